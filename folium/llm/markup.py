"""Clean text from documents that still hold HTML, Markdown, wiki or LaTeX markup.

Method: consensus host paths. Every page's HTML containers are scored (text, punctuation and share of
link text) under their generalised tag-class path, at any depth; every page votes per host and path in Spark
whether it holds text or links and scripts; then each page is extracted again by the outcome. A path wins
where most pages hold text, and loses where enough pages are against it. A container is kept or left out by
the outcome for the innermost container around its text that is decided, so a winning path inside a losing
one is kept; where none is decided the whole page is kept. What is kept, and all markup without containers,
is converted construct by construct: headings become lines of their own, list items
keep their hyphen, table rows become tab-separated lines, code keeps its lines and formulas a plain
spelling. ``kinds`` names the constructs removed or converted; a row without any keeps its text.

No markup are: list markers, tab- or label-separated tables, source code itself, type names such as
``Map<String, Long>``, path parameters, template blanks, prices, comparisons and other plain symbols.

A null text stays null with no kinds, an empty one stays empty. The host may be null.
"""

from __future__ import annotations

import hashlib
import html
import html.entities
import re
from collections import defaultdict
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folium.runtime import join_bounded

# Element names of HTML (and of wiki text: ref, nowiki, gallery, references).
TAGS = (
    "a abbr acronym address article aside audio b base big blockquote body br button canvas caption center cite code col colgroup dd del details dfn div dl dt em "
    "embed fieldset figcaption figure font footer form frame gallery h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd li link main mark menu meta nav "
    "noscript nowiki object ol option p picture pre q ref references s samp script section select small span strike strong style sub summary sup svg table tbody td "
    "template textarea tfoot th thead title tr tt u ul var video wbr"
).split()
BLOCK_TAGS = set("address article aside blockquote body center dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav noscript ol p pre section summary table title tr ul".split())
DROPPED_TAGS = {"script", "style"}

TAG = re.compile(rf"<(/?)({'|'.join(TAGS)})((?:\s+[^<>]*)?)\s*/?>", re.I)
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!doctype[^>]*>", re.S | re.I)
ENTITY = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_NAMES = {k.rstrip(";").lower(): v for k, v in html.entities.html5.items() if len(k) > 2} | {k.rstrip(";"): v for k, v in html.entities.html5.items()}

FENCE = re.compile(r"^([ \t]*)(`{3,}|~{3,})[^\n`]*\n(.*?)(?:^[ \t]*\2[`~]*[ \t]*$\n?|\Z)", re.M | re.S)
PRE = re.compile(r"<pre\b[^>]*>(.*?)(?:</pre\s*>|\Z)", re.I | re.S)
WIKI_CODE = re.compile(r"^\{(code|noformat)(?::[^}\n]*)?\}[ \t]*\n(.*?)(?:^\{\1\}[ \t]*$|\Z)", re.M | re.S | re.I)
VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting|minted)\}(?:\[[^\]\n]*\])?\n?(.*?)(?:\\end\{\1\}|\Z)", re.S | re.I)
EQUATION = re.compile(r"\\begin\{(equation|align|gather|displaymath|math)(\*?)\}(.*?)(?:\\end\{\1\2\}|\Z)", re.S | re.I)
DISPLAY = re.compile(r"\$\$(.+?)\$\$|\\\[(.+?)\\\]", re.S)
INLINE = re.compile(r"\\\((.+?)\\\)|(?<![\w$\\])\$(?=[^\s${(])([^$\n]*?(?:\\[A-Za-z]+|\^|_\{)[^$\n]*?)(?<=\S)\$(?![\w{])", re.S)
LATEX_HEAD = re.compile(r"^[ \t]*\\(?:part|chapter|(?:sub)*section|(?:sub)?paragraph)\*?\{([^{}\n]*)\}", re.M | re.I)
LATEX_ENV = re.compile(r"^[ \t]*\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?[ \t]*\n?", re.M | re.I)
LATEX_ITEM = re.compile(r"^([ \t]*)\\item\b[ \t]*(?:\[([^\]\n]*)\])?[ \t]*", re.M | re.I)
LATEX_CITE = re.compile(r"~?\\(?:cite|citep|citet|label|ref|eqref|footnotemark|index)\{[^{}\n]*\}", re.I)
LATEX_STYLE = re.compile(r"\\(?:text(?:bf|it|tt|sc|rm|sf)|emph|underline|footnote|url|mathrm|mbox)\{([^{}]*)\}", re.I)
LATEX_HREF = re.compile(r"\\href\{[^{}\n]*\}\{([^{}]*)\}", re.I)

ATX = re.compile(r"^ {0,3}(#{2,6})[ \t]+(\S[^\n]*?)[ \t]*#*[ \t]*$|^ {0,3}(#{1,6})([^\W\d_a-z][^\n]*?)[ \t]*$", re.M)
ATX1 = re.compile(r"(?:\A|(?<=\n\n))# ([^\W\d_a-z][^\n]*?)[ \t]*(?=\n[ \t]*\n|\s*\Z)")
SETEXT = re.compile(r"(?:\A|(?<=\n))([^\s|>#\-=][^\n\t|]*)\n(?:={3,}|-{3,})[ \t]*(?=\n|\Z)")
RULE = re.compile(r"^[ \t]*(?:(?:\*[ \t]*){3,}|-{3,})[ \t]*$\n?", re.M)
QUOTE = re.compile(r"^[ \t]{0,3}>(?:[ \t]*>)*[ \t]?(?=\S|$)", re.M)
TASK = re.compile(r"^([ \t]*[-*+][ \t]+)\[[ xX]\][ \t]+", re.M)
IMAGE = re.compile(r"!\[([^\]\n]*)\](?:\([^()\n]*\)|\[[^\]\n]*\])")
LINK = re.compile(r"(?<![\w\]])\[([^\[\]\n]*)\]\((?:<[^<>\n]*>|[^()\s]+)(?:[ \t]+\"[^\"\n]*\")?\)")
REFLINK = re.compile(r"(?<![\w\]])\[([^\[\]\n]+)\]\[([\w -]*)\]")
LINKDEF = re.compile(r"^[ \t]{0,3}\[([^\]\n^]+)\]:[ \t]+\S+(?:[ \t]+(?:\"[^\"\n]*\"|'[^'\n]*'|\([^()\n]*\)))?[ \t]*$\n?", re.M)
FOOTDEF = re.compile(r"^[ \t]{0,3}\[\^(\d+)\]:[ \t]*", re.M)
FOOTREF = re.compile(r"\[\^\d+\]")
CODE_SPAN = re.compile(r"(?<!`)(`{1,2})(?!`)([^`\n]+?)\1(?!`)")
STAR3 = re.compile(r"(?<![\w*])\*\*\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*\*\*(?![\w*])")
STAR2 = re.compile(r"(?<![\w*])\*\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*\*(?![\w*])")
STAR1 = re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])")
UNDER2 = re.compile(r"(?<![\w_])__(?=[^\s_])([^\n]+?)(?<=[^\s_])__(?![\w_])")
UNDER1 = re.compile(r"(?<![\w_/{<%$@])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_}>%@])")
STRIKE = re.compile(r"~~(?=[^\s~])([^~\n]+?)(?<=[^\s~])~~")
PIPE_RULE = re.compile(r"^[ \t]*\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)+\|?[ \t]*$")
PIPE_ROW = re.compile(r"^[ \t]*\|.*\|[ \t]*$")
WIKI_TABLE = re.compile(r"^\{\|[^\n]*\n(.*?)(?:^\|\}[ \t]*$|\Z)", re.M | re.S)
WIKI_HEAD = re.compile(r"^={2,6}[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*$", re.M)
CONF_HEAD = re.compile(r"^h[1-6]\.[ \t]+(\S[^\n]*)$", re.M | re.I)
CATEGORY = re.compile(r"\[\[(?:Category|Categor[ií]a|File|Archivo|Arquivo|Image|Imagen?m?):[^\[\]\n]*\]\][ \t]*\n?", re.I)
WIKI_LINK = re.compile(r"\[\[(?![\s])(?:[^\[\]|\n]*\|)?([^\[\]|\n]+)\]\]")
WIKI_CALL = re.compile(r"\{\{\s*[^\W\d_][\w ]*\|((?:[^{}]|\{[^{}]*\}|\{\{[^{}]*\}\})*)\}\}")
QUOTE3 = re.compile(r"(?<![\w'])'''(?=[^\s'])(.+?)(?<=[^\s'])'''(?![\w'])")
QUOTE2 = re.compile(r"(?<![\w'])''(?=[^\s'])([^\n]+?)(?<=[^\s'])''(?![\w'])")
BLANKS = re.compile(r"\n[ \t]*\n(?:[ \t]*\n)+")

_GREEK = {"alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "lambda": "λ", "mu": "μ", "sigma": "σ", "theta": "θ", "pi": "π", "sum": "∑", "prod": "∏", "int": "∫", "cdot": "·", "times": "×", "leq": "≤", "geq": "≥", "infty": "∞"}


def entity(m: re.Match) -> str:
    """The character of an entity, or the entity itself where its name is unknown."""
    name = m.group(1)
    if name[0] == "#":
        return html.unescape(m.group(0))
    return _NAMES.get(name, _NAMES.get(name.lower(), m.group(0)))


def plain_formula(tex: str) -> str:
    """A readable spelling of a simple LaTeX formula."""
    s = re.sub(r"\\label\{[^{}]*\}", "", tex)
    before = None
    while before != s:  # from the inside out, at any depth
        before = s
        s = re.sub(r"\\frac\{([^{}]*)\}\{([^{}]*)\}", r"(\1)/(\2)", s)
        s = re.sub(r"\\sqrt\{([^{}]*)\}", r"√(\1)", s)
    s = re.sub(r"([_^])\{(\w)\}", r"\1\2", s)
    s = re.sub(r"([_^])\{([^{}]*)\}", r"\1(\2)", s)
    s = re.sub(r"\\([A-Za-z]+)", lambda m: _GREEK.get(m.group(1), m.group(1)), s)
    return re.sub(r"\s+", " ", s.replace("\\\\", " ")).strip()


def _dedent(code: str, indent: str) -> str:
    lines = code.rstrip("\n").split("\n")
    return "\n".join(x[len(indent) :] if indent and x.startswith(indent) else x for x in lines)


#: Characters up to which a container's path is spelled out.
LONG_PATH = 400


def generalised(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """``tag.class`` with digits folded, the step of a container's path."""
    cls = next((v for k, v in attrs if k == "class" and v), None)
    return tag if not cls else f"{tag}.{re.sub(r'[0-9]+', '0', cls.split()[0].lower())}"


def path_under(parent: str, tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """Path of a container within ``parent``; a long path is spelled by its digest, so any depth has one of bounded size."""
    path = (parent + ">" if parent else "") + generalised(tag, attrs)
    return path if len(path) <= LONG_PATH else hashlib.md5(path.encode("utf-8", "replace")).hexdigest()


KEPT_TAGS = {"div", "section", "article", "aside", "nav", "header", "footer", "main", "ul", "ol", "table", "details", "form", "p", "body", "noscript", "script", "style"}


class _Open:
    """The open containers of a page, as ``(tag, path)``; a paragraph ends where another begins."""

    def __init__(self):
        self.stack: list[tuple[str, str]] = []

    def start(self, tag: str, attrs) -> bool:
        if tag not in KEPT_TAGS:
            return False
        if tag == "p" and self.stack and self.stack[-1][0] == "p":
            self.stack.pop()
        self.stack.append((tag, path_under(self.path, tag, attrs)))
        return True

    def end(self, tag: str) -> None:
        """Close the innermost container of this tag and what is open within it; an end without a beginning closes nothing."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                break

    @property
    def path(self) -> str:
        return self.stack[-1][1] if self.stack else ""


class _Containers(HTMLParser):
    """Text, link text and punctuation under every container path of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = _Open()
        self.link = 0
        self.found: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link += 1
        if self.open.start(tag, attrs):
            self.found[self.open.path]  # noqa: B018 - an empty container has its vote too

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = max(0, self.link - 1)
        self.open.end(tag)

    def handle_data(self, data):
        size = len(data.strip())
        if not size or not self.open.stack:
            return
        code = self.open.stack[-1][0] in DROPPED_TAGS
        v = self.found[self.open.path]
        v[0] += size
        v[1] += size if self.link or code else 0
        v[2] += sum(data.count(c) for c in ".,;:")


def container_scores(text: str) -> dict[str, tuple[float, float, float]]:
    """Per container path of one page: text length, share that is links or scripts, and marks of punctuation."""
    p = _Containers()
    try:
        p.feed(text)
        p.close()
    except (ValueError, AssertionError):  # malformed markup of a kind the parser refuses
        return {}
    return {k: (v[0], v[1] / v[0] if v[0] else 0.0, v[2]) for k, v in p.found.items()}


class _Extract(HTMLParser):
    """Text of a page by the outcome for its container paths, with block structure as lines."""

    def __init__(self, outcome: dict[str, bool]):
        super().__init__(convert_charrefs=False)
        self.outcome, self.out = outcome, []
        self.open = _Open()
        self.first_cell = True

    def _kept(self) -> bool:
        if any(t in DROPPED_TAGS for t, _ in self.open.stack[-1:]):
            return False
        return next((self.outcome[p] for _, p in reversed(self.open.stack) if p in self.outcome), True)

    def _emit(self, s: str) -> None:
        if self._kept():
            self.out.append(s)

    def _line(self) -> None:
        if self.out and not self.out[-1].endswith("\n"):
            self._emit("\n")

    def handle_starttag(self, tag, attrs):
        if tag not in _TAG_SET:
            self._emit(self.get_starttag_text() or "")
            return
        self.open.start(tag, attrs)
        if tag == "tr":
            self.first_cell = True
        if tag in ("td", "th"):
            if not self.first_cell:
                self._emit("\t")
            self.first_cell = False
        elif tag == "br":
            self._emit("\n")
        elif tag in BLOCK_TAGS:
            self._line()
            if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.out:
                self._emit("\n")
            if tag == "li":
                self._emit("- ")
        elif tag == "ref":
            self._emit(" (")
        elif tag == "img":
            alt = next((v for k, v in attrs if k == "alt" and v), "")
            self._emit(alt)

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self._emit("\n")
        elif tag not in _TAG_SET:
            self._emit(self.get_starttag_text() or "")

    def handle_endtag(self, tag):
        if tag not in _TAG_SET:
            self._emit(f"</{tag}>")
            return
        self.open.end(tag)
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._line()
            self._emit("\n")
        elif tag in BLOCK_TAGS:
            self._line()
        elif tag == "ref":
            self._emit(")")

    def handle_data(self, data):
        self._emit(data)

    def unknown_decl(self, data):
        self._emit(f"<![{data}]>")


_TAG_SET = set(TAGS)
_UPPER_GENERIC = re.compile(r"(?<=\w)<([A-Z]\w*)>")


def _has_tag(text: str) -> bool:
    """Whether a known element occurs, not counting type arguments such as ``List<Label>``."""
    for m in TAG.finditer(text):
        s = m.start()
        if m.group(1) or m.group(3) or not (m.group(2)[0].isupper() and s and (text[s - 1].isalnum() or text[s - 1] == "_")):
            return True
        if m.group(2).lower() == "br":
            return True
    return False


def _extract_html(text: str, outcome: dict[str, bool]) -> str:
    # comparisons and type arguments must not look like tags to the parser
    safe = re.sub(rf"<(?!/?(?:{'|'.join(TAGS)})(?:[\s/>]))", "\x02", text, flags=re.I)
    safe = _UPPER_GENERIC.sub(lambda m: "\x02" + m.group(1) + ">", safe).replace("&", "\x03")
    p = _Extract(outcome)
    p.feed(safe)
    p.close()
    return "".join(p.out).replace("\x02", "<").replace("\x03", "&")


def _pipe_tables(text: str, kinds: set[str]) -> str:
    out = []
    for line in text.split("\n"):
        if "|" in line:
            if PIPE_RULE.match(line):
                kinds.add("table")
                continue
            if PIPE_ROW.match(line):
                kinds.add("table")
                s = line.strip()
                cells = s.strip("|").split("||") if s.startswith("||") else s[1:-1].split("|")
                out.append("\t".join(c.strip() for c in cells))
                continue
        out.append(line)
    return "\n".join(out)


def _wiki_table(m: re.Match) -> str:
    rows: list[list[str]] = []
    cells: list[str] = []
    for line in m.group(1).split("\n"):
        s = line.strip()
        if s.startswith("|-"):
            if cells:
                rows.append(cells)
            cells = []
        elif s.startswith("|+"):
            rows.append([s[2:].strip()])
        elif s[:1] in "|!" and s:
            cells += [c.strip() for c in re.split(r"\|\||!!", s[1:])]
        elif s:
            cells = [*cells[:-1], f"{cells[-1]} {s}"] if cells else [s]
    if cells:
        rows.append(cells)
    return "\n".join("\t".join(r) for r in rows) + "\n"


def _call_text(m: re.Match) -> str:
    """The text of a template call: its text argument, else its arguments one by one."""
    args = [a.strip() for a in m.group(1).split("|")]
    named = dict(a.split("=", 1) for a in args if "=" in a)
    for k in ("texto", "text", "1", "contenido", "content"):
        if k in {x.strip().lower() for x in named}:
            return next(v.strip() for x, v in named.items() if x.strip().lower() == k)
    return "\n".join(f"{a.split('=', 1)[0].strip()}: {a.split('=', 1)[1].strip()}" if "=" in a else a for a in args)


def convert(text: str | None, outcome: dict[str, bool] | None = None) -> tuple[str | None, list[str]]:
    """Clean text and the sorted kinds of constructs that were removed or converted."""
    if not text:
        return text, []
    kinds: set[str] = set()
    kept: list[str] = []
    t = text.replace("\x00", "") if "\x00" in text else text

    def hold(s: str) -> str:
        kept.append(s)
        return f"\x00{len(kept) - 1}\x00"

    def apply(pattern: re.Pattern, new, kind: str) -> None:
        nonlocal t
        t, n = pattern.subn(new, t)
        if n:
            kinds.add(kind)

    def code(s: str) -> str:
        return hold(ENTITY.sub(entity, s) if "&" in s else s)

    if "```" in t or "~~~" in t:
        apply(FENCE, lambda m: code(_dedent(m.group(3), m.group(1))) + "\n", "code")
    if "<" in t:
        if "<!" in t:
            apply(COMMENT, "", "html_comment")
        low = t.lower()
        if "<pre" in low:
            apply(PRE, lambda m: "\n" + code(re.sub(r"</?code\b[^>]*>", "", m.group(1), flags=re.I).strip("\n")) + "\n", "html")
    if "{" in t:
        apply(WIKI_CODE, lambda m: code(m.group(2).rstrip("\n")), "wiki")
        if "{|" in t:
            apply(WIKI_TABLE, _wiki_table, "wiki")
        if "{{" in t:
            apply(WIKI_CALL, _call_text, "wiki")
    if "\\" in t:
        apply(VERBATIM, lambda m: code(m.group(2).rstrip("\n")), "latex")
        apply(EQUATION, lambda m: hold(plain_formula(m.group(3))), "formula")
        apply(DISPLAY, lambda m: hold(plain_formula(m.group(1) or m.group(2))), "formula")
        apply(INLINE, lambda m: hold(plain_formula(m.group(1) or m.group(2))), "formula")
        apply(LATEX_HEAD, lambda m: "\n" + m.group(1) + "\n", "latex")
        apply(LATEX_ITEM, lambda m: "- " + (m.group(2) + ": " if m.group(2) else ""), "latex")
        apply(LATEX_ENV, "", "latex")
        apply(LATEX_CITE, "", "latex")
        apply(LATEX_HREF, r"\1", "latex")
        apply(LATEX_STYLE, r"\1", "latex")
    elif "$" in t:
        apply(DISPLAY, lambda m: hold(plain_formula(m.group(1) or m.group(2))), "formula")
        apply(INLINE, lambda m: hold(plain_formula(m.group(1) or m.group(2))), "formula")
    if "`" in t:
        apply(CODE_SPAN, lambda m: hold(m.group(2).strip()), "code_span")
    if "<" in t and _has_tag(t):
        kinds.add("html")
        t = _extract_html(t, outcome or {})
    if "&" in t:
        before = t
        t = ENTITY.sub(entity, t)
        if t != before:
            kinds.add("entity")
    if "#" in t:
        apply(ATX, lambda m: (m.group(2) or m.group(4)).strip(), "heading")
        apply(ATX1, r"\1", "heading")
    if "===" in t or "---" in t:
        apply(SETEXT, r"\1", "heading")
    if "***" in t or "---" in t or "* *" in t:
        apply(RULE, "", "rule")
    if ">" in t:
        apply(QUOTE, "", "quote")
    if "[" in t:
        apply(TASK, r"\1", "task")
        if "[[" in t:
            apply(CATEGORY, "", "wiki")
            apply(WIKI_LINK, r"\1", "wiki")
        if "![" in t:
            apply(IMAGE, r"\1", "image")
        if "](" in t:
            apply(LINK, r"\1", "link")
        if "][" in t:
            apply(REFLINK, r"\1", "link")
        if "]:" in t:
            apply(FOOTDEF, r"\1. ", "footnote")
            apply(LINKDEF, "", "link")
        if "[^" in t:
            apply(FOOTREF, "", "footnote")
    if "|" in t:
        t = _pipe_tables(t, kinds)
    if "==" in t:
        apply(WIKI_HEAD, r"\1", "heading")
    if "h" in t or "H" in t:
        apply(CONF_HEAD, r"\1", "heading")
    if "*" in t:
        for p in (STAR3, STAR2, STAR1):
            apply(p, r"\1", "emphasis")
    if "_" in t:
        if "__" in t:
            apply(UNDER2, r"\1", "emphasis")
        apply(UNDER1, r"\1", "emphasis")
    if "~~" in t:
        apply(STRIKE, r"\1", "emphasis")
    if "''" in t:
        apply(QUOTE3, r"\1", "emphasis")
        apply(QUOTE2, r"\1", "emphasis")
    if not kinds:
        return text, []
    for _ in range(2):  # a held formula may lie inside a held span
        t = re.sub("\x00(\\d+)\x00", lambda m: kept[int(m.group(1))], t)
    return BLANKS.sub("\n\n", t).strip(" \n"), sorted(kinds)


#: Pages of a host that must hold a path before it is decided, and the share of link or script text from which a page is against it.
MIN_PAGES = 5
LOSING_LINKS = 0.8


def page_votes(text: str) -> dict[str, int]:
    """Vote of one page on each of its container paths: 1 for text, -1 for links and scripts, 0 for an empty container."""
    return {path: 0 if not size else -1 if links >= LOSING_LINKS and marks < size / 40 else 1 for path, (size, links, marks) in container_scores(text).items()}


def vote_paths(df: DataFrame, host: str, text: str) -> DataFrame:
    """``host, outcome``: for every container path that its pages decide, whether it won (holds text)."""
    rows = df.select(df[host].alias("host"), df[text].alias("text")).where("host is not null and contains(text, '<')")

    def run(batches):
        for b in batches:
            sums: dict[tuple[str, str], list[int]] = {}
            for h, t in zip(b.column("host").to_pylist(), b.column("text").to_pylist()):
                if _has_tag(t):
                    for path, vote in page_votes(t).items():
                        v = sums.setdefault((h, path), [0, 0])
                        v[0] += vote != 0
                        v[1] += vote
            cols = list(zip(*[(h, p, *v) for (h, p), v in sums.items()])) or [[]] * 4
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["host", "path", "pages", "votes"])

    partial = rows.mapInArrow(run, "host string, path string, pages long, votes long")
    decided = partial.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("votes").alias("votes")).where(f"pages >= {MIN_PAGES} and votes <> 0")
    # a host where nothing lost needs no outcome: its pages are kept whole
    per = decided.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", F.col("votes") > 0))).alias("outcome"), F.min("votes").alias("least"))
    return per.where("least < 0").select("host", "outcome")


def clean(df: DataFrame, keys: list[str], host: Column, text: str = "text", with_text: bool = True) -> DataFrame:
    """``keys``, ``clean_text`` and ``kinds`` of every row; ``host`` says whose pages vote together."""
    rows = df.select(*[df[k] for k in keys], host.alias("_host"), df[text].alias("_text"))
    outcome = vote_paths(rows, "_host", "_text").withColumnRenamed("host", "_host")
    joined = join_bounded(rows, outcome, ["_host"], "left", salt=16).select(*keys, "_text", "outcome")
    n = len(keys)
    fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for b in batches:
            texts, outcomes = b.column(n).to_pylist(), b.column(n + 1)
            maps = [None] * len(texts) if outcomes.null_count == len(texts) else outcomes.to_pylist()
            done = [convert(t, dict(x) if x else None) for t, x in zip(texts, maps)]
            cleaned = pa.array([x[0] for x in done], pa.string()) if with_text else pa.nulls(len(done), pa.string())
            kinds = pa.array([x[1] for x in done], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n)], cleaned, kinds], names=[*keys, "clean_text", "kinds"])

    return joined.mapInArrow(run, f"{fields}, clean_text string, kinds array<string>")
