"""Template residue and error-page text standing in place of real content.

Method: positive-unlabelled naive Bayes by expectation-maximization. A short, general list of phrases (status
names of the HTTP standard, access notices, placeholders, orders to fill in) only seeds it: a record is
trusted to stand in for content where such phrases make up ``SEED_SHARE`` of its words, where it is a
template with its blanks unfilled, blind text, or one phrase over and over. All other records are
unlabelled, but for passages that refer to or introduce a page, which are trusted to be content.

The model is fitted on a bounded sample: up to ``POSITIVES`` distinct trusted passages and ``UNLABELLED``
distinct others of about ``RECORDS`` unlabelled records, the ones with the smallest hashes, over the whole
table. Records are thinned by the share of distinct texts and counts are brought down to those of a table
without copies, so a table copied as a whole gives the same model. Counts are weighted so that both classes
stand for the same share of the table, and a larger table gives the same odds. The posteriors of unlabelled passages, the rates of the features and the class weight
are re-estimated until they settle; so passages that no phrase matches join the class by what they share
with it. No single feature weighs more than ``MOST_ODDS``, as the sample may lack a usual word. Then every
passage of every record is scored by the model alone, whole: a record stands in for content if its passages
do taken together and none is clearly content. A bare section title before them changes nothing.

Null and blank texts hold no content and no stand-in: they are not found. Real content that cites a
message, and real content that is merely short, has passages of its own and is not found.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from http import HTTPStatus

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.llm.pubayes import FEATURE, Model
from folium.runtime import Stage

#: Distinct trusted and other passages that the model is fitted on, at most.
POSITIVES = 20_000
UNLABELLED = 60_000
#: Distinct records that passages are taken from, about; in a larger table unlabelled ones are thinned and trusted ones weighted.
RECORDS = 30_000
#: Kinds in the sample: trusted records, unlabelled records of up to ``FEW`` passages, and longer ones. Half of the unlabelled part is
#: of either kind and stands for all of it, as stand-ins are brief and would be rare among all. The passages of a record of up to
#: ``FEW`` are fitted together, as they share its class; longer records are fitted passage by passage.
TRUSTED, BRIEF, LONGER = 2, 1, 0
FEW = 3
#: Share of a record's words in seed phrases (or blanks) from which it is trusted.
SEED_SHARE = 0.4
#: Log odds below which a passage is clearly content.
CLEARLY_CONTENT = -3.0

# Seeds: phrases of which a trusted record mainly consists, by what stands in for content.
SEEDS = {
    "error": [
        rf"(?:error )?(?:<n> )?(?:{'|'.join(re.escape(s.phrase.lower()) for s in HTTPStatus if s >= 400)})", r"\berror <n>", r"\b(?:oops|ups)\b", r"\brequest id:? <n>", r"\bref\W* <n>",
        r"(?:something went wrong|(?:an )?(?:unexpected )?error (?:has )?occurred|ocurrió un error|ocorreu um erro)(?: on our side| inesperado)?",
        r"(?:page|página)(?: solicitada)? (?:not found|does not exist|no existe|não existe|não encontrada|no encontrada)",
        r"(?:try again|intente de nuevo|tente novamente)(?: later| más tarde| mais tarde)?", r"(?:session|sesión|sessão) (?:has )?(?:expired|expirada|expirou)",
        r"(?:you do not have permission|no tiene permiso|você não tem permissão|access denied|acceso denegado|acesso negado)", r"(?:did not answer|no respondió|não respondeu)(?: in time| a tiempo| a tempo)?",
    ],
    "notice": [
        r"(?:please |por favor )?(?:enable|turn on|allow|habilitar|habilite|active|activar|ative|permita) (?:las |the |os )?(?:javascript|scripts|cookies)",
        r"(?:javascript|scripts|cookies)(?: (?:is|are|está|no está|não está))? (?:required|needed|disabled|turned off|activo|desactivado|desativado)",
        r"(?:your browser|su navegador|seu navegador)(?: is not| no es| não é)?(?: supported| compatible| compatível)?", r"(?:that )?(?:you are|usted es|você é) (?:a )?(?:human|humano|humana)",
        r"(?:may|puede|pode) (?:take|tardar|demorar) (?:a few|unos|alguns) (?:seconds|segundos)", r"\b(?:loading|cargando|carregando)\b", r"(?:please wait|espere un momento|aguarde)",
    ],
    "placeholder": [
        r"\b(?:to do|todo|tbd|tba|wip|fixme|n/a|pending|pendiente|pendente)\b", r"(?:coming soon|próximamente|em breve|under construction|en construcción|em construção|in preparation|en preparación|em preparação)",
        r"(?:\bto be|\bpor|\ba|\bde) (?:defined|determined|completed|written|definir|completar|redactar|preencher)\b", r"(?:no content|sin contenido|sem conteúdo)", r"(?:fill in|add|complete)(?: it| this)? later",
    ],
    "order": [
        r"\b(?:insert|type|write|enter|add|escriba|escribe|inserte|insira|introduzca|digite|escreva|agregar|describa|describe|descreva)(?: (?:your|su|seu|o|el|la|a|un|una|um|uma|breve|short))* "
        r"(?:text|content|description|texto|contenido|conteúdo|descripción|descrição|here|aquí|aqui)(?: (?:here|aquí|aqui))?",
        r"(?:replace|reemplace|substitua) (?:this|este|esta) (?:text|paragraph|texto|párrafo|parágrafo)", r"(?:click|haga clic|clique)(?: to| para| here| aquí| aqui)",
        r"(?:your|su|seu) (?:own )?(?:text|content|texto|contenido|conteúdo)(?: goes here| va aquí)?",
        r"\b(?:section|sección|seção|title|título|item|step|paso|description|descripción|descrição|flow|flujo|fluxo|body|heading)(?: (?:title|body|section|heading|text))? <n>", r"\bsection (?:title|body|text)",
    ],
}
# Passages trusted to be content, though short: references to another page, and what a page is about.
CONTENT_FORMS = re.compile(
    r"\W*(?:(?:see|ver|véase|vea|veja|cf)\b|(?:this|these|esta|este|estas|estos|essa|esse) (?:page|section|document|chapter|guide|table|página|sección|seção|documento|capítulo|guía|guia|tabla|tabela) "
    r"(?:describes|explains|lists|shows|contains|covers|documents|describe|explica|enumera|muestra|contiene|documenta|descreve|lista|mostra|contém)\b).*", re.I | re.S
)
# Words of the usual blind text.
BLIND_WORDS = {"lorem", "ipsum", "dolor", "sit", "amet"}
FILLER = re.compile(r"(?P<u>\b[^\W\d_]{3,}(?: [^\W\d_]{2,}){0,3})(?:[\s,.;]+(?P=u)){2,}[.!,\s]*", re.I)

BLANK = re.compile(r"\{\{\s*[\w.-]+\s*\}\}|\$\{\w+\}|<%=?[^%<>]*%>|@@\w+@@|%[A-Za-z]\w+%|_{4,}|\[(?:INSERT|INSERTAR|INSERIR)\b[^\]\n]*\]|\bX{3,}\b|<(?!/)(?!(?:br|hr|p|b|i|a|ul|li|ol|h[1-6]|pre|code|body|center|title|noscript|summary|details|table|tr|td|th|div|span|strong|em|ref)>)[a-z]+(?:-[a-z0-9]+)*>")
TAG = re.compile(r"</?[a-zA-Z][^<>]*>|<!--.*?-->", re.S)
PASSAGE = re.compile(r"(?<=[.!?…])\s+|\n+")
NUMBER = re.compile(r"\b[0-9a-z]*\d[0-9a-z]*(?:[.,]\d+)*\b", re.I)
NAME = re.compile(r"\b[A-Za-z]+(?:_[A-Za-z0-9]+)+\b|\b[a-z]+(?:[A-Z][a-z0-9]*)+\b")
SHORT_ANCHORS = {"tbd", "tba", "wip", "n/a", "ups", "ref", "do", "uri", "too"}
MARKS = ("<", "{{", "${", "____", "@@", "[INS", "XXX", "%")
RAW_WORD = re.compile(r"n/a|[^\W_]+(?:_[^\W_]+)*")
NORMAL_WORD = re.compile(r"<blank>|<name>|n/a|[^\W_]+")
MARK = re.compile(r"\W*(?:ref\W+)?(?:<n>|<blank>)?\W*", re.I)
TITLE = re.compile(r"[#=\s]*[^\W\d_][^\n.!?:;{}<>=|]{0,60}?[=\s]*\n\s*\n")


def normal(text: str) -> str:
    """A text with blanks, numbers and identifiers as symbols, without tags."""
    t = BLANK.sub(" <blank> ", text)
    t = TAG.sub(lambda m: " " if m.group(0) not in ("<blank>", "<name>", "<n>") else m.group(0), t)
    t = NAME.sub(" <name> ", t)
    return " ".join(NUMBER.sub("<n>", t).split())


def body(text: str) -> str:
    """The text after a bare section title."""
    m = TITLE.match(text)
    return text[m.end() :] if m and text[m.end() :].strip() else text


class Seeds:
    """Trusted records, by a list of seed phrases."""

    def __init__(self, phrases: list[str]):
        self.phrase = re.compile(rf"(?<!\w)(?:{'|'.join(phrases)})", re.I) if phrases else None
        words = re.findall(r"[^\W\d_]+", re.sub(r"\\[A-Za-z]", " ", " ".join(phrases)).lower())
        self.anchors = {w for w in words if len(w) > 3} | SHORT_ANCHORS

    def _possible(self, text: str) -> bool:
        """A quick bound from above: at most three words of a phrase go to each of its longer ones."""
        text, blanks = body(text), 0
        if any(m in text for m in MARKS):
            text, blanks = BLANK.subn(" ", text)
            if "<" in text:
                text = TAG.sub(" ", text)
        words = RAW_WORD.findall(text.lower())
        n = sum(w.isalpha() for w in words) + blanks
        if 3 * sum(w in self.anchors for w in words) + blanks >= SEED_SHARE * n or (blanks > 1 and blanks * 5 >= n):
            return True
        return sum(w in BLIND_WORDS for w in words) * 8 >= n or len(set(words)) * 3 <= n

    def trusted(self, text: str) -> bool:
        """Whether the record as a whole consists mainly of seed phrases, unfilled blanks, blind text or one phrase over and over."""
        if not self._possible(text):
            return False
        t = normal(body(text))
        words = [w.lower() for w in NORMAL_WORD.findall(t)]
        if not words:
            return False
        blind = [w for w in words if w in BLIND_WORDS]
        if len(set(blind)) > 1 and len(blind) * 8 >= len(words):
            return True
        blanks = words.count("<blank>")
        if (blanks > 1 and blanks * 5 >= len(words)) or FILLER.fullmatch(t):
            return True
        seeded = sum(len(NORMAL_WORD.findall(m.group())) for m in self.phrase.finditer(t)) if self.phrase else 0
        return seeded > 0 and seeded + blanks >= SEED_SHARE * len(words)


def passages(text: str) -> Iterator[str]:
    """Normalised passages (lines and sentences) of a record, without its title; a bare mark joins the one before."""
    held = ""
    for x in PASSAGE.split(body(text)):
        p = normal(x)
        if held and MARK.fullmatch(p):
            held += " " + p
        elif FEATURE.search(p):
            if held:
                yield held
            held = p
    if held:
        yield held


def stands_in(model: Model, text: str | None) -> bool:
    """Whether the passages of the record stand in for content, taken together, and none is clearly content."""
    if not text or not model.odds:
        return False
    some, total = False, 0.0
    for p in passages(text):  # the first passage that is clearly content decides
        some, s = True, model.score(p)
        if s < CLEARLY_CONTENT:
            return False
        total += s
    return some and total > 0


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "little", signed=True)


def fit(df: DataFrame, text: str = "text", seeds: list[str] | None = None) -> Model:
    """The model of a table; a first pass picks the passages with the smallest hashes of either kind. ``seeds`` are other phrases to trust."""
    known = Seeds([p for group in SEEDS.values() for p in group] if seeds is None else seeds)
    rows = df.select(df[text].alias("t")).where("t is not null")
    size = rows.agg(F.count("*").alias("n"), F.count_distinct(F.xxhash64("t")).alias("texts")).first()
    # unlabelled records are thinned by their hash, which takes all copies of a text or none: the share is one of texts, so that
    # about enough different ones come, whatever the size and however often each is copied
    share = min(1.0, RECORDS / max(1, size["texts"]))
    bound = min(2**63 - 1, int(-(2**63) + 2**64 * share))

    def run(batches):
        for b in batches:
            got: dict[tuple[int, str, int], list[int]] = {}
            for t in b.column(0).to_pylist():
                good, h = known.trusted(t), _hash(t)
                if good or h < bound:
                    ps = list(passages(t))
                    kind = TRUSTED if good else BRIEF if len(ps) <= FEW else LONGER
                    for p, k in Counter(ps if len(ps) > FEW else ["\n".join(ps)]).items():
                        got.setdefault((kind, p, h), [0, k])[0] += k
            cols = [pa.array([k[i] for k in got], x) for i, x in enumerate((pa.int32(), pa.string(), pa.int64()))] + [pa.array([v[i] for v in got.values()], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(cols, names=["kind", "p", "h", "n", "once"])

    per_text = rows.mapInArrow(run, "kind int, p string, h long, n long, once long").groupBy("kind", "p", "h").agg(F.sum("n").alias("n"), F.max("once").alias("once"))
    counted = per_text.groupBy("kind", "p").agg(F.sum("n").alias("n"), F.sum("once").alias("once"))
    stage = Stage(df.sparkSession, "standins")
    picked = stage.put(counted)
    total = {r["kind"]: r["n"] for r in picked.groupBy("kind").agg(F.sum("n").alias("n")).collect()}

    repeated: set[str] = set()
    fresh = size["texts"] / max(1, size["n"])  # counts of a table copied as a whole are those of one copy

    def smallest(kind: int, most: int, part: float) -> dict[str, float]:
        """Passages whose counts add up to ``part`` of those of all passages of the kind."""
        got = picked.where(F.col("kind") == kind).orderBy(F.xxhash64("p"), "p").limit(most).collect()
        repeated.update(r["p"] for r in got if r["once"] > 1)  # more than once if each text is counted once
        weight = part * fresh * total.get(kind, 0) / max(1, sum(r["n"] for r in got))
        return {r["p"]: r["n"] * weight for r in got}

    # every trusted record was counted, but only a share of the others
    good = smallest(TRUSTED, POSITIVES, share)
    others: dict[str, float] = {}
    for kind in (BRIEF, LONGER):
        for p, n in smallest(kind, UNLABELLED // 2, 1.0).items():
            if p not in good:
                others[p] = others.get(p, 0.0) + n
    stage.drop(picked)
    return Model(good, others, repeated, CONTENT_FORMS)


def find(df: DataFrame, key: str = "id", text: str = "text", keep_real: bool = False, seeds: list[str] | None = None) -> DataFrame:
    """Keys of the records that stand in for content, or with ``keep_real`` the rows without them."""
    model = df.sparkSession.sparkContext.broadcast(fit(df, text, seeds))
    if keep_real:
        at, schema = df.columns.index(text), df.schema

        def drop(batches):
            m = model.value
            for b in batches:
                yield b.filter(pa.array([not stands_in(m, t) for t in b.column(at).to_pylist()], pa.bool_()))

        return df.mapInArrow(drop, schema)

    def run(batches):
        m = model.value
        for b in batches:
            ok = pa.array([stands_in(m, t) for t in b.column(1).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok)], names=["key"])

    rows = df.select(df[key].alias("key"), df[text].alias("t")).where("key is not null and t is not null")
    return rows.mapInArrow(run, rows.select("key").schema).distinct()
