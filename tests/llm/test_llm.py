import math
import random
import unicodedata
from collections import defaultdict

import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from folium.functions.codepoints import TOKEN_PATTERN
from folium.llm import binpack, entity_splits, linkgroups, lookalike, markup, mixing, neardup, qa_defects, split_items, standins

TOKENS = regex.compile(TOKEN_PATTERN)


def roots(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


# ---- 1


@pytest.mark.parametrize(
    "text,clean",
    [
        ("## Alertas\n\nEl campo", "Alertas\n\nEl campo"),
        ("#Base de datos\n\nx", "Base de datos\n\nx"),
        ("Title\n=====\nbody", "Title\nbody"),
        ("a **b c** and *d* and ~~e~~ __f__ ***g***", "a b c and d and e f g"),
        ("see [the docs](../a/b.md) or [here][1]\n\n[1]: /x \"y\"", "see the docs or here"),
        ("![Alt](img/x.png)\ntext[^1]\n\n[^1]: note", "Alt\ntext\n\n1. note"),
        ("use `stock_id` now", "use stock_id now"),
        ("```json\n{&#34;a&#34;: 1}\n```", '{"a": 1}'),
        ("- [x] done\n> quoted", "- done\nquoted"),
        ("| A | B |\n|---|:-:|\n| 1 | 2 |", "A\tB\n1\t2"),
        ("||A||B||\n|1| |", "A\tB\n1\t"),
        ('{| class="w"\n! A !! B\n|-\n| 1 || 2\n|}', "A\tB\n1\t2"),
        ("== Límites ==\nx", "Límites\nx"),
        ("h2. Head\nx", "Head\nx"),
        ("a [[Page|word]] b [[Category:X]]", "a word b"),
        ("'''bold''' and ''it''", "bold and it"),
        ("{{Note|floor=53|texto=Use {stock_id} now.}}", "Use {stock_id} now."),
        ("{code:java}\nint a;\n{code}", "int a;"),
        ("x $\\sqrt{z^2 + 4}$ y", "x √(z^2 + 4) y"),
        ("\\[ \\frac{p}{q} \\]", "(p)/(q)"),
        ("\\section{Top}\n\\begin{itemize}\n  \\item a\n\\end{itemize}", "Top\n\n- a"),
        ("cost~\\cite{a1}. \\textbf{b}", "cost. b"),
        ("<ul class='x'><li>a</li><li>b</ul>", "- a\n- b"),
        ("<table border=1>\n<tr><td>a</td><td></td><td>b</td></tr></table>", "a\t\tb"),
        ("R&D &mdash; x &lt; y&nbsp;z", "R&D — x < y\xa0z"),
        ("<p>Map<String, Long> & R&D</p><!-- no -->", "Map<String, Long> & R&D"),
        ("<pre><code class='l'>List&lt;A&gt; x;</code></pre>", "List<A> x;"),
        ("***\n\nafter", "after"),
    ],
)
def test_markup_is_converted(text, clean):
    out, kinds = markup.convert(text)
    assert kinds and out == clean


@pytest.mark.parametrize(
    "text",
    [
        "- a\n- b\n1. c", "A\tB\n1\t2", "Field: x; Type: y", "public List<Offer> f(long id) {\n    Map<String, Long> a = b.c(1);\n}", "LIST<OFFER> F()", "# dock state\nexport A=${B:-3}",
        "GET /v1/{id}/x [optional] TODO list", "from $30 to $142 per R&D unit", "stock < 53 and demand > 89, case #5237", "runs 0 5 * * * daily", "2 * 7 * 7 in C:\\jobs\\slot.",
        "def f(a, **kwargs):\n    return a", "Hi __________, {{ name }} <%= x %> ${A} @@B@@ <stock-depth-type>", "it's a 'quoted' word", "SELECT a FROM b WHERE c = '' AND d = ''", "", "plain text.",
    ],
)
def test_other_text_is_left_alone(text):
    assert markup.convert(text) == (text, [])


def test_markup_votes_and_edges(spark):
    nav = '<div class="menu7"><a href="x">one</a> <a href="y">two</a></div><p>Real text, with marks.</p>'
    rows = [("h", f"k{i}", nav, "z") for i in range(6)] + [("g", "k9", nav, "z"), (None, "k10", nav, "z"), ("h", "k11", None, "z"), ("h", None, "", "z")]
    df = spark.createDataFrame(rows, "host string, key string, text string, clean_text string")
    got = {r["key"]: r for r in markup.clean(df, ["key"], F.col("host")).collect()}
    assert got["k0"]["clean_text"] == "Real text, with marks."  # six pages of the host agree on the menu
    assert "one two" in got["k9"]["clean_text"] and "one two" in got["k10"]["clean_text"]
    assert got["k11"]["clean_text"] is None and got["k11"]["kinds"] == [] and got[None]["clean_text"] == ""
    assert markup.clean(df.limit(0), ["key"], F.col("host")).count() == 0


def test_winning_paths_inside_losing_ones(spark):
    links = "".join(f'<a href="{i}">entry {i}</a> ' for i in range(12))
    page = f'<div class="shell">{links}<div class="main"><p>The text, with marks.<p>And more, of it.</div><div class="menu">{links}</div></div>'
    rows = [("h", f"k{i}", page) for i in range(6)] + [("few", f"f{i}", page) for i in range(4)] + [("text", f"t{i}", f"<div>Title</div><p>Only text {i}.</p>") for i in range(6)]
    got = {r["key"]: r["clean_text"] for r in markup.clean(spark.createDataFrame(rows, "host string, key string, text string"), ["key"], F.col("host")).collect()}
    assert got["k0"] == "The text, with marks.\nAnd more, of it."  # the shell and the menu lose, the main part wins
    assert "entry 3" in got["f0"] and got["t1"] == "Title\nOnly text 1."  # too few pages, and nothing that loses: the whole page
    outcome = {r["host"]: r["outcome"] for r in markup.vote_paths(spark.createDataFrame(rows, "host string, key string, text string"), "host", "text").collect()}
    assert outcome == {"h": {"div.shell": False, "div.shell>div.main>p": True, "div.shell>div.menu": False}}


def test_end_tags_close_their_own_container():
    page = "".join(f'<div class="c{chr(97 + i)}">' for i in range(8)) + "deep" + "</div>" * 3 + "<p>next</p></span></section>" + "</div>" * 5 + "<p>last</p>"
    paths = list(markup.container_scores(page))
    assert paths[-2].endswith("div.ce>p") and paths[-1] == "p" and paths[-2].count(">") == 5


def test_long_headings_and_deep_formulas():
    title = "word " * 60 + "end"
    assert markup.convert(f"{title}\n=====\nbody") == (f"{title}\nbody", ["heading"])
    tex = "x"
    for _ in range(7):
        tex = rf"\frac{{{tex}}}{{y}}"
    assert "frac" not in markup.convert(rf"a $${tex}$$ b")[0]


def test_deep_containers_vote(spark):
    for depth in (8, 300):
        deep = "<div>" * depth + '<div class="menu"><a href="x">one</a> <a href="y">two</a></div>' + "Real text, with marks." + "</div>" * depth
        df = spark.createDataFrame([("h", f"k{i}", deep) for i in range(6)], "host string, key string, text string")
        assert {r["clean_text"] for r in markup.clean(df, ["key"], F.col("host")).collect()} == {"Real text, with marks."}
    assert max(map(len, markup.container_scores("<div class='abc'>" * 3000 + "x"))) <= markup.LONG_PATH


# ---- 2


def test_link_groups_against_union_find(spark):
    rng = random.Random(8)
    pairs = [(f"p{rng.randint(0, 150):03d}", f"p{rng.randint(0, 150):03d}") for _ in range(110)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)]
    pairs += [("hub", f"s{i}") for i in range(60)] + pairs[:10] + [(b, a) for a, b in pairs[:10]] + [("self", "self")]
    rows = [(a, b, "x") for a, b in pairs] + [(None, "p000", "x"), ("p001", "", "x")]
    out = linkgroups.link_groups(spark.createDataFrame(rows, "a string, b string, node string"), "a", "b").collect()
    assert {r["node"]: r["group"] for r in out} == roots(pairs) and len(out) == len(roots(pairs))
    assert linkgroups.link_groups(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_hubs_are_split_alike(spark, monkeypatch):
    from functools import partial

    from folium import runtime

    hub = [("hub", f"s{i}") for i in range(120)] + [(f"s{i}", f"t{i}") for i in range(0, 120, 3)] + [("x", "y")]
    split = partial(runtime.join_unique, hot_rows=20)
    monkeypatch.setattr(linkgroups, "join_unique", split)
    monkeypatch.setattr(entity_splits, "join_unique", split)
    out = linkgroups.link_groups(spark.createDataFrame(hub, "a string, b string"), "a", "b").collect()
    assert {r["node"]: r["group"] for r in out} == roots(hub)
    rows = spark.createDataFrame([(f"r{i}", "hot", f"own{i}") for i in range(90)] + [("z", None, "own0"), ("w", "cold", None)], "id string, a string, b string")
    got = {r["record"]: r["component"] for r in entity_splits.entity_components(rows, "id", {"a": F.col("a"), "b": F.col("b")}).collect()}
    assert len(got) == 92 and len({got[f"r{i}"] for i in range(90)} | {got["z"]}) == 1 and got["w"] != got["z"]


# ---- 3


def test_pieces_respect_limits_and_join_back(spark):
    rng = random.Random(3)
    words = ["casa", "perro.", "sol,", "luz\n", "mar\n\n", "a_b", "ñu!", "x"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 5, 90, 130, 400, 3000)] + ["z" * 5000, "?" * 999, "", None, "b " * 100]
    df = spark.createDataFrame([(i, t, "p", 7) for i, t in enumerate(texts)], "id int, text string, section_path string, piece int")
    got = defaultdict(list)
    for r in split_items.split_items(df, "id", "text", limit=100, overlap=15, carry=("section_path",)).collect():
        got[r["id"]].append(r)
    assert 9 not in got
    for i, t in enumerate(texts):
        if t is None:
            continue
        ps = sorted(got[i], key=lambda r: r["piece"])
        assert "".join(t[r["core_start"] : r["char_end"]] for r in ps) == t
        assert (len(ps) > 1) == (len(TOKENS.findall(t)) > 100)
        for k, r in enumerate(ps):
            assert r["text"] == t[r["char_start"] : r["char_end"]] and r["n_pieces"] == len(ps) and r["section_path"] == "p"
            assert r["n_tokens"] == len(TOKENS.findall(r["text"])) <= 100
            assert r["overlap_tokens"] == (15 if k else 0) == len(TOKENS.findall(t[r["char_start"] : r["core_start"]]))
    with pytest.raises(ValueError):
        split_items.split_items(df, "id", "text", limit=100, overlap=30)
    assert split_items.split_items(df.limit(0), "id", "text").count() == 0


def test_strongest_boundary_wins(spark):
    t = "a " * 60 + "b.\n\n" + "c " * 70
    df = spark.createDataFrame([("x", t)], "id string, text string")
    second = [r for r in split_items.split_items(df, "id", "text", limit=100, overlap=10).collect() if r["piece"] == 1]
    assert t[second[0]["core_start"] :].startswith("c ")


# ---- 4


def test_entity_components_and_shares(spark):
    rng = random.Random(6)
    rows = [(f"r{i}", f"a{rng.randint(0, 90)}" if rng.random() < 0.8 else None, f"b{rng.randint(0, 120)}" if rng.random() < 0.6 else None) for i in range(160)]
    rows += [(f"hot{i}", "A", f"h{i % 3}") for i in range(50)] + [("twice", "a1", None), ("twice", "a2", None), (None, "a1", None)]
    df = spark.createDataFrame(rows, "id string, a string, b string").withColumn("component", F.lit("clash"))
    out = entity_splits.entity_components(df, "id", {"a": F.col("a"), "b": F.col("b")}).collect()
    got = {r["record"]: r["component"] for r in out}
    assert len(out) == len(got)
    links = [(("r", r), ("a", a)) for r, a, _ in rows if r and a] + [(("r", r), ("b", b)) for r, _, b in rows if r and b]
    want = roots(links)
    by_root = defaultdict(set)
    for r, _, _ in rows:
        if r:
            by_root[want.get(("r", r), r)].add(r)
    by_component = defaultdict(set)
    for r, c in got.items():
        by_component[c].add(r)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_component.values()))
    many = spark.range(20000).select(F.col("id").cast("string").alias("record"), F.col("id").cast("string").alias("component"))
    n = {r["split"]: r["count"] / 20000 for r in entity_splits.assign(many, {"train": 0.6, "val": 0.2, "test": 0.2}).groupBy("split").count().collect()}
    assert abs(n["train"] - 0.6) < 0.02 and abs(n["val"] - 0.2) < 0.02 and abs(n["test"] - 0.2) < 0.02
    assert entity_splits.entity_components(df.limit(0), "id", {"a": F.col("a")}).count() == 0


def test_reached_shares_of_splits(spark):
    many = spark.range(4000).select(F.col("id").cast("string").alias("record"), (F.col("id") % 1000).cast("string").alias("component"))
    got = {r["split"]: r for r in entity_splits.reached_shares(entity_splits.assign(many, {"train": 3, "val": 1, "test": 1}), {"train": 3, "val": 1, "test": 1, "none": 0}).collect()}
    assert sum(r["records"] for r in got.values()) == 4000 and abs(sum(r["reached_share"] for r in got.values()) - 1) < 1e-9
    assert got["train"]["target_share"] == 0.6 and abs(got["train"]["reached_share"] - 0.6) < 0.05 and got["none"]["records"] == 0


def test_split_names_and_pages(spark):
    df = spark.createDataFrame([(" Train ", "docs_raw/p/v/a/b.md"), ("VALIDATION", "x/y"), ("test\n", None), ("", "docs_raw/p/v2/a/b.md"), (None, "a")], "s string, d string")
    out = [(r[0], r[1]) for r in df.select(entity_splits.split_name(F.col("s")), entity_splits.page_entity(F.col("d"))).collect()]
    assert out == [("train", "p/a/b.md"), ("val", None), ("test", None), (None, "p/a/b.md"), (None, None)]


# ---- 5

REAL = ["El servicio de precios archiva los pedidos y publica la lista de cambios.", "The job runs every 5 minutes and compares the current rates.", "Sí.", "string", "v2.7", "Default: 46", "stock_id",
        "El endpoint devuelve 404 Not Found cuando la firma no coincide con el pedido.", "When JavaScript is disabled in the browser, the public API for the catalog publishes the rates."]
STAND_IN = ["TO DO.", "Coming soon", "Alertas\n\nPendiente", "404 Not Found\nLa página solicitada no existe o fue movida.\nRequest ID: 12ab34cd56ef", "Please enable JavaScript to view this page.", "foo bar foo bar foo bar foo bar!",
            "Para consultar ${A_B} llame a %C_D% con el token XXXX.", "Lorem ipsum dolor sit amet. Dolor amet lorem.", "Cargando, espere un momento... [3]", "Error 503: Sesión expirada. Inicie sesión para continuar."]


def test_stand_ins_are_found(spark):
    rng = random.Random(1)
    actors, verbs, things = ["el servicio", "la cola", "the module", "the job", "el campo"], ["archiva", "publica", "compares", "rejects", "guarda"], ["los pedidos", "las tarifas", "the rates", "the orders", "el costo"]
    rows = [(f"n{i}", " ".join(f"{rng.choice(actors)} {rng.choice(verbs)} {rng.choice(things)} cada {rng.randint(1, 99)} minutos." for _ in range(5)), 1) for i in range(400)]
    rows += [(f"r{i}-{k}", t, 1) for i, t in enumerate(REAL) for k in range(25)] + [(f"s{i}", t, 1) for i, t in enumerate(STAND_IN)]
    rows += [("null", None, 1), ("blank", "  \n", 1), ("s0", STAND_IN[0], 1), (None, STAND_IN[0], 1), ("mixed", STAND_IN[4] + "\n\n" + rows[0][1], 1)]
    df = spark.createDataFrame(rows, "id string, text string, key int")
    assert sorted(r["key"] for r in standins.find(df).collect()) == sorted(f"s{i}" for i in range(len(STAND_IN)))
    kept = standins.find(df, keep_real=True)
    assert kept.columns == df.columns and kept.count() == len(rows) - len(STAND_IN) - 2
    assert standins.find(df.limit(0)).count() == 0


def test_odds_do_not_move_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(standins, "UNLABELLED", 4000)
    monkeypatch.setattr(standins, "RECORDS", 1000, raising=False)  # a quarter, as it was

    def fitted(n):
        rng = random.Random(n)
        words = [a + b for a in ("alfa", "beta", "gama", "delta", "iota") for b in ("ro", "ta", "mi", "su")]
        rows = [(" ".join(rng.choice(words) for _ in range(8)),) for _ in range(n)] + [(rng.choice(["Coming soon", "404 Not Found"]),) for _ in range(n // 10)]
        return standins.fit(spark.createDataFrame(rows, "text string"))

    small, large = fitted(900), fitted(18_000)
    for f in ("coming", "found", "alfaro", "sumi", "deltata"):
        assert abs(small.odds.get(f, 0) - large.odds.get(f, 0)) < 0.3, f
    for text in ("Coming soon", "404 Not Found", "alfaro betata"):
        assert abs(small.score(standins.normal(text)) - large.score(standins.normal(text))) < 0.8


def all_seeds():
    return [p for group in standins.SEEDS.values() for p in group]


def test_whole_passages_and_records_are_fitted(spark):
    start = "el servicio de precios archiva los pedidos " * 12
    rows = [(start + "alfa",), (start + "betaterm",), ("Coming soon",)]
    assert "betaterm" in standins.fit(spark.createDataFrame(rows, "text string")).odds
    real = " ".join(f"palabra{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    trusted = standins.Seeds(all_seeds()).trusted
    assert len(real) > 700 and trusted(real + " etcetera " * 6 + ". " + "Lorem ipsum dolor sit amet. " * 8) and not trusted(real + " etcetera " * 6)
    for unit in ("404 Not Found. ", "texto de ejemplo, "):  # a record as long as a book is judged whole
        assert trusted(unit * 3000) and not trusted(unit + real * 500)


def stand_in_table(seed=1):
    """Real chunks, and stand-ins made of parts that go together in many ways."""
    rng = random.Random(seed)
    actors, verbs, things = ["el servicio", "la cola", "the module", "the job", "el campo"], ["archiva", "publica", "compares", "rejects", "guarda"], ["los pedidos", "las tarifas", "the rates", "the orders", "el costo"]
    rows = [(f"n{i}", " ".join(f"{rng.choice(actors)} {rng.choice(verbs)} {rng.choice(things)} cada {rng.randint(1, 99)} minutos." for _ in range(5))) for i in range(1500)]
    status = ["404 Not Found", "502 Bad Gateway", "503 Service Unavailable", "Error 500:", "Oops!"]
    what = ["La página solicitada no existe o fue movida.", "The requested page does not exist or was moved.", "Something went wrong on our side. Please try again later.", "Ocurrió un error inesperado. Intente de nuevo más tarde.",
            "Su sesión ha expirado. Inicie sesión para continuar.", "El servidor no respondió a tiempo. Intente de nuevo más tarde."]
    tail = ["", " Request ID: 12ab34", " (ref. 77)"]
    notice = ["Please enable JavaScript to {}.", "Habilite JavaScript para {}.", "Scripts are turned off: turn them on to {}.", "Active las cookies para {}.", "Your browser is not supported. Upgrade it to {}."]
    goal = ["continue", "continuar", "view this page", "ver esta página", "access this site"]
    rows += [(f"s{i}", rng.choice(status) + "\n" + rng.choice(what) + rng.choice(tail)) for i in range(60)]
    rows += [(f"s{60 + i}", rng.choice(notice).format(rng.choice(goal))) for i in range(40)]
    rows += [(f"s{100 + i}", f"Hola {{{{a{i}}}}}, describa aquí el propósito de ${{B_{i}}}.") for i in range(10)]
    return rows


def test_the_model_finds_what_withheld_phrases_would(spark):
    rows = stand_in_table()
    short = ["Please restart the billing worker after a deploy.", "Esta página describe el flujo de alta.", "The queue rejects late orders.", "Ver README.", "El campo guarda el costo."]
    df = spark.createDataFrame(rows + [(f"r{i}", t) for i, t in enumerate(short)], "id string, text string")
    wanted = {i for i, _ in rows if i[0] == "s"}
    for seeds in (None, all_seeds()[::2], all_seeds()[1::2]):
        got = {r["key"] for r in standins.find(df, seeds=seeds).collect()}
        assert got <= wanted and len(got) >= 0.9 * len(wanted), (len(got), got - wanted)
    known = standins.Seeds(all_seeds()[::2])
    assert sum(not known.trusted(t) for i, t in rows if i in wanted) > 10  # so the rest came from the model


def test_copies_of_a_table_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(standins, "RECORDS", 800)
    rows = stand_in_table()
    one = spark.createDataFrame(rows, "id string, text string")
    many = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40))))
    a, b = standins.fit(one), standins.fit(many)
    assert a.odds.keys() == b.odds.keys() and max(abs(a.odds[f] - b.odds[f]) for f in a.odds) < 1e-6 and abs(a.prior - b.prior) < 1e-6
    seeds = all_seeds()[::2]
    assert {r["key"] for r in standins.find(one, seeds=seeds).collect()} == {r["key"] for r in standins.find(many, seeds=seeds).collect()}


# ---- 6


def shingles(text, width):
    t = TOKENS.findall(text.lower())
    return set(zip(*[t[k:] for k in range(width)]))


def near_table(n, seed=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 120))]
        rows.append((f"d{i}", " ".join(base), "prose"))
        for k in range(rng.randint(0, 3)):
            words = list(base)
            for _ in range(rng.randint(1, 9)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
            rows.append((f"d{i}x{k}", " ".join(words), "prose" if rng.random() < 0.9 else "code"))
    rows += [("up", rows[0][1].upper(), "prose"), ("sp", rows[0][1].replace(" ", "  "), "prose"), ("short", "a b c", "prose"), ("null", None, "prose"), ("kind", rows[0][1], None), (None, rows[0][1], "prose"), rows[1]]
    return rows


@pytest.mark.parametrize("hot,word", [(neardup.HOT, 4), (2, 4), (neardup.HOT, 6)])
def test_near_pairs_against_brute_force(spark, monkeypatch, hot, word):
    monkeypatch.setattr(neardup, "HOT", hot)
    if word > 4:
        monkeypatch.setattr(neardup, "BACKGROUND", 0.2)  # as if the table were far larger
    rows = near_table(40)
    df = spark.createDataFrame(rows, "id string, text string, kind string").withColumn("cid", F.lit(1))
    near = neardup.NearDuplicates(df, "id", "text", "kind", shingle=3, threshold=0.6, min_tokens=50)
    got = {(r["id_a"], r["id_b"]) for r in near.id_pairs().collect()}
    sets = {(i, k, neardup.normal_text(t)): shingles(t, 3) for i, t, k in rows if i and t and k and len(TOKENS.findall(t)) >= 50}
    items = sorted(sets.items())
    want = set()
    for a, ((ia, ka, na), sa) in enumerate(items):
        for (ib, kb, nb), sb in items[a + 1 :]:
            if ia != ib and ka == kb and na != nb and len(sa & sb) >= 0.6 * len(sa | sb):
                want.add((min(ia, ib), max(ia, ib)))
    assert len(want) > 20 and got == want


def test_copies_with_other_tokens_keep_their_own_shingles(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(60)]
    plain, odd = " ".join(base), "\xa0".join(base)  # a no-break space is a token, so the second has others
    edited = "\xa0".join([*base[:30], "edit", *base[31:]])
    df = spark.createDataFrame([("a", plain, "p"), ("b", odd, "p"), ("c", edited, "p")], "id string, text string, kind string")
    near = neardup.NearDuplicates(df, "id", "text", "kind", shingle=3, threshold=0.6)
    sets = {i: shingles(t, 3) for i, t in (("a", plain), ("b", odd), ("c", edited))}
    want = {(x, y) for x, y in (("a", "c"), ("b", "c")) if len(sets[x] & sets[y]) >= 0.6 * len(sets[x] | sets[y])}
    assert {(r["id_a"], r["id_b"]) for r in near.id_pairs().collect()} == want == {("b", "c")}  # a and b are copies and no pair
    from folium.llm import queries

    assert len({r["group_id"] for r in queries.near_groups(near).collect()}) == 1


def test_words_grow_with_the_table(spark):
    for n in (10, 10**6, 10**8, 10**10):
        for j in (0.6, 0.8):
            word, tables = neardup.plan(n, j)
            assert (1 - j**word - word * j ** (word - 1) * (1 - j)) ** tables <= neardup.MISS
            assert n * tables * word * neardup.BACKGROUND ** (word - 1) <= neardup.CHANCE_MEETINGS
    assert neardup.plan(10**6, 0.6) == (4, 12) and neardup.plan(10**9, 0.6)[0] > 4


def test_hot_anchor_stream_is_bounded(monkeypatch):
    import numpy as np

    monkeypatch.setattr(neardup, "HOT", 50)
    n = 1000
    anchor = np.sort(np.concatenate([np.full(n, 7), np.arange(100, 140)])).astype(np.int64)
    cid = np.arange(len(anchor), dtype=np.int64)
    zero = np.zeros(len(anchor), np.int64)
    cols = [anchor, cid, zero.astype(np.int32), zero, zero]
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + 64]) for x in cols], names=["anchor", "cid", "size", "f0", "f1"]) for i in range(0, len(anchor), 64)]
    out = list(neardup._compare_sorted(10, 5, hold=128)(iter(batches)))
    hot = [c for b in out for c, a in zip(b.column("a").to_pylist(), b.column("anchor").to_pylist()) if a == 7]
    assert sorted(hot) == list(range(n))  # every member of the hot run is passed on, none twice


def test_near_empty_table(spark):
    df = spark.createDataFrame([], "id string, text string, kind string")
    assert neardup.NearDuplicates(df, "id", "text", "kind").id_pairs().count() == 0


def test_every_compared_record_has_a_group(spark, tmp_path):
    from folium.llm import queries

    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    copied, base, alone = ([rng.choice(words) for _ in range(80)] for _ in range(3))
    edited = [*base[:40], "edit", *base[41:]]
    rows = [(f"c{i}", " ".join(copied), "prose") for i in range(30)] + [("b0", " ".join(base), "prose"), ("b1", " ".join(base), "prose"), ("e", " ".join(edited), "prose")]
    rows += [("u", " ".join(alone), "prose"), ("k", " ".join(copied), "code"), ("short", "a b c", "prose"), ("spec", " ".join(base), "api_spec"), ("null", None, "prose"), rows[0]]
    spark.createDataFrame(rows, "id string, text string, content_type string").write.parquet(f"{tmp_path}/corpus_row.parquet")
    out = queries.p6_groups(spark, str(tmp_path)).collect()
    got = {r["id"]: (r["class_id"], r["group_id"], r["n_links"]) for r in out}
    assert len(out) == len(got) == 35 and set(got) == {i for i, _, _ in rows} - {"short", "spec", "null"}
    assert len({got[f"c{i}"] for i in range(30)}) == 1  # copies without a variant are one class and group
    assert all(got[i][1:] == (str(got[i][0]), 0) for i in ("c0", "u", "k")) and len({got[i][1] for i in ("c0", "u", "k", "e")}) == 4
    assert got["b0"] == got["b1"] and got["b0"][0] != got["e"][0] and got["b0"][1:] == got["e"][1:] and got["e"][2] == 1


# ---- 7

GOOD = [("¿Qué conserva el campo a_b?", "El campo a_b conserva las tarifas vigentes una vez por semana.", "El campo a_b de la cola conserva las tarifas vigentes una vez por semana."),
        ("What does the job x_y do?", "It runs every 5 minutes and compares the current rates once a week", "The job x_y runs every 5 minutes and compares the current rates once a week."),
        ("¿Cada cuánto corre el job x_y?", "Cada 5 minutos", "El job x_y corre cada 5 minutos y compara las tarifas."), ("¿Puede la cola procesar el costo?", "No.", "La cola no puede procesar el costo."),
        ("What is the default value of z_k?", "null", "The parameter z_k is null by default.")]


def test_pair_defects(spark):
    rows = [(f"g{i}-{k}", f"{q} ({k})", a.replace("5", str(k + 1)) + ("." if k % 3 and a.endswith("week") else ""), e.replace("5", str(k + 1))) for i, (q, a, e) in enumerate(GOOD) for k in range(60)]
    q, _, e = GOOD[0]
    eq, ea, ee = GOOD[1]
    bad = {
        "e1": (q, None, e, "empty"), "e2": (q, " \u200b\xa0", e, "empty"), "e3": (q, "N/A", e, "empty"), "e4": (q, "<br>", e, "empty"), "e5": (q, "Respuesta:", e, "empty"), "e6": (eq, "nan", ee, "empty"),
        "c1": (q, q.upper(), e, "copies_question"), "c2": (q, f"{q} {q}", e, "copies_question"), "c3": (eq, f"The question is: {eq}", ee, "copies_question"),
        "r1": (q, "Lo siento, pero no me es posible ayudar con esa solicitud.", e, "refusal"), "r2": (eq, "As an assistant, I don't have enough information to answer.", ee, "refusal"),
        "o1": (q, "The field a_b keeps the current rates once a week.", e, "other_language"), "o2": (eq, "Corre cada 5 minutos y compara las tarifas vigentes una vez por semana.", ee, "other_language"),
        "t1": (q, "El campo a_b conserva las tarifas vig", e, "truncated"), "t2": (eq, "It runs every 5 minutes and compares the", ee, "truncated"), "t3": (q, "El campo a_b conserva las…", e, "truncated"),
    }
    rows += [(i, *v[:3]) for i, v in bad.items()] + [("ok", f"{q}", f"{q} El campo a_b conserva las tarifas vigentes una vez por semana.", e), ("noq", None, GOOD[0][1], None), ("e1", q, None, e), (None, q, None, e)]
    df = spark.createDataFrame(rows, "id string, question string, answer string, evidence_span string").withColumn("defect", F.lit("clash"))
    out = qa_defects.find_defects(df).collect()
    assert {r["id"]: r["defect"] for r in out} == {i: v[3] for i, v in bad.items()} and len(out) == len(bad)
    assert qa_defects.find_defects(df.limit(0)).count() == 0


def test_pair_models_are_fitted_on_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(qa_defects, "SAMPLE", 20, raising=False)  # as it was
    words = ["alfaro", "betuna", "gamiso", "deltor", "iotema", "kapuli", "lambir", "muzeco", "nuvapo", "omirga", "pirodo", "sigmel", "taurin", "upsilo", "fitona", "zetamu"]
    question = "¿Qué guarda el campo {} de la cola?"
    full = [(f"f{w}{i}", question.format(w), f"El campo {w} conserva siempre todas las {w[::-1]} de la tabla {x}", None) for w in words for i, x in enumerate(words)]
    cut = [(f"c{w}", question.format(w), f"El campo {w} conserva siempre todas las {w[:1:-1]}", None) for w in words]
    df = spark.createDataFrame(full + cut, "id string, question string, answer string, evidence_span string")
    assert {(r["id"], r["defect"]) for r in qa_defects.find_defects(df).collect()} == {(r[0], "truncated") for r in cut}
    pairs = df.selectExpr("question q", "answer a", "evidence_span e")
    models = qa_defects.fit(pairs.union(pairs))
    every = qa_defects.EndModel([(qa_defects.shape(r[2]), False) for r in full + cut])
    assert models.ends.open == every.open and all(models.ends.likelihood(t) == every.likelihood(t) for t in every.open)


def refusals():
    answers = [a for _, a, _ in GOOD for _ in range(40)]
    answers += [f"{x} {y}" for x in ("Lo siento, pero", "Sorry,", "Lamentablemente,", "Sinto muito,") for y in ("no puedo ayudar con esa solicitud.", "I cannot answer this question.", "no tengo información para responder.", "não posso responder a essa pergunta.") for _ in range(3)]
    return qa_defects.refusal_model(answers)


def test_refusal_after_a_lead_in():
    q, a, e = GOOD[0]
    model = refusals()
    for t in ("Gracias por su consulta. No puedo ayudar con esa solicitud.", "Thank you for asking. I cannot answer that. Let me know if you need anything else."):
        assert qa_defects.is_refusal(model, q, t, e) and qa_defects.is_refusal(model, q, t, ""), t
    for t in (f"{a} No puedo ayudar.", "Son 57 horas. No puedo ayudar.", a, e):
        assert not qa_defects.is_refusal(model, q, t, e) and not qa_defects.is_refusal(model, q, t, ""), t


def test_refusals_no_phrase_lists():
    model = refusals()
    for t in ("No tengo información para responder a esa solicitud.", "Lamentablemente, no tengo esa información.", "I answer no question.", "Não tenho como responder a essa pergunta."):
        assert not qa_defects.REFUSAL_SEEDS.search(t) and qa_defects.is_refusal(model, GOOD[0][0], t, GOOD[0][2]), t
    for t in ("La cola no puede procesar el costo.", "The queue cannot process the costs.", "No.", "A fila não pode processar o custo."):
        assert not qa_defects.is_refusal(model, GOOD[0][0], t, GOOD[0][2]), t


def test_ends_of_texts():
    nouns = ["las tarifas", "los costos", "los pedidos", "las rutas", "los lotes"]
    full = [f"El campo a_{i} conserva {n} una vez por semana{'.' if i % 2 else ''}" for i in range(30) for n in nouns]
    short = [n.capitalize() for n in nouns for _ in range(6)] + ["Cada 5 minutos", "No", "true", "OPEN, DONE y LOST"] * 15
    cut = ["El campo a_1 conserva las", "El campo b_2 conserva", "El campo c_3 conserva los costos una vez por"] * 2
    model = qa_defects.EndModel([(qa_defects.shape(t), qa_defects.is_closed(t)) for t in full + short + cut])
    for t in (*cut, "El campo z_9 conserva las rut", "OPEN, DONE y", "El campo conserva: (", "El campo conserva los...", "Los costos una vez por"):
        assert qa_defects.is_truncated(model, t, ""), t
    for t in (*full[:4], *short[::6], "El campo z_9 conserva los lotes una vez por semana", "No", "5 minutos."):
        assert not qa_defects.is_truncated(model, t, ""), t
    evidence = "El campo y conserva las cuotas vigentes."
    assert qa_defects.is_truncated(model, "Las cuotas vig", evidence) and not qa_defects.is_truncated(model, "Las cuotas vigentes", evidence)


# ---- 8


def test_containers(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([0, 1, 5, 30, 60, 99, 100, 101, 250, 400]) if rng.random() < 0.9 else rng.randint(1, 100), rng.choice("abcdefgh") if rng.random() < 0.9 else None, f"c{rng.randint(0, 40)}" if rng.random() < 0.5 else None) for i in range(900)]
    rows += [(1000 + i, 30, "a", "same") for i in range(200)] + [(2000, None, None, None), (None, 5, "a", "b"), (5, rows[5][1], rows[5][2], rows[5][3])]
    df = spark.createDataFrame(rows, "k long, n long, s string, c string").withColumn("container", F.lit("clash"))
    out = binpack.pack(df, "k", "n", 100, "s", "c", max_sources=3, block_items=400).collect()
    size = {r[0]: r[1] or 0 for r in rows if r[0] is not None}
    meta = {r[0]: (r[2], r[3]) for r in rows if r[0] is not None}
    by_key, bins = defaultdict(list), defaultdict(list)
    for r in out:
        by_key[r["key"]].append(r)
        bins[r["container"]].append(r)
    assert set(by_key) == set(size)
    for k, ps in by_key.items():
        assert sum(p["size"] for p in ps) == size[k] and len(ps) == max(1, math.ceil(size[k] / 100)) == ps[0]["n_pieces"]
        assert sorted(p["piece"] for p in ps) == list(range(len(ps)))
    for ps in bins.values():
        assert sum(p["size"] for p in ps) == ps[0]["used"] <= 100 and sorted(p["position"] for p in ps) == list(range(len(ps)))
        assert len({meta[p["key"]][0] for p in ps} - {None}) <= 3
        clusters = [meta[p["key"]][1] for p in ps if meta[p["key"]][1]]
        assert len(clusters) == len(set(clusters))
    free = spark.createDataFrame([(i, rng.randint(1, 50)) for i in range(2000)], "k long, n long")
    got = binpack.pack(free, "k", "n", 100).select("container", "used").distinct().collect()
    assert sum(r["used"] for r in got) / (100 * len(got)) > 0.97
    assert binpack.pack(free.limit(0), "k", "n", 100).count() == 0


# ---- 9


def test_mixture_reaches_its_shares(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["big"] * 8 + ["Mid", " mid "] + ["small"]), rng.randint(20, 300)) for i in range(6000)] + [(9001, None, 50), (9002, "other", 50), (9003, "big", None), (9004, "big", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").withColumn("slot", F.lit(1))
    targets = spark.createDataFrame([("big", 0.4, 1), ("mid", 0.4, 2), ("small", 0.15, 9), ("none", 0.05, 3)], "source string, target_share double, max_repeats int")
    out = mixing.mix(docs, targets, block_tokens=500)
    got = out.collect()
    seen = {(r["source"], r["repetition"], r["key"]) for r in got}
    assert len(seen) == len(got)
    caps = {"big": 1, "mid": 2, "small": 9}
    assert all(r["repetition"] < caps[r["source"]] for r in got)
    sizes = defaultdict(int)
    for _, s, n in rows:
        name = (s or "").strip().lower()
        if name in caps and n:
            sizes[name] += n
    want = mixing.allocate(dict(sizes), {"big": 0.4, "mid": 0.4, "small": 0.15}, caps, float(sum(sizes.values())))
    mass = sum(want.values())
    report = {r["source"]: r for r in mixing.reached_shares(out, docs, targets).collect()}
    for s in caps:
        assert abs(report[s]["reached_share"] - want[s] / mass) < 0.02
    assert report["none"]["reached_share"] == 0 and abs(sum(r["reached_share"] for r in report.values()) - 1) < 1e-9
    # every stretch of the mixture holds the sources in proportion
    half = max(r["slot"] for r in got) // 2
    first = sum(r["n_tokens"] for r in got if r["slot"] < half and r["source"] == "small") / sum(r["n_tokens"] for r in got if r["slot"] < half)
    assert abs(first - want["small"] / mass) < 0.03
    assert mixing.mix(docs.limit(0), targets).count() == 0


def test_mixture_of_very_many_sources(spark):
    n = 12_000
    targets = spark.range(n).select(F.concat(F.lit("s"), "id").alias("source"), F.lit(1.0 / n).alias("target_share"), F.lit(2).alias("max_repeats"))
    docs = spark.range(3 * n).select(F.col("id").alias("doc_id"), F.concat(F.lit("S"), F.col("id") % n).alias("source"), F.lit(40).alias("n_tokens"))
    out = mixing.mix(docs, targets, block_tokens=40)
    got = out.groupBy("source").agg(F.sum("n_tokens").alias("n")).agg(F.count("*").alias("sources"), F.max("n").alias("most")).first()
    assert got["sources"] > 0.99 * n and got["most"] <= 6 * 40


# ---- 10


def test_lookalike_forms(spark):
    same = [
        ["cafe\u0301 ﬁn", "café fin", "ｃａｆé\u2007ﬁｎ", "c\u200bafé\xa0f\u00adin", "\u0441\u0430f\u00e9 fin"],
        ["Москва и село", "Мocквa и ceлo"],
        ["ёлка й", "е\u0308лка и\u0306"],
        ["ΟΡΟΣ Ωμέγα", "OPOΣ Ωμέγα"],
        ["a\u0323\u0302b", "a\u0302\u0323b", "ậb"],
        ["vpui fog", "νρυι fog", "vpuı fоɡ", "vpսi fօg"],
        ["Ready - it's", "Ꭱeady − itʼs"],
    ]
    forms = [lookalike.canonical(pa.array(g)).to_pylist() for g in same]
    assert all(len(set(f)) == 1 for f in forms) and len({f[0] for f in forms}) == len(same)
    assert forms[0][0] == "café fin" and forms[1][0] == "Москва и село" and forms[2][0] == "ёлка й" and forms[4][0] == "ậb" and forms[5][0] == "vpui fog"
    for text in ["El niño comió ñandú, acción: 12 %.", "Привет, мир! Это село.", "日本語 テキスト 한국어", "Οι τιμές του έργου και της υπηρεσίας", "Հայերեն սեր ու ոսկի", "a\tb\nc", ""]:
        assert lookalike.canonical(pa.array([text])).to_pylist() == [text]
    assert lookalike.canonical(pa.array([None, "x"])).to_pylist() == [None, "x"]
    rng = random.Random(2)
    plain = "".join(chr(c) for c in rng.choices([*range(32, 127), *range(0xC0, 0x17F)], k=2000))
    assert lookalike.canonical(pa.array([unicodedata.normalize("NFD", plain)])) == lookalike.canonical(pa.array([plain]))


def test_lookalike_pairs(spark):
    rows = [(1, "casa"), (2, "cаsa"), (3, "casa"), (4, "Casa"), (5, "cása"), (6, "ｃasa"), (7, None), (8, ""), (9, "\u200b"), (2, "cаsa"), (None, "cаsa")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash"))
    got = {(r["a"], r["b"]) for r in lookalike.lookalike_pairs(df).collect()}
    assert got == {(1, 2), (2, 3), (1, 6), (3, 6), (2, 6), (8, 9)}
    assert lookalike.lookalike_pairs(df.limit(0)).count() == 0
    classes = {(r["key"], r["n_spellings"]) for r in lookalike.lookalike_classes(df).collect()}
    assert classes == {(1, 3), (2, 3), (3, 3), (6, 3), (4, 1), (5, 1), (8, 2), (9, 2)}
    assert lookalike.with_canonical_text(df.select("doc_id", "text")).where("doc_id = 6").first()["canonical_text"] == "casa"
