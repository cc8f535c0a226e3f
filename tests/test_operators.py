import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folium.operators import balance, components, duplicates, embeddings, packing, quality
from folium.operators.prefix import running_sum
from folium.plans import reports
from folium.runtime import Stage, join_bounded, join_unique, release, shared_dir


def test_mark_duplicates_points_at_first_in_order(spark):
    rows = [("b#0", "B", "b.md", 0), ("a#1", "Same text", "a.md", 1), ("c#0", "same  TEXT", "c.md", 0), ("a#0", "x", "a.md", 0)]
    df = spark.createDataFrame(rows, "id string, text string, path string, i int")
    out = {r["id"]: r["duplicate_of"] for r in duplicates.mark_duplicates(df, "id", "text", duplicates.order_key("path", "i")).collect()}
    assert out == {"b#0": None, "a#1": None, "c#0": "a#1", "a#0": None}


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, None), ("b", 2, None)], "k string, at int, v string")
    assert sorted((r["k"], r["at"], r["v"]) for r in duplicates.latest_rows(df, "k", "at").collect()) == [("a", 3, "y"), ("b", 2, None)]


def test_latest_rows_of_repeated_and_null_keys(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", None, "x"), ("b", None, "x"), ("c", 1, "x"), (None, 1, "x"), (None, 2, "y"), ("d", None, "x"), ("d", 5, "y")]
    out = [tuple(r) for r in duplicates.latest_rows(spark.createDataFrame(rows, "k string, at int, v string"), "k", "at").collect()]
    got = {k: [r[1:] for r in out if r[0] == k] for k in ("a", "b", "c", "d", None)}
    assert got["a"] in ([(1, "x")], [(1, "y")]) and got["b"] == [(None, "x")] and got["c"] == [(1, "x")] and got["d"] == [(5, "y")] and len(got[None]) == 2
    assert duplicates.latest_rows(spark.createDataFrame([], "k string, at int, v string"), "k", "at").count() == 0


def test_vector_pairs_both_ways_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 16))
    vectors = np.concatenate([base, base + 0.05 * rng.standard_normal((12, 16)), rng.standard_normal((20, 16))])
    rows = [(i, [float(x) for x in v], "p" if i % 2 else "q") for i, v in enumerate(vectors)] + [(99, [0.0] * 16, "p")]
    df = spark.createDataFrame(rows, "id long, v array<double>, kind string")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = {(i, j) for i in range(len(unit)) for j in range(i + 1, len(unit)) if i % 2 == j % 2 and unit[i] @ unit[j] >= 0.9}
    assert want
    got = {(r["id_a"], r["id_b"]) for r in duplicates.vector_pairs(df, "id", "v", "kind", 0.9, block=7).collect()}
    assert got == want
    hashed = {(r["id_a"], r["id_b"]) for r in duplicates.hashed_vector_pairs(df, "id", "v", "kind", 0.9, 16).collect()}
    assert hashed == want


def test_hashed_candidates_are_few_and_split(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((1500, 32))
    vectors = np.concatenate([base, base + 0.1 * rng.standard_normal((1500, 32))])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in v], "k") for i, v in enumerate(vectors)], "id long, v array<double>, kind string")
    bits, tables = duplicates.hash_plan(len(vectors), 0.9)
    met = duplicates.hashed_candidates(df, 32, bits, tables, 3)
    assert met.count() < 0.012 * len(vectors) ** 2 / 2  # vectors of so few dimensions meet more often than by chance
    monkeypatch.setattr(duplicates, "BUCKET", 3)  # buckets in blocks give the same candidates
    assert duplicates.hashed_candidates(df, 32, 6, 2, 3).exceptAll(duplicates.hashed_candidates(df, 32, 6, 2, 3)).count() == 0
    split = {(r["x"], r["y"]) for r in duplicates.hashed_candidates(df.where("id < 300"), 32, 6, 2, 3).collect()}
    monkeypatch.setattr(duplicates, "BUCKET", 500)
    assert split == {(r["x"], r["y"]) for r in duplicates.hashed_candidates(df.where("id < 300"), 32, 6, 2, 3).collect()}
    assert duplicates.hash_plan(10**9, 0.9)[0] > duplicates.hash_plan(10**6, 0.9)[0] > bits


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_against_union_find(spark):
    rng = random.Random(4)
    nodes = [f"d{i:03d}" for i in range(120)]
    edges = [tuple(rng.sample(nodes, 2)) for _ in range(70)] + [(f"d{i:03d}", f"d{i + 1:03d}") for i in range(30)]
    edges += [(a, a) for a in nodes[:3]]
    df = components.components(spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(edges, "u string, v string"))
    assert {r["node"]: r["component"] for r in df.collect()} == union_find(nodes, edges)
    empty = components.components(spark.createDataFrame([("a",)], "node string"), spark.createDataFrame([], "u string, v string"))
    assert empty.collect()[0].asDict() == {"node": "a", "component": "a"}


def test_components_of_chains_and_hubs(spark, monkeypatch):
    rounds = []
    put = Stage.put
    monkeypatch.setattr(Stage, "put", lambda self, df, *a: rounds.append("parent" in df.columns and "root" not in df.columns) or put(self, df, *a))
    names = [*range(0, 1602, 2), *range(1601, 0, -2)]  # up the even numbers and down the odd ones
    chain = spark.createDataFrame(list(zip(names, names[1:])), "u long, v long")
    got = components.components(spark.range(1602).withColumnRenamed("id", "node"), chain)
    assert got.where("component <> 0").count() == 0 and got.count() == 1602
    assert sum(rounds) <= 60  # hooks, and steps of pointer jumping
    hub = spark.createDataFrame([(500, i) for i in range(400)] + [(i, i + 1000) for i in range(50)], "u long, v long")
    nodes = hub.selectExpr("explode(array(u, v)) as node")
    assert {r["component"] for r in components.components(nodes, hub, hot_rows=20).collect()} == {0}


def test_join_unique_splits_hot_keys(spark):
    left = Stage(spark, "t").put(spark.createDataFrame([(0 if i % 2 else i, i) for i in range(200)] + [(None, 7)], "k int, v int"))
    right = spark.createDataFrame([(i, f"x{i}") for i in range(150)], "k int, w string")
    for how in ("inner", "left"):
        a = sorted((r["k"] or -1, r["v"], r["w"] or "") for r in join_unique(left, right, "k", how).collect())
        assert a == sorted((r["k"] or -1, r["v"], r["w"] or "") for r in join_unique(left, right, "k", how, hot_rows=10).collect())


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Far:
        master = "spark://x"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Far()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError):
        shared_dir(Session())


def lpt(weights, ties, test=0.2, val=0.2):
    total = sum(weights.values())
    goal = balance.targets(total, test, val)
    held = dict.fromkeys(goal, 0.0)
    out = {}
    for c in sorted(weights, key=lambda c: (-weights[c], ties[c], c)):
        s = max(balance.ORDER, key=lambda s: goal[s] - held[s])
        out[c] = s
        held[s] += weights[c]
    return out


def test_balance_equals_one_by_one(spark):
    rng = random.Random(2)
    for n in (1, 2, 5, 300):
        weights = {f"c{i}": rng.choice([1, 1, 2, 3, 7, 50]) for i in range(n)}
        df = spark.createDataFrame(list(weights.items()), "component string, weight long")
        tied = df.withColumn("tie", balance.seeded_tie(F.col("component"), 42))
        ties = {r["component"]: r["tie"] for r in tied.collect()}
        got = {r["component"]: r["split"] for r in balance.assign_by_weight(df, balance.seeded_tie(F.col("component"), 42)).collect()}
        assert got == lpt(weights, ties), n


def test_parity_ties_equal_a_plain_run(spark):
    rng = random.Random(3)
    weights = {f"c{i:02d}": rng.choice([1, 2, 2, 5]) for i in range(40)}
    names = sorted(weights)
    random.Random(42).shuffle(names)
    df = balance.shuffled_ties(spark.createDataFrame(list(weights.items()), "component string, weight long"), 42)
    got = {r["component"]: r["split"] for r in balance.assign_by_weight(df, F.col("tie")).collect()}
    assert got == lpt(weights, {c: i for i, c in enumerate(names)})


def test_worker_model_loads_once():
    loads = []
    model = embeddings.WorkerModel("t", lambda: loads.append(1) or embeddings.hashed_ngrams)
    model(["abcd"]), model(["efgh"])
    assert len(loads) == 1


def test_balance_small_cases(spark):
    def run(weights):
        df = spark.createDataFrame(list(weights.items()), "component string, weight long")
        return {r["component"]: r["split"] for r in balance.assign_by_weight(df, balance.seeded_tie(F.col("component"), 1)).collect()}

    assert set(run({"a": 5}).values()) == {"train"}
    assert sorted(run({"a": 5, "b": 5}).values()) == ["test", "train"]
    got = run({"a": 51, "b": 10, "c": 6, "d": 4, "e": 4})
    assert got["a"] == "train" and set(got.values()) == {"train", "val", "test"}
    empty = spark.createDataFrame([], "component string, weight long")
    assert balance.assign_by_weight(empty, balance.seeded_tie(F.col("component"), 1)).count() == 0


def test_running_sum_over_buckets(spark):
    rows = [(g, i, i % 5 + 1) for g in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i int, v int").withColumn("b", (F.col("i") / 7).cast("int"))
    out = running_sum(df, ["g"], "b", ["i"], "v", "before").collect()
    for r in out:
        assert r["before"] == sum(i % 5 + 1 for i in range(r["i"]))


def test_join_bounded_gives_the_same_either_way(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k int, w string")
    small = sorted((r["k"], r["v"], r["w"] or "") for r in join_bounded(left, right, ["k"]).collect())
    large = sorted((r["k"], r["v"], r["w"] or "") for r in join_bounded(left, right, ["k"], max_rows=1, salt=4).collect())
    assert small == large and len(small) == 30


def test_stage_writes_and_drops(spark):
    stage = Stage(spark, "t")
    df = stage.put(spark.range(5))
    assert df.count() == 5
    stage.drop(df)
    kept = stage.put(spark.range(3))
    assert os.path.isdir(kept._folium_path) and not os.path.exists(df._folium_path)
    release(spark)
    assert not os.path.exists(stage.root)


# ---- packing


def plain_chunks(sections, cfg):
    """One document, section by section: lists of (section, part key, blocks) as plain loops."""
    out, waiting = [], []

    def pack(section, blocks):
        part, size = [], 0

        def flush():
            nonlocal part, size
            if part:
                out.append((section, [b["i"] for b in part], False))
            part, size = [], 0

        if len(blocks) == 1 and blocks[0]["n"] > cfg.max_tokens:
            out.append((section, [blocks[0]["i"]], True))
            return
        for b in blocks:
            if b["rep"]:
                flush()
                out.append((section, [b["i"]], False))
            elif b["n"] > cfg.max_tokens:
                flush()
                out.append((section, [b["i"]], True))
            else:
                if part and size + b["n"] > cfg.max_tokens:
                    flush()
                part.append(b)
                size += b["n"]
                if size >= cfg.target_tokens:
                    flush()
        flush()

    before = None
    for k, blocks in enumerate(sections):
        if all(b["api"] for b in blocks):
            if waiting:
                pack(before, waiting)
                waiting = []
            pack(k, blocks)
        else:
            waiting = waiting + blocks
            if sum(b["n"] for b in waiting) >= cfg.min_section_tokens or k == len(sections) - 1:
                pack(k, waiting)
                waiting = []
        before = k
    return out


def test_chunks_equal_plain_loops(spark):
    rng = random.Random(11)
    cfg = packing.PackingConfig(40, 80, 10)
    rows, want = [], {}
    for d in range(40):
        sections, i = [], 0
        for s in range(rng.randint(1, 7)):
            api = rng.random() < 0.2
            blocks = []
            for _ in range(rng.randint(1, 5)):
                n = rng.choice([1, 3, 5, 10, 20, 39, 41, 79, 85, 200])
                b = {"i": i, "n": n, "rep": rng.random() < 0.15, "api": api}
                blocks.append(b)
                words = " ".join(f"w{d}x{i}y{k}" for k in range(n))
                rows.append((f"d{d}", s, i, "api_spec" if api else rng.choice(["prose", "table", "code"]), words, i * 10, i * 10 + 5, n, b["rep"]))
                i += 1
            sections.append(blocks)
        want[f"d{d}"] = plain_chunks(sections, cfg)
    schema = "doc_id string, section_idx int, block_idx int, content_type string, text string, char_start int, char_end int, n_tokens int, repeated boolean"
    blocks = spark.createDataFrame(rows, schema)
    out = packing.chunks(blocks, cfg).collect()
    texts = {(r[0], r[2]): r[4] for r in rows}
    for d, parts in want.items():
        got = sorted((r for r in out if r["doc_id"] == d), key=lambda r: r["chunk_index"])
        assert [r["chunk_index"] for r in got] == list(range(len(got))) and all(r["n_chunks_in_doc"] == len(got) for r in got)
        k = 0
        for section, ids, windowed in parts:
            if not windowed:
                assert got[k]["text"] == "\n\n".join(texts[d, i] for i in ids)
                assert got[k]["section_idx"] == section
                k += 1
            else:
                words = texts[d, ids[0]].split(" ")
                start = 0
                while True:
                    assert got[k]["text"] == " ".join(words[start : start + cfg.max_tokens])
                    assert not got[k]["is_low_signal"]
                    k += 1
                    if start + cfg.max_tokens >= len(words):
                        break
                    start += cfg.step
        assert k == len(got)


def test_packing_cases(spark):
    cfg = packing.PackingConfig(40, 80, 10)
    schema = "doc_id string, section_idx int, block_idx int, content_type string, text string, char_start int, char_end int, n_tokens int, repeated boolean"

    def run(rows):
        return sorted(packing.chunks(spark.createDataFrame(rows, schema), cfg).collect(), key=lambda r: r["chunk_index"])

    placeholder = run([("d", 0, 0, "prose", "TO DO.", 0, 6, 3, False)])
    assert placeholder[0]["is_low_signal"]
    merged = run([("d", 0, 0, "prose", "a b", 0, 3, 2, False), ("d", 1, 1, "table", "c " * 30, 9, 70, 30, False)])
    assert len(merged) == 1 and merged[0]["section_idx"] == 1 and merged[0]["content_type"] == "table" and (merged[0]["char_start"], merged[0]["char_end"]) == (0, 70)
    api = run([("d", 0, 0, "api_spec", "a", 0, 1, 1, False), ("d", 1, 0, "api_spec", "b", 0, 1, 1, False)])
    assert [r["section_idx"] for r in api] == [0, 1]


def test_round_robin_cap(spark):
    rng = random.Random(5)
    rows = [("d1", rng.randint(0, 4), rng.choice(list(quality.TYPE_PRIORITY)), i) for i in range(40)] + [("d2", 0, "enum", 100)]
    df = spark.createDataFrame(rows, "doc string, chunk int, kind string, n int")
    got = [(r["chunk"], r["n"]) for r in quality.round_robin_cap(df, "doc", "chunk", [quality.type_priority("kind"), "n"], 8).orderBy("doc", "pick").collect()]
    queues = {}
    for d, c, k, n in sorted((x for x in rows if x[0] == "d1"), key=lambda x: (x[1], quality.TYPE_PRIORITY[x[2]], x[3])):
        queues.setdefault(c, []).append(n)
    want = []
    while len(want) < 8 and any(queues.values()):
        for c in sorted(queues):
            if queues[c] and len(want) < 8:
                want.append((c, queues[c].pop(0)))
    assert got == [*want, (0, 100)]


def test_quality_checks_order_and_judge(spark):
    rows = [
        ("p", 0, "¿Qué es el valor?", "a", "no such", "text here", None),
        ("p", 1, "qué es el valor", "b", "text", "text here", None),
        ("q", 2, "¿Qué es el valor?", "c", "text", "text here", True),
        ("q", 3, "¿Qué otra cosa?", "d", "text", "text here", False),
    ]
    df = spark.createDataFrame(rows, "project string, n int, question string, answer string, evidence_span string, chunk_text string, llm_judge_grounded boolean")
    out = {r["n"]: (r["evidence_verified"], r["not_near_duplicate_question"], r["qc_passed"]) for r in quality.quality_checks(df, ["n"]).collect()}
    # a failing first question still hides a later equal one of its project
    assert out == {0: (False, True, False), 1: (True, False, False), 2: (True, True, True), 3: (True, True, False)}


def test_hashed_vectors_are_close_for_close_texts(spark):
    v = embeddings.hashed_ngrams(["el cliente paga la cuota mensual", "el cliente paga la cuota anual", "zzz qqq", ""])
    assert v[0] @ v[1] > 0.6 > v[0] @ v[2] and not v[3].any()
    df = spark.createDataFrame([(1, "abc def"), (2, None)], "id long, text string")
    assert [r["key"] for r in embeddings.with_vectors(df, "id", "text").collect()] == [1]


def test_reports(spark):
    docs = spark.createDataFrame([("p", "d1", "c1", "train", 3), ("p", "d2", "c2", "test", 1), ("q", "d3", "c1", "train", 2)], "project string, doc_id string, component string, split string, n_chunks int")
    rows = {r["project"]: r for r in reports.split_report(docs).collect()}
    assert rows["p"]["chunks_train"] == 3 and rows["p"]["chunks_test"] == 1 and rows["p"]["warnings"] == "nothing in val"
    assert rows["q"]["warnings"] == "single component; nothing in val; nothing in test"
    leak = spark.createDataFrame([("h", "train"), ("h", "val"), ("g", "train"), (None, "val")], "h string, split string")
    assert [r["h"] for r in reports.leaks(leak, "h").collect()] == ["h"]
