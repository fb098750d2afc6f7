"""Operators on vectors, the component finder and the pipeline against brute force."""

import duckdb
import numpy as np
import pytest

from tillstream.llm import embed_dedup, graph, topk
from tillstream.llm.common import session
from tillstream.llm.oracle import ORACLE
from tillstream.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def sc(spark):
    return session(spark)


def plain_links(rows, cosine):
    n, root = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ok = [r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], "f4").astype("f8"), np.array(rows[j][1], "f4").astype("f8")
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return n, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("block", [1024, 7])
def test_embedding_links_equal_brute_force(sc, block, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(12):
        centre = rng.normal(size=16)
        rows += [((centre + rng.normal(size=16) * s).tolist(), int(rng.integers(0, 3))) for s in (0, 0, 0.05, 0.1, 0.15, 0.2, 0.3)]
    rows = [(i, v, label) for i, (v, label) in enumerate(rows)]
    k = len(rows)
    rows += [(k, None, 1), (k + 1, [0.0] * 16, 1), (k + 2, [float("nan")] * 16, 1), (k + 3, [1.0, None] * 8, 1), (k + 4, rows[0][1], None), (k + 5, [1e-30] * 16, 2), (k + 6, [2e30] * 16, 2), (k + 7, [], 2), (k + 8, [1.0, 2.0], 2), (k + 9, [2.0, 4.0], 2), (k + 10, [float("inf")] * 16, 0)]
    want_n, want_root = plain_links(rows, 0.98)
    out = {r["vec_id"]: r for r in embed_dedup.near_duplicates(sc.createDataFrame(rows, VECTORS)).collect()}
    assert len(out) == len(rows)
    assert [out[i]["n_links"] for i in range(len(rows))] == [want_n[i] for i in range(len(rows))]
    assert [out[i]["component_id"] for i in range(len(rows))] == want_root
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())
    assert embed_dedup.near_duplicates(sc.createDataFrame([], VECTORS)).count() == 0


def test_embedding_rows_without_an_id_and_with_a_repeated_one(sc):
    rng = np.random.default_rng(6)
    a, b, c, d, e = (rng.normal(size=16) for _ in range(5))
    near = lambda v: (v + rng.normal(size=16) * 0.02).tolist()
    # a pair with one id missing, a pair without ids, and one id for three vectors, of which two have neighbours
    ids = [None, 5, None, None, 9, 9, 9, 3, 20, 21]
    rows = list(zip(ids, map(near, [a, a, b, b, c, d, e, c, d, d]), [0, 0, 0, 0, 1, 2, 1, 1, 2, 2]))
    want_n, _ = plain_links(rows, 0.98)
    names = [5, 5, None, None, 3, 9, 9, 3, 9, 9]
    want = [(i, want_n[k], name, i == name) for k, (i, name) in enumerate(zip(ids, names))]
    assert [want_n[k] for k in range(10)] == [1, 1, 1, 1, 1, 2, 0, 1, 2, 2]
    out = embed_dedup.near_duplicates(sc.createDataFrame(rows, VECTORS)).collect()
    assert sorted(map(str, (tuple(r) for r in out))) == sorted(map(str, want))


def test_embedding_recall_near_the_threshold(sc):
    rng = np.random.default_rng(8)
    v = embed_dedup.unit(rng.normal(size=(300, 64)))
    near = []
    for x in v:
        side = rng.normal(size=(4, 64))
        side = embed_dedup.unit(side - (side @ x)[:, None] * x)
        cosine = rng.uniform(0.975, 0.995, 4)[:, None]
        near.append(cosine * x + np.sqrt(1 - cosine**2) * side)
    v = np.concatenate([v, *near]).astype("f4").astype("f8")
    label = np.concatenate([np.arange(300) % 3, np.repeat(np.arange(300) % 3, 4)])
    rows = [(i, x.tolist(), int(y)) for i, (x, y) in enumerate(zip(v, label))]
    out = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(sc.createDataFrame(rows, VECTORS)).collect()}
    u = v / np.sqrt((v * v).sum(1, keepdims=True))
    links = [int(((u @ x >= 0.98) & (label == y)).sum()) - 1 for x, y in zip(u, label)]
    assert sum(links) > 1500 and all(out[i] <= n for i, n in enumerate(links))
    assert sum(out.values()) >= 0.99 * sum(links)


def test_calibrated_count_keeps_threshold_pairs():
    rng = np.random.default_rng(0)
    count = embed_dedup.least_count(0.98)
    a = embed_dedup.unit(rng.normal(size=(4000, 64)))
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * embed_dedup.unit(side)
    hits = (np.abs((a - b) @ embed_dedup.lines(64)) <= embed_dedup.WIDTH).sum(1)
    assert (hits >= count).mean() > 0.999
    far = (np.abs((a[1:] - a[:-1]) @ embed_dedup.lines(64)) <= embed_dedup.WIDTH).sum(1)
    assert (far >= count).mean() < 0.01


@pytest.mark.parametrize(("block", "side"), [(2048, 32), (9, 32), (9, 2)])
def test_top_k_equals_brute_force(sc, block, side, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "SIDE", side)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 8).astype("f4").tolist(), 0) for i in range(160)]  # many ties
    rows += [(200, None, 0), (201, [float("nan")] * 8, 0), (202, [None] * 8, 0), (250, [0.5] * 8, None), (300, [9.0] * 3, 0), (7, rows[7][1], 0), (None, rows[3][1], 0), (350, [], 0)]
    ints = [(i, np.floor(np.array(v, "f4").astype("f8") * 256).astype("i8")) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = {}
    for q, x in ints:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in ints if i != q and len(y) == len(x))[:5]
            want.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)})
    out = topk.top_k(sc.createDataFrame(rows, VECTORS)).collect()
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in out} == want
    assert topk.top_k(sc.createDataFrame([], VECTORS)).count() == 0


def test_top_k_among_many_equal_vectors_and_ids(sc):
    rng = np.random.default_rng(2)
    a, b, c = (rng.integers(-40, 40, 6).astype("f4").tolist() for _ in range(3))
    rows = [(i, a) for i in range(40, 400)] + [(i, b) for i in range(900, 990)] + [(50, a)] * 9 + [(51, a)] * 7 + [(1000, c), (0, [-x for x in a])]
    ints = [(i, np.floor(np.array(v) * 256).astype("i8")) for i, v in rows]
    want = {}
    for q in {i for i, _ in rows if i % 50 == 0}:
        x = min((tuple(v.tolist()) for i, v in ints if i == q))
        best = sorted((-int(np.dot(x, y)), i) for i, y in ints if i != q)[:5]
        want.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)})
    table = sc.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(table).collect()} == want
    assert topk.searched(topk.integers(table), 5).count() < 60  # of 468 rows


def test_top_k_reads_few_exact_rows_and_broadcasts_nothing(sc, monkeypatch):
    rng = np.random.default_rng(3)
    table = sc.createDataFrame([(i, v.astype("f4").tolist(), 0) for i, v in enumerate(rng.normal(size=(6000, 32)))], VECTORS)
    monkeypatch.setattr(topk, "BLOCK", 512)
    exact = topk.integers(table)
    blocks = topk.materialize(topk.approximation_file(topk.searched(exact, 5)), "blocks")
    packs = topk.materialize(topk.query_packs(topk.asked_rows(exact, 50)), "packs")
    assert "exact" not in blocks.columns and "v" not in blocks.columns
    met = topk.survivors(blocks, packs, 5)
    assert "Broadcast" not in met._jdf.queryExecution().explainString(sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    wanted = topk.wanted_rows(met, 5)
    per_query = wanted.count() / 120
    assert 5 <= per_query < 60  # of 5,999


def test_components_of_paths_stars_and_loops(sc):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    edges = path + star + [(5, 5), (7000, 7000), (2000, 2001), (2001, 2000), (-9, 2001)]
    got = {r["node"]: r["root"] for r in graph.components(sc.createDataFrame(edges, graph.EDGE)).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1000 + i] for i in range(400)} == {1000} and got[2000] == -9 and 7000 not in got
    assert graph.components(sc.createDataFrame([], graph.EDGE)).count() == 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle_rows(sc, key):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got, want = QUERIES[key](sc, sf).toPandas(), con.execute(ORACLE[key]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda f: sorted(map(str, f[cols].itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_pipeline_stages_hand_on_documents(sc):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = sc.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(sc, docs, sf), name)
        assert docs.columns == columns
        if name == "lines":
            assert docs.count() == before
        elif name == "near_duplicates":
            assert 0 < docs.count() < before and docs.count() == docs.select("doc_id").distinct().count()
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](sc, docs, sf)
    assert last.count() == before and last.where("not round_trip").count() == 0
    assert corpus_pipeline.run(sc, sf).count() == before


def test_pipeline_on_an_empty_table(sc, tmp_path):
    import corpus_pipeline

    for t in ("documents", "labels"):
        sc.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(sc, str(tmp_path)).count() == 0
