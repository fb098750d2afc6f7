"""Operators on documents against brute force, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tillstream.llm import bpe, chunk_dedup, line_dedup, mixing, quality, secret_scan, sharding, simhash
from tillstream.llm.common import session
from tillstream.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sc(spark):
    return session(spark)


def frame(spark, texts, **more):
    rows = [(i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " ", "\n\n\n", "a", "a\na\na\na\na", "x" * 30000, "word " * 9000, "é漢👩‍👩‍👧   z", "same text\nhere twice\nover", "same text\nhere twice\nover"]


# ---- 1 quality


def test_quality_held_out_accuracy_and_fold(sc):
    out = QUERIES["op1_quality_classifier"](sc, "/root/testdata/sf0.01").toPandas()
    labels = sc.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    assert len(out) == 1000 and out["score"].between(0, 1).all()
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out["doc_id"]]).all()
    assert ((out["score"] >= 0.3).astype(int) == out["predicted"]).all()
    known = out.merge(labels, on="doc_id")
    fold = known[known["held_out"]]
    assert (fold["predicted"] == fold["quality"]).mean() > 0.93


def test_quality_reads_whole_texts_in_slices(sc, monkeypatch):
    rng = np.random.default_rng(1)
    good, bad = [" ".join(rng.choice(["the", "of", "and", "thing"], 60)) for _ in range(40)], [" ".join(rng.choice(["THE!!", "OF!!", "AND!!"], 60)) for _ in range(40)]
    m = quality.train(good + bad, np.array([1.0] * 40 + [0.0] * 40), epochs=6)
    long = " ".join(good * 30) + " " + bad[0]  # the junk comes last
    scores = quality.probability(m, quality.pooled(m, [good[0], bad[0], long, None, ""]))
    assert scores[0] > 0.5 > scores[1] and scores[2] < scores[0]
    whole = quality.pooled(m, [long, good[1]])
    monkeypatch.setattr(quality, "SLICE", 1024)
    np.testing.assert_allclose(quality.pooled(m, [long, good[1]]), whole, atol=1e-5)


def plain_pooled(m, text):
    """The network by loops over bytes, filter positions and chunks."""
    raw = list(text.encode())
    n = -(-len(raw) // quality.HALF)
    flag = [any(all(i - j - lag >= 0 and raw[i - j] == raw[i - j - lag] for j in range(quality.REPEAT)) for lag in quality.LAGS) for i in range(len(raw))]
    vectors = [m.embed[b + 256 * f] for b, f in zip(raw, flag)]
    zero, best = np.zeros(quality.WIDTH), np.zeros(quality.FILTERS)
    at = lambda i: vectors[i] if i < len(vectors) else zero
    for c in range(n):
        out = []
        for p in range(c * quality.HALF, min((c + 2) * quality.HALF, len(raw)), quality.STEP):
            first, second = (np.concatenate([at(i + j) for j in range(quality.STEP)]) for i in (p, p + quality.STEP))
            out.append(np.maximum(first @ m.kernel[:, : quality.FILTERS] + second @ m.kernel[:, quality.FILTERS :] + m.shift, 0))
        best = np.maximum(best, np.mean(out, axis=0))
    return best


def small_model(rng):
    k = quality
    m = k.Model(*[rng.normal(0, s, shape).astype("float32") for s, shape in ((0.5, (k.BLANK + 1, k.WIDTH)), (0.3, (k.STEP * k.WIDTH, 2 * k.FILTERS)), (0.1, k.FILTERS), (0.3, k.FILTERS))], 0.2)
    m.embed[k.BLANK] = 0
    return m


QUALITY_TEXTS = ["", "a", "abcd" * 40, "The quick brown fox, " * 9 + "jumps é漢 over!", "x y z " * 70 + "QWERTY 0123456789 " * 12, "\n".join(f"line {i * i}" for i in range(60))]


@pytest.mark.parametrize("slice_bytes", [1 << 18, 128])
def test_quality_network_equals_plain_loops(monkeypatch, slice_bytes):
    monkeypatch.setattr(quality, "SLICE", slice_bytes)
    m = small_model(np.random.default_rng(4))
    np.testing.assert_allclose(quality.pooled(m, QUALITY_TEXTS), [plain_pooled(m, t) for t in QUALITY_TEXTS], rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("slice_bytes", [1 << 18, 128])
def test_quality_gradient_equals_differences(monkeypatch, slice_bytes):
    monkeypatch.setattr(quality, "SLICE", slice_bytes)
    rng = np.random.default_rng(8)
    m, y = small_model(rng), np.array([1.0, 0, 1, 0, 1, 0])
    texts = [t.encode() for t in QUALITY_TEXTS]

    def loss(m):
        p = quality.probability(m, quality.pooled(m, QUALITY_TEXTS))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality._gradient(m, texts, y)
    for k, name in enumerate(["embed", "kernel", "shift", "weight", "bias"]):
        g, value = grads[k], getattr(m, name)
        step = 1e-3 * (g / np.linalg.norm(g)) if name != "bias" else np.array([1e-3])
        if name == "embed":
            step[quality.BLANK] = 0
        ends = []
        for sign in (1, -1):
            other = quality.Model(m.embed, m.kernel, m.shift, m.weight, m.bias)
            setattr(other, name, value + sign * step if name != "bias" else float(value + sign * step[0]))
            ends.append(loss(other))
        assert ends[0] - ends[1] == pytest.approx(2 * float((g * step).sum()), rel=0.03), name


def test_quality_sample_takes_whole_texts_within_its_bounds(sc):
    docs = frame(sc, ["word " * (i * 40) for i in range(60)] + [None])
    labels = sc.createDataFrame([(i, i % 2, 0) for i in range(61)] + [(7, 0, 0)], "doc_id long, quality int, toxic int")
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    fold = [i for i in range(61) if zlib.crc32(str(i).encode()) % 5]
    rows = quality.sample(docs, labels).collect()
    assert sorted(r["doc_id"] for r in rows) == fold and all(r["text"] == whole[r["doc_id"]] for r in rows)
    some = quality.sample(docs, labels, max_rows=20).collect()
    assert [r["doc_id"] for r in some] == [r["doc_id"] for r in rows[:20]]
    few = quality.sample(docs, labels, max_chars=60_000).collect()
    assert 3 < len(few) < len(rows) and sum(len(r["text"] or "") for r in few) <= 60_000 and all(r["text"] == whole[r["doc_id"]] for r in few)
    assert quality.sample(docs.union(docs.where("doc_id = 8")), labels).where("doc_id = 8").count() == 2


def test_quality_without_labels_or_with_one_class(sc):
    docs = frame(sc, ODD)
    none = sc.createDataFrame([], "doc_id long, quality int, toxic int")
    one = sc.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert {round(r["score"], 3) for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert all(r["score"] > 0.99 for r in quality.score(docs, quality.fit(docs, one)).collect())
    assert quality.keep_good(docs, quality.fit(docs, one)).columns == docs.columns
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0


# ---- 2 secrets


def plain_secrets(text):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_secrets_match_plain_patterns(sc):
    out = {r["doc_id"]: r for r in QUERIES["op2_secret_scan"](sc, SF).collect()}
    docs = sc.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        want = plain_secrets(d["text"])
        got = out[d["doc_id"]]
        assert [got["n_assign"], got["n_access"], got["n_hex"]] == [sum(s[0] == k for s in want) for k in ("assign", "access", "hex")]
        assert got["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert set(got["spans"].split(",")) - {""} >= {f"{k}:{a}:{b}" for k, a, b in want}


def test_secrets_patterns_on_odd_texts():
    rng = random.Random(3)
    parts = ["token", "Secret", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abc", "deadbeef" * 3, "AKIA", "AKIA" + "Q7" * 9, "ſecret", "toKen", "\n", "x.y=z", "0" * 23, "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        got = [(secret_scan.KINDS[k], a, b) for a, k, b, _ in secret_scan.scan(text) if k < 3]
        assert got == plain_secrets(text), text


def test_secrets_ownership_separates_copied_from_owned(sc):
    live, copied = "zQ9" * 8, "Ab3" * 9
    rows = [(i, f"see {copied} here", "en", f"s{i}", 0) for i in range(40)] + [(100, f"x {live} y token={live}", "en", "s1", 0), (101, None, None, None, None), (102, "", "en", "s", 0)]
    docs = sc.createDataFrame(rows + rows[:1], DOCS)
    out = secret_scan.secrets(docs).collect()
    assert len(out) == len(rows) + 1
    by = {r["doc_id"]: r for r in out}
    assert by[5]["spans"] == [] and by[5]["n_copied"] == 1
    assert [secret_scan.KINDS[s["kind"]] for s in by[100]["spans"]] == ["owned", "assign"] and by[100]["n_live"] == 2
    assert {(s["repositories"], s["owners"]) for s in by[100]["spans"]} == {(1, 1)}
    assert by[101]["spans"] == [] and by[102]["n_live"] == 0
    assert secret_scan.secrets(docs.limit(0)).count() == 0


def test_secrets_added_kind_equals_brute_force(sc):
    rng = random.Random(21)
    pool = ["".join(rng.choice("abcXYZ0123456789+/_=-") for _ in range(rng.randint(18, 26))) for _ in range(60)]
    fill = ["token=", "see", "AKIA" + "Q7" * 9, "0f" * 14, ".", "\n", "é"]
    rows = []
    for i in range(400):
        tokens = [rng.choice(pool[: 12 + i // 8]) if rng.random() < 0.5 else rng.choice(fill) for _ in range(rng.randint(0, 6))]
        # the first tokens of the pool stand in every source, others in one or two, some of them very often
        rows.append((i, " ".join(tokens), "en", f"s{i % 7 if i % 2 else 0}", 0))
    wanted, places = {}, {}
    for i, text, _, source, _ in rows:
        wanted[i] = []
        base = [(a, b) for _, a, b in plain_secrets(text)]
        values = [(m[2], "assign", m.start(), m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 6]
        values += [(text[a:b], k, a, b) for k, a, b in plain_secrets(text) if k != "assign"]
        for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
            v = m[0]
            if len(v) >= 20 and all(re.search(c, v) for c in ("[0-9]", "[a-z]", "[A-Z]")) and not any(a < m.end() and m.start() < b for a, b in base):
                values.append((v, "owned", m.start(), m.end()))
        for v, k, a, b in values:
            places.setdefault(v, set()).add((source, i))
            wanted[i].append((v, k, a, b))
    live = {v: len({s for s, _ in at}) <= 2 and len(at) <= 8 for v, at in places.items()}
    spread = {(len({s for s, _ in at}) <= 2, len(at) <= 8) for at in places.values()}
    assert spread == {(True, True), (True, False), (False, True), (False, False)} or len(spread) >= 3
    out = {r["doc_id"]: r for r in secret_scan.secrets(sc.createDataFrame(rows, DOCS)).collect()}
    for i, found in wanted.items():
        got = {(secret_scan.KINDS[s["kind"]], s["start"], s["stop"], s["repositories"], s["owners"]) for s in out[i]["spans"]}
        assert got == {(k, a, b, len(places[v]), len({s for s, _ in places[v]})) for v, k, a, b in found if k != "owned" or live[v]}
        assert [out[i]["n_live"], out[i]["n_copied"]] == [sum(live[v] == x for v, *_ in found) for x in (True, False)]


def test_secrets_copied_within_one_hot_source(sc):
    value = "Kq7" * 9
    rows = [(i, f"key {value}", "en", "hot", 0) for i in range(50)] + [(90 + i, "own Zx8Zx8Zx8Zx8Zx8Zx8Zx8", "en", "hot", 0) for i in range(3)]
    out = {r["doc_id"]: r for r in secret_scan.secrets(sc.createDataFrame(rows, DOCS)).collect()}
    assert all(out[i]["spans"] == [] and out[i]["n_copied"] == 1 for i in range(50))
    assert all([(s["repositories"], s["owners"]) for s in out[90 + i]["spans"]] == [(3, 1)] for i in range(3))


# ---- 4 substrings


def plain_chunks(data):
    ends = chunk_dedup.cuts(data)
    return list(zip([0, *ends], ends))


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 9))) for _ in range(800))
    for t in (text, "", "é" * 3000, "a" * 5000, "x"):
        ends = chunk_dedup.cuts(t.encode())
        assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == len(t.encode())
        for a, b in zip([0, *ends], ends):
            t.encode()[a:b].decode()
            assert b - a <= chunk_dedup.MOST
    data, moved = text.encode(), ("inserted words " + text).encode()
    mine, other = {data[a:b] for a, b in plain_chunks(data)}, {moved[a:b] for a, b in plain_chunks(moved)}
    assert len(mine & other) >= len(mine) - 3


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(random.Random(1).randbytes(300), "u1")
    for i in (0, 3, 15, 16, 100, 299):
        want = sum(int(chunk_dedup.GEAR[data[j]]) << (i - j) for j in range(max(0, i - chunk_dedup.REACH + 1), i + 1)) % 2**32
        assert int(chunk_dedup.gear(data)[i]) == want


def test_shared_passages_go_and_clean_texts_stay(sc):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    texts = [prose(150) + " " + passage + " " + prose(100) if i % 3 == 0 else prose(200) for i in range(60)]
    rows = chunk_dedup.dedup(frame(sc, texts + ODD)).orderBy("doc_id").collect()
    assert len(rows) == 60 + len(ODD)
    for i, r in enumerate(rows[:60]):
        if i % 3 or i == 0:
            assert r["text"] == texts[i] and r["n_removed"] == 0
        else:
            assert r["n_removed"] >= 128 and 0 in r["first_ids"] and len(r["text"]) < len(texts[i])
    assert rows[60]["text"] is None and rows[61]["text"] == ""
    assert chunk_dedup.dedup(frame(sc, [])).count() == 0


def test_substring_dedup_equals_brute_force(sc):
    docs = sc.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    first, want = {}, {}
    for d in docs:
        data = d["text"].encode()
        for a, b in plain_chunks(data):
            first.setdefault(data[a:b], (d["doc_id"], a))
    for d in docs:
        data = d["text"].encode()
        spans = [(a, b) for a, b in plain_chunks(data) if first[data[a:b]] != (d["doc_id"], a)]
        gone = chunk_dedup.long_runs(spans, chunk_dedup.LEAST_RUN)
        want[d["doc_id"]] = b"".join(data[a:b] for a, b in zip([0, *(g[1] for g in gone)], [*(g[0] for g in gone), len(data)])).decode()
    assert {r["doc_id"]: r["text"] for r in QUERIES["op4_substring_dedup"](sc, SF).collect()} == want


def test_a_text_sends_each_of_its_chunks_once(sc):
    rng = random.Random(41)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passage = prose(80)
    texts = [" ".join([prose(40), passage, prose(30), passage, prose(20), passage]), prose(120), None, "", passage]
    made = chunk_dedup.chunks(frame(sc, texts))
    held = [{t.encode()[a:b] for a, b in plain_chunks(t.encode())} for t in texts if t]
    assert made.count() == sum(map(len, held)) < sum(len(plain_chunks(t.encode())) for t in texts if t)
    assert made.columns == ["id", "key", "at", "d1", "d2"]  # what is shuffled for every chunk: no offsets
    found = chunk_dedup.repeats(frame(sc, texts)).collect()
    assert [r["id"] for r in found] == [4] and {s["first"] for s in found[0]["spans"]} == {0}
    out = {r["doc_id"]: r for r in chunk_dedup.dedup(frame(sc, texts)).collect()}
    assert out[0]["first_ids"] == [0] and out[0]["n_removed"] > len(passage) and out[4]["first_ids"] == [0]
    assert out[1]["first_ids"] == [] and out[1]["text"] == texts[1] and out[2]["first_ids"] == []


def test_substrings_of_rows_without_an_id_or_with_one_id(sc):
    rng = random.Random(43)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passage = prose(90)
    twice = f"{passage} {prose(30)} {passage}"
    rows = [(None, twice), (None, twice), (None, prose(60)), (7, twice), (7, twice), (7, f"{prose(20)} {passage}"), (9, f"{prose(15)} {passage}")]
    docs = sc.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((-1 if r["doc_id"] is None else r["doc_id"], len(r["text"]), r["n_removed"], tuple(r["first_ids"])) for r in chunk_dedup.dedup(docs).collect()), key=str)
    assert len(out) == 7
    by = {i: [x[2:] for x in out if x[0] == i] for i in (-1, 7, 9)}
    # without an id: comes last, so all of the text that a row with an id holds goes
    assert sorted(len(f) for _, f in by[-1]) == [0, 1, 1] and by[-1].count((len(twice.encode()), (7,))) == 2
    # one id: none repeats the other, the repeat inside each goes
    assert sorted(bool(n) for n, _ in by[7]) == [False, True, True] and {f for n, f in by[7] if n} == {(7,)}
    assert [f for _, f in by[9]] == [(7,)]


def test_two_copies_of_51_words_seldom_stay_whole():
    rng, whole, half = random.Random(12), 0, 0
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    for _ in range(1500):
        passage = prose(51)
        first, second = (f"{prose(rng.randint(20, 90))} {passage} {prose(rng.randint(20, 90))}".encode() for _ in range(2))
        known = {first[a:b] for a, b in plain_chunks(first)}
        spans = [(a, b) for a, b in plain_chunks(second) if second[a:b] in known]
        gone = sum(b - a for a, b in chunk_dedup.long_runs(spans, chunk_dedup.LEAST_RUN))
        whole += not gone
        half += gone < len(passage) / 2
    assert whole < 15 and half < 45, (whole, half)


def test_what_goes_is_a_common_substring_and_most_of_it_goes(sc):
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("etaoinshrdlué漢") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(51, 120)) for _ in range(25)]
    short = [prose(12) for _ in range(25)]  # under the least run: stays
    texts, held = [], []
    for i in range(200):
        p = rng.choice(passages) if i % 2 else rng.choice(short)
        held.append(p)
        texts.append(f"{prose(rng.randint(5, 150))} {p} {prose(rng.randint(5, 150))}")
    rows = chunk_dedup.dedup(frame(sc, texts)).orderBy("doc_id").collect()
    missed = 0
    for i, r in enumerate(rows):
        text, out = texts[i].encode(), r["text"].encode()
        again = held[i] in passages and held[i] in held[:i]
        assert len(text) - len(out) == r["n_removed"] and (again or not r["n_removed"])
        missed += again and r["n_removed"] < len(held[i].encode()) / 2
        if r["n_removed"]:
            at = next((k for k, (x, y) in enumerate(zip(text, out)) if x != y), len(out))
            starts = [k for k in range(at, -1, -1) if text[:k] + text[k + r["n_removed"] :] == out]
            pieces = [text[k : k + r["n_removed"]] for k in starts[:40]]
            assert any(x in texts[d].encode() for x in pieces for d in range(i))
    assert missed <= 2, missed


# ---- 5 lines


def test_lines_guarantee_and_order(sc):
    block = "one line\ntwo lines\nthree lines"
    texts = [f"start a\n{block}\nend a", "clean\nother", f"{block}", f"b\n{block}\nc", None, "", "only", "r\nr\nr\nr\nr"]
    out = line_dedup.dedup_lines(frame(sc, texts)).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == [texts[0], texts[1], "", "b\nc", None, "", "only", "r"]
    assert out[0]["n_chars"] == len(texts[0])
    staged = line_dedup.stage(frame(sc, texts)).orderBy("doc_id").collect()
    assert staged[3]["n_chars"] == 3 and staged[2]["n_chars"] == 0


def test_lines_every_repeated_run_of_guaranteed_length_goes(sc):
    rng = random.Random(2)
    run = [f"shared {rng.random()}" for _ in range(line_dedup.GRAM + line_dedup.WINDOW - 1)]
    texts = ["\n".join([f"x {rng.random()}" for _ in range(rng.randint(0, 5))] + run + [f"y {rng.random()}" for _ in range(rng.randint(0, 5))]) for _ in range(60)]
    out = line_dedup.dedup_lines(frame(sc, texts)).orderBy("doc_id").collect()
    assert out[0]["text"] == texts[0]
    assert all(not any(line in r["text"] for line in run) for r in out[1:])


def test_lines_one_copy_of_every_long_line_stays(sc):
    rng = random.Random(4)
    new = lambda: f"x {rng.random()}"
    lone, many = "this line stands alone in its text", " ".join(f"word{i}" for i in range(51))
    texts = [f"{new()}\n{lone}\n{new()}", f"{new()}\n{many}", lone, f"{new()}\n{lone}\n{new()}\n{many}\n{new()}", f"{many}\n{new()}", lone]
    out = [r["text"] for r in line_dedup.stage(frame(sc, texts)).orderBy("doc_id").collect()]
    assert out[:2] == texts[:2] and out[2] == out[5] == "" and not any(x in t for t in out[2:] for x in (lone, many))

    docs = sc.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = lambda rows: Counter(x for r in rows if r["text"] is not None for x in r["text"].split("\n") if len(x.split()) > 5)
    before, after = lines(docs.collect()), lines(line_dedup.stage(docs).collect())
    assert max(before.values()) > 100 and set(after) == set(before) and set(after.values()) == {1}


def test_lines_repeated_runs_go_whatever_the_first_place_of_their_gram(sc):
    rng = random.Random(9)
    texts = []
    for k in range(40):  # the pair a, b stands elsewhere first, once before and once after another line
        a, b, p = (f"{x}{k} {rng.random()}" for x in "abp")
        new = lambda: f"x {rng.random()}"
        texts += ["\n".join([new(), a, b, new()]), "\n".join([new(), b, p, new()])]
        texts += ["\n".join([new(), a, b, p, new()]) for _ in range(3)]
    out = [r["text"].split("\n") for r in line_dedup.stage(frame(sc, texts)).orderBy("doc_id").collect()]
    assert all(len(out[5 * k + i]) == 2 for k in range(40) for i in (3, 4))
    assert all(len(out[5 * k + i]) == 4 for k in range(40) for i in (0, 1))


def test_lines_odd_rows(sc):
    docs = frame(sc, ODD).withColumn("gram", F.lit(1)).withColumn("runs", F.lit("x"))
    docs = docs.union(docs.where("doc_id = 9")).union(docs.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    out = line_dedup.stage(docs)
    assert out.columns == docs.columns and out.count() == len(ODD) + 2
    assert out.where("doc_id = 9 and text <> ''").count() == 2 and out.where("doc_id = 10 and text = ''").count() == 1
    assert line_dedup.stage(docs.limit(0)).count() == 0


# ---- 6 BPE


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return Tokenizer.from_file(path), bpe.load(path)


def test_bpe_equals_the_library_on_every_character(reference):
    lib, mine = reference
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(4)
    texts = ["".join(f"a{c} {c}1{c}" for c in every[k : k + 5000]) for k in range(0, len(every), 5000)]
    texts += ["".join(rng.choice(["a", " ", "\n", "1", "é", "'s", "the", "<|endoftext|>", "漢", "\t", "!!"]) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [t or "" for t in ODD] + ["z" * 4000, "ab" * 999, "!" * 700]
    ids = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    got = mine.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == ids
    assert [mine.decode(g) for g in got] == [lib.decode(i, skip_special_tokens=False) for i in ids]


def test_bpe_pieces_of_long_texts_and_small_caches(reference, monkeypatch):
    lib, _ = reference
    monkeypatch.setattr(bpe, "PIECE", 64)
    monkeypatch.setattr(bpe, "WORDS", 10)
    monkeypatch.setattr(bpe, "CACHE", 25)
    mine = bpe.Bpe(public_tokenizers.path("byte_bpe_50k.json"))
    text = "Some words, 123 numbers\n\n  and <|endoftext|> more of them " * 40
    assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    assert mine.decode(mine.encode([text])[0]) == text


def test_bpe_query_digests(sc, reference):
    lib, _ = reference
    docs = sc.read.parquet(f"{SF}/documents.parquet").collect()
    out = {r["doc_id"]: r for r in QUERIES["op6_bpe_round_trip"](sc, SF).collect()}
    for d in docs:
        ids = lib.encode(d["text"], add_special_tokens=False).ids
        r = out[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()
    made = bpe.encode_and_decode(frame(sc, ODD).withColumn("ids", F.lit(1)), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in made)


# ---- 8 SimHash


def plain_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values, linked):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_fingerprints_follow_the_definition(monkeypatch):
    texts = [t or "" for t in ODD] + ["A B C d e", "ÀB one\x0btwo\x1cthree four five", "a b c", "x"]
    for slice_bytes in (1 << 20, 7):
        monkeypatch.setattr(simhash, "SLICE", slice_bytes)
        assert [simhash.fingerprint(t, 4) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_simhash_groups_equal_brute_force(sc):
    docs = sc.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain_fingerprint(d["text"]) for d in docs]
    want = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    out = {r["doc_id"]: r for r in QUERIES["op8_simhash_near_dedup"](sc, "/root/testdata/sf0.01").collect()}
    assert [out[d["doc_id"]]["fingerprint"] for d in docs] == [f"{f:016x}" for f in fps]
    assert [out[d["doc_id"]]["component_id"] for d in docs] == [docs[w]["doc_id"] for w in want]


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 6])
def test_pigeonhole_links_equal_all_pairs(sc, max_bits, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)  # hot values are cut into blocks
    rng = random.Random(max_bits)
    centres = [rng.getrandbits(64) for _ in range(8)] + [0]
    values = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(40)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = plain_components(values, lambda a, b: (a ^ b).bit_count() <= max_bits)
    edges = simhash.links(sc.createDataFrame([(v,) for v in signed], "fp long"), max_bits)
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    got = [found.get(v, v) for v in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_thresholds_are_the_cheapest_that_are_safe():
    assert simhash.allocate([[0, 1, 50, 90], [0, 100, 200, 300], [0, 2, 3, 90]], 0) == [0, -1, 1]
    for m in (2, 3, 4, 5):
        n, both = 1000, np.full((64, 64), 250.0) + np.eye(64) * 250
        parts, chosen, _ = simhash.plan(n, both, m, 4)
        assert sorted(b for p in parts for b in p) == list(range(64)) and sum(chosen) == 4 - m + 1 and min(chosen) >= -1


def test_keep_one_of_each_group(sc):
    docs = frame(sc, [*ODD, *ODD]).withColumn("fp", F.lit(1)).withColumn("first", F.lit(2))
    kept = simhash.keep_one(docs)
    groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert kept.columns == docs.columns and kept.count() == groups
    assert simhash.keep_one(docs.limit(0)).count() == 0
    twice = docs.union(docs)
    assert simhash.keep_one(twice).count() == groups


# ---- 9 mixing


def test_poisson_counts_and_weights(sc):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(6000)]
    docs = sc.createDataFrame(rows, DOCS)
    out = mixing.replicate(docs, {"hot": 1.0, "s0": 1.0, "s1": 2.0, "s2": 0.0, "s3": 0.0, "s4": 4.0}, other=0.0).toPandas()
    share = out["source"].value_counts(normalize=True)
    assert "s2" not in share and abs(share["s4"] - 0.5) < 0.03 and abs(share["hot"] - 0.125) < 0.02
    assert abs(len(out) - 6000) < 400
    copies = out[out["source"] == "s4"].groupby("doc_id").size()
    rate = out.loc[out["source"] == "s4", "__rate"].iloc[0]
    assert abs(copies.sum() / 400 - rate) < 0.4
    assert out["__copy"].min() == 0 and not out.duplicated(["doc_id", "__copy"]).any()


def test_poisson_inversion_is_exact():
    for rate in (0.01, 0.5, 3.0, 40.0, 900.0):
        cdf = mixing.cumulative(rate)
        mean = sum(k * (b - a) for k, (a, b) in enumerate(zip([0, *cdf], cdf)))
        assert abs(mean - rate) < 1e-6 * max(rate, 1) and cdf[-1] <= 1.0 and cdf[-1] > 1 - 1e-15
    assert mixing.cumulative(0) == [1.0]


def test_mixing_odd_rows(sc):
    docs = frame(sc, ODD).withColumn("rate", F.lit(1)).withColumn("source", F.when(F.col("doc_id") > 5, F.col("source")))
    out = mixing.stage(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.stage(docs.limit(0)).count() == 0
    again = Counter(r["doc_id"] for r in mixing.stage(docs.repartition(5)).collect())
    assert again == Counter(r["doc_id"] for r in out.collect())


# ---- 10 sharding


def test_shards_are_exact_and_gapless(sc):
    out = QUERIES["op10_sharding"](sc, SF).toPandas()
    docs = sc.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")["text"]
    assert sorted(out["doc_id"]) == sorted(docs.index)
    sizes = out["shard"].value_counts()
    assert len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    for _, s in out.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    for r in out.itertuples():
        data = docs[r.doc_id].encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data)


def test_hypergeometric_draws():
    import random as r

    rng = r.Random(1)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(20000)]
    assert abs(np.mean(draws) - 6) < 0.06 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.12
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0
    matrix = sharding.communication([10, 0, 7, 100], 24, 3)
    assert [sum(row) for row in matrix] == [10, 0, 7, 100] and [sum(c) for c in zip(*matrix)] == sharding.targets(117, 24)


def test_sharding_odd_rows(sc):
    docs = frame(sc, ODD * 10).withColumn("part", F.lit(1)).withColumn("offset", F.lit(2))
    same = docs.where("doc_id = 0")
    out = sharding.shard(docs.union(same).union(same), shards=4)
    assert out.columns == [*docs.columns, "__shard", "__slot"]
    counts = sorted(r["count"] for r in out.groupBy("__shard").count().collect())
    assert sum(counts) == len(ODD) * 10 + 2 and counts[-1] - counts[0] <= 1
    assert sharding.shard(docs.limit(0)).count() == 0


def test_partitions_and_ranges_follow_the_rows(sc):
    assert sharding.sizes(0, 24) == sharding.sizes(1 << 30, 24) == (512, 8)
    partitions, bits = sharding.sizes(10**11, 24)
    assert 10**11 <= partitions * sharding.GROUP_ROWS and 10**11 <= (24 << bits) * sharding.GROUP_ROWS and partitions < 25_000
    assert sharding.sizes(700, 2, 4, 1) == (700, 9)
    docs = sc.range(700).selectExpr("id as doc_id", "concat('t', id % 9) as text")
    rows = sharding.shard(docs, shards=2, partitions=4, group_rows=1).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(700))
    assert all(sorted(r["__slot"] for r in rows if r["__shard"] == s) == list(range(350)) for s in (0, 1))


def test_written_shards_keep_texts_in_slot_order(sc, tmp_path):
    sharding.write_shards(frame(sc, ODD * 4), str(tmp_path / "out"), shards=3)
    back = sc.read.parquet(str(tmp_path / "out")).collect()
    assert Counter(r["text"] for r in back) == Counter(ODD * 4) and {r["shard"] for r in back} == {0, 1, 2}


# ---- callers' columns and rows without an id


def test_null_ids_keep_one_row_of_every_group(sc):
    words = [" ".join(f"{w}{k}" for k in range(60)) for w in ("apple", "stone", "river")]
    rows = [(None, words[0], "x"), (None, words[1], "x"), (None, words[0], "x"), (4, words[2], "x"), (None, words[2], "x"), (2, words[2], "x")]
    docs = sc.createDataFrame(rows, "doc_id long, text string, __text_key string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and {(r.doc_id, r.text) for r in got.collect()} == {(None, words[0]), (None, words[1]), (2, words[2])}


def test_callers_columns_with_inner_names_come_back(sc):
    names = ["__n", "__u", "__copy", "__rate", "__order", "__runs", "__key", "__rid", "__shard", "__slot", "__U_", "kept_n"]
    line = "a line of quite many words that stands in more than one document of them all"
    docs = frame(sc, [f"{line}\nown {k}" for k in range(4)]).select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in names])
    for made in (line_dedup.stage(docs), mixing.stage(docs), simhash.keep_one(docs)):
        assert made.columns == docs.columns
        assert all(r[c] == f"{c}{r['doc_id']}" for r in made.collect() for c in names)
    out = sharding.shard(docs)
    assert sorted(r["__slot"] for r in out.where("__shard = 0").collect()) == list(range(out.where("__shard = 0").count()))
    rows = out.collect()
    assert len(rows) == 4 and all(r["__rid"] == f"__rid{r['doc_id']}" and r["__slot_"] == f"__slot{r['doc_id']}" and r["__shard_"] == f"__shard{r['doc_id']}" for r in rows)
    assert all(r["__copy_"] == f"__copy{r['doc_id']}" and r["__copy"] >= 0 for r in mixing.replicate(docs).collect())
