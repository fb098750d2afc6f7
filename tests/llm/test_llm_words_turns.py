"""Spelling variants, SentencePiece and conversation repair against brute force and the library, and their defined cases."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tillstream.llm import pieces, spelling, turns
from tillstream.llm.common import session
from tillstream.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sc(spark):
    return session(spark)


# ---- 11 spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}


def plain_variants(n):
    gone = {}
    for w in n:  # candidates share the word itself or a word with one letter deleted
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            gone.setdefault(x, set()).add(w)
    near = {w: set() for w in n}
    for ws in gone.values():
        for a in ws:
            near[a] |= {b for b in ws if b != a and one_edit(a, b)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def shown(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_variants_of_the_corpus_equal_brute_force(sc):
    docs = [(r.doc_id, r.text) for r in sc.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_variants(vocabulary(docs))
    assert shown(QUERIES["op11_spelling_variants"](sc, SF)) == want and any(w[1] for w in want)


@pytest.mark.parametrize(("letters", "low", "high", "count", "most"), [("ab", 7, 11, 700, 5), ("abcé", 7, 9, 900, 2000), ("aÿ", 1, 6, 90, 2), ("x", 1, 40, 60, 1)])
def test_near_words_of_hot_lists(sc, letters, low, high, count, most):
    rng = random.Random(count)
    ws = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(count)})
    got = spelling.near_words(sc.createDataFrame([(w, 2) for w in ws], "word string, n long"), most)
    assert sorted((r.word, r.near) for r in got.collect()) == [(a, b) for a in ws for b in ws if a != b and one_edit(a, b)]


def test_forms_ties_chains_and_long_words(sc):
    n = {"zzzaaaa": 2, "zzzaaab": 20, "zzzaaac": 20, "zzzaabb": 200, "zzzabbb": 2000, "b" * 5000: 3, "b" * 5001: 30, "lonely": 9, "lonelyx": 89}
    got = {r[0]: r[1:3] for r in shown(spelling.variants(sc.createDataFrame(list(n.items()), "word string, n long")))}
    assert got["zzzaaaa"] == ("zzzaaab", "zzzabbb") and got["zzzaaac"] == ("", "zzzaaac") and got["zzzabbb"] == ("", "zzzabbb")
    assert got["b" * 5000] == ("b" * 5001, "b" * 5001) and got["lonely"] == ("", "lonely")


def test_words_of_odd_tables(sc):
    docs = [(None, "Elephants elephants"), (1, None), (1, ""), (2, "ÀÉelephants x elephants-elephants"), (2, "ÀÉelephants"), (3, "w" * 40000), (3, "w" * 40000)]
    df = sc.createDataFrame([(*r, "key", 7) for r in docs], "doc_id long, text string, word string, n int")
    assert {r.word: r.n for r in spelling.words(df).collect()} == vocabulary(docs)
    assert spelling.variants(spelling.words(df.limit(0))).count() == 0
    assert {r.word for r in spelling.words(df, damage=0).collect()} == {"elephants", "ÀÉelephants", "w" * 40000}


# ---- 12 SentencePiece

ALPHABET = ["a", "b", "the", " ", "  ", "\n", ".", ",", "▁", "日", "語", "𝒳", "é", "\x00", "0", "12", "</s>", "ing", "\t", "　", "é", "🙂", "ß", "ｱ", "ﾞ", "ﬁ", "①", "¨", "\xa0", "½", "㈱", "́", "\r", "​", "ᄀ", "ᅡ"]


def mixtures(seed, count):
    rng = random.Random(seed)
    odd = ["", " ", "  a", "\n", "x" * 3000, "▁" * 100, " " * 45, "ab " * 9000, "a" * 70 + "é" * 70]
    return odd + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(50))) for _ in range(count)]


def same_as_library(own, lib, texts):
    for text, (ids, spans), want in zip(texts, own.encode(texts), lib.encode(texts), strict=True):
        assert ids.tolist() == want, text[:80]
        assert own.decode(ids) == lib.decode(want)
        assert spans.tolist() == [[p.begin, p.end] for p in lib.encode(text, return_type="proto").pieces]


def test_pieces_and_spans_equal_the_library(monkeypatch):
    own, lib = pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    same_as_library(own, lib, mixtures(1, 1500))
    monkeypatch.setattr(pieces, "PIECE", 7)
    monkeypatch.setattr(pieces, "CACHE", 50)
    same_as_library(own, lib, mixtures(2, 200))


def test_equal_parts_are_gathered_exactly(monkeypatch):
    own, lib = pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    code = np.frombuffer("abcabab".encode("utf-32-le"), "<u4")
    begin, size = np.array([0, 3, 5]), np.array([3, 2, 2])
    first, same = pieces.distinct(code, begin, size)
    assert len(first) == 2 and same[1] == same[2] != same[0] and first[same].tolist() == [0, 1, 1]
    looked = []
    monkeypatch.setattr(own, "learn", lambda parts, real=own.learn: (looked.extend(parts), real(parts)))
    own.encode(["one two one two"] * 50)
    assert len(looked) == len(set(looked)) < 10
    monkeypatch.setattr(pieces, "FACTOR", np.uint64(0))  # every hash the same: parts are told apart by their characters
    assert pieces.distinct(code, begin, size)[1].tolist() == [0, 1, 1]
    same_as_library(own, lib, mixtures(5, 100))


@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_compiled_map_equals_the_library(squeeze, prefix):
    model, rules = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    spec = model.normalizer_spec
    spec.precompiled_charsmap, spec.remove_extra_whitespaces, spec.add_dummy_prefix = rules.normalizer_spec.precompiled_charsmap, squeeze, prefix
    data = model.SerializeToString()
    same_as_library(pieces.Pieces(data), sentencepiece.SentencePieceProcessor(model_proto=data), mixtures(3, 600))


def test_any_ids_decode_as_the_library():
    own, lib, rng = pieces.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, "int64")) == lib.decode(ids)


def test_round_trip_query_equals_the_library(sc):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in sc.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = QUERIES["op12_sentencepiece_round_trip"](sc, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = lib.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))


def test_pieces_of_odd_tables_and_models(sc):
    rows = [(1, None, 3), (1, "", 4), (None, "é 日", 5), (2, "é 日", 5)]
    made = pieces.encode_and_decode(sc.createDataFrame(rows, "doc_id long, text string, ids int"), MODEL).collect()
    assert [(list(r.ids), r.decoded) for r in made[:2]] == [([2], ""), ([2], "")]
    assert made[2].decoded == "é 日" and made[2].ends[-1] == 6 and list(made[2].ids) == list(made[3].ids)
    with open(MODEL, "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError, match="BPE"):
        pieces.Pieces(model.SerializeToString())


# ---- 13 conversations

SPACES = " \t\n\x0b\x0c\r"
TALK = "conv_id long, turn long, role string, text string"


def after_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        conv_shown, turn_shown = (" " if v is None else v for v in (conv, turn))
        k = zlib.crc32(f"{conv_shown}:{turn_shown}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(k, text)
        out.setdefault(conv, []).extend([(turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1))
    for rs in out.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def cheapest(rows, faults):
    """(cost, audit, lines) by plain recursion over suffixes; at most two inserts in a row can help."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def go(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def way(cost, letter, row, *rest):
            if (r := go(*rest)) is not None:
                ways.append((cost + r[0], letter + r[1], ((row,) if row else ()) + r[2]))

        for role in ("user", "assistant"):
            if inserts < 2 and role[0] in follows[last]:
                way(5, "I", (role, ""), i, role[0], inserts + 1)
        if i < len(rows):
            role, text = rows[i]
            way(2, "D", None, i + 1, last, 0)
            if faults[i] not in ("blank", "duplicate"):
                for new, cost, letter in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if new[0] in follows[last]:
                        way(cost + 5 * (faults[i] == "truncated"), letter, (new, text), i + 1, new[0], 0)
        return min(ways, key=lambda w: w[:2]) if ways else None

    sys.setrecursionlimit(20000)
    return go(0, "", 0)


def plain_repair(rows):
    out = []
    for conv, rs in after_damage(rows).items():
        seen, faults = set(), []
        for _, role, text in rs:
            end = text.rstrip(SPACES)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        starts = [r[1][0] for r in rs]
        at = [r[0] for r in rs if r[0] is not None]
        cost, audit, kept = cheapest([r[1:] for r in rs], faults)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in kept))
        lines = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((
            conv, max(at) - min(at) + 1 - len(set(at)) if at else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:])), cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def repaired(df):
    return sorted(map(tuple, turns.repair(df).collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9, 14])):
            text = rng.choice(["Hi.", "Yes?", "ok", "", " \n", "x y.", "And so on!", None, "é. \t", f"q{rng.random()}.", "long " * 3000])
            rows.append((conv, None if rng.random() < 0.05 else turn + 3 * (rng.random() < 0.05), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), text))
    hot = [(7777, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", "", f"n{t}."])) for t in range(200)]
    return rows + hot + [(7777, 5, "user", "same.")] * 30


@pytest.mark.parametrize("bits", [12, 2])
def test_repair_equals_plain_search(sc, monkeypatch, bits):
    monkeypatch.setattr(turns, "BLOCK_BITS", bits)  # 2: a conversation is parsed in blocks of four rows
    monkeypatch.setattr(turns, "LINES", 20)
    rows = talks(bits)
    assert repaired(sc.createDataFrame(rows, TALK)) == plain_repair(rows)


def test_repair_query_equals_plain_search(sc):
    rows = [tuple(r) for r in sc.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op13_conversation_repair"](sc, SF)
    assert sorted(map(tuple, out.collect())) == plain_repair(rows)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_of_odd_tables(sc):
    assert turns.repair(sc.createDataFrame([], TALK)).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone.")] + [(3, None, None, None)] * 5
    df = sc.createDataFrame(rows, TALK).withColumn("pos", F.lit(1)).withColumn("fault", F.lit("x")).withColumn("block", F.lit(0))
    got = repaired(df)
    assert got == plain_repair(rows)
    assert next(g for g in got if g[0] == dropped)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
