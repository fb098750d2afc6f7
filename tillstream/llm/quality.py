"""Quality classifier: a byte-level convolutional network in numpy (operator 1).

A document is its UTF-8 bytes. Each byte, together with a flag that marks text which repeats itself a
few bytes further back, is embedded; learned filters of ``2 * STEP`` bytes slide over the whole document
in steps of ``STEP``; their rectified responses are averaged in overlapping chunks of ``2 * HALF`` bytes;
each filter's largest chunk, over all chunks of the document, goes into one logistic unit.

Training reads a bounded sample of whole texts: labelled rows outside the held-out fold in the order of a hash of their
id, at most ``max_rows`` of them and as many as come to ``max_chars`` characters (a longer text is not drawn). Scoring and
training read every byte of every text, in slices; scoring's memory does not grow with a text.

Defined cases: a null text is scored as an empty one; an empty text has no chunk, so its pooled
responses are zero and it gets the bias's probability; without labels, or with one class only, every
document gets the share of good labels (0.5 without any). Rows that repeat an id are scored one by one; of
several labels of one id the largest counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, text_key

STEP = 4
WIDTH = 8
FILTERS = 24
HALF = 64
#: Distances in bytes at which a byte may repeat an earlier one, and bytes that must repeat in a row.
LAGS = range(3, 25)
REPEAT = 8
#: Byte that no UTF-8 text holds, and its symbol.
PAD = 255
BLANK = 512
#: Bytes scored at a time, a multiple of HALF.
SLICE = 1 << 18
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 30_000_000
EPOCHS = 3


@dataclass
class Model:
    embed: np.ndarray  # (513, WIDTH): byte, byte in a repeat, padding (zero)
    kernel: np.ndarray  # (STEP * WIDTH, 2 * FILTERS): both halves of a filter side by side
    shift: np.ndarray  # (FILTERS,)
    weight: np.ndarray  # (FILTERS,)
    bias: float


def symbols(data: np.ndarray) -> np.ndarray:
    """Byte values, plus 256 where the last ``REPEAT`` bytes equal those some lag before; padding is ``BLANK``."""
    flag = np.zeros(len(data), bool)
    for lag in LAGS:
        same = data[lag:] == data[:-lag]
        width = 1
        while width < REPEAT:
            same = same[width:] & same[:-width]
            width *= 2
        flag[lag + REPEAT - 1 :] |= same
    sym = data.astype("int16") + np.where(flag, np.int16(256), np.int16(0))
    sym[data == PAD] = BLANK
    return sym


@dataclass
class Batch:
    sym: np.ndarray  # symbols of all pieces, each padded to whole halves and followed by a blank half
    first: np.ndarray  # first half of each piece
    halves: np.ndarray  # halves of each piece that start a chunk
    doc: np.ndarray  # document of each piece


def lay_out(texts: list[bytes]) -> Iterator[Batch]:
    """Documents side by side, about ``SLICE`` bytes at a time. A long text becomes several pieces which overlap
    so that every chunk is whole in one of them."""
    data, first, halves, doc, at = [], [], [], [], 0
    for d, text in enumerate(texts):
        raw = np.frombuffer(text, "u1")
        for lo in range(0, len(raw), SLICE):
            before = min(lo, HALF)  # what the repeat flags look back on
            piece = raw[lo - before : lo + SLICE + 2 * HALF]
            n = -(-len(piece) // HALF)
            data += [piece, np.full((n + 1) * HALF - len(piece), PAD, "u1")]
            first.append(at + before // HALF)
            halves.append(min(n - before // HALF, SLICE // HALF))
            doc.append(d)
            at += n + 1
            if at * HALF >= SLICE:
                yield Batch(symbols(np.concatenate(data)), np.array(first), np.array(halves), np.array(doc))
                data, first, halves, doc, at = [], [], [], [], 0
    if data:
        yield Batch(symbols(np.concatenate(data)), np.array(first), np.array(halves), np.array(doc))


def _responses(m: Model, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block embeddings, rectified responses, and the mean response of the chunk that starts at each half."""
    blocks = m.embed[sym].reshape(-1, STEP * WIDTH)
    both = blocks @ m.kernel
    out = both[:, :FILTERS]
    out[:-1] += both[1:, FILTERS:]
    out += m.shift
    np.maximum(out, 0, out=out)
    blank = sym[::STEP] == BLANK
    out[blank] = 0
    sums = out.reshape(-1, HALF // STEP, FILTERS).sum(1)
    sums[:-1] += sums[1:].copy()
    sums /= _positions(blank)[:, None]
    return blocks, out, sums


def _positions(blank: np.ndarray) -> np.ndarray:
    """Positions with text in the chunk that starts at each half (1 where there is none)."""
    counts = (~blank).reshape(-1, HALF // STEP).sum(1)
    counts[:-1] += counts[1:].copy()
    return np.maximum(counts, 1).astype("float32")


def pooled(m: Model, texts: list[str | None]) -> np.ndarray:
    """(documents, FILTERS): the largest chunk response over each whole text, zero for an empty text."""
    best = np.zeros((len(texts), FILTERS), "float32")
    for x in lay_out([_bytes(t) for t in texts]):
        chunks = _responses(m, x.sym)[2]
        spans = np.column_stack([x.first, x.first + x.halves]).ravel()
        np.maximum.at(best, x.doc, np.maximum.reduceat(chunks, spans, axis=0)[::2])
    return best


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def probability(m: Model, best: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(best.astype("float64") @ m.weight.astype("float64") + m.bias, -30, 30)))


def constant(share: float) -> Model:
    """A model that gives every text the same probability."""
    p = min(max(share, 1e-6), 1 - 1e-6)
    zero = np.zeros((BLANK + 1, WIDTH), "float32"), np.zeros((STEP * WIDTH, 2 * FILTERS), "float32")
    return Model(*zero, np.zeros(FILTERS, "float32"), np.zeros(FILTERS, "float32"), float(np.log(p / (1 - p))))


def train(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit by Adam on batches of 16 documents; gradients pass through each filter's largest chunk."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return constant(share)
    rng = np.random.default_rng(seed)
    m = Model(
        rng.normal(0, 0.5, (BLANK + 1, WIDTH)).astype("float32"),
        rng.normal(0, (STEP * WIDTH) ** -0.5, (STEP * WIDTH, 2 * FILTERS)).astype("float32"),
        np.zeros(FILTERS, "float32"),
        rng.normal(0, 0.1, FILTERS).astype("float32"),
        0.0,
    )
    m.embed[BLANK] = 0
    bias = np.array([np.log(share / (1 - share))], "float32")
    params = [m.embed, m.kernel, m.shift, m.weight, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    data = [_bytes(t) for t in texts]
    turn, steps = 0, epochs * -(-len(data) // 16)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(data), 16):
            batch = order[start : start + 16]
            m.bias = float(bias[0])
            turn += 1
            rate = 0.01 * (1 - 0.95 * turn / steps)
            for p, g, a, b in zip(params, _gradient(m, [data[d] for d in batch], labels[batch]), first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= (rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.99**turn)) + 1e-6)).astype("float32")
            m.embed[BLANK] = 0
    m.bias = float(bias[0])
    return m


def _gradient(m: Model, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
    """Mean gradient of the logistic loss. A filter's gradient goes to its first largest chunk, whichever piece of a text holds it."""
    per, cols = HALF // STEP, np.arange(FILTERS)
    parts = list(lay_out(texts))
    held = [_responses(m, parts[0].sym)] if len(parts) == 1 else []  # one layout is kept, several are computed again
    best = np.zeros((len(texts), FILTERS), "float32")
    tops = []
    for i, x in enumerate(parts):
        chunks = (held[i] if held else _responses(m, x.sym))[2]
        tops.append(np.stack([f + chunks[f : f + n].argmax(0) for f, n in zip(x.first, x.halves, strict=True)]))
        np.maximum.at(best, x.doc, chunks[tops[i], cols])
    err = (probability(m, best) - labels).astype("float32")
    total = [np.zeros_like(m.embed), np.zeros_like(m.kernel), np.zeros_like(m.shift), err @ best, err.sum(keepdims=True)]
    taken = np.zeros(best.shape, bool)
    for i, x in enumerate(parts):
        blocks, resp, chunks = held[i] if held else _responses(m, x.sym)
        top = tops[i]
        mine = chunks[top, cols] == best[x.doc]
        for j, d in enumerate(x.doc):
            mine[j] &= ~taken[d]
            taken[d] |= mine[j]
        size = _positions(x.sym[::STEP] == BLANK)[top]
        rows = top[:, None, :] * per + np.arange(2 * per)[None, :, None]  # (piece, position, filter)
        g = np.where((resp[rows, cols] > 0) & mine[:, None, :], (err[x.doc, None] * m.weight / size)[:, None, :], 0).astype("float32")
        total[2] += g.sum((0, 1))
        flat = np.zeros((len(blocks) + 1, 2 * FILTERS), "float32")
        np.add.at(flat, (rows, cols), g)
        np.add.at(flat, (rows + 1, cols + FILTERS), g)
        used = np.flatnonzero(flat[:-1].any(1))
        total[1] += blocks[used].T @ flat[used]
        np.add.at(total[0], x.sym.reshape(-1, STEP)[used].ravel(), (flat[used] @ m.kernel.T).reshape(-1, WIDTH))
    return [t / len(texts) for t in total]


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees: crc32 of the id as text, modulo 5, is 0 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> DataFrame:
    """``(doc_id, quality, text)``: at most ``max_rows`` labelled rows of the training fold and ``max_chars`` characters, whole
    texts in the order of a hash of the id."""
    known = labels.select("doc_id", "quality").where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    drawn = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    # the drawn ids are at most max_rows, a parameter
    known = docs.select("doc_id", "text", n.alias("n")).where(F.col("n") <= max_chars).join(F.broadcast(drawn), "doc_id")
    rows = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id", text_key()).limit(max_rows).withColumn("at", F.monotonically_increasing_id()), "sample")
    # one task: max_rows numbers
    total = F.sum("n").over(W.orderBy(F.xxhash64("doc_id"), "doc_id", "at").rowsBetween(W.unboundedPreceding, 0))
    within = rows.select("at", total.alias("total")).where(F.col("total") <= max_chars)
    return rows.join(F.broadcast(within), "at").orderBy(F.xxhash64("doc_id"), "doc_id", "at").select("doc_id", "quality", "text")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> Model:
    rows = sample(docs, labels, max_rows, max_chars).collect()
    return train([r["text"] for r in rows], np.array([float(r["quality"]) for r in rows]))


def scorer(model: Model) -> Callable[[Column], Column]:
    """Vectorised UDF: text -> probability of label 1."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(probability(model, pooled(model, list(texts))))

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every row; labels, source, language and id are no inputs of the score."""
    return docs.select(F.col(id_col).alias("doc_id"), scorer(model)(F.col(text_col)).alias("score"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """``docs`` without the rows scored under ``least``."""
    return docs.where(scorer(model)(F.col("text")) >= least)
