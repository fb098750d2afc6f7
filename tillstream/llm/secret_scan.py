"""Secret scan with corpus-wide ownership frequency (operator 2).

Base kinds, each found leftmost and non-overlapping in the whole text: ``assign`` (a value assigned to a
secret's name), ``access`` (access key ids) and ``hex`` (long lower-case hexadecimal runs). The method adds
candidates of kind ``owned``: other long mixed tokens that touch no base span.

Every candidate's value is hashed (128 bits) and the hashes are counted by distinct repositories (a document
is one) and owners (``source``) over the whole corpus. A value with at most ``max_owners`` owners and at most
``max_repositories`` repositories is specific to its owner and looks live; one that more share is a copied example, also
when all its copies lie with one owner. Tokens of the added kind become spans only if they look live; base spans always
stay, the columns ``n_live`` and ``n_copied`` tell how many of a document's candidates are of either sort, and
every span carries both counts.

Scale: a document hands on its spans and hashes only. Counting goes in three steps with partial sums (rows of one
repository, repositories of one owner, owners), so no task gathers the owners or the documents of a value; the
counts are joined back from written tables, whose hot hashes Spark can split.

Defined cases: a null text counts as empty; a null source is an owner of its own; rows without an id are one
repository for each text; rows equal in id and text are scanned one by one and agree; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_key

#: Span kinds in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
NAMES = ("passw", "secret", "token", "api")
# Greedy runs are maximal, so a run that is long enough from its first character is what the plain class finds.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
MAX_OWNERS = 2
MAX_REPOSITORIES = 8


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, stop, value)`` of every candidate, sorted; kind is a place in ``KINDS``."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    base = sorted((s, e) for s, _, e, _ in out)
    at = 0
    for m in TOKEN.finditer(text):
        v = m.group()
        if not (re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v)):
            continue
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        if at == len(base) or base[at][0] >= m.end():
            out.append((m.start(), 3, m.end(), v))
    return sorted(out)


def _scan_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for x in batches:
        rows = []
        for t in x:
            found = scan(t) if isinstance(t, str) else []
            h = np.frombuffer(b"".join(hashlib.blake2b(v.encode(), digest_size=16).digest() for *_, v in found), "i8").reshape(-1, 2)
            rows.append([np.array([f[k] for f in found], "i4") for k in range(3)] + [h[:, 0], h[:, 1]])
        yield pd.DataFrame({c: [r[k] for r in rows] for k, c in enumerate(("start", "kind", "stop", "h1", "h2"))})


def ownership(found: DataFrame) -> DataFrame:
    """``(h1, h2, repositories, owners)`` of rows ``(h1, h2, doc_id, key, source)``."""
    repository = F.when(F.col("doc_id").isNull(), F.col("key"))
    once = found.groupBy("h1", "h2", "source", "doc_id", repository.alias("text")).agg(F.lit(1).alias("one"))
    by_owner = once.groupBy("h1", "h2", "source").agg(F.count("*").alias("n"))
    return by_owner.groupBy("h1", "h2").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))))


def secrets(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``(doc_id, base, spans, n_live, n_copied)``, one row per input row: base spans (start, kind, stop), and all spans that stay
    with their ``repositories`` and ``owners``."""
    scanner = F.pandas_udf(_scan_batches, "start array<int>, kind array<int>, stop array<int>, h1 array<long>, h2 array<long>")
    made = docs.select("doc_id", text_key().alias("key"), "source", scanner("text").alias("f"))
    span = F.arrays_zip("f.start", "f.kind", "f.stop", "f.h1", "f.h2")
    rows = materialize(made.select("doc_id", "key", "source", span.alias("found")), "scanned")
    each = rows.where(F.size("found") > 0).select("doc_id", "key", "source", F.explode("found").alias("f")).select("doc_id", "key", "source", "f.*")
    each = materialize(each, "candidates")
    counts = materialize(ownership(each), "ownership")
    place = F.struct("start", "kind", "stop", "repositories", "owners")
    by_doc = materialize(each.join(counts, ["h1", "h2"]).groupBy("doc_id", "key").agg(F.collect_set(place).alias("judged")), "judged")
    by_doc = by_doc.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "judged")
    joined = rows.join(by_doc, rows["doc_id"].eqNullSafe(by_doc["__id"]) & (rows["key"] == by_doc["__key"]), "left")

    def plain(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))

    def live(s: Column) -> Column:
        return (s["owners"] <= max_owners) & (s["repositories"] <= max_repositories)

    none = F.coalesce("judged", F.array().cast("array<struct<start:int,kind:int,stop:int,repositories:bigint,owners:bigint>>"))
    own = KINDS.index("owned")
    return joined.select(
        "doc_id",
        F.transform(F.filter("found", lambda s: s["kind"] < own), plain).alias("base"),
        F.sort_array(F.filter(none, lambda s: (s["kind"] < own) | live(s))).alias("spans"),
        F.size(F.filter(none, live)).alias("n_live"),
        F.size(F.filter(none, lambda s: ~live(s))).alias("n_copied"),
    )
