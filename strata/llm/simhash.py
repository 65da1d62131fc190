"""Operator 3, SimHash near-dedup by a byte-position inverted index with count filtering.

A 64-bit fingerprint has 8 positional bytes. Two that differ in at most
``max_bits`` bits share at least ``8 - max_bits`` of them (the guaranteed
minimum). The index posts each distinct fingerprint under sets of positions
chosen so that every set of that many shared positions holds one; fingerprints
of one posting are compared: their shared positional bytes are tallied, pairs
below the minimum drop out, and the rest are verified by their bit distance.
A posting yields a spanning forest of its links, never all of its pairs.

A posting of more than ``POSTING`` fingerprints is split: of its free bits, cut
into ``max_bits + 1`` runs, a linked pair must also share one run entirely, so
its members are posted again under each longer key. At 13 free bits a posting
cannot exceed the bound, so this ends, and no link is lost.

Defined results
  null text: like an empty one, fingerprint zero; fewer words than a shingle:
  one shingle of all words; documents with equal fingerprints are linked;
  repeated rows and equal ids: each row is returned; null ids are ignored in
  ``component_id``, which is null only if no row of the component has an id;
  ties: of a group's rows the least id stays, of equal ids that of the least text hash; very long
  texts: all shingles hashed, a few texts to a batch; empty table: no rows; extra columns are
  ignored (or carried by ``first_of_each``), whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, small_batches
from strata.llm.graph import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints of a posting that are compared in one task, at most.
POSTING = 8192
FULL = (1 << 64) - 1


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint: a bit is 1 if set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: n - 1]]
    ends = ends[-n:]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = zip(starts[at:at + 65536], ends[at:at + 65536])
        h = np.array([xxhash.xxh64_intdigest(joined[s:e - 1], SEED) for s, e in part], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, shingle: int, out: str) -> DataFrame:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], "<u8").view("<i8"))

    small_batches(docs.sparkSession)
    return docs.withColumn(out, prints(F.col(text_col)))


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which any ``8 - max_bits`` positions hold at least one.

    For four or more shared positions: three classes of positions, and the
    triples inside a class or with two members in a class and one in the next.
    """
    shared = 8 - max_bits
    if shared < 1:
        raise ValueError("max_bits must be at most 7")
    if shared < 4:
        return list(itertools.combinations(range(8), shared))
    kind = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for t in itertools.combinations(range(8), 3):
        k = [kind[i] for i in t]
        twice = [x for x in set(k) if k.count(x) == 2]
        if len(set(k)) == 1 or twice and (twice[0] + 1) % 3 in k:
            out.append(t)
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def longer_masks(mask: int, max_bits: int) -> list[int]:
    """The mask with each run of its free bits added, ``max_bits + 1`` runs in all."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in run) for run in np.array_split(free, max_bits + 1) if len(run)]


def _near(a, others: np.ndarray, max_bits: int) -> np.ndarray:
    x = np.ascontiguousarray(others ^ a)
    tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(1)
    near = tally >= 8 - max_bits
    near[near] = np.bitwise_count(x[near]) <= max_bits
    return near


def forest(f: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among distinct fingerprints: a search from each node."""
    out, rest = [], f
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            a = todo.pop()
            near = _near(a, rest, max_bits)
            if near.any():
                found, rest = rest[near], rest[~near]
                out.append((np.full(len(found), a), found))
                todo.extend(found)
    return out


def _links(key: np.ndarray, f: np.ndarray, max_bits: int) -> pd.DataFrame:
    """Links within the runs of equal keys (rows come sorted by key)."""
    out = []
    start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
    size = np.diff(np.r_[start, len(f)])
    few = np.repeat(size <= 8, size)
    for d in range(1, int(size[size <= 8].max(initial=1))):
        at = np.flatnonzero(few[:-d] & (key[d:] == key[:-d]).all(1))
        near = _near(f[at], f[at + d], max_bits)
        out.append((f[at][near], f[at + d][near]))
    for s, n in zip(start[size > 8], size[size > 8]):
        out += forest(f[s:s + n], max_bits)
    u, v = (np.concatenate([x[i] for x in out]) if out else np.zeros(0, "<u8") for i in (0, 1))
    return pd.DataFrame({"u": u.view("<i8"), "v": v.view("<i8")})


def _posting_links(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            key = pdf[["mask", "bits"]].to_numpy()
            last = int(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])[-1])
            held = pdf.iloc[last:]
            if last:
                yield _links(key[:last], pdf["f"].to_numpy()[:last].astype("<i8").view("<u8"), max_bits)
        if held is not None and len(held):
            yield _links(held[["mask", "bits"]].to_numpy(), held["f"].to_numpy().astype("<i8").view("<u8"), max_bits)
    return run


def _reposted(max_bits: int):
    """Each fingerprint under every longer key of the posting it was in."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longer: dict[int, np.ndarray] = {}
        for pdf in batches:
            for mask, rows in pdf.groupby("mask"):
                if mask not in longer:
                    longer[mask] = np.array([_signed(k) for k in longer_masks(int(mask) & FULL, max_bits)], np.int64)
                kids = longer[mask]
                yield pd.DataFrame({"f": np.repeat(rows["f"].to_numpy(), len(kids)), "mask": np.tile(kids, len(rows))})
    return run


def _posted(prints: DataFrame, masks: Column) -> DataFrame:
    return (prints.select("f", F.explode(masks).alias("mask"))
            .withColumn("bits", F.col("f").bitwiseAND(F.col("mask"))))


def links(prints: DataFrame, max_bits: int = MAX_BITS, posting: int = POSTING) -> DataFrame:
    """Edges ``u, v`` that connect the distinct fingerprints of column ``f`` as the links do."""
    byte_masks = [sum(0xFF << 8 * p for p in t) for t in position_sets(max_bits)]
    posted = _posted(prints, F.array(*[F.lit(_signed(m)) for m in byte_masks]))
    found = []
    while True:
        heavy = cut(posted.groupBy("mask", "bits").count().filter(F.col("count") > posting).drop("count"), "heavy")
        split = not heavy.isEmpty()
        light = posted.join(heavy, ["mask", "bits"], "left_anti") if split else posted
        found.append(cut(light.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
                         .mapInPandas(_posting_links(max_bits), "u long, v long"), "links"))
        if not split:
            break
        again = posted.join(heavy, ["mask", "bits"], "left_semi").select("f", "mask")
        posted = cut(again.mapInPandas(_reposted(max_bits), "f long, mask long").distinct()
                     .withColumn("bits", F.col("f").bitwiseAND(F.col("mask"))), "longer")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _members(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int,
             posting: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, f)``, and for each distinct ``f`` the ``first`` row of its component:
    the least of (without an id, id, text hash)."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    rows = cut(with_fingerprint(rows, "_text", shingle, "f").select(
        "doc_id", F.xxhash64(text).alias("h"), "f"), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "h")
    prints = cut(rows.groupBy("f").agg(F.min(first).alias("first")), "distinct")
    roots = components(links(prints.select("f"), max_bits, posting))
    nodes = cut(prints.join(roots.withColumnRenamed("node", "f"), "f", "left")
                .withColumn("root", F.coalesce("root", "f")), "nodes")
    least = nodes.groupBy("root").agg(F.min("first").alias("first"))
    return rows, nodes.drop("first").join(least, "root").select("f", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, posting: int = POSTING) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row."""
    rows, member = _members(docs, id_col, text_col, shingle, max_bits, posting)
    return rows.join(member, "f").select(
        "doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = SHINGLE, max_bits: int = MAX_BITS, posting: int = POSTING) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the least
    id stays (a row without an id only where no other is). If that id repeats, the row with
    the least text hash stays, and of rows equal in both the least by its other columns."""
    names = docs.columns
    _, member = _members(docs, id_col, text_col, shingle, max_bits, posting)
    keys = ["_missing", "_id", "_h"]
    keep = member.select("first").distinct().select(
        F.col("first.missing").alias("_missing"), F.coalesce("first.doc_id", F.lit(0)).alias("_id"),
        F.col("first.h").alias("_h"))
    rows = docs.select(F.struct(*[F.col(c).alias(f"in_{c}") for c in names]).alias("r"),
                       F.col(id_col).isNull().alias("_missing"), F.coalesce(F.col(id_col), F.lit(0)).alias("_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"))
    others = F.struct(*[F.col(f"r.in_{c}").cast("string") for c in names if c != text_col])
    one = rows.join(keep, keys, "left_semi").groupBy(*keys).agg(F.min_by("r", others).alias("r"))
    return one.select(*[F.col(f"r.in_{c}").alias(c) for c in names])
