"""Operator 10, benchmark decontamination by spaced-seed hashing.

Texts are lower-cased and cut into tokens (runs of ASCII letters, digits, ``_``
and of any other character beyond ASCII). Each fixed mask keeps some positions
of a window and ignores the others, so a substituted token at an ignored
position leaves the window's hash unchanged. The masks cover: with at most 20 % of
the tokens substituted, wherever they stand, any stretch of 12 or more tokens and
any shorter item as a whole has a window that a mask leaves unchanged (so too for
a greater ``overlap`` or ``similarity``, but not for lesser ones). Hashes of every
benchmark window meet those of every training window; around each hit, the two texts are laid on
the hit's diagonal and the longest stretch is taken in which at least
``similarity`` of the tokens agree. A document is contaminated by an item if
that stretch has ``overlap`` tokens, or all of a shorter item's.

At scale: a bitmap over the benchmark's hashes, of ``BITS_A_HASH`` bits for each up to
2 ** ``MAX_BITS`` in all (32 MB), goes to the tasks; only training windows it admits leave
them, with the tokens around, and the join on the hashes themselves then decides which
stretch of text meets which item. Of each such pair one row is made, however many windows
they share: the diagonals are found and verified within it. Copies of a text are looked at
once, by text hash. Both joins have the skew join against a window or an item
that very many documents share.

Defined results
  null and empty texts on either side, and items without an id: never a match; items with fewer than
  ``least`` tokens are not searched for; equal items each get their rows, repeated documents and
  equal ids one row per id and item; ties: of a pair's stretches the longest counts, of equally
  long ones that with more tokens agreeing; very long texts: hashed whole, and verified
  around their hits; a token that is repeated over and over: as many diagonals as tokens, and memory
  in proportion; empty tables: no rows; extra columns on either side, whatever their names, are
  ignored (``clean`` keeps those of the documents).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, cut, small_batches

#: Window positions that each mask keeps (1) or ignores (0).
MASKS = ("1111011", "110010111", "11000100111")
#: The masks for items under 12 tokens, by length; shorter ones still may not differ at all.
SHORT_MASKS = {5: ("1111", "11101", "11011", "10111"), 6: ("11111", "111101", "111011", "110111", "101111"),
               7: ("11111", "111011", "110111"), 8: ("111111", "1111011", "1101111"), 9: ("1111011", "1101111"),
               10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
               11: ("1110111", "111001011", "1011111", "111111")}
OVERLAP, SIMILARITY, LEAST = 12, 0.8, 5
#: Tokens kept on either side of the windows that were hit.
AROUND = 96
#: Of the bitmap: bits for each distinct hash, and the base-2 logarithm of its size at least and at most.
BITS_A_HASH, MIN_BITS, MAX_BITS = 48, 16, 28

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SLOT = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789_", *range(128, 256)]] = True


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of all texts, and the text number of each."""
    parts = [(t or "").lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    inside = _IN_WORD[raw]
    step = np.diff(inside.view(np.int8), prepend=0)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(inside)
    size = ends - starts
    place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    mixed = _BYTE[raw[at]] * _PLACE[place & 63]
    mixed += (place >> 6).astype(np.uint64) * _SLOT[0]
    h = _scramble(np.add.reduceat(mixed, np.cumsum(size) - size))
    of = np.searchsorted(np.cumsum([len(p) for p in parts]), starts, side="right")
    return h, of


def window_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the kept positions of the window that starts at each token."""
    n = len(h) - len(mask) + 1
    out = np.full(max(n, 0), len(mask) * 1_000_003 + int(mask, 2), np.uint64)
    for i, kept in enumerate(mask):
        if kept == "1" and n > 0:
            out += h[i:i + n] * _SLOT[i]
    return _scramble(out)


def masks_for(n: int, least: int = LEAST) -> list[str]:
    """The masks that an item of ``n`` tokens is searched by."""
    if n < max(least, 1):
        return []
    return list(MASKS if n >= 12 else SHORT_MASKS.get(n, ("1" * n,)))


def stretch(a: np.ndarray, b: np.ndarray, similarity: float) -> tuple[int, int]:
    """Longest stretch of two aligned token lists in which ``similarity`` agree: tokens, agreeing."""
    same = a == b
    level = np.concatenate([[0.0], np.cumsum(same - similarity)])
    low = np.minimum.accumulate(level)
    begin = np.searchsorted(-low, -level - 1e-9)
    size = np.arange(len(level)) - begin
    j = int(size.argmax())
    i = int(begin[j])
    return j - i, int(same[i:j].sum())


def _postings(benchmark: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for item, text in zip(pdf["item_id"], pdf["t"]):
                h, _ = token_hashes([text])
                rows = [(m, window_hashes(h, m)) for m in masks_for(len(h), least)]
                yield pd.DataFrame({
                    "item_id": [item], "tokens": [h.tobytes()],
                    "hashes": [np.concatenate([w for _, w in rows]).view(np.int64) if rows else np.zeros(0, np.int64)],
                    "places": [np.concatenate([np.arange(len(w)) for _, w in rows]) if rows else np.zeros(0, np.int64)],
                    "short": [len(h) if rows and len(h) < 12 else 0]})

    named = benchmark.select(as_text(F.col(id_col)).alias("item_id"), F.col(text_col).alias("t")).filter("item_id is not null")
    return named.mapInPandas(
        run, "item_id string, tokens binary, hashes array<long>, places array<long>, short int").withColumn(
        "item_id", F.col("item_id").cast("long"))


def bitmap_bits(hashes: int) -> int:
    """The base-2 logarithm of the bitmap's size for so many hashes."""
    return min(MAX_BITS, max(MIN_BITS, (max(1, hashes) * BITS_A_HASH - 1).bit_length()))


def _probes(bits: int) -> tuple[int, int, int]:
    """Where in a hash the bitmap's indexes begin: a hash is in the set if all of them are."""
    return 64 - bits, (64 - bits) // 2, 0


def _bitmap(postings: DataFrame, bits: int) -> np.ndarray:
    """The set of the hashes' probes, ``bits`` bits each; at most 2 ** (bits - 6) rows come back."""
    probe = F.explode(F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(F.lit((1 << bits) - 1)) for s in _probes(bits)]))
    words = postings.select(probe.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("b")).toPandas()
    out = np.zeros(max(1, 1 << bits >> 6), np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return out


def _admitted(seen: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
    """Places of the hashes whose probes are all in the bitmap."""
    at = np.arange(len(w))
    for s in _probes(bits):
        p = w[at] >> np.uint64(s) & np.uint64((1 << bits) - 1)
        at = at[(seen[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)]
    return at


def _hit_regions(bitmap, masks: list[str], around: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = bitmap.value
        for pdf in batches:
            h, of = token_hashes(list(pdf["t"]))
            hits = []
            for m in masks:
                w = window_hashes(h, m)
                at = _admitted(seen, w, bits)
                at = at[of[at] == of[at + len(m) - 1]]
                hits.append((at, w[at], np.full(len(at), len(m))))
            at, w, span = (np.concatenate([x[i] for x in hits]) for i in range(3))
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, w, span = at[order], w[order], span[order]
            first, last = np.searchsorted(of, np.arange(len(pdf))), np.searchsorted(of, np.arange(len(pdf)), side="right")
            apart = np.flatnonzero(np.r_[True, (np.diff(at) > around) | (of[at[1:]] != of[at[:-1]])])
            rows = []
            for i, j in zip(apart, np.r_[apart[1:], len(at)]):
                d = of[at[i]]
                lo, hi = max(first[d], at[i] - around), min(last[d], at[j - 1] + int(span[i:j].max()) + around)
                rows.append((pdf["doc_id"].iat[d], pdf["h"].iat[d], int(lo - first[d]), h[lo:hi].tobytes(),
                             w[i:j].view(np.int64), at[i:j] - lo))
            yield pd.DataFrame(rows, columns=["doc_id", "h", "region", "tokens", "hashes", "places"])
    return run


def diagonals(a_hashes: np.ndarray, a_places: np.ndarray, b_hashes: np.ndarray, b_places: np.ndarray) -> np.ndarray:
    """Differences of the places at which the two lists hold the same hash, ascending."""
    shared = np.intersect1d(a_hashes, b_hashes)
    a_in, b_in = np.isin(a_hashes, shared), np.isin(b_hashes, shared)
    a_hashes, a_places, b_hashes, b_places = a_hashes[a_in], a_places[a_in], b_hashes[b_in], b_places[b_in]
    if not len(shared):
        return np.zeros(0, np.int64)
    least = int(a_places.min() - b_places.max())
    marks = np.zeros(int(a_places.max() - b_places.min()) - least + 1, bool)
    a_by, b_by = np.argsort(a_hashes, kind="stable"), np.argsort(b_hashes, kind="stable")
    a_ends = np.searchsorted(a_hashes[a_by], shared, side="right")
    b_ends = np.searchsorted(b_hashes[b_by], shared, side="right")
    for i, j, k, m in zip(np.r_[0, a_ends], a_ends, np.r_[0, b_ends], b_ends):
        own = a_places[a_by[i:j]] - least
        for place in b_places[b_by[k:m]]:
            marks[own - place] = True
    return np.flatnonzero(marks) + least


def best_stretch(a: np.ndarray, b: np.ndarray, at: np.ndarray, similarity: float) -> tuple[int, int]:
    """The longest stretch (tokens, agreeing) on any of the diagonals ``at``."""
    best = (0, 0)
    for d in at.tolist():
        lo, hi = max(0, d), min(len(a), d + len(b))
        if hi - lo >= best[0] and hi > lo:  # no shorter diagonal holds a longer stretch
            best = max(best, stretch(a[lo:hi], b[lo - d:hi - d], similarity))
    return best


def _verified(overlap: int, similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                a, b = np.frombuffer(r.region_tokens, "<u8"), np.frombuffer(r.item_tokens, "<u8")
                at = diagonals(np.asarray(r.region_hashes), np.asarray(r.region_places), np.asarray(r.item_hashes), np.asarray(r.item_places))
                n, same = best_stretch(a, b, at, similarity)
                if n >= min(overlap, len(b)):
                    out.append((r.h, r.item_id, n, same))
            yield pd.DataFrame(out, columns=["h", "item_id", "overlap", "agreeing"])
    return run


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", overlap: int = OVERLAP,
             similarity: float = SIMILARITY, least: int = LEAST, around: int = AROUND) -> tuple[DataFrame, DataFrame]:
    """Verified overlaps ``(h, item_id, overlap, agreeing)`` by text hash, and ``(doc_id, h)``
    of every document with a hit."""
    spark = docs.sparkSession
    small_batches(spark)
    items = cut(_postings(benchmark, item_col, item_text, least), "items")
    postings = cut(items.select("item_id", F.explode(F.array_distinct("hashes")).alias("hash")), "postings")
    bits = bitmap_bits(postings.count())
    short = [r["short"] for r in items.filter("short > 0").select("short").distinct().collect()]  # lengths under 12
    masks = list(dict.fromkeys([*MASKS, *[m for n in sorted(short) for m in masks_for(n, least)]]))
    bitmap = spark.sparkContext.broadcast(_bitmap(postings, bits))
    rows = docs.select(as_text(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("t"), _text_hash(text_col).alias("h"))
    found = cut(rows.mapInPandas(_hit_regions(bitmap, masks, around, bits),
                                 "doc_id string, h long, region long, tokens binary, hashes array<long>, places array<long>")
                .withColumn("doc_id", F.col("doc_id").cast("long")), "regions")
    regions = cut(found.drop("doc_id").dropDuplicates(["h", "region"]), "distinct-regions")
    hits = regions.select("h", "region", F.explode(F.array_distinct("hashes")).alias("hash"))
    met = hits.join(postings, "hash").select("h", "region", "item_id").distinct()
    both = lambda df, name, *keys: df.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in ("tokens", "hashes", "places")])
    pairs = met.join(both(regions, "region", "h", "region"), ["h", "region"]).join(both(items, "item", "item_id"), "item_id")
    good = pairs.mapInPandas(_verified(overlap, similarity), "h long, item_id long, overlap int, agreeing int")
    good = good.groupBy("h", "item_id").agg(F.max(F.struct("overlap", "agreeing")).alias("m")).select(
        "h", "item_id", "m.overlap", "m.agreeing")
    return cut(good, "overlaps"), found.select("doc_id", "h").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, overlap, agreeing."""
    good, where = overlaps(docs, benchmark, **options)
    return where.join(good, "h").groupBy("doc_id", "item_id").agg(
        F.max("overlap").alias("overlap"), F.max("agreeing").alias("agreeing"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage, all columns as they are."""
    good, _ = overlaps(docs, benchmark, text_col=text_col, **options)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(c).alias(f"in_{c}") for c in names]).alias("r"), _text_hash(text_col).alias("h"))
    return rows.join(good.select("h").distinct(), "h", "left_anti").select(
        *[F.col(f"r.in_{c}").alias(c) for c in names])
