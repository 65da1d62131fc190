"""Operator 11, ranked lexical search over a length-stratified index.

``build`` counts the terms of every document (whole text), and with the corpus totals gives
each its normaliser ``m``. Documents of equal ``m`` form a stratum; strata are laid side by side by
their terms and dealt out in partitions of near-equal terms, where they are cut into segments of
at most ``SEGMENT_TERMS`` terms (a longer document is a segment of its own): a stratum with most
documents is many segments, a partition of long documents has few. A segment's rows are its terms,
each with its postings grouped by tf, the highest last, and one row of the empty term that
lists the segment's documents in ascending id.

``search`` takes the items in blocks. Within a segment all documents share ``m``, so an impact
``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` is worked out once per term and tf, and the
impacts of the highest tfs bound every score of the segment. Segments are visited in order of
their bounds: the ``FIRST`` best of every item are scored, their k-th score is the item's
floor, and only segments whose bound reaches it are scored after them. Every segment is
bounded or scored, none is capped: the ranks are exact.

Memory of a task: a segment's postings for the block's terms, and one score per document of
the segment. Bounds travel as one row per segment and item; the driver gets the terms of a
block, whose size its limits fix, and one number for each.

Defined results
  null and empty texts and texts without a term: in no rank, and not counted in N; null ids:
  before all others on equal scores; rows with equal ids: documents of their own; items without
  a known term: no rows; rows of items with equal ids: each ranked for itself; equal
  scores: ascending id; terms that every document holds: weight 0; very long texts: counted
  whole; empty tables: no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, shuffle_partitions, small_batches

TOP_K = 20
#: Terms (with repeats) of a segment, and of a block of items; items of a block.
SEGMENT_TERMS, BLOCK_TERMS, BLOCK_ITEMS = 1 << 20, 100_000, 2000
#: Segments scored for each item before its floor is known.
FIRST = 4
#: A-Z lower-cased; what is no digit, no letter and not beyond ASCII becomes a blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The maximal runs of term characters: on UTF-8 bytes, as all bytes beyond ASCII belong to terms."""
    return (text or "").encode().translate(TERM_BYTES).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Index:
    """``postings``: segment, m, term, tfs (ascending), ends (of each tf's run in ``docs``), docs
    (places in the segment's list; the ids themselves in the row of the empty term)."""
    postings: DataFrame
    documents: int
    terms: int


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, n, terms and tfs of every document that holds a term."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n, ends, terms, tfs = [], [], [0], [], []
            for k, t in enumerate(b.column("t").to_pylist()):
                found = terms_of(t)
                if found:
                    tf = Counter(found)
                    kept.append(k)
                    n.append(len(found))
                    terms.extend(tf)
                    tfs.extend(tf.values())
                    ends.append(len(tfs))
            at = pa.array(kept, pa.int64())
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(at), b.column("doc_id").take(at), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["row", "doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, "row long, doc_id long, n long, terms array<string>, tfs array<long>")


def _segment(number: int, m: int, parts: list[tuple]) -> pa.RecordBatch:
    """The rows of one segment from its documents' ids (nulls as masks), term lists and tf lists."""
    ids = pa.concat_arrays([p[0] for p in parts])
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc = np.repeat(place, np.concatenate([p[1] for p in parts]))
    coded = pa.chunked_array([p[2] for p in parts]).combine_chunks().dictionary_encode()
    term, tf = coded.indices.to_numpy().astype(np.int64), np.concatenate([p[3] for p in parts])
    by = np.lexsort((doc, tf, term))
    term, tf, doc = term[by], tf[by], doc[by]
    run = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])  # a term's documents of one tf
    end = np.r_[run[1:], len(term)]
    first = np.flatnonzero(np.r_[True, term[run][1:] != term[run][:-1]])  # a term's first run
    sizes = np.r_[first[1:], len(run)]
    start = run[first]
    rows = len(first) + 1
    offset = lambda x: pa.array(np.r_[0, x].astype(np.int32))
    whole = lambda values, last: pa.concat_arrays([pa.array(values, pa.int64()), last])
    nothing = pa.array([], pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows, number, np.int64)), pa.array(np.full(rows, m, np.int64)),
         pa.concat_arrays([coded.dictionary.take(pa.array(term[start])), pa.array([""])]),
         pa.ListArray.from_arrays(offset(np.r_[sizes, len(run)]), whole(tf[run], nothing)),
         pa.ListArray.from_arrays(offset(np.r_[sizes, len(run)]), whole(end - np.repeat(start, np.diff(np.r_[first, len(run)])), nothing)),
         pa.ListArray.from_arrays(offset(np.r_[end[np.r_[first[1:] - 1, len(run) - 1]], len(doc) + len(ids)]), whole(doc, ids.take(pa.array(order))))],
        names=["segment", "m", "term", "tfs", "ends", "docs"])


#: Groups of strata for each doubling of ``m``; 63 doublings fit in a long.
GROUPS = 64


def _partition(forward: DataFrame, parts: int) -> Column:
    """Where a document goes: the groups of neighbouring strata, laid end to end by their terms,
    cover a line that is cut into ``parts``; a hash of the row is the place within its group."""
    group = F.floor(F.log2("m") * GROUPS).cast("int")
    # at most 63 * GROUPS rows
    terms = {r["g"]: r["t"] for r in forward.groupBy(group.alias("g")).agg(F.sum("n").alias("t")).collect()}
    if not terms:
        return F.lit(0)
    low, total = min(terms), sum(terms.values())
    own = np.array([terms.get(g, 0) for g in range(low, max(terms) + 1)], float) / total
    place = F.element_at(F.lit((np.cumsum(own) - own).tolist()), group - low + 1)
    share = F.element_at(F.lit(own.tolist()), group - low + 1)
    within = F.shiftrightunsigned(F.xxhash64("row"), 11) / F.lit(float(1 << 53))
    return F.least(F.floor((place + share * within) * parts), F.lit(parts - 1)).cast("int")


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_terms: int = SEGMENT_TERMS) -> Index:
    spark = docs.sparkSession
    forward = cut(counted(docs, id_col, text_col), "search-terms")
    documents, terms = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # in decimals, as 25 * n * N may pass 64 bits on the way
    m = (F.lit(75) + F.expr(f"(cast(25 as decimal(38, 0)) * n * {documents}L) div {max(1, terms)}L")).cast("long")
    parts = shuffle_partitions(spark)
    placed = (forward.withColumn("m", m).withColumn("part", _partition(forward.withColumn("m", m), parts))
              .repartitionById(parts, "part").sortWithinPartitions("m", "row").select("m", "doc_id", "n", "terms", "tfs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held, size, now = [], 0, None
        for b in batches:
            ms, ns = b.column("m").to_numpy(), b.column("n").to_numpy()
            at = 0
            while at < len(ms):
                if held and (ms[at] != now or size + ns[at] > segment_terms):
                    yield _segment(number, int(now), held)
                    held, size, number = [], 0, number + 1
                now, to = ms[at], at
                while to < len(ms) and ms[to] == now and (to == at and not held or size + ns[to] <= segment_terms):
                    size, to = size + int(ns[to]), to + 1
                part = b.slice(at, to - at)
                lists, tfs = part.column("terms"), part.column("tfs")
                held.append((part.column("doc_id"), pc.list_value_length(lists).to_numpy(), lists.flatten(), tfs.flatten().to_numpy()))
                at = to
        if held:
            yield _segment(number, int(now), held)

    postings = cut(placed.mapInArrow(run, "segment long, m long, term string, tfs array<long>, ends array<long>, docs array<long>"), "search-postings")
    return Index(postings, documents, terms)


@dataclass
class _Block:
    """The items of a block: their ids, and for every term its weight and the items that ask for it."""
    ids: list
    wanted: dict  # term -> [(item, times)]
    weights: dict


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[_Block]:
    """The items, a bounded number and a bounded number of terms at a time (a single item may be longer)."""
    ids, wanted, size = [], {}, 0
    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        found = Counter(terms_of(r["t"]))
        if ids and (size + len(found) > BLOCK_TERMS or len(ids) >= BLOCK_ITEMS):
            yield _Block(ids, wanted, {})
            ids, wanted, size = [], {}, 0
        for t, times in found.items():
            wanted.setdefault(t.decode(), []).append((len(ids), times))
        ids.append(r["i"])
        size += len(found)
    if ids:
        yield _Block(ids, wanted, {})


def impact(w: int, tf: np.ndarray, m: int) -> np.ndarray:
    """Of every tf, in 64-bit integers."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _bounds(block: _Block):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best = np.zeros(len(block.ids), np.int64)
        m = int(pdf["m"].iat[0])
        for term, tfs in zip(pdf["term"], pdf["tfs"]):
            if term:
                most = int(impact(block.weights[term], np.array([tfs[-1]], np.int64), m)[0])
                for item, times in block.wanted[term]:
                    best[item] += times * most
        at = np.flatnonzero(best > 0)
        return pd.DataFrame({"segment": int(pdf["segment"].iat[0]), "item": at, "bound": best[at]})
    return run


def _scores(block: _Block, k: int):
    def run(asked: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        floors = dict(zip(asked["item"], asked["floor"]))
        own: dict[int, list] = {i: [] for i in floors}
        ids, out = None, []
        for term, tfs, ends, docs, m in zip(pdf["term"], pdf["tfs"], pdf["ends"], pdf["docs"], pdf["m"]):
            if not term:
                ids = docs
                continue
            mine = [(i, times) for i, times in block.wanted[term] if i in own]
            if mine:
                values = np.repeat(impact(block.weights[term], np.asarray(tfs, np.int64), int(m)), np.diff(np.r_[0, ends]).astype(np.int64))
                for i, times in mine:
                    own[i].append((np.asarray(docs, np.int64), values * times))
        for i, hits in own.items():
            if not hits:
                continue
            score = np.zeros(len(ids), np.int64)
            np.add.at(score, np.concatenate([d for d, _ in hits]), np.concatenate([v for _, v in hits]))
            floor = max(1, int(floors[i]))
            at = np.flatnonzero(score >= floor)
            if len(at) > k:
                at = at[score[at] >= np.partition(score[at], -k)[-k]]
                at = at[np.lexsort((at, -score[at]))[:k]]
            out += [(i, None if pd.isna(ids[d]) else str(int(ids[d])), int(score[d])) for d in at]
        return pd.DataFrame(out, columns=["item", "doc_id", "score"]).astype({"doc_id": object})
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = TOP_K, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each item's ``k`` highest-scoring documents: item_id, rank, doc_id, score."""
    spark = items.sparkSession
    found = [_search_block(index, block, k, items.schema[id_col].dataType.simpleString()) for block in _blocks(items, id_col, text_col)]
    if not found:
        return spark.createDataFrame([], f"item_id {items.schema[id_col].dataType.simpleString()}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_block(index: Index, block: _Block, k: int, id_type: str) -> DataFrame:
    postings, spark = index.postings, index.postings.sparkSession
    names = spark.createDataFrame([(t,) for t in [*block.wanted, ""]], "term string")
    # broadcast: at most BLOCK_TERMS terms, or those of one item
    hits = cut(postings.join(F.broadcast(names), "term"), "search-hits")
    # the driver gets one count for each of them
    df = {r["term"]: r["df"] for r in hits.filter("term <> ''").groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()}
    block.weights.update({t: weight(index.documents, n) for t, n in df.items()})
    by_segment = hits.groupBy("segment")
    bounds = cut(hits.select("segment", "m", "term", "tfs").groupBy("segment").applyInPandas(_bounds(block), "segment long, item int, bound long"), "search-bounds")
    visits = bounds.withColumn("visit", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "segment")))
    visits = cut(visits.filter(F.col("visit") <= FIRST), "search-visits")
    score = lambda asked: asked.groupBy("segment").cogroup(by_segment).applyInPandas(
        _only_asked(_scores(block, k)), "item int, doc_id string, score long").withColumn("doc_id", F.col("doc_id").cast("long"))
    first = cut(score(visits.select("segment", "item", F.lit(1).cast("long").alias("floor"))), "search-first")
    # the k-th score so far: at most one number an item of the block
    floors = _ranked(first, k).filter(F.col("rank") == k).select("item", F.col("score").alias("floor"))
    rest = (bounds.join(visits.select("segment", "item"), ["segment", "item"], "left_anti").join(F.broadcast(floors), "item", "left")
            .withColumn("floor", F.coalesce("floor", F.lit(1).cast("long"))).filter("bound >= floor").select("segment", "item", "floor"))
    ranked = _ranked(first.unionByName(score(rest)), k)
    ids = spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {id_type}")
    return (ranked.join(F.broadcast(ids), "item")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _only_asked(scores):
    """Segments that no item asks for give nothing."""
    def run(asked: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame({"item": pd.Series([], dtype="int32"), "doc_id": pd.Series([], dtype=object), "score": pd.Series([], dtype="int64")})
        return scores(asked, pdf)
    return run
