"""Operator 13, Merkle dataset manifest: a tree of arity 3 over the documents of every
source, a tree over the sources' roots, and proofs by octopus multiproof.

``build`` digests every row, numbers the rows of each source, and computes the interior
nodes in chunks of ``3 ** SPAN`` neighbouring nodes, ``SPAN`` levels at a time; leaves and
nodes are Parquet tables in the shared folder. ``prove`` takes the leaves wanted (all of
them, or those of some ids). Each leaf partition (a chunk, never more than ``3 ** SPAN``
rows) names the coordinates its leaves need and cannot derive from each other (their
minimal union), fetches those once in one join, derives the interiors that its leaves
share, and expands every leaf's own proof from them.

Memory of a task is one chunk and its fetched nodes, at most two a level for whole chunks;
texts never leave the scan. A source that holds most rows is many chunks; many small
sources pass one after another through the same tasks.

Defined results
  null columns: ``-`` in the leaf; null text: never changed by the tampering; null ids: first
  in their source, never tampered with; null source: a source of its own, the first; rows
  equal in source and id: ordered by leaf, rows equal in all: each its own leaf, and they are
  interchangeable; very long texts: digested whole inside the scan; empty table: no rows;
  columns other than the five of the leaf are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import as_text, cut, numbered, shuffle_partitions

ARITY, SPAN = 3, 7
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: The tree over the sources' roots; those of the sources are numbered from 0.
TOP = -1
CHUNK = ARITY ** SPAN
NODE = "tree long, level int, pos long, digest string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ARITY), h + 1
    return h


def leaf_of(*cols: Column) -> Column:
    """The digest of a row: of every column its byte count, a colon and its text."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[part(c) for c in cols]).cast("binary"), 256)


def missing(known: np.ndarray, n: int) -> list[tuple[int, int]]:
    """``(level, position)`` of the nodes that the proofs of the leaves at ``known`` need and
    that cannot be computed from those leaves, of a tree with ``n`` of them."""
    out, level, known = [], 0, np.unique(known)
    while n > 1:
        runs = np.unique(known // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out += [(level, int(p)) for p in np.setdiff1d(members[members < n], known)]
        known, n, level = runs, -(-n // ARITY), level + 1
    return out


@dataclass
class Manifest:
    """``leaves``: tree, pos, n (leaves of the tree), doc_id, leaf, shown; ``nodes``: the interior
    ones as tree, level, pos, digest, level 0 of the top tree included; ``sources``: their number."""
    leaves: DataFrame
    nodes: DataFrame
    sources: int


def _chunks(pdfs: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows equal in ``keys``, which follow each other, as one frame each."""
    rest: pd.DataFrame | None = None
    for pdf in pdfs:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        new = np.flatnonzero((pdf[keys].to_numpy()[1:] != pdf[keys].to_numpy()[:-1]).any(axis=1)) + 1
        bounds = [0, *new.tolist()]
        for a, b in zip(bounds, bounds[1:]):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[bounds[-1]:]
    if rest is not None and len(rest):
        yield rest


def _in_chunks(df: DataFrame, *then: str) -> DataFrame:
    df = df.withColumn("chunk", F.floor(F.col("pos") / CHUNK).cast("long")) if "chunk" not in df.columns else df
    return df.repartition(shuffle_partitions(df.sparkSession), "tree", "chunk").sortWithinPartitions("tree", "chunk", *then)


def _parents(digests: list[str]) -> list[str]:
    return [digest("".join(digests[k:k + ARITY])) for k in range(0, len(digests), ARITY)]


def _interior(level_nodes: DataFrame, base: int) -> DataFrame:
    """Nodes of the levels ``base + 1`` to ``base + SPAN`` from all nodes of level ``base``
    (tree, pos, width of the level, digest), as far as their trees go."""
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _chunks(pdfs, ["tree", "chunk"]):
            tree, first, width, digests = int(rows["tree"].iat[0]), int(rows["pos"].iat[0]), int(rows["width"].iat[0]), list(rows["digest"])
            out = []
            for level in range(base + 1, base + SPAN + 1):
                if width == 1:
                    break
                digests, first, width = _parents(digests), first // ARITY, -(-width // ARITY)
                out += [(tree, level, first + k, width, d) for k, d in enumerate(digests)]
            if out:
                yield pd.DataFrame(out, columns=["tree", "level", "pos", "width", "digest"])

    return _in_chunks(level_nodes, "pos").mapInPandas(run, "tree long, level int, pos long, width long, digest string")


def _tree(leaves: DataFrame, most: int, name: str) -> DataFrame:
    """All interior nodes over ``leaves`` (tree, pos, width, digest), trees of at most ``most`` leaves."""
    out, base, level_nodes = [], 0, leaves
    while True:
        out.append(cut(_interior(level_nodes, base), name))
        base += SPAN
        if height(most) <= base:
            break
        level_nodes = out[-1].filter((F.col("level") == base) & (F.col("width") > 1)).drop("level")
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def build(docs: DataFrame, shown: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``shown`` is the text that proofs are held against (default:
    the text itself); its leaf travels beside the true one."""
    spark = docs.sparkSession
    c = [F.col(x) for x in LEAF_COLUMNS]
    leaf = leaf_of(*c)
    # another digest only for texts that the proof is shown changed
    other = F.lit(None).cast("string") if shown is None else F.when(
        ~shown.eqNullSafe(F.col("text")), leaf_of(*c[:-1], shown))
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), other.alias("shown"))
    order = [F.col(x).asc_nulls_first() for x in ("source", "doc_id", "leaf")]
    rows = cut(rows.withColumn("tie", F.monotonically_increasing_id()), "manifest-rows")
    placed = cut(rows.repartitionByRange(shuffle_partitions(spark), *order, F.col("tie"))
                 .sortWithinPartitions(*order, F.col("tie")).drop("tie")
                 .withColumns({"part": F.spark_partition_id(),
                               "seq": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "manifest-placed")
    # one row for each source in each range partition: a source's place goes on where the one before ends
    runs = placed.groupBy("part", "source").agg(F.count("*").alias("rows"), F.min("seq").alias("lo"))
    of_source = Window.partitionBy("source")
    runs = runs.withColumns({
        "n": F.sum("rows").over(of_source),
        "before": F.coalesce(F.sum("rows").over(of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    sources = numbered(runs.groupBy("source").agg(F.first("n").alias("n")), [F.col("source").asc_nulls_first()],
                       name="manifest-sources", row="tree").withColumnRenamed("source", "name")
    runs = (runs.join(sources.drop("n"), F.col("source").eqNullSafe(F.col("name")))
            .select(F.col("part").alias("p"), F.col("source").alias("s"), "lo", "n", "before", "tree"))
    leaves = cut(placed.join(runs, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")))
                 .select("tree", (F.col("before") + F.col("seq") - F.col("lo")).alias("pos"), "n", "doc_id", "leaf",
                         F.coalesce("shown", "leaf").alias("shown")), "manifest-leaves")
    count, most = sources.agg(F.count("*"), F.max("n")).first()
    nodes = _tree(leaves.select("tree", "pos", F.col("n").alias("width"), F.col("leaf").alias("digest")), most or 0, "manifest-nodes")
    # a source's root: the one node of its last level, a lone leaf itself
    roots = cut(nodes.filter("width = 1").select(F.col("tree").alias("pos"), "digest")
                .unionByName(leaves.filter("n = 1").select(F.col("tree").alias("pos"), F.col("leaf").alias("digest")))
                .select(F.lit(TOP).cast("long").alias("tree"), "pos", F.lit(count).cast("long").alias("width"), "digest"), "manifest-roots")
    top = _tree(roots, count, "manifest-top")
    every = nodes.drop("width").unionByName(top.drop("width")).unionByName(
        roots.select("tree", F.lit(0).alias("level"), "pos", "digest"))
    return Manifest(leaves, every, count)


class _Proofs:
    """The shared part of a chunk's proofs: digests by level, known or fetched, and for every
    node the siblings above it."""

    def __init__(self, fetched: dict[tuple[int, int, int], str], tree: int, n: int, sources: int, known: dict[int, str]):
        self.levels: list[tuple[dict[int, str], int]] = []  # digests by position, and the width
        for at, pos_of, width, level0 in ((tree, None, n, known), (TOP, tree, sources, None)):
            here = level0 if level0 is not None else {pos_of: self.root}
            level = 0
            while width > 1:
                asked = {p // ARITY for p in here}
                full = dict(here)
                for run in asked:
                    for p in range(run * ARITY, min(run * ARITY + ARITY, width)):
                        if p not in full:
                            full[p] = fetched[at, level, p]
                self.levels.append((full, width))
                here = {run: digest("".join(full[p] for p in range(run * ARITY, min(run * ARITY + ARITY, width)))) for run in asked}
                width, level = -(-width // ARITY), level + 1
            if at == tree:
                self.own = len(self.levels)
                self.root = self.subroot = here[0]
            else:
                self.root = here[0]
        self.tree, self.above = tree, {}

    def siblings(self, level: int, pos: int) -> list[tuple[str, str]]:
        """What stands left and right of the node and of each one above it."""
        if level == len(self.levels):
            return []
        if (level, pos) not in self.above:
            digests, width = self.levels[level]
            run = pos // ARITY
            a, b = run * ARITY, min(run * ARITY + ARITY, width)
            up = self.tree if level + 1 == self.own else run
            self.above[level, pos] = [("".join(digests[p] for p in range(a, pos)), "".join(digests[p] for p in range(pos + 1, b))),
                                      *self.siblings(level + 1, up)]
        return self.above[level, pos]

    def of_leaf(self, pos: int) -> list[tuple[str, str]]:
        return self.siblings(0, pos if self.own else self.tree)


def fold(start: str, siblings: list[tuple[str, str]]) -> str:
    for left, right in siblings:
        start = digest(left + start + right)
    return start


def prove(manifest: Manifest, wanted: Column | None = None, with_proofs: bool = True) -> DataFrame:
    """One row for each leaf that ``wanted`` (a condition on doc_id, leaf, tree or pos; default all)
    selects: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and its
    ``proof``, the siblings' digests level by level, if asked for."""
    sources, leaves = manifest.sources, manifest.leaves
    if wanted is not None:
        leaves = leaves.filter(wanted)

    def coordinates(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _chunks(pdfs, ["tree", "chunk"]):
            tree, chunk = int(rows["tree"].iat[0]), int(rows["chunk"].iat[0])
            out = [(tree, chunk, tree, *x) for x in missing(rows["pos"].to_numpy(), int(rows["n"].iat[0]))]
            out += [(tree, chunk, TOP, *x) for x in missing(np.array([tree]), sources)]
            if out:
                yield pd.DataFrame(out, columns=["tree", "chunk", "at", "level", "pos"])

    asked = _in_chunks(leaves.select("tree", "pos", "n"), "pos").mapInPandas(
        coordinates, "tree long, chunk long, at long, level int, pos long")
    there = manifest.nodes.unionByName(manifest.leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("digest")))
    fetched = asked.join(there.withColumnRenamed("tree", "at"), ["at", "level", "pos"])
    none = F.lit(None)
    mixed = (leaves.withColumn("chunk", F.floor(F.col("pos") / CHUNK).cast("long"))
             .select("tree", "chunk", F.lit(1).alias("kind"), none.cast("long").alias("at"), none.cast("int").alias("level"),
                     "pos", "n", as_text(F.col("doc_id")).alias("doc_id"), "leaf", "shown")
             .unionByName(fetched.select("tree", "chunk", F.lit(0).alias("kind"), "at", "level", "pos", none.cast("long").alias("n"),
                                         none.cast("string").alias("doc_id"), F.col("digest").alias("leaf"), none.cast("string").alias("shown"))))

    def expand(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _chunks(pdfs, ["tree", "chunk"]):
            got, own = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
            fetched = {(int(a), int(x), int(p)): d for a, x, p, d in zip(got["at"], got["level"], got["pos"], got["leaf"])}
            places = [int(p) for p in own["pos"]]
            proofs = _Proofs(fetched, int(own["tree"].iat[0]), int(own["n"].iat[0]), sources, dict(zip(places, own["leaf"])))
            chains = [proofs.of_leaf(p) for p in places]
            texts = ["".join(x + y for x, y in chain) for chain in chains]
            out = pd.DataFrame({"doc_id": list(own["doc_id"]), "leaf": list(own["leaf"]), "subroot": proofs.subroot, "root": proofs.root,
                                "proof_sha256": [digest(t) for t in texts],
                                "folded_root": [fold(s, chain) for s, chain in zip(own["shown"], chains)]})
            if with_proofs:
                out["proof"] = [[t[k:k + 64] for k in range(0, len(t), 64)] for t in texts]
            yield out

    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    out = _in_chunks(mixed, "kind", "pos").mapInPandas(expand, schema + (", proof array<string>" if with_proofs else ""))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), *out.columns[1:6],
                      (F.col("folded_root") == F.col("root")).alias("verified"), *out.columns[6:])


def without_line_ends(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The tampered text: where 2 divides the checksum of the id, its line ends are gone."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.translate(F.col(text_col), "\n", "")).otherwise(F.col(text_col))
