"""Operator 2, sharding: a Feistel permutation with cycle walking over global
row numbers. Every row's shard and slot can be computed from its row number,
the row count and the seed alone; reruns agree.

Law ``rows``: shard sizes in rows are at most one apart, since position ``p``
of the permutation goes to shard ``p mod shards``, slot ``p div shards``.

Defined results
  null text: no bytes, so size 16 and the checksum of the empty string (0);
  null ids: sorted first; repeated rows: each gets its own slot, and rows equal
  in id and text are interchangeable; equal ids: ordered by text checksum and
  size; very long texts: measured whole, in the scan, and never moved; empty table: no rows; other input columns are ignored, whatever their
  names. Copies are rows like any other under this law, so a group of equal
  texts is spread over the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, numbered, permute

SHARDS = 40
SEED = "strata-shards"


def shard(docs: DataFrame, shards: int = SHARDS, seed: str = SEED,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = cut(docs.select(F.col(id_col).alias("doc_id"),
                             (F.octet_length(text) + 16).cast("long").alias("size"),
                             F.crc32(text.cast("binary")).alias("text_crc32")), "shard-digest")
    rows = numbered(digest, ["doc_id", "text_crc32", "size"], name="shard-rows")
    total = F.lit(digest.count())
    place = rows.withColumn("_p", permute(F.col("_row"), total, seed))
    return place.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                        (F.col("_p") % shards).cast("int").alias("shard"),
                        F.floor(F.col("_p") / shards).cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))
