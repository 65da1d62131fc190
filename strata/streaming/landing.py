"""File-stream landing of API envelopes into bronze with ``foreachBatch``.

Each micro-batch is gated and exploded exactly like a batch load and written
into ``{base}/bronze/{entity}/load=stream-{query id}-{epoch}`` with ``overwrite``: a micro-batch
replayed after a failure rewrites its own directory, so together with the
stream checkpoint (which records the files already consumed) every envelope
is landed exactly once. Rejected envelopes go to ``{base}/rejected/{entity}``
instead of stopping the stream. The query id is kept in the stream's checkpoint:
a restart goes on with its own loads, and a stream with a new checkpoint, whose
epochs begin at 0 again, never writes over those of another.

Row ids continue above the largest id of the table's other loads, as those of a
batch load do, so ids stay unique when batch runs and streams take turns (two
writers at the same moment would need a lock of their own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.keys import discard, materialize, next_key_start
from strata.plans.store import LayerStore
from strata.sources.bronze import arrival_ids, check_target, land_bronze
from strata.sources.envelope import parse_envelopes, staged


def _batch_writer(base: str, entity: str):
    root = f"{base.rstrip('/')}/bronze/{entity}"

    def write(batch: DataFrame, epoch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("no streaming query id: loads could not be told apart")
        load = f"load=stream-{query_id}-{epoch_id:012d}"
        store = LayerStore(batch.sparkSession, base)
        lines = batch.withColumns({"block": F.lit(0).cast("long"), "line": F.monotonically_increasing_id()})
        whole = materialize(staged(parse_envelopes(lines), "body"), f"stream_{entity}")
        whole.filter(~F.col("ok")).select("source_file", "body").write.mode("overwrite") \
            .parquet(f"{base.rstrip('/')}/rejected/{entity}/{load}")
        start = next_key_start(store.bronze(entity).filter(F.col("load") != load[len("load="):]), "id")
        rows = arrival_ids(whole.filter("ok").drop("body"), start)
        landed = land_bronze(rows, entity, F.current_timestamp(), id_col="id")
        landed.write.mode("overwrite").parquet(f"{root}/{load}")
        discard(whole)

    return write


def land_stream(spark: SparkSession, entity: str, source_dir: str, base: str,
                checkpoint_location: str, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``. With
    ``available_now`` it processes every file present and stops."""
    check_target(entity)
    files = (spark.readStream.format("text").option("wholetext", "true").load(source_dir)
             .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body")))
    writer = files.writeStream.foreachBatch(_batch_writer(base, entity)) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
