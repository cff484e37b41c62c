"""Landed files merged into a table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import merge_folder, upsert_table
from ..session import shared_dir
from ..sources import paths
from ..specs import TableSpec


def stream_upsert(
    spark: SparkSession, landing_dir: str, target: str, spec: TableSpec, checkpoint: str,
    schema: T.StructType | None = None, on_duplicate: str = "raise", clear_landed: bool = False,
    files_per_batch: int | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that merges every landed parquet file once.

    The batch number names the merged rows in the scratch folder, so a batch replayed after a
    crash writes what it wrote before. Audit stamps come with the rows; a replay invents none.
    ``clear_landed`` deletes files after their batch. The default trigger takes what has landed
    and stops.
    """
    known: dict[str, str] = {}

    def merge(batch: DataFrame, number: int) -> None:
        if not known:
            # the id Spark keeps in the checkpoint: a new checkpoint never meets old scratch rows
            known["id"] = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        scratch = f"{shared_dir(spark)}/stream-{known['id']}"
        upsert_table(spark, target, batch, spec, on_duplicate, str(number), scratch)
        if number > 0:  # the batch before is committed by now
            paths.delete(spark, f"{merge_folder(spark, target, spec, scratch)}/{number - 1}")

    reader = spark.readStream.schema(schema or spec.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if clear_landed:
        reader = reader.option("cleanSource", "delete")
    landed = reader.parquet(landing_dir)
    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
