"""The incremental load as a file stream: each new source file is read exactly once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from snapdelta.config import DeltaLoad
from snapdelta.operators.cursor import first_floor, in_cursor_order
from snapdelta.plans.loads import declared, extract, land_run
from snapdelta.sinks.layout import Layout
from snapdelta.sources.tables import projected
from snapdelta.state.watermark import WatermarkTable, state_key


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None):
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def land_stream(
    source: DataFrame,
    load: DeltaLoad,
    layout: Layout,
    day: str,
    checkpoint: str,
    watermarks: WatermarkTable,
    base_name: str = "snapdelta",
    floor=None,
) -> StreamingQuery:
    """Land all files that have arrived since the last call, then stop.

    The checkpoint knows which files were read, so only the floor filters rows, and a late row in a
    new file is kept. A batch writes to a folder of its own, named after the checkpoint: if it runs
    again after a failure, it replaces what the first try left. (On a later day it lands in that
    day's folder, so rows may repeat but are never lost.) The highest cursor is saved too, so that
    batch runs can go on from it.
    """
    cutoff = first_floor(load.initial_value, floor)
    key = state_key(base_name, "delta", load.database, load.schema, load.output_name)
    rows = projected(source, load)
    data_type = rows.schema[load.cursor_column].dataType
    chosen = extract(rows, load, cutoff)
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def land(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{stream}-{batch_id}"
        found = land_run(in_cursor_order(declared(batch, load), load.cursor_column), load, layout, day, run_id)
        watermarks.advance(key, found["high"], data_type.simpleString(), found["n_rows"], run_id)

    writer = chosen.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
