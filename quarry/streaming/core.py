"""Stream sources over the driver tables and a runner that drains a stream.

Streams read the same Parquet files as the batch views (one table file per
directory, selected with ``pathGlobFilter``), so a stream over the driver
folder is one micro-batch, and a folder of time-split files replays the same
rows in several. Event-time columns are NTZ in the tables and are cast to
TIMESTAMP (UTC session) because watermarks require it. Outputs and
checkpoints live under the shared ``spark.checkpoint.dir``, so a restarted
query resumes from its checkpoint instead of recomputing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path


# Keyed state with timers and lists lives in RocksDB; the setting may be given per session.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def table_stream(spark: SparkSession, folder: str, table: str, max_files: int | None = None) -> DataFrame:
    """Stream the rows of ``<folder>/<table>*.parquet``."""
    schema = spark.read.parquet(f"{folder}/{table}*.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}*.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def clock_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Times (``ts``) written to ``folder`` with :func:`tick`, as a stream."""
    return spark.readStream.schema("ts timestamp_ntz").parquet(folder)


def tick(spark: SparkSession, folder: str, at: str) -> None:
    """Write one time to a clock folder."""
    spark.sql(f"SELECT TIMESTAMP_NTZ'{at}' AS ts").coalesce(1).write.mode("append").parquet(folder)


def drain(stream: DataFrame, name: str, mode: str = "append", path: str | None = None) -> str:
    """Run ``stream`` with ``availableNow`` into a Parquet folder; return the folder."""
    spark = stream.sparkSession
    base = path or scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:10]}")
    q = (stream.writeStream.format("parquet").outputMode(mode)
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{base}/out"


def drain_batches(stream: DataFrame, name: str, fn, path: str | None = None) -> str:
    """Run ``stream`` with ``foreachBatch(fn(batch_df, batch_id, out_dir))``."""
    spark = stream.sparkSession
    base = path or scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:10]}")
    out = f"{base}/out"
    q = (stream.writeStream.foreachBatch(lambda df, bid: fn(df, bid, out))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def event_time(col: str = "ts"):
    return F.col(col).cast("timestamp")
