"""Event windows, in batch and as a stream, and as-of attachment; an extension beside the purchase operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, shared_folder


def tumbling(events: DataFrame, width: str) -> DataFrame:
    """Events and value per type and window; works on a stream with watermark as on a batch."""
    w = events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    return w.select(F.col("w.start").alias("window_start"), "event_type", "events", F.col("total").cast("double").alias("total"))


def sessions(events: DataFrame, gap_minutes: int) -> DataFrame:
    """Sessions of each user: events closer than the gap belong together (map-side merged session windows)."""
    w = events.groupBy("user_id", F.session_window("ts", f"{gap_minutes} minutes").alias("w")).agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("last_event"))
    return w.select("user_id", F.col("w.start").alias("session_start"), "last_event", "events")


def stream_to_table(spark: SparkSession, sf_dir: str, width: str) -> DataFrame:
    """Read the events as a stream to its end; each batch writes the windows it changed, the last state of each window is returned.

    Windows are kept as state until the watermark passes them; a batch that is run again after a failure
    writes over its own folder, so nothing counts twice, and nothing is held in the driver.
    """
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "10 minutes")
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/windows/batch={number}")

    q = tumbling(src, width).writeStream.outputMode("update").option("checkpointLocation", f"{root}/state").foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    done = spark.read.schema("window_start timestamp, event_type string, events bigint, total double, batch int").parquet(f"{root}/windows")
    last = done.groupBy("window_start", "event_type").agg(F.max_by(F.struct("events", "total"), "batch").alias("m"))
    return last.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "m.events", "m.total")


def as_of(events: DataFrame, of: str, last: str) -> DataFrame:
    """Each event of type ``of`` with the latest event of type ``last`` of its user before it, by one window and no range join.

    Users are bounded in events by time only, so time is cut into days first: within a day the window runs per user and day,
    and the last value of earlier days is carried by a second window over one row per user and day.
    """
    e = events.where(F.col("event_type").isin(of, last)).withColumn("day", F.to_date("ts"))
    hit = F.when(F.col("event_type") == last, F.struct("ts", "event_id"))
    w = Window.partitionBy("user_id", "day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = e.withColumn("near", F.last(hit, ignorenulls=True).over(w))
    daily = e.groupBy("user_id", "day").agg(F.max(hit).alias("day_last"))
    carried = daily.withColumn("far", F.max("day_last").over(Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))).select("user_id", "day", "far")
    j = inside.where(F.col("event_type") == of).join(carried, ["user_id", "day"])
    return j.select("event_id", "user_id", F.coalesce("near.event_id", "far.event_id", F.lit(-1)).alias("last_id"))


def incremental_registry(batch: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """The registry after a batch: what it knew stays with its first run, new keys are appended; a new snapshot, never written over what is read."""
    fresh = batch.select(*registry.columns).join(registry.select(*keys), keys, "left_anti").dropDuplicates(keys)
    return cut(registry.unionByName(fresh))
