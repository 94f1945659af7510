"""Structured Streaming: event-time windows, and the state machine on live series."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymo.session import scratch_root, ship


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder (or file, by its parent) as a stream; ``ts`` is cast, as watermarks need an instant."""
    schema = spark.read.parquet(path).schema
    parent, name = path.rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).option("recursiveFileLookup", "false").parquet(parent) if name.endswith(".parquet") and _is_file(spark, path) else spark.readStream.schema(schema).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts and sums per hour and type, streamed once over what is there; late data up to a day is kept."""
    root = f"{scratch_root(spark)}/kymo-{uuid.uuid4().hex}"
    windows = read_events(spark, path).withWatermark("ts", "1 day").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.select(F.date_format("window.start", "yyyy-MM-dd HH:00").alias("hour_start"), "event_type", "n", F.round("total", 4).alias("total")).write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

    q = windows.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    last = out.agg(F.max("epoch")).first()[0]
    return out.where(F.col("epoch") == last).drop("epoch")


def stream_machine(events: DataFrame, entity: str, value: str, t_on: float, t_off: float, k_on: int, k_off: int, cooldown: int, alpha: float) -> DataFrame:
    """The state machine per entity over a stream ordered by ``ts`` within each batch."""
    import pandas as pd

    ship(events.sparkSession)

    def advance(key: tuple, frames: Iterator[pd.DataFrame], memory) -> Iterator[pd.DataFrame]:
        score, on_state, on, off, steps = memory.get if memory.exists else (None, 0, 0, 0, 999)
        rows = pd.concat(list(frames)).sort_values("ts")
        out = []
        for ts, p in zip(rows["ts"], rows[value], strict=True):
            score = p if score is None else alpha * p + (1 - alpha) * score
            steps += 1
            if on_state == 0:
                on = on + 1 if score > t_on else max(0, on - 1)
                flips = on >= k_on and steps >= cooldown
            else:
                off = off + 1 if score < t_off else max(0, off - 1)
                flips = off >= k_off and steps >= cooldown
            if flips:
                on_state, on, off, steps = 1 - on_state, 0, 0, 0
            out.append((key[0], ts, score, on_state))
        memory.update((score, on_state, on, off, steps))
        yield pd.DataFrame(out, columns=[entity, "ts", "score", "state"])

    kind = events.schema[entity].dataType.simpleString()
    return events.groupBy(entity).applyInPandasWithState(advance, f"{entity} {kind}, ts timestamp, score double, state int", "score double, state int, n_on int, n_off int, steps int", "append", "NoTimeout")
