"""Incremental patterns on Structured Streaming: windows, rates, deduplication, queue state, incremental scoring."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, sf_dir: str, watermark: str = "10 minutes") -> DataFrame:
    """The events table as a stream of files; timestamps without zone are read as UTC."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)


def per_minute(events: DataFrame, minutes: int = 1) -> DataFrame:
    """Tumbling counts and sums per event type; batch or stream."""
    return events.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def trailing(events: DataFrame, length: str = "2 minutes", slide: str = "1 minute") -> DataFrame:
    """Sliding throughput."""
    return events.groupBy(F.window("ts", length, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a user (an extension: the award platform has none)."""
    return events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def deduplicated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First row of each key; on a stream, within the watermark."""
    return rows.dropDuplicatesWithinWatermark(keys) if rows.isStreaming else rows.dropDuplicates(keys)


def run_to_end(stream: DataFrame, folder: str, mode: str, checkpoint: str) -> DataFrame:
    """Run a query over all available input into Parquet files below ``folder``.

    Every batch has a folder of its own, which a repeated batch writes anew; in complete mode the last result stays.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.parquet(f"{folder}/start")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{'last' if mode == 'complete' else f'batch-{number}'}")

    query = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(folder)


def queue_states(outcomes: DataFrame, most: int = 4) -> DataFrame:
    """Status of each work item from its stream of outcomes (``node_id``, ``ok``): pending, done or failed."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, done = state.get if state.exists else (0, False)
        for b in batches:
            for ok in b["ok"]:
                if not done:
                    attempts, done = attempts + 1, bool(ok)
        state.update((attempts, done))
        status = "done" if done else "failed" if attempts >= most else "pending"
        yield pd.DataFrame({"node_id": [key[0]], "status": [status], "attempts": [attempts]})

    return outcomes.groupBy("node_id").applyInPandasWithState(step, "node_id long, status string, attempts int", "attempts int, done boolean", "update", GroupStateTimeout.NoTimeout)


def incremental(stream: DataFrame, score, target: str, keys: list[str], checkpoint: str) -> None:
    """Score only rows that are not in the Parquet table ``target`` yet, batch by batch.

    Each batch overwrites its own folder, so that a repeated batch adds nothing.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys)
        try:
            seen = spark.read.parquet(target).where(F.col("batch") < number)
            new = new.join(seen.select(*keys), keys, "left_anti")
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        score(new).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class GateFailed(RuntimeError):
    """A batch did not pass its gates; the stream stops before the batch is part of the table."""


def gated(stream: DataFrame, gates_of, folder: str, checkpoint: str) -> DataFrame:
    """The stream's rows below ``folder``, each batch only after its gates passed.

    ``gates_of`` gives the gates of a batch. A failing batch raises; started again, the stream takes it up anew.
    """
    from plumbline.operators.gates import checked

    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{folder}/start")

    def put(batch: DataFrame, number: int) -> None:
        failed = [r["gate"] for r in checked(gates_of(batch)).where("NOT passed").collect()]  # a row per gate
        if failed:
            raise GateFailed(f"batch {number}: {', '.join(failed)}")
        batch.write.mode("overwrite").parquet(f"{folder}/batch-{number}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(folder)


def cursor_stream(spark: SparkSession, schema, path: str, files_per_batch: int) -> DataFrame:
    """A table's files as a stream in batches of a few; the checkpoint is the cursor."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_of_each_text(stream: DataFrame, text: str) -> DataFrame:
    """Rows whose text's hash was not seen before in the run."""
    return stream.withColumn("sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).dropDuplicates(["sha"])


def with_remaining(rates: DataFrame, wanted: int) -> DataFrame:
    """Minutes left at the rate of each window, from what was done up to it. ``rates``: start, n, done."""
    return rates.withColumn("minutes_left", F.round(F.try_divide(F.greatest(F.lit(wanted) - F.col("done"), F.lit(0)) * 1.0, F.col("n")), 2))


def sampled(spark: SparkSession, sample, folder: str, checkpoint: str, rows_per_second: int = 1, seconds: int = 8) -> DataFrame:
    """A sampler: for each tick of a rate source ``sample(ticks)`` gives rows, which are appended below ``folder``, for ``seconds``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    query = sample(ticks).writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(processingTime="1 second").start()
    query.awaitTermination(seconds)
    query.stop()
    return spark.read.parquet(folder)


def token_budget(events: DataFrame, seconds: int = 60) -> DataFrame:
    """Sum of ``value`` over the trailing window of each user's events."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return events.select("event_id", "user_id", F.round(F.sum("value").over(w), 4).alias("trailing"))


def gap_control(outcomes: list[bool], start: float = 0.5, floor: float = 0.5, cap: float = 2.5, grow: float = 1.5, ease: float = 0.10, after: int = 8) -> float:
    """Gap between requests after a run of outcomes: grows on a block, eases after enough clean ones."""
    gap, clean = start, 0
    for ok in outcomes:
        clean = clean + 1 if ok else 0
        if not ok:
            gap = min(cap, gap * grow)
        elif clean >= after:
            gap, clean = max(floor, gap - ease), 0
    return gap
