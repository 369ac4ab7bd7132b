"""Structured Streaming jobs over the event files.

Each job is a normal streaming query: a file source, event-time windows with a
watermark, and a checkpoint in the shared folder. ``available_now`` drains what
has arrived and stops, so the same code serves a schedule and a test.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagewright.functions.numeric import cents, exact_sum
from wagewright.operators.loading import write_partitioned
from wagewright.session import parallelism
from wagewright.sources.tables import SCHEMAS


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for stateful queries over the event tables.

    The number of state partitions is fixed when a query first starts:
    ``partitions``, or the session's own shuffle partitions.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")  # the tables' times carry no zone: windows must not move with the caller's
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    return own


def event_stream(
    spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_trigger: int | None = None, with_file: bool = False
) -> DataFrame:
    """Events as they land in a folder; ``ts`` becomes a timestamp a watermark can use, ``landed_file`` names the file."""
    reader = spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(folder)
    if with_file:
        rows = rows.withColumn("landed_file", F.col("_metadata.file_path"))
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def table_stream(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of part files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    # Listed by Spark's reader, so that any store it reads will do; a lone file is watched through its parent folder.
    held = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").first()
    if held is None or held["path"].rstrip("/").endswith(f"/{name}.parquet"):
        return event_stream(spark, sf_dir, f"{name}.parquet")
    return event_stream(spark, path)


def drain(query) -> None:
    """Wait for an available-now query; an error in it is raised here."""
    query.awaitTermination()


def append_to(df: DataFrame, out: str, checkpoint: str) -> None:
    """Append mode into Parquet; the sink's own log makes a retried batch idempotent."""
    drain(
        df.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    drain(
        df.writeStream.outputMode(mode).foreachBatch(work)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def keep_latest(out: str) -> Callable[[DataFrame, int], None]:
    """Keep the whole result of a complete-mode query in two folders in turn, each with the batch it is of.

    A batch overwrites the result before the last, so that what readers see stays whole until the next is written, and no more than two
    results are ever kept. A replayed batch overwrites itself.
    """
    def work(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{out}/turn={batch_id % 2}")

    return work


def latest_batch(spark: SparkSession, out: str) -> DataFrame:
    """The last full result of a complete-mode query that ``keep_latest`` wrote."""
    kept = spark.read.parquet(out)
    newest = kept.agg(F.max("batch").alias("b")).scalar()
    return kept.filter(F.col("batch") == newest).drop("batch", "turn")


def running_totals(events: DataFrame) -> DataFrame:
    """Count and amount per event type since the start; state is one row per type."""
    return events.groupBy("event_type").agg(F.count("*").alias("events"), exact_sum(cents("value"), 2).alias("amount"))


def tumbling(events: DataFrame, width: str = "1 day", delay: str | None = None) -> DataFrame:
    """Count, amount and per-type breakdown per event-time window."""
    source = events.withWatermark("ts", delay) if delay else events
    kinds = {k: F.count_if(F.col("event_type") == k).alias(k) for k in ("view", "click", "purchase", "signup", "error")}
    sums = source.groupBy(F.window("ts", width)).agg(
        F.count("*").alias("events"), exact_sum(cents("value"), 2).alias("amount"), *kinds.values()
    )
    return sums.select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("window_start"),
        F.date_format("window.end", "yyyy-MM-dd HH:mm").alias("window_end"), "events", "amount", *kinds,
    )


def stage_files(events: DataFrame, folder: str, by: str | None = None) -> None:
    """Land rows as new files in a watched folder, from every task as it stands; ``by`` parts the files by a column."""
    if by:
        write_partitioned(events, folder, [by], mode="append")
    else:
        events.write.mode("append").parquet(folder)


def tagged(out: str) -> Callable[[DataFrame, int], None]:
    """Write each row with the batch it came in; a replayed batch overwrites itself."""
    def work(df: DataFrame, batch_id: int) -> None:
        df.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{out}/run_batch={batch_id}")

    return work


def files_per_batch(spark: SparkSession) -> int:
    """A bounded batch: as many files as a quarter of the session's tasks."""
    return max(1, parallelism(spark) // 4)


def running_by_key(rows: DataFrame, key: str, at: str, tie: str, units: str, shares: int = 1 << 11) -> DataFrame:
    """Each row with its number (``nth``, from 1) and the sum of ``units`` so far (``total``) among the rows of its key, in order of arrival.

    Keyed state: two numbers per key, kept from batch to batch and over restarts on the same checkpoint. Keys share ``shares`` states by
    their hash, so that a call of the function serves many keys at once; a checkpoint keeps the number it began with. Within a batch rows are
    ordered by ``at`` and ``tie``; the batch's size, which the source bounds, is what one state's rows can need of memory. ``key``, ``tie``
    and ``units`` are whole numbers.
    """
    import pandas as pd

    sums = ["nth", "total"]

    def work(group, parts, state):
        held = pd.DataFrame(dict(zip([key, *sums], state.get if state.exists else ([], [], []))), dtype="int64")
        new = pd.concat(list(parts)).sort_values([at, tie], kind="stable")
        both = pd.concat([held, pd.DataFrame({key: new[key], "nth": 1, "total": new[units]})], ignore_index=True)
        both[sums] = both.groupby(key, sort=False)[sums].cumsum()
        last = both.drop_duplicates(key, keep="last")
        state.update(tuple(last[c].tolist() for c in (key, *sums)))
        yield both.iloc[len(held):].assign(**{tie: new[tie].to_numpy()})[[key, tie, *sums]].astype("int64")

    schema = f"{key} long, {tie} long, nth long, total long"
    shared = rows.select(key, at, tie, units, F.pmod(F.xxhash64(key), F.lit(shares)).alias("_share")).groupBy("_share")
    return shared.applyInPandasWithState(work, schema, "keys array<long>, n array<long>, total array<long>", "append", "NoTimeout")
