"""Incremental work: resumable batches, file streams, daily budgets, pacing and leases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.operators import ingest as I
from marquee.operators import prefixes as P


def resume_offset(state: DataFrame, job: str, snapshot: str) -> int:
    """The stored offset of a job if its snapshot is the same, else 0."""
    row = state.where((F.col("job") == job) & (F.col("snapshot_id") == snapshot)).select("next_offset").first()
    return int(row.next_offset) if row else 0


def refresh_batch(cands: DataFrame, state: DataFrame, job: str, snapshot: str, size: int) -> tuple[DataFrame, DataFrame]:
    """The next batch of a job and the state after it."""
    start = resume_offset(state, job, snapshot)
    rows, end, total = I.slice_of(cands, start, size)
    status = "completed" if end >= total else "in_progress"
    path = f"checkpoints/{job}/{snapshot}/{start:08d}-{end:08d}"
    row = cands.sparkSession.createDataFrame([(job, snapshot, status, end, path)], "job string, snapshot_id string, status string, next_offset long, last_checkpoint_path string")
    return rows, upsert(state, row)


def upsert(state: DataFrame, rows: DataFrame) -> DataFrame:
    """State with the given jobs replaced or added."""
    return state.join(rows.select("job"), "job", "left_anti").unionByName(rows)


def finalize(state: DataFrame, job: str) -> DataFrame:
    """Marks a job completed and keeps its offsets; a job without state gets a default row."""
    spark = state.sparkSession
    have = state.where(F.col("job") == job).withColumn("status", F.lit("completed"))
    default = spark.createDataFrame([(job, None, "completed", 0, None)], "job string, snapshot_id string, status string, next_offset long, last_checkpoint_path string")
    return upsert(state, have.unionByName(default.join(have.select("job"), "job", "left_anti")))


def landing(spark: SparkSession, source: str, schema: StructType):
    """A stream reader of ``source``: a folder of files, or one file of a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2)
    first = spark.read.parquet(source).inputFiles()[0].rstrip("/")
    folder, _, name = source.rstrip("/").rpartition("/")
    if first.rpartition("/")[2] == name:
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(source)


def refresh_stream(spark: SparkSession, source: str, schema: StructType, work: str, transform) -> str:
    """Files landing in ``source`` through ``transform`` into ``work``/rows, one folder per batch: a batch that is
    repeated after a failure overwrites its own folder. Runs until all files are read; returns the folder."""
    out = f"{work}/rows"

    def put(df: DataFrame, batch: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream = landing(spark, source, schema)
    stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return out


def release_rows(raw: DataFrame) -> DataFrame:
    """What the stream of release candidates keeps: accepted ones as wide entities (N1), rejected ones as a reason."""
    checked = I.validate(raw)
    good = I.normalize_release(checked.where("reason is null")).select("pos", "entity_id", "title", "release_year", F.size("related").alias("edges"), F.lit(None).cast("string").alias("reason"))
    bad = checked.where("reason is not null").select("pos", F.lit(None).cast("string").alias("entity_id"), "title", F.lit(None).cast("int").alias("release_year"), F.lit(0).alias("edges"), "reason")
    return good.unionByName(bad)


def daily_budget(requests: DataFrame, limit: int) -> DataFrame:
    """Requests per provider and UTC day, and whether the day's limit is used up."""
    days = requests.groupBy("provider", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"))
    return days.select("provider", F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n", (F.col("n") >= limit).alias("exhausted"))


def daily_budget_stream(spark: SparkSession, source: str, schema: StructType, work: str, limit: int) -> str:
    """The same as a stream: each batch writes its partial counts into its own folder under ``work``/days, and a batch
    that is repeated after a failure overwrites it. No row is late and no day stays open; ``daily_counts`` reads them."""
    out = f"{work}/days"

    def put(df: DataFrame, batch: int) -> None:
        rows = df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("provider", F.concat(F.lit("p"), F.col("user_id") % 3))
        daily_budget(rows, limit).select("provider", "day", "n").write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream = landing(spark, source, schema)
    stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return out


def daily_counts(spark: SparkSession, out: str, limit: int) -> DataFrame:
    """The days of ``daily_budget`` from the partial counts of all batches so far."""
    parts = spark.read.schema("provider string, day string, n long").parquet(out)
    return parts.groupBy("provider", "day").agg(F.sum("n").alias("n")).withColumn("exhausted", F.col("n") >= limit)


def pacing(requests: DataFrame, step_us: int, rows_per_range: int = 500_000) -> DataFrame:
    """Earliest allowed start of each request at one per ``step_us``, its wait, and whether the gap before it was too short.

    The i-th request of a provider starts at ``i * step`` plus the greatest ``us - i * step`` so far. Rows are cut into ranges of time of
    about equal row counts (``prefixes.bounds``) and numbered inside them; what the ranges before add (their number, last time and greatest
    lead) is carried over, a row for each provider and range, so no task holds a provider's whole history.
    """
    cut = requests.withColumn("_range", P.range_of(F.col("us"), P.bounds(requests, "us", rows_per_range)))
    order = Window.partitionBy("provider", "_range").orderBy("us", "event_id")
    own = cut.withColumn("_k", F.row_number().over(order).cast("long") - 1).withColumn("_prior", F.lag("us").over(order))
    own = own.withColumn("_lead", F.max(F.col("us") - F.col("_k") * step_us).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    totals = own.groupBy("provider", "_range").agg(F.count("*").alias("_n"), F.max("us").alias("_last"), F.max("_lead").alias("_most"))
    earlier = Window.partitionBy("provider").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumn("_last", F.max("_last").over(earlier))
    carried = carried.withColumn("_ahead", F.max(F.col("_most") - F.col("_before") * step_us).over(earlier)).select("provider", "_range", "_before", "_last", "_ahead")
    out = P.with_carried(own, carried, "provider").withColumn("i", (F.col("_before") + F.col("_k")).cast("long"))
    start = F.col("i") * step_us + P.joined("max", F.col("_ahead"), F.col("_lead") - F.col("_before") * step_us)
    out = out.withColumn("start_us", start).withColumn("wait_us", F.col("start_us") - F.col("us"))
    violation = F.coalesce(F.col("us") - F.coalesce("_prior", "_last") < step_us, F.lit(False))
    return out.withColumn("violation", violation).drop("_range", "_k", "_prior", "_lead", "_before", "_last", "_ahead")


def lease_conflicts(runs: DataFrame, lease_us: int, rows_per_range: int = 500_000) -> DataFrame:
    """Runs that start before an earlier lease of their scope ends; maxima run over ranges of time and inside them."""
    out = P.running(runs, "provider", "us", ["us", "event_id"], {"held_until": ("max", F.col("us") + lease_us)}, rows_per_range, before=True)
    return out.withColumn("conflict", F.coalesce(F.col("us") < F.col("held_until"), F.lit(False)))


def uncached(calls: DataFrame, cache: DataFrame, key: str = "cache_key") -> DataFrame:
    return calls.join(cache.select(key), key, "left_anti")


def uncached_stream(spark: SparkSession, source: str, schema: StructType, work: str, calls, cache: DataFrame, key: str = "cache_key", ts: str = "ts", delay: str = "1 hour") -> str:
    """The stream form of ``uncached``: the calls (``calls`` of the landed rows) whose key is in no cache and came in no call of the last ``delay``.

    A key is held as state until the watermark, ``delay`` behind the latest ``ts`` read in earlier batches, has passed its time; rows
    older than the watermark are dropped. State grows with the keys of one ``delay`` (where that outgrows memory, the session names
    RocksDB as its state store). Each batch has its own folder under ``work``/calls, which a repeat after a failure overwrites;
    a restart goes on where the last run ended. Runs until all files are read; returns the folder.
    """
    out = f"{work}/calls"
    rows = calls(spark.readStream.schema(schema).parquet(source)).withWatermark(ts, delay)
    fresh = rows.dropDuplicatesWithinWatermark([key]).join(cache.select(key).distinct(), key, "left_anti")
    put = lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    fresh.writeStream.foreachBatch(put).option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return out


def daily_budget_events(spark: SparkSession, source: str, schema: StructType, work: str, requests, delay: str = "1 hour") -> str:
    """``daily_budget`` by event time: one-day windows held as state until the watermark, ``delay`` behind the latest ts of earlier batches, has passed their end.

    Every batch writes the days whose count it changed (update mode), with their count so far, into its own folder under ``work``/days, which a
    repeat overwrites; so days that are still open are there too. Rows of a day that the watermark has passed are dropped. ``latest_days`` reads.
    """
    out = f"{work}/days"
    rows = requests(spark.readStream.schema(schema).parquet(source)).withWatermark("ts", delay)
    days = rows.groupBy("provider", F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"))
    put = lambda df, batch: df.select("provider", F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n").write.mode("overwrite").parquet(f"{out}/batch={batch}")
    days.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start().awaitTermination()
    return out


def latest_days(spark: SparkSession, out: str, limit: int) -> DataFrame:
    """Each day's count of the last batch that changed it."""
    rows = spark.read.schema("provider string, day string, n long, batch long").parquet(out)
    return rows.groupBy("provider", "day").agg(F.max_by("n", "batch").alias("n")).withColumn("exhausted", F.col("n") >= limit)
