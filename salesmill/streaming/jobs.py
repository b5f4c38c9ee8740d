"""Structured Streaming: the batch column functions over a stream of files."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from salesmill.functions.dates import year_month
from salesmill.functions.numeric import exact_sum, merge_parts, parts_mean, parts_sum, round_money, sum_parts
from salesmill.operators.clean import clean, finish
from salesmill.operators.impute import Fills, apply_fills
from salesmill.operators.price_store import PriceStore
from salesmill.operators.quality import split_corrupt
from salesmill.plans.profiles import Profile, get_profile
from salesmill.plans.staging import stage
from salesmill.sources.files import stream_csv


def stream_clean(spark: SparkSession, source: str, target: str, checkpoint: str, profile: str | Profile = "microbatch",
                 as_of=None, files_per_trigger: int | None = None) -> StreamingQuery:
    """Clean the files that have arrived and append them to `target`.

    The checkpoint remembers what was read, so a restart goes on from there without repeating rows.
    Progress counts are observed under the name `progress`.
    """
    rows = finish(clean(stream_csv(spark, source, files_per_trigger), profile, as_of), profile)
    counted = rows.observe("progress", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("date").isNull()).alias("bad_dates"))
    return (
        counted.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", target)
        .trigger(availableNow=True).start()
    )


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """`df`, and what counts its rows while it is written: no pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def record_progress(spark: SparkSession, path: str, epoch: int, counts: dict[str, int], seconds: float) -> None:
    """The counts of a micro-batch as a row of a table; a repeated batch replaces its row."""
    kinds = ", ".join(f"{c} long" for c in counts)
    row = spark.createDataFrame([(*counts.values(), seconds)], f"{kinds}, seconds double")
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={epoch}")


def total_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row: batches recorded so far, over all runs of the stream, and the sums of their counts."""
    rows = spark.read.parquet(path)
    counts = [c for c, kind in rows.dtypes if kind == "bigint"]
    return rows.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in counts])


def stream_split(spark: SparkSession, source: str, target: str, rejects: str, checkpoint: str, profile: str | Profile = "microbatch",
                 as_of=None, files_per_trigger: int | None = None, header: bool = True, progress: str | None = None) -> StreamingQuery:
    """Like `stream_clean`, but rows with a wrong field count go to `rejects` with their text and reason.

    A bad row never stops the stream. Each micro-batch is written to a folder of its own under both targets, so a
    repeated batch replaces itself. With `progress` a table there gets a row per batch: rows_in = rows_out + dropped (by
    the profile's own filters) + rejected.
    """
    p = get_profile(profile)

    def load(batch: DataFrame, epoch: int) -> None:
        start = time.monotonic()
        good, bad = split_corrupt(batch)
        good, usable = _counted(good, "usable")
        out, written = _counted(finish(clean(good, p, as_of), p), "written")
        out.write.mode("overwrite").parquet(f"{target}/batch={epoch}")
        bad, rejected = _counted(bad, "rejected")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={epoch}")
        if progress:
            n_usable, n_out, n_bad = (seen.get["n"] for seen in (usable, written, rejected))
            counts = {"rows_in": n_usable + n_bad, "rows_out": n_out, "dropped": n_usable - n_out, "rejected": n_bad}
            record_progress(batch.sparkSession, progress, epoch, counts, time.monotonic() - start)

    rows = stream_csv(spark, source, files_per_trigger, keep_corrupt=True, header=header)
    return (
        rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_impute(rows: DataFrame, fills: Fills, target: str, checkpoint: str, profile: str | Profile = "datamart") -> StreamingQuery:
    """Fill the prices of a stream of cleaned rows from the means of an earlier batch.

    The means stay those of that batch; `stream_moving_fills` moves them. Each micro-batch is
    written to a folder of its own under `target`, so a repeated batch replaces itself.
    """
    p = get_profile(profile)

    def load(batch: DataFrame, epoch: int) -> None:
        filled = finish(apply_fills(batch, fills, p.imputation), p)
        filled.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    return (
        rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_moving_fills(rows: DataFrame, store: PriceStore, target: str, checkpoint: str, profile: str | Profile = "datamart") -> StreamingQuery:
    """Fill the prices of a stream of cleaned rows from means that move with it.

    Each micro-batch first adds its sums to `store`, marked with its number, and is then filled from all rows so far. A
    repeated batch replaces its sums and its rows. Its cleaned rows are staged, so its files are read and cleaned once.
    """
    p = get_profile(profile)

    def load(batch: DataFrame, epoch: int) -> None:
        batch = stage(batch, "stream-batch")
        months = store.add(batch, mark=epoch)
        finish(apply_fills(batch, store.fills(months), p.imputation), p).write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    return (
        rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def customer_months(rows: DataFrame, late_months: int = 1) -> DataFrame:
    """Mergeable totals per calendar month and customer of a stream of finished rows.

    State holds a customer once per month, however many rows it has. A month is closed, and its state dropped, by the
    first row of a month more than `late_months` after the next one; rows of closed months are left out.
    """
    month_end = F.add_months(F.trunc("date", "month"), 1).cast("timestamp")
    timed = rows.where(F.col("date").isNotNull()).withColumn("month_end", month_end)
    kept = timed.withWatermark("month_end", f"{31 * late_months + 1} days").groupBy("month_end", "customer_id")
    return kept.agg(*[c.alias(n) for n, c in sum_parts(F.col("total_amount")).items()], F.try_sum("quantity").alias("quantity"))


def monthly_totals(spark: SparkSession, target: str) -> DataFrame:
    """The figures of `dashboard.monthly` from the last state of each customer and month that `stream_totals` wrote."""
    parts = ["s_exact", "s_float", "n_inexact", "n", "quantity"]
    last = spark.read.parquet(target).groupBy("month_end", "customer_id").agg(F.max_by(F.struct(*parts), "batch").alias("last"))
    # One row per customer and month, so counting rows counts distinct customers.
    months = last.select("month_end", "customer_id", "last.*").groupBy("month_end").agg(
        *[c.alias(n) for n, c in merge_parts().items()], F.count("customer_id").alias("customers"),
        F.when(F.count("quantity") == 0, F.lit(0).cast("long")).otherwise(F.try_sum("quantity")).alias("quantity"),
    )
    return months.select(
        year_month(F.add_months(F.col("month_end").cast("date"), -1)).alias("year_month"),
        round_money(F.coalesce(parts_sum(), F.lit(0.0))).alias("revenue"), round_money(parts_mean()).alias("avg_amount"),
        F.col("n").alias("transactions"), "quantity", "customers",
    )


def monthly_windows(rows: DataFrame, late: str = "7 days", length: str = "30 days") -> DataFrame:
    """Revenue and transactions per event-time window of a stream of cleaned rows.

    `timestamp` carries no zone, so it is read in the session's zone to serve as event time.
    """
    timed = rows.where(F.col("timestamp").isNotNull()).withColumn("event_time", F.col("timestamp").cast("timestamp"))
    windows = timed.withWatermark("event_time", late).groupBy(F.window("event_time", length))
    return windows.agg(
        exact_sum(F.col("total_amount")).alias("revenue"), F.count(F.lit(1)).alias("transactions")
    ).select(F.col("window.start").alias("window_start"), "revenue", "transactions")


def stream_totals(windows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the windows that each micro-batch changed to a folder of its own; `latest_totals` reads them back.

    Update mode: the watermark drops rows later than it allows and closes the state of windows it has passed. A
    repeated batch replaces itself.
    """
    keep = lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{target}/batch={epoch}")
    return (
        windows.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest_totals(spark: SparkSession, target: str) -> DataFrame:
    """The last state of each window that `stream_totals` wrote."""
    written = spark.read.parquet(target)
    last = written.groupBy("window_start").agg(F.max_by(F.struct("revenue", "transactions"), "batch").alias("last"))
    return last.select("window_start", "last.*")
