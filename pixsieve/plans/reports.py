"""Counts and tables read off a processed dataset."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.sources.manifest import dense_index


def status_counts(df: DataFrame) -> DataFrame:
    """``accepted, rejected``; rows in any other state count in neither."""
    status = F.col("status")
    return df.agg(
        F.count_if(F.coalesce(status == S.ACCEPTED, F.lit(False))).alias("accepted"),
        F.count_if(F.coalesce(status == S.REJECTED, F.lit(False))).alias("rejected"),
    )


def annotation_counts(annotations: DataFrame) -> DataFrame:
    good = F.coalesce(F.col("status") == S.SUCCESS, F.lit(False))
    return annotations.agg(F.count_if(good).alias("success"), F.count_if(~good).alias("failed"))


def merge_metrics(parts: DataFrame) -> DataFrame:
    """Partial metrics (of partitions, workers or runs) summed by operator."""
    return parts.groupBy("operator").agg(
        F.sum("processed").alias("processed"), F.sum("rejected").alias("rejected")
    )


def curation_funnel(metrics: DataFrame, dedup: DataFrame | None = None) -> DataFrame:
    """``stage, stage_pos, remaining, removed`` from operator metrics, dedup last.

    ``metrics`` has one row per operator label, so the running sum is over a handful of rows.
    """
    stages = metrics.select(
        F.col("operator").alias("stage"), (F.col("op_pos") + 1).alias("stage_pos"),
        F.col("processed"), F.col("rejected").alias("removed"),
    )
    start = metrics.agg(F.max("processed").alias("processed")).select(
        F.lit("Input").alias("stage"), F.lit(0).alias("stage_pos"), "processed",
        F.lit(0).cast("bigint").alias("removed"),
    )
    stages = start.unionByName(stages)
    if dedup is not None:
        stages = stages.unionByName(dedup.select(
            F.lit(S.DEDUP_LABEL).alias("stage"), F.lit(1_000_000).alias("stage_pos"),
            F.col("input_samples").alias("processed"), F.col("duplicates_removed").alias("removed"),
        ))
    upto = Window.orderBy("stage_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entered = F.max("processed").over(Window.orderBy("stage_pos").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    ))
    return stages.select(
        "stage", (F.row_number().over(Window.orderBy("stage_pos")) - 1).alias("stage_pos"),
        (entered - F.sum("removed").over(upto)).alias("remaining"), "removed",
    )


def run_rollup(runs: DataFrame) -> DataFrame:
    """Per (samples, executor): exact median time and throughput, runs, last run's counts.

    ``runs`` has ``samples, executor, run, seconds, accepted, rejected``. The medians come from
    one distributed sort: number all rows by (group, time) and pick the middle one or two of
    each group. No group is collected, however many runs it holds. Throughput falls as time
    grows, so its middle rows are the same. Runs without a time count as runs, but have no place among
    the times; a group without any time has no medians.
    """
    group = ["samples", "executor"]
    ranked = dense_index(runs, [*group, "seconds", "run"], "_rank")
    totals = ranked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("runs"), F.count("seconds").alias("_timed"),
        F.min(F.when(F.col("seconds").isNotNull(), F.col("_rank"))).alias("_first"),
        F.max_by("accepted", "run").alias("accepted"), F.max_by("rejected", "run").alias("rejected"),
    )
    low = F.col("_first") + F.floor((F.col("_timed") - 1) / 2)
    high = F.col("_first") + F.floor(F.col("_timed") / 2)
    middle = totals.select(
        *group, "runs", "accepted", "rejected", F.explode(F.array_distinct(F.array(low, high))).alias("_rank")
    )
    picked = middle.join(ranked.select("_rank", "seconds"), "_rank", "left")
    return picked.groupBy(*group, "runs", "accepted", "rejected").agg(
        F.avg("seconds").alias("median_time"),
        F.avg(throughput(F.col("samples"), F.col("seconds"))).alias("median_throughput"),
    ).select(*group, "runs", "median_time", "median_throughput", "accepted", "rejected")


# Values a sketch keeps per level. At 200 a quantile is off by less than SKETCH_ERROR of the ranks.
SKETCH_SIZE = 200
SKETCH_ERROR = 0.02


def sketch_runs(runs: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Runs as one mergeable row per (samples, executor), however many there are.

    ``times`` is a KLL sketch of the run times (a few KB), ``last_run`` says whose counts are ``accepted`` and ``rejected``.
    Store it, and merge it with those of later runs (``merge_sketches``) instead of reading old runs again.
    """
    return runs.groupBy("samples", "executor").agg(
        F.count(F.lit(1)).alias("runs"), F.count("seconds").alias("timed"),
        F.kll_sketch_agg_double("seconds", F.lit(size)).alias("times"), F.max("run").alias("last_run"),
        F.max_by("accepted", "run").alias("accepted"), F.max_by("rejected", "run").alias("rejected"),
    )


def merge_sketches(parts: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Sketched runs of several appends as one row per (samples, executor), to be stored or merged again."""
    return parts.groupBy("samples", "executor").agg(
        F.sum("runs").alias("runs"), F.sum("timed").alias("timed"),
        F.kll_merge_agg_double("times", F.lit(size)).alias("times"), F.max("last_run").alias("last_run"),
        F.max_by("accepted", "last_run").alias("accepted"), F.max_by("rejected", "last_run").alias("rejected"),
    )


def sketched_rollup(sketches: DataFrame) -> DataFrame:
    """``run_rollup`` from sketches: counts are exact, medians are run times within ``SKETCH_ERROR`` of the middle rank.

    Throughput falls as time grows, so its median belongs to the same run. A group without any time has no medians.
    """
    median = F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("times", F.lit(0.5)))
    return sketches.withColumn("median_time", median).select(
        "samples", "executor", "runs", "median_time",
        throughput(F.col("samples"), F.col("median_time")).alias("median_throughput"), "accepted", "rejected",
    )


def throughput(samples: Column, seconds: Column) -> Column:
    return samples / seconds


def speedup(rollup: DataFrame, baseline: str) -> DataFrame:
    """Median throughput against the baseline executor at the same number of samples."""
    base = rollup.filter(F.col("executor") == baseline).select(
        "samples", F.col("median_throughput").alias("_base")
    )
    return rollup.join(base, "samples", "left").withColumn(
        "speedup", F.col("median_throughput") / F.col("_base")
    ).drop("_base")
