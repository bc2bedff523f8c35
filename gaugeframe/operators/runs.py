"""Run statistics: timing summaries, speedups, job analysis, benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clean_number
from ..functions.status import run_warnings, verdict
from ..plans.skew import HOT_KEYS, rename_keys, same_key
from ..schema import TOP_CHECKED
from .order_stats import bracket_values, middle_of, middle_values
from .profile import GROUP_KEYS, profile_totals, top_anomalies


def medians(runs: DataFrame, by: list[str], value: str, median: str = "mid",
            hot_keys: int = HOT_KEYS, large_keys: bool = False) -> DataFrame:
    """``by, median``: ``mid`` averages the two middle values, ``upper`` takes the second."""
    if median not in ("mid", "upper"):
        raise ValueError(f"median must be 'mid' or 'upper', got {median!r}")
    middle = middle_values(runs, by, value, hot_keys, large_keys=large_keys)
    upper = F.col("upper_middle")
    return middle.select(*by, (upper if median == "upper"
                               else (F.col("lower_middle") + upper) / 2).alias("median"))


def timing_summary(runs: DataFrame, by: list[str], value: str, median: str = "mid",
                   hot_keys: int = HOT_KEYS, large_keys: bool = False) -> DataFrame:
    """runs, median, mean, sample stdev, min, max and CV% per group; one run has stdev and CV 0.
    ``large_keys`` is for groups of more than about 5 * 10^7 runs, see ``middle_values``."""
    if median not in ("mid", "upper"):
        raise ValueError(f"median must be 'mid' or 'upper', got {median!r}")
    rows = runs.select(*by, clean_number(value).alias("__v"))
    x = F.col("__v")
    # One pass gives the moments and the brackets of the medians, a second the medians.
    stats = bracket_values(rows, by, mean=F.avg(x), min=F.min(x), max=F.max(x),
                           stdev=F.when(F.count(x) > 0, F.coalesce(F.stddev_samp(x), F.lit(0.0))))
    middle = middle_of(rows.filter("__v IS NOT NULL"), stats.filter("__n > 0"), by, hot_keys, large_keys=large_keys)
    upper = F.col("upper_middle")
    middle = rename_keys(middle.select(*by, (upper if median == "upper" else (
        F.col("lower_middle") + upper) / 2).alias("median")), by)
    return (stats.join(middle, same_key(by), "left")
            .select(*by, F.col("__n").alias("runs"), "median", "mean", "stdev", "min", "max",
                    F.when(F.col("__n") > 1, F.try_divide(F.col("stdev"), F.col("mean")) * 100)
                     .when(F.col("__n") == 1, F.lit(0.0)).alias("cv_pct")))


def compare_runs(runs: DataFrame, baseline: str, candidate: str, job: str = "job_id",
                 pipeline: str = "pipeline", value: str = "seconds",
                 hot_keys: int = HOT_KEYS) -> DataFrame:
    """Per job: medians of two pipelines, speedup, and time saved in percent.

    A job that lacks one of the two, or divides by zero, has NULLs.
    """
    both = runs.filter(F.col(pipeline).isin(baseline, candidate))
    per_run = medians(both, [job, pipeline], value, hot_keys=hot_keys)

    def of(name: str) -> Column:
        return F.max(F.when(F.col(pipeline) == name, F.col("median")))

    return (per_run.groupBy(job)
            .agg(of(baseline).alias("baseline_s"), of(candidate).alias("candidate_s"))
            .withColumns({
                "speedup": F.try_divide("baseline_s", "candidate_s"),
                "reduction_pct": (1 - F.try_divide("candidate_s", "baseline_s")) * 100,
            }))


def analyze_jobs(norm: DataFrame, runs: DataFrame, rate_base: str = "groups") -> DataFrame:
    """Analysis of each job from its normalisation row and its run rows.

    ``norm``: job_id, backend, total_s. ``runs``: job_id, pipeline, run_id, groups, anomalies,
    median_s (and readings for ``rate_base="readings"``). The usual rate is anomalies per
    *group*. A pipeline's seconds come from its first run by run_id that has any; the texts show
    numbers rounded by ``round_scaled``. Everything is a bounded aggregate per job: no list of
    runs is built.
    """
    if rate_base not in ("groups", "readings"):
        raise ValueError(f"rate_base must be 'groups' or 'readings', got {rate_base!r}")

    def first_seconds(name: str) -> Column:
        mine = (F.col("pipeline") == name) & F.col("median_s").isNotNull()
        return F.min_by(F.when(mine, F.col("median_s")), F.when(mine, F.col("run_id")))

    per_job = runs.groupBy("job_id").agg(
        first_seconds("rdd").alias("rdd_s"), first_seconds("dataframe").alias("dataframe_s"),
        F.max(rate_base).alias("__base"), F.max("anomalies").alias("__anomalies"),
        (F.min("groups") < F.max("groups")).alias("__differ"))
    base, anomalies = (F.coalesce(F.col(c), F.lit(0)) for c in ("__base", "__anomalies"))
    return (norm.select("job_id", "backend", "total_s").join(per_job, "job_id", "left")
            .withColumns({
                "anomaly_rate": F.when(base > 0, anomalies / base).otherwise(F.lit(0.0)),
                "speedup": F.when(F.col("dataframe_s") > 0,
                                  F.try_divide("rdd_s", "dataframe_s")),
            })
            .select("job_id", "anomaly_rate", "rdd_s", "dataframe_s", "speedup", "backend",
                    "total_s", verdict(F.col("speedup"), rounded=True).alias("verdict"),
                    run_warnings(F.col("backend"), F.col("__differ"),
                                 F.col("anomaly_rate"), rounded=True).alias("warnings")))


def bench_pivot(df: DataFrame) -> DataFrame:
    """One row per size ``n`` of a benchmark table: times side by side, speedups, efficiency.

    Sizes without a one-thread row are left out. Of several rows for one column the one with
    the most threads, then the lowest time, is used. A ratio over a time of zero is NULL.
    """
    cpu = F.col("impl") == "cpu_omp"
    picked = {
        "cpu1": cpu & (F.col("threads") == 1),
        "cpun": cpu & (F.col("threads") != 1),
        "gpu": F.col("impl").startswith("gpu_cuda"),
    }
    row = F.struct("threads", (-F.col("ms_mediana")).alias("order"), "ms_mediana", "kernel_ms",
                   "h2d_ms", "d2h_ms")
    wide = df.groupBy("n").agg(*[F.max(F.when(cond, row)).alias(name)
                                 for name, cond in picked.items()])
    cpu1, cpun, gpu = (F.col(f"{name}.ms_mediana") for name in picked)
    return (wide.filter(F.col("cpu1").isNotNull())
            .select(
                "n", cpu1.alias("cpu1_ms"), cpun.alias("cpun_ms"), gpu.alias("gpu_ms"),
                F.col("gpu.kernel_ms").alias("kernel_ms"),
                F.try_divide(cpu1, cpun).alias("cpu_speedup"),
                (F.try_divide(cpu1, cpun) / F.nullif(F.col("cpun.threads"), F.lit(0)) * 100)
                .alias("cpu_efficiency_pct"),
                F.try_divide(cpu1, gpu).alias("gpu_speedup_vs_1"),
                F.try_divide(cpun, gpu).alias("gpu_speedup_vs_n"),
                (F.try_divide(F.col("gpu.h2d_ms") + F.col("gpu.d2h_ms"), gpu) * 100)
                .alias("transfer_pct"),
                *[effective_gbps(F.col("n"), ms).alias(f"{name}_gbps")
                  for name, ms in (("cpu1", cpu1), ("cpun", cpun))]))


def effective_gbps(n: Column, ms: Column) -> Column:
    """Two reads and one write of float32 per element; 0 for a time of zero."""
    return F.when(ms > 0, F.try_divide(n * 12.0, ms * 1e6)).when(ms.isNotNull(), F.lit(0.0))


def metrics_record(profile: DataFrame, times_s: list[float], pipeline: str, input: str) -> DataFrame:
    """The one-row record of a timed run over a profile: totals, upper median, first rows."""
    top = top_anomalies(profile, TOP_CHECKED).agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("anomaly_ratio")).alias("__ratio"), (-F.col("readings")).alias("__readings"),
        *GROUP_KEYS, F.struct(*profile.columns).alias("__row")))).alias("rows"))
    ordered = sorted(times_s)
    return profile_totals(profile).select(
        F.lit(pipeline).alias("pipeline"), F.lit(input).alias("input"),
        F.lit(len(times_s)).alias("runs"),
        F.array(*[F.lit(float(t)) for t in times_s]).alias("times_s"),
        F.lit(float(ordered[len(ordered) // 2])).alias("median_s"),
        F.lit(float(ordered[0])).alias("min_s"), "groups", "anomalies",
        top.select(F.transform("rows", lambda r: r["__row"])).scalar().alias("top"),
        F.lit(profile.sparkSession.version).alias("spark_version"))
