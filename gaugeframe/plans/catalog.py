"""Every registered query: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode_f32, f32_problem, normalize_array, run_family
from ..functions.instants import parse_instant, print_instant
from ..functions.numeric import round_scaled
from ..operators import (
    accept_starts, analyze_folded, analyze_jobs, anomaly_profile, bench_pivot, classify_failures, column_stats,
    compare_runs, decode_status, diff_tables, encode_status, enrich, equivalent, filter_quality, fold_jobs, job_attempts,
    job_counts, job_status_json, lookup_job, max_rel_error, metrics_record, normalize, normalize_modes,
    normalize_summary, parse_job_status, profile_totals, project_profile_input, recent_jobs, retain,
    sample_exact, split_requests, timing_summary, top_anomalies, typed_jobs, validate_requests,
)
from ..sources import (
    block_outlier, parse_requests, pick_column, read_bench, read_npy, read_runs, read_telemetry,
    telemetry_from_ids, write_metrics, write_normalized, write_profile, write_table,
)
from . import views
from .scratch import scratch_path

MODES = {"zscore": "zscore", "minmax": "minmax", "robust": "robust"}
PROFILE_DOUBLES = ["mean_norm", "stddev_norm", "min_norm", "max_norm", "anomaly_ratio"]
NOW = "2024-02-15 00:00:00"


def _round(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def normalized_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(views.telemetry(spark, sf_dir), "value")


def _profile(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    readings = filter_quality(normalized_telemetry(spark, sf_dir))
    return anomaly_profile(project_profile_input(readings), **options)


def enriched_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_profile(spark, sf_dir))


def q_anomaly_profile(spark, sf_dir):
    return _round(enriched_profile(spark, sf_dir), *PROFILE_DOUBLES)


def q_top_anomalies(spark, sf_dir):
    return _round(top_anomalies(enriched_profile(spark, sf_dir)), *PROFILE_DOUBLES)


def q_top_first_rows(spark, sf_dir):
    return _round(top_anomalies(enriched_profile(spark, sf_dir), 5), *PROFILE_DOUBLES)


def q_profile_totals(spark, sf_dir):
    return profile_totals(_profile(spark, sf_dir))


def q_profile_null_zero(spark, sf_dir):
    return _round(_profile(spark, sf_dir, null_policy="zero"), *PROFILE_DOUBLES)


def q_profile_unmatched_null(spark, sf_dir):
    return _round(enrich(_profile(spark, sf_dir), unmatched="null"), *PROFILE_DOUBLES)


def q_region_profile_lineitem(spark, sf_dir):
    readings = filter_quality(normalize(views.line_readings(spark, sf_dir), "value"))
    # Region depends on the supplier, so the join comes after the aggregation.
    profile = anomaly_profile(readings, keys=["l_suppkey"], sigma=1.5)
    return _round(profile.join(views.supplier_regions(spark, sf_dir), "l_suppkey"),
                  *PROFILE_DOUBLES)


def q_quality_filter(spark, sf_dir):
    return filter_quality(views.telemetry(spark, sf_dir)).select(
        "sensor_id", "region", "ts", "value", "quality")


def q_column_stats(spark, sf_dir):
    return _round(column_stats(views.telemetry(spark, sf_dir), "value"),
                  "mean", "stddev", "sum", "sumsq", digits=4)


def q_pick_column_stats(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    picked = [pick_column(orders), pick_column(orders, default="first"),
              pick_column(orders, "o_totalprice")]
    parts = [column_stats(orders, c).select(F.lit(i).alias("choice"), F.lit(c).alias("col_name"),
                                            "n", "min", "max") for i, c in enumerate(picked)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _line_normalized(mode: str, precision: str = "double", digits: int = 6):
    def query(spark, sf_dir):
        lines = views.table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_extendedprice")
        out = normalize(lines, "l_extendedprice", mode, precision=precision)
        return out.select("l_orderkey", "l_linenumber",
                          F.round(F.col("value_norm").cast("double"), digits).alias("value_norm"))
    return query


def q_normalize_by_key(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    out = normalize_modes(lines, "l_extendedprice", MODES, by=["l_returnflag"])
    return _round(out.drop("l_extendedprice"), *MODES)


def q_normalize_by_many_keys(spark, sf_dir):
    """One key with a third of the rows and more others than the broadcast bound: some rows
    go by broadcast and some by shuffle."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_orderkey") % 3 == 0, -1).otherwise(F.col("l_partkey")).alias("k"))
    out = normalize_modes(lines, "l_extendedprice", MODES, by=["k"], hot_keys=100)
    return _round(out.drop("l_extendedprice"), *MODES)


def q_normalize_fixed(spark, sf_dir):
    out = normalize(views.table(spark, sf_dir, "events"), "value",
                    stats={"mean": 100.0, "stddev": 25.0})
    return _round(out.select("event_id", "value_norm"), "value_norm")


def q_normalize_summary(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    out = normalize_summary(lines, "l_quantity", "robust")
    return _round(out, "mean", "stddev", "shift", "scale")


def _array_normalized(mode: str):
    def query(spark, sf_dir):
        vectors = views.table(spark, sf_dir, "embeddings").select(
            "vec_id", normalize_array("embedding", mode).alias("v"))
        return (vectors.select("vec_id", F.posexplode("v").alias("pos", "x"))
                .withColumn("x", F.round("x", 5)))
    return query


def q_timing_summary(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    out = timing_summary(events, ["user_id", "event_type"], "value")
    return _round(out, "median", "mean", "stdev", "cv_pct")


def q_timing_summary_hot(spark, sf_dir):
    """The same over few large groups, with one key by broadcast and the others by shuffle."""
    out = timing_summary(views.table(spark, sf_dir, "events"), ["event_type"], "value",
                         hot_keys=2)
    return _round(out, "median", "mean", "stdev", "cv_pct")


def q_timing_summary_upper(spark, sf_dir):
    out = timing_summary(views.runs(spark, sf_dir), ["job_id", "pipeline"], "seconds",
                         median="upper")
    return _round(out, "median", "mean", "stdev", "cv_pct")


def q_compare_runs(spark, sf_dir):
    out = compare_runs(views.runs(spark, sf_dir), "rdd", "dataframe")
    return _round(out, "baseline_s", "candidate_s", "speedup", "reduction_pct")


def _job_analysis(rate_base: str):
    def query(spark, sf_dir):
        out = analyze_jobs(views.job_backends(spark, sf_dir), views.run_results(spark, sf_dir),
                           rate_base)
        return out.withColumns({"warnings": F.array_join("warnings", "; "),
                                **{c: round_scaled(F.col(c), 6) for c in ("anomaly_rate", "speedup")}})
    return query


def q_bench_pivot(spark, sf_dir):
    out = bench_pivot(views.bench_rows(spark, sf_dir))
    return _round(out, *[c for c in out.columns if c != "n"])


def q_profile_equivalence(spark, sf_dir):
    return equivalent(_profile(spark, sf_dir), _profile(spark, sf_dir, sigma=2.5))


def q_diff_tables(spark, sf_dir):
    left = _profile(spark, sf_dir)
    changed = F.col("readings") % 5 == 0
    right = (left.filter(~F.col("sensor_id").endswith("3"))
             .withColumn("mean_norm", F.col("mean_norm") + F.when(changed, 0.5).otherwise(0.0)))
    out = diff_tables(left.filter(~F.col("sensor_id").endswith("4")), right,
                      ["region", "sensor_id"], ["mean_norm", "anomaly_ratio"])
    return _round(out, "left", "right")


def q_max_rel_error(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").withColumn(
        "got", F.when(F.col("l_orderkey") % 50 != 0, F.col("l_extendedprice").cast("float").cast("double")))
    return _round(max_rel_error(lines, "l_extendedprice", "got"), "max_rel_error", digits=12)


def q_validate_requests(spark, sf_dir):
    out = validate_requests(views.requests(spark, sf_dir))
    return out.withColumn("errors", F.array_join("errors", "; "))


def q_split_requests(spark, sf_dir):
    parts = split_requests(validate_requests(views.requests(spark, sf_dir)))
    counts = [p.groupBy("valid").agg(F.count(F.lit(1)).alias("requests"),
                                     F.sum(F.size("errors")).alias("problems")) for p in parts]
    return counts[0].unionByName(counts[1])


def q_parse_requests(spark, sf_dir):
    out = parse_requests(views.request_json(spark, sf_dir), "body").drop("body")
    return out.withColumn("parse_errors", F.array_join("parse_errors", "; "))


def q_fold_jobs(spark, sf_dir):
    state = fold_jobs(views.job_log(spark, sf_dir), now=_now())
    attempts = F.array_sort(F.transform(F.map_entries("attempts"), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))))
    return _round(state.withColumn("attempts", F.array_join(attempts, ",")), "elapsed_s", digits=3)


def q_job_attempts(spark, sf_dir):
    return job_attempts(views.job_log(spark, sf_dir))


def _job_states(spark, sf_dir):
    return fold_jobs(views.job_log(spark, sf_dir)).select(
        "job_id", "stage", "created_at", "updated_at", "is_terminal")


def q_job_status_json(spark, sf_dir):
    states = fold_jobs(views.job_log(spark, sf_dir))
    return parse_job_status(job_status_json(states), "status")


def q_analysis_from_log(spark, sf_dir):
    out = analyze_folded(typed_jobs(views.result_log(spark, sf_dir)))
    return _round(out.withColumn("warnings", F.array_join("warnings", "; ")), "anomaly_rate", "speedup", "total_s")


def _shown(run: Column) -> Column:
    """A run as text, its fields between bars."""
    return F.concat_ws("|", run["pipeline"], run["runId"], run["groups"].cast("string"), run["anomalies"].cast("string"),
                       F.format_string("%.3f", run["medianSeconds"]), F.coalesce(run["outputUri"], F.lit("-")))


def _flat_status(jobs: DataFrame) -> DataFrame:
    gpu, analysis, request = F.col("gpu"), F.col("analysis"), F.col("request")
    attempts = F.array_sort(F.transform(F.map_entries("attempts"), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))))
    return jobs.select(
        "job_id", "stage", "created_at", "updated_at", F.array_join(attempts, ",").alias("attempts"),
        request["datasetUri"].alias("dataset_uri"), request["mode"].alias("mode"), request["pipeline"].alias("pipeline"),
        request["outputUri"].alias("request_output"), request["forceCpu"].alias("force_cpu"), request["column"].alias("column"),
        gpu["backend"].alias("backend"), gpu["device"].alias("device"), gpu["elements"].alias("elements"),
        gpu["mean"].alias("mean"), gpu["stddev"].alias("stddev"), gpu["kernelMs"].alias("kernel_ms"),
        gpu["wallMs"].alias("wall_ms"), gpu["outputUri"].alias("output_uri"),
        F.array_join(F.transform("spark", _shown), ",").alias("spark"), analysis["anomalyRate"].alias("anomaly_rate"),
        analysis["rddSeconds"].alias("rdd_s"), analysis["gpuBackend"].alias("gpu_backend"),
        analysis["totalSeconds"].alias("total_s"), analysis["verdict"].alias("verdict"),
        F.array_join(analysis["warnings"], ",").alias("warnings"), "error")


def q_typed_jobs(spark, sf_dir):
    return _flat_status(typed_jobs(views.result_log(spark, sf_dir)))


def q_job_status_round_trip(spark, sf_dir):
    """Whole statuses to JSON and back; every 17th text is cut short on the way."""
    texts = encode_status(typed_jobs(views.result_log(spark, sf_dir)))
    cut = F.when(F.col("job_id") % 17 == 0, F.substring("status", 1, 40)).otherwise(F.col("status"))
    back = decode_status(texts.select(F.col("job_id").alias("of"), cut.alias("status")), "status")
    # A text that can't be read has no id: its row shows the job's own with a minus.
    return _flat_status(back.select("decoded.*", "of").withColumn("job_id", F.coalesce("job_id", -F.col("of"))))


def q_instants(spark, sf_dir):
    at = parse_instant("text")
    return views.instant_texts(spark, sf_dir).select("event_id", at.alias("at"), print_instant(at).alias("printed"))


def q_recent_jobs(spark, sf_dir):
    return recent_jobs(_job_states(spark, sf_dir))


def q_lookup_job(spark, sf_dir):
    return lookup_job(_job_states(spark, sf_dir), 7)


def q_retain_jobs(spark, sf_dir):
    log = views.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("job_id"), F.col("ts").alias("updated_at"))
    return retain(log, now=_now())


def q_job_counts(spark, sf_dir):
    return job_counts(views.run_states(spark, sf_dir))


def q_run_family(spark, sf_dir):
    return views.run_states(spark, sf_dir).select("run_id", run_family("state").alias("family"))


def q_first_starts(spark, sf_dir):
    starts = views.job_log(spark, sf_dir).select("job_id", "seq", "at", "payload")
    return accept_starts(starts)


def q_classify_failures(spark, sf_dir):
    return classify_failures(views.failures(spark, sf_dir), "error_class", "message")


def q_generate_telemetry(spark, sf_dir):
    readings = telemetry_from_ids(views.table(spark, sf_dir, "events"), "event_id")
    return _round(readings, "value", "value_norm")


def q_telemetry_exact_outliers(spark, sf_dir):
    """Events as generated readings, with exactly 4 outliers at random places in each 1,000 rows and
    their share of the last ones."""
    events = views.table(spark, sf_dir, "events").select("event_id")
    bounds = events.agg(F.struct(F.min("event_id").alias("first"), F.count(F.lit(1)).alias("rows")).alias("b")).scalar()
    numbered = events.withColumns({"number": F.col("event_id") - bounds["first"], "rows": bounds["rows"]})
    outlier = block_outlier(F.col("number"), F.col("rows"), block_rows=1000)
    return _round(telemetry_from_ids(numbered, "event_id", outlier=outlier), "value", "value_norm")


def q_sample_exact(spark, sf_dir):
    """A tenth of all events, chosen at random without replacement."""
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return sample_exact(events, ["event_id"], fraction=0.1)


def q_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "telemetry-csv")
    columns = ["sensor_id", "region", "ts", "value", "value_norm", "quality"]
    write_table(normalized_telemetry(spark, sf_dir).select(*columns), path, "csv")
    return _round(read_telemetry(spark, path, "csv"), "value_norm")


def q_normalized_sink(spark, sf_dir):
    path = scratch_path(spark, "telemetry-normalized")
    write_normalized(normalized_telemetry(spark, sf_dir), path)
    return _round(anomaly_profile(filter_quality(read_telemetry(spark, path))), *PROFILE_DOUBLES)


def q_profile_sink(spark, sf_dir):
    path = scratch_path(spark, "profile")
    write_profile(enriched_profile(spark, sf_dir), path)
    return _round(read_telemetry(spark, path), *PROFILE_DOUBLES)


def q_metrics_round_trip(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    profile = enriched_profile(spark, sf_dir)
    for pipeline, times in (("rdd", [3.0, 1.0, 2.0]), ("dataframe", [1.5, 0.5])):
        write_metrics(metrics_record(profile, times, pipeline, "events"), path)
    return read_runs(spark, path, multi_line=False)


def q_bench_csv(spark, sf_dir):
    path = scratch_path(spark, "bench-csv")
    write_table(views.bench_rows(spark, sf_dir), path, "csv")
    out = bench_pivot(read_bench(spark, path))
    return _round(out, *[c for c in out.columns if c != "n"])


def q_decode_f32(spark, sf_dir):
    @F.pandas_udf("binary")
    def raw(vectors: pd.Series) -> pd.Series:
        import numpy as np
        return vectors.map(lambda v: np.asarray(v, "<f4").tobytes())

    encoded = views.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.base64(raw("embedding")).alias("payload"))
    return encoded.select("vec_id", F.posexplode(decode_f32("payload")).alias("pos", "x"))


def q_malformed_payloads(spark, sf_dir):
    """Vectors' ids as payloads, good, missing and malformed, counted by what is wrong."""
    i = F.col("vec_id")
    raw = F.concat(F.repeat(F.lit("abcd"), (i % 5).cast("int")), F.when(i % 7 == 0, "x").otherwise(""))
    payload = F.when(i % 13 == 0, F.lit(None)).when(i % 11 == 0, F.lit("***")).otherwise(F.base64(F.encode(raw, "utf-8")))
    payloads = views.table(spark, sf_dir, "embeddings").select(payload.alias("payload"))
    return payloads.groupBy(f32_problem("payload").alias("problem")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("payload").alias("payloads"))


def q_enrich_large_dimension(spark, sf_dir):
    """Line items with their parts; one part that the dimension lacks holds a third of all rows, and
    only a few heavy keys may be broadcast."""
    lines = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(
        F.col("l_orderkey") % 3 == 0, -1).when(F.col("l_orderkey") % 31 != 0, F.col("l_partkey")).alias("p_partkey"))
    parts = views.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return enrich(lines, parts, on="p_partkey", defaults={"p_brand": "none", "p_size": 0}, large=True, hot_keys=50)


def q_read_npy(spark, sf_dir):
    path = scratch_path(spark, "npy")

    def save(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        root, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        root.create_dir(folder)
        for i, batch in enumerate(batches):
            # A name per partition and batch: a repeated task writes the same files again.
            values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            with root.open_output_stream(f"{folder}/part-{part}-{i}.npy") as out:
                np.save(out, values.reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["rows"])

    vectors = views.table(spark, sf_dir, "embeddings").repartition("vec_id")
    vectors.select("embedding").mapInArrow(save, "rows long").agg(F.sum("rows")).collect()
    elements = read_npy(spark, path, chunk_bytes=1 << 16)
    return elements.groupBy(F.round("value", 1).alias("bin")).agg(
        F.count(F.lit(1)).alias("elements"), F.min("value").alias("lowest"),
        F.max("value").alias("highest"))


def q_read_npy_files(spark, sf_dir):
    """Vectors as files of 64 each, read back: what every file holds, and in which order."""
    path = scratch_path(spark, "npy-files")

    def save(table):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        table = table.sort_by("vec_id")
        number = table["vec_id"][0].as_py() // 64
        root, folder = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        root.create_dir(folder)
        values = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        with root.open_output_stream(f"{folder}/vectors-{number}.npy") as out:
            np.save(out, values.reshape(table.num_rows, -1))
        return pa.table({"file": pa.array([number], pa.int64())})

    vectors = views.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    files = vectors.groupBy(F.floor(F.col("vec_id") / 64)).applyInArrow(save, "file bigint")
    files.agg(F.count("file")).collect()
    number = F.regexp_extract("path", r"vectors-(\d+)\.npy$", 1).cast("bigint")
    return read_npy(spark, path).groupBy(number.alias("file")).agg(
        F.count(F.lit(1)).alias("elements"), F.sum("idx").alias("sum_idx"), F.max("idx").alias("last_idx"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"), F.min_by("value", "idx").alias("first_value"),
        F.max_by("value", "idx").alias("last_value"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    for mode in MODES:
        named[f"normalize_{mode}"] = _line_normalized(mode)
        named[f"normalize_array_{mode}"] = _array_normalized(mode)
    named["normalize_float32"] = _line_normalized("zscore", "float", 4)
    named["job_analysis"] = _job_analysis("groups")
    named["job_analysis_readings"] = _job_analysis("readings")
    return named
