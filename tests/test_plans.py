"""Shape of the physical plans: what is pushed down, shuffled, broadcast."""

import re

import pytest

from gaugeframe.operators import retain
from gaugeframe.plans import catalog, views

PYTHON_QUERIES = {"decode_f32", "read_npy", "read_npy_files"}
ROUND_TRIPS = {"csv_round_trip", "normalized_sink", "profile_sink", "metrics_round_trip", "bench_csv"}


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored_profile(spark, sf_dir, tmp_path_factory):
    """Telemetry with its normalised column on disk, read back and profiled."""
    from gaugeframe.operators import anomaly_profile, enrich, filter_quality, normalize, top_anomalies
    from gaugeframe.sources import read_telemetry, write_normalized

    path = str(tmp_path_factory.mktemp("plans") / "telemetry")
    write_normalized(normalize(views.telemetry(spark, sf_dir), "value"), path)
    return top_anomalies(enrich(anomaly_profile(filter_quality(read_telemetry(spark, path)))))


def test_profile_plan(stored_profile):
    text = plan(stored_profile)
    assert "GreaterThanOrEqual(quality,60)" in re.search(r"PushedFilters: (.*)", text).group(1)
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["quality", "region", "sensor_id", "value_norm"]
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"- Exchange", tree)) == 1
    assert tree.count("HashAggregate") == 2
    assert "BroadcastHashJoin LeftOuter" in tree and "TakeOrderedAndProject" in tree


def test_global_normalisation_moves_no_rows(spark, sf_dir):
    df = catalog.queries()["normalize_zscore"](spark, sf_dir)
    text = plan(df)
    main = text.split("===== Subqueries =====")[0]
    assert "Exchange" not in main and "Join" not in main
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert final.count("ReusedSubquery") or final.count("Subquery subquery#") >= 1


def test_statistics_read_one_column(spark, sf_dir):
    text = plan(catalog.q_normalize_summary(spark, sf_dir))
    assert "ReadSchema: struct<l_quantity:double>" in text


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - ROUND_TRIPS))
def test_no_product_joins_and_python_only_where_needed(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    python = re.search(r"ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas", text)
    assert bool(python) == (name in PYTHON_QUERIES)


def test_retention_reaches_the_scan(spark, sf_dir):
    text = plan(catalog.q_retain_jobs(spark, sf_dir))
    assert "GreaterThan(ts," in re.search(r"PushedFilters: (.*)", text).group(1)
    assert retain.__doc__


@pytest.mark.parametrize("name", ["fold_jobs", "first_starts", "job_attempts", "typed_jobs"])
def test_job_logs_are_folded_by_hash(spark, sf_dir, name):
    text = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Window" not in text


def rows_read(df) -> int:
    """Rows that the scans of the executed plan gave, reused exchanges counted once."""
    df.collect()

    def of(p) -> int:
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return of(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return of(p.plan())
        if name == "ReusedExchangeExec":
            return 0
        total = p.metrics().apply("numOutputRows").value() if name == "FileSourceScanExec" else 0
        children = p.children().iterator()
        while children.hasNext():
            total += of(children.next())
        subqueries = p.subqueries().iterator()
        while subqueries.hasNext():
            q = subqueries.next()
            if q.getClass().getSimpleName() == "SubqueryExec":
                total += of(q.child())
        return total

    return of(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("name,table,most", [
    ("timing_summary", "events", 2), ("timing_summary_hot", "events", 2), ("compare_runs", "events", 2),
    ("normalize_by_key", "lineitem", 2), ("normalize_by_many_keys", "lineitem", 3), ("profile_equivalence", "events", 3)])
def test_reads(spark, sf_dir, name, table, most):
    n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert rows_read(catalog.queries()[name](spark, sf_dir)) <= most * n
