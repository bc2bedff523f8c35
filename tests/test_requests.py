import pytest

from gaugeframe.operators import split_requests, validate_requests
from gaugeframe.sources import parse_requests

SCHEMA = ("job_id string, dataset_uri string, mode string, pipeline string, output_uri string, callback_url string")


def check(spark, *rows):
    return validate_requests(spark.createDataFrame(rows, SCHEMA))


def test_valid_request_gets_its_output(spark):
    row = check(spark, ("j1", "s3://bucket/data.parquet", "zscore", "both", None, None)).first()
    assert row["valid"] and row["errors"] == [] and row["output_uri"] == "s3://bucket/processed/j1/"
    row = check(spark, ("j1", "s3://bucket/data.parquet", "zscore", "both", "s3://o/", "https://h")).first()
    assert row["valid"] and row["output_uri"] == "s3://o/"


def test_all_errors_are_reported(spark):
    row = check(spark, ("j2", "ftp://x", "logaritmica", "spark", None, "mailto:x")).first()
    assert row["errors"] == [
        "datasetUri con esquema no soportado: ftp://x", "mode 'logaritmica' inválido (use minmax/zscore/robust)",
        "pipeline 'spark' inválido (use rdd/dataframe/both)", "callbackUrl debe ser http(s): mailto:x"]
    assert row["output_uri"] is None


def test_domains_are_case_sensitive_and_uri_required(spark):
    rows = check(spark, ("a", "s3://b/x", "ZSCORE", "both", None, None), ("b", None, "zscore", "both", None, None),
                 ("c", "s3://", "zscore", "both", None, None), ("d", "S3://x", "zscore", "both", None, None))
    assert [len(r["errors"]) for r in rows.collect()] == [1, 1, 1, 1]
    valid, invalid = split_requests(rows)
    assert (valid.count(), invalid.count()) == (0, 4)


@pytest.mark.parametrize("body,errors", [
    ('{"datasetUri": " s3://b/x "}', []),
    ('{"datasetUri": "u", "mode": null, "forceCpu": null, "extra": {"a": 1}}', []),
    ('{"mode": "zscore"}', ["falta el campo obligatorio 'datasetUri'"]),
    ('{"datasetUri": null}', ["falta el campo obligatorio 'datasetUri'"]),
    ('{"datasetUri": 5}', ["'datasetUri' debe ser una cadena, recibido 5"]),
    ('{"datasetUri": "u", "mode": "  ", "column": [1]}',
     ["'mode' debe ser una cadena, recibido \"  \"", "'column' debe ser una cadena, recibido [1]"]),
    ('{"datasetUri": "u", "forceCpu": "yes"}', ["'forceCpu' debe ser booleano, recibido \"yes\""]),
    ('[{"datasetUri": "u"}]', ["se esperaba un objeto JSON"]), ("{'datasetUri': 'u'}", ["se esperaba un objeto JSON"]),
    ('{"datasetUri": "u", "mode": ', ["se esperaba un objeto JSON"]), ("5", ["se esperaba un objeto JSON"]),
    ('{"datasetUri": {"a": 1}}', ["'datasetUri' debe ser una cadena, recibido {\"a\":1}"]),
    ('{"datasetUri": "a", "datasetUri": "b"}', []), ("{}", ["falta el campo obligatorio 'datasetUri'"]),
    ("[1]", ["se esperaba un objeto JSON"]), ("{bad", ["se esperaba un objeto JSON"]),
    (None, ["se esperaba un objeto JSON"]),
])
def test_parse_errors(spark, body, errors):
    df = spark.createDataFrame([(body,)], "body string")
    assert parse_requests(df, "body").first()["parse_errors"] == errors


def test_parse_defaults_and_values(spark):
    df = spark.createDataFrame([('{"datasetUri": " u ", "pipeline": "rdd", "forceCpu": true}',)], "body string")
    row = parse_requests(df, "body").first()
    assert (row["dataset_uri"], row["mode"], row["pipeline"], row["output_uri"], row["force_cpu"], row["column"]) == (
        "u", "zscore", "rdd", None, True, None)
