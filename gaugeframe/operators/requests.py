"""Validation of request rows, every error reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.uris import default_output
from ..schema import MODES, PIPELINES, URI_SCHEMES

# The texts a rejected request is answered with.
NO_URI = "datasetUri es obligatorio"
BAD_SCHEME = "datasetUri con esquema no soportado: %s"
BAD_MODE = "mode '%s' inválido (use minmax/zscore/robust)"
BAD_PIPELINE = "pipeline '%s' inválido (use rdd/dataframe/both)"
BAD_CALLBACK = "callbackUrl debe ser http(s): %s"


def _failed(check: Column, message: str, value: str) -> Column:
    before, after = message.split("%s")
    shown = F.coalesce(F.col(value), F.lit("null"))
    return F.when(~check, F.concat(F.lit(before), shown, F.lit(after)))


def validate_requests(df: DataFrame) -> DataFrame:
    """Adds ``errors`` and ``valid`` to ``job_id, dataset_uri, mode, pipeline, output_uri,
    callback_url``; a valid row gets its output filled in. Domains are case-sensitive."""
    uri = F.coalesce("dataset_uri", F.lit(""))
    scheme = f"^({'|'.join(URI_SCHEMES)})://.+"
    callback = F.col("callback_url")
    errors = F.array_compact(F.array(
        F.when(uri == "", F.lit(NO_URI)).otherwise(_failed(uri.rlike(scheme), BAD_SCHEME, "dataset_uri")),
        _failed(F.coalesce(F.col("mode").isin(MODES), F.lit(False)), BAD_MODE, "mode"),
        _failed(F.coalesce(F.col("pipeline").isin(PIPELINES), F.lit(False)), BAD_PIPELINE, "pipeline"),
        _failed(callback.startswith("https://") | callback.startswith("http://"), BAD_CALLBACK,
                "callback_url"),
    ))
    valid = F.size("errors") == 0
    return (df.withColumn("errors", errors).withColumn("valid", valid)
            .withColumns({
                "mode": F.when(F.col("valid"), F.lower("mode")).otherwise(F.col("mode")),
                "pipeline": F.when(F.col("valid"), F.lower("pipeline")).otherwise(F.col("pipeline")),
                "output_uri": F.when(F.col("valid"), F.coalesce(
                    "output_uri", default_output("dataset_uri", "job_id")))
                .otherwise(F.col("output_uri")),
            }))


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows of a validated table."""
    return df.filter("valid"), df.filter("NOT valid")
