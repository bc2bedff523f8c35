"""Request rows from JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults of an omitted field and the texts of a malformed one.
DEFAULT_MODE = "zscore"
DEFAULT_PIPELINE = "both"
FIELDS = ["datasetUri", "mode", "pipeline", "outputUri", "callbackUrl", "forceCpu", "column"]
NOT_AN_OBJECT = "se esperaba un objeto JSON"
NOT_TEXT = "'{}' debe ser una cadena, recibido "
NOT_BOOLEAN = "'{}' debe ser booleano, recibido "
MISSING = "falta el campo obligatorio 'datasetUri'"

_BLANKS = " \t\r\n"
_CORRUPT = "__corrupt"


# What a schema can't tell: a field of text whose value is neither text nor null, and keys that may be
# spelled with escapes.
_TEXTS = [f for f in FIELDS if f != "forceCpu"]
_UNSURE = f'\\\\|"({"|".join(_TEXTS)})"\\s*:\\s*[^"\\sn]'
_OPTIONS = {"columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}


def parse_requests(df: DataFrame, json_col: str) -> DataFrame:
    """Adds the request fields and ``parse_errors``; only ``datasetUri`` is required.

    Text is trimmed. A blank or wrong-typed field is an error, a missing or JSON-null one
    takes its default. All fields of a malformed request are still given where readable.

    Every row is read by a typed schema first. Only rows that the schema rejects, or that it can't
    judge, are read again field by field.
    """
    schema = ", ".join([f"`{f}` {'BOOLEAN' if f == 'forceCpu' else 'STRING'}" for f in FIELDS] + [f"{_CORRUPT} STRING"])
    read = df.withColumn("__typed", F.from_json(json_col, schema, _OPTIONS))
    typed = {f: F.col("__typed")[f] for f in FIELDS}
    texts = {f: F.trim(typed[f], F.lit(_BLANKS)) for f in _TEXTS}
    plain = F.col("__typed")[_CORRUPT].isNull() & F.col(json_col).rlike(r"^\s*\{") & ~F.col(json_col).rlike(_UNSURE)
    for f in _TEXTS:
        given = texts[f] != ""
        plain = plain & (given.isNotNull() & given if f == "datasetUri" else F.coalesce(given, F.lit(True)))
    record = F.when(F.coalesce(plain, F.lit(False)), _record(
        texts | {"forceCpu": F.coalesce(typed["forceCpu"], F.lit(False))}, F.array().cast("array<string>")))
    return read.withColumn("__request", record.otherwise(_by_field(F.col(json_col)))).select(*df.columns, "__request.*")


def _record(value: dict[str, Column], errors: Column) -> Column:
    return F.struct(
        value["datasetUri"].alias("dataset_uri"), F.coalesce(value["mode"], F.lit(DEFAULT_MODE)).alias("mode"),
        F.coalesce(value["pipeline"], F.lit(DEFAULT_PIPELINE)).alias("pipeline"), value["outputUri"].alias("output_uri"),
        value["callbackUrl"].alias("callback_url"), value["forceCpu"].alias("force_cpu"), value["column"].alias("column"),
        errors.alias("parse_errors"))


def _once(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _by_field(text: Column) -> Column:
    """The record of a request of any form, from the type of each field."""
    rules = F.array(*[
        F.struct(F.lit("BOOLEAN" if f == "forceCpu" else "STRING").alias("kind"),
                 F.lit((NOT_BOOLEAN if f == "forceCpu" else NOT_TEXT).format(f)).alias("message"))
        for f in FIELDS])
    body = F.from_json(text, ", ".join([f"`{f}` VARIANT" for f in FIELDS] + [f"{_CORRUPT} STRING"]), _OPTIONS)

    def of_fields(fields: Column) -> Column:
        value = {f: fields[i]["value"] for i, f in enumerate(FIELDS)}
        errors = F.transform(fields, lambda f, i: F.when(
            f.isNull() & (i == FIELDS.index("datasetUri")), F.lit(MISSING)).otherwise(f["error"]))
        return _record(value | {"forceCpu": F.coalesce(value["forceCpu"] == "true", F.lit(False))},
                       F.when(fields.isNotNull(), F.array_compact(errors)).otherwise(F.array(F.lit(NOT_AN_OBJECT))))

    def of_body(read: Column) -> Column:
        is_object = F.coalesce(text.rlike(r"^\s*\{") & read[_CORRUPT].isNull(), F.lit(False))
        checked = F.zip_with(rules, F.transform(F.array(*[read[f] for f in FIELDS]), _describe), _check)
        return _once(F.when(is_object, checked), of_fields)

    return _once(body, of_body)


def _describe(raw: Column) -> Column:
    """Type and trimmed text of a field; NULL for a missing or JSON-null one."""
    given = raw.isNotNull() & ~F.is_variant_null(raw)
    text = F.trim(F.try_variant_get(raw, "$", "string"), F.lit(_BLANKS))
    return F.when(given, F.struct(F.schema_of_variant(raw).alias("kind"), text.alias("text"),
                                  raw.alias("raw")))


def _check(rule: Column, field: Column) -> Column:
    good = (field["kind"] == rule["kind"]) & (field["text"] != "")
    error = F.when(~good, F.concat(rule["message"], F.to_json(field["raw"])))
    return F.when(field.isNotNull(), F.struct(F.when(good, field["text"]).alias("value"),
                                              error.alias("error")))
