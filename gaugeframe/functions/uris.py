"""Derived output locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def default_output(uri: Column | str, job_id: Column | str) -> Column:
    """Folder of the input + ``processed/<job_id>/``."""
    folder = F.regexp_replace(_col(uri), F.lit("[^/]*$"), F.lit(""))
    return F.concat(folder, F.lit("processed/"), _col(job_id).cast("string"), F.lit("/"))


def pipeline_output(output: Column | str, pipeline: Column | str) -> Column:
    """Per-pipeline suffix under an output folder; empty when there is no output."""
    return F.coalesce(F.concat(_col(output), _col(pipeline)), F.lit(""))
