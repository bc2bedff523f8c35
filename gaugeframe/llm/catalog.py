"""The registered queries of this package and the SQL texts that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import OP1_SQL, op1_decontaminate
from .language_id import op5_language_id
from .line_dedup import op8_line_dedup
from .merkle import OP12_SQL, op12_merkle
from .mixing import OP10_SQL, op10_mix_sources
from .ngram_join import op4_ngram_join
from .nn_descent import op7_nn_descent
from .periodic import op13_periodic_runs
from .quality import op3_quality
from .secret_scan import op2_secret_scan
from .suffix_lm import op9_suffix_lm
from .token_records import op11_token_records
from .warc import op6_warc

QUERIES = [op1_decontaminate, op2_secret_scan, op3_quality, op4_ngram_join, op5_language_id,
           op6_warc, op7_nn_descent, op8_line_dedup, op9_suffix_lm, op10_mix_sources,
           op11_token_records, op12_merkle, op13_periodic_runs]
ORACLES: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op10_mix_sources": OP10_SQL,
                           "op12_merkle": OP12_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
