"""Instants as Java prints them: UTC, no fraction or one of 3, 6 or 9 digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INSTANT = r"^(\d{4}-\d\d-\d\d)T(\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?(Z|[+-]\d\d:\d\d)$"
MAX_OFFSET_S = 18 * 3600


def print_instant(at: Column | str) -> Column:
    """A zone-less timestamp, taken as UTC, with as many groups of three digits as it needs."""
    micros = F.date_format(at, "SSSSSS")
    fraction = (F.when(micros == "000000", F.lit(""))
                .when(micros.endswith("000"), F.concat(F.lit("."), F.substring(micros, 1, 3)))
                .otherwise(F.concat(F.lit("."), micros)))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def parse_instant(text: Column | str) -> Column:
    """A zone-less timestamp in UTC from an ISO instant with any fraction of up to nine digits (what
    is below a microsecond is cut off) and ``Z`` or an offset; NULL for any other text."""
    upper = F.upper(F.col(text) if isinstance(text, str) else text)
    date, time, fraction, zone = (F.regexp_extract(upper, INSTANT, i) for i in range(1, 5))
    local = F.concat(date, F.lit(" "), time, F.lit("."), F.rpad(F.substring(fraction, 1, 6), 6, "0")).try_cast("timestamp_ntz")
    size = F.substring(zone, 2, 2).try_cast("int") * 3600 + F.substring(zone, 5, 2).try_cast("int") * 60
    offset = F.when(zone == "Z", F.lit(0)).when(size <= MAX_OFFSET_S, F.when(zone.startswith("-"), -size).otherwise(size))
    return F.when(upper.rlike(INSTANT), local - F.make_dt_interval(secs=offset.cast("decimal(18,6)")))
