"""Joining per-key results back to the rows they came from, with hot keys kept apart.

A per-key table may have any number of keys, and one key may hold a third of all rows.
``heaviest_keys`` picks the keys with at least 1/limit of all rows. There are never more than
``limit`` of them, whatever the data is, so they may be broadcast; every other key is too
light to make a hot partition in an ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 50_000


def key_alias(key: str) -> str:
    return f"__key_{key}"


def rename_keys(per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Give the key columns their own names, so the join condition is never ambiguous."""
    rest = [f"`{c}`" for c in per_key.columns if c not in keys]
    return per_key.selectExpr(*[f"`{k}` AS `{key_alias(k)}`" for k in keys], *rest)


def same_key_sql(keys: list[str]) -> str:
    """NULL-safe equality of a row's keys with the renamed ones."""
    return " AND ".join(f"`{k}` <=> `{key_alias(k)}`" for k in keys)


def same_key(keys: list[str]) -> Column:
    return F.expr(same_key_sql(keys))


def heaviest_keys(per_key: DataFrame, keys: list[str], weight: str, limit: int = HOT_KEYS) -> DataFrame:
    """At most ``limit`` rows of ``per_key``: all of them if it has no more, else the keys
    whose ``weight`` is 1/limit of the whole or more. A filter, so nothing is sorted or
    gathered, and every evaluation picks the same keys."""
    whole = per_key.agg(F.expr(f"struct(sum(`{weight}`) AS total, count(1) AS keys) AS size")).scalar()
    share = (whole["keys"] <= limit) | (F.col(weight) * limit >= whole["total"])
    return per_key.filter(share)


def without_keys(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``hot`` (a bounded table)."""
    return df.join(F.broadcast(rename_keys(hot.select(*keys), keys)), same_key(keys), "left_anti")


def keep_columns(per_key: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``per_key`` with a filter that is always true and reads every column: whatever a use of it
    needs, all uses read the same columns, so the aggregate behind it is exchanged once. ``weight``
    is a count, so the hash is never worked out."""
    values = ", ".join(f"`{c}`" for c in per_key.columns if c not in (*keys, weight))
    return per_key.filter(f"`{weight}` >= 0 OR xxhash64({values}) = 0") if values else per_key


def attach_by_key(rows: DataFrame, per_key: DataFrame, keys: list[str], weight: str,
                  hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` with the columns of ``per_key`` (one row per key, every key present).

    Rows of heavy keys meet a bounded broadcast table and are never shuffled; the other
    rows are shuffled by key.
    """
    per_key = keep_columns(per_key, keys, weight)
    hot = heaviest_keys(per_key, keys, weight, hot_keys)
    renamed = [key_alias(k) for k in keys]
    by_broadcast = rows.join(F.broadcast(rename_keys(hot, keys)), same_key(keys)).drop(*renamed)
    cold_stats = rename_keys(without_keys(per_key, hot, keys), keys)
    by_shuffle = without_keys(rows, hot, keys).join(cold_stats, same_key(keys)).drop(*renamed)
    return by_broadcast.unionByName(by_shuffle)
