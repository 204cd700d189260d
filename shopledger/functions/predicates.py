"""Filters written as data: ``{column: condition}``, all of which must hold."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _comparable(df: DataFrame, name: str) -> Column:
    """Text columns compare as text, everything else as numbers where it can."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)):
        return column
    return column.try_cast("double")


def _text_or_number(column: Column, value: Any, is_text: bool) -> Column:
    """Compare text with a number by reading the text as a number."""
    return column.try_cast("double") if is_text and isinstance(value, (int, float)) else column


def condition(df: DataFrame, name: str, rule: Any) -> Column:
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    column = _comparable(df, name)
    if not isinstance(rule, dict):
        return _text_or_number(column, rule, is_text) == F.lit(rule)
    op, value = rule.get("op"), rule.get("value")
    if op == "notna":
        return F.col(name).isNotNull()
    if op == "isna":
        return F.col(name).isNull()
    if op == "in":
        return F.col(name).isin(list(rule.get("values", [])))
    column = _text_or_number(column, value, is_text)
    comparisons = {
        "eq": lambda c: c == F.lit(value),
        # A missing value is different from every value.
        "ne": lambda c: ~c.eqNullSafe(F.lit(value)),
        "gt": lambda c: c > F.lit(value),
        "gte": lambda c: c >= F.lit(value),
        "lt": lambda c: c < F.lit(value),
        "lte": lambda c: c <= F.lit(value),
    }
    if op not in comparisons:
        raise ValueError(f"unsupported filter operator: {op}")
    return comparisons[op](column)


def build_predicate(df: DataFrame, filters: dict[str, Any] | None) -> Column:
    return reduce(and_, [condition(df, name, rule) for name, rule in (filters or {}).items()], F.lit(True))


def require_columns(df: DataFrame, columns: list[str], context: str = "") -> DataFrame:
    """The frame itself, or ``ValueError`` naming what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        prefix = f"{context}: " if context else ""
        raise ValueError(f"{prefix}missing required columns {missing}; found {df.columns}")
    return df


def invalid_rows(df: DataFrame, column: str, sample: int = 10) -> DataFrame:
    """A small sample of rows whose ``column`` could not be read."""
    return df.filter(F.col(column).isNull()).limit(sample)


def require_valid(df: DataFrame, column: str, show: list[str]) -> DataFrame:
    """The frame itself, or ``ValueError`` with a sample of unreadable rows. Runs one small job."""
    bad = invalid_rows(df, column).select(*show).take(10)
    if bad:
        raise ValueError(f"rows with an invalid {column!r}, for example {[r.asDict() for r in bad]}")
    return df
