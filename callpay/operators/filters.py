"""Row filters the models share. All are plain predicates that Catalyst can push down."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.functions.columns import clean_string


def drop_blank_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is more than spaces."""
    return df.where(clean_string(key).isNotNull())


def nonzero(df: DataFrame, flag: str = "is_zero_amount") -> DataFrame:
    """Rows known not to be zero; an unreadable amount has a NULL flag and goes too."""
    return df.where(~F.col(flag))


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which every named column is filled (as ``IS NOT NULL``, which reaches the scan)."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def only(df: DataFrame, c: str, value) -> DataFrame:
    return df.where(F.col(c) == value)


def only_true(df: DataFrame, flag: str) -> DataFrame:
    return df.where(F.col(flag))
