"""Find real ids inside free text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.functions.columns import digit_runs
from callpay.operators.keys import join_per_key


def explode_digit_runs(df: DataFrame, text: str, out: str, keep: list[str]) -> DataFrame:
    """One row per distinct digit run of ``text`` that fits a BIGINT."""
    return df.select(*keep, F.explode(digit_runs(text)).alias(out)).where(F.col(out).isNotNull())


def match_ids_in_text(df: DataFrame, key: str, text: str, ids: DataFrame, id_col: str, out: str) -> DataFrame:
    """Smallest real id named in ``text``, one row per ``key`` that names any.

    Only (key, candidate) travels to the semi join; its rows are split when one
    number fills many notes. The minimum is combined map-side before the second
    shuffle.
    """
    candidates = explode_digit_runs(df, text, "_candidate", [key])
    known = ids.select(F.col(id_col).alias("_candidate")).distinct()
    hits = join_per_key(candidates, known, ["_candidate"], "left_semi")
    return hits.groupBy(key).agg(F.min("_candidate").alias(out))


def attach_match(df: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """Left join of a per-key result onto every row of that key."""
    return join_per_key(df, matched, [key])
