"""Row keys, duplicate flags and deterministic dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpay.operators.filters import require


def row_key(cols: Sequence[str], sep: str = "-") -> Column:
    """Readable composite key. An empty slot is kept, so two keys never shift into each other."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in cols])


def hash_key(cols: Sequence[str], sep: str = "|") -> Column:
    """SHA-256 over the named columns, NULL read as empty text."""
    return F.sha2(row_key(cols, sep), 256)


def join_keys(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: bool = False,
    extra: Column | None = None,
) -> DataFrame:
    """Join on equally named keys; the right side's copies are named ``_b_<key>``.

    Renaming keeps the condition unambiguous when both sides share ancestors.
    """
    right = b.withColumnsRenamed({k: f"_b_{k}" for k in keys})
    on = extra
    for k in keys:
        x, y = F.col(k), F.col(f"_b_{k}")
        term = x.eqNullSafe(y) if null_safe else x == y
        on = term if on is None else on & term
    return a.join(right, on, how)


def join_per_key(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a side that has at most one row per key; a NULL key matches nothing.

    The rows may hold any number of copies of a key. Adaptive execution splits
    such a key only if the other side was shuffled for this very join; a side
    that was just aggregated by the same key is not. Null-safe equality over
    non-NULL keys means the same and shuffles both sides by an expression of the
    key, so the split always applies. It costs one more shuffle of the small side.
    """
    present = require(per_key, *keys)
    kept = [c for c in per_key.columns if c not in keys] if how == "left" else []
    return join_keys(df, present, keys, how, null_safe=True).select(*df.columns, *kept)


def flag_duplicates(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Mark every row whose key occurs more than once (NULLs equal each other).

    Not a window over the key: a key that holds a third of the rows would have
    to pass through one task. Keys are counted map-side first, only the repeated
    ones are joined back, and adaptive execution can split their rows.
    """
    repeated = df.groupBy(*keys).count().where("count > 1").select(*keys, F.lit(True).alias("_repeated"))
    return join_keys(df, repeated, keys, "left", null_safe=True).select(
        *df.columns, F.coalesce("_repeated", F.lit(False)).alias(out)
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Filtering ``row_number`` to 1 lets Spark cut every key to one row per map
    task before the shuffle (WindowGroupLimit), so copies of one hot row do
    not meet in one place.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
