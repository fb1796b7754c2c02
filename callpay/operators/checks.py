"""Data-quality checks. Every result row is (check, target, severity, failures, passed).

Checks that look at rows are aggregate columns, and ``measure`` evaluates all
of one table's in a single pass. Checks that look at keys aggregate by key
first, combined map-side, so a hot key costs one row per task; ``measure_keys`` groups
by all keys of one table at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.functions.columns import clock
from callpay.operators.fx import uncovered_dates

ERROR = "ERROR"
WARN = "WARN"


@dataclass(frozen=True)
class Rule:
    """A check whose failures one aggregate over the table can count."""

    check: str
    target: str
    failures: Column
    severity: str = ERROR


def _rows_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def not_null_rule(c: str) -> Rule:
    return Rule("not_null", c, _rows_where(F.col(c).isNull()))


def key_present_rule(c: str) -> Rule:
    return Rule("key_present", c, _rows_where(F.col(c).isNull() | (F.col(c) == "")))


def accepted_values_rule(c: str, values: Sequence) -> Rule:
    return Rule("accepted_values", c, _rows_where(~F.col(c).isin(list(values))))


def accepted_range_rule(c: str, low=None, high=None, inclusive: bool = True) -> Rule:
    col = F.col(c)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (col >= low if inclusive else col > low)
    if high is not None:
        inside = inside & (col <= high if inclusive else col < high)
    return Rule("accepted_range", c, _rows_where(~inside))


def expect_rule(condition: str) -> Rule:
    """Every row must satisfy a SQL condition; NULL counts as satisfied."""
    return Rule("expect", condition, _rows_where(~F.expr(condition)))


def has_rows_rule() -> Rule:
    return Rule("has_rows", "*", F.when(F.count(F.lit(1)) > 0, 0).otherwise(1))


def _result(check: Column, target: Column, severity: Column, failures: Column) -> list[Column]:
    failures = failures.cast("bigint")
    return [
        check.alias("check"),
        target.alias("target"),
        severity.alias("severity"),
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    ]


def measure(df: DataFrame, rules: Sequence[Rule], prefix: str = "") -> DataFrame:
    """All row rules of one table in one scan."""
    counts = df.agg(*[r.failures.cast("bigint").alias(f"_f{i}") for i, r in enumerate(rules)])
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r.check).alias("check"),
                    F.lit(prefix + r.target).alias("target"),
                    F.lit(r.severity).alias("severity"),
                    F.col(f"_f{i}").alias("failures"),
                )
                for i, r in enumerate(rules)
            ]
        )
    )
    return counts.select(rows.alias("r")).select(
        *_result(F.col("r.check"), F.col("r.target"), F.col("r.severity"), F.col("r.failures"))
    )


def not_null(df: DataFrame, c: str) -> DataFrame:
    return measure(df, [not_null_rule(c)])


def key_present(df: DataFrame, c: str) -> DataFrame:
    return measure(df, [key_present_rule(c)])


def accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return measure(df, [accepted_values_rule(c, values)])


def accepted_range(df: DataFrame, c: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    return measure(df, [accepted_range_rule(c, low, high, inclusive)])


def expect(df: DataFrame, condition: str) -> DataFrame:
    return measure(df, [expect_rule(condition)])


def has_rows(df: DataFrame) -> DataFrame:
    return measure(df, [has_rows_rule()])


def _counted(failing: DataFrame, check: str, target: str, severity: str = ERROR, weight: str | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return failing.agg(n.alias("n")).select(*_result(F.lit(check), F.lit(target), F.lit(severity), F.col("n")))


@dataclass(frozen=True)
class KeyRule:
    """A check whose failures are keys: groups of equal ``keys`` for which ``fails`` holds."""

    check: str
    target: str
    keys: tuple[str, ...]
    fails: Column
    severity: str = ERROR


def unique_rule(c: str) -> KeyRule:
    """Values that occur more than once; NULLs never fail."""
    return KeyRule("unique", c, (c,), (F.count(F.lit(1)) > 1) & F.max(F.col(c).isNotNull()))


def unique_combination_rule(cols: Sequence[str]) -> KeyRule:
    """Combinations that occur more than once; NULLs equal each other."""
    return KeyRule("unique_combination", ",".join(cols), tuple(cols), F.count(F.lit(1)) > 1)


def one_to_one_rule(key: str, value: str, where: str | None = None) -> KeyRule:
    """Keys with more than one distinct ``value``, NULLs aside, among the rows of ``where``."""
    held = F.col(value) if where is None else F.when(F.expr(where), F.col(value))
    return KeyRule("one_to_one", f"{key}->{value}", (key,), F.min(held) < F.max(held))


def measure_keys(df: DataFrame, rules: Sequence[KeyRule], prefix: str = "") -> DataFrame:
    """All key rules of one table in one scan and one shuffle.

    Rows are grouped by the keys of every rule at once (grouping sets), combined map-side; rules on the same keys share
    their groups. What is left is one number per rule.
    """
    columns = list(dict.fromkeys(c for r in rules for c in r.keys))
    sets = list(dict.fromkeys(tuple(c for c in columns if c in r.keys) for r in rules))
    # grouping columns are copies, NULL where a set leaves them out; rules see the rows' own
    copies = {c: f"_key{i}" for i, c in enumerate(columns)}
    keyed = df.withColumns({k: F.col(c) for c, k in copies.items()})
    groups = keyed.groupingSets([[copies[c] for c in s] for s in sets], *copies.values()).agg(
        F.grouping_id().alias("_set"), *[F.coalesce(r.fails, F.lit(False)).alias(f"_fails{i}") for i, r in enumerate(rules)]
    )

    def set_of(rule: KeyRule) -> int:
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in rule.keys)

    counted = [
        Rule(r.check, r.target, F.count_if((F.col("_set") == set_of(r)) & F.col(f"_fails{i}")), r.severity)
        for i, r in enumerate(rules)
    ]
    return measure(groups, counted, prefix)


def unique(df: DataFrame, c: str, prefix: str = "") -> DataFrame:
    return measure_keys(df, [unique_rule(c)], prefix)


def unique_combination(df: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    return measure_keys(df, [unique_combination_rule(cols)], prefix)


def relationships(
    df: DataFrame, c: str, to: DataFrame, field: str, where: str | None = None, prefix: str = ""
) -> DataFrame:
    """Counts rows whose non-NULL ``c`` is absent from ``to.field``.

    Both sides shrink to one row per value before the anti join, so a popular value is one row.
    """
    rows = df.where(where) if where else df
    values = rows.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    parents = to.select(F.col(field).alias("_parent")).distinct()
    orphans = values.join(parents, F.col("_value") == F.col("_parent"), "left_anti")
    return _counted(orphans, "relationships", prefix + c, weight="_rows")


def several_values(df: DataFrame, key: str, value: str, out: str = "value_count") -> DataFrame:
    """Keys that map to more than one distinct ``value``, with how many."""
    pairs = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.lit(1).alias("_one"))
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def one_to_one(df: DataFrame, key: str, value: str, prefix: str = "") -> DataFrame:
    return measure_keys(df, [one_to_one_rule(key, value)], prefix)


def covers_dates(payments: DataFrame, fx: DataFrame, dates_only: bool = False, prefix: str = "") -> DataFrame:
    """Warns about payment days without a stored rate."""
    return _counted(uncovered_dates(payments, fx, dates_only), "covers_dates", prefix + "rate_date", WARN)


def last_deadline(now: Column, deadline_hour: int) -> Column:
    """The most recent daily deadline at or before ``now``."""
    today = F.to_date(now).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(deadline_hour))
    return F.when(now >= today, today).otherwise(today - F.make_dt_interval(days=F.lit(1)))


def freshness(
    loads: DataFrame,
    name: str = "source_name",
    loaded_at: str = "loaded_at",
    *,
    now: datetime | None = None,
    deadline_hour: int = 6,
    allowance: timedelta = timedelta(hours=2),
    targets: Sequence[str] = (),
) -> DataFrame:
    """One row per source: was it loaded no earlier than the allowance before the last deadline?

    Every one of ``targets`` gets a row; one that never loaded fails.
    """
    due = last_deadline(clock(now), deadline_hour) - F.make_dt_interval(
        secs=F.lit(allowance.total_seconds()).cast("decimal(18,6)")
    )
    late = F.when(F.coalesce(F.col("_last") >= due, F.lit(False)), 0).otherwise(1)
    seen = loads.select(F.col(name).alias("_name"), F.col(loaded_at).alias("_at"))
    if targets:
        listed = F.explode(F.array(*[F.lit(t) for t in targets])).alias("_name")
        expected = loads.sparkSession.range(1).select(listed, F.lit(None).cast("timestamp_ntz").alias("_at"))
        seen = seen.unionByName(expected)
    return (
        seen.groupBy("_name")
        .agg(F.max("_at").alias("_last"))
        .select(*_result(F.lit("freshness"), F.col("_name"), F.lit(ERROR), late))
    )


def run_suite(results: Sequence[DataFrame]) -> DataFrame:
    """All check results as one table."""
    return reduce(DataFrame.unionByName, results)
