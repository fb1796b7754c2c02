"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is its share of all words by weight, at most three times its own words; what is
above that is shared again among the rest. A source is taken whole as often as fits, and the
rest of its budget is filled by documents taken once more: documents are counted by their exact length,
each length gives its proportional share, and a bounded knapsack over the lengths left (dynamic
programming on reachable sums) closes the remaining gap, exactly if any choice does. Which documents
of a length are taken is decided by a seeded order.

Only counts by (source, length) reach the fitting step, one source at a time: at most sqrt(2 * words) rows,
as different lengths add up. The dynamic programme covers a budget of ``DP_WORDS``; a larger gap is
first closed down to it by whole documents.

Cases: NULL text and text without words have size 0 and are never taken; a NULL source is the last source;
repeated rows are documents of their own; an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpay.llm.shared import named, rank_within, seeded, split_words, stored, unit

WEIGHTS = (1, 2, 3)
MAX_TIMES = 3
DP_WORDS = 1 << 16


def size_of(text: str = "text") -> Column:
    return F.size(split_words(F.col(text))).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source of (source, size) rows: source_size, weight, target.

    All sources are raised together, in proportion to their weights, and one that reaches its limit stays
    there: with sources in the order in which they would, the level is found by running sums. One
    small row per source goes through one window.
    """
    per = sizes.groupBy(named("source").alias("__source")).agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = per.withColumn("weight", F.element_at(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
    cap = MAX_TIMES * F.col("source_size")
    everything = Window.partitionBy(F.lit(1))
    by_cap = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = weighed.withColumns(
        {
            "__words": F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(by_cap), F.lit(0)),
            "__weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0)),
        }
    )
    level = left.withColumn("__level", F.col("__words") / F.col("__weights"))
    # a source at its limit raises the level of those after it, a free one does not: the highest is final
    final = level.withColumn("__final", F.max("__level").over(everything))
    raised = F.col("weight") * F.col("__final")
    return final.select(
        "__source", "source", "source_size", "weight", F.least(cap.cast("double"), raised).alias("target")
    )


def fill_budget(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their words come nearest to ``budget`` from below."""
    total = sum(x * n for x, n in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    taken = [n * budget // total for n in counts]
    gap = budget - sum(x * n for x, n in zip(lengths, taken, strict=True))
    for i in sorted(range(len(lengths)), key=lambda i: (-(counts[i] * budget % total), lengths[i])):
        if gap > DP_WORDS:
            more = min(counts[i] - taken[i], 1, gap // max(lengths[i], 1))
            taken[i] += more
            gap -= more * lengths[i]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if gap > DP_WORDS and lengths[i]:
            more = min(counts[i] - taken[i], (gap - DP_WORDS) // lengths[i])
            taken[i] += more
            gap -= more * lengths[i]
    # reachable sums as bits; a bounded count is split into powers of two
    reach, steps, mask = 1, [], (1 << (gap + 1)) - 1
    for i, x in enumerate(lengths):
        spare, part = counts[i] - taken[i], 1
        while spare > 0 and 0 < x <= gap and not reach >> gap & 1:
            part = min(part, spare)
            if part * x > gap:
                break
            steps.append((i, part, reach))
            reach |= (reach << part * x) & mask
            spare, part = spare - part, part * 2
    at = reach.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += part
            at -= part * lengths[i]
    return taken


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    budget = int(rows["__budget"].iloc[0])
    take = fill_budget(rows["size"].tolist(), rows["__n"].tolist(), budget)
    return pd.DataFrame({"__source": rows["__source"], "size": rows["size"], "__take": take})


def mix(docs: DataFrame, seed: int = 23) -> DataFrame:
    """``docs`` plus size, source_size, target and ``times``, how often the mix takes the document (0 to 3)."""
    sized = docs.withColumns({"__source": named("source"), "size": size_of()}).withColumn(
        "__h", seeded(seed, "doc_id", "size")
    )
    narrow = stored(sized.select("__source", "source", "doc_id", "size", "__h"), "mix-sizes")
    targets = stored(source_targets(narrow).drop("source"), "targets")
    words = F.round("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(MAX_TIMES), F.floor(words / F.col("source_size")))).otherwise(0)
    plan = targets.withColumn("__whole", whole.cast("int")).withColumn(
        "__budget", (words - F.col("__whole") * F.col("source_size")).cast("bigint")
    )
    lengths = narrow.groupBy("__source", "size").agg(F.count("*").alias("__n"))
    wanted = plan.where("__whole < 3").select("__source", "__budget")
    takes = stored(
        lengths.join(wanted, "__source")
        .groupBy("__source")
        .applyInPandas(_fit, "__source string, size bigint, __take bigint"),
        "takes",
    )
    ranked = rank_within(
        sized.withColumn("__id", F.col("doc_id")), ["__source", "size"], unit(F.col("__h")), ["__h", "__id"],
        "__r", offsets_of=narrow, carry=takes,
    )
    planned = ranked.join(plan.drop("__budget", "weight"), "__source")
    once = F.when(F.col("__r") < F.coalesce("__take", F.lit(0)), 1).otherwise(0)
    times = F.when(F.col("size") > 0, F.col("__whole") + once).otherwise(0)
    extra = ["size", "source_size", "target", "times"]
    return planned.withColumn("times", times.cast("int")).select(
        *[c for c in docs.columns if c not in extra], *extra
    )


def repeat_taken(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each taken document as often as the mix takes it."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col("times")))
    return mixed.withColumn("__copy", copies).select(*columns)
