"""Sharding by proportional stratified interleaving, DataFrame functions only.

The rows of each source are shuffled by a seed and ranked; a row's fractional rank (rank + 1/2) / (rows
of its source) says how far through its source it comes. All rows sorted by that number interleave
the sources in proportion, so that any run of neighbours, and hence any shard, has the mixture of
the whole. The sorted rows are cut into shards whose counts differ by one at most.

Both rankings are exact and spread over tasks whatever share one source has (``rank_within``).

Cases: NULL sources form a source of their own; a NULL text counts as empty; repeated rows get places of
their own; ties of the seeded order go by id, then by the text's checksum; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import named, rank_within, seeded, stored, unit

OVERHEAD = 16


def text_crc32(text: str = "text"):
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def shard(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """``docs`` plus ``shard`` (0 .. shards - 1) and ``slot`` (0, 1, ... within the shard)."""
    keyed = docs.withColumns(
        {"__source": named("source"), "__crc": text_crc32(), "__id": F.col("doc_id")}
    ).withColumn("__h", seeded(seed, "__id", "__crc"))
    tail = ["__h", "__id", "__crc"]
    # the narrow rows are ranked first; texts then only pick up what was counted
    narrow = stored(keyed.select("__source", *tail), "shard-keys")
    sizes = narrow.groupBy("__source").agg(F.count("*").alias("__of"))

    def in_source(rows: DataFrame) -> DataFrame:
        ranked = rank_within(rows, ["__source"], unit(F.col("__h")), ["__h", "__id", "__crc"], "__r", offsets_of=narrow)
        return ranked.join(stored(sizes, "source-sizes"), "__source").withColumn(
            "__f", (2 * F.col("__r") + 1) / (2.0 * F.col("__of"))
        )

    order = ["__f", "__source", "__r"]
    first = stored(in_source(narrow).select(*order), "fractions")
    ranked = rank_within(in_source(keyed), [], F.col("__f"), order, "__at", offsets_of=first)
    total = first.count()
    low, longer = total // shards, total % shards
    edge = longer * (low + 1)
    at = F.col("__at")
    number = F.when(at < edge, F.floor(at / (low + 1))).otherwise(longer + F.floor((at - edge) / max(low, 1)))
    start = F.when(F.col("shard") < longer, F.col("shard") * (low + 1)).otherwise(
        edge + (F.col("shard") - longer) * low
    )
    placed = ranked.withColumn("shard", number.cast("int")).withColumn("slot", (at - start).cast("bigint"))
    return placed.select(*[c for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")
