"""Helpers of several operators: stored tables, exact distributed ranks, bounded filters, components.

Columns the operators add on the way begin with ``__``; such names are reserved, other columns of an
input pass through. A result column replaces an input column of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callpay.llm.textcodes import bloom_has, id_codes
from callpay.session import scratch_path

#: Separators of words, `[\x20\x09-\x0D]`, as text and as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


#: Slices whose counts are added up in one task.
RUN = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the inputs. Python workers started from now on find this package where the driver does."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Cuts the lineage, is computed once, and gives the planner the real size: a small table is
    then broadcast because its files are small, a large one never is.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans run inside hand rows to Python in batches of at most ``rows``; for rows that are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column) -> Column:
    """Words of a text, an empty array for NULL and for text without words."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, BLANK_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def held_by(key: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def seeded(seed: int, *cols: str) -> Column:
    """A pseudo-random order of rows that depends on the seed and the named columns only."""
    return F.xxhash64(F.lit(seed), *cols)


def named(source: str) -> Column:
    """A key without NULL: NULL and the empty string stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    out: str,
    per_bucket: int = 512,
    offsets_of: DataFrame | None = None,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row within ``keys`` (none of them NULL), exactly, for groups of any size.

    ``position`` lies in [0, 1) and rows are ranked by it, then by ``order``. Rows meet in one task
    only per (keys, slice of positions); a slice holds about ``per_bucket`` rows when positions
    are spread evenly, as hashes and fractional ranks are. The ranks of earlier slices come from
    counts, ``RUN`` slices of a key to a task. ``offsets_of`` has the same rows in narrow form, if ``df`` carries long texts. Columns of
    ``carry``, one row per ``keys`` at most, come along without a join of their own.
    """
    narrow = df if offsets_of is None else offsets_of
    slices = max(1, -(-narrow.count() // per_bucket))
    slot = F.least(F.floor(position * slices), F.lit(slices - 1)).cast("bigint")
    counts = narrow.withColumn("__slot", slot).groupBy(*keys, "__slot").agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__run", F.floor(F.col("__slot") / RUN))

    def up_to(n: str, parts: Sequence[str], at: str) -> Column:
        window = Window.partitionBy(*parts) if parts else Window
        return F.sum(n).over(window.orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(n)

    # two levels: sums over runs of slices, one row each, and sums inside a run
    runs = counts.groupBy(*keys, "__run").agg(F.sum("__n").alias("__all"))
    runs = runs.select(*keys, "__run", up_to("__all", keys, "__run").alias("__earlier"))
    offsets = counts.join(runs, [*keys, "__run"]).select(
        *keys, "__slot", (F.col("__earlier") + up_to("__n", [*keys, "__run"], "__slot")).alias("__before")
    )
    offsets = stored(offsets if carry is None else offsets.join(carry, list(keys), "left"), "offsets")
    here = Window.partitionBy(*keys, "__slot").orderBy(*order)
    return (
        df.withColumn("__slot", slot)
        .join(offsets, [*keys, "__slot"])
        .withColumn(out, F.col("__before") + F.row_number().over(here) - 1)
        .drop("__slot", "__before")
    )


def unit(hash_col: Column) -> Column:
    """A 64-bit hash as a position in [0, 1)."""
    return F.pmod(hash_col, F.lit(1 << 40)) / F.lit(float(1 << 40))


def bloom_bits(df: DataFrame, key: str, bits: int = 1 << 24) -> bytes:
    """A Bloom filter of fixed size over a column of evenly mixed 64-bit codes, for ``textcodes.bloom_has``.

    The size is the bound of what is sent to tasks; with too many keys the filter merely lets
    more rows pass, and an exact step follows wherever it is used.
    """
    low, mid = F.col(key).bitwiseAND(bits - 1), F.shiftrightunsigned(F.col(key), 24).bitwiseAND(bits - 1)
    words = (
        df.select(F.explode(F.array(low, mid)).alias("__s"))
        .groupBy(F.shiftright("__s", 6).alias("__w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__s & 63 as int))")).alias("__b"))
        .toPandas()
    )
    filled = np.zeros(bits // 64, np.int64)
    filled[words["__w"].to_numpy(np.int64)] = words["__b"].to_numpy(np.int64)
    return filled.tobytes()


def bloom_of_ids(ids: DataFrame) -> bytes:
    """A Bloom filter of the integer ids in the one column of ``ids``, for ``textcodes.id_codes``."""
    name = ids.columns[0]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([id_codes(batch.column(name))], ["code"])

    return bloom_bits(ids.mapInArrow(code, "code bigint"), "code")


def drop_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids`` (distinct; NULL equals NULL).

    Rows that a filter of fixed size rules out pass straight through; only the others, with their texts, are
    shuffled for the exact join.
    """
    names, name = docs.columns, ids.columns[0]
    filled = bloom_of_ids(ids)

    def side(listed: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                may = bloom_has(filled, np.asarray(id_codes(batch.column(key))).view(np.uint64))
                yield batch.filter(pa.array(may == listed))

        return docs.mapInArrow(pick, docs.schema)

    exact = ids.withColumnRenamed(name, "__drop")
    return side(False).unionByName(side(True).join(exact, F.col(key).eqNullSafe(F.col("__drop")), "left_anti")).select(*names)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected edges (a, b): one row (node, component), the smallest node.

    Alternates large and small stars: every node hands its larger, then its smaller neighbours to the
    smallest node it knows. The rounds grow with the logarithm of the component size, no node
    gathers its neighbours in one task (minima are combined before the shuffle), and each round is
    written to the shared folder. Returns nodes of edges only.
    """
    spark = edges.sparkSession
    star = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name
    )
    seen = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), name)
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            smallest.select("a", F.col("m").alias("b"))
        )
        star = stored(small.distinct(), name)
        state = star.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
