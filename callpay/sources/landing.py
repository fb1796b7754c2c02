"""Landing: plan by content hash, land once, record what was landed."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpay.functions.columns import clock
from callpay.operators.keys import join_per_key
from callpay.session import scratch_path
from callpay.sources.contracts import MANIFEST_SCHEMA, SOURCES, SourceContract
from callpay.sources.extracts import (
    PLACE,
    blank_line_rejects,
    check_headers,
    classify,
    find_files,
    inspect_files,
    quoted_records,
    read_extract,
    read_lines,
    read_records,
    split_rejects,
    stray_quotes,
)
from callpay.sources.tables import read_or_empty

# Why a source was skipped.
NOT_FOUND = "file_not_found"
UNCHANGED = "unchanged_since_last_run"
#: Why a file is left out that names other columns.
WRONG_HEADER = "wrong_header"

INSPECTED = "uri string, file_hash string, header_ok boolean, header_lines long, broken_lines long, blank_lines long"

_LANDING_KEYS = ["kind", "load_id"]
#: More than the folders that one load writes to (two kinds of rows), or Spark goes back to sorting.
OPEN_FILES = 8


def manifest_path(root: str) -> str:
    return f"{root}/load_manifest"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, manifest_path(root), MANIFEST_SCHEMA)


def new_files(hashes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content was not landed before for that source.

    The manifest shrinks to one row per content, and many deliveries of one
    content may be split.
    """
    keys = ["source_name", "file_hash"]
    return join_per_key(hashes, manifest.select(*keys).distinct(), keys, "left_anti")


def plan_loads(registry: DataFrame, found: DataFrame, manifest: DataFrame) -> DataFrame:
    """What to do with each registered file.

    ``registry`` (source_name, file_name), ``found`` (file_name, file_hash, ...),
    ``manifest`` as recorded. ``reason`` says why a file is skipped and is NULL
    for one to load.
    """
    done = manifest.select("source_name", "file_hash").distinct().withColumn("_done", F.lit(True))
    joined = join_per_key(registry.join(found, "file_name", "left"), done, ["source_name", "file_hash"])
    reason = F.when(F.col("file_hash").isNull(), NOT_FOUND).when(F.col("_done"), UNCHANGED)
    carried = [c for c in found.columns if c not in ("file_name", "file_hash")]
    return joined.select("source_name", "file_name", "file_hash", *carried, reason.alias("reason"))


def registry_frame(spark: SparkSession, contracts: Iterable[SourceContract]) -> DataFrame:
    return spark.createDataFrame([(c.name, c.file_name) for c in contracts], "source_name string, file_name string")


def land_schema(contract: SourceContract) -> T.StructType:
    text = [*contract.columns, *[k for k in contract.key_columns if k not in contract.columns]]
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in [*text, "_source_file"]]
        + [T.StructField("_ingested_at", T.TimestampNTZType())]
        + [T.StructField(c, T.StringType()) for c in ("raw_line", "reason", "uri")]
        + [T.StructField(c, T.LongType()) for c in PLACE]
        + [T.StructField(c, T.StringType()) for c in ("file_hash", "kind", "load_id")]
    )


@contextmanager
def _unsorted_write(spark: SparkSession) -> Iterator[None]:
    """A task holds a file of each kind open and writes rows as they come, instead of sorting all its rows by folder first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def land(
    spark: SparkSession, contract: SourceContract, files: list, root: str, loaded_at: datetime, load_id: str
) -> DataFrame:
    """Parse the given files once and append their valid and rejected rows under kind / load_id.

    Readers see only loads that the manifest names, so what a crashed run left behind is never
    read, whenever it is repeated. Returns the rows of this load.
    """
    if not all(hasattr(f, "header_ok") for f in files):
        found = inspect_files(spark, [f.path for f in files], {None: contract.columns}).drop("file_hash").collect()
        known = {r.uri: r.asDict() for r in found}
        files = [Row(path=f.path, file_hash=f.file_hash, **{**_UNREAD, **known.get(f.uri, {}), "uri": f.uri}) for f in files]
    check_headers(files, [f.uri for f in files], contract)
    parts = _records(spark, contract, files)
    hashes = spark.createDataFrame([(f.uri, f.file_hash) for f in files], "uri string, file_hash string")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    schema = land_schema(contract)
    target = f"{root}/{contract.name}"
    # the list of files is broadcast: a join by file would put all rows of a file in one task
    stamped = rows.join(F.broadcast(hashes), "uri").withColumns({"_ingested_at": clock(loaded_at), "load_id": F.lit(load_id)})
    with _unsorted_write(spark):
        stamped.select(*schema.names).write.mode("append").partitionBy(*_LANDING_KEYS).parquet(target)
    return spark.read.schema(schema).parquet(target).where(F.col("load_id") == load_id)


_UNREAD = {"header_ok": False, "header_lines": 0, "broken_lines": 0, "blank_lines": 0}


def _records(spark: SparkSession, contract: SourceContract, files: list) -> list[DataFrame]:
    """Classified records of files, read in splits but for those with stray quotes."""
    quoted = [f for f in files if f.broken_lines]
    stray, parts = set(), []
    if quoted:
        path = scratch_path(spark, "quoted_records")
        quoted_records(spark, [f.path for f in quoted]).write.parquet(path)
        records = spark.read.parquet(path)
        stray = {r.uri for r in stray_quotes(records).collect()}
        sound = records.where(~F.col("uri").isin(list(stray))) if stray else records
        parts.append(classify(read_records(sound, contract), contract))
    lines = [f.path for f in files if not f.broken_lines and f.header_lines == 1]
    if lines:
        parts.append(classify(read_lines(spark, lines, contract), contract))
    # Spark's CSV reader passes over blank lines
    twice = [f for f in files if not f.broken_lines and f.header_lines != 1]
    for group, whole in ((twice, False), ([f for f in quoted if f.uri in stray], True)):
        if group:
            parts.append(classify(read_extract(spark, [f.path for f in group], contract, whole), contract))
        blank = [f.path for f in group if f.blank_lines]
        if blank:
            parts.append(blank_line_rejects(spark, blank, contract, whole))
    return parts


def read_landed(spark: SparkSession, root: str, contract: SourceContract) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of all committed loads of a source; empty before the first load.

    Rejected rows have the number of their line in the file.
    """
    landed = read_or_empty(spark, f"{root}/{contract.name}", land_schema(contract))
    committed = read_manifest(spark, root).where(F.col("source_name") == contract.name).select("load_id").distinct()
    return split_rejects(landed.join(committed, "load_id", "left_semi").drop("file_hash"))


def read_raw(spark: SparkSession, root: str, contract: SourceContract) -> DataFrame:
    return read_landed(spark, root, contract)[0]


def record_loads(manifest: str, loads: DataFrame) -> None:
    """Append load records, one per landed file."""
    loads.select(*MANIFEST_SCHEMA.names).write.mode("append").parquet(manifest)


def load_summary(plan: DataFrame, loads: DataFrame) -> DataFrame:
    """Per source: was it skipped, why, and how many rows were loaded and rejected."""
    counts = loads.groupBy("source_name").agg(
        F.sum("row_count").alias("rows_loaded"), F.sum("rejected_count").alias("rejected")
    )
    per_source = plan.groupBy("source_name").agg(
        (F.count_if(F.col("reason").isNull()) == 0).alias("skipped"), F.max("reason").alias("reason")
    )
    return per_source.join(counts, "source_name", "left").select(
        "source_name",
        "skipped",
        F.when(F.col("skipped"), F.col("reason")).alias("reason"),
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"),
    )


def load_extracts(
    spark: SparkSession,
    input_dir: str,
    root: str,
    only: Iterable[str] | None = None,
    loaded_at: datetime | None = None,
    skip_wrong_headers: bool = False,
) -> DataFrame:
    """Land every new file of the chosen sources and return the load summary.

    A file with another header than its contract's stops the load, or with ``skip_wrong_headers`` is left out and
    reported. The driver handles file names and what ``inspect_files`` says of them, never rows.
    """
    contracts = [SOURCES[n] for n in only] if only is not None else list(SOURCES.values())
    files = find_files(spark, input_dir, [c.file_name for c in contracts])
    return load_files(files, contracts, root, loaded_at, skip_wrong_headers)


def load_files(
    files: DataFrame,
    contracts: Sequence[SourceContract],
    root: str,
    loaded_at: datetime | None = None,
    skip_wrong_headers: bool = False,
) -> DataFrame:
    """Land those of the given ``files`` (as ``find_files`` lists them) that are new, and return the load summary."""
    spark = files.sparkSession
    loaded_at = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    load_id = uuid.uuid4().hex
    paths = [r.path for r in files.select("path").collect()]
    headers = {c.file_name: c.columns for c in contracts}
    about = inspect_files(spark, paths, headers) if paths else spark.createDataFrame([], INSPECTED)
    manifest = read_manifest(spark, root)
    planned = plan_loads(registry_frame(spark, contracts), files.join(about, "uri"), manifest)
    if skip_wrong_headers:
        refused = F.col("reason").isNull() & ~F.col("header_ok")
        planned = planned.withColumn("reason", F.when(refused, WRONG_HEADER).otherwise(F.col("reason")))
    plan_rows = planned.collect()
    plan = spark.createDataFrame(plan_rows, planned.schema)
    for contract in contracts:
        todo = [r for r in plan_rows if r.source_name == contract.name and r.reason is None]
        if not todo:
            continue
        landed = land(spark, contract, todo, root, loaded_at, load_id)
        counted = landed.groupBy("file_hash").agg(
            F.count_if(F.col("kind") == "valid").alias("row_count"),
            F.count_if(F.col("kind") == "rejected").alias("rejected_count"),
        )
        records = (
            plan.where((F.col("source_name") == contract.name) & F.col("reason").isNull())
            .dropDuplicates(["file_hash"])
            .join(counted, "file_hash", "left")
            .withColumns(
                {
                    "loaded_at": clock(loaded_at),
                    "landed_path": F.lit(f"{root}/{contract.name}"),
                    "load_id": F.lit(load_id),
                    "row_count": F.coalesce("row_count", F.lit(0)),
                    "rejected_count": F.coalesce("rejected_count", F.lit(0)),
                }
            )
        )
        record_loads(manifest_path(root), records)
    this_run = read_manifest(spark, root).where(F.col("load_id") == load_id)
    return load_summary(plan, this_run)
