"""Delimited extracts: profile, refuse, read, split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from callpay.operators.keys import join_keys
from callpay.sources.contracts import SourceContract

# A line that is a complete record by itself: fields are either quoted, with
# inner quotes doubled, or free of quotes. Quantifiers are possessive, so long
# lines neither backtrack nor deepen the stack.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
COMPLETE_LINE = rf"\A\x{{FEFF}}?{_FIELD}(?:,{_FIELD})*+\z"

_FILE_COLUMNS = ("uri", "path", "file_name", "length")


def source_file() -> Column:
    """Plain name of the file a row was read from (the metadata column is percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def find_files(spark: SparkSession, input_dir: str, expected: Sequence[str]) -> DataFrame:
    """Delivered files: (uri, path, file_name, length), content unread.

    A delivery is one file of the expected name, or a folder of that name with
    any number of part files, also in folders of their own.
    """
    return _delivered(_file_reader(spark.read).load(input_dir), expected)


def stream_files(spark: SparkSession, input_dir: str, expected: Sequence[str], batch_files: int) -> DataFrame:
    """The same as a stream: each path once, at most ``batch_files`` in a batch."""
    reader = _file_reader(spark.readStream).schema(_FILE_SCHEMA).option("maxFilesPerTrigger", batch_files)
    return _delivered(reader.load(input_dir), expected)


# The columns of Spark's source of whole files.
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _file_reader(reader: DataFrameReader | DataStreamReader) -> DataFrameReader | DataStreamReader:
    return reader.format("binaryFile").option("recursiveFileLookup", "true")


def _delivered(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    listed = files.select(F.col("_metadata.file_path").alias("uri"), "path", "length")
    known = F.filter(F.split("path", "/"), lambda step: step.isin(list(expected)))
    name = F.get(known, F.size(known) - 1)
    return listed.withColumn("file_name", name).where("file_name IS NOT NULL").select(*_FILE_COLUMNS)


def header_fields(header: Column) -> Column:
    """Header line to names: byte-order mark, spaces and quotes removed."""
    plain = F.regexp_replace(header, "^\ufeff", "")
    return F.transform(F.split(plain, ","), lambda h: F.btrim(F.btrim(h), F.lit('"')))


def _is_header(line: str, columns: Sequence[str]) -> Column:
    return header_fields(_plain(line)) == F.array(*[F.lit(c) for c in columns]).cast("array<string>")


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri, _source_file, block, seq, value): lines in splits; seq grows within a block, a line keeps its ``\\r``."""
    read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(list(paths))
    return read.select(
        F.col("_metadata.file_path").alias("uri"),
        source_file().alias("_source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )


def _plain(value: str | Column) -> Column:
    return F.regexp_replace(value, "\\r$", "")


def inspect_files(
    spark: SparkSession, paths: Sequence[str], headers: Mapping[str | None, Sequence[str]]
) -> DataFrame:
    """Per file, from one splittable pass over its lines:

    - ``file_hash``: identity of the content, by one rule for files of any size;
    - ``header_ok``: the first line names exactly the columns that ``headers`` has for the
      file's name (or that of the folder it was delivered in; None: any), in order;
    - ``header_lines``: lines near the start that read like the header;
    - ``broken_lines``: lines that are not complete records (a quoted newline somewhere);
    - ``blank_lines``.

    Only numbers are aggregated, so this is a hash aggregate that leaves one row per file and split, whatever the
    size of the file. The hash covers size, number of lines, the sum of their codes and the sum of codes times
    line numbers: other lines, or the same in another order, give another hash. Blocks add up: a line's number is its
    place in the block plus the lines of earlier blocks, so the result does not depend on splits. Spark passes
    over empty files, here as in every read.
    """
    place = F.col("seq").bitwiseAND((1 << 33) - 1).cast("decimal(11,0)")
    code = F.sha2("value", 256)

    def number(start: int) -> Column:
        return F.conv(F.substring(code, start, 15), 16, 10).cast("decimal(19,0)")

    steps = F.split(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))), "/")
    named = F.lit(False)
    for name, columns in headers.items():
        belongs = F.lit(True) if name is None else F.array_contains(steps, name)
        named = named | (belongs & _is_header("value", columns))
    at_start = F.when(F.col("block") == 0, F.col("seq"))
    heading = F.when((F.col("block") == 0) & named, F.col("seq"))
    plain = _plain("value")
    blocks = _lines(spark, paths).groupBy("uri", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(place).alias("first"),
        *[F.sum(number(s)).alias(f"sum{s}") for s in _CODES],
        *[F.sum(number(s) * place).alias(f"placed{s}") for s in _CODES],
        F.max("size").alias("size"),
        (F.min(at_start) == F.min(heading)).alias("header"),
        F.count(heading).alias("header_lines"),
        F.count_if(~plain.rlike(COMPLETE_LINE)).alias("broken"),
        F.count_if(F.trim(plain) == "").alias("blank"),
    )
    so_far = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chained = blocks.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)).cast("decimal(19,0)"))

    def total(s: int) -> Column:
        shift = (F.col("before") - F.col("first")) * F.col(f"sum{s}")
        return F.sum(F.col(f"placed{s}") + shift).cast("string")

    sums = [F.max("size").cast("string"), F.sum("n").cast("string")]
    sums += [x for s in _CODES for x in (F.sum(f"sum{s}").cast("string"), total(s))]
    return chained.groupBy("uri").agg(
        F.sha2(F.concat_ws(":", *sums), 256).alias("file_hash"),
        F.coalesce(F.bool_or("header"), F.lit(False)).alias("header_ok"),
        F.sum("header_lines").alias("header_lines"),
        F.sum("broken").alias("broken_lines"),
        F.sum("blank").alias("blank_lines"),
    )


#: Where the two 60-bit codes of a line begin in its SHA-256.
_CODES = (1, 16)


def file_hashes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri, file_hash) per file; see ``inspect_files``."""
    return inspect_files(spark, paths, {}).select("uri", "file_hash")


def profile_lines(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """What ``inspect_files`` says of files with this header, whatever their names, without the hash."""
    return inspect_files(spark, paths, {None: columns}).drop("file_hash")


def check_headers(profile: Sequence[Row], uris: Sequence[str], contract: SourceContract) -> None:
    """Refuse files whose header is not exactly the contract's, in order; an empty file has none."""
    wrong = sorted(set(uris) - {f.uri for f in profile if f.header_ok})
    if wrong:
        raise ValueError(f"header is not {list(contract.columns)} in {wrong}")


def _field_count(raw_line: Column) -> Column:
    """Fields of a raw record: commas outside quoted parts, plus one."""
    unquoted = F.regexp_replace(raw_line, r'"[^"]*+(?:""[^"]*+)*+"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) + 1


def _options(multiline: bool) -> dict[str, object]:
    return {"multiLine": multiline, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _record_schema(contract: SourceContract) -> T.StructType:
    return T.StructType([*contract.schema.fields, T.StructField("_corrupt", T.StringType())])


def _parsed(records: DataFrame, contract: SourceContract, *kept: str) -> DataFrame:
    """Raw records as text columns plus ``_corrupt``, the raw record of a row with a wrong field count or none."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _options(True).items()}
    cells = F.from_csv("record", _record_schema(contract).simpleString(), options)
    empty = F.trim("record") == ""
    parsed = records.withColumn("_cells", F.when(~empty, cells))
    return parsed.select(
        *[F.col("_cells")[c].alias(c) for c in contract.columns],
        F.when(empty, F.col("record")).otherwise(F.col("_cells._corrupt")).alias("_corrupt"),
        "_source_file", "uri", *kept,
    )


def read_lines(spark: SparkSession, paths: Sequence[str], contract: SourceContract) -> DataFrame:
    """Records of files in which every line is one, read in splits; ``block`` and ``seq`` say where in the file.

    For files with one line that reads like the header, the first (``inspect_files``).
    """
    lines = _lines(spark, paths)
    rows = lines.where(~((F.col("block") == 0) & _is_header("value", contract.columns)))
    return _parsed(rows.withColumn("record", _plain("value")), contract, "block", "seq")


def _tallied(lines: DataFrame) -> DataFrame:
    """Lines (uri, block, _quotes, ...) with ``_nth`` in their split, ``_odd`` quotes before them there, and ``_begun1``, odd lines so far.

    A task reads the lines of a split one after another, so the counts run along with the scan: nothing is shuffled, sorted or
    held but a batch.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, quotes_before, n, begun = None, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            uri, block = batch.column("uri"), batch.column("block").to_numpy()
            quotes = batch.column("_quotes").to_numpy().astype(np.int64)
            nth, odd, begun1 = (np.empty(len(quotes), np.int64) for _ in range(3))
            other = (block[1:] != block[:-1]) | pc.not_equal(uri[1:], uri[:-1]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(other) + 1).tolist(), len(quotes)]
            for a, b in zip(cuts, cuts[1:]):
                here = (uri[a].as_py(), int(block[a]))
                if here != split:
                    split, quotes_before, n, begun = here, 0, 0, 0
                upto = quotes_before + np.cumsum(quotes[a:b])
                odd[a:b] = (upto - quotes[a:b]) % 2
                nth[a:b] = np.arange(n + 1, n + 1 + b - a)
                begun1[a:b] = begun + np.cumsum(odd[a:b])
                quotes_before, n, begun = int(upto[-1]), n + b - a, int(begun1[b - 1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, (nth, odd, begun1))], [*batch.schema.names, "_nth", "_odd", "_begun1"]
            )

    added = [T.StructField(c, T.LongType()) for c in ("_nth", "_odd", "_begun1")]
    counted = lines.mapInArrow(tally, T.StructType([*lines.schema.fields, *added]))
    return counted.withColumn("_begun0", F.col("_nth") - F.col("_begun1"))


def quoted_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri, _source_file, line_number, record, closed): records of files with newlines inside quotes, read in splits.

    Whether a line begins inside quotes hangs on all quotes before it, but only on whether they are odd. Every split
    counts its quotes, and how many records begin in it if it starts outside quotes and if it starts inside;
    a running sum over splits, one row each, then says which holds and how many came before. These rows are broadcast, as many as
    the splits that the driver plans for any read of the files. Lines that are a
    record by themselves go straight through, the others are put together by record number. A record
    whose quote is never closed would swallow the rest of the file: its lines come out one by one, not ``closed``.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = _lines(spark, paths).select("uri", "_source_file", "block", quotes.alias("_quotes"), "value")
    blocks = _tallied(lines.select("uri", "block", "_quotes")).groupBy("uri", "block").agg(
        F.sum("_quotes").alias("_sum"), F.max("_nth").alias("_lines"),
        *[F.max(f"_begun{k}").alias(f"_all{k}") for k in (0, 1)],
    )
    earlier = Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("uri")
    inside = blocks.withColumn("_inside", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)) % 2)
    begins = F.when(F.col("_inside") == 0, F.col("_all0")).otherwise(F.col("_all1"))
    starts = inside.select(
        F.col("uri").alias("_uri"), F.col("block").alias("_block"), "_inside",
        F.coalesce(F.sum(begins).over(earlier), F.lit(0)).alias("_records"),
        F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"),
        F.when(F.sum("_sum").over(whole) % 2 == 1, F.sum(begins).over(whole)).alias("_open"),
    )
    placed = _tallied(lines).join(F.broadcast(starts), (F.col("uri") == F.col("_uri")) & (F.col("block") == F.col("_block")))
    outside = F.col("_odd") == F.col("_inside")
    number = F.col("_records") + F.when(F.col("_inside") == 0, F.col("_begun0")).otherwise(F.col("_begun1"))
    numbered = placed.select(
        "uri", "_source_file", "value",
        (F.col("_before") + F.col("_nth")).alias("line_number"),
        number.alias("_record"),
        (outside & (F.col("_quotes") % 2 == 0)).alias("_alone"),
        (number == F.col("_open")).alias("_dangling"),
    )
    dangling = F.coalesce("_dangling", F.lit(False))
    alone = numbered.where(F.col("_alone") | dangling).select(
        "uri", "_source_file", "line_number", _plain("value").alias("record"), (~dangling).alias("closed")
    )
    parts = numbered.where(~F.col("_alone") & ~dangling).groupBy("uri", "_source_file", "_record").agg(
        F.min("line_number").alias("line_number"),
        F.sort_array(F.collect_list(F.struct("line_number", "value"))).alias("_parts"),
    )
    joined = parts.select(
        "uri", "_source_file", "line_number", _plain(F.array_join("_parts.value", "\n")).alias("record"), F.lit(True).alias("closed")
    )
    return alone.unionByName(joined)


def stray_quotes(records: DataFrame) -> DataFrame:
    """(uri) of files with records whose quotes do not stand around whole fields, so that counting them misleads."""
    return records.where(F.col("closed") & ~F.col("record").rlike(COMPLETE_LINE)).select("uri").distinct()


def read_records(records: DataFrame, contract: SourceContract) -> DataFrame:
    """``quoted_records`` parsed, without the header; a line of a quote that is never closed is corrupt."""
    body = _parsed(records.where("line_number > 1"), contract, "line_number", "closed", "record")
    corrupt = F.when(F.col("closed"), F.col("_corrupt")).otherwise(F.col("record"))
    return body.withColumn("_corrupt", corrupt).drop("record", "closed")


def read_extract(spark: SparkSession, paths: Sequence[str], contract: SourceContract, multiline: bool) -> DataFrame:
    """Every record as text columns plus ``_corrupt``, by Spark's CSV reader.

    Headers are verified beforehand (``check_headers``). With ``multiline`` a
    quoted field may contain newlines and each file is read by one task: for files with stray quotes, whose
    records only a reader from the start can tell. Without, files are read in splits.
    """
    return (
        spark.read.schema(_record_schema(contract))
        .options(header=True, enforceSchema=True, columnPruning=False, **_options(multiline))
        .csv(list(paths))
        .select("*", source_file().alias("_source_file"), F.col("_metadata.file_path").alias("uri"))
    )


def _reason(expected: int, got: Column) -> Column:
    return F.concat(F.lit(f"expected {expected} fields, got "), got.cast("string"))


def classify(records: DataFrame, contract: SourceContract) -> DataFrame:
    """Mark each record ``valid`` or ``rejected``, in the one pass that parses it.

    Valid cells keep ``''`` for empty. A rejected row keeps its raw text and the
    reason instead of cells.
    """
    valid = F.col("_corrupt").isNull()
    cells = [F.when(valid, F.coalesce(c, F.lit(""))).alias(c) for c in contract.columns]
    marked = contract.transform(
        records.select(
            *cells,
            "_source_file",
            "uri",
            F.col("_corrupt").alias("raw_line"),
            F.when(~valid, _reason(len(contract.columns), F.when(F.col("_corrupt") == "", 0).otherwise(_field_count(F.col("_corrupt"))))).alias("reason"),
            *[(F.col(c) if c in records.columns else F.lit(None)).cast("bigint").alias(c) for c in PLACE],
            F.when(valid, "valid").otherwise("rejected").alias("kind"),
        )
    )
    added = [c for c in contract.key_columns if c not in contract.columns]
    return marked.withColumns({c: F.when(F.col("kind") == "valid", F.col(c)) for c in added}) if added else marked


#: Where a row stands in its file, as far as it is known.
PLACE = ("line_number", "block", "seq")


def split_rejects(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects) of classified rows that are stored or cached.

    Straight from a file Spark refuses the second: it would read the corrupt
    column alone.
    """
    valid = classified.where("kind = 'valid'").drop("raw_line", "reason", "kind", "uri", "load_id", *PLACE)
    return valid, _line_numbers(classified)


def _line_numbers(classified: DataFrame) -> DataFrame:
    """Rejected rows with the number of their (first) line in the file, the header being 1.

    Where a line is a record, that is its place in the block, plus all rows of earlier blocks, plus the header. NULL in
    files that Spark's CSV reader read.
    """
    rejects = classified.where("kind = 'rejected'")
    if not {"uri", *PLACE} <= set(classified.columns):
        return rejects.select("raw_line", "reason", "_source_file")
    located = classified.where("block IS NOT NULL")
    rejected_blocks = rejects.select("load_id", "uri").distinct()
    keys = ["load_id", "uri"]
    blocks = join_keys(located, rejected_blocks, keys, "left_semi").groupBy(*keys, "block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("seq").alias("_first")
    )
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*keys, "block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = join_keys(rejects, offsets, [*keys, "block"], "left")
    return numbered.select(
        "raw_line", "reason", "_source_file",
        F.coalesce("line_number", F.col("seq") + F.col("_shift") + 2).alias("line_number"),
    )


def blank_line_rejects(spark: SparkSession, paths: Sequence[str], contract: SourceContract, multiline: bool) -> DataFrame:
    """Lines with nothing or only spaces on them, which the CSV reader passes over.

    For files read by ``read_extract``. With ``multiline`` a line is empty only outside quotes, where the quotes before
    it are even in number; lines of spaces are records there.
    """
    lines = spark.read.text(list(paths)).select(
        source_file().alias("_source_file"),
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        F.col("value").alias("raw_line"),
    )
    if multiline:
        before = Window.partitionBy("uri").orderBy("_block", "_seq").rowsBetween(Window.unboundedPreceding, -1)
        quotes = F.length("raw_line") - F.length(F.replace("raw_line", F.lit('"')))
        open_quotes = F.coalesce(F.sum(quotes).over(before), F.lit(0)) % 2
        blank = lines.withColumn("_open", open_quotes).where((F.col("raw_line") == "") & (F.col("_open") == 0)).drop("_open")
    else:
        blank = lines.where(F.trim("raw_line") == "")
    got = F.when(F.col("raw_line") == "", 0).otherwise(1)
    return blank.drop("_block", "_seq").withColumns(
        {"reason": _reason(len(contract.columns), got), "kind": F.lit("rejected")}
    )
