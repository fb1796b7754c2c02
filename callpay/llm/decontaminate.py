"""Benchmark decontamination by winnowing.

Of the hashes of all k-word runs of a text, the smallest of every ``WINDOW`` consecutive ones is kept as a
fingerprint, so that two texts which share k + WINDOW - 1 = 10 words in a row share a fingerprint of that
span. Training and benchmark fingerprints are joined on the hash, and each joint hit is extended
word by word to both sides; a shared run of ten words or more is a hit. An item of fewer words is
one window of its own length, searched by the hashes of all runs of that length.

The texts are read once, in tasks that keep fingerprints only if a filter of fixed size over the
benchmark's fingerprints lets them pass; the join on the hash decides. Texts with the same words
are worked off once.

Cases: NULL text has no words and no hits; an item without words has no windows; repeated items keep their
ids; repeated documents each get a row; very long texts are worked off in blocks; an empty benchmark gives no
hits, an empty table no rows. Other columns do not pass through the search; ``drop_contaminated`` keeps all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from callpay.llm.shared import bloom_bits, bloom_of_ids, stored
from callpay.llm.textcodes import ALPHANUMERIC, batches_of, bloom_has, grams, id_codes, mix, word_codes

SPAN, GRAM = 10, 5
WINDOW = SPAN - GRAM + 1
#: Words kept around a hit: what a shared run of SPAN words can reach on either side, and the run of GRAM.
SIDE = SPAN - GRAM
AROUND = SIDE + GRAM + SIDE
PAD_TEXT, PAD_ITEM = np.uint64(0), np.uint64(1)

_HITS = "array<struct<code: bigint, at: int, length: int, words: array<bigint>>>"


def fingerprints(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) kept by winnowing, for texts of words ``codes`` cut at ``offsets``."""
    runs = grams(codes, GRAM)
    n = len(codes) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    least, at = runs[:n].copy(), np.arange(n)
    for i in range(1, WINDOW):
        later = runs[i : n + i]
        closer = later <= least
        least[closer] = later[closer]
        at[closer] = (np.arange(n) + i)[closer]
    kept = np.unique(at[text[:n] == text[SPAN - 1 :]])
    return runs[kept], kept


def _around(codes: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int, pad: np.uint64) -> np.ndarray:
    """The words around each position as rows of AROUND codes; where the text ends, ``pad``."""
    text = np.searchsorted(offsets, at, "right") - 1
    first = at - (SIDE if length == 0 else 0)
    spots = first[:, None] + np.arange(AROUND)
    inside = (spots >= offsets[text][:, None]) & (spots < offsets[text + 1][:, None])
    if length:
        inside &= np.arange(AROUND) < length
        pad = PAD_TEXT
    out = np.full(spots.shape, pad, np.uint64)
    out[inside] = codes[spots[inside]]
    return out


def _hits(codes, offsets, lengths, pad, passes=None) -> tuple[np.ndarray, ...]:
    """(text, hash, position in the text, length or 0, words around) of fingerprints and of short runs that pass."""
    parts = []
    for length in (0, *lengths):
        if length:
            code = grams(codes, length)
            at = np.arange(len(code))
            text = np.searchsorted(offsets, at, "right") - 1
            inside = at + length <= offsets[text + 1]
            code, at = code[inside], at[inside]
        else:
            code, at = fingerprints(codes, offsets)
        if passes is not None and len(code):
            ok = passes(code)
            code, at = code[ok], at[ok]
        text = np.searchsorted(offsets, at, "right") - 1
        words = _around(codes, offsets, at, length, pad) if len(at) else np.zeros((0, AROUND), np.uint64)
        parts.append((text, code, at - offsets[text], np.full(len(at), length), words))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _table_of(text, code, at, length, words) -> pa.StructArray:
    around = pa.ListArray.from_arrays(
        np.arange(0, len(code) * AROUND + 1, AROUND, dtype=np.int32), pa.array(words.reshape(-1).view(np.int64))
    )
    return pa.StructArray.from_arrays(
        [pa.array(code.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32)), around],
        ["code", "at", "length", "words"],
    )


def benchmark_marks(items: DataFrame) -> DataFrame:
    """(code, length, words, items): what is looked for, and the ids of the items that have it."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                codes, offsets = word_codes(part.column("text"), ALPHANUMERIC)
                n = np.diff(offsets)
                text, code, at, length, words = _hits(codes, offsets, range(1, SPAN), PAD_ITEM)
                fits = np.where(length == 0, n[text] >= SPAN, n[text] == length)
                found = _table_of(text[fits], code[fits], at[fits], length[fits], words[fits])
                ids = part.column("item").take(pa.array(text[fits]))
                yield pa.RecordBatch.from_arrays(
                    [ids, found.field("code"), found.field("length"), found.field("words")],
                    ["item", "code", "length", "words"],
                )

    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(
        marks, "item string, code bigint, length int, words array<bigint>"
    )
    return stored(rows.groupBy("code", "length", "words").agg(F.collect_set("item").alias("items")), "marks")


def _text_codes(codes: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """Two codes of each text, from its words and their places."""
    with np.errstate(over="ignore"):
        place = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
        placed = mix(codes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (placed, mix(placed))]
        return [pa.array((s[offsets[1:]] - s[offsets[:-1]]).view(np.int64)) for s in sums]


def find_hits(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, two text codes, and the places that may hold a mark."""
    filled = bloom_bits(marks, "code")
    lengths = sorted(r["length"] for r in marks.where("length > 0").select("length").distinct().collect())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                codes, offsets = word_codes(part.column("text"), ALPHANUMERIC)
                text, *rest = _hits(codes, offsets, lengths, PAD_TEXT, lambda c: bloom_has(filled, c))
                order = np.argsort(text, kind="stable")
                found = _table_of(text[order], *[x[order] for x in rest])
                ends = np.searchsorted(text[order], np.arange(len(offsets)), "left").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(offsets)),
                        *_text_codes(codes, offsets),
                        pa.ListArray.from_arrays(pa.array(ends), found),
                    ],
                    ["doc_id", "n_words", "code_a", "code_b", "hits"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, code_a bigint, code_b bigint, hits {_HITS}"
    )


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joint hits to shared runs: from the common run outwards as long as words are equal."""
    for batch in batches:
        both = [
            np.asarray(batch.column(c).flatten()).reshape(-1, AROUND) if batch.num_rows else np.zeros((0, AROUND), np.int64)
            for c in ("words", "item_words")
        ]
        equal = both[0] == both[1]
        length = np.asarray(batch.column("length"))
        left = np.cumprod(equal[:, :SIDE][:, ::-1], axis=1).sum(axis=1)
        right = np.cumprod(equal[:, SIDE + GRAM :], axis=1).sum(axis=1)
        core = equal[:, SIDE : SIDE + GRAM].all(axis=1)
        at = np.asarray(batch.column("at")).astype(np.int64)
        short = length > 0
        start, end = np.where(short, at, at - left), np.where(short, at + length, at + GRAM + right)
        hit = np.where(short, equal.all(axis=1), core & (end - start >= SPAN))
        keep = pa.array(hit)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(keep) for c in ("code_a", "code_b")]
            + [pa.array(start[hit]), pa.array(end[hit]), batch.column("items").filter(keep)],
            ["code_a", "code_b", "start", "end", "items"],
        )


def _covered(spans):
    """Words inside a sorted array of (start, end) spans."""
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"),
        F.greatest(a["to"], s["end"]).alias("to"),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    return F.aggregate(spans, zero, step)["n"]


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside shared runs) and ``items`` (their ids as sorted strings)."""
    return _coded_contamination(docs, items).drop("code_a", "code_b")


def _coded_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`contamination` with the two codes of each row's text."""
    marks = benchmark_marks(items)
    found = stored(find_hits(docs, marks), "hits")
    texts = found.where(F.size("hits") > 0).dropDuplicates(["code_a", "code_b"])
    places = texts.select("code_a", "code_b", F.explode("hits").alias("h")).select("code_a", "code_b", "h.*")
    wanted = marks.select(F.col("code").alias("m_code"), F.col("length").alias("m_length"), F.col("words").alias("item_words"), "items")
    joint = places.join(wanted, (F.col("code") == F.col("m_code")) & (F.col("length") == F.col("m_length")))
    runs = joint.select("code_a", "code_b", "at", "length", "words", "item_words", "items").mapInArrow(
        _extend, "code_a bigint, code_b bigint, start bigint, end bigint, items array<string>"
    )
    spans = runs.groupBy("code_a", "code_b").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"), F.collect_set("items").alias("lists")
    )
    hits = stored(
        spans.select(
            F.col("code_a").alias("h_a"),
            F.col("code_b").alias("h_b"),
            _covered(F.col("spans")).alias("hit"),
            F.array_sort(F.array_distinct(F.flatten("lists"))).alias("ids"),
        ),
        "contaminated",
    )
    joined = found.drop("hits").join(hits, (F.col("code_a") == F.col("h_a")) & (F.col("code_b") == F.col("h_b")), "left")
    return joined.select(
        "doc_id",
        "code_a",
        "code_b",
        "n_words",
        F.coalesce("hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows without a hit, as they came. Each row is judged by its own words, whatever other rows of its id, or without id, have."""
    names, schema = docs.columns, docs.schema
    found = _coded_contamination(docs, items).where("n_hit > 0")
    bad = stored(found.select(F.col("doc_id").alias("__b_id"), F.col("code_a").alias("__b_a"), F.col("code_b").alias("__b_b")).distinct(), "hit-rows")
    filled = bloom_of_ids(bad.select("__b_id"))

    def may(batch: pa.RecordBatch) -> np.ndarray:
        return bloom_has(filled, np.asarray(id_codes(batch.column("doc_id"))).view(np.uint64))

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~may(batch)))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch.filter(pa.array(may(batch)))):
                own = _text_codes(*word_codes(part.column("text"), ALPHANUMERIC))
                yield pa.RecordBatch.from_arrays([*part.columns, *own], [*names, "__a", "__b"])

    # rows that share no id with a hit pass straight through, only the others are shuffled
    kept = docs.mapInArrow(coded, StructType([*schema.fields, StructField("__a", LongType()), StructField("__b", LongType())]))
    same = F.col("doc_id").eqNullSafe(F.col("__b_id")) & (F.col("__a") == F.col("__b_a")) & (F.col("__b") == F.col("__b_b"))
    return docs.mapInArrow(clear, schema).unionByName(kept.join(bad, same, "left_anti").select(*names))
