"""N-gram Jaccard join: texts whose sets of word shingles are similar, and the groups they form.

Rare-first prefix filtering. All shingles have one global order, by how often a counter they share with
others was hit (a fixed number of counters over the whole corpus) and then by hash. Two sets that reach
the threshold must share a shingle of their prefixes, the first n - ceil(t n) + 1 in that order;
any order is exact, a rare-first one makes prefixes meet seldom. Prefixes are joined on the shingle. A pair
passes the length filter, the positional filter (what may still be shared after the place where the
prefixes met) and the suffix filter (how many shingles both have in each range of the hash, ranges of about
six shingles: the differences bound the overlap), and is then verified once on the whole sets.

Equal sets are one node. Groups of many near copies are not expanded into all pairs either: the members of a
prefix's list are first compared to its most central member only. What that links is one component; a
second round compares the members of a list that are outside its largest component to those of
other components, with the same filters. A pair left out is inside one component already, so
components are exact.

Cases: NULL text and text without words have an empty set and no links; shorter texts are one shingle;
repeated rows and equal texts share a group; rows of one id are one document in the
groups; ``keep_one`` judges each row by its own text, also rows without id; long texts are worked off in blocks;
an empty table gives no rows. Other columns do not pass through the join; ``keep_one`` keeps all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpay.llm.shared import bloom_of_ids, components, drop_ids, stored
from callpay.llm.textcodes import NOT_BLANK, batches_of, bloom_has, grams, id_codes, mix, word_codes

#: Defaults: words of a shingle, and the least similarity in percent.
SHINGLE, PERCENT = 5, 80
COUNTER_BITS = 16


def _shingles(part: pa.RecordBatch, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle codes of a slice of texts, in order, and the offsets of the texts; a short text is one shingle."""
    codes, offsets = word_codes(part.column("text"), NOT_BLANK)
    n = np.diff(offsets)
    counts = np.where(n >= shingle, n - shingle + 1, (n > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(ends[-1], np.uint64)
    runs = grams(codes, shingle)
    long = n >= shingle
    text = np.repeat(np.flatnonzero(long), counts[long])
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts[long]) - counts[long], counts[long])
    out[ends[text] + nth] = runs[offsets[text] + nth]
    for i in np.flatnonzero(~long & (n > 0)):
        out[ends[i]] = grams(codes[offsets[i] : offsets[i + 1]], int(n[i]))[0]
    return out, ends


def count_shingles(docs: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """How often each of the counters was hit, over all texts. Fixed size: 2 ** COUNTER_BITS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for part in batches_of(batch):
                codes, _ = _shingles(part, shingle)
                total += np.bincount((codes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["counter", "n"])

    rows = docs.select("text").mapInArrow(count, "counter bigint, n bigint").groupBy("counter").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << COUNTER_BITS, np.int64)
    total[rows["counter"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return total


def needed(a, b, percent: int = PERCENT):
    """Least overlap of two sets of these sizes that reaches the threshold."""
    return F.ceil(percent * (a + b) / F.lit(float(100 + percent)) - 1e-9)


def _range_counts(own: np.ndarray) -> bytes:
    """How many members fall into each of 2, 4, 8, ... equal ranges of the hash, a byte each (at most 255)."""
    bits = max(1, len(own).bit_length() - 3)
    counts = np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _may_overlap(batches: Iterator[pa.RecordBatch], percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    """Suffix filter: pairs whose range counts do not rule the threshold out. Counts cut at 255 differ less, so they rule out less."""
    for batch in batches:
        ok = []
        for n, m, x, y in zip(*(batch.column(c) for c in ("a_n", "b_n", "a_r", "b_r")), strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64), np.frombuffer(y.as_buffer(), np.uint8).astype(np.int64)
            width = min(len(p), len(q))
            p, q = p.reshape(width, -1).sum(axis=1), q.reshape(width, -1).sum(axis=1)
            total = n.as_py() + m.as_py()
            ok.append(np.abs(p - q).sum() <= total - 2 * (-(-percent * total // (100 + percent))))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def prefixes(docs: DataFrame, counters: np.ndarray, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, set size n, two codes of the set, prefix in order, counts by hash range."""
    seen = counters.tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.frombuffer(seen, np.int64)
        for batch in batches:
            for part in batches_of(batch):
                codes, ends = _shingles(part, shingle)
                sizes, sums, heads, ranges = [], [], [], []
                for a, b in zip(ends[:-1], ends[1:], strict=True):
                    own = np.unique(codes[a:b])
                    n = len(own)
                    kept = n + (percent * n) // -100 + 1 if n else 0
                    order = np.lexsort((own, often[(own >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]))[:kept]
                    with np.errstate(over="ignore"):
                        sums.append((own.sum(dtype=np.uint64), mix(own).sum(dtype=np.uint64)))
                    sizes.append(n)
                    heads.append(own[order])
                    ranges.append(_range_counts(own))
                at = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(heads).view(np.int64)))
                both = np.array(sums, np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), prefix, pa.array(ranges, pa.binary())],
                    ["doc_id", "n", "set_a", "set_b", "prefix", "ranges"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id bigint, n int, set_a bigint, set_b bigint, prefix array<bigint>, ranges binary"
    )


def _whole_sets(docs: DataFrame, ids: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, whole set as sorted bytes) of at least the documents named by ``ids``, picked by a filter of fixed size."""
    filled = bloom_of_ids(ids)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = bloom_has(filled, np.asarray(id_codes(batch.column("doc_id"))).view(np.uint64))
            for part in batches_of(batch.filter(pa.array(wanted))):
                codes, ends = _shingles(part, shingle)
                sets = [np.unique(codes[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "members"])

    return stored(docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(pick, "doc_id bigint, members binary"), "sets")


def _similar(batches: Iterator[pa.RecordBatch], percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(p) + len(q) - len(np.union1d(p, q))
            ok.append(100 * both >= percent * (len(p) + len(q) - both))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])


def _verified(pairs: DataFrame, spread: DataFrame, docs: DataFrame, name: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that pass the suffix filter and then the exact test, each tested once.

    Whole sets are made again from the texts, of the documents that are left in a pair.
    """
    side = lambda c: spread.select(F.col("doc_id").alias(f"{c}_id"), F.col("n").alias(f"{c}_n"), F.col("ranges").alias(f"{c}_r"))
    sized = pairs.distinct().join(side("a"), F.col("a") == F.col("a_id")).join(side("b"), F.col("b") == F.col("b_id"))
    left = sized.select("a", "b", "a_n", "b_n", "a_r", "b_r").mapInArrow(partial(_may_overlap, percent=percent), "a bigint, b bigint")
    left = stored(left.distinct(), f"{name}-pairs")
    sets = _whole_sets(docs, left.select("a").union(left.select("b")).distinct(), shingle)
    members = lambda c, out: sets.select(F.col("doc_id").alias(f"{c}_id"), F.col("members").alias(out))
    whole = left.join(members("a", "x"), F.col("a") == F.col("a_id")).join(members("b", "y"), F.col("b") == F.col("b_id"))
    return stored(whole.select("a", "b", "x", "y").mapInArrow(partial(_similar, percent=percent), "a bigint, b bigint").distinct(), name)


def _may_link(n: str, at: str, m: str, to: str, percent: int = PERCENT) -> Column:
    """Length and positional filter for prefix places ``at`` and ``to`` of sets of sizes ``n`` and ``m``."""
    n, at, m, to = F.col(n), F.col(at), F.col(m), F.col(to)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.least(n - at, m - to) >= needed(n, m, percent))


def similarity_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (smallest id reachable by links).

    Texts are linked if their sets of runs of ``shingle`` words have a Jaccard similarity of ``percent`` or more.
    """
    rows = stored(prefixes(docs, count_shingles(docs, shingle), shingle, percent), "prefixes")
    same = ["set_a", "set_b", "n"]
    firsts = stored(
        rows.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("node")).withColumnsRenamed({c: f"f_{c}" for c in same}),
        "equal-sets",
    )
    equal = (F.col("set_a") == F.col("f_set_a")) & (F.col("set_b") == F.col("f_set_b")) & (F.col("n") == F.col("f_n"))
    nodes = rows.join(firsts, equal & (F.col("doc_id") == F.col("node")))
    places = nodes.select("doc_id", "n", F.posexplode("prefix").alias("at", "shingle")).repartition("shingle")
    lists = places.groupBy("shingle").agg(F.count("*").alias("members"), F.min("n").alias("least"))
    lists = lists.where("members > 1").withColumnRenamed("shingle", "l_shingle")
    smallest = F.greatest(F.col("least"), F.ceil(percent * F.col("n") / 100.0 - 1e-9))
    met = stored(
        places.join(lists, F.col("shingle") == F.col("l_shingle"))
        .where(F.col("n") - F.col("at") >= needed(F.col("n"), smallest, percent))
        .select("shingle", "doc_id", "n", "at"),
        "prefix-lists",
    )
    spread = rows.join(met.select(F.col("doc_id").alias("m_id")).distinct(), F.col("doc_id") == F.col("m_id")).select("doc_id", "n", "ranges")
    spread = stored(spread.distinct(), "ranges")

    center = met.groupBy("shingle").agg(F.min(F.struct("at", "n", "doc_id")).alias("c"))
    center = center.select(F.col("shingle").alias("c_shingle"), F.col("c.at").alias("to"), F.col("c.n").alias("m"), F.col("c.doc_id").alias("center"))
    near = met.join(center, F.col("shingle") == F.col("c_shingle")).where(F.col("doc_id") != F.col("center"))
    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    first = _verified(near.where(_may_link("n", "at", "m", "to", percent)).select(*ordered("doc_id", "center")), spread, docs, "links-center", shingle, percent)

    groups = components(first, "groups-center")
    member = groups.select(F.col("node").alias("g_node"), F.col("component").alias("g"))
    grouped = stored(
        met.join(member, F.col("doc_id") == F.col("g_node"), "left").select("shingle", "doc_id", "n", "at", F.coalesce("g", "doc_id").alias("g")),
        "grouped-lists",
    )
    sizes = grouped.groupBy("shingle", "g").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy(F.col("shingle").alias("s_shingle")).agg(F.count("*").alias("groups"), F.max(F.struct("size", "g"))["g"].alias("main"))
    mixed = stored(mixed.where("groups > 1"), "mixed-lists")
    open_lists = stored(grouped.join(mixed, F.col("shingle") == F.col("s_shingle")).select(*grouped.columns, "main"), "open-lists")
    outside = open_lists.where("g <> main").select(
        F.col("shingle").alias("o_shingle"), F.col("doc_id").alias("o_id"), F.col("n").alias("m"), F.col("at").alias("to"), F.col("g").alias("o_g")
    )
    once = (F.col("g") == F.col("main")) | (F.col("doc_id") < F.col("o_id"))
    across = open_lists.join(
        outside, (F.col("shingle") == F.col("o_shingle")) & (F.col("g") != F.col("o_g")) & once & _may_link("n", "at", "m", "to", percent)
    )
    second = _verified(across.select(*ordered("doc_id", "o_id")), spread, docs, "links-across", shingle, percent)
    final = components(first.unionByName(second), "groups")

    joined = firsts.join(final.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left")
    roots = stored(joined.select("f_set_a", "f_set_b", "f_n", F.coalesce("component", F.col("node")).alias("root")), "roots")
    out = rows.select("doc_id", *same).join(roots, equal, "left")
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))


def _separate(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows of an id of their own, the others): rows without id, or of an id that occurs again, are listed once per text.

    The others have their id in ``__id``, a code of their text in ``__tie``, and in ``doc_id`` a number that no row has.
    """
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    odd = stored(counts.where("n > 1 or doc_id is null").select(F.col("doc_id").alias("__odd")), "odd-ids")
    if odd.isEmpty():
        return docs, None
    single = drop_ids(docs, odd)
    again = docs.join(odd, F.col("doc_id").eqNullSafe(F.col("__odd")), "left_semi").dropDuplicates(["doc_id", "text"])
    again = stored(
        again.withColumns({"__id": F.col("doc_id"), "__tie": F.xxhash64("text"), "__n": F.monotonically_increasing_id()}), "odd-rows"
    )
    part, at = F.shiftright("__n", 33), F.col("__n").bitwiseAND((1 << 33) - 1)
    so_far = F.sum("rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = again.groupBy(part.alias("__part")).agg(F.count("*").alias("rows"))
    parts = stored(parts.select("__part", (so_far - F.col("rows")).alias("__before")), "odd-parts")
    low, high = counts.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high, rows = low or 0, high or 0, again.count()
    if high + rows < 1 << 63:
        base = high + 1
    elif low - rows >= -(1 << 63):
        base = low - rows
    else:
        raise ValueError("no numbers left for rows without an id of their own")
    numbered = again.join(parts, part == F.col("__part")).withColumn("doc_id", F.lit(base) + F.col("__before") + at)
    return single, numbered.drop("__n", "__part", "__before")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows with one left of each group of similar texts, the one of the smallest id, with the columns they came with.

    Each row is judged by its own text: rows without id and different texts of one id are documents of their own. Of
    rows with equal id and text one counts. Among equal ids a code of the text decides, an id goes before none.
    """
    names = docs.columns
    single, others = _separate(docs)
    if others is None:
        ids = stored(similarity_groups(docs, shingle, percent), "similar")
        return drop_ids(docs, stored(ids.where("doc_id <> component_id").select("doc_id"), "not-first"))
    rows = single.select("doc_id", "text").unionByName(others.select("doc_id", "text"))
    groups = similarity_groups(rows, shingle, percent).select(F.col("doc_id").alias("key"), "component_id")
    own = others.select(F.col("doc_id").alias("o_key"), "__id", "__tie")
    placed = stored(
        groups.join(own, F.col("key") == F.col("o_key"), "left").select(
            "component_id",
            "key",
            F.col("o_key").isNotNull().alias("other"),
            F.when(F.col("o_key").isNull(), F.col("key")).otherwise(F.col("__id")).alias("id"),
            F.coalesce("__tie", F.lit(0)).alias("tie"),
        ),
        "similar",
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "tie", "key")
    first = placed.groupBy(F.col("component_id").alias("c")).agg(F.min(order)["key"].alias("first"))
    gone = stored(
        placed.join(first, F.col("component_id") == F.col("c")).where("key <> first").select(F.col("key").alias("__gone"), "other"), "not-first"
    )
    left = others.join(gone.where("other"), F.col("doc_id") == F.col("__gone"), "left_anti")
    left = left.withColumn("doc_id", F.col("__id")).select(*names)
    return drop_ids(single, gone.where("not other").select("__gone")).select(*names).unionByName(left)
