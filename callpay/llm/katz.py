"""Katz backoff language model of word pairs: Good-Turing discounts, exactly normalised backoff weights.

P(w | h) is d(c) * c(h, w) / c(h) for a pair seen in training, otherwise alpha(h) * P(w), and P(w) is d(c) * c(w) / N
for a known word, otherwise the mass that the discounts of single words leave, given to one unknown word.
Discounts of counts up to ``CUTOFF`` follow Good and Turing from the counts of counts, larger counts are not
discounted. alpha(h) is what the discounted pairs of h leave, over what their words leave in P; a
history without discounted pairs counts once more, so that something is left.

Tables. Word counts are one table. Pairs are dealt out by their history into buckets of about
``BUCKET_TOKENS`` tokens, as compact records: a record holds the pairs of one bucket in a few million
tokens, each with the texts that have it. One such bucket has all pairs of its histories, hence c(h, w), c(h) and
alpha(h), and evaluates each of its tokens once. A text's score is the sum over its buckets. Counts
of the words w come along: those of the ``KNOWN`` most frequent from a list of that bounded size,
those of all others from the table of word counts, by a join. A history with more than ``HOT`` tokens is split
over buckets by the next word; its alpha is put together from their sums.

Texts with the same tokens are one text with its number of training copies. Texts are read three
times rather than shuffled.

Cases: NULL and empty texts have the end token only; repeated ids and rows each get their row; without training
documents every token is unknown; very long texts are worked off in blocks; an empty table gives no rows. Other
columns do not pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import arrow_rows, stored
from callpay.llm.textcodes import NOT_BLANK, batches_of, mix, word_codes

CUTOFF = 5
KNOWN = 1 << 20
BUCKET_TOKENS, BUCKETS_IN_TASK, CHUNK_TOKENS = 1 << 19, 12, 1 << 19
#: Texts or records in one batch.
BATCH_ROWS = 200
HOT = 1 << 21
END, START = np.uint64(0x5EED0FE4D), np.uint64(0x57A47)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def discounts(of_counts: list[int]) -> np.ndarray:
    """d(0..CUTOFF) from how many things occur 1 .. CUTOFF + 1 times; d(0) is unused.

    Where the counts of counts are too few for Good-Turing (a discount outside (0, 1)), the largest cutoff
    that gives proper ones is taken, and if none does, half an occurrence is taken off counts up to CUTOFF.
    """
    for k in range(CUTOFF, 0, -1):
        n = [0, *of_counts]
        if any(n[r] <= 0 for r in range(1, k + 2)):
            continue
        common = (k + 1) * n[k + 1] / n[1]
        d = [((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if common < 1 else 2.0 for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([1.0, *d, *[1.0] * (CUTOFF - k)])
    return np.array([1.0, *[1 - 0.5 / r for r in range(1, CUTOFF + 1)]])


@dataclass(frozen=True)
class Words:
    """Totals of the training tokens, and the most frequent words with their counts, by code.

    ``shared`` is what probabilities are shares of: the tokens, or one more where no count is discounted.
    """

    tokens: int
    kinds: int
    shared: int
    discount: np.ndarray
    unknown: float
    codes: np.ndarray
    counts: np.ndarray

    def probability(self, count: np.ndarray) -> np.ndarray:
        """P(w) of words with these counts."""
        if not self.tokens:
            return np.ones(len(count))
        kept = np.where(count <= CUTOFF, self.discount[np.minimum(count, CUTOFF)], 1.0) * count / self.shared
        return np.where(count > 0, kept, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token codes with an end after each text, and offsets."""
    codes, offsets = word_codes(part.column("text"), NOT_BLANK)
    return np.insert(codes, offsets[1:], END), offsets + np.arange(len(offsets))


def _keys(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A code of each whole text."""
    with np.errstate(over="ignore"):
        place = (np.arange(len(tokens)) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + place * _ODD))])
        return mix(sums[offsets[1:]] - sums[offsets[:-1]])


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of each value over them."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, *[np.bincount(at, v, len(distinct)) for v in values]


def count_words(docs: DataFrame) -> DataFrame:
    """(code, n) of the training tokens of (text, train) rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            codes, n = _summed(np.concatenate([c for c, _ in held]), np.concatenate([x for _, x in held]))
            held[:] = [(codes, n)]
            return codes, n.astype(np.int64)

        def out():
            codes, n = merged()
            held.clear()
            for a in range(0, len(codes), 200_000):
                b = slice(a, a + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(codes[b].view(np.int64)), pa.array(n[b])], ["code", "n"])

        size = 0
        for batch in batches:
            for part in batches_of(batch.filter(batch.column("train"))):
                tokens, _ = _tokens(part)
                codes, n = np.unique(tokens, return_counts=True)
                held.append((codes, n.astype(float)))
                size += len(codes)
                if size > 3_000_000:
                    size = len(merged()[0])
                    if size > 1_500_000:
                        yield from out()
                        size = 0
        if held:
            yield from out()

    counted = docs.select("text", "train").mapInArrow(count, "code bigint, n bigint")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def learn_words(counts: DataFrame, known: int = KNOWN) -> Words:
    """Totals and the list of the most frequent words: at most ``known`` of them reach the driver."""
    level = F.floor(8 * F.log2("n"))
    some = [F.sum(F.when(F.col("n") == r, 1).otherwise(0)).alias(f"n{r}") for r in range(1, CUTOFF + 2)]
    totals = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds"), *some).first()
    of_counts = [totals[f"n{r}"] or 0 for r in range(1, CUTOFF + 2)]
    # a few hundred levels of counts tell from which count on the list does not get too long
    levels = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, listed = None, 0
    for at, n in levels:
        if listed + n > known:
            break
        least, listed = at, listed + n
    frequent = counts.where(level >= (least if least is not None else 1 << 30)).toArrow()
    codes = np.asarray(frequent.column("code").combine_chunks(), np.int64).view(np.uint64)
    n = np.asarray(frequent.column("n").combine_chunks(), np.int64)
    order = np.argsort(codes)
    discount = discounts(of_counts)
    left = sum(r * (1 - discount[r]) * of_counts[r - 1] for r in range(1, CUTOFF + 1))
    tokens = int(totals["tokens"] or 0)
    shared = tokens if left else tokens + 1
    return Words(tokens, int(totals["kinds"]), shared, discount, (left or 1.0) / shared if shared else 1.0, codes[order], n[order])


def _lookup(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of codes in a sorted list, -1 where absent."""
    if not len(sorted_codes):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == codes, at, -1)


class _Chunk:
    """Tokens of many texts, dealt into buckets by history."""

    def __init__(self, words: Words, buckets: int, hot: np.ndarray):
        self.words, self.buckets, self.hot = words, buckets, hot
        self.tokens: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.train: list[np.ndarray] = []
        self.size = 0

    def add(self, part: pa.RecordBatch) -> None:
        tokens, offsets = _tokens(part)
        self.tokens.append(tokens)
        self.lengths.append(np.diff(offsets))
        self.keys.append(_keys(tokens, offsets))
        self.train.append(np.asarray(part.column("train").cast(pa.int64())))
        self.size += len(tokens)

    def pairs(self):
        """Sorted by bucket, history, word, text: (bucket, history, word) numbers and the vocabulary they point to."""
        tokens, lengths = np.concatenate(self.tokens), np.concatenate(self.lengths)
        keys, train = np.concatenate(self.keys), np.concatenate(self.train)
        texts, first, at = np.unique(keys, return_index=True, return_inverse=True)
        copies = np.bincount(at, train, len(texts)).astype(np.int64)
        once = np.zeros(len(keys), bool)
        once[first] = True
        text = np.repeat(at, lengths)
        inside = np.repeat(once, lengths)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[np.cumsum(lengths) - lengths] = START
        tokens, before, text = tokens[inside], before[inside], text[inside]
        vocabulary, ids = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        word, history = ids[: len(tokens)], ids[len(tokens) :]
        del ids, before
        spread = mix(vocabulary + np.uint64(3))
        place = spread[history]
        if len(self.hot):
            is_hot = (_lookup(self.hot, vocabulary) >= 0)[history]
            place[is_hot] = mix(place[is_hot] ^ spread[word[is_hot]])
        bucket = (place % np.uint64(self.buckets)).astype(np.int64)
        return vocabulary, texts, copies, bucket, history, word, text

    def rare(self) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, word code) of words that are not on the list, distinct."""
        vocabulary, _, _, bucket, _, word, _ = self.pairs()
        unlisted = (_lookup(self.words.codes, vocabulary) < 0)[word]
        both = np.unique(bucket[unlisted] * len(vocabulary) + word[unlisted])
        return both // len(vocabulary), vocabulary[both % len(vocabulary)]

    def records(self) -> Iterator[tuple[int, bytes]]:
        vocabulary, texts, copies, bucket, history, word, text = self.pairs()
        size = len(vocabulary)
        key = (bucket * size + history) * size + word
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(key)))
        key, text = key[at], text[at]
        word, rest = key % size, key // size
        history, bucket = rest % size, rest // size
        listed = _lookup(self.words.codes, vocabulary)
        edges = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *edges], [*edges, len(bucket)], strict=True):
            yield int(bucket[a]), _pack(vocabulary, listed, texts, copies, history[a:b], word[a:b], text[a:b], times[a:b])


def _small(x: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds these numbers."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _pack(vocabulary, listed, texts, copies, history, word, text, times) -> bytes:
    """One record: distinct words as steps between places on the list or as codes, and per pair small numbers into them."""

    def words(ids: np.ndarray) -> list[np.ndarray]:
        place = listed[ids]
        known = np.sort(place[place >= 0])
        return [_small(np.diff(known, prepend=0)), np.sort(vocabulary[ids[place < 0]])]

    def number(ids: np.ndarray, distinct: np.ndarray) -> np.ndarray:
        place = listed[distinct]
        rank = np.empty(len(distinct), np.int64)  # listed ones by place, then the others by code
        rank[np.lexsort((vocabulary[distinct], place, place < 0))] = np.arange(len(distinct))
        return rank[np.searchsorted(distinct, ids)]

    h, runs = np.unique(history, return_counts=True)
    w, t = np.unique(word), np.unique(text)
    parts = [*words(h), _small(number(h, h)), _small(runs), *words(w), _small(number(word, w))]
    parts += [texts[t], _small(copies[t]), _small(np.searchsorted(t, text)), _small(times)]
    head = np.array([v for p in parts for v in (p.itemsize, len(p))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *[p.tobytes() for p in parts]]))


def _unpack(record: bytes, codes: np.ndarray):
    """(history code, word code, word's place on the list or -1, text, copies, times) per pair."""
    raw = zstandard.ZstdDecompressor().decompress(record)
    head = np.frombuffer(raw, np.int64, 22).reshape(-1, 2)
    at, parts = 22 * 8, []
    for width, n in head:
        parts.append(np.frombuffer(raw, f"u{width}", n, at))
        at += width * n
    known_h, other_h, h, runs, known_w, other_w, w, texts, copies, text, times = parts
    place_h, place_w = np.cumsum(known_h.astype(np.int64)), np.cumsum(known_w.astype(np.int64))
    histories = np.concatenate([codes[place_h], other_h])[h]
    words = np.concatenate([codes[place_w], other_w])
    places = np.concatenate([place_w, np.full(len(other_w), -1)])
    return np.repeat(histories, runs), words[w], places[w], texts[text], copies[text].astype(np.int64), times.astype(np.int64)


class _Bucket:
    """All pairs of one bucket's histories, counted."""

    def __init__(self, records: list[bytes], rare: tuple[np.ndarray, np.ndarray], words: Words):
        loaded = [_unpack(r, words.codes) for r in records]
        history, word, place, text, copies, times = (np.concatenate(x) for x in zip(*loaded, strict=True))
        del loaded
        with np.errstate(over="ignore"):
            pair = mix(history * _ODD + word)
        kinds, first, self.kind = np.unique(pair, return_index=True, return_inverse=True)
        self.count = np.bincount(self.kind, copies * times, len(kinds)).astype(np.int64)
        self.history, word, place = history[first], word[first], place[first]
        n = words.counts[place] if len(words.counts) else np.zeros(len(place), np.int64)
        codes, counts = rare
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        other = _lookup(codes, word)
        known_rare = counts[other] if len(counts) else np.zeros(len(word), np.int64)
        self.word_count = np.where(place >= 0, n, np.where(other >= 0, known_rare, 0))
        self.text, self.times = text, times

    def once_per_text(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(kind, text, times): copies of a text in several records are one."""
        order = np.lexsort((self.text, self.kind))
        kind, text, times = self.kind[order], self.text[order], self.times[order]
        new = np.ones(len(kind), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (text[1:] != text[:-1])
        return kind[new], text[new], times[new]


def _buckets(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[tuple[int, pa.RecordBatch, _Bucket]]:
    """Counted buckets of a task, one after the other; rows are sorted by bucket."""
    records: list[bytes] = []
    codes: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    at = None
    for batch in batches:
        bucket = np.asarray(batch.column("bucket"))
        edges = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *edges], [*edges, len(bucket)], strict=True) if len(bucket) else ():
            if at is not None and bucket[a] != at and records:
                yield at, batch, _Bucket(records, (np.concatenate(codes), np.concatenate(counts)), words)
            if bucket[a] != at:
                at, records = int(bucket[a]), []
                codes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            part = batch.slice(a, b - a)
            plain = part.filter(part.column("record").is_null())
            codes.append(np.asarray(plain.column("code"), np.int64).view(np.uint64))
            counts.append(np.asarray(plain.column("n"), np.int64))
            records += [r.as_py() for r in part.column("record") if r.is_valid]
            last = batch
    if records:
        yield at, last, _Bucket(records, (np.concatenate(codes), np.concatenate(counts)), words)


_SCORED = "kind int, text bigint, history bigint, tokens bigint, base double, score double, record binary"


def _evaluate(bucket: _Bucket, words: Words, discount: np.ndarray, hot: np.ndarray, hot_counts: np.ndarray):
    """Sums per text; the unseen tokens of split histories per text; and what those histories' pairs take, as (low kinds, discounted, P of words)."""
    seen = bucket.count > 0
    histories, h = np.unique(bucket.history, return_inverse=True)
    lower = words.probability(bucket.word_count)
    taken = np.where(bucket.count <= CUTOFF, discount[np.minimum(bucket.count, CUTOFF)], 1.0) * bucket.count
    total = np.bincount(h, bucket.count, len(histories))
    low = np.bincount(h, seen & (bucket.count <= CUTOFF) & (taken < bucket.count), len(histories))
    mass, words_mass = np.bincount(h, taken, len(histories)), np.bincount(h, lower * seen, len(histories))
    split = _lookup(hot, histories)
    total = np.where(split >= 0, hot_counts[split] if len(hot) else 0, total)
    total = total + ((low == 0) & (split < 0) & (total > 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        alpha = np.where(total > 0, np.log10((total - mass) / total) - np.log10(np.maximum(1 - words_mass, 1e-300)), 0.0)
        value = np.where(seen, np.log10(taken) - np.log10(total[h]), np.log10(lower) + np.where(split[h] >= 0, 0.0, alpha[h]))
    base, known = words.base(bucket.word_count), bucket.word_count > 0
    kind, text, times = bucket.once_per_text()
    sums = _summed(text, known[kind] * times, base[kind] * times, value[kind] * times)
    open_kinds = (split[h] >= 0) & ~seen
    later = open_kinds[kind]
    stats = [(histories[i], low[i], mass[i], words_mass[i]) for i in np.flatnonzero(split >= 0)]
    return sums, (text[later], histories[h[kind[later]]], times[later]), stats


def _rows(kind, text, history, tokens, base=0.0, score=0.0, records=None) -> pa.RecordBatch:
    n = len(text)
    column = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t))
    code = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.uint64), n).copy().view(np.int64))
    return pa.RecordBatch.from_arrays(
        [column(kind, np.int32), code(text), code(history), column(tokens, np.int64), column(base, float), column(score, float), pa.array(records or [None] * n, pa.binary())],
        ["kind", "text", "history", "tokens", "base", "score", "record"],
    )


def _pack_sums(sums: tuple[np.ndarray, ...], groups: int) -> tuple[list[int], list[bytes]]:
    """Sums per text as one record for each of ``groups`` groups of texts."""
    group = (sums[0] % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(groups + 1))
    spans = [(g, order[a:b]) for g, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
    return [g for g, _ in spans], [b"".join(x[rows].astype(kind).tobytes() for x, kind in zip(sums, ("u8", "f8", "f8", "f8"), strict=True)) for _, rows in spans]


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of :func:`_pack_sums` to one row per text that a task has."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for record in batch.column("record"):
            columns = np.frombuffer(record.as_buffer(), np.uint64).reshape(4, -1)
            held.append((columns[0], *columns[1:].view(np.float64)))
        if held:
            held = [_summed(*[np.concatenate(x) for x in zip(*held, strict=True)])]
    for text, known, base, score in held:
        names = ["text", "known", "base", "score"]
        yield pa.RecordBatch.from_arrays([pa.array(text.view(np.int64)), pa.array(known), pa.array(base), pa.array(score)], names)


def score_texts(docs: DataFrame, bucket_tokens: int = BUCKET_TOKENS, hot_tokens: int = HOT, known: int = KNOWN) -> tuple[DataFrame, Words]:
    """Per row of ``docs`` (doc_id, text, train): doc_id, train, n_tokens, n_known, base_score, score; and the totals."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _score_texts(docs, bucket_tokens, hot_tokens, known)


def _score_texts(docs: DataFrame, bucket_tokens: int, hot_tokens: int, known: int) -> tuple[DataFrame, Words]:
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "train")
    counts = stored(count_words(docs), "word-counts")
    words = learn_words(counts, known)
    sent = spark.sparkContext.broadcast(words)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                tokens, offsets = _tokens(part)
                keys = pa.array(_keys(tokens, offsets).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("train"), keys, pa.array(np.diff(offsets))], ["doc_id", "train", "text", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = stored(docs.mapInArrow(keyed, f"doc_id {kind}, train boolean, text bigint, tokens bigint"), "text-keys")
    size = texts.agg(F.sum("tokens").alias("all"), F.count_if("train").alias("trained")).first()
    tasks = max(1, -(-(size["all"] or 0) // (bucket_tokens * BUCKETS_IN_TASK)))
    buckets = tasks * BUCKETS_IN_TASK
    often = words.counts > hot_tokens
    hot, hot_counts = words.codes[often], words.counts[often]
    if size["trained"] > hot_tokens:
        at = np.searchsorted(hot, START)
        hot, hot_counts = np.insert(hot, at, START), np.insert(hot_counts, at, size["trained"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
        chunk = _Chunk(sent.value, buckets, hot)
        for batch in batches:
            for part in batches_of(batch):
                chunk.add(part)
                if chunk.size >= CHUNK_TOKENS:
                    yield chunk
                    chunk = _Chunk(sent.value, buckets, hot)
        if chunk.size:
            yield chunk

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            bucket, code = chunk.rare()
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(code.view(np.int64))], ["bucket", "code"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            made = []
            for row in chunk.records():
                made.append(row)
                if len(made) == 16:
                    yield _record_batch(made)
                    made = []
            if made:
                yield _record_batch(made)

    def _record_batch(made):
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in made], pa.int32()), pa.array([r for _, r in made], pa.binary())], ["bucket", "record"])

    wanted = docs.select("text", "train").mapInArrow(rare, "bucket int, code bigint").distinct()
    rare_counts = wanted.join(counts, "code").select("bucket", "code", "n", F.lit(None).cast("binary").alias("record"))
    records = docs.select("text", "train").mapInArrow(pack, "bucket int, record binary").select(
        "bucket", F.lit(None).cast("bigint").alias("code"), F.lit(None).cast("bigint").alias("n"), "record"
    )
    task = F.floor(F.col("bucket") / BUCKETS_IN_TASK)
    dealt = records.unionByName(stored(rare_counts, "rare-counts")).withColumn("task", task).repartition(tasks, "task").drop("task")
    dealt = dealt.sortWithinPartitions("bucket")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CUTOFF + 2, np.int64)
        for _, _, bucket in _buckets(batches, sent.value):
            total += np.bincount(np.minimum(bucket.count, CUTOFF + 2), minlength=CUTOFF + 3)[: CUTOFF + 2]
        yield pa.RecordBatch.from_arrays([pa.array([int(n)], pa.int64()) for n in total[1:]], [f"n{r}" for r in range(1, CUTOFF + 2)])

    names = [f"n{r}" for r in range(1, CUTOFF + 2)]
    tallies = dealt.mapInArrow(tally, ", ".join(f"{c} bigint" for c in names))
    # both passes read one shuffle: the counts of counts first, then the scores that need them
    of_counts = tallies.agg(F.array(*[F.coalesce(F.sum(c), F.lit(0)) for c in names]).alias("of_counts"))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush():
            if held:
                groups, packed = _pack_sums(_summed(*[np.concatenate(x) for x in zip(*held, strict=True)]), tasks)
                yield _rows(0, np.zeros(len(groups), np.uint64), 0, groups, records=packed)
            held.clear()

        for _, batch, bucket in _buckets(batches, sent.value):
            discount = discounts(batch.column("of_counts")[0].as_py())
            sums, (text, history, times), stats = _evaluate(bucket, sent.value, discount, hot, hot_counts)
            held.append(sums)
            if len(text):
                yield _rows(2, text, history, times)
            for code, low, mass, words_mass in stats:
                yield _rows(1, np.zeros(1, np.uint64), code, [int(low)], [mass], [words_mass])
            if sum(len(x[0]) for x in held) > 2_000_000:
                yield from flush()
        yield from flush()

    parts = stored(dealt.withColumn("of_counts", of_counts.scalar()).mapInArrow(evaluate, _SCORED), "text-parts")
    alpha = _split_alphas(parts, hot, hot_counts)
    late = parts.where("kind = 2").join(alpha, "history").select(
        "text", F.lit(0.0).alias("known"), F.lit(0.0).alias("base"), (F.col("tokens") * F.col("alpha")).alias("score")
    )
    # a task has a few tokens of very many texts: their sums travel as one record for each group of texts
    packed = parts.where("kind = 0").select(F.col("tokens").alias("texts"), "record").repartition(tasks, "texts")
    early = packed.select("record").mapInArrow(_add_up, "text bigint, known double, base double, score double")
    sums = early.unionByName(late).groupBy("text").agg(*[F.sum(c).alias(c) for c in ("known", "base", "score")])
    sums = stored(sums.withColumnRenamed("text", "s_text"), "text-scores")
    out = texts.join(sums, F.col("text") == F.col("s_text"), "left").select(
        "doc_id", "train", F.col("tokens").alias("n_tokens"), F.col("known").cast("bigint").alias("n_known"), F.col("base").alias("base_score"), "score"
    )
    return out, words


def _split_alphas(parts: DataFrame, hot: np.ndarray, hot_counts: np.ndarray) -> DataFrame:
    """log10 alpha of histories that were split over buckets: at most one row per entry of the bounded word list."""
    totals = parts.sparkSession.createDataFrame(
        [(int(c), int(n)) for c, n in zip(hot.view(np.int64), hot_counts, strict=True)], "t_history bigint, total bigint"
    )
    sums = parts.where("kind = 1").groupBy("history").agg(F.sum("base").alias("mass"), F.sum("score").alias("words_mass"))
    left = sums.join(totals, F.col("history") == F.col("t_history"))
    mass = (F.col("total") - F.col("mass")) / F.col("total")
    return left.select("history", (F.log10(mass) - F.log10(1 - F.col("words_mass"))).alias("alpha"))
