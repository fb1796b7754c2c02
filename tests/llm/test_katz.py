"""The Katz model against a dictionary version of the same definitions."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import crc, lower, words

from callpay.llm import katz
from callpay.llm.queries import QUERIES
from callpay.llm.shared import table

SF = "/root/testdata/sf0.001"


def reference(rows):
    """(doc, text, train) to doc: (tokens, known, base, score), and the model for one text at a time."""
    toks = {d: [*words(lower(t or "")), None] for d, t, _ in rows}
    train = [toks[d] for d, _, x in rows if x]
    uni = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s>", *t[:-1]], t))
    by = defaultdict(dict)
    for (h, w), c in pairs.items():
        by[h][w] = c
    of = lambda c: [sum(1 for x in c.values() if x == r) for r in range(1, katz.CUTOFF + 2)]
    du, dp = katz.discounts(of(uni)), katz.discounts(of(pairs))
    cut = lambda d, c: d[c] * c if c <= katz.CUTOFF else c
    n = sum(uni.values())
    left = sum(c - cut(du, c) for c in uni.values())
    shared = n if left else n + 1
    one = lambda w: (cut(du, uni[w]) if uni[w] else (left or 1)) / shared if n else 1.0

    def prob(h, w):
        seen = by.get(h)
        if not seen:
            return one(w)
        total = sum(seen.values())
        taken = {x: cut(dp, c) for x, c in seen.items()}
        total += all(taken[x] == seen[x] for x in seen)
        if w in seen:
            return taken[w] / total
        return (1 - sum(taken.values()) / total) / (1 - sum(one(x) for x in seen)) * one(w)

    out = {}
    for d, t in toks.items():
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (len(uni) + 1))) for w in t)
        score = sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *t[:-1]], t))
        out[d] = (len(t), sum(uni[w] > 0 for w in t), base, score)
    return out, prob, one, uni, n


def compare(rows, got):
    want = reference(rows)[0]
    assert len(got) == len(rows)
    for r in got:
        n, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_query_equals_dictionary_version(spark):
    rows = [(r.doc_id, r.text, crc(r.doc_id) % 5 != 1) for r in table(spark, SF, "documents").collect()]
    got = QUERIES["op5_katz_scores"](spark, SF).collect()
    compare(rows, got)
    assert {r.doc_id for r in got if r.held_out} == {d for d, _, x in rows if not x}
    assert {r.train_tokens for r in got} == {reference(rows)[4]}


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 21, 1 << 20), (500, 40, 30), (300, 5, 0)])
def test_buckets_and_split_histories_change_nothing(spark, sizes):
    base = table(spark, SF, "documents").limit(60).collect()
    rows = [(r.doc_id, r.text, r.doc_id % 3 != 0) for r in base]
    rows += [(1000 + i, base[1].text, i % 2 == 0) for i in range(8)] + [(2000, None, True), (2001, "", False), (2002, " \n", True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean").repartition(3)
    bucket, hot, known = sizes
    compare(rows, katz.score_texts(df, bucket, hot, known)[0].collect())


def test_probabilities_add_up():
    rows = [(1, "a b a c a b d", True), (2, "a b b b e", True), (3, "c a", True), (4, "z a", False)]
    _, prob, one, uni, _ = reference(rows)
    everything = [*uni, "unknown"]
    assert sum(one(w) for w in everything) == pytest.approx(1)
    for h in ["<s>", "a", "b", "c", "nothing"]:
        assert sum(prob(h, w) for w in everything) == pytest.approx(1)


def test_no_training_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", False), (1, "a b", False)], "doc_id bigint, text string, train boolean")
    got = katz.score_texts(df)[0].collect()
    assert [(r.n_tokens, r.n_known, r.score) for r in got] == [(3, 0, 0.0)] * 2
    assert katz.score_texts(df.limit(0))[0].count() == 0


def test_discounts_stay_proper():
    assert np.allclose(katz.discounts([100, 40, 20, 10, 6, 4])[0], 1)
    for counts in ([0] * 6, [1, 0, 0, 0, 0, 0], [3, 9, 27, 81, 243, 9], [100, 40, 20, 10, 6, 4]):
        d = katz.discounts(counts)
        assert len(d) == katz.CUTOFF + 1 and all(0 < x <= 1 for x in d[1:]) and d[1] < 1


def test_one_shuffle_serves_both_passes(spark):
    rows = [(r.doc_id, r.text, True) for r in table(spark, SF, "documents").limit(20).collect()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean")
    seen = []
    real = katz.stored

    def spy(frame, name):
        out = real(frame, name)
        if name == "text-parts":
            seen.append(frame)
        return out

    katz.stored = spy
    try:
        katz.score_texts(df)[0].collect()
    finally:
        katz.stored = real
    assert seen[0].collect()
    assert "ReusedExchange" in seen[0]._jdf.queryExecution().executedPlan().toString()
