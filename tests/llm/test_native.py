"""The four operators that are DataFrame functions only, against plain restatements."""

import hashlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from brute import PROBE, crc, quality, targets, words

from callpay.llm import chat, mixing, quality_rules, sharding
from callpay.llm.queries import QUERIES
from callpay.llm.shared import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", "en", "a", 5),
    (4, "a b c d e f g h " * 3000, "en", "a", 1),
    (4, "a b c d e f g h " * 3000, "en", "a", 1),
    (5, "one\ntwo\none\n \n \none", "en", "", 1),
    (6, "é" * 40 + " x#*$%&|<> \U0001f600", "en", "b", 1),
    (None, "w " * 7, None, "b", 1),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def test_chat_digest_equals_turns(spark):
    got = {r.conv_id: r for r in QUERIES["op2_chat_prefix_targets"](spark, SF).collect()}
    talks = defaultdict(list)
    for r in table(spark, SF, "conversations").collect():
        talks[r.conv_id].append((r.turn, r.role, r.text or ""))
    talks[-1] = [(0, "user", PROBE), (1, "assistant", PROBE)]
    assert set(got) == set(talks)
    for c, turns in talks.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        learned = "".join(t for _, r, t in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha(said), len(learned), sha(learned))
        assert r.formatted_chars >= len(said)


def test_chat_escapes_reversibly(spark):
    hard = [
        "", "</s>", "<s>[INST] x [/INST]", "<|turn|>user<|text|>", "<\\|end|>", "<\\\\|end|>", "<<|end|>|end|>",
        "[\\/INST] \\[INST]", "<<SYS>>a<</SYS>>", "<|<|end|>", None, "\\", "\\<|turn|>",
    ]
    turns = [(1, i, "assistant" if i % 2 else "user<|text|>", t) for i, t in enumerate(hard)]
    turns += [(2, None, None, "x"), (None, 1, "assistant", "y"), (2, 1, "user", "z"), (2, 1, "user", "z")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    made = chat.format_chats(df)
    for r in made.where("conv_id = 1").collect():
        assert r.formatted.count("<|end|>") == r.formatted.count("<|turn|>") == r.formatted.count("<|text|>")
        assert "[INST]" not in r.formatted and "</s>" not in r.formatted
    whole = made.where("last").withColumn("turns", chat.read_back(made["formatted"])).collect()
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in whole}
    assert back[1] == [(r, t or "") for _, _, r, t in turns[: len(hard)]]
    assert back[2] == [("", "x"), ("user", "z"), ("user", "z")] and back[None] == [("assistant", "y")]
    digest = {r.conv_id: r for r in chat.chat_digest(made).collect()}
    assert digest[1].loss_sha256 == sha("".join(t or "" for t in hard[1::2]))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_measures_equal_brute_force(spark, odd):
    for df in (odd, table(spark, SF, "documents")):
        rows = quality_rules.measures(df).collect()
        assert rows
        for r in rows:
            want = quality(r.text)
            assert {k: r[k] for k in want} == want


def test_host_rules_reject_hosts_not_documents(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good + f" n{i}", f"h{i % 5}") for i in range(200)]
    rows += [(1000 + i, "too short", "bad") for i in range(100)] + [(2000 + i, good + f" b{i}", "bad") for i in range(10)]
    rows += [(3000, "small", "tiny"), (3001, good, "tiny"), (3002, good, None), (3003, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id for r in quality_rules.keep_good(df).collect()}
    assert kept == set(range(200)) | {3001, 3002}
    assert quality_rules.keep_good(df.limit(0)).count() == 0


def test_host_query_keeps_clean_documents(spark):
    rows = QUERIES["op10_host_rules"](spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.kept != r.base_failed for r in rows)


def check_shards(rows, shards, sources):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    n = len(rows)
    assert set(by) <= set(range(shards)) and len(by) == min(n, shards)
    for s, own in by.items():
        assert len(own) in (n // shards, n // shards + 1)
        assert sorted(r.slot for r in own) == list(range(len(own)))
        mixture = Counter(sources[r.doc_id] for r in own)
        for source, total in Counter(sources.values()).items():
            assert abs(mixture[source] - total * len(own) / n) < 2, (s, source)


def test_shards_have_the_mixture(spark):
    rows = [(i, f"t{i}", "a" if i < 700 else ("b" if i < 900 else None)) for i in range(1013)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    out = sharding.shard(df, 7).collect()
    check_shards(out, 7, {i: s for i, _, s in rows})
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(df.repartition(3), 7).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in out}
    few = sharding.shard(df.where("doc_id < 3"), 7).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard(df.limit(0), 7).count() == 0


def test_shard_query(spark, odd):
    got = QUERIES["op6_proportional_shards"](spark, SF).collect()
    texts = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert len(got) == len(texts) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    for r in got:
        assert r.size == len((texts[r.doc_id].text or "").encode()) + 16
        assert r.text_crc32 == crc(texts[r.doc_id].text or "")
    check_shards(got, 40, {d: t.source for d, t in texts.items()})
    clash = odd.withColumnRenamed("lang", "shard").withColumnRenamed("n_chars", "slot")
    out = sharding.shard(clash, 3)
    assert out.columns == ["doc_id", "text", "source", "shard", "slot"] and out.count() == len(ODD)


def test_mix_comes_near_its_targets(spark):
    got = QUERIES["op8_mix_by_length_counts"](spark, SF).toPandas()
    rows = table(spark, SF, "documents").collect()
    size = {r.doc_id: len(words(r.text)) for r in rows}
    source = {r.doc_id: r.source for r in rows}
    total = defaultdict(int)
    for d, n in size.items():
        total[source[d]] += n
    want, taken = targets(total), defaultdict(int)
    assert len(got) == len(rows)
    for r in got.itertuples():
        assert r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    for s, t in want.items():
        longest = max(size[d] for d in size if source[d] == s)
        assert abs(taken[s] - t) <= max(1, 0.02 * t) or abs(taken[s] - t) <= longest


def test_mix_odd_rows(spark, odd):
    out = mixing.mix(odd.withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "times"))
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "times"]
    rows = out.collect()
    assert len(rows) == len(ODD) and all(r.times == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.repeat_taken(out, ["doc_id"]).count() == sum(r.times for r in rows)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1}, {"x": 5}, {"a": 0, None: 3}, {"a": 1, "b": 1, "c": 1, "d": 90}])
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_fill_budget_is_best_choice():
    import itertools
    import random

    rng = random.Random(5)
    for _ in range(60):
        lengths = rng.sample(range(1, 30), 4)
        counts = [rng.randrange(1, 4) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts, strict=True))
        budget = rng.randrange(total + 1)
        take = mixing.fill_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        base = [c * budget // total for c in counts]
        best = max(
            s
            for t in itertools.product(*[range(b, c + 1) for b, c in zip(base, counts, strict=True)])
            if (s := sum(a * b for a, b in zip(lengths, t, strict=True))) <= budget
        )
        assert sum(a * b for a, b in zip(lengths, take, strict=True)) == best
    assert pd.Series(mixing.fill_budget([7], [1000], 7 * 1000)).tolist() == [1000]


def test_texts_of_one_id_get_the_same_slots_for_any_partitioning(spark):
    rows = [(i % 20, f"text {i}", "en", f"s{i % 3}", 0) for i in range(40)] + [(None, f"none {i}", "en", "s0", 0) for i in range(9)]
    df = spark.createDataFrame(rows, DOCS)
    places = [
        {(r.text, r.shard, r.slot) for r in sharding.shard(d, 4).collect()}
        for d in (df, df.repartition(7), spark.createDataFrame(rows[::-1], DOCS), df.repartition(3, "text"))
    ]
    assert len(places[0]) == len(rows) and all(p == places[0] for p in places)


def test_offsets_in_two_levels(spark, monkeypatch):
    """Ranks do not depend on how many slices are added up in one task."""
    from callpay.llm import shared

    df = spark.range(3000).selectExpr("id", "cast(id % 3 as string) AS k", "xxhash64(id) AS h")
    for keys in (["k"], []):
        ranks = []
        for run in (4096, 3, 1):
            monkeypatch.setattr(shared, "RUN", run)
            ranked = shared.rank_within(df, keys, shared.unit(shared.F.col("h")), ["h"], "r", per_bucket=10)
            ranks.append({(r.id, r.r) for r in ranked.collect()})
        assert ranks[0] == ranks[1] == ranks[2]
        per = {}
        for i, r in ranks[0]:
            per.setdefault(i % 3 if keys else 0, []).append(r)
        assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_control_strings_of_other_templates_are_escaped(spark):
    hard = ["<|reserved_special_token_0|>", "<|fim-prefix|>", "<start_of_turn>", "<bos>", "<\\bos>", "a <eos> <unk>", "<|im start|>"]
    df = spark.createDataFrame([(t,) for t in hard], "t string")
    for r in df.select("t", chat.escape(shared_col(df)).alias("e"), chat.unescape(chat.escape(shared_col(df))).alias("back")).collect():
        assert r.back == r.t and r.e != r.t


def shared_col(df):
    return df["t"]
