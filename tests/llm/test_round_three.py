"""Conversation repair, whitening and top-k search against plain restatements."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from callpay.llm import dialogue, innerproduct, whitening
from callpay.llm.queries import QUERIES
from callpay.llm.shared import table

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"
VECTORS = "vec_id bigint, embedding array<float>"
BLANK = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def fits(state, initial):
    return initial == NEXT[state] or (state == "" and initial == "s")


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = ":".join(" " if v is None else str(v) for v in (conv, turn))
        d = zlib.crc32(place.encode()) % 20
        if d == 1:
            text = ""
        if d == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if d == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(d, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(BLANK)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit, lines) by keeping, for every state, the whole best audit."""
    best = {"": (0, "", ())}

    def widen(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                new = (cost + 5, audit + "I", (*lines, NAMES[NEXT[state]] + ":"))
                states[NEXT[state]] = min(states.get(NEXT[state], new), new)
        return states

    for (_, role, text), fault in zip(rows, found, strict=True):
        new = {}

        def offer(state, way, new=new):
            new[state] = min(new.get(state, way), way)

        for state, (cost, audit, lines) in widen(dict(best)).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if fits(state, role[:1]):
                offer(role[0], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            to = NEXT[state]
            offer(to, (cost + more + 1, audit + "R", (*lines, f"{NAMES[to]}:{text}")))
        best = new
    final = widen(dict(best))
    return min(final[s] for s in ("", "a") if s in final)


def report(original, spoiled):
    out = {}
    for conv in {r[0] for r in original}:
        rows = sorted((r[1:] for r in spoiled if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        found, turns = faults(rows), {r[0] for r in rows} - {None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
        cost, audit, lines = cheapest(rows, found)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_repair_of_the_table_equals_plain(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").collect()]
    assert got(QUERIES["op11_hirschberg_repair"](spark, SF)) == report(rows, spoil(rows))


def test_plain_restatement_is_least_of_all_audits():
    """Every audit with at most two inserts in a row, tried out."""
    rng = random.Random(5)
    for _ in range(40):
        rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b.", "c", ""])) for i in range(rng.randint(0, 3))]
        found, ways = faults(rows), []
        for edits in itertools.product("KRD", repeat=len(rows)):
            for inserts in itertools.product(range(3), repeat=len(rows) + 1):
                audit = "".join("I" * n + e for n, e in zip(inserts, (*edits, ""), strict=True))
                state, cost, at, ok = "", 0, 0, True
                for e in audit:
                    if e == "I":
                        state, cost = NEXT[state], cost + 5
                        continue
                    role, fault, at = rows[at][1], found[at], at + 1
                    ok = ok and (e == "D" or fault not in ("blank", "duplicate"))
                    cost += {"K": 0, "R": 1, "D": 2}[e] + 5 * (fault == "truncated" and e != "D")
                    if e == "K":
                        ok = ok and fits(state, role[0])
                        state = role[0]
                    if e == "R":
                        state = NEXT[state]
                    if not ok:
                        break
                if ok and state in ("", "a"):
                    ways.append((cost, audit))
        assert cheapest(rows, found)[:2] == min(ways)


def test_crossings_need_no_tree():
    """Blocks put together in a tree give what one run gives."""
    rng = random.Random(3)
    for n in (1, 2, 5, 40):
        steps = [dialogue._ROW_TABLES[rng.randrange(12)] for _ in range(n)]
        whole = dialogue.whole_table(steps)
        assert whole == dialogue.whole_table([dialogue.whole_table(steps[: n // 2]), dialogue.whole_table(steps[n // 2 :])])
        leave = min(range(4), key=lambda s: (whole[0][s], whole[1][s]))
        states = dialogue.crossings(steps, 0, leave)
        assert sum(t[0][4 * a + b] for t, a, b in zip(steps, states, states[1:], strict=False)) == whole[0][leave]


ODD = [
    (1, None, None, None), (1, None, "user", "x."), (1, 0, "user", ""), (1, 3, "assistant", "y" * 300_000 + "?"),
    (2, 0, "system", "s."), (2, 0, "system", "s."), (2, 0, "user", "u"), (2, 1, "assistant", " \t"), (2, 9, "", "z!"),
    (None, 0, "user", "é."), (None, 1, "assistant", "ü!"), (None, None, "tool", "t."),
    (4, -(1 << 62), "user", "a."), (4, 1 << 62, "assistant", "b.\n"), (5, None, None, None),
]


def test_repair_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, TURNS)
    want = report(ODD, spoil(ODD))
    clashing = df.withColumns({c: F.lit("x") for c in ("key", "part", "idx", "edit", "rows", "audit", "__d", "__copy")})
    for turns in (df, clashing.repartition(7)):
        assert got(dialogue.conversation_report(turns, dialogue.damage(turns))) == want
    none = df.limit(0)
    assert dialogue.conversation_report(none, dialogue.damage(none)).count() == 0
    assert got(dialogue.conversation_report(df, none))[4] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_one_very_long_conversation(spark):
    rng = random.Random(9)
    rows = [(7, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["hello.", "and", f"n{i}.", f"m{i}", ""])) for i in range(18_000)]
    rows += [(8, 0, "user", "q."), (8, 1, "assistant", "r.")]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    blocks, audits = dialogue.repair(df)
    assert audits.where("key = '=7'").first().n_blocks > dialogue.FAN
    assert got(dialogue.conversation_report(df, df)) == report(rows, rows)
    edits = dialogue.edited_rows(blocks).where("key = '=8'").orderBy("part", "idx", "at").collect()
    assert [(e.edit, e.turn, e.role, e.text) for e in edits] == [("K", 0, "user", "q."), ("K", 1, "assistant", "r.")]


def vectors(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


def plain_whitening(rows):
    x = np.floor(1024 * np.array([r[1] for r in rows], np.float32).astype(np.float64)).astype(np.int64).astype(object) + 100000
    n, s = len(x), x.sum(axis=0)
    centred = (x - s / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, [int(((n * r - s) ** 2).sum()) for r in x], centred, values[::-1], axes[:, ::-1]


def check_whitening(found, rows, top):
    n, deviation, centred, values, axes = plain_whitening(rows)
    at = {r[0]: i for i, r in enumerate(rows)}
    assert len(found) == len(rows) * top
    signs = {}
    for r in found:
        want = float(centred[at[r.vec_id]] @ axes[:, r.component - 1] / np.sqrt(values[r.component - 1]))
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - want) < abs(r.whitened + want) else -1)
        assert r.whitened == pytest.approx(sign * want, abs=1e-8)
        assert (r.n, r.deviation) == (n, deviation[at[r.vec_id]])
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_whitening_of_the_table_equals_plain(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    check_whitening(QUERIES["op12_bitsliced_whitening"](spark, SF).collect(), rows, 8)


def whitened(df):
    return whitening.component_rows(*whitening.whiten(df)).collect()


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(v) for v in rng.normal(0, 10.0 ** (i % 5), 3)]) for i in range(70)]
    good += [(70, [-500.0, 4000.0, 0.0])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [float("inf"), 0.0, 0.0]), (94, []), (95, [1.0])]
    df = vectors(spark, good + bad).withColumns({c: F.lit("x") for c in ("vector", "n", "component", "whitened")})
    check_whitening(whitened(df), good, 3)
    assert whitened(vectors(spark, bad[:4])) == []
    assert whitened(vectors(spark, [])) == []
    one = whitened(vectors(spark, [(None, [1.0, 2.0])]))
    assert [(r.vec_id, r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (None, c, 0, None, None, 0.0) for c in (1, 2)
    ]
    flat = whitened(vectors(spark, [(i, [float(i), 5.0]) for i in range(4)] * 2))
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)} and len(flat) == 16
    huge = whitened(vectors(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0])]))
    assert len(huge) == 4 and all(r.deviation is None for r in huge)


def test_bit_sliced_scatter_is_exact():
    rng = np.random.default_rng(1)
    for rows, width, most in ((1, 1, 1), (63, 3, 5), (64, 4, 1 << 12), (65, 5, 1 << 40), (200, 2, 1 << 50)):
        x = rng.integers(-most, most + 1, (rows, width))
        sums, cross = whitening.scatter(x)
        big = x.astype(object)
        assert sums == [int(v) for v in big.sum(axis=0)]
        assert cross == [int(big[:, i] @ big[:, j]) for i in range(width) for j in range(i, width)]


def plain_search(rows, k, every):
    kept = {(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for q, x in kept:
        if q is None or q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y, strict=True)), i is None, i or 0) for i, y in kept if i != q]
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_search_of_the_table_equals_plain(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert found(QUERIES["op13_norm_sorted_top_k"](spark, SF)) == plain_search(rows, 5, 50)


def test_search_of_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in np.round(rng.normal(0, 1 + (i % 7) ** 2, 4), 1)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]  # ties
    rows += rows[10:20] * 3  # repeated rows
    rows += [(50, [9.0, 9.0, 9.0, 9.0]), (None, rows[0][1]), (None, [50.0] * 4)]  # an id with two vectors, no id
    bad = [(600, None), (650, [1.0, None, 2.0, 0.0]), (700, [float("nan")] * 4), (750, [float("inf"), 0.0, 0.0, 0.0])]
    df = vectors(spark, rows + bad).withColumns({c: F.lit("x") for c in ("x", "square", "place", "bound", "score")})
    want = plain_search(rows, 5, 50)
    assert found(innerproduct.search(df, F.col("vec_id") % 50 == 0)) == want
    for name, value in (("QUERIES", 3), ("LONGEST", 2), ("LONGEST", 30), ("BATCH", 16)):
        monkeypatch.setattr(innerproduct, name, value)
        assert found(innerproduct.search(df, F.col("vec_id") % 50 == 0)) == want
    few = rows[:3]
    assert found(innerproduct.search(vectors(spark, few), F.col("vec_id") % 1 == 0)) == plain_search(few, 5, 1)
    assert found(innerproduct.search(vectors(spark, bad), F.col("vec_id") % 50 == 0)) == []
    assert found(innerproduct.search(vectors(spark, []), F.col("vec_id") % 50 == 0)) == []


def test_scan_passes_over_what_cannot_reach_the_bound():
    """Bounds spare exact scores: short candidates are not multiplied at all."""
    rng = np.random.default_rng(2)
    x = (rng.normal(0, 1, (4000, 8)) * np.linspace(100, 1, 4000)[:, None]).astype(np.int64)
    x = x[np.argsort(-np.einsum("ij,ij->i", x, x), kind="stable")]
    import pyarrow as pa

    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(range(i, i + 500)), innerproduct._lists(x[i : i + 500].astype(np.int32)), pa.array(np.einsum("ij,ij->i", x[i : i + 500], x[i : i + 500]))],
            ["vec_id", "x", "square"],
        )
        for i in range(0, 4000, 500)
    ]
    queries = innerproduct.Block(np.arange(3), np.arange(3), x[:3].astype(np.int32), np.full(3, innerproduct.LEAST))
    pairs = []
    plain = innerproduct._pair_products, innerproduct._products
    try:
        innerproduct._pair_products = lambda q, y: pairs.append(len(q)) or plain[0](q, y)
        innerproduct._products = lambda q, y: pairs.append(len(q) * len(y)) or plain[1](q, y)
        rows = list(innerproduct._scan(iter(batches), queries, np.eye(8)[:, :3], 5))[0].to_pylist()
    finally:
        innerproduct._pair_products, innerproduct._products = plain
    assert sum(pairs) < 3 * 4000 / 4
    for q in range(3):
        want = sorted((-int(x[q] @ x[j]), j) for j in range(4000) if j != q)[:5]
        assert sorted((-r["score"], r["vec_id"]) for r in rows if r["place"] == q) == want
