"""Streams: incremental, exactly once, equal to batch."""

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from callpay.sources import landing
from callpay.sources.contracts import SOURCES
from callpay.streaming import arrivals, settlement

AGENTS = SOURCES["agent_mapping"]
T0 = datetime(2026, 8, 4)


def write(spark, folder, name, rows, schema):
    """One Parquet file under a name of our own, as a delivery would be."""
    tmp = folder.parent / f"tmp-{name}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp))
    folder.mkdir(exist_ok=True)
    shutil.copy(next(tmp.glob("*.parquet")), folder / f"{name}.parquet")


def test_each_file_lands_once(spark, tmp_path):
    schema = "id long, t timestamp_ntz"
    src, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")

    def land():
        stream = arrivals.stream_table(spark, spark.createDataFrame([], schema).schema, str(src))
        return arrivals.land_stream(stream, out, state).count()

    write(spark, src, "a", [(1, T0), (2, T0)], schema)
    assert land() == 2
    assert land() == 2
    write(spark, src, "b", [(3, T0)], schema)
    assert land() == 3


def test_csv_stream_splits_valid_and_rejected(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a file.csv").write_text(",".join(AGENTS.columns) + '\nKenya,u1,,"Jo\n"\nKenya,u2\n')
    stream = arrivals.stream_extract(spark, str(src), AGENTS)
    landed = arrivals.land_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), ["kind"])
    rows = {r.kind: r for r in landed.collect()}
    assert (rows["valid"].team, rows["valid"].atlas_user_name, rows["valid"]._source_file) == ("", "Jo\n", "a file.csv")
    assert rows["rejected"].raw_line == "Kenya,u2"


def test_extract_stream_shares_the_manifest_with_the_batch_load(spark, tmp_path):
    src, root, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")
    folder = src / AGENTS.file_name
    folder.mkdir(parents=True)
    header = ",".join(AGENTS.columns)

    def stream(**more):
        return arrivals.land_extracts(spark, str(src), root, state, ["agent_mapping"], loaded_at=T0, **more)

    (folder / "a.csv").write_text(f'{header}\nKenya,u1,,"Jo\n"\nKenya,u2\n')
    (folder / "b.csv").write_text(f"{header}\nKenya,u3,T,x\n\n")
    assert sorted((r.row_count, r.rejected_count) for r in stream(batch_files=1).collect()) == [(1, 1), (1, 1)]
    assert stream().count() == 2
    batch = landing.load_extracts(spark, str(src), root, only=["agent_mapping"], loaded_at=T0).first()
    assert (batch.skipped, batch.reason) == (True, "unchanged_since_last_run")
    # landed by the batch load first, and a copy of what is there: the stream lands neither again
    (folder / "c.csv").write_text(f"{header}\nKenya,u4,T,x\n")
    assert landing.load_extracts(spark, str(src), root, only=["agent_mapping"], loaded_at=T0).first().rows_loaded == 1
    (folder / "d.csv").write_bytes((folder / "b.csv").read_bytes())
    assert stream().count() == 3
    valid, rejects = landing.read_landed(spark, root, AGENTS)
    assert sorted(r.ameyo_user_id for r in valid.collect()) == ["u1", "u3", "u4"]
    assert sorted((r.raw_line, r.line_number) for r in rejects.collect()) == [("", 3), ("Kenya,u2", 4)]
    # a wrong header stops the micro-batch and is tried again, or is left out
    (folder / "e.csv").write_text("a,b\n1,2\n")
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="header is not"):
            stream()
    assert stream(skip_wrong_headers=True).count() == 3


def test_copies_are_dropped_across_batches(spark, tmp_path):
    schema = "id long, t timestamp_ntz"
    src, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")

    def land():
        stream = arrivals.stream_table(spark, spark.createDataFrame([], schema).schema, str(src))
        return arrivals.land_new(stream, ["id"], out, state)

    write(spark, src, "a", [(1, T0), (1, T0), (2, T0), (None, T0)], schema)
    assert land().count() == 4 - 1
    write(spark, src, "b", [(2, T0), (3, T0 + timedelta(hours=1)), (None, T0)], schema)
    land()
    # an id first seen five days late, and a copy as late
    write(spark, src, "c", [(4, T0 - timedelta(days=5)), (1, T0 - timedelta(days=5))], schema)
    assert sorted(r.id or 0 for r in land().collect()) == [0, 1, 2, 3, 4]
    assert land().count() == 5


def test_attribution_per_batch_equals_batch_result(spark, tmp_path):
    schema = "payment_id long, contract_id long, paid_at_utc timestamp_ntz"
    src, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")
    calls = spark.createDataFrame(
        [(11, 7, T0), (12, 7, T0 + timedelta(hours=2)), (13, 8, T0)],
        "call_log_id long, contract_id long, disposed_at_utc timestamp_ntz",
    )

    def attribute():
        stream = arrivals.stream_table(spark, spark.createDataFrame([], schema).schema, str(src))
        rows = arrivals.attribute_stream(stream, lambda: calls, out, state).collect()
        return {r.payment_id: r.attributed_call_log_id for r in rows}, len(rows)

    write(spark, src, "a", [(1, 7, T0 + timedelta(hours=1)), (2, 9, T0), (3, 8, T0 + timedelta(days=3))], schema)
    assert attribute() == ({1: 11, 2: None, 3: None}, 3)
    write(spark, src, "b", [(4, 7, T0 + timedelta(hours=3)), (5, None, T0), (6, 7, None)], schema)
    assert attribute() == ({1: 11, 2: None, 3: None, 4: 12, 5: None, 6: None}, 6)
    assert attribute()[1] == 6


def test_first_of_a_batch_lands_by_order(spark, tmp_path):
    schema = "id long, t timestamp_ntz, v string"
    src, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")

    def land(to=out):
        stream = arrivals.stream_table(spark, spark.createDataFrame([], schema).schema, str(src))
        return sorted(((r.id or 0, r.v) for r in arrivals.land_new(stream, ["id"], to, state, [F.col("t"), F.col("v")]).collect()))

    write(spark, src, "a", [(1, T0, "b"), (1, T0, "a"), (2, T0 + timedelta(hours=1), "x"), (2, T0, "y"), (None, T0, "n")], schema)
    assert land() == [(0, "n"), (1, "a"), (2, "y")]
    # earlier by its time, but later than what landed
    write(spark, src, "b", [(2, T0 - timedelta(days=9), "z"), (3, T0, "new")], schema)
    assert land() == [(0, "n"), (1, "a"), (2, "y"), (3, "new")]


def test_landed_rows_are_not_read_again(spark, tmp_path):
    """The state alone knows what landed: a batch that writes to another folder still drops copies."""
    schema = "id long, t timestamp_ntz"
    src, state = tmp_path / "src", str(tmp_path / "state")

    def land(to):
        stream = arrivals.stream_table(spark, spark.createDataFrame([], schema).schema, str(src))
        return sorted(r.id for r in arrivals.land_new(stream, ["id"], str(tmp_path / to), state, [F.col("t")]).collect())

    write(spark, src, "a", [(i, T0) for i in range(50)], schema)
    assert land("out") == list(range(50))
    write(spark, src, "b", [(i, T0) for i in range(40, 60)], schema)
    assert land("elsewhere") == list(range(50, 60))


def test_late_calls_settle_payments(spark, tmp_path):
    """Calls land after their payments, on one hot contract and on others; nothing is decided before it can be."""
    import random

    rng = random.Random(2)
    pay_schema = "payment_id long, contract_id long, paid_at_utc timestamp_ntz"
    call_schema = "call_log_id long, contract_id long, disposed_at_utc timestamp_ntz"

    def moment(day):
        return T0 + timedelta(days=day, hours=rng.randrange(24), microseconds=rng.choice([0, 0, 1]))

    def contract():
        return 7 if rng.random() < 0.4 else rng.choice([None, 8, 9, 10])

    days = [([(1000 * d + i, contract(), moment(d)) for i in range(30)], [(5000 + 1000 * d + i, contract(), moment(d)) for i in range(30)]) for d in range(3)]
    days[0][0].append((99, 7, None))
    waiting, sizes = [], []

    def settle():
        streams = [
            arrivals.stream_table(spark, spark.createDataFrame([], s).schema, str(tmp_path / n))
            for n, s in (("payments", pay_schema), ("calls", call_schema))
        ]
        return settlement.settle_stream(*streams, str(tmp_path / "out"), str(tmp_path / "state"), late_days=2, spread=2)

    for d, (payments, calls) in enumerate(days):
        write(spark, tmp_path / "payments", f"p{d}", payments, pay_schema)
        write(spark, tmp_path / "calls", f"c{d}", [c for c in calls if c[0] % 3] + waiting, call_schema)
        waiting = [c for c in calls if c[0] % 3 == 0]
        sizes.append(settle().count())
    assert sizes[0] == 1  # only the payment without a time, the rest may still get a call
    write(spark, tmp_path / "payments", "close-p", [(None, None, T0 + timedelta(days=900))], pay_schema)
    write(spark, tmp_path / "calls", "close-c", [*waiting, (None, -1, T0 + timedelta(days=900))], call_schema)
    settle()
    got = settle().collect()
    every = [c for _, calls in days for c in calls]
    want = {}
    for payments, _ in days:
        for pid, k, at in payments:
            near = [(c[2], c[0]) for c in every if k is not None and at and c[1] == k and at - timedelta(days=3) < c[2] <= at]
            want[pid] = max(near)[1] if near else None
    assert len(got) == len(want) and {r.payment_id: r.attributed_call_log_id for r in got} == want
