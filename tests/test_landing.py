"""Extracts: header, quoting, rejects, hashes, plan, repeat runs."""

import hashlib
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callpay.sources import extracts, landing
from callpay.sources.contracts import SOURCES

AT = datetime(2026, 8, 7, 6, 5)
CALLS, AGENTS, PAYMENTS = SOURCES["ameyo_calls"], SOURCES["agent_mapping"], SOURCES["payments"]
HEADER = ",".join(CALLS.columns)
GOOD = '"1","2026-08-05 06:57:26.609","1","CONNECTED","outbound","96250","u1","c1","71667828"'


def deliver(folder, contract, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / contract.file_name).write_bytes(text.encode(encoding))
    return str(folder)


def run(spark, tmp_path, text, contract=CALLS, at=AT, encoding="utf-8"):
    folder = deliver(tmp_path / "in", contract, text, encoding)
    root = str(tmp_path / "raw")
    summary = landing.load_extracts(spark, folder, root, only=[contract.name], loaded_at=at).collect()
    valid, rejects = landing.read_landed(spark, root, contract)
    return summary[0], valid.collect(), rejects.collect()


def test_good_and_too_long_row(spark, tmp_path):
    summary, valid, rejects = run(spark, tmp_path, f"{HEADER}\n{GOOD}\na,b,c,d,e,f,g,h,i,j,k\n")
    assert (summary.skipped, summary.rows_loaded, summary.rejected, summary.reason) == (False, 1, 1, None)
    assert valid[0].total_talk_time == "96250" and valid[0].udh_notes == "71667828"
    assert valid[0]._source_file == CALLS.file_name and valid[0]._ingested_at == AT
    assert rejects[0].reason == "expected 9 fields, got 11"
    assert rejects[0].raw_line == "a,b,c,d,e,f,g,h,i,j,k"


def test_empty_cells_stay_empty_text(spark, tmp_path):
    _, valid, _ = run(spark, tmp_path, f"{HEADER}\n1,2026-08-05 06:57:26.609,1,,outbound,,u1,c1,\n")
    assert (valid[0].ch_system_disposition, valid[0].total_talk_time, valid[0].udh_notes) == ("", "", "")


def test_repeated_keys_both_land(spark, tmp_path):
    summary, valid, _ = run(spark, tmp_path, f"{HEADER}\n{GOOD}\n{GOOD}\n")
    assert summary.rows_loaded == 2 and [v.ch_call_id for v in valid] == ["1", "1"]


@pytest.mark.parametrize("multiline", [False, True])
def test_short_blank_and_quoted_rows(spark, tmp_path, multiline):
    """Quoted commas and doubled quotes are content; a quoted newline switches to whole-file reading."""
    tail = '5,t,1,s,o,1,u,c,"line one\nline two"\n' if multiline else ""
    text = f'﻿{HEADER}\r\n1,t,1,"a, b",o,1,u,c,"he said ""hi"""\r\n2,short\r\n{tail}'
    if not multiline:
        text += "\n   \n"
    summary, valid, rejects = run(spark, tmp_path, text)
    notes = {v.ch_call_id: (v.ch_system_disposition, v.udh_notes) for v in valid}
    assert notes["1"] == ("a, b", 'he said "hi"')
    reasons = sorted(r.reason for r in rejects)
    if multiline:
        assert notes["5"][1] == "line one\nline two"
        assert reasons == ["expected 9 fields, got 2"]
    else:
        assert reasons == ["expected 9 fields, got 0", "expected 9 fields, got 1", "expected 9 fields, got 2"]
    assert summary.rejected == len(rejects)


def test_lone_quote_line_belongs_to_the_last_field(spark, tmp_path):
    text = ",".join(AGENTS.columns) + '\nKenya,u1,Upsell,"Jo\n"\nKenya,u2,Upsell,Ann\n'
    _, valid, rejects = run(spark, tmp_path, text, AGENTS)
    assert sorted((v.ameyo_user_id, v.atlas_user_name) for v in valid) == [("u1", "Jo\n"), ("u2", "Ann")]
    assert not rejects


@pytest.mark.parametrize("header", ["a,b,c", HEADER.upper(), ",".join(reversed(CALLS.columns)), HEADER + ",more"])
def test_wrong_header_is_refused(spark, tmp_path, header):
    with pytest.raises(ValueError, match="header is not"):
        run(spark, tmp_path, f"{header}\n{GOOD}\n")


def test_file_with_only_a_header_loads_nothing(spark, tmp_path):
    summary, valid, rejects = run(spark, tmp_path, f"{HEADER}\n")
    assert (summary.skipped, summary.rows_loaded, summary.rejected) == (False, 0, 0)
    assert not valid and not rejects


def test_empty_file_is_never_loaded(spark, tmp_path):
    try:
        summary, valid, _ = run(spark, tmp_path, "")
    except ValueError as refused:
        assert "header is not" in str(refused)
    else:
        assert summary.reason == "file_not_found" and not valid


def test_header_may_have_spaces_and_quotes(spark, tmp_path):
    header = ",".join(f' "{c}" ' for c in CALLS.columns)
    summary, valid, _ = run(spark, tmp_path, f"{header}\n{GOOD}\n")
    assert summary.rows_loaded == 1 and valid[0].ch_call_id == "1"


def test_payment_key_is_stable_and_plain_sha256(spark, tmp_path):
    cells = ["2026-08-05 06:57:26.609", "1001", "7", "MPESA", "", "5890.0"]
    _, valid, _ = run(spark, tmp_path, ",".join(PAYMENTS.columns) + "\n" + ",".join(cells) + "\n", PAYMENTS)
    assert valid[0]._payment_row_key == hashlib.sha256("|".join(cells).encode()).hexdigest()


def test_unchanged_missing_and_changed_files(spark, tmp_path):
    folder = deliver(tmp_path / "in", CALLS, f"{HEADER}\n{GOOD}\n")
    root = str(tmp_path / "raw")

    def load(day):
        rows = landing.load_extracts(spark, folder, root, only=["ameyo_calls", "payments"], loaded_at=AT.replace(day=day))
        return {r.source_name: (r.skipped, r.reason, r.rows_loaded) for r in rows.collect()}

    assert load(7) == {"ameyo_calls": (False, None, 1), "payments": (True, "file_not_found", 0)}
    assert load(8)["ameyo_calls"] == (True, "unchanged_since_last_run", 0)
    deliver(tmp_path / "in", CALLS, f"{HEADER}\n{GOOD}\n{GOOD}\n")
    assert load(9)["ameyo_calls"] == (False, None, 2)
    assert landing.read_raw(spark, root, CALLS).count() == 3
    manifest = landing.read_manifest(spark, root).orderBy("loaded_at").collect()
    assert [(m.source_name, m.file_name, m.row_count, m.rejected_count) for m in manifest] == [
        ("ameyo_calls", CALLS.file_name, 1, 0), ("ameyo_calls", CALLS.file_name, 2, 0),
    ]


def test_landing_twice_after_a_lost_manifest_adds_nothing(spark, tmp_path):
    """The crash between landing and recording, repeated on the next day: rows are there once."""
    folder = deliver(tmp_path / "in", CALLS, f"{HEADER}\n{GOOD}\n")
    root = str(tmp_path / "raw")
    files = extracts.find_files(spark, folder, [CALLS.file_name])
    rows = files.join(extracts.file_hashes(spark, [r.path for r in files.collect()]), "uri").collect()
    landing.land(spark, CALLS, rows, root, AT, "lost")
    assert landing.read_raw(spark, root, CALLS).count() == 0
    after_midnight = AT.replace(day=8)
    summary = landing.load_extracts(spark, folder, root, only=["ameyo_calls"], loaded_at=after_midnight).first()
    assert (summary.skipped, summary.rows_loaded) == (False, 1)
    assert landing.read_raw(spark, root, CALLS).count() == 1
    again = landing.load_extracts(spark, folder, root, only=["ameyo_calls"], loaded_at=after_midnight).first()
    assert (again.skipped, again.rows_loaded) == (True, 0)


def test_a_delivery_may_be_a_folder_of_parts(spark, tmp_path):
    folder = tmp_path / "in" / CALLS.file_name
    folder.mkdir(parents=True)
    for i in range(3):
        (folder / f"part-{i}.csv").write_text(f"{HEADER}\n{GOOD}\n{i},t,1,s,o,1,u,c,n\n")
    root = str(tmp_path / "raw")
    summary = landing.load_extracts(spark, str(tmp_path / "in"), root, only=["ameyo_calls"], loaded_at=AT).first()
    assert summary.rows_loaded == 6
    assert landing.read_manifest(spark, root).count() == 3


def hashes_of(spark, *paths):
    return {r.uri.rsplit("/", 1)[1]: r.file_hash for r in extracts.file_hashes(spark, [str(p) for p in paths]).collect()}


def test_file_hashes_tell_order_and_line_ends_and_not_splits(spark, tmp_path):
    names = ["a", "b", "swapped", "same", "crlf", "empty", "moved"]
    paths = {n: tmp_path / f"{n}.csv" for n in names}
    rows = [f"{i},{i * 7 % 13}" for i in range(5000)]
    swapped = [*rows[:4000], rows[4001], rows[4000], *rows[4002:]]
    texts = {"a": rows, "b": rows[:-1], "swapped": swapped, "same": rows, "moved": [*rows[1:], rows[0]]}
    for n, lines in texts.items():
        paths[n].write_bytes(("\n".join(lines) + "\n").encode())
    paths["crlf"].write_bytes(("\r\n".join(rows) + "\r\n").encode())
    paths["empty"].write_bytes(b"")
    whole = hashes_of(spark, *paths.values())
    assert whole["a.csv"] == whole["same.csv"]
    assert set(whole) == {f"{n}.csv" for n in names if n != "empty"}
    assert len(set(whole.values())) == len(whole) - 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        assert spark.read.text(str(paths["a"])).rdd.getNumPartitions() > 3
        assert hashes_of(spark, *paths.values()) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_lines_are_rejected_whatever_else_a_file_holds(spark, tmp_path):
    plain = f"{HEADER}\n{GOOD}\n\n{GOOD}\n\n"
    quoted = plain + '5,t,1,s,o,1,u,c,"line one\n\nline two"\n'
    for name, text, valid in (("plain", plain, 2), ("quoted", quoted, 3)):
        summary, rows, rejects = run(spark, tmp_path / name, text)
        assert (summary.rows_loaded, summary.rejected) == (valid, 2), name
        assert [r.reason for r in rejects] == ["expected 9 fields, got 0"] * 2


def test_large_files_are_read_in_splits_with_one_result(spark, tmp_path):
    """Many splits: fingerprint, header check and rows do not depend on split size."""
    lines = "".join(f"{i},t,1,s,o,1,u,c,note {i}\n" for i in range(20_000))
    path = tmp_path / "big.csv"
    path.write_text(f"{HEADER}\n{lines}")
    whole = extracts.profile_lines(spark, [str(path)], CALLS.columns).first()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        pieces = extracts.profile_lines(spark, [str(path)], CALLS.columns)
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
        assert pieces.first() == whole
        records = extracts.read_extract(spark, [str(path)], CALLS, multiline=False)
        assert records.rdd.getNumPartitions() > 5
        assert records.where("_corrupt IS NULL").select("ch_call_id", "_corrupt").distinct().count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert whole.header_ok and not whole.broken_lines


def test_very_long_lines_do_not_break_the_line_pattern(spark, tmp_path):
    long = '"' + 'x""y' * 100_000 + '"'
    _, valid, _ = run(spark, tmp_path, f"{HEADER}\n1,t,1,s,o,1,u,c,{long}\n")
    assert valid[0].udh_notes == 'x"y' * 100_000


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def quoted_file(path, seed, n=600):
    """Records with newlines, commas and doubled quotes inside quotes, blank lines, rows that are too long or short."""
    rng = random.Random(seed)
    lines = [",".join(AGENTS.columns)]
    for i in range(n):
        lines.append(rng.choice([
            f"Kenya,u{i},T,plain", f'Kenya,u{i},T,"two\nlines"', f'Kenya,u{i},"a, b","said ""x""\n\n""y"","', f"Kenya,u{i}", "",
            f'"Kenya\n",u{i},"\n\n\n",""', f"Kenya,u{i},T,x,more", f'Kenya,u{i},"long\nrow",x,"\n"', f"Kenya,u{i},,",
        ]))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def parts_of(df):
    cells = [*AGENTS.columns, "raw_line", "reason", "kind"]
    return sorted(tuple("" if r[c] is None else r[c] for c in cells) for r in extracts.classify(df, AGENTS).select(*cells).collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quoted_newlines_in_splits_equal_the_one_task_read(spark, tmp_path, small_splits, seed):
    path = quoted_file(tmp_path / "a.csv", seed)
    records = extracts.quoted_records(spark, [path])
    assert spark.read.text(path).rdd.getNumPartitions() > 3
    assert extracts.stray_quotes(records).count() == 0
    got = parts_of(extracts.read_records(records, AGENTS))
    whole = parts_of(extracts.read_extract(spark, [path], AGENTS, multiline=True))
    blank = extracts.blank_line_rejects(spark, [path], AGENTS, multiline=True).collect()
    assert [g for g in got if g[len(AGENTS.columns)] or g[-1] == "valid"] == whole
    assert sum(g[-1] == "rejected" and not g[len(AGENTS.columns)] for g in got) == len(blank)


def test_lines_of_a_file_are_neither_sorted_nor_shuffled_by_it(spark, tmp_path, small_splits):
    """A task holds a batch of its split: lines go to no task by file or block, only parts of records do, by record."""
    path = quoted_file(tmp_path / "a.csv", 4)
    plan = extracts.quoted_records(spark, [path])._jdf.queryExecution().executedPlan().toString()
    for shuffle in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan):
        assert "_record" in shuffle or "value" not in shuffle
    assert not re.search(r"Sort \[uri#\d+ ASC NULLS FIRST, block#\d+L ASC NULLS FIRST, seq", plan)
    assert plan.count("BroadcastHashJoin") == 2


def test_one_file_is_landed_by_many_tasks(spark, tmp_path, small_splits):
    """Rows of a plain and of a quoted file keep the tasks that read them; before, one task sorted and wrote each file."""
    plain = ",".join(AGENTS.columns) + "\n" + "".join(f"Kenya,u{i},T,x\nshort{i}\n" for i in range(2000))
    (tmp_path / "quoted").mkdir()
    quoted = open(quoted_file(tmp_path / "quoted" / "a.csv", 5, 3000)).read()
    old = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    for name, text in (("plain", plain), ("quoted", quoted)):
        deliver(tmp_path / name / "in", AGENTS, text)
        root = str(tmp_path / name / "raw")
        summary = landing.load_extracts(spark, str(tmp_path / name / "in"), root, only=["agent_mapping"], loaded_at=AT).first()
        landed = spark.read.parquet(f"{root}/agent_mapping").withColumn("part", F.input_file_name())
        files = landed.groupBy("kind").agg(F.countDistinct("part").alias("files"), F.count("*").alias("n")).collect()
        found = {r.kind: r.files for r in files}
        assert min(found["valid"], found["rejected"]) > 3, name
        assert {r.kind: r.n for r in files} == {"valid": summary.rows_loaded, "rejected": summary.rejected}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == old


def test_line_numbers_of_rejects_in_splits(spark, tmp_path, small_splits):
    """Plain and quoted files: the number of a reject is that of its first line, whatever the splits."""
    for name, quoted in (("plain", False), ("quoted", True)):
        lines, want = [",".join(AGENTS.columns)], []
        for i in range(900):
            if i % 7 == 3:
                want.append((len(lines) + 1, f"short{i}"))
                lines.append(f"short{i}")
            elif quoted and i % 50 == 0:
                lines += [f'Kenya,u{i},T,"a', 'b"']
            else:
                lines.append(f"Kenya,u{i},T,x")
        summary, _, rejects = run(spark, tmp_path / name, "\n".join(lines) + "\n", AGENTS)
        assert sorted((r.line_number, r.raw_line) for r in rejects) == want and summary.rejected == len(want)


def test_a_quote_that_is_never_closed_loses_no_line(spark, tmp_path, small_splits):
    lines = [",".join(AGENTS.columns), 'Kenya,u1,T,"a\nb"', 'Kenya,u2,T,"open', *[f"Kenya,u{i},T,x" for i in range(3, 400)]]
    summary, valid, rejects = run(spark, tmp_path, "\n".join(lines) + "\n", AGENTS)
    assert [v.ameyo_user_id for v in valid] == ["u1"]
    assert sorted((r.line_number, r.raw_line) for r in rejects) == [(4 + i, x) for i, x in enumerate(lines[2:])]


def test_stray_quotes_and_repeated_headers_go_to_the_csv_reader(spark, tmp_path):
    text = ",".join(AGENTS.columns) + '\nKenya,u1,T,5" pipe\nKenya,u2,T,"a\nb"\nKenya,u3,T,6" pipe\nKenya,u4,T,x\n'
    _, valid, rejects = run(spark, tmp_path / "stray", text, AGENTS)
    assert sorted((v.ameyo_user_id, v.atlas_user_name) for v in valid) == [("u1", '5" pipe'), ("u2", "a\nb"), ("u3", '6" pipe'), ("u4", "x")]
    header = ",".join(AGENTS.columns)
    _, valid, rejects = run(spark, tmp_path / "twice", f"{header}\nKenya,u1,T,x\n{header}\n\n", AGENTS)
    assert len(valid) == 2 and [r.reason for r in rejects] == ["expected 4 fields, got 0"]


def test_a_wrong_header_may_be_left_out(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "raw")
    deliver(folder, AGENTS, "a,b\n1,2\n")
    deliver(folder, CALLS, f"{HEADER}\n{GOOD}\n")
    rows = landing.load_extracts(spark, str(folder), root, only=["ameyo_calls", "agent_mapping"], loaded_at=AT, skip_wrong_headers=True)
    assert {r.source_name: (r.skipped, r.reason, r.rows_loaded) for r in rows.collect()} == {
        "ameyo_calls": (False, None, 1), "agent_mapping": (True, "wrong_header", 0),
    }


def test_a_final_newline_is_part_of_the_identity(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\ny")
    (tmp_path / "b.csv").write_text("x\ny\n")
    assert len(set(hashes_of(spark, tmp_path / "a.csv", tmp_path / "b.csv").values())) == 2
