"""The pipeline stage by stage on the middle tables."""

from collections import Counter

import corpus_pipeline
from brute import contamination, linked, quality, targets, words

from callpay.llm.shared import stored, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, rows = docs.columns, {r.doc_id: r.asDict() for r in docs.collect()}
    items = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    want = {d for d, r in rows.items() if not quality(r["text"])["base_failed"]}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        kept.append(docs)
    for df in kept[:-1]:
        assert df.columns == names
        assert all(r.asDict() == rows[r.doc_id] for r in df.collect())
    ids = [sorted(r.doc_id for r in df.collect()) for df in kept]
    assert ids[0] == sorted(want)
    groups = linked({d: rows[d]["text"] for d in want}, 5, 80)
    assert ids[1] == sorted(set(groups.values())) and len(ids[1]) < len(want)
    hits = contamination({d: rows[d]["text"] for d in ids[1]}, items)
    assert ids[2] == sorted(d for d in ids[1] if not hits[d][1]) and len(ids[2]) < len(ids[1])
    size = {d: len(words(rows[d]["text"])) for d in ids[2]}
    total, taken = Counter(), Counter()
    for d in ids[2]:
        total[rows[d]["source"]] += size[d]
    for d, n in Counter(ids[3]).items():
        assert n <= 3
        taken[rows[d]["source"]] += n * size[d]
    for source, target in targets(total).items():
        assert abs(taken[source] - target) <= max(size.values())
    assert ids[4] == ids[3] and kept[4].columns == [*names, "shard", "slot"]
    counts = Counter(r.shard for r in kept[4].collect())
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1


def test_run_is_the_stages(spark):
    """Rows of a run are those of the stages applied one by one, also with an empty benchmark or without documents."""
    small = "/root/testdata/sf0.001"
    docs = table(spark, small, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), name)
    out = corpus_pipeline.run(spark, small)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_stages_of_empty_tables(spark, tmp_path):
    for name, rows in (("documents", None), ("benchmark", 0)):
        table(spark, "/root/testdata/sf0.001", name).limit(20 if rows is None else 0).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
