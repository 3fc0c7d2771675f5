import collections

import pytest

import corpus_pipeline
from tidegrid.llm import quality, registry
from tidegrid.llm.common import OWN


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in registry.queries()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 11)]
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("which", ["some_docs", "odd_docs", "no_docs"])
def test_stages_keep_columns_and_whole_rows(spark, request, tmp_path, which):
    docs = request.getfixturevalue(which)
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "unused")
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == columns and not any(c.startswith(OWN + "row") for c in after.columns)
        rows = collections.Counter(map(str, docs.collect()))
        for r, n in collections.Counter(map(str, after.collect())).items():
            assert n <= rows[r] * (3 if name == "mixing" else 1)
        docs = after
        counts.append(docs.count())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "unused")
    assert sum(1 for b in packed.select("pieces").collect() for p in b["pieces"] if p["start"] == 0) == docs.count()
    if which == "some_docs":
        assert counts[0] > counts[1] > counts[2] >= counts[3] > 0


def test_decisions_take_effect(spark, some_docs, tmp_path):
    kept = {r["doc_id"] for r in quality.quality(some_docs).collect() if r["kept"]}
    out = corpus_pipeline.quality_rules(spark, some_docs, "unused")
    assert {r["doc_id"] for r in out.collect()} == kept
    out.write.parquet(str(tmp_path / "q"))
    docs = spark.read.parquet(str(tmp_path / "q"))
    once = corpus_pipeline.exact(spark, docs, "unused")
    texts = [r["text"] for r in once.collect()]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert len({t.translate(lower) for t in texts}) == len(texts) == len({r["text"].translate(lower) for r in docs.collect()})


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mixing", "packing"]
    assert got and all(len(r["ids"]) == r["bin_used"] <= r["bin_length"] for r in got)
