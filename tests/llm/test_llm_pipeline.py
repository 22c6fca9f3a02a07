"""The pipeline's stages against plain versions, each on its own input."""

import os

import duckdb
import pytest
from llm_plain import contamination, mix_targets, ngram_classes, odd_documents, removed_lines
from llm_plain import SIZE

import corpus_pipeline
from terraloom.llm import decontaminate, quality
from terraloom.llm.oracle import ORACLE
from terraloom.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    if not os.path.isdir(SF):
        pytest.skip("shared tables are not here")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1]) and steps[-1].columns == [*steps[0].columns, "copy"]


def test_quality_stage_keeps_what_the_classifier_accepts(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.quality(steps[0], labels).collect() if r.predicted == 1}
    assert rows(steps[1]).keys() == good


def test_line_stage_takes_out_later_copies(steps):
    before, after = rows(steps[1]), rows(steps[2])
    gone = removed_lines(sorted((i, r.text) for i, r in before.items()))
    want = {}
    for i, r in before.items():
        lines = r.text.split("\n")
        left = [x for k, x in enumerate(lines) if k not in gone.get(i, ())]
        if left:
            want[i] = "\n".join(left)
    assert {i: r.text for i, r in after.items()} == want and all(r.n_chars == len(r.text) for r in after.values())


def test_join_stage_keeps_one_of_each_class(steps):
    classes = ngram_classes([(i, r.text) for i, r in rows(steps[2]).items()])
    assert rows(steps[3]).keys() == {i for i, (c, _) in classes.items() if c == i}


def test_decontamination_stage(spark, steps):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = contamination([(i, r.text) for i, r in rows(steps[3]).items()], bench)
    assert rows(steps[4]).keys() == {i for i, j in judged.items() if not j[3]}


def test_mixing_stage(steps):
    docs = steps[4].collect()
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + len(SIZE.findall(r.text))
    targets = mix_targets(sizes)
    copies = {}
    for r in steps[5].collect():
        copies.setdefault(r.doc_id, []).append(r.copy)
    for r in docs:
        rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0
        got = sorted(copies.get(r.doc_id, []))
        assert got == list(range(len(got))) and int(rate) <= len(got) <= int(rate) + 1


def test_stages_take_odd_rows(spark):
    if not os.path.isdir(SF):
        pytest.skip("shared tables are not here")
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = materialize(stage(spark, docs, SF), "odd")
    assert "copy" in docs.columns


def test_run_is_the_stages_in_order(spark, steps):
    got = sorted(map(repr, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(repr, steps[-1].collect()))


CLASHING = ["score", "n_lines", "gone", "_id", "_gone", "_none", "_body", "_kept", "_t1", "_t2", "_copies", "size", "target", "_draw", "_source", "source_size",
            "copies", "bands", "n", "y", "_own", "_row", "_bit", "hit_items", "n_words", "item", "h1", "node", "Gone_x"]


def test_stages_leave_clashing_columns_alone(spark):
    if not os.path.isdir(SF):
        pytest.skip("shared tables are not here")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.unionByName(docs.limit(3)).selectExpr("*", *[f"doc_id * 10 + {k} AS `{c}`" for k, c in enumerate(CLASHING)])
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "clash")
        assert out.columns[: len(docs.columns)] == docs.columns
        found = out.collect()
        assert found and all(r[c] == r.doc_id * 10 + k for r in found for k, c in enumerate(CLASHING))
        docs = out.select(*docs.columns)


def test_items_without_an_id_hit_words(spark):
    words = " ".join(f"word{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"here {words} there"), (2, "nothing of it")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, words), (7, "of it"), (None, words + " more")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.contamination_report(docs, bench).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1].contaminated) == (20, 1, True) and (got[2].n_hit, got[2].n_items) == (2, 1)
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", bench)):
        con.register(name, df.toArrow())
    want = {r[0]: r for r in con.execute(f"SELECT doc_id, n_hit, n_items, items_sha256, contaminated FROM ({ORACLE['op4_decontaminate']})").fetchall()}
    assert {i: (r.doc_id, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in got.items()} == want
