"""Classifiers: held-out accuracy, what they may learn from, odd rows."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_plain import odd_documents
from pyspark.sql import functions as F

from terraloom.llm import labelled, quality, toxicity

SF = "/root/testdata/sf0.01"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")
LABELS = "doc_id bigint, quality int, toxic int"
CASES = [(quality.quality, "quality", 0.3), (toxicity.toxicity, "toxic", 0.5)]


def area(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    good = y == 1
    return (rank[good].sum() - good.sum() * (good.sum() - 1) / 2) / good.sum() / (~good).sum()


@here
@pytest.mark.parametrize("run, label, threshold, least", [(*CASES[0], 0.97), (*CASES[1], 0.75)])
def test_held_out_rows_are_ranked(spark, run, label, threshold, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = run(docs, labels)
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= threshold)
    truth = [(rows[r.doc_id].score, r[label]) for r in labels.collect() if rows[r.doc_id].held_out]
    assert area(np.array([s for s, _ in truth]), np.array([y for _, y in truth])) > least
    # Held-out labels are never learned from: turning them round changes nothing.
    turned = labels.withColumn(label, F.when(labelled.held_out("doc_id"), 1 - F.col(label)).otherwise(F.col(label)))
    assert {r.doc_id: r.score for r in run(docs, turned).collect()} == {i: r.score for i, r in rows.items()}


@pytest.mark.parametrize("run, label, threshold", CASES)
def test_odd_rows(spark, run, label, threshold):
    docs = odd_documents(spark).selectExpr("*", "'x' AS score")
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (6, 0, 1), (5, None, None), (7, 5, 5), (None, 1, 1), (99, 1, 1), (8, 1, 1), (8, 0, 0)], LABELS)
    rows = run(docs, labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    same = {r.score for r in rows if r.doc_id in (6, 7)}
    assert len(same) == 1 and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert {r.score for r in run(docs, labels.limit(0)).collect()} == {0.5} and run(docs.limit(0), labels).count() == 0


def test_sample_takes_one_row_a_label_and_passes_over_long_texts(spark, caplog):
    labels = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    first = labelled.training_texts(spark.range(40).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text"), labels, "quality", 20)
    first = [r.text for r in first.orderBy("order").collect()]
    docs = spark.createDataFrame(
        [(int(i), " ".join(f"w{i}x{k}" for k in range(400 if n == 2 else 3))) for n, i in enumerate(first)]
        + [(int(first[0]), f"copy {k}") for k in range(50)], "doc_id long, text string",
    )
    texts = labelled.training_texts(docs, labels, "quality", 20)
    whole = labelled.gather_sample(texts, quality.indicators, 10**6)[1]
    assert len(first) == len(whole) == 20 and len(whole[2]) > 300
    y, rows = labelled.gather_sample(texts, quality.indicators, len(whole[2]))
    assert len(y) == 19 and all(np.array_equal(a, b) for a, b in zip(rows, whole[:2] + whole[3:])) and "19 of 20" in caplog.text


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('word', id, ' more text') AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    y, rows = labelled.gather_sample(labelled.training_texts(docs, labels, "quality", 50), quality.indicators, 10**6)
    again = labelled.gather_sample(labelled.training_texts(docs.repartition(7), labels, "quality", 50), quality.indicators, 10**6)[1]
    assert len(y) == 50 and all(np.array_equal(a, b) for a, b in zip(rows, again))
    few = labelled.gather_sample(labelled.training_texts(docs, labels, "quality", 50), quality.indicators, 200)[1]
    assert 0 < sum(map(len, few)) <= 200


def test_misspelled_insults_are_near_the_words_they_imitate():
    rng = np.random.default_rng(1)
    plain = [f"{a}{b}" for a in ("stone", "water", "light", "paper") for b in ("er", "ing", "ed", "s")]
    texts, y = [], []
    for k in range(400):
        some = list(rng.choice(plain, 30))
        if k % 4 == 0:
            some[rng.integers(30)] = "grumblefoot"
            some[rng.integers(30)] = "grumblefoot"
        texts.append(" ".join(some))
        y.append(int(k % 4 == 0))
    model = toxicity.fit(np.array(y), toxicity.encode(pa.array(texts)))
    scores = model.score(pa.array(["stoner grumblefooot waters", "stoner papers waters", "grumblef00t lighting", "", None, "stoner " * 5000 + "grumblefoot grumblefoot"]))
    assert scores[0] > 0.5 > scores[1] and scores[2] > scores[1] and scores[3] == scores[4] and scores[5] > 0.5


def test_a_bag_holds_every_ngram():
    part = next(iter(toxicity.textops.slices(pa.array(["Äbcd x"]))))
    starts, ends, _, _ = toxicity._distinct_words(part)
    _, begin = toxicity._subwords(part, starts, ends)
    sizes = {bytes(toxicity.textops.LOWER[part.data[a:b]]).decode(): int(n) for a, b, n in zip(starts, ends, np.diff(begin))}
    assert sizes == {"Äbcd": 1 + 4 + 3 + 2 + 1, "x": 1 + 1}
