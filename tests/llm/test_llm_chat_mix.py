"""Chat formatting by exact round trips; mixing against a plain version."""

import hashlib
import json
import random

import pytest
from llm_plain import SIZE, mix_targets, odd_documents
from pyspark.sql import functions as F

from terraloom.llm import chat, mixing


def test_formatting_reads_back_exactly():
    rng = random.Random(1)
    signs = [*"ab<>/[]sSYINTROLEU\\ \n", *chat.CONTROLS, "\\", "\\", "é😀"]
    for _ in range(5000):
        turns = [(rng.choice(["user", "assistant", "system", "", "tool", "[ROLE]", "x\\"]), "".join(rng.choice(signs) for _ in range(rng.randint(0, 8))))
                 for _ in range(rng.randint(0, 5))]
        text, mask = chat.format_turns(turns)
        assert chat.read_back(text) == turns
        loss = "".join(chat.unescape(text[a:b]) for a, b in zip(mask[::2], mask[1::2]))
        assert loss == "".join(t for r, t in turns if r == "assistant")


def test_layouts_are_told_by_their_paths(spark):
    lines = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"prompt": "a", "response": "b"}, {"instruction": "a", "input": "c", "output": "b"}, {"instruction": "a", "input": "", "output": "b"},
        {"output": "b", "instruction": "a"}, {"unknown": 1}, [1], {"messages": []},
    ]
    df = spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(lines)] + [(90, None), (91, "{")], "k int, record string").selectExpr("*", "1 AS turns")
    got = {r.k: ([tuple(t) for t in r.turns], r.problem) for r in chat.canonical_json(df).collect()}
    assert got[0] == ([("user", "a"), ("assistant", "")], None)
    assert got[1] == got[2] == got[4] == got[5] == ([("user", "a"), ("assistant", "b")], None)
    assert got[3][0][0] == ("user", "a\n\nc")
    assert [got[k][1] for k in (6, 7, 90, 91)] == ["unknown layout", "no record", "no record", "not JSON"]


def test_typed_layouts(spark):
    df = spark.sql("SELECT named_struct('instruction', 'a', 'input', x, 'output', 'b') AS record FROM VALUES ('c'), (NULL) AS t(x)")
    got = sorted([tuple(t) for t in r.turns] for r in chat.canonical_turns(df).collect())
    assert got == [[("user", "a"), ("assistant", "b")], [("user", "a\n\nc"), ("assistant", "b")]]
    empty = spark.sql("SELECT CAST(NULL AS struct<messages:array<struct<role:string,content:string>>>) AS record")
    assert chat.canonical_turns(empty).first().turns == []
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(spark.sql("SELECT named_struct('odd', 1) AS record"))


def test_report_of_odd_conversations(spark):
    rows = [(1, 1, "assistant", "</s>b"), (1, 0, "user", None), (1, None, None, "last"), (2, 0, "assistant", ""), (None, 0, "user", "x"), (1, 1, "assistant", "</s>b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    got = {r.conv_id: r for r in chat.chat_report(df).collect()}
    said = "user\n\nassistant\n</s>b\nassistant\n</s>b\n\nlast\n"
    assert got[1].n_turns == 4 and got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (10, hashlib.sha256(b"</s>b</s>b").hexdigest())
    assert (got[2].loss_chars, got[None].n_turns) == (0, 1) and chat.chat_report(df.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 90, "c": 900, None: 7}, {"a": 5}, {"a": 0, "b": 4}, {"é": 1, "z": 1000, "a": 1, "b": 2, "c": 3, "d": 4000}, {"a": 0}])
def test_targets_are_those_of_sharing_again(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = mix_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


def test_targets_of_many_sources_are_found_by_ranges(spark):
    """Ranks and fill levels of 200 000 sources, dealt to several tasks: equal to the plain ones, and no task has them all."""
    rng = random.Random(8)
    sizes = {f"https://site-{rng.randrange(10**9)}-{k}.example/": rng.choice([0, 1, 5, 5, 40, 10**6]) + rng.randrange(3) for k in range(200_000)}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = mixing._ranged(df, ["source"], {"size": "source_size"}, "ranges").groupBy(F.spark_partition_id()).count().collect()
        got = mixing.targets(df).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in ranges) < 100_000
    want = mix_targets(sizes)
    assert len(got) == len(want) and all(abs(r.target - want[r.source]) <= 1e-6 * max(1.0, want[r.source]) for r in got)


def test_mix_takes_near_its_targets(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('wort ', CAST(1 + id % 7 AS INT)) AS text", "concat('s', CAST(sqrt(id % 50) AS INT)) AS source", "1 AS copies")
    rows = mixing.mix_report(docs).collect()
    taken = {}
    for r in rows:
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size
        taken.setdefault((int((r.doc_id % 50) ** 0.5), r.target), []).append(r.taken)
    assert len(taken) == 8 and all(abs(sum(v) - target) < 0.15 * target for (_, target), v in taken.items())
    assert sorted(rows) == sorted(mixing.mix_report(docs.repartition(5)).collect())
    out = mixing.mix(docs)
    assert out.count() == sum(r.taken // r.size for r in rows) and out.columns == [*docs.columns, "copy"]


def test_mix_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = mixing.mix_report(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: r.size for r in got if r.doc_id in (1, 2, 4)} == {1: 0, 2: 0, 4: 60_000}
    assert sum(r.size for r in got) == sum(len(SIZE.findall(r.text or "")) for r in docs.collect())
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix_report(docs.where("doc_id IN (1, 2)")).agg({"taken": "sum"}).first()[0] == 0
