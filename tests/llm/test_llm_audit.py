"""Filter interaction audit against counting every order document by document."""

import collections
import re
from fractions import Fraction
from itertools import permutations
from math import factorial

from llm_plain import SIZE, odd_documents

from terraloom.llm import filter_audit


def plain(docs, labels):
    first = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    fails = []
    for doc, text, source in docs:
        t = text or ""
        w = SIZE.findall(t)
        bad = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        bad += "D" * bool(re.search("[#$%&*|]", t)) + "E" * (doc is not None and first.get(t, doc) < doc)
        fails.append((source or "", set(bad), doc in good, doc in toxic))
    out, share = {}, collections.Counter()
    for order in map("".join, permutations("ABCDE")):
        for k, f in enumerate(order):
            for part in {x[0] for x in fails}:
                row = [0] * 6
                for own, bad, g, t in fails:
                    if own == part:
                        earlier = bad & set(order[:k])
                        here = f in bad and not earlier
                        for c, yes in enumerate((not earlier and f not in bad, here, f in bad and earlier, bad == {f}, here and g, here and t)):
                            row[c] += bool(yes)
                share[part, f] += row[1]
                out[part, order, k + 1] = row
    return {key: (*row, share[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def test_all_orders_over_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (6, 1, 1), (6, 0, 0), (7, None, 1), (4, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    got = filter_audit.filter_audit(docs.withColumn("mask", docs.doc_id), labels).collect()
    want = plain([(r.doc_id, r.text, r.source) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    assert len(got) == 600 * 4
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want


def test_empty_tables(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.filter_audit(docs.where("false"), labels).count() == 0
    assert filter_audit.filter_audit(docs, labels).agg({"good_lost": "sum"}).first()[0] == 0


def test_least_squares_gives_the_shapley_values():
    for m in (2, 3, 5):
        for i, row in enumerate(filter_audit.shapley_weights(m)):
            for s, weight in enumerate(row):
                size = s.bit_count()
                inside = bool(s >> i & 1)
                want = Fraction(factorial(size - inside) * factorial(m - size - 1 + inside), factorial(m))
                assert weight == (want if inside else -want) or s == 0
