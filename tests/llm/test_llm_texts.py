"""Word arrays, token counts, license scans and decontamination against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_plain import contamination, odd_documents, words

from terraloom.llm import decontaminate, licenses, textops, tokens

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abZé1 .\n漢-", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, most):
    got = [[] for _ in texts]
    for part in textops.slices(pa.array(texts, pa.string()), most):
        starts, ends, docs, hashes = textops.words(part)
        for a, b, d, h in zip(starts, ends, docs, hashes):
            word = textops.LOWER[part.data[a:b]].tobytes().decode()
            assert int(h) == textops.text_hash(word)
            got[part.first + d].append(word)
    assert got == [words(t) for t in texts]


def test_ngrams_stay_inside_texts():
    docs = np.array([0, 0, 0, 1, 1, 3])
    hashes = np.arange(6, dtype=np.uint64)
    assert textops.ngrams(hashes, docs, 2)[1].tolist() == [0, 1, 3]
    assert textops.ngrams(hashes, docs, 7)[1].tolist() == []


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("word_bpe_49k.json")


def test_token_counts_are_the_librarys(vocabulary):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary)
    proven = tokens.prove(vocabulary)
    assert len(proven.whole) > 30_000
    counter, rng = proven.counter(), random.Random(5)
    signs = [*"abcsS'tTrReEvVmMlLdD 0129²½\t\n\r\x0b\x85\xa0\x1c\x00\x7f!?.,-_|<>éÉßİıſΣσςëÅﬁ漢ひが😀‍　́’٠ẞ한", "<|startoftext|>", "<|endoftext|>", "<|endof", "'ll", "İ゙"]
    for _ in range(5000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False)), repr(text)


def test_token_counts_of_odd_rows(spark, vocabulary):
    docs = odd_documents(spark).selectExpr("*", "'x' AS n_tokens", "1 AS over_limit")
    out = tokens.count_tokens(docs, vocabulary, limit=10)
    assert out.columns == [*docs.columns[:5], "n_bytes", "n_tokens", "over_limit"]
    rows = {r.doc_id: r for r in out.where("doc_id IS NOT NULL").collect()}
    assert (rows[1].n_bytes, rows[1].n_tokens, rows[2].n_tokens, rows[4].over_limit, rows[2].over_limit) == (0, 0, 0, True, False)
    assert out.count() == docs.count() and tokens.count_tokens(docs.limit(0), vocabulary).count() == 0


def test_base_phrases_are_all_counted():
    rng = random.Random(2)
    signs = ["MIT", "License", "apache", "general", "public", "license", "x", "mit-license", "GNU", "\n"]
    texts = [" ".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(300)] + ["", None]
    known = licenses.vocabulary()
    index = licenses.build_index(np.arange(len(known)), 1000)
    got = [row for part in textops.slices(pa.array(texts), 500) for row in licenses.scan_slice(index, part)]
    for text, row in zip(texts, got):
        w, places, labels = words(text), [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert row[:5] == (len(w), len(places), min(places, default=None), max(places, default=None), sorted(labels))


def test_license_texts_are_found_in_place_and_edited(spark):
    full = {label: text for label, text, _ in licenses.TEMPLATES}
    rows = [(1, "some code " + full["mit"] + " more"), (2, full["bsd"].replace("or without", "or also without")), (3, "redistribution and use"), (4, None),
            (5, "Licensed under CC BY-NC 4.0."), (6, "Released under the MIT License."), (7, "permission is granted to any person " * 50)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "'mine' AS score")
    out = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert [out[k].labels for k in range(1, 8)] == [["mit"], ["bsd"], [], [], ["cc-by-nc-4.0"], ["mit", "mit-notice"], []]
    assert out[1].matches[0]["first"] == 2 and out[1].score > 0.99 and out[4].n_words == 0 and out[3].score == 0
    assert licenses.license_report(docs.limit(0)).count() == 0 and licenses.license_report(odd_documents(spark)).count() == 11


def _decontaminated(spark, docs, bench, **more):
    d = spark.createDataFrame(docs, "doc_id int, text string")
    b = spark.createDataFrame(bench, "item_id int, text string")
    found = decontaminate._judged(decontaminate.find_contamination(d, b, **more)).collect()
    return {r.doc_id: (r.n_words, r.n_hit, sorted(r.hit_items), r.contaminated) for r in found}


@pytest.mark.parametrize("block_bytes", [4 << 20, 60])
def test_windows_are_found_as_by_comparing_all(spark, block_bytes):
    rng = random.Random(block_bytes)
    signs = ["a", "b", "Ab", "é", "c1", "zz"]
    bench = [(k, " ".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 5, 13, 14, 20, 40])))) for k in range(6)] + [(90, None)]
    docs = [(k, rng.choice(["", ". "]) + rng.choice(["  ", "-"]).join(rng.choice(signs) for _ in range(rng.choice([0, 1, 3, 20, 60])))) for k in range(20)]
    docs += [(100 + k, f"x {text} y") for k, text in bench] + [(200, None), (201, "")]
    assert _decontaminated(spark, docs, bench, block_bytes=block_bytes) == contamination(docs, bench)


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WINDOWS", 7)
    item = " ".join(f"w{k}" for k in range(60))
    docs = [(k, " ".join(f"w{x}" for x in range(k, k + 13))) for k in range(0, 48)]
    pieces = decontaminate._pieces(spark.createDataFrame([(1, item)], "item_id int, text string")).collect()
    matcher = decontaminate.Matcher([(0, r.whole, r.words) for r in pieces])
    part = next(textops.slices(pa.array([t for _, t in docs])))
    assert all(s.tolist() == [0, 13] for s in matcher.hits(part)[1])


def test_decontamination_of_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "'x' AS hit_spans", "7 AS n_words")
    bench = spark.createDataFrame([(1, "same TEXT here, for all of us!"), (2, None), (None, "wort")], "item_id int, text string")
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 8]
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.contamination_report(docs.limit(0), bench).count() == 0
