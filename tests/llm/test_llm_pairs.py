"""Near-duplicate vectors, the n-gram join and line dedup against comparing everything."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_plain import ngram_classes, odd_documents, removed_lines, roots

from terraloom.llm import blocks, lattice, line_dedup, ngram_join, vector_dedup


def test_lattice_points_are_the_nearest():
    x = np.random.default_rng(0).normal(size=(2000, 8)) * 2
    point = lattice.nearest(x)
    near = ((x - point) ** 2).sum(1)
    around = ((x[:, None] - (point[:, None] + lattice.shortest()[None])) ** 2).sum(2).min(1)
    assert len(lattice.shortest()) == 240 and (near <= around + 1e-9).all() and near.max() <= 1 + 1e-9
    twice = np.rint(2 * point)
    assert np.allclose(twice, 2 * point) and (twice.sum(1) % 4 == 0).all() and (np.ptp(twice % 2, axis=1) == 0).all()


def plain_vectors(rows, least=0.98):
    good = [(i, np.asarray(v, float), label) for i, v, label in rows
            if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = []
    for k, (a, x, la) in enumerate(good):
        for b, y, lb in good[k + 1 :]:
            if la == lb and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                pairs.append((a, b))
    root = roots([r[0] for r in rows if r[0] is not None], pairs)
    links = [x for p in pairs for x in p]
    return {i: (links.count(i), root[i]) for i in root}


def clouds(rng, copies, noise):
    rows = []
    for _ in range(12):
        centre = rng.normal(size=64)
        centre /= np.linalg.norm(centre)
        for _ in range(copies):
            rows.append((len(rows), [float(x) for x in np.float32(centre + rng.normal(size=64) * noise / 8)], int(rng.integers(2))))
    return rows


@pytest.mark.parametrize("chunk", [5, 768])
def test_vector_links_are_those_of_comparing_all(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_dedup.blocks.deal, "__defaults__", (chunk,))
    rng = np.random.default_rng(chunk)
    rows = clouds(rng, 12, 0.11) + clouds(rng, 3, 0.6)
    rows = [(k, v, label) for k, (_, v, label) in enumerate(rows)]
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(9)]
    n = len(rows)
    bad = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] * 64]
    rows += [(2000 + k, v, 0) for k, v in enumerate(bad)] + [(2100, rows[0][1], None), (2101, rows[0][1][:8], 0), (2102, rows[0][1][:8], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS n", "2 AS cells")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.vector_links(df).collect()}
    want = plain_vectors(rows)
    assert len(got) == len(rows) and got[2000] == (0, 2000) and got[2102] == (1, 2101)
    found, there = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert there > n and found >= 0.995 * there and all(got[i][0] <= want[i][0] for i in want)
    if found == there:
        assert got == want


def test_vector_links_of_odd_tables(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vector_dedup.vector_links(df).collect())
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert vector_dedup.vector_links(df.limit(0)).count() == 0


@pytest.mark.parametrize("vectors", [0, 5000, 10**6, 10**8, 10**13])
def test_recall_of_pairs_near_the_limit(vectors):
    """The same recall at every resolution."""
    count, tables = lattice.resolution(vectors, 0.98)
    rng = np.random.default_rng(4)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.981 * a + np.sqrt(1 - 0.981**2) * side
    met = np.zeros(len(a), bool)
    for t in range(tables):
        ca, ra, pa_ = lattice.cells(a, t, count)
        cb, rb, pb = lattice.cells(b, t, count)
        met |= ca == cb
        met[ra[pa_ == cb[ra]]] = True
        met[rb[pb == ca[rb]]] = True
    assert met.mean() > 0.99


def test_cells_get_finer_with_more_vectors():
    """Strangers a vector meets in a table stay bounded: their share falls block by block, as the resolution assumes."""
    x = np.random.default_rng(9).normal(size=(40_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shares = []
    for count in (1, 2, 3):
        copies = np.unique(lattice.cells(x, 0, count)[0], return_counts=True)[1].astype(float)
        shares.append((copies * (copies - 1)).sum() / len(x) ** 2)
    assert shares[1] < shares[0] / 50 and shares[2] < shares[1] / 50
    counts = [lattice.resolution(n, 0.98)[0] for n in (1000, 10**5, 10**6, 10**8, 10**10, 10**12, 10**13)]
    assert counts == sorted(counts) and counts[0] == 2 and counts[-1] == 6
    assert 10**6 * shares[lattice.resolution(10**6, 0.98)[0] - 1] < lattice.STRANGERS


def test_links_at_a_finer_resolution(spark, monkeypatch):
    """What a large table would use, on a small one: links, components and counts equal those at the coarse resolution."""
    rng = np.random.default_rng(10)
    centre = rng.normal(size=(40, 64))
    x = (centre / np.linalg.norm(centre, axis=1, keepdims=True))[rng.integers(0, 40, 400)] + rng.normal(size=(400, 64)) * 0.008
    df = spark.createDataFrame([(k, v.astype(float).tolist(), k % 2) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    coarse = sorted(map(tuple, vector_dedup.vector_links(df).collect()))
    fine = lattice.resolution(10**8, 0.98)
    monkeypatch.setattr(lattice, "resolution", lambda *_: fine)
    assert fine[0] == 4 and sorted(map(tuple, vector_dedup.vector_links(df).collect())) == coarse
    assert sum(r[1] > 0 for r in coarse) > 300


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_roots(pairs):
    a, b = np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
    want = roots(range(31), [p for p in pairs if p[0] != p[1]])
    assert blocks.roots(31, a, b).tolist() == [want[k] for k in range(31)]


def near_copies(rng, n, length, changes):
    base = [f"w{rng.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(changes + 1)):
            text[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("chunk", [7, 768])
def test_ngram_links_are_those_of_comparing_all(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join.blocks.deal, "__defaults__", (chunk,))
    rng = random.Random(chunk)
    texts = near_copies(rng, 40, 120, 6) + near_copies(rng, 10, 60, 1) + near_copies(rng, 6, 30, 9) + ["one two"] * 3 + ["One, two!", "", "one", "..."]
    texts += [" ".join(f"u{rng.randrange(50)}" for _ in range(80)) for _ in range(20)] + [None]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS bands")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_links(df).collect()}
    assert got == ngram_classes(docs)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (c, _) in got.items() if i == c)


def test_ngram_links_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = ngram_join.ngram_links(docs).collect()
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links, r.kept) for r in rows)
    assert got == [(0, 0, 0, True), (0, 0, 0, True), (1, 1, 0, True), (2, 2, 0, True), (3, 3, 0, True), (4, 4, 0, True), (5, 5, 0, True),
                   (6, 6, 2, True), (6, 6, 2, True), (7, 6, 2, False), (8, 8, 0, True)]
    assert sorted(r.doc_id or 0 for r in ngram_join.keep_one(docs).collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 8]
    assert ngram_join.ngram_links(docs.limit(0)).count() == 0 and ngram_join.keep_one(docs.limit(0)).count() == 0


def test_texts_under_one_id_are_documents_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(ngram_join.blocks.deal, "__defaults__", (3,))
    rng = random.Random(2)
    a, b, c = (near_copies(rng, 4, 100, 1) for _ in range(3))
    alone = near_copies(rng, 3, 40, 0)[0]
    docs = [(1, a[0]), (2, a[1]), (2, alone), (1, b[0]), (3, b[1]), (4, b[2]), (5, c[0]), (5, c[1]), (5, c[2]), (5, c[2]), (6, c[3]),
            (7, "One two"), (7, "One, two!"), (8, None), (8, None), (8, "more words")]
    want = ngram_classes(list(enumerate(t for _, t in docs)))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_links(df).collect())
    assert got == sorted((i, docs[want[k][0]][0], want[k][1]) for k, (i, _) in enumerate(docs))
    left = [(r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()]
    assert sorted(i for i, _ in left) == [1, 1, 2, 5, 7, 8, 8, 8]
    assert {(1, a[0]), (1, b[0]), (2, alone), (8, None), (8, "more words")} <= set(left)
    assert ngram_join.keep_one(df).columns == df.columns


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.8, 0.95):
        bands, rows = ngram_join.bands_for(similarity)
        assert 1 - (1 - similarity**rows) ** bands >= 0.9999 and bands * rows <= 128


@pytest.mark.parametrize("seed", range(3))
def test_removed_lines_are_those_of_comparing_all(spark, seed):
    rng = random.Random(seed)
    lines = ["a b c", "d", "", "e f g h i j k l m n", " d\r", "x " * 60, "last one"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 25))) for _ in range(30)]
    texts += [texts[3], "head\n" + texts[4] + "\ntail", "", "x " * 60, "q\n" * 80 + "q"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = line_dedup.dedup_lines(df, 12).collect()
    assert {r.doc_id: list(r.gone) for r in rows if r.gone} == removed_lines(docs, 12)
    for r in rows:
        assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in r.gone)


def test_line_dedup_of_odd_rows(spark):
    run = "\n".join(f"line number {k} of it" for k in range(20))
    more = spark.createDataFrame([(20, run, "en", "z", 1), (20, run, "en", "z", 1), (21, "top\n" + run, None, None, None), (None, run, None, None, None)],
                                 odd_documents(spark).schema)
    docs = odd_documents(spark).unionByName(more).selectExpr("*", "1 AS p", "'x' AS gone")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns[:6], "n_lines", "gone"] and out.count() == docs.count()
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert [r.text for r in rows[20]] == [run, run] and rows[21][0].text == "top" and rows[1][0].text is None and rows[2][0].text == ""
    assert sorted(len(r.gone) for r in rows[None]) == [0, 0, 20] and rows[1][0].n_lines == 0
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_only_pairs_that_share_a_band_are_compared():
    """Texts of one boilerplate, far from near: chains of chance bands must not make all of them meet."""
    rng = np.random.default_rng(4)
    common = rng.integers(0, 1 << 62, 90, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(common, 70, replace=False), rng.integers(0, 1 << 62, 130, dtype=np.uint64)])) for _ in range(2000)]
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    bands, rows = ngram_join.bands_for()
    names = ngram_join._signatures(np.concatenate(sets), starts, bands, rows)
    pairs = {(i, j) for name in names.T for i, j in zip(*np.nonzero(np.triu(name[:, None] == name[None, :], 1)))}
    compared = ngram_join.candidates(names, None, None)
    assert set(zip(*np.nonzero(compared))) == pairs and 0 < len(pairs) < 20_000
    by_band = sum(ngram_join.candidates(names[own], None, int(value)).astype(int).sum() for name in names.T for value in np.unique(name) for own in [name == value])
    assert by_band == len(pairs)


@pytest.mark.parametrize("chunk", [2, 5])
def test_thin_bands_are_compared_band_by_band(spark, monkeypatch, chunk):
    """Chains of texts, each near the next alone: groups are long, bands are thin, and links are those of comparing all."""
    monkeypatch.setattr(blocks, "CHUNK", chunk)
    monkeypatch.setattr(blocks.deal, "__defaults__", (chunk,))
    words = [f"w{k}" for k in range(900)]
    docs = [(k, " ".join(words[4 * k : 4 * k + 80])) for k in range(150)] + [(500 + k, " ".join(words[:60]) + f" end{k}") for k in range(12)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    signed = ngram_join._signed(df, 5, 0.8, 0.9999).where("h1 IS NOT NULL").selectExpr("h1", "h2", "_id", "_t1", "_t2", "1L n", "size", "bands", "_id node")
    modes = {tuple(k.band is None for k in r["keys"]) for r in ngram_join._placed(signed).collect()}
    assert any(not all(m) for m in modes)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_links(df).collect()}
    assert got == ngram_classes(docs)
