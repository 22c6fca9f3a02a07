"""Plain versions to compare the operators with, and rows that try their limits."""

import collections
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SIZE = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall((text or "").translate(_LOW))


def odd_documents(spark, columns=""):
    """Nulls in any column, an empty and a very long text, ties and repeated rows."""
    long = "wort " * 60_000
    rows = [
        (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, "Eins zwei", "de", None, None), (4, long, "en", "b", len(long)), (5, "!!! ***", "en", "b", 7),
        (6, "Same text here for all of us", "en", "c", 28), (6, "Same text here for all of us", "en", "c", 28), (7, "Same text here for all of us", "en", "c", 28),
        (None, "Same text here for all of us", "en", "c", 28), (None, None, None, None, None), (8, "naïve Ünïcode 漢字 ́x\x00y", "xx", "c", 10),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def contamination(docs, bench, n=13):
    windows = collections.defaultdict(set)
    for item, text in bench:
        w = words(text)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[k : k + size])].add(item)
    out = {}
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    items |= found
        out[doc] = (len(w), len(hit), sorted(map(str, items)), bool(hit) and 20 * len(hit) >= len(w))
    return out


def ngram_classes(docs, n=5, similarity=(4, 5)):
    """doc -> (class, links) by comparing all pairs."""
    sets = {}
    for doc, text in docs:
        w = words(text)
        size = min(n, len(w))
        sets[doc] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if size else set()
    pairs = []
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and similarity[1] * both >= similarity[0] * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    root, links = roots(ids, pairs), collections.Counter(x for p in pairs for x in p)
    return {i: (root[i], links[i]) for i in ids}


def removed_lines(docs, least=50):
    """doc -> positions covered by a maximal run of at least ``least`` words that stands earlier too."""
    lines = [(k, p, x.removesuffix("\r").strip(" "), len(SIZE.findall(x))) for k, (_, t) in enumerate(docs) for p, x in enumerate(t.split("\n"))]
    at = collections.defaultdict(list)
    for n, line in enumerate(lines):
        at[line[2]].append(n)
    gone = collections.defaultdict(set)

    def same(i, j):
        return 0 <= i and j < len(lines) and lines[i][2] == lines[j][2]

    for places in at.values():
        for x, j in enumerate(places):
            for i in places[:x]:
                if same(i - 1, j - 1) and lines[i - 1][0] == lines[i][0] and lines[j - 1][0] == lines[j][0]:
                    continue
                n = total = 0
                while same(i + n, j + n) and lines[i + n][0] == lines[i][0] and lines[j + n][0] == lines[j][0]:
                    total += lines[j + n][3]
                    n += 1
                if total >= least:
                    gone[docs[lines[j][0]][0]].update(lines[q][1] for q in range(j, j + n))
    return {k: sorted(v) for k, v in gone.items()}


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """source -> target, by handing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        left = total - sum(full.values())
        free = [s for s in names if s not in full]
        heavy = sum(weight[x] for x in free)
        share = {s: left * weight[s] / heavy for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return full | share
        full |= {s: float(most * sizes[s]) for s in over}
