"""Merkle manifest, MinHash near-duplicates and lexical search against brute force, and their edges."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import lexical_search, merkle, minhash

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, g string, lo long, n long, digest string, "
          "key string, h long, bucket string, path string, m map<string,int>")


def rows(spark, docs):
    """Documents (doc_id, text, lang, source), with columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "g", 1, 2, "d", "k", 3, "b", "p", {"a": 1})
                                  for i, t, lang, s in docs], SCHEMA)


LONG = " ".join(f"w{k % 977}" for k in range(60_000))
EDGES = [(0, None, "en", None), (1, "", None, "s"), (2, "One two", "en", "s"), (3, "A b c d e f", "en", ""),
         (3, "A b c d e f", "en", ""), (5, LONG, "en", "s"), (6, LONG + " end", "en", "é"), (None, "ÀÉ ç " * 40, "fr", "s"),
         (None, None, None, None), (9, " \t\n", "en", "s"), (10, "one\x0btwo", "en", "s"), (11, LONG, "en", "s")]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- Merkle manifest ---------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_record(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def slow_tree(leaves):
    """(root, the siblings before and after each leaf, level by level)."""
    paths, place, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, p in enumerate(place):
            run, at = level[p // 16 * 16:p // 16 * 16 + 16], p % 16
            paths[i].append(("".join(run[:at]), "".join(run[at + 1:])))
        level = [H(*level[i:i + 16]) for i in range(0, len(level), 16)]
        place = [p // 16 for p in place]
    return level[0], paths


def lower(text):
    return None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)


def slow_tampering(docs):
    sources = {}
    for r in docs:
        sources.setdefault(r["source"], []).append((r["doc_id"] is None, r["doc_id"] or 0, slow_record(r, r["text"]), r))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: slow_tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    root, upper = slow_tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, upper):
        for (_, _, leaf, r), path in zip(sorted(sources[s], key=lambda x: x[:3]), trees[s][1]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            h = slow_record(r, lower(r["text"])) if hit else leaf
            for before, after in path + above:
                h = H(before, h, after)
            out.append((r["doc_id"], leaf, trees[s][0], root, H(*[a + b for a, b in path + above]), h, h == root))
    return sorted(out, key=repr)


def test_manifest_matches_brute_force(spark):
    # three levels in one source, many sources (two levels above), a source of one document
    rng = random.Random(5)
    docs = [(i, f"Text {i} of Ümlaut", "en", rng.choice(["hot"] * 300 + [None, ""] + [f"s{k}" for k in range(40)]))
            for i in rng.sample(range(10_000), 700)] + [(77_777, "Alone", None, "alone")]
    for given in (docs, EDGES):
        df = rows(spark, given)
        assert collected(merkle.tampering(df)) == slow_tampering([r.asDict() for r in df.collect()])


def test_manifest_of_one_source_and_of_none(spark):
    one = rows(spark, [(1, "A", "en", "s")])
    got = merkle.tampering(one).first()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == H() and got.verified
    assert merkle.tampering(rows(spark, [])).count() == 0


def test_manifest_labels_are_nested_intervals(spark):
    df = rows(spark, [(i, "x", "en", "s") for i in range(300)])
    tree = merkle.manifest(df.select(merkle.group_key(F.col("source")).alias("g"), F.col("doc_id").alias("id"),
                                     merkle.record_digest([F.col("doc_id")]).alias("digest")))
    assert [sorted((r.lo, r.hi) for r in level.collect()) for level in tree.levels] == [
        [(k, min(k + 16, 300)) for k in range(0, 300, 16)], [(0, 256), (256, 300)], [(0, 300)]]
    proofs = merkle.proofs(tree).select("digest", "path", "root").limit(5).collect()
    for r in proofs:
        h = r.digest
        for s in r.path:
            h = H(s.before, h, s.after)
        assert h == r.root


# -- MinHash -----------------------------------------------------------------------

def slow_sets(docs):
    out = []
    for r in docs:
        w = (r["text"] or "").encode().lower().split()
        out.append({b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def slow_near_duplicates(docs):
    sets = slow_sets(docs)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(docs):
        groups.setdefault(find(i), []).append(r["doc_id"])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((r["doc_id"], len(s), least[find(i)], r["doc_id"] == least[find(i)])
                   for i, (r, s) in enumerate(zip(docs, sets))), key=repr)


def families(rng, n, size):
    """Groups of near copies of differing likeness: some pairs link, some only through others."""
    out = []
    for _ in range(n):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([8, 60, 200]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            out.append(" ".join(words))
    return out


def test_minhash_matches_brute_force(spark):
    rng = random.Random(7)
    texts = families(rng, 12, 12)
    rng.shuffle(texts)
    for df in (rows(spark, [(i * 3, t, "en", "s") for i, t in enumerate(texts)]), rows(spark, EDGES)):
        assert collected(minhash.near_duplicates(df)) == slow_near_duplicates([r.asDict() for r in df.collect()])


def test_minhash_of_a_large_family_in_blocks(spark, monkeypatch):
    """Members that hubs don't settle are compared as pairs of blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(220)]
    texts = []
    for k in range(90):                               # about half of the pairs link
        words = list(base)
        for at in rng.sample(range(22), 2):
            words[at * 10] = f"x{k % 30}-{at}"
        texts.append(" ".join(words))
    df = rows(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    signed = minhash._signed(df.select("doc_id", F.col("text").cast("binary").alias("raw"), F.lit(1).cast("long").alias("h")), 5)
    assert signed.select(F.explode("buckets").alias("b")).groupBy("b").count().agg(F.max("count")).first()[0] > 8
    assert collected(minhash.near_duplicates(df)) == slow_near_duplicates([r.asDict() for r in df.collect()])


def test_forest_unites_what_is_linked():
    rng = random.Random(13)
    docs = [{"doc_id": i, "text": t} for i, t in enumerate(families(rng, 4, 10))]
    sets = [minhash.shingles(d["text"].encode()) for d in docs]
    found = minhash.forest(sets, np.arange(len(sets)), np.arange(len(sets)), None)
    parent = list(range(len(sets)))
    for i, j in found:
        a, b = i, j
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        assert a != b                                 # a forest: no link twice
        parent[max(a, b)] = min(a, b)
    expected = {c for _, _, c, _ in slow_near_duplicates(docs)}
    assert {i for i in range(len(sets)) if parent[i] == i} == expected


def test_shingles_do_not_depend_on_the_piece(monkeypatch):
    rng = random.Random(17)
    text = "".join(rng.choice(["ab", "Ç", " ", "\t ", "x" * 30, "\n"]) for _ in range(3000)).encode()
    whole = {r for r in minhash.shingles(text).tolist()}
    assert len(whole) == len(slow_sets([{"text": text.decode()}])[0])
    monkeypatch.setattr(minhash, "PIECE", 50)
    assert {r for r in minhash.shingles(text).tolist()} == whole


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for both, only in ((300, 100), (10, 10), (2, 1)):
        estimates = []
        for _ in range(60):
            h = rng.integers(0, 1 << 63, both + 2 * only, dtype=np.uint64)
            a, b = h[:both + only], np.concatenate([h[:both], h[both + only:]])
            s = minhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
            assert (s != minhash.EMPTY).all()
            estimates.append((s[0] == s[1]).mean())
        j = both / (both + 2 * only)
        # no wider than independent minima
        assert abs(np.mean(estimates) - j) < 0.02 and np.var(estimates) < 1.3 * j * (1 - j) / minhash.REGISTERS


def test_minhash_of_nothing(spark):
    assert minhash.near_duplicates(rows(spark, [])).count() == 0
    assert collected(minhash.near_duplicates(rows(spark, [(1, None, "en", "s"), (2, "", "en", "s")]))) == [
        (1, 0, 1, True), (2, 0, 2, True)]


# -- lexical search ----------------------------------------------------------------

def slow_search(docs, items, k=50):
    def terms(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in
                re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    tf = [(d, Counter(terms(t))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    N, L = len(tf), sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in tf:
            m = 50 + 50 * c.total() * N // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [(1, "One two THREE"), (2, None), (3, "..."), (3, "ç w5 w6"), (None, "w5 w7 one"), (5, "one two three"),
         (6, "nowhere")]


def test_search_matches_brute_force(spark):
    df = rows(spark, EDGES + [(20 + i, f"one w{i % 7} two" + " x" * (i % 3), "en", "s") for i in range(120)])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = slow_search([(r.doc_id, r.text) for r in df.collect()], ITEMS)
    assert collected(lexical_search.search(df, items)) == expected


def test_search_in_small_tiles_and_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = collected(lexical_search.search(docs, items))
    assert expected == slow_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    blocks = list(lexical_search.item_blocks(items, limit=100))
    assert len(blocks) > 5 and all(len({t for _, ts in b for t in ts}) <= 100 or len(b) == 1 for b in blocks[:-1])
    place = {t: i for i, t in enumerate(sorted({t for b in blocks for _, ts in b for t in ts}))}
    monkeypatch.setattr(lexical_search, "TILE_TERMS", 7)
    parts = lexical_search.tiles(blocks[0], place, np.ones(len(place), np.int64))
    assert len(parts) > 3 and all(len(p[2]) <= 7 for p in parts)
    # the tiles of an item tile hold each cell once
    assert sum(len(p[3]) for p in parts) == sum(len(ts) for _, ts in blocks[0])


def test_search_tiles_stay_exact(spark, monkeypatch):
    """Tiles of seven terms, three documents, and a greatest weight that forces narrower ones."""
    weight = np.array([1 << 40] * 9, np.int64)
    parts = lexical_search.tiles([(1, [bytes([65 + i]) for i in range(9)])], {bytes([65 + i]): i for i in range(9)}, weight)
    assert all(len(p[2]) * (1 << 40) * 10 ** 6 < 1 << 53 or len(p[2]) == 1 for p in parts) and len(parts) == 9


def test_search_of_nothing(spark):
    none, items = rows(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(none, items).count() == 0
    assert lexical_search.search(rows(spark, EDGES), items.limit(0)).count() == 0
    assert lexical_search.search(rows(spark, [(1, None, "en", "s"), (2, "..", "en", "s")]), items).count() == 0
