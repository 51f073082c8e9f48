"""Edge faults: column names and types, large components, short and repetitive items."""

import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, simhash, token_counts, vector_search

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, __id long, __h long, __n long, c0 string, "
          "id long, h long, span string, tokens string, m map<string,int>, a array<map<string,int>>")
WORDS = "the cat sat on the mat and saw a dog run by in the park where it was warm"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 77, 5, 9, "c", 3, 4, "x", "y", {"k": i}, [{"q": 1}])
                                  for i, t in texts], SCHEMA)


def test_one_of_each_keeps_columns(spark):
    df = docs(spark, [(1, WORDS), (2, WORDS), (3, "other words " * 9), (3, "other words " * 9), (None, None)])
    kept = simhash.one_of_each(df)
    assert kept.schema.simpleString() == df.schema.simpleString()
    rows = {r.doc_id: r for r in kept.collect()}
    assert set(rows) == {1, 3, None} and kept.count() == 3
    assert all((r["__id"], r["__h"], r["__n"], r["id"], r["h"], r.span, r.tokens) == (77, 5, 9, 3, 4, "x", "y")
               for r in rows.values())
    assert rows[1].m == {"k": 1} and rows[1].a == [{"q": 1}]


def test_stages_keep_any_columns(spark, tmp_path):
    df = docs(spark, [(i, f"{WORDS} and then number {i} came along with w{i} x{i} y{i} z{i} to the end of the day") for i in range(8)])
    spark.createDataFrame([(1, "nothing of the kind in any text here")], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, df, str(tmp_path))
        assert out.schema.simpleString() == df.schema.simpleString(), name
        assert all(r["__id"] == 77 and r.m == {"k": r.doc_id} for r in out.collect()), name


def test_counts_by_any_key(spark):
    df = docs(spark, [(1, "one two"), (2, "one two three"), (3, None)])
    for by, column in ((["span"], "tokens"), (["tokens"], "tokens_"), (["tokens", "n_chars"], "tokens_"), (["c0"], "tokens")):
        hist = token_counts.histogram(df, by)
        table = token_counts.limits(hist, by)
        assert len(set(table.columns)) == len(table.columns) == len(by) + 6
        assert all(r[by[0]] in ("x", "y", "c") for r in table.collect())
        assert sorted(r[column] for r in table.collect()) == sorted(r[column] for r in hist.collect())


def test_truncated_totals_and_quantiles(spark):
    df = docs(spark, [(i, " ".join(["word"] * (i % 17))) for i in range(60)])
    hist = token_counts.histogram(df)
    lengths = [n for n, c in hist.collect() for _ in range(c)]
    table = token_counts.limits(hist)
    for limit in (0, 1, 5, 16, 99):
        assert token_counts.truncated_total(table, limit).first()[0] == sum(min(n, limit) for n in lengths)
    for share in (0.01, 0.25, 0.5, 0.9, 1.0):
        least = next(n for n in sorted(set(lengths)) if sum(x <= n for x in lengths) >= share * len(lengths))
        assert token_counts.quantile(table, share).first()[0] == least


def test_search_of_large_components(spark):
    rng = random.Random(3)
    vectors = [[rng.uniform(-1, 1) * 10 ** rng.choice([0, 3, 8, 12]) for _ in range(3)] for _ in range(60)]
    vectors += [[1e8, 1e8, 1.0], [1e30, 1.0, 0.0], [-1e30, 2.0, 1e30], [1e30, 1.0, 0.5]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vector_search.search(df, 5, F.pmod("vec_id", F.lit(10)) == 0).collect()))
    whole = [[max(-(1 << 55), min(1 << 55, int(np.floor(np.float64(x) * 256)))) for x in v] for v in vectors]
    expected = []
    for q in range(0, len(vectors), 10):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)
        expected += [(q, r, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, i) in enumerate(scores[:5], 1)]
    assert got == sorted(expected)


def test_short_items_at_word_borders(spark):
    df = docs(spark, [(1, "see Zyx Qwert, and more"), (2, "xzyx qwert"), (3, "zyx qwerty"), (4, "ZYX QWERT"),
                      (5, None), (6, "(zyx qwert) xzyx qwert"), (7, "zyx qwers"), (8, "zyxqwert")])
    bench = spark.createDataFrame([(1, "zyx qwert"), (2, "the"), (3, "8 chars!")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.edits, r.start, r.end) for r in decontamination.matches(df, bench).collect())
    assert got == [(1, 1, 0, 4, 13), (4, 1, 0, 0, 9), (6, 1, 0, 1, 10)]
    assert {r.doc_id for r in decontamination.clean(df, bench).collect()} == {2, 3, 5, 7, 8}


def test_matcher_on_repeated_grams_is_bounded():
    item, text = "-" * 80, "-" * 400_000
    matcher = decontamination.Matcher([item, "a" * 30 + "b" * 30], 0.1)
    tracemalloc.start()
    found = matcher.search([text, "x " + "a" * 30 + "b" * 30])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {(0, 0): (0, 0, 80), (1, 1): (0, 2, 62)} and peak < 500 << 20


def test_slices_lose_no_occurrence(monkeypatch):
    rng = random.Random(9)
    items = ["".join(rng.choice("ab c") for _ in range(rng.randrange(24, 90))) for _ in range(20)]
    texts = []
    for _ in range(30):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            some = list(rng.choice(items))
            for _ in range(rng.randrange(4)):
                some[rng.randrange(len(some))] = "z"
            parts += ["".join(rng.choice("ab c") for _ in range(rng.randrange(300))), "".join(some)]
        texts.append("".join(parts))
    whole = decontamination.Matcher(items, 0.1).search(texts)
    monkeypatch.setattr(decontamination, "HITS", 50)
    assert decontamination.Matcher(items, 0.1).search(texts) == whole and whole
