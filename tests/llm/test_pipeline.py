"""The pipeline as a whole against a plain version of its five stages."""

import random
import zlib
from functools import cache

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, language_id, packing, tokens

from .test_llm import SF, slow_components, slow_fingerprint, slow_model, word_symbols


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def plain_languages(docs):
    """Rows whose best model doesn't find them far more surprising than it finds its own language."""
    of = {}
    for r in docs:
        if r.lang is not None and r.text is not None and fold(r.doc_id) > 1:
            of.setdefault(r.lang, []).append(r.text)
    models = {x: cache(slow_model(of[x], language_id.ORDER, language_id.SHARE)) for x in sorted(of)}
    order = language_id.ORDER
    seen = {}
    for at, r in enumerate(docs):
        grams = [w[max(0, k - order + 1):k + 1] for w in word_symbols(r.text) for k in range(1, len(w))]
        if grams:
            bits = {x: -sum(np.log2(p(g)) for g in grams) / len(grams) for x, p in models.items()}
            best = min(bits, key=bits.get)
            seen[at] = best, bits[best], len(grams)
    right = [(x, b, n) for at, (x, b, n) in seen.items()
             if docs[at].lang == x and fold(docs[at].doc_id) == 1]
    limits = {}
    for x in models:
        own = [(b, n) for y, b, n in right if y == x]
        mean = np.mean([b for b, _ in own])
        spread = max(0.02, np.std([b for b, n in own if n >= 400] or [0]))
        limits[x] = mean, spread, max(2.0, 10 * max(0.02, np.std([b for b, _ in own])))

    def stays(at):
        x, b, n = seen[at]
        mean, spread, noise = limits[x]
        return b <= mean + language_id.DEVIATIONS * (spread + noise / np.sqrt(n))

    return [r for at, r in enumerate(docs) if at in seen and stays(at)]


def plain_near_duplicates(docs):
    classes = slow_components([slow_fingerprint(r.text) for r in docs], [r.doc_id for r in docs])
    return [r for r, c in zip(docs, classes) if r.doc_id == c]


def plain_repeats(docs, length=50):
    """(doc_id, text) without the bytes that an earlier document has in a string of ``length``."""
    raws = sorted((r.doc_id, r.text.encode()) for r in docs)
    held, out = set(), []
    for d, raw in raws:
        grams = [raw[i:i + length] for i in range(len(raw) - length + 1)]
        gone = bytearray(len(raw))
        for i, g in enumerate(grams):
            if g in held:
                gone[i:i + length] = b"\1" * length
        held.update(grams)
        text = bytes(x for x, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if text or not raw:
            out.append((d, text))
    return out


def plain_benchmark_free(docs, items):
    """Rows no stretch of which is within the allowed edits of an item."""
    allowed = decontamination.Matcher(items, 0.1).edits
    gap = "\0" * (int(max(allowed)) + 2)
    joined = np.frombuffer(gap.join(t.lower() for _, t in docs).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t.lower()) + len(gap) for _, t in docs])
    places, hit = np.arange(len(joined) + 1, dtype=np.int32), set()
    for item, most in zip(items, allowed):
        row = np.zeros(len(joined) + 1, dtype=np.int32)
        for i, c in enumerate(item.lower(), 1):
            new = row + 1
            new[0] = i
            np.minimum(new[1:], row[:-1] + (joined != ord(c)), out=new[1:])
            row = np.minimum.accumulate(new - places) + places           # text characters that the item lacks
        hit |= set(np.searchsorted(ends, np.flatnonzero(row[1:] <= most), side="right").tolist())
    return [r for at, r in enumerate(docs) if at not in hit]


def test_pipeline_matches_a_plain_version(spark, tmp_path):
    rng = random.Random(3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.col("text").isNull() | (F.length("text") < 8000))
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    texts = [r.text for r in docs.filter("lang = 'en' and length(text) > 900").orderBy("doc_id").collect()]
    bad = ["".join(rng.choice("qxzjvkwyß ") for _ in range(900)), "Ωμέγα και άλφα " * 60, "12 34 ½", "", None]
    words = texts[0].split()
    rng.shuffle(words)
    planted = [*bad, texts[1], f"{' '.join(words[:150])} {items[0]} {' '.join(words[150:])}",
               f"{' '.join(reversed(words))} {texts[2][100:700]}"]
    ids = range(1_000_000, 1_000_000 + len(planted))
    more = spark.createDataFrame([(i, t, None, "planted", 0) for i, t in zip(ids, planted)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    more = more.select(*[F.col(f.name).cast(f.dataType) for f in docs.schema])
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    there = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    known = plain_languages(there)
    assert not {r.doc_id for r in known} & set(ids[:len(bad)]) and len(known) >= 0.99 * (len(there) - len(bad))
    single = plain_near_duplicates(known)
    cut = plain_repeats(single)
    clean = plain_benchmark_free(cut, items)
    assert len(known) > len(single) and sum(len(r.text) for r in single) > sum(len(t) for _, t in cut) and len(cut) > len(clean)
    expected = []
    for d, text in clean:
        tokens_of = tokens.reference_encoder()(text) + [2]
        for k, (start, n) in enumerate(packing.cut(len(tokens_of), 1024)):
            expected.append((d, k, start, n, zlib.crc32(np.array(tokens_of[start:start + n], "<u4").tobytes())))

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    assert ids[5] not in {r.doc_id for r in got} and ids[6] not in {r.doc_id for r in got} and ids[7] in {r.doc_id for r in got}
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in map(sorted, places.values()):
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 1024
