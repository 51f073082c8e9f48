"""Licence statements in documents, by a trained paragraph classifier.

A text's lines are its paragraphs; a line of more than ``WINDOW`` words is read in overlapping
windows of that many.  Features are words and pairs of neighbouring words, as shares of the
window's words, of those that occur in the licence texts (``license_texts``); all other words
only count into the length.  Multinomial logistic regression over the licence families and the
class of everything else is trained on the licence texts, whole, cropped and with words left
out, and on short notices (frames like "distributed under the terms of" around a licence's names,
and around what is none), alone and between other words, against ``NEGATIVE_LINES`` lines at most from the ``NEGATIVE_DOCS`` documents with the
least hashed ids and hand-written look-alikes (a bounded sample, drawn alike from any corpus;
lines that resemble a licence text are left out of it).  A fifth of the examples is kept from
the fit; a temperature that makes the probabilities right on these is divided out, so that a
family's probability can be read as such: below ``PROBABILITY`` a window stays unknown.

A prediction is confirmed by comparison with the family's texts: the share of the most similar
text's word pairs that the window holds, and the share of the window's pairs that any text of
the family holds, must both reach ``SIMILARITY``, the latter over the best stretch of the
window of that text's length.  The short notices are compared alike, and the window must hold the
licence's name whole.  Versions count as one word, "licence" as "license".

A short statement is a small share of a longer window, which then looks like everything else.
So a window is also read in stretches of the notices' own lengths (``SHORT``, by a quarter of
the length), cut to their first and last pair of neighbours from the licence texts and
classified and confirmed alike; those with fewer such pairs than any confirmation needs are
left out.  A statement found so counts unless the window that holds it has its family already,
or it overlaps a statement of its line that is as similar or more.

Null and empty texts, and lines without words, match nothing; repeated rows match alike; a null
id is returned as null; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, map_batches
from tidemark.llm.license_texts import DEDICATIONS, FRAMES, NAMES, NO_NAMES, OTHER, TEMPLATES

WINDOW = 80
STEP = 40
#: Words of the shorter stretches that are classified too.
SHORT = (8, 16, 40)
NEGATIVE_DOCS = 200
NEGATIVE_LINES = 2000
COPIES = 72
PROBABILITY = 0.5
SIMILARITY = 0.6
NONE = "none"
#: Words scored at a time.
PART = 200_000

_words = re.compile(r"[^\W_]+(?:\.\d+)*")
#: "2.0" and "v3" are versions, "gplv3" and "gpl3" names with one; neither changes the number of words.
_versions = re.compile(r"(?<![^\W_])(?:v?|([a-z]{3,4})v?)[0-9]+(?:\.[0-9]+)*(?![^\W_])")


def words_of(line: str) -> list[str]:
    line = _versions.sub(lambda m: m[1] or "0", line.lower())
    return _words.findall(line.replace("licence", "license"))


def windows(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(line, first word, words) of every window of a text."""
    for n, line in enumerate(text.split("\n")):
        words = words_of(line)
        if len(words) <= WINDOW:
            if words:
                yield n, 0, words
            continue
        for at in range(0, len(words) - WINDOW + STEP, STEP):
            yield n, at, words[at:at + WINDOW]


def _pairs(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


def short_notices(family: str) -> list[tuple[str, str]]:
    """(notice, the name in it) of every frame and name."""
    named = [(frame.format(name), name) for name in NAMES[family] for frame in FRAMES]
    return named + [(d, "") for d in DEDICATIONS] if family == "public domain" else named


def _known(text: str, name: str) -> tuple[list[str], frozenset, str]:
    words = words_of(text)
    return words, frozenset(_pairs(words)), " ".join(words_of(name))


#: By family: words, pairs and name (empty: none is asked for) of what a window is compared with.
KNOWN = {family: [_known(t, "") for t in texts] + [_known(t, n) for t, n in short_notices(family)]
         for family, texts in TEMPLATES.items()}


def best_stretch(words: list[str], family: str) -> tuple[float, int, int]:
    """How much of a family's most similar text the words hold, and it of them; from and to which word."""
    best, where = 0.0, (0, len(words))
    own = _pairs(words)
    distinct, line = set(own), f" {' '.join(words)} "
    for known, pairs, name in KNOWN[family]:
        held = len(pairs & distinct) / len(pairs)
        if held <= best or f" {name} " not in line and name:
            continue
        inside = [p in pairs for p in own]
        size = min(len(inside), len(known) - 1)
        most = now = sum(inside[:size])
        at = 0
        for i in range(size, len(inside)):
            now += inside[i] - inside[i - size]
            if now > most:
                most, at = now, i - size + 1
        alike = min(held, most / size if size else 0.0)
        if alike > best:
            best, where = alike, (at, at + size + 1)
    return best, *where


def similarity(words: list[str], family: str) -> float:
    return best_stretch(words, family)[0]


#: Fewest pairs of neighbours that confirm any text.
LEAST_PAIRS = min(math.ceil(SIMILARITY * len(pairs)) for known in KNOWN.values() for _, pairs, _ in known)


@dataclass
class Found:
    doc: int
    line: int
    word: int
    family: str
    probability: float
    similarity: float
    stretch: tuple[int, int]             # words of the line
    window: tuple[int, int] | None       # the same of the window; None: found in a shorter stretch


def settled(found: list[Found]) -> list[Found]:
    """One of those that tell of the same statement, in the order of documents and lines."""
    lines: dict[tuple[int, int], list[Found]] = {}
    for f in found:
        lines.setdefault((f.doc, f.line), []).append(f)
    out = []
    for some in lines.values():
        kept = [f for f in some if f.window]
        for f in sorted((f for f in some if not f.window), key=lambda f: (-f.similarity, -f.probability, f.word)):
            a, b = f.stretch
            if not any((a < k.stretch[1] and k.stretch[0] < b)
                       or (k.window and k.family == f.family and k.window[0] <= a and b <= k.window[1]) for k in kept):
                kept.append(f)
        out += sorted(kept, key=lambda f: f.word)
    return out


@dataclass
class Classifier:
    classes: list[str]                   # the families, then NONE
    words: dict[str, int]                # 1 and up; 0: any other word
    pairs: np.ndarray                    # sorted, first word's number times len(words) + 1 plus the second's
    weights: np.ndarray                  # words', then pairs', then the bias; a column for each class
    temperature: float = 1.0

    def known(self, texts: list[list[str]]) -> tuple[np.ndarray, ...]:
        """Of the texts' words in a row: each text's size, each word's text and number, and the places
        and numbers of the known pairs."""
        sizes = np.array([len(t) for t in texts])
        ids = np.fromiter((self.words.get(w, 0) for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
        row = np.repeat(np.arange(len(texts)), sizes)
        first = ids[:-1] * (len(self.words) + 1) + ids[1:]
        pair = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0) & (row[:-1] == row[1:]))
        found = np.minimum(np.searchsorted(self.pairs, first[pair]), max(len(self.pairs) - 1, 0))
        there = self.pairs[found] == first[pair]
        return sizes, row, ids, pair[there], found[there]

    def features(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, feature, value), feature numbers below len(weights) - 1."""
        sizes, row, ids, pair, number = self.known(texts)
        at = np.flatnonzero(ids)
        rows = np.concatenate([row[at], row[pair]])
        return rows, np.concatenate([ids[at] - 1, len(self.words) + number]), 1.0 / sizes[rows]

    def stretches(self, texts: list[list[str]]) -> list[tuple[int, int, int]]:
        """(text, from, to): the shorter stretches that a notice may fill."""
        sizes, _, ids, pair, _ = self.known(texts)
        starts = np.cumsum(sizes) - sizes
        before = np.zeros(len(ids) + 1, dtype=np.int64)           # known pairs before each word
        before[pair + 1] = 1
        before = np.cumsum(before)
        out = []
        for size in SHORT:
            step = size // 4
            n = np.where(sizes > size, -(-(sizes - size) // step) + 1, 0)
            text = np.repeat(np.arange(len(texts)), n)
            lo = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * step
            hi = np.minimum(lo + size, sizes[text])
            a, b = before[starts[text] + lo], before[starts[text] + hi - 1]
            some = np.flatnonzero(b - a >= LEAST_PAIRS)
            text, a, b = text[some], a[some], b[some]
            out.append(np.stack([text, pair[a] - starts[text], pair[b - 1] + 2 - starts[text]], axis=1))
        return list(map(tuple, np.unique(np.concatenate(out), axis=0).tolist()))

    def probabilities(self, texts: list[list[str]]) -> np.ndarray:
        rows, feature, value = self.features(texts)
        score = np.tile(self.weights[-1], (len(texts), 1))
        np.add.at(score, rows, self.weights[feature] * value[:, None])
        return _softmax(score / self.temperature)

    def find(self, text: str | None) -> list[tuple[int, int, str, float, float]]:
        """(line, first word, family, probability, similarity) of every statement."""
        found, some, held = [], [], 0
        for window in windows(text or ""):
            some.append((0, *window))
            held += len(window[2])
            if held >= PART:
                found += self.find_all(some)
                some, held = [], 0
        return [(f.line, f.word, f.family, f.probability, f.similarity) for f in settled(found + self.find_all(some))]

    def find_all(self, some: list[tuple[int, int, int, list[str]]]) -> list[Found]:
        """What the windows (document, line, first word, words) and their shorter stretches state."""
        if not some:
            return []
        out = [Found(*some[i][:3], family, p, alike, (some[i][2] + a, some[i][2] + b),
                     (some[i][2], some[i][2] + len(some[i][3])))
               for i, family, p, alike, a, b in self._confirmed([w[3] for w in some])]
        short = self.stretches([w[3] for w in some])
        for i, family, p, alike, a, b in self._confirmed([some[w][3][lo:hi] for w, lo, hi in short]):
            w, lo, _ = short[i]
            at = some[w][2] + lo
            out.append(Found(*some[w][:2], at, family, p, alike, (at + a, at + b), None))
        return out

    def _confirmed(self, texts: list[list[str]]) -> Iterator[tuple[int, str, float, float, int, int]]:
        if not texts:
            return
        p = self.probabilities(texts)
        best = np.argmax(p, axis=1)
        for i in np.flatnonzero((best < len(self.classes) - 1) & (p.max(axis=1) >= PROBABILITY)).tolist():
            family = self.classes[best[i]]
            alike, a, b = best_stretch(texts[i], family)
            if alike >= SIMILARITY:
                yield i, family, float(p[i, best[i]]), alike, a, b


def _softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(negatives: list[str]) -> tuple[list[list[str]], list[int]]:
    """Windows and their classes: the texts whole, cropped and thinned, and everything else."""
    rng = np.random.default_rng(7)
    texts, labels = [], []
    for c, family in enumerate(TEMPLATES):
        for text in TEMPLATES[family]:
            words = words_of(text)
            for k in range(COPIES):
                some = words
                if k:
                    keep = rng.random(len(words)) >= (0.0 if k % 2 else 0.08)
                    some = [w for w, x in zip(words, keep) if x]
                    if len(some) > 12 and k % 3 == 0:
                        a = int(rng.integers(0, len(some) // 3))
                        some = some[a:a + int(rng.integers(len(some) // 2, len(some)))]
                if some:
                    texts.append(some[:WINDOW])
                    labels.append(c)
        for notice, _ in short_notices(family):
            for k in (0, 3, 9):                      # alone, and between words of no weight
                words = words_of(notice)
                front = int(rng.integers(0, k + 1))
                texts.append([""] * front + words + [""] * (k - front))
                labels.append(c)
    for line in [*OTHER] * 4 + [f.format(n) for f in FRAMES for n in NO_NAMES] + negatives:
        for _, _, words in windows(line):
            texts.append(words)
            labels.append(len(TEMPLATES))
    return texts, labels


def fit(negatives: list[str]) -> Classifier:
    """Trains on the licence texts against ``negatives`` (lines)."""
    licence = [known for texts in KNOWN.values() for known, _, _ in texts]
    words = {w: i for i, w in enumerate(sorted({w for t in licence for w in t}), 1)}
    pairs = np.array(sorted({words[a] * (len(words) + 1) + words[b] for t in licence for a, b in _pairs(t)}))
    classes = [*TEMPLATES, NONE]
    model = Classifier(classes, words, pairs, np.zeros((len(words) + len(pairs) + 1, len(classes))))
    texts, labels = _examples(negatives)
    rows, feature, value = model.features(texts)
    x = np.zeros((len(texts), len(model.weights)), dtype=np.float32)
    np.add.at(x, (rows, feature), value)
    x[:, -1] = 1
    y = np.zeros((len(texts), len(classes)), dtype=np.float32)
    y[np.arange(len(texts)), labels] = 1
    weight = (1 / np.maximum(y.sum(axis=0), 1))[labels].astype(np.float32)[:, None]        # classes count alike
    weight = np.where(np.array(labels)[:, None] == len(classes) - 1, weight * len(classes), weight) * 100
    fitted = np.arange(len(texts)) % 5 != 0
    xf, yf, wf = x[fitted], y[fitted], weight[fitted]
    w, speed = np.zeros_like(model.weights, dtype=np.float32), np.zeros_like(model.weights, dtype=np.float32)
    rate = 0.5 / float((wf * xf ** 2).sum(axis=1).sum() / len(xf) + 1e-3) * 0.2
    for _ in range(300):                                                                # gradient with momentum
        g = xf.T @ (wf * (_softmax(xf @ w) - yf)) / 100 + 1e-4 * w
        speed = 0.95 * speed - rate * g
        w += speed
    model.weights = w.astype(np.float64)
    score, held = x[~fitted] @ w, np.array(labels)[~fitted]
    loss = lambda t: -np.log(_softmax(score / t)[np.arange(len(held)), held] + 1e-12).mean()
    model.temperature = min((math.exp(k / 8) for k in range(-24, 17)), key=loss)
    return model


def negatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Lines of ``NEGATIVE_DOCS`` documents (of each, the first 20,000 characters) that resemble no
    licence text: a sample to train on; ``scan`` reads all texts whole."""
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))
    least = rows.select("h").orderBy("h").limit(NEGATIVE_DOCS).collect()      # the hashes first, then their texts
    if not least:
        return []
    sample = rows.filter(F.col("h") <= least[-1].h).orderBy("h", F.xxhash64("text")).limit(NEGATIVE_DOCS).select(
        F.substring("text", 1, 20_000).alias("text")).collect()
    lines = [line for r in sample for line in r.text.split("\n")][:NEGATIVE_LINES]
    alike = lambda words: max(similarity(words, f) for f in TEMPLATES)
    return [line for line in lines if (words := words_of(line)) and alike(words) < SIMILARITY / 2]


def scan(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, word, family, probability, similarity, paragraph) of every statement."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, doc = b.column("text").to_pylist(), b.column("doc_id").to_pylist()
            some: list[tuple[int, int, int, list[str]]] = []
            found: list[Found] = []
            held = 0
            for i, text in enumerate(texts):
                for window in windows(text or ""):
                    some.append((i, *window))
                    held += len(window[2])
                    if held >= PART:
                        found += sent.value.find_all(some)
                        some, held = [], 0
            found = settled(found + sent.value.find_all(some))
            yield batch(doc_id=pa.array([doc[f.doc] for f in found], pa.int64()),
                        line=pa.array([f.line for f in found], pa.int32()),
                        word=pa.array([f.word for f in found], pa.int32()),
                        family=pa.array([f.family for f in found], pa.string()),
                        probability=pa.array([f.probability for f in found], pa.float64()),
                        similarity=pa.array([f.similarity for f in found], pa.float64()),
                        paragraph=pa.array([texts[f.doc].split("\n")[f.line] for f in found], pa.string()))

    return map_batches(rows, run, "doc_id long, line int, word int, family string, probability double, "
                                  "similarity double, paragraph string")
