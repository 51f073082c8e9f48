"""Language identification by interpolated Kneser-Ney character models.

A text is lower-cased and cut into runs of letters; each run is a word, a space before and
after it.  A language's model gives each letter, and the space that ends the word, a
probability after up to ``ORDER`` - 1 characters of the word before it.

Training.  Tasks count the words of their documents by language and turn the distinct ones
into 64-bit hashes of their n-grams, so a task sends each n-gram once, however often it
occurs.  Counts, continuation counts, counts of counts and context sums are aggregated over
all training documents.  An n-gram is kept if it has at least ``SHARE`` of its language's
characters, which bounds a model to 1 / ``SHARE`` n-grams for each order whatever the corpus;
what is cut off goes to the shorter context, so each context's probabilities still sum to 1.
Only that bounded model reaches the driver, as sorted arrays of hashes with log-probabilities.

Prediction.  The language with the lowest cross-entropy per character.  Documents with
remainder ``CALIBRATED`` are kept out of the counts; from them come a logistic fit of being
right on the lead over the second language (``score``, over a histogram), and each language's
mean and deviation of the cross-entropy: a text that lies more than ``DEVIATIONS`` above the
mean, its length taken into account, is rejected.

Null texts and texts without a letter give ``und``, score 0, and are rejected, as is every text
if no labelled text was there to learn from; a null id counts as the empty text and is held
out; null languages are not learned from; repeated rows count each; an empty table gives no
row; extra columns are ignored (``accepted`` keeps them).  Long texts are read in parts that
end between words (a word longer than a part is read as several).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch, map_batches, written

ORDER = 4
SHARE = 5e-6
FOLDS, HELD_OUT, CALIBRATED = 5, 0, 1
DEVIATIONS = 12.0
UNKNOWN = "und"
#: Characters of a text read at a time, and distinct words that a task holds.
PART = 1 << 20
WORDS = 200_000
#: Characters scored at a time, or one part.
TOGETHER = 1 << 18

U = np.uint64
#: What ``isalpha`` holds for: without the digits and numbers that are no decimals, as in "m²" and "½".
_letters = re.compile(r"[^\W\d_%s]+" % "".join(c for c in map(chr, range(0x110000))
                                               if c.isnumeric() and not c.isalpha() and not c.isdecimal()))
_is_letter = np.array([chr(c).isalpha() for c in range(0x10000)])


def fold(id_col: Column) -> Column:
    """Remainder of the CRC-32 of an id as text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def parts_of(text: str | None) -> Iterator[str]:
    """A text in lower case, in parts that end between words."""
    text = text or ""
    at = 0
    while at < len(text):
        end = at + PART
        while end < len(text) and end - at < 2 * PART and text[end].isalpha():
            end += 1
        yield text[at:end].lower()
        at = end


def symbols(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, part of each) of all words of some parts: a space, then each word and a space."""
    codes = np.frombuffer((" ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
    letter = _is_letter[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        kinds, at = np.unique(codes[high], return_inverse=True)
        letter[high] = np.array([chr(c).isalpha() for c in kinds.tolist()])[at]
    keep = letter.copy()
    keep[1:] |= letter[:-1]                                    # what follows a word ends it
    codes = np.where(letter, codes, 32)[keep].astype(U)
    return np.concatenate([[U(32)], codes]), np.concatenate([[-1], of[keep]])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def depths(codes: np.ndarray) -> np.ndarray:
    """For each symbol but the first, how many symbols of its word are before it, the space included."""
    at = np.arange(len(codes))
    return at[1:] - np.maximum.accumulate(np.where(codes == 32, at, 0))[:-1]


def unmixed(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For 0 to ``order``: the sum that hashes the so many symbols that end at each symbol."""
    power, sums = U(1), [np.zeros(len(codes), dtype=U)]
    for k in range(1, order + 1):
        longer = sums[-1].copy()
        longer[k - 1:] += (codes[:len(codes) - k + 1] + U(1)) * power
        power = U(int(power) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        sums.append(longer)
    return sums


# -- training -------------------------------------------------------------------

COUNTS = "lang string, order int, gram long, context long, shorter long, starts boolean, n long"


def _counts(docs: DataFrame, order: int) -> DataFrame:
    """N-gram counts of ``docs`` (lang, text), as far as each task gets with ``WORDS`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in seen.items():
                codes = np.frombuffer((" " + " ".join(counter) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(U)
                word = np.cumsum(codes == 32)[:-1] - 1
                times = np.fromiter(counter.values(), dtype=np.int64, count=len(counter))[word]
                depth, sums = depths(codes), unmixed(codes, order)
                for k in range(1, order + 1):
                    valid = np.flatnonzero(depth >= k - 1)
                    gram, first, of = np.unique(_mixed(sums[k][1:][valid] + U(k)), return_index=True, return_inverse=True)
                    at = valid[first]
                    yield batch(lang=pa.array([lang] * len(gram), pa.string()),
                                order=np.full(len(gram), k, dtype=np.int32), gram=gram.view(np.int64),
                                context=_mixed(sums[k - 1][at] + U(k - 1)).view(np.int64),
                                shorter=_mixed(sums[k - 1][at + 1] + U(k - 1)).view(np.int64),
                                starts=depth[at] == k - 1,
                                n=np.bincount(of, weights=times[valid], minlength=len(gram)).astype(np.int64))
            seen.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                for part in parts_of(text):
                    seen.setdefault(lang, Counter()).update(_letters.findall(part))
                    if sum(map(len, seen.values())) > WORDS:
                        yield from flush()
        yield from flush()

    return map_batches(docs.select("lang", "text"), run, COUNTS)


class SortedHashes:
    """A sorted array of hashes, with where each run of equal leading bits starts in it."""

    BITS = 16

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.start = np.searchsorted(hashes, np.arange(1 << self.BITS, dtype=U) << U(64 - self.BITS))
        self.start = np.append(self.start, len(hashes)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        run = (wanted >> U(64 - self.BITS)).astype(np.int32)
        at, end = self.start[run], self.start[run + 1]
        out = np.full(len(wanted), -1, dtype=np.int32)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = self.hashes[at[open_]]
            same = here == wanted[open_]
            out[open_[same]] = at[open_[same]]
            at[open_] += 1
            open_ = open_[(here < wanted[open_]) & (at[open_] < end[open_])]
        return out


@dataclass
class Model:
    langs: list[str]
    order: int
    grams: np.ndarray                   # sorted hashes of all orders
    logs: np.ndarray                    # their log2, a column for each language; a last row for symbols never seen
    contexts: np.ndarray
    backoffs: np.ndarray
    mean: np.ndarray | None = None      # of the cross-entropy, by language; its deviation, and that of one symbol
    spread: np.ndarray | None = None
    noise: np.ndarray | None = None
    slope: float = 4.0
    offset: float = 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "lookups"}

    def lookup(self) -> tuple[SortedHashes, SortedHashes]:
        if "lookups" not in self.__dict__:                       # built once in each worker
            self.lookups = SortedHashes(self.grams), SortedHashes(self.contexts)
        return self.lookups

    def symbol_logs(self, codes: np.ndarray) -> np.ndarray:
        """log2-probability, by language, of each symbol but the first."""
        grams, contexts = self.lookup()
        sums = unmixed(codes, self.order)
        order = np.minimum(depths(codes) + 1, self.order)
        row = np.full(len(order), -1, dtype=np.int32)            # of ``logs``; the last for what was never seen
        left: list[tuple[np.ndarray, np.ndarray]] = []           # symbols whose context leaves something, its rows
        at = np.empty(0, dtype=np.int64)
        for k in range(self.order, 0, -1):                       # what has, or is left with, k - 1 symbols before it
            at = np.concatenate([at, np.flatnonzero(order == k)])
            place = grams.find(_mixed(sums[k][at + 1] + U(k)))
            row[at] = place
            at = at[place < 0]
            place = contexts.find(_mixed(sums[k - 1][at] + U(k - 1)))
            left.append((at[place >= 0], place[place >= 0]))
        out = np.take(self.logs, row, axis=0, mode="wrap")
        for mine, place in left:
            out[mine] += self.backoffs[place]
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy in bits per symbol by language, symbols) of each text."""
        total, chars = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64)
        parts: list[str] = []
        of: list[int] = []
        held = 0

        def settle() -> None:
            codes, part = symbols(parts)
            if len(codes) > 1:
                logs, part = self.symbol_logs(codes), part[1:]
                heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                mine = np.array(of)[part[heads]]
                np.add.at(total, mine, np.add.reduceat(logs, heads, axis=0))
                np.add.at(chars, mine, np.diff(np.append(heads, len(part))))

        for i, text in enumerate(texts):
            for part in parts_of(text):
                parts.append(part), of.append(i)
                held += len(part)
                if held >= TOGETHER:
                    settle()
                    parts, of, held = [], [], 0
        if parts:
            settle()
        return -total / np.maximum(chars, 1)[:, None], chars

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, rejected, cross-entropy) of each text."""
        if not self.langs:
            return ([UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool), np.zeros(len(texts)))
        bits, chars = self.entropies(texts)
        best, least, lead = leads(bits, chars)
        score = 1 / (1 + np.exp(-np.clip(self.slope * lead + self.offset, -30, 30)))
        score = np.where(chars > 0, score, 0.0)
        rejected = chars == 0
        if self.mean is not None:
            limit = self.mean[best] + DEVIATIONS * (self.spread[best] + self.noise[best] / np.sqrt(np.maximum(chars, 1)))
            rejected |= least > limit
        return [self.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), chars.tolist())], score, rejected, least


def leads(bits: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language, its cross-entropy, its lead over the second in deviations of a mean)."""
    best = np.argmin(bits, axis=1)
    ordered = np.sort(bits, axis=1)
    second = ordered[:, 1] if bits.shape[1] > 1 else ordered[:, 0] + 1.0
    return best, ordered[:, 0], (second - ordered[:, 0]) * np.sqrt(np.maximum(chars, 1))


def _model(counted: DataFrame, order: int, share: float) -> Model:
    """The Kneser-Ney model of aggregated counts."""
    keys = ["lang", "order", "gram"]
    more = counted.filter("order > 1").groupBy("lang", (F.col("order") - 1).alias("order"),
                                               F.col("shorter").alias("gram")).agg(F.count(F.lit(1)).alias("cont"))
    # the longest n-grams, and those that start a word, have nothing before them to be counted
    m = F.when((F.col("order") == order) | F.col("starts"), F.col("n")).otherwise(F.coalesce("cont", "n"))
    mod = written(counted.join(more, keys, "left").withColumn("m", m).drop("cont", "starts"), "modified-counts")
    stats = mod.groupBy("lang", "order").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"),
        F.sum((F.col("m") == 1).cast("long")).alias("n1"), F.sum((F.col("m") == 2).cast("long")).alias("n2")).collect()
    langs = sorted({r.lang for r in stats})
    of = {(r.lang, r.order): r for r in stats}
    discount = {k: min(max(r.n1 / (r.n1 + 2 * r.n2) if r.n1 and r.n2 else 0.5, 0.1), 0.95) for k, r in of.items()}
    if not langs:
        return Model([], order, *[np.empty(0)] * 4)
    of_row = F.create_map(*[F.lit(x) for k, r in of.items() for x in (f"{k[1]} {k[0]}", float(discount[k]))])
    least = F.create_map(*[F.lit(x) for lang in langs for x in (lang, float(share * of[lang, 1].n))])
    sums = mod.groupBy("lang", "order", "context").agg(F.sum("m").alias("all"))
    # at most 1 / share n-grams for each language and order
    kept_all = mod.filter(F.col("n") >= least[F.col("lang")]).join(sums, ["lang", "order", "context"]).select(
        "lang", "order", "gram", "context", "shorter",
        ((F.col("m") - of_row[F.concat_ws(" ", F.col("order").cast("string"), "lang")]) / F.col("all")).alias("p"))
    kept_all = kept_all.toPandas()
    alphabet = np.array([of[lang, 1].kinds + 1 for lang in langs], dtype=np.float64)
    number = {lang: x for x, lang in enumerate(langs)}
    orders: list[tuple[np.ndarray, np.ndarray]] = []          # sorted hashes, probabilities by language
    bows: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(1, order + 1):
        kept = kept_all[kept_all["order"] == k]
        lang = kept["lang"].map(number).to_numpy(np.int64)
        gram, context, shorter = (kept[c].to_numpy(np.int64).view(U) for c in ("gram", "context", "shorter"))
        gram, first, at = np.unique(gram, return_index=True, return_inverse=True)
        own = np.full((len(gram), len(langs)), 0.0)
        own[at, lang] = kept["p"].to_numpy()
        contexts, of_context = np.unique(context, return_inverse=True)
        gamma = np.ones((len(contexts), len(langs)))           # what a context leaves to the shorter one
        np.subtract.at(gamma, (of_context, lang), kept["p"].to_numpy())
        gamma = np.maximum(gamma, 1e-9)
        if k == 1:
            below = np.tile(1 / alphabet, (len(gram), 1))
        else:                                                  # kept, as it occurs at least as often
            below = orders[-1][1][np.searchsorted(orders[-1][0], shorter[first])]
        orders.append((gram, own + gamma[of_context[first]] * below))
        bows.append((contexts, gamma))

    def merged(tables: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.concatenate([h for h, _ in tables])
        by = np.argsort(hashes)
        return hashes[by], np.log2(np.concatenate([v for _, v in tables])[by])

    grams, logs = merged(orders)
    return Model(langs, order, grams, np.vstack([logs, -np.log2(alphabet)]), *merged(bows))


def train(docs: DataFrame, order: int = ORDER, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """Learns from the rows with a language whose fold isn't ``HELD_OUT``."""
    rows = docs.select(fold(F.col(id_col)).alias("fold"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and text is not null")
    counts = _counts(rows.filter(~F.col("fold").isin(HELD_OUT, CALIBRATED)), order)
    counted = written(counts.groupBy("lang", "order", "gram").agg(
        F.first("context").alias("context"), F.first("shorter").alias("shorter"), F.first("starts").alias("starts"),
        F.sum("n").alias("n")), "ngram-counts")
    model = _model(counted, order, share)
    if model.langs:
        _calibrate(model, rows.filter(F.col("fold") == CALIBRATED))
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            bits, chars = model.entropies(b.column("text").to_pylist())
            best, least, lead = leads(bits, chars)
            right = np.array([model.langs[x] == lang for x, lang in zip(best.tolist(), b.column("lang").to_pylist())],
                             dtype=bool)
            there = chars > 0
            yield batch(best=best[there].astype(np.int32), right=right[there], bits=least[there],
                        chars=chars[there].astype(np.float64),
                        bin=np.minimum(np.floor(lead[there] * 8), 400).astype(np.int32))

    seen = written(map_batches(rows.select("text", "lang"), run,
                               "best int, right boolean, bits double, chars double, bin int"), "calibration")
    bins = seen.groupBy("bin").agg(F.sum(F.col("right").cast("int")).alias("yes"),
                                   F.count(F.lit(1)).alias("n")).orderBy("bin").collect()     # 401 rows at most
    if bins:
        x = np.array([(r.bin + 0.5) / 8 for r in bins])
        yes = np.array([r.yes for r in bins], dtype=np.float64) + 0.5    # a right and a wrong one for each bin
        n = np.array([r.n for r in bins], dtype=np.float64) + 1.0
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            w = n * p * (1 - p) + 1e-9
            g = np.array([((yes - n * p) * x).sum() - 1e-3 * a, (yes - n * p).sum()])
            h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
            if abs(step).max() < 1e-9:
                break
        model.slope, model.offset = max(a, 0.0), b
    long = F.when(F.col("chars") >= 400, F.col("bits"))
    stats = {r.best: r for r in seen.filter("right").groupBy("best").agg(
        F.avg("bits").alias("mean"), F.stddev_pop(long).alias("spread"), F.stddev_pop("bits").alias("all")).collect()}
    langs = len(model.langs)
    overall = [r.mean for r in stats.values()]
    model.mean = np.array([stats[i].mean if i in stats else max(overall, default=math.inf) for i in range(langs)])
    wide = lambda i, c, least: max((getattr(stats[i], c) or 0.0) if i in stats else 0.0, least)
    model.spread = np.array([wide(i, "spread", 0.02) for i in range(langs)])
    model.noise = np.array([max(2.0, 10 * wide(i, "all", 0.02)) for i in range(langs)])


# -- prediction -----------------------------------------------------------------

def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected, bits) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col)) == HELD_OUT).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, rejected, bits = sent.value.decide(b.column("text").to_pylist())
            yield batch(doc_id=b.column("doc_id"), held_out=b.column("held_out"), lang_pred=pa.array(lang, pa.string()),
                        score=score, rejected=rejected, bits=bits)

    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, "
                                  "bits double")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is rejected."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rejected = sent.value.decide(b.column(at).to_pylist())[2]
            yield b.filter(pa.array(~rejected))

    return map_batches(docs, run, docs.schema)
