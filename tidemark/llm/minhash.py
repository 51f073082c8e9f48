"""MinHash near-duplicates by SuperMinHash, bands, verification on full sets and union-find.

A document is the set of its distinct word shingles (A-Z lower-cased, words split at ASCII
white space, joined by one space; fewer words than a shingle: the whole sequence; none: the
empty set, which links with nothing).  A shingle stands for itself by its 64-bit hash, a set by
128 bits of the hash of its sorted shingles, so copies collapse into one set.

Signature: each shingle draws a permutation of the ``REGISTERS`` registers; at step j it
offers j + r, r in [0, 1), to the j-th register of its permutation, and a register keeps the
least offer.  The ranks of one shingle are so correlated (all different), which lowers the variance
against independent minima.  The permutation is j -> a j + b modulo the prime number of
registers, in which any two registers get any two ranks equally often, as the variance needs.
An offer of step j is less than any of a later step, so a set stops once its registers are
full: after a few steps for a text of some length.

Bands: ``BANDS`` x ``ROWS`` registers; sets that agree on a band share a bucket.  A link at the
threshold of 0.85 is in no bucket with probability (1 - 0.85^5)^30 = 2e-8, one above it with less.

Verification, twice, always on full sets.  First each member of a bucket against the bucket's
hub, its smallest key: links that settle nearly all of a group of copies.  Union-find over the links
found gives components.  Then, in buckets whose other members still lie in several
components, every pair from different ones: the members of the largest component and the others are
dealt into blocks of bounded size, and pairs of blocks with at least one of the others are
compared, each pair in a task of its own.  Buckets of the same members are compared once.  A
task unites what it links as it goes, skips pairs that it has united already, and emits a
spanning forest: rows grow with the members, never with their pairs.

Null and empty texts are empty sets, each a component of its own; repeated rows are
copies; a null doc_id counts only where a component has no other id; an empty table gives no
row; other columns are ignored, whatever their names.  Texts of any length are hashed in pieces of
bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, batch, map_batches, sliced, texts, written
from tidemark.llm.graph import components

SHINGLE = 5
#: A link: ``THRESHOLD[1]`` * intersection >= ``THRESHOLD[0]`` * union.
THRESHOLD = (85, 100)
#: A prime; 30 bands of 5 registers, one is left over.
REGISTERS, BANDS, ROWS = 151, 30, 5
#: Members and shingles in one block of a bucket.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Bytes of text hashed at once, and in one batch.
PIECE = 1 << 21

U = np.uint64
EMPTY = U(0xFFFFFFFFFFFFFFFF)
SPACE = re.compile(rb"[\x20\x09-\x0D]")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(9, 14)]] = True


# -- sets ------------------------------------------------------------------------

def _words(raw: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text, lower-cased and joined by one space; where each starts and ends."""
    b = np.frombuffer(raw, np.uint8)
    word = ~_IS_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return b"", starts, ends
    keep = word
    keep[starts[1:] - 1] = True                       # one of the spaces before each word
    joined = _LOWER[b[keep]]
    sizes = ends - starts + 1
    stops = np.cumsum(sizes) - 1
    joined[stops[:-1]] = 0x20
    return joined.tobytes(), stops - sizes + 1, stops


def shingles(raw: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles, taken in pieces of ``PIECE`` bytes."""
    from xxhash import xxh64_intdigest as digest

    found, carry, at = [], b"", 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):                            # a piece ends with a word
            gap = SPACE.search(raw, end)
            end = gap.start() if gap else len(raw)
        joined, starts, stops = _words(carry + b" " + raw[at:end])
        at = end
        n = len(starts) - width + 1
        if n > 0:
            a, b = starts[:n].tolist(), stops[width - 1:].tolist()
            found.append(np.unique(np.fromiter((digest(joined[i:j]) for i, j in zip(a, b)), U, n)))
            carry = joined[starts[n]:] if width > 1 else b""
        else:
            carry = joined
    if not found:
        return np.array([digest(carry)] if carry else [], U)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def key(members: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(members.tobytes())


# -- signatures ------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def signatures(members: np.ndarray, owner: np.ndarray, sets: int) -> np.ndarray:
    """SuperMinHash signatures (sets x REGISTERS) of ``sets`` sets: ``members`` are hashes,
    ``owner`` the set of each.  The highest byte of a register is its step, the rest r."""
    out = np.full((sets, REGISTERS), EMPTY)
    flat, m = out.reshape(-1), U(REGISTERS)
    a = U(1) + _mixed(members ^ U(0xA24BAED4963EE407)) % (m - U(1))
    place = _mixed(members ^ U(0x9FB21C651E98DF25)) % m
    h, base = members, owner.astype(np.int64) * REGISTERS
    for step in range(REGISTERS):
        slot = base + place.astype(np.int64)
        free = flat[slot] == EMPTY                    # what is taken, is taken by less
        offer = _mixed(h[free] + U((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> U(8)
        np.minimum.at(flat, slot[free], offer | U(step << 56))
        place = (place + a) % m
        still = (out == EMPTY).any(axis=1)[base // REGISTERS]
        if not still.all():                           # full registers end a set
            h, a, place, base = h[still], a[still], place[still], base[still]
            if not len(h):
                break
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A bucket (sets x BANDS) for each band."""
    cut = signature[:, :BANDS * ROWS].reshape(len(signature), BANDS, ROWS)
    bucket = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U) * U(0x9E3779B97F4A7C15), cut.shape[:2])
    for r in range(ROWS):
        bucket = _mixed(bucket ^ cut[:, :, r]) + U(0x9E3779B97F4A7C15)
    return bucket


def _signed(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, h, key, n, buckets) of ``rows`` (doc_id, h, raw); key null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in sliced(b.column("raw"), PIECE):
                part = b.slice(i, j - i)
                sets = [shingles(raw.as_py(), width) for raw in part.column("raw")]
                sizes = np.array([len(s) for s in sets])
                there = np.flatnonzero(sizes)
                buckets = np.zeros((0, BANDS), U)
                if len(there):
                    buckets = bands(signatures(np.concatenate([sets[k] for k in there]),
                                               np.repeat(np.arange(len(there)), sizes[there]), len(there)))
                ends = np.cumsum(np.where(sizes > 0, BANDS, 0))
                yield batch(doc_id=part.column("doc_id"), h=part.column("h"),
                            key=pa.array([key(s) if len(s) else None for s in sets], pa.binary()),
                            n=sizes.astype(np.int64),
                            buckets=pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                                             pa.array(buckets.reshape(-1).view(np.int64))))

    return map_batches(rows, run, "doc_id long, h long, key binary, n long, buckets array<long>")


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """(key, members), once for each set that occurs in ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in sliced(b.column("raw"), PIECE):
                sets = [shingles(raw.as_py(), width) for raw in b.column("raw").slice(i, j - i)]
                yield batch(key=pa.array([key(s) for s in sets], pa.binary()),
                            members=pa.array([s.tobytes() for s in sets], pa.binary()))

    return map_batches(rows.select("raw"), run, "key binary, members binary").dropDuplicates(["key"])


# -- verification ----------------------------------------------------------------

def forest(sets: list[np.ndarray], label: np.ndarray, left: np.ndarray, right: np.ndarray | None,
           threshold: tuple[int, int] = THRESHOLD) -> list[tuple[int, int]]:
    """Links that unite ``sets``: of all pairs of ``left`` and ``right`` (None: within left) whose
    labels differ, those that pass; a link gives both sides one label, so one is enough for two labels."""
    need, of = threshold
    size = np.array([len(s) for s in sets])
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(ids) and ids.max() + 1, dtype=np.int64)
    label, out = label.copy(), []
    for at, i in enumerate(left.tolist()):
        others = left[at + 1:] if right is None else right
        fits = (of * np.minimum(size[others], size[i]) >= need * np.maximum(size[others], size[i]))
        others = others[fits & (label[others] != label[i])]
        if not len(others):
            continue
        own = ids[starts[i]:starts[i] + size[i]]
        marked[own] = 1
        if 4 * len(others) > len(sets):
            shared = np.add.reduceat(marked[ids], starts)[others]
        else:
            shared = np.array([marked[ids[starts[o]:starts[o] + size[o]]].sum() for o in others.tolist()])
        marked[own] = 0
        for o in others[of * shared >= need * (size[i] + size[others] - shared)].tolist():
            if label[o] != label[i]:
                out.append((i, o))
                label[label == label[o]] = label[i]
    return out


def _compared(tasks: DataFrame, sets: DataFrame, by: list[str], threshold: tuple[int, int]) -> DataFrame:
    """Links (u, v) of ``tasks`` (``by``, key, label, side): in each, side 0 against side 1, or
    within side 0 where there is no other."""

    def run(group: pa.Table) -> pa.Table:
        keys, side = group.column("key").to_pylist(), group.column("side").to_numpy()
        _, label = np.unique(np.array([x.hex() for x in group.column("label").to_pylist()]), return_inverse=True)
        found = [np.frombuffer(m, U) for m in group.column("members").to_pylist()]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links = forest(found, label, left, right if len(right) else None, threshold) if len(left) else []
        return pa.table({"u": pa.array([keys[i] for i, _ in links], pa.binary()),
                         "v": pa.array([keys[j] for _, j in links], pa.binary())})

    return tasks.join(sets, "key").groupBy(*by).applyInArrow(run, "u binary, v binary")


def _blocks(rows, shingles_):
    """Blocks of bounded size for so many rows and shingles."""
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(BLOCK)), F.ceil(shingles_ / F.lit(BLOCK_SHINGLES))).cast("int")


def _hub_tasks(members: DataFrame) -> DataFrame:
    """Each member of a bucket against the bucket's smallest key; a pair once, whatever
    buckets it shares.  A hub's members are dealt into blocks, and the hub goes to each."""
    pairs = members.filter(F.col("key") != F.col("hub")).groupBy("hub", "key").agg(F.first("n").alias("n"))
    pairs = written(pairs, "hub-pairs")
    blocks = pairs.groupBy("hub").agg(_blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks"))
    dealt = pairs.join(blocks, "hub").select(
        "hub", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), "key",
        F.col("key").alias("label"), F.lit(1).alias("side"))
    hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                         F.col("hub").alias("key"), F.col("hub").alias("label"), F.lit(0).alias("side"))
    return dealt.unionByName(hubs)


def _rest_tasks(members: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs of a bucket that no hub settles: those of its other members that lie in
    different components, as pairs of blocks."""
    rest = members.filter(F.col("key") != F.col("hub")).join(
        linked.select(F.col("node").alias("key"), "root"), "key", "left")
    rest = rest.select("bucket", "key", "n", F.coalesce("root", "key").alias("label"))
    parts = rest.groupBy("bucket", "label").agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.sum(F.hash("key").cast("long")).alias("s"))
    large = F.max(F.struct("c", "n", "label"))
    open_ = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("labels"), large.alias("large"), F.sum("c").alias("c"), F.sum("n").alias("n"),
        F.bit_xor("x").alias("x"), F.sum("s").alias("s")).filter("labels > 1")
    # buckets of the same members are one
    open_ = open_.groupBy("c", "n", "x", "s").agg(F.min(F.struct("bucket", "large")).alias("b")).select(
        "b.bucket", F.col("b.large.label").alias("large"),
        _blocks(F.col("c") - F.col("b.large.c"), F.col("n") - F.col("b.large.n")).alias("few"),
        _blocks(F.col("b.large.c"), F.col("b.large.n")).alias("many"))
    dealt = rest.join(open_, "bucket")
    few = F.col("label") != F.col("large")
    spread = F.xxhash64("key")
    block = F.when(few, F.pmod(spread, F.col("few"))).otherwise(
        F.col("few") + F.pmod(spread, F.col("many"))).cast("int")
    # a block meets all blocks where it is one of the few, only the few where it is of the large component
    dealt = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(
        F.lit(0), F.when(few, F.col("few") + F.col("many") - 1).otherwise(F.col("few") - 1))))
    return dealt.select("bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                        "key", "label", F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"))


def links(signed: DataFrame, docs: DataFrame, width: int = SHINGLE,
          threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(u, v): links between distinct sets, enough of them to connect all that are linked.

    ``signed`` is the written result of ``_signed`` over ``docs`` (doc_id, h, raw).
    """
    distinct = signed.filter("key is not null").groupBy("key").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "h")).alias("row"),
        F.first("n").alias("n"), F.first("buckets").alias("buckets"))
    distinct = written(distinct, "distinct-sets")
    entries = distinct.select("key", "n", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(entries.join(shared.select("bucket", "hub"), "bucket"), "bucket-members")
    # texts are read again only where a set shares a bucket
    wanted = distinct.join(members.select("key").distinct(), "key", "left_semi").select("row.*")
    texts_ = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST_ID))).join(wanted, ["doc_id", "h"], "left_semi")
    sets = written(_sets(texts_, width), "shingle-sets")
    by_hub = written(_compared(_hub_tasks(members), sets, ["hub", "block"], threshold), "hub-links")
    rest = _compared(_rest_tasks(members, components(by_hub)), sets, ["bucket", "x", "y"], threshold)
    return by_hub.unionByName(rest)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    rows = texts(docs, id_col, text_col).withColumn("h", F.xxhash64("raw"))
    signed = written(_signed(rows, width), "super-minhash")
    member = components(links(signed, rows, width, threshold))
    least = signed.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    member = written(least.join(member.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "least", F.coalesce("root", "key").alias("root")), "set-roots")
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    found = signed.join(member.join(ids, "root").select("key", "component_id"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))


#: DuckDB: links by the shingles that two sets share; all that can be reached from each.
ORACLE = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})])
        END AS s FROM words),
members AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v FROM members a JOIN members b ON a.m = b.m AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING {THRESHOLD[1]} * count(*) >= {THRESHOLD[0]} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS u, doc_id AS v FROM sets UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u) USING (doc_id)
"""
