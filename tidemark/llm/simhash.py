"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: a text's bytes with A-Z lower-cased, split at ASCII white space, give
shingles of ``shingle`` words; each shingle's XXH64 votes on 64 bits.

Links (``max_distance`` D bits or fewer): the 64 bits are cut into D + 2 blocks, so two
linked fingerprints agree on two blocks at least.  For each pair of blocks, the distinct
fingerprints, with those blocks' bits moved to the front, are sorted by Gray rank (the
position of the code in the reflected Gray sequence) over all partitions.  Codes that
agree on the front form a run, a bucket.  Short runs are compared in place.  A longer run
gets a tree in this order: each node holds the bits that all codes below it share, an
upper node the bits shared by its children, which then keep only the bits that they
share beyond it.  A search carries the differences that a code has gathered on its way
down and leaves a whole group once they exceed D.  Runs longer than ``BLOCK`` codes, or
cut by the edge of a partition, are split into blocks; pairs of blocks whose shared bits
differ by D or less (again the tree's rule, on the blocks' roots) are spread over the
tasks and searched there, so one hot bucket is the work of many tasks.

Each comparison emits a spanning forest of the links that it found, never all pairs of
a group; components of the forests' union are those of all links.  Identical copies
collapse into one fingerprint before anything is compared.

Null text has no words and, like empty text, fingerprint zero, which links like any
other; repeated rows are copies; a null doc_id counts only where its component has no
other id (component_id is then null); an empty table gives no row; extra columns are
ignored.  A text of any length is voted on in slices of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, batch, map_batches, task_id, texts, written
from tidemark.llm.graph import components, roots

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
#: Codes in one block of a run.
BLOCK = 4096
#: Codes that a task holds before it cuts them into runs.
HELD = 1 << 17
#: Runs up to this length are compared in place.
SHORT = 48
FANOUT = 16

U = np.uint64
SIGN = U(1 << 63)


# -- fingerprints ---------------------------------------------------------------

def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text; 0 without words."""
    from xxhash import xxh64_intdigest as digest

    words = raw.lower().split()          # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 65_280):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + 65_280], ends[at:at + 65_280])],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for part in range(0, len(bits), 255 * 64):       # sums of 255 ones fit a byte
            some = bits[part:part + 255 * 64]
            whole = len(some) // 255 * 255
            ones += some[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            ones += some[whole:].sum(axis=0, dtype=np.uint8)
    return sum(1 << k for k in np.flatnonzero(2 * ones > len(starts)).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, h, fp): one row per document; h is a hash of its text, fp a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(raw, shingle, seed) for raw in b.column("raw").to_pylist()], dtype=U)
            yield batch(doc_id=b.column("doc_id"), h=b.column("h"), fp=fp.view(np.int64))

    return map_batches(texts(docs, id_col, text_col).withColumn("h", F.xxhash64("raw")), run,
                       "doc_id long, h long, fp long")


# -- Gray order -----------------------------------------------------------------

def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> U(s)
    return rank


def gray_code(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> U(1))


def block_pairs(max_distance: int) -> list[list[tuple[int, int]]]:
    """For each pair of the D + 2 blocks, the (shift, width) of all blocks, the pair first."""
    n = max_distance + 2
    cuts = [64 * k // n for k in range(n + 1)]
    blocks = [(cuts[k], cuts[k + 1] - cuts[k]) for k in range(n)]
    return [[blocks[i], blocks[j], *(b for k, b in enumerate(blocks) if k not in (i, j))]
            for i in range(n) for j in range(i + 1, n)]


def front_width(order: list[tuple[int, int]]) -> int:
    return order[0][1] + order[1][1]


def permuted(code: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """``code`` with its blocks in the given order, first block highest."""
    out = np.zeros_like(code)
    for shift, width in order:
        out = (out << U(width)) | ((code >> U(shift)) & U((1 << width) - 1))
    return out


def restored(code: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    out, low = np.zeros_like(code), 64
    for shift, width in order:
        low -= width
        out |= ((code >> U(low)) & U((1 << width) - 1)) << U(shift)
    return out


# -- the tree -------------------------------------------------------------------

def shared_bits(code: np.ndarray) -> tuple[int, int]:
    """(mask, pattern): the bits on which all codes agree, and their values there."""
    mask = ~np.bitwise_or.reduce(code ^ code[0])
    return int(mask), int(code[0] & mask)


class GrayTree:
    """Levels of nodes over codes in Gray order; the codes are the lowest level."""

    def __init__(self, codes: np.ndarray):
        masks, patterns = [np.full(len(codes), ~U(0))], [codes]
        while len(patterns[-1]) > 1:
            mask, pattern = masks[-1], patterns[-1]
            heads = np.arange(0, len(pattern), FANOUT)
            first = np.repeat(pattern[heads], np.diff(np.append(heads, len(pattern))))
            differ = np.bitwise_or.reduceat(pattern ^ first, heads)
            up = np.bitwise_and.reduceat(mask, heads) & ~differ
            masks.append(up)
            patterns.append(pattern[heads] & up)
        for k in range(len(masks) - 1):                   # a child keeps what its parent doesn't have
            parent = np.arange(len(masks[k])) // FANOUT
            masks[k] = masks[k] & ~masks[k + 1][parent]
            patterns[k] = patterns[k] & masks[k]
        self.masks, self.patterns = masks, patterns

    def near(self, queries: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) indices of all pairs at ``max_distance`` bits or fewer."""
        query, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        gathered = np.zeros(len(queries), dtype=np.int64)
        for level in range(len(self.masks) - 1, -1, -1):
            if level < len(self.masks) - 1:
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, gathered = np.repeat(query, FANOUT), np.repeat(gathered, FANOUT)
                there = node < len(self.masks[level])
                query, node, gathered = query[there], node[there], gathered[there]
            gathered = gathered + np.bitwise_count(
                (queries[query] ^ self.patterns[level][node]) & self.masks[level][node])
            close = gathered <= max_distance
            query, node, gathered = query[close], node[close], gathered[close]
        return query, node


def forest(a: np.ndarray, b: np.ndarray | None, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) that connect what all links inside ``a``, or between ``a`` and ``b``, connect."""
    tree = GrayTree(a if b is None else b)
    codes = a if b is None else np.concatenate([a, b])
    parent = np.arange(len(codes))
    for at in range(0, len(a), 256):
        query, node = tree.near(a[at:at + 256], max_distance)
        u, v = parent[query + at], parent[node + (0 if b is None else len(a))]
        parent = roots(len(codes), u, v)[parent]
    linked = np.flatnonzero(parent != np.arange(len(codes)))
    return codes[linked], codes[parent[linked]]


# -- links over all partitions ----------------------------------------------------

def gray_ordered(distinct: DataFrame, max_distance: int) -> DataFrame:
    """(pair, rank) of every distinct fingerprint for every pair of blocks, sorted over
    all partitions; rank has its sign flipped, so that signed order is Gray order."""
    orders = block_pairs(max_distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = b.column("fp").to_numpy().view(U)
            for k, order in enumerate(orders):
                rank = gray_rank(permuted(code, order)) ^ SIGN
                yield batch(pair=np.full(len(code), k, dtype=np.int32), rank=rank.view(np.int64))

    keys = map_batches(distinct.select("fp"), run, "pair int, rank long")
    return keys.repartitionByRange("pair", "rank").sortWithinPartitions("pair", "rank")


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(u, v): forests of the links between the fingerprints of ``distinct`` (fp)."""
    orders = block_pairs(max_distance)

    def cut_to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n_blocks, first = task_id(), 0, True
        u_out: list[np.ndarray] = []
        v_out: list[np.ndarray] = []
        pair = np.empty(0, dtype=np.int32)
        code = np.empty(0, dtype=U)

        def block(k: int, codes: np.ndarray) -> pa.RecordBatch:
            nonlocal n_blocks
            n_blocks += 1
            bucket = int(codes[0] >> U(64 - front_width(orders[k]))) | k << 48
            mask, pattern = shared_bits(codes)
            return batch(u=pa.array([None], pa.int64()), v=pa.array([None], pa.int64()),
                         bucket=pa.array([bucket], pa.int64()), block=pa.array([task << 32 | n_blocks], pa.int64()),
                         mask=np.array([mask], dtype=U).view(np.int64),
                         pattern=np.array([pattern], dtype=U).view(np.int64),
                         codes=pa.array([codes.tobytes()], pa.binary()))

        def links_found(k: int, u: np.ndarray, v: np.ndarray) -> None:
            u_out.append(restored(u, orders[k]).view(np.int64))
            v_out.append(restored(v, orders[k]).view(np.int64))

        def flush() -> Iterator[pa.RecordBatch]:
            if u_out:
                u, v = np.concatenate(u_out), np.concatenate(v_out)
                u_out.clear(), v_out.clear()
                none = pa.nulls(len(u), pa.int64())
                yield batch(u=u, v=v, bucket=none, block=none, mask=none, pattern=none,
                            codes=pa.nulls(len(u), pa.binary()))

        def whole_runs(pair: np.ndarray, code: np.ndarray) -> None:
            """Links of the short runs, all at once."""
            for k in np.unique(pair).tolist():
                c = code[pair == k]
                front = c >> U(64 - front_width(orders[k]))
                u, v = [], []
                for shift in range(1, SHORT):
                    same = np.flatnonzero(front[:-shift] == front[shift:])
                    if not len(same):
                        break
                    close = same[np.bitwise_count(c[same] ^ c[same + shift]) <= max_distance]
                    u.append(close), v.append(close + shift)
                if u and len(u := np.concatenate(u)):
                    parent = roots(len(c), u, np.concatenate(v))
                    linked = np.flatnonzero(parent != np.arange(len(c)))
                    links_found(k, c[linked], c[parent[linked]])

        def runs(pair: np.ndarray, code: np.ndarray, edge: bool) -> Iterator[pa.RecordBatch]:
            """Whole runs; ``edge``: the last one may go on in the next partition."""
            nonlocal first
            if not len(code):
                return
            front = code >> np.array([64 - front_width(o) for o in orders], dtype=U)[pair]
            heads = np.flatnonzero(np.concatenate(([True], (front[1:] != front[:-1]) | (pair[1:] != pair[:-1]))))
            ends = np.append(heads[1:], len(code))
            apart = ends - heads >= SHORT
            apart[0] |= first                         # it may have begun in the partition before
            apart[-1] |= edge
            open_ = np.zeros(len(heads), dtype=bool)
            open_[0] |= first
            open_[-1] |= edge                         # of a single run, both hold
            first = False
            keep = np.repeat(~apart, ends - heads)
            whole_runs(pair[keep], code[keep])
            for r in np.flatnonzero(apart).tolist():
                k, c = int(pair[heads[r]]), code[heads[r]:ends[r]]
                for at in range(0, len(c), BLOCK):
                    part = c[at:at + BLOCK]
                    links_found(k, *forest(part, None, max_distance))
                    if open_[r] or len(c) > BLOCK:
                        yield block(k, part)
            yield from flush()

        for b in batches:
            pair = np.concatenate([pair, b.column("pair").to_numpy()])
            code = np.concatenate([code, gray_code(b.column("rank").to_numpy().view(U) ^ SIGN)])
            if len(code) < HELD:
                continue
            # the last run stays until its end is seen, but for its full blocks
            k = int(pair[-1])
            front = (code >> U(64 - front_width(orders[k])))
            last = int(np.flatnonzero((front == front[-1]) & (pair == k))[0])
            yield from runs(pair[:last], code[:last], False)
            full = (len(code) - last) // BLOCK * BLOCK
            for at in range(last, last + full, BLOCK):
                links_found(k, *forest(code[at:at + BLOCK], None, max_distance))
                yield block(k, code[at:at + BLOCK])
                first = True                          # what is left of the run belongs to these blocks
            pair, code = pair[last + full:], code[last + full:]
        yield from runs(pair, code, True)

    found = written(map_batches(gray_ordered(distinct, max_distance), cut_to_runs,
                                "u long, v long, bucket long, block long, mask long, pattern long, codes binary"),
                    "gray-runs")
    blocks = found.filter("block is not null")
    heads = blocks.select("bucket", "block", "mask", "pattern")
    a, b = heads.alias("a"), heads.alias("b")
    # the differences on the bits that both blocks' roots hold
    apart = F.bit_count(F.col("a.pattern").bitwiseXOR(F.col("b.pattern")).bitwiseAND(F.col("a.mask"))
                        .bitwiseAND(F.col("b.mask")))
    pairs = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.block") < F.col("b.block"))
                   & (apart <= max_distance)).select(F.col("a.bucket").alias("bucket"), F.col("a.block").alias("x"),
                                                     F.col("b.block").alias("y"))
    pairs = pairs.join(blocks.select(F.col("block").alias("x"), F.col("codes").alias("xs")), "x") \
                 .join(blocks.select(F.col("block").alias("y"), F.col("codes").alias("ys")), "y") \
                 .repartition("x", "y")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, xs, ys in zip(*(b.column(c).to_pylist() for c in ("bucket", "xs", "ys"))):
                order = orders[bucket >> 48]
                u, v = forest(np.frombuffer(xs, U), np.frombuffer(ys, U), max_distance)
                yield batch(u=restored(u, order).view(np.int64), v=restored(v, order).view(np.int64))

    across = map_batches(pairs.select("bucket", "xs", "ys"), between, "u long, v long")
    return found.filter("u is not null").select("u", "v").union(across)


def groups(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``prints`` (doc_id, fp): root names
    the component, component_id is its smallest doc_id."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    member = components(links(distinct, max_distance)).withColumnRenamed("node", "fp")
    member = distinct.join(member, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    member = written(member, "fingerprint-roots")
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return member.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, max_distance: int = MAX_DISTANCE, shingle: int = SHINGLE,
                    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    prints = written(fingerprints(docs, id_col, text_col, shingle, seed), "document-fingerprints")
    return prints.join(groups(prints, max_distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_distance: int = MAX_DISTANCE, shingle: int = SHINGLE,
                seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest doc_id (a null id
    where there is no other); of rows with the same id and text, the first by a hash."""
    prints = written(fingerprints(docs, id_col, text_col, shingle, seed), "document-fingerprints")
    found = groups(prints, max_distance)
    kept = prints.join(found, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "h")).alias("kept")).select("kept.*")
    # the columns go by their places: any names, any types (a map has no hash, its JSON has)
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("h"),
                       *[F.col(c).alias(k) for c, k in zip(docs.columns, names)])
    rows = rows.join(kept, ["id", "h"], "left_semi")
    by = F.xxhash64(*[F.to_json(F.struct(k)) if "map<" in rows.schema[k].dataType.simpleString() else F.col(k)
                      for k in names])
    # repeated rows are combined where they are read
    one = rows.groupBy("id", "h").agg(F.min_by(F.struct(*names), by).alias("row"))
    return one.select(*[F.col("row")[k].alias(c) for c, k in zip(docs.columns, names)])
