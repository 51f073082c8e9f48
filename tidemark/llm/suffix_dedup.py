"""Removal of byte strings that an earlier document holds too, through threshold-bounded
interval expansion on Burrows-Wheeler transforms.

A byte of a document goes if a string of ``length`` L bytes that covers it also starts in
a document with a smaller id; strings are judged on the input and never cross documents.

1. Anchors.  Every window of L bytes picks one of its own ``GRAM``-byte grams, by a rule
   that sees nothing but the window (the smallest hashed ``TINY``-gram's position modulo
   the number of grams), so equal windows pick equal grams.  A run of windows with the same
   gram is an anchor, about one for each 15 bytes.
2. Anchors whose gram another document has.  Each task packs its anchors' grams by bucket
   (leading hash bits); what is repeated inside a task is settled there, so a gram that a
   third of all documents hold counts once for each task in its bucket.  The answer returns
   to the task's documents: per document, the grams that are worth a closer look.
3. Segments.  Documents are joined with their answers; the bytes of each such run of windows
   form a segment, and equal segments of a task are sent once, with the smallest id.  A gram
   that has more anchors in all than one transform takes is hot: its windows are segments of
   their own, dealt by a hash of all their bytes, so that equal windows still meet while the
   others spread over all buckets.  A
   bucket's distinct segments are joined to one string with a separator after each, and its
   suffix array and Burrows-Wheeler transform are built.  Intervals of the transform are
   expanded breadth first, by backward extension: a border between two suffixes whose common
   prefix has l bytes is found from the borders of l - 1 bytes, so common prefixes come out
   by increasing value.  It stops at L: suffixes with no border between them then share L
   bytes, and each interval's smallest document id is the id that a window is compared with.
4. The answer returns to the task's documents as spans, which are joined and cut out.

The documents' text is shuffled once by (id, hash of text): both joins use that exchange.
Texts are read in chunks of bounded size whatever their length.

Null text counts as empty.  A null id sorts behind every other id and is returned as null.
Rows of the same id never remove each other's bytes.  Texts shorter than L stay whole.  An
empty table gives no row.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LAST_ID, batch, map_batches, sliced, task_id, texts, total_bytes

LENGTH = 50
GRAM = 28
TINY = 5
#: Window starts hashed at a time, and bytes of text held at a time (or one text).
CHUNK = 1 << 14
SLICE = 4 << 20
#: Anchors that a task packs together, and text bytes for each bucket.
PACK = 2_000_000
BUCKET_BYTES = 2 << 20
#: Symbols of one Burrows-Wheeler transform, which a gram with more anchors is split to keep.
SYMBOLS = 400_000

U = np.uint64


# -- anchors ------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(29))


def _words(padded: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes from each of ``n`` positions as a little-endian integer."""
    return np.ndarray((n,), "<u8", padded, strides=(1,))


def window_anchors(padded: np.ndarray, lo: int, hi: int, length: int) -> np.ndarray:
    """Position of the gram that each window starting in [lo, hi) picks."""
    grams = length - GRAM + 1
    n = hi - lo + length - TINY
    tiny = _words(padded[lo:], n) << U(64 - 8 * TINY)
    tiny *= U(0x9E3779B97F4A7C15)
    least = (tiny >> U(24) << U(24)) | np.arange(n, dtype=U)     # ties to the left
    width, need = 1, length - TINY + 1
    while width * 2 <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if need > width:
        least = np.minimum(least[:len(least) - (need - width)], least[need - width:])
    start = np.arange(hi - lo)
    return lo + start + ((least & U(0xFFFFFF)).astype(np.int64) - start) % grams


def anchors(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, first window, windows, gram, its hash) of every run of windows; documents are
    the ranges [starts, ends) of ``padded``, chunk by chunk."""
    n = int(ends[-1]) if len(ends) else 0
    for lo in range(0, n - length + 1, CHUNK):
        hi = min(lo + CHUNK, n - length + 1)
        i, j = np.searchsorted(ends, [lo, hi - 1], "right")
        here = np.minimum(ends[i:j + 1], hi) - np.maximum(starts[i:j + 1], lo)
        last = np.repeat(ends[i:j + 1] - length, np.maximum(here, 0))
        at = np.arange(lo, hi)
        inside = at <= last
        if not inside.any():
            continue
        at, pick = at[inside], window_anchors(padded, lo, hi, length)[inside]
        heads = np.flatnonzero(np.concatenate(([True], pick[1:] != pick[:-1])))
        windows = np.diff(np.append(heads, len(at)))
        first, gram = at[heads], pick[heads]
        yield np.searchsorted(ends, first, "right"), first, windows, gram, _gram_hashes(padded, n, gram)


def _joined(raw: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, the same padded, starts, ends) of several texts in a row."""
    buf = b"".join(raw)
    ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return buf, np.frombuffer(buf + bytes(16), dtype=np.uint8), starts, ends


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j in sliced(b.column("raw"), SLICE):
            yield b.slice(i, j - i)


def _grouped(order_by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads) that sort ``order_by`` and start its runs of equal values, each in any order."""
    order = np.argsort(order_by)
    s = order_by[order]
    return order, np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)


def _plain(array: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(array.astype(kind, copy=False)).tobytes()


def _blob(array: np.ndarray, kind: str) -> bytes:
    """The array's bytes, first all lowest ones, compressed."""
    a = np.ascontiguousarray(array.astype(kind, copy=False))
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def _unpacked(blob: bytes | None, kind: str) -> np.ndarray:
    if not blob:
        return np.empty(0, dtype=kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _read(blobs: list[bytes | None], kind: str) -> np.ndarray:
    return np.concatenate([_unpacked(x, kind) for x in blobs]) if blobs else np.empty(0, dtype=kind)


def _gram_hashes(padded: np.ndarray, n: int, gram: np.ndarray, size: int = GRAM) -> np.ndarray:
    h = np.zeros(len(gram), dtype=U)
    for offset in (*range(0, size - 8, 8), size - 8):
        h = _mixed(h * U(3) + _words(padded, n)[gram + offset])
    return h


# -- which grams other documents have -------------------------------------------

SENT = "kind int, key long, part long, gram binary, doc binary, hash binary"
REPEATED = np.uint32(0xFFFFFFFF)
#: In place of a gram's offset: the segment is one window of a hot gram.
WINDOW = 0xFFFFFFFF


def _hot_anchors(length: int) -> int:
    """Anchors of one gram whose segments fit a transform, whatever they hold."""
    return SYMBOLS // (2 * length - GRAM + 1)


def _shared_grams(rows: DataFrame, bits: int, length: int) -> DataFrame:
    """(id, hash, wanted, hot): the last 32 bits of the cut-down grams that others may have too, and
    those cut-down grams of the document that are hot.  Every document that holds a hot gram and
    has it among its wanted ones is told so."""
    many = _hot_anchors(length)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n_parts = task_id() << 32, 0
        ids: list = []
        hashes: list = []
        doc: list[np.ndarray] = []
        gram: list[np.ndarray] = []
        held = 0

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal n_parts
            part, n_parts = base | n_parts, n_parts + 1
            g, d, of = np.concatenate(gram), np.concatenate(doc), np.array(ids, dtype=np.int64)
            order, heads = _grouped(g)
            g, d = g[order], d[order]
            # rows, not ids: of rows with one id, each must ask for the gram itself
            several = np.minimum.reduceat(d, heads) != np.maximum.reduceat(d, heads)
            counts = np.diff(np.append(heads, len(g)))
            alone = np.repeat(several, counts)
            cut = g >> U(32 - bits)                                   # bucket and 32 more bits
            out = [(2, part, None, _blob(of, "<i8"), _blob(np.array(hashes, dtype=np.int64), "<i8")),
                   (1, part, _blob(cut[alone], "<u8"), _blob(d[alone], "<u4"), None)]
            first_g, first_d = cut[heads], np.where(several, REPEATED, d[heads].astype(np.uint32))
            bucket = (first_g >> U(32)).astype(np.int64)
            edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).tolist()
            for a, b in zip(edges, [*edges[1:], len(bucket)]):
                low = (first_g[a:b] & U(0xFFFFFFFF)).astype(np.uint32)
                out.append((0, int(bucket[a]), _blob(np.diff(low, prepend=np.uint32(0)), "<u4"),
                            _blob(first_d[a:b], "<u4"), _blob(counts[a:b], "<u4")))
            kind, key, gs, ds, hs = zip(*out)
            yield batch(kind=pa.array(kind, pa.int32()), key=pa.array(key, pa.int64()),
                        part=pa.array([part] * len(out), pa.int64()), gram=pa.array(gs, pa.binary()),
                        doc=pa.array(ds, pa.binary()), hash=pa.array(hs, pa.binary()))

        for b in _slices(batches):
            _, padded, starts, ends = _joined(b.column("raw").to_pylist())
            for d, _, _, _, g in anchors(padded, starts, ends, length):
                doc.append(d + len(ids))
                gram.append(g)
                held += len(g)
            ids += b.column("id").to_pylist()
            hashes += b.column("hash").to_pylist()
            if held >= PACK:
                yield from pack()
                ids, hashes, doc, gram, held = [], [], [], [], 0
        if held:
            yield from pack()

    def compare(table: pa.Table) -> pa.Table:
        """Of one bucket: the entries whose gram comes from two tasks, or twice from one (kind 1), and
        for each task those of its grams that have too many anchors in all (kind 3)."""
        if table.column("kind")[0].as_py():
            return table
        part, gram, doc, count = (table.column(c).to_pylist() for c in ("part", "gram", "doc", "hash"))
        grams = [np.cumsum(_unpacked(x, "<u4"), dtype=np.uint32) for x in gram]
        g, d = np.concatenate(grams), _read(doc, "<u4")
        where = np.repeat(np.arange(len(gram)), [len(x) for x in grams])
        order, heads = _grouped(g)
        sizes = np.diff(np.append(heads, len(g)))
        asked = np.empty(len(g), dtype=bool)
        asked[order] = np.repeat(sizes > 1, sizes)
        asked &= d != REPEATED
        hot = np.empty(len(g), dtype=bool)
        hot[order] = np.repeat(np.add.reduceat(_read(count, "<u4")[order].astype(np.int64), heads) > many, sizes)
        g = g.astype(U) | U(table.column("key")[0].as_py()) << U(32)
        rows = []
        for kind, some in ((1, asked), (3, hot)):
            g_, d_, where_ = g[some], d[some], where[some]
            edges = np.flatnonzero(np.concatenate(([True], where_[1:] != where_[:-1]))).tolist() if len(where_) else []
            rows += [(kind, 0, part[where_[a]], _blob(g_[a:b], "<u8"), _blob(d_[a:b], "<u4") if kind == 1 else None, None)
                     for a, b in zip(edges, [*edges[1:], len(where_)])]
        return pa.Table.from_pylist([dict(zip(table.schema.names, r)) for r in rows], schema=table.schema)

    def answer(table: pa.Table) -> pa.Table:
        kind, gram, doc, hash_ = (table.column(c).to_pylist() for c in ("kind", "gram", "doc", "hash"))
        own = kind.index(2)
        ids, hashes = _unpacked(doc[own], "<i8"), _unpacked(hash_[own], "<i8")
        g = _read([x for k, x in zip(kind, gram) if k == 1], "<u8")
        d = _read([x for k, x in zip(kind, doc) if k == 1], "<u4")
        order, heads = _grouped(d)
        g, edges = g[order], np.append(heads, len(d)).tolist()
        mine = d[order][heads]
        hot = np.isin(g, _read([x for k, x in zip(kind, gram) if k == 3], "<u8"))
        return pa.table({"id": pa.array(ids[mine]), "hash": pa.array(hashes[mine]),
                         "wanted": pa.array([_plain(g[a:b], "<u4") for a, b in zip(edges, edges[1:])], pa.binary()),
                         "hot": pa.array([_plain(g[a:b][hot[a:b]], "<u8") for a, b in zip(edges, edges[1:])],
                                         pa.binary())})

    sent = map_batches(rows, send, SENT)
    seen = sent.groupBy("kind", "key").applyInArrow(compare, SENT)
    found = seen.groupBy("part").applyInArrow(answer, "id long, hash long, wanted binary, hot binary")
    return found.groupBy("id", "hash").agg(                                      # equal for equal rows
        F.first("wanted").alias("wanted"), F.first("hot").alias("hot"))


# -- the transform ----------------------------------------------------------------

def suffix_array(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix array, rank of each position, starts of the segments) of the segments in a row,
    each followed by a separator of its own, smaller than any byte."""
    sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)) + 1
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    symbol = np.zeros(n, dtype=U)
    is_byte = np.ones(n, dtype=bool)
    is_byte[starts + sizes - 1] = False
    symbol[is_byte] = np.frombuffer(b"".join(segments), dtype=np.uint8).astype(U) + U(1)
    width = 7                                            # symbols of 9 bits that fit a word
    key, ended = np.zeros(n, dtype=U), np.zeros(n, dtype=bool)
    for k in range(width):                               # a suffix ends at its separator
        there = symbol[k:]
        ended[:n - k] |= there == 0
        key[:n - k] = (key[:n - k] << U(9)) | np.where(ended[:n - k], U(0), there)
        key[n - k:] <<= U(9)
    order = np.argsort(key)
    slots = np.flatnonzero(ended[order])                 # equal suffixes stay in the order of their separators
    mine = order[slots]
    order[slots] = mine[np.lexsort((mine, key[mine]))]
    sorted_key = key[order]
    new = np.concatenate(([True], (sorted_key[1:] != sorted_key[:-1]) | ended[order[1:]]))
    rank = np.empty(n, dtype=np.int32)                   # of a group of suffixes that look alike: its first place
    heads = np.flatnonzero(new)
    sizes_ = np.diff(np.append(heads, n))
    rank[order] = np.repeat(heads, sizes_)
    slots = np.flatnonzero(np.repeat(sizes_ > 1, sizes_))
    while len(slots):                                    # such suffixes have no separator in ``width`` symbols
        mine = order[slots]
        key = rank[mine].astype(U) << U(32) | rank[mine + width].astype(U)
        by = np.argsort(key)
        mine, key = mine[by], key[by]
        order[slots] = mine
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes_ = np.diff(np.append(heads, len(key)))
        rank[mine] = np.repeat(slots[heads], sizes_)
        slots = slots[np.repeat(sizes_ > 1, sizes_)]
        width *= 2
    return order, rank, starts


def interval_starts(order: np.ndarray, rank: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Where, in suffix order, a suffix shares fewer than ``length`` symbols with the one before.

    ``first``: each suffix's first symbol, in suffix order.  The border between suffixes t - 1
    and t of the word c w has the value of the smallest border between the places of w to which
    the transform maps them, plus 1; by increasing value, a border is found as soon as any border
    of the value before lies between those places.
    """
    n = len(order)
    border = np.concatenate(([True], first[1:] != first[:-1]))
    shorter = rank[np.minimum(order + 1, n - 1)]         # place of the suffix without its first symbol
    open_ = np.flatnonzero(~border)
    high, low = shorter[open_], shorter[open_ - 1]
    for _ in range(1, length):
        seen = np.cumsum(border, dtype=np.int32)
        found = seen[high] > seen[low]
        if not found.any():
            break                                        # no border of this value, so none of a larger one
        border[open_[found]] = True
        open_, high, low = open_[~found], high[~found], low[~found]
    return border


def window_ids(segments: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest id that has each window, windows before each segment) for all windows of ``length``
    bytes of the segments, ``ids`` being the smallest id that has the segment."""
    order, rank, starts = suffix_array(segments)
    sizes = np.diff(np.append(starts, len(order))) - 1
    windows = sizes - length + 1
    before = np.cumsum(windows) - windows
    symbol = np.zeros(len(order), dtype=np.int64)
    symbol[starts + sizes] = -1 - np.arange(len(segments))
    flat = np.ones(len(order), dtype=bool)
    flat[starts + sizes] = False
    symbol[flat] = np.frombuffer(b"".join(segments), dtype=np.uint8)
    border = interval_starts(order, rank, symbol[order], length)
    position = np.repeat(starts - before, windows) + np.arange(int(windows.sum()))
    least = np.full(len(order), LAST_ID, dtype=np.int64)
    least[position] = np.repeat(ids, windows)
    heads = np.flatnonzero(border)
    smallest = np.minimum.reduceat(least[order], heads)
    return smallest[(np.cumsum(border) - 1)[rank[position]]], before


# -- spans ----------------------------------------------------------------------

SEGMENTS = ("kind int, key long, part long, entry binary, gram binary, size binary, bytes binary, "
            "least binary, most binary")


def _spans(rows: DataFrame, bits: int, length: int) -> DataFrame:
    """(id, hash, spans) of the documents ``rows`` (id, hash, raw, wanted, hot)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n_parts = task_id() << 32, 0
        entries: dict[bytes, int] = {}
        grams: list[int] = []
        offsets: list[int] = []
        ids: list[int] = []
        hashes: list[int] = []
        seen: list[tuple[np.ndarray, ...]] = []
        held = 0

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal n_parts
            part, n_parts = base | n_parts, n_parts + 1
            entry, doc, start = (np.concatenate(x) for x in zip(*seen))
            of = np.array(ids, dtype=np.int64)
            least = np.full(len(entries), LAST_ID, dtype=np.int64)
            most = np.full(len(entries), -LAST_ID - 1, dtype=np.int64)
            np.minimum.at(least, entry, of[doc])
            np.maximum.at(most, entry, of[doc])
            gram, offsets_, segments = np.array(grams, dtype=U), np.array(offsets), list(entries)
            order = np.argsort(gram)
            number = np.empty(len(order), dtype=np.int64)        # entries count in the order they are sent
            number[order] = np.arange(len(order))
            out = [dict(kind=2, key=part, part=part, least=_blob(of, "<i8"),
                        most=_blob(np.array(hashes, dtype=np.int64), "<i8")),
                   dict(kind=1, key=part, part=part, entry=_blob(number[entry], "<u4"), gram=_blob(doc, "<u4"),
                        least=_blob(start, "<i8"))]
            bucket = (gram[order] >> U(64 - bits)).astype(np.int64)
            edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).tolist()
            for a, b in zip(edges, [*edges[1:], len(bucket)]):
                mine = order[a:b]
                some = [segments[i] for i in mine.tolist()]
                out.append(dict(kind=0, key=int(bucket[a]), part=part, entry=_plain(np.array([a]), "<i8"),
                                gram=_blob(offsets_[mine], "<u4"), size=_blob(np.array(list(map(len, some))), "<u4"),
                                bytes=zstandard.ZstdCompressor(level=1).compress(b"".join(some)),
                                least=_blob(least[mine], "<i8"), most=_blob(most[mine] - least[mine], "<i8")))
            yield from pa.Table.from_pylist(out, schema=_SEGMENT_SCHEMA).to_batches()

        for b in _slices(batches):
            buf, padded, starts, ends = _joined(b.column("raw").to_pylist())
            asked = b.column("wanted").to_pylist()
            known = np.concatenate([np.frombuffer(x, "<u4") for x in asked]).astype(U)
            salt = np.arange(len(asked), dtype=U) << U(32)
            known = np.unique(known | np.repeat(salt, [len(x) // 4 for x in asked]))
            table = np.zeros(1 << 20, dtype=bool)
            table[_mixed(known) >> U(44)] = True
            hot = np.unique(np.concatenate([np.frombuffer(x, "<u8") for x in b.column("hot").to_pylist()]))
            for d, first, windows, gram, g in anchors(padded, starts, ends, length):
                own = ((g >> U(32 - bits)) & U(0xFFFFFFFF)) | salt[d]
                there = np.flatnonzero(table[_mixed(own) >> U(44)])
                at = np.minimum(np.searchsorted(known, own[there]), len(known) - 1)
                there = there[known[at] == own[there]]
                d, first, windows, gram, g = d[there], first[there], windows[there], gram[there], g[there]
                offset = gram - first
                if len(hot) and (split := np.isin(g >> U(32 - bits), hot)).any():
                    # each window of a hot gram goes its own way, by a hash of its bytes
                    times = np.where(split, windows, 1)
                    d, first, windows, g, offset, split = (np.repeat(x, times) for x in (
                        d, first, windows, g, offset, split))
                    first = first + np.where(split, np.arange(len(d)) - np.repeat(np.cumsum(times) - times, times), 0)
                    windows, offset = np.where(split, 1, windows), np.where(split, WINDOW, offset)
                    g[split] = _gram_hashes(padded, int(ends[-1]), first[split], length)
                entry = []
                for s, e, x, y in zip(first.tolist(), (first + windows + length - 1).tolist(), g.tolist(),
                                      offset.tolist()):
                    n = entries.setdefault(buf[s:e], len(entries))
                    entry.append(n)
                    if n == len(grams):
                        grams.append(x)
                        offsets.append(y)
                entry = np.array(entry, dtype=np.int64)
                if len(d):
                    seen.append((entry, d + len(ids), first - starts[d]))
                    held += len(d)
            ids += b.column("id").to_pylist()
            hashes += b.column("hash").to_pylist()
            if held >= PACK // 8:
                yield from pack()
                entries, grams, offsets, ids, hashes, seen, held = {}, [], [], [], [], [], 0
        if held:
            yield from pack()

    def expand(table: pa.Table) -> pa.Table:
        """Of one bucket: for every segment sent, its runs of windows that a smaller id than its
        largest has, with that id."""
        if table.column("kind")[0].as_py():
            return table
        part, sent, gram, size, raw, least, most = (table.column(c).to_pylist() for c in (
            "part", "entry", "gram", "size", "bytes", "least", "most"))
        size = [_unpacked(x, "<u4") for x in size]
        raw = [zstandard.ZstdDecompressor().decompress(x) for x in raw]
        sent_sizes = [len(x) for x in size]
        where = np.repeat(np.arange(len(sent)), sent_sizes)
        entry = np.concatenate([np.frombuffer(x, "<i8") + np.arange(n) for x, n in zip(sent, sent_sizes)])
        least = _read(least, "<i8")
        most = least + _read(most, "<i8")
        joined, offset = b"".join(raw), _read(gram, "<u4")
        padded = np.frombuffer(joined + bytes(16), dtype=np.uint8)
        segment_at = (np.cumsum(np.concatenate(size)) - np.concatenate(size)).astype(np.int64)
        whole = offset != WINDOW
        gram = np.empty(len(offset), dtype=U)
        gram[whole] = _gram_hashes(padded, len(joined), segment_at[whole] + offset[whole])
        gram[~whole] = _gram_hashes(padded, len(joined), segment_at[~whole], length)
        distinct: dict[bytes, int] = {}
        of = np.empty(len(entry), dtype=np.int64)            # each entry's distinct segment
        k = 0
        for sizes, some in zip(size, raw):
            at = 0
            for n in sizes.tolist():
                of[k] = distinct.setdefault(some[at:at + n], len(distinct))
                at, k = at + n, k + 1
        segments = list(distinct)
        first = np.full(len(segments), LAST_ID, dtype=np.int64)
        np.minimum.at(first, of, least)
        last = np.full(len(segments), -LAST_ID - 1, dtype=np.int64)
        np.maximum.at(last, of, most)
        by_gram = np.empty(len(segments), dtype=U)
        by_gram[of] = gram
        order, heads = _grouped(by_gram)
        counts = np.diff(np.append(heads, len(order)))
        runs: list[tuple[np.ndarray, ...]] = []              # (segment, window, windows, id)
        alone = order[heads[counts == 1]]                    # no other segment has this gram
        alone = alone[first[alone] < last[alone]]
        sizes = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        runs.append((alone, np.zeros(len(alone), np.int64), sizes[alone] - length + 1, first[alone]))
        group: list[int] = []
        symbols = 0

        def search() -> None:
            mine = np.array(group)
            ids, before = window_ids([segments[i] for i in group], first[mine], length)
            windows = sizes[mine] - length + 1
            of_window = np.repeat(np.arange(len(mine)), windows)
            new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (of_window[1:] != of_window[:-1])))
            at = np.flatnonzero(new)
            seg = of_window[at]
            runs.append((mine[seg], at - before[seg], np.diff(np.append(at, len(ids))), ids[at]))

        for a, n in zip(heads[counts > 1].tolist(), counts[counts > 1].tolist()):
            mine = order[a:a + n]
            if group and symbols + int(sizes[mine].sum()) + n > SYMBOLS:
                search()
                group, symbols = [], 0
            group += mine.tolist()
            symbols += int(sizes[mine].sum()) + n
        if group:
            search()
        seg, window, windows, ids = (np.concatenate(x) for x in zip(*runs))
        by_seg = np.argsort(seg, kind="stable")
        seg, window, windows, ids = seg[by_seg], window[by_seg], windows[by_seg], ids[by_seg]
        from_ = np.searchsorted(seg, of, "left")
        n_runs = np.searchsorted(seg, of, "right") - from_
        e = np.repeat(np.arange(len(of)), n_runs)
        r = np.repeat(from_ - (np.cumsum(n_runs) - n_runs), n_runs) + np.arange(len(e))
        told = ids[r] < most[e]
        e, r = e[told], r[told]
        edges = np.flatnonzero(np.concatenate(([True], where[e][1:] != where[e][:-1]))).tolist() if len(e) else []
        out = []
        for a, b in zip(edges, [*edges[1:], len(e)]):
            out.append(dict(kind=0, key=0, part=part[where[e[a]]], entry=_blob(entry[e[a:b]], "<u4"),
                            gram=_blob(window[r[a:b]], "<u4"), size=_blob(windows[r[a:b]], "<u4"),
                            least=_blob(ids[r[a:b]], "<i8")))
        return pa.Table.from_pylist(out, schema=_SEGMENT_SCHEMA)

    def answer(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in table.schema.names}
        at = {k: [i for i, x in enumerate(columns["kind"]) if x == k] for k in (0, 1, 2)}
        read = lambda k, c, kind: _read([columns[c][i] for i in at[k]], kind)
        ids, hashes = read(2, "least", "<i8"), read(2, "most", "<i8")
        entry, doc, start = read(1, "entry", "<u4"), read(1, "gram", "<u4"), read(1, "least", "<i8")
        told, window, windows, least = (read(0, "entry", "<u4"), read(0, "gram", "<u4"), read(0, "size", "<u4"),
                                        read(0, "least", "<i8"))
        order = np.argsort(told, kind="stable")
        told = told[order]
        from_ = np.searchsorted(told, entry, "left")
        n_runs = np.searchsorted(told, entry, "right") - from_
        o = np.repeat(np.arange(len(entry)), n_runs)
        r = order[np.repeat(from_ - (np.cumsum(n_runs) - n_runs), n_runs) + np.arange(len(o))]
        goes = least[r] < ids[doc[o]]
        o, r = o[goes], r[goes]
        doc, lo = doc[o].astype(np.int64), start[o] + window[r]
        hi = lo + windows[r] + length - 1
        order = np.lexsort((lo, doc))
        doc, lo, hi = doc[order], lo[order], hi[order]
        if not len(doc):
            return _SPAN_SCHEMA.empty_table()
        reach = np.maximum.accumulate(hi + doc * (int(hi.max()) + 2)) - doc * (int(hi.max()) + 2)
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (lo[1:] > reach[:-1])))
        heads = np.flatnonzero(new)
        doc, lo, hi = doc[heads], lo[heads], reach[np.append(heads[1:], len(doc)) - 1]
        edges = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        pairs = np.stack([lo, hi], axis=1)
        spans = [_plain(pairs[a:b], "<i8") for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(doc)])]
        mine = doc[edges]
        return pa.table({"id": pa.array(ids[mine]), "hash": pa.array(hashes[mine]),
                         "spans": pa.array(spans, pa.binary())})

    sent = map_batches(rows, send, SEGMENTS)
    expanded = sent.groupBy("kind", "key").applyInArrow(expand, SEGMENTS)
    found = expanded.groupBy("part").applyInArrow(answer, "id long, hash long, spans binary")
    return found.groupBy("id", "hash").agg(F.first("spans").alias("spans"))      # equal for equal rows


_SPAN_SCHEMA = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("spans", pa.binary())])
_SEGMENT_SCHEMA = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("part", pa.int64()),
                             *((c, pa.binary()) for c in ("entry", "gram", "size", "bytes", "least", "most"))])


def _with_spans(rows: DataFrame, length: int, n_bytes: int) -> DataFrame:
    """``rows`` (doc_id, raw, whatever else) with ``spans``: the [start, end) byte ranges, disjoint
    and in order as pairs of little-endian longs, that go; null where none do."""
    if length < GRAM + TINY:
        raise ValueError(f"length must be at least {GRAM + TINY}")
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST_ID))).withColumn("hash", F.xxhash64("raw"))
    bits = max(4, (n_bytes // BUCKET_BYTES).bit_length())
    wanted = _shared_grams(rows.select("id", "hash", "raw"), bits, length)
    # both joins take all columns, so that one exchange by (id, hash) serves both
    spans = _spans(rows.join(wanted, ["id", "hash"]), bits, length)
    return rows.join(spans, ["id", "hash"], "left").drop("id", "hash")


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, raw, spans) of every document."""
    return _with_spans(texts(docs, id_col, text_col), length, total_bytes(docs, text_col))


def cut_out(raw: bytes, spans: np.ndarray) -> bytes:
    kept, at = [], 0
    for lo, hi in spans.tolist():
        kept.append(raw[at:lo])
        at = hi
    return b"".join([*kept, raw[at:]])


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): kept are the bytes that stay, joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            kept, sizes, removed, count = [], [], [], []
            for raw, spans in zip(b.column("raw").to_pylist(), b.column("spans").to_pylist()):
                pairs = np.frombuffer(spans or b"", "<i8").reshape(-1, 2)
                kept.append(cut_out(raw, pairs))
                sizes.append(len(raw)), removed.append(len(raw) - len(kept[-1])), count.append(len(pairs))
            yield batch(doc_id=b.column("doc_id"), n_bytes=pa.array(sizes, pa.int64()),
                        n_removed=pa.array(removed, pa.int64()), n_spans=pa.array(count, pa.int64()),
                        kept=pa.array(kept, pa.binary()))

    return map_batches(repeated_spans(docs, length, id_col, text_col).select("doc_id", "raw", "spans"), run,
                       "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same with the SHA-256 of the bytes that stay in their place."""
    return without_repeats(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                F.sha2("kept", 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their texts cut; characters of which only a part stays go, and rows that
    lose their whole text."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw"),
                       F.col(text_col).isNull().alias("none"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(others)])
    rows = _with_spans(rows, length, total_bytes(docs, text_col))
    kept = [f"c{k}" for k in range(len(others))]
    schema = "".join(f"{k} {rows.schema[k].dataType.simpleString()}, " for k in kept) + "text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            out, stays = [], []
            for raw, none, spans in zip(*(b.column(c).to_pylist() for c in ("raw", "none", "spans"))):
                text = cut_out(raw, np.frombuffer(spans or b"", "<i8").reshape(-1, 2)).decode("utf-8", "ignore")
                out.append(None if none else text)
                stays.append(bool(text) or not raw)
            columns = [*(b.column(k) for k in kept), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text"]).filter(pa.array(stays, pa.bool_()))

    cut = map_batches(rows.select("raw", "none", "spans", *kept), run, schema)
    back = dict(zip(others, kept)) | {text_col: "text"}
    return cut.select(*[F.col(back[c]).alias(c) for c in docs.columns])
