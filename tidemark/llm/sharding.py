"""Placement of rows on shards through a permutation-filled lookup table (SQL functions only).

Each shard prefers the slots of a table of prime size M in an order of its own: it starts at
a hashed slot and steps by a hashed amount, which visits every slot once.  Shards take turns;
at its turn a shard claims the first slot in its order that is free, until the table is full.
So shards own equally many slots (to within one), and when a shard leaves or joins, few slots
but its own change hands.  A row's slot is the hash of its key modulo M; the table has
``MAX_SLOTS`` rows at most, is broadcast, and each row finds its shard by one lookup.

The table is filled by one ``aggregate`` over the M turns, in SQL; its size is a parameter and
doesn't grow with the data.  Hashes are the first 32 bits of MD5.

A null key is placed like the empty text; repeated keys share a shard; an empty table gives no
row; other columns of the table are kept by ``place`` (``slot`` and ``shard`` must not be among
them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{k:02d}" for k in range(64))
#: A prime, over a hundred times the shards.
SLOTS = 8191
#: The largest size whose fill was measured: 16,381 slots take 6 s, 8,191 take 4 s.
MAX_SLOTS = 1 << 14
#: Preferences looked at first; the others only if none of these is free.
NEAR = 64


def hashed(text: Column) -> Column:
    """The first 32 bits of a text's MD5, as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) for the slots 0 to ``slots`` - 1."""
    if not _is_prime(slots) or slots > MAX_SLOTS:
        raise ValueError("slots must be a prime of at most MAX_SLOTS")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shards must be distinct, and no more than slots")
    if len(shards) >= 0xFFFF:
        raise ValueError("a slot has two bytes for its shard")
    names = F.array(*[F.lit(s) for s in shards])
    first = F.transform(names, lambda s: hashed(F.concat(s, F.lit("/first"))) % slots)
    step = F.transform(names, lambda s: hashed(F.concat(s, F.lit("/step"))) % (slots - 1) + 1)
    start = spark.range(1, numPartitions=1).select(names.alias("names"), first.alias("first"), step.alias("step"))
    at = "int((p.first[i] + j * p.step[i]) % {m})"
    free = f"j -> substring(s.owner, 2 * {at} + 1, 2) = X'FFFF'"
    # the table is a binary of two bytes a slot, so that a turn copies bytes, not array elements;
    # p, i, j and slot are bound by one-element arrays, so that each is computed once
    filled = f"""
        transform(array(named_struct('first', first, 'step', step)), p -> aggregate(
            sequence(0, {{m}} - 1),
            named_struct('owner', unhex(repeat('FFFF', {{m}})), 'next', array_repeat(0L, {len(shards)})),
            (s, turn) -> transform(array(int(turn % {len(shards)})), i ->
                transform(array(coalesce(
                    get(filter(sequence(s.next[i], least(s.next[i] + {NEAR}, {{m}} - 1L)), {free}), 0),
                    get(filter(sequence(s.next[i], {{m}} - 1L), {free}), 0))), j ->
                    transform(array({at}), slot -> named_struct(
                        'owner', concat(substring(s.owner, 1, 2 * slot), unhex(lpad(hex(i), 4, '0')),
                                        substring(s.owner, 2 * slot + 3)),
                        'next', concat(slice(s.next, 1, i), array(j), slice(s.next, i + 2, {len(shards)}))
                    ))[0])[0])[0],
            s -> transform(sequence(0, {{m}} - 1),
                           slot -> int(conv(hex(substring(s.owner, 2 * slot + 1, 2)), 16, 10)))))[0]"""
    owner = F.expr(filled.replace("{m}", str(slots)))
    return start.select("names", owner.alias("owner")).select("names", F.posexplode("owner").alias("slot", "k")) \
        .select("slot", F.expr("names[k]").alias("shard"))


def place(rows: DataFrame, key: Column, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; the table is checked to be of ``slots`` rows at most."""
    at = (hashed(F.coalesce(key.cast("string"), F.lit(""))) % slots).cast("int")
    return rows.withColumn("slot", at).join(F.broadcast(table.filter(F.col("slot") < slots)), "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder for each shard; a shard's rows are written by as many tasks as hold some."""
    placed.write.partitionBy("shard").parquet(path)


#: DuckDB: the same fill, a turn for each step of the recursion.
ORACLE = f"""
WITH RECURSIVE shards AS (
    SELECT k, 'shard-' || lpad(k::VARCHAR, 2, '0') AS shard FROM range({len(SHARDS)}) r(k)),
prefs AS (
    SELECT list(('0x' || substr(md5(shard || '/first'), 1, 8))::BIGINT % {SLOTS} ORDER BY k) AS first,
           list(('0x' || substr(md5(shard || '/step'), 1, 8))::BIGINT % {SLOTS - 1} + 1 ORDER BY k) AS step
    FROM shards),
fill AS (
    SELECT 0 AS turn, [-1 FOR x IN range({SLOTS})] AS owner, first, step FROM prefs
    UNION ALL
    SELECT turn + 1,
           list_concat(owner[1:slot], [turn % {len(SHARDS)}], owner[slot + 2:]), first, step
    FROM (SELECT turn, owner, first, step,
                 (first[turn % {len(SHARDS)} + 1] + step[turn % {len(SHARDS)} + 1]
                  * list_filter(range({SLOTS}), lambda j: owner[(first[turn % {len(SHARDS)} + 1]
                        + j * step[turn % {len(SHARDS)} + 1]) % {SLOTS} + 1] = -1)[1]) % {SLOTS} AS slot
          FROM fill WHERE turn < {SLOTS})),
slots AS (
    SELECT unnest(range({SLOTS})) AS slot, unnest(owner) AS k FROM fill WHERE turn = {SLOTS})
SELECT d.doc_id, d.slot::INTEGER AS slot, shards.shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS} AS slot
      FROM documents) d JOIN slots USING (slot) JOIN shards USING (k)
"""
