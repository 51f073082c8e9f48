"""Incremental refresh of the change log (I1, I3, P4 as a stream).

``foreachBatch`` form (the default):
  the state (latest logged digest per page) is kept log-structured: the log
  delta a batch writes (``log/batch_id=N``) is itself the state change of that
  batch, and every ``compact_every`` batches a full snapshot is written
  (``state/batch_id=N``, partitioned by a hash bucket of the page, so a
  batch reads only the buckets its pages fall in).  Batch N reads the last
  snapshot before it plus at most ``compact_every - 1`` deltas, compacts them
  to one row per page and restricts them to the pages it holds; it never
  rewrites the whole state per micro-batch.  All outputs are written per batch
  id with overwrite, and a batch reads only outputs of earlier ids, so a
  replayed batch rewrites the same rows.  Written tables also cut lineage.

``transformWithState`` form (``stateful_changes``):
  the last digest per page lives in the state store as a value state, which starts from
  the compacted log of earlier runs; rows of a page within a micro-batch are processed in
  ``capture_seq`` order.

Both compare captures in arrival order, as the crawl does: by batch, and by
``capture_seq`` within one.  A late capture (a smaller ``capture_seq`` in a
later batch) is compared with what the batches before it logged.  Captures
without url, body or order are not compared; ``rejected_captures`` lists them.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from itertools import chain
from typing import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import change

LOG_COLUMNS = ["capture_seq", "kind", "url", "page_uid", "data_uid", "status"]


STATE_SCHEMA = "page_uid string, capture_seq long, data_uid string"


@dataclass(frozen=True)
class RefreshSink:
    """Folders (in the shared checkpoint area or a table location)."""
    root: str
    initial_state: str | None = None     # compacted state of earlier runs
    compact_every: int = 10              # snapshot period, in batches
    state_buckets: int = 1024            # hash buckets of the snapshot layout

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    def state_of(self, batch_id: int) -> str:
        return f"{self.state}/batch_id={batch_id}"

    def delta_of(self, batch_id: int) -> str:
        """The state change of a batch is its log delta."""
        return self.log_of(batch_id)

    def is_snapshot(self, batch_id: int) -> bool:
        return (batch_id + 1) % self.compact_every == 0

    def last_snapshot_before(self, batch_id: int) -> int | None:
        s = (batch_id // self.compact_every) * self.compact_every - 1
        return s if s >= 0 else None

    def log_of(self, batch_id: int) -> str:
        return f"{self.log}/batch_id={batch_id}"

    def fingerprints_of(self, batch_id: int) -> str:
        return f"{self.root}/fingerprints/batch_id={batch_id}"


def page_bucket(sink: RefreshSink):
    """Hash bucket of a page in the snapshot layout."""
    return F.pmod(F.xxhash64("page_uid"), F.lit(sink.state_buckets)).cast("int")


def _read_snapshot(spark: SparkSession, sink: RefreshSink, snap: int,
                   pages: DataFrame | None) -> DataFrame:
    """A snapshot, reading only the buckets the batch's pages fall in (the
    bucket list is bounded by ``state_buckets``; partition pruning skips the
    other folders)."""
    df = spark.read.parquet(sink.state_of(snap))
    if pages is not None:
        buckets = [r[0] for r in pages.select(page_bucket(sink).alias("b")).distinct().collect()]
        df = df.filter(F.col("page_bucket").isin(buckets))
    return df.select("page_uid", "capture_seq", "data_uid")


def _merged_state(spark: SparkSession, sink: RefreshSink, batch_id: int,
                  upto: int, pages: DataFrame | None = None) -> DataFrame | None:
    """Last snapshot before ``batch_id`` plus the deltas of batches from
    that snapshot up to ``upto`` (exclusive), compacted.  With ``pages``
    every part is first restricted to those pages (a semi join), so only
    the state of pages in the batch is shuffled and compacted."""
    snap = sink.last_snapshot_before(batch_id)
    # every part bears the number of the batch that logged it
    parts: list[DataFrame] = []
    if snap is not None:
        parts.append(_read_snapshot(spark, sink, snap, pages).withColumn("_batch", F.lit(snap)))
    elif sink.initial_state:
        parts.append(spark.read.schema(STATE_SCHEMA).parquet(sink.initial_state)
                     .withColumn("_batch", F.lit(-1)))
    first_delta = (snap + 1) if snap is not None else 0
    deltas = [spark.read.schema(STATE_SCHEMA).parquet(sink.delta_of(b)).withColumn("_batch", F.lit(b))
              for b in range(first_delta, upto)]
    parts += deltas
    if not parts:
        return None
    if pages is not None:
        parts = [p.join(pages, "page_uid", "left_semi") for p in parts]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    # a snapshot is one row per page; a log delta may hold several rows of a
    # page, so anything with deltas in it is compacted to the row logged last
    return change.compact_state(merged, arrival="_batch") if deltas else merged.drop("_batch")


def _prior_state(spark: SparkSession, sink: RefreshSink, batch_id: int,
                 pages: DataFrame | None = None) -> DataFrame | None:
    """State as of the end of batch ``batch_id - 1`` (for ``pages`` only)."""
    return _merged_state(spark, sink, batch_id, batch_id, pages)


def refresh_batch(batch: DataFrame, batch_id: int, sink: RefreshSink) -> None:
    """foreachBatch body: status against earlier batches and the log delta
    (which is also the batch's state change); a snapshot every
    ``compact_every`` batches."""
    spark = batch.sparkSession
    # bodies are hashed once; the change window reads keys and digests only
    change.add_fingerprints(batch.select("capture_seq", "kind", "url", "body")).drop("body") \
        .write.mode("overwrite").parquet(sink.fingerprints_of(batch_id))
    caps, _ = change.rejected(spark.read.parquet(sink.fingerprints_of(batch_id)))
    prior = _prior_state(spark, sink, batch_id, caps.select("page_uid").distinct())
    status = change.change_status(caps, prior_state=prior)
    delta = change.log_delta(status).select(*LOG_COLUMNS)
    delta.write.mode("overwrite").parquet(sink.log_of(batch_id))
    if sink.is_snapshot(batch_id):
        snap = _merged_state(spark, sink, batch_id, batch_id + 1)
        # one task for each bucket, so one file in each of its folders
        snap.select("page_uid", "capture_seq", "data_uid", page_bucket(sink).alias("page_bucket")) \
            .repartition("page_bucket") \
            .write.mode("overwrite").partitionBy("page_bucket").parquet(sink.state_of(batch_id))


def rejected_captures(spark: SparkSession, sink: RefreshSink) -> DataFrame:
    """Captures of all batches that were not compared, with a reason."""
    _, bad = change.rejected(spark.read.parquet(f"{sink.root}/fingerprints"))
    return bad.select("batch_id", "capture_seq", "url", "reason")


def start_refresh_stream(captures: DataFrame, sink: RefreshSink, checkpoint: str,
                         available_now: bool = True) -> StreamingQuery:
    """Run ``refresh_batch`` over a capture stream."""
    w = (captures.writeStream
         .foreachBatch(lambda df, bid: refresh_batch(df, bid, sink))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


# --------------------------------------------------------- state-store form

STATUS_SCHEMA = ("page_uid string, capture_seq long, data_uid string, "
                 "prev_digest string, status string")


#: Settings that the state-store form needs (a session may set them from the start).
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # incremental checkpoints: a micro-batch uploads its changes, not the whole state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _processor_class():
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor
    from pyspark.sql.types import StringType, StructField, StructType

    class LastDigest(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState(
                "last_digest", StructType([StructField("digest", StringType(), True)]))

        def handleInitialState(self, key, initialState, timerValues) -> None:
            """What earlier runs logged of the page: one row."""
            self.last.update((initialState["data_uid"],))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            # the store hands over a page's rows of one micro-batch in any order: only order
            # values and digests are kept, equal digests once, until all are there
            seqs, digests, once = array("q"), [], {}
            unplaced = []                           # without an order value: after all others
            for r in rows:
                d = once.setdefault(r["data_uid"], r["data_uid"])
                if r["capture_seq"] is None:
                    unplaced.append(d)
                else:
                    seqs.append(r["capture_seq"])
                    digests.append(d)
            placed = ((int(seqs[i]), digests[i]) for i in np.argsort(np.frombuffer(seqs, np.int64), kind="stable")) \
                if seqs else ()
            # each call to the store is a round trip: one to read, one to write what is new
            stored = self.last.get()
            prev = stored[0] if stored is not None else None
            status = change.NEW if stored is None else None
            for seq, d in chain(placed, ((None, d) for d in unplaced)):
                if status is None:
                    status = change.UNCHANGED if prev == d else change.CHANGED
                yield Row(page_uid=key[0], capture_seq=seq, data_uid=d, prev_digest=prev, status=status)
                prev, status = d, None
            if stored is None or stored[0] != prev:
                self.last.update((prev,))

        def close(self) -> None:
            pass

    return LastDigest


def stateful_changes(fingerprinted: DataFrame, initial_state: DataFrame | None = None) -> DataFrame:
    """I1 with a value state per page (needs ``STATE_STORE_CONF``).  ``initial_state``
    (page_uid, data_uid), one row per page, is the compacted log of earlier runs; the first
    micro-batch loads it.  A page's rows of one micro-batch are held by one task, as order values and
    references to digests: ``maxFilesPerTrigger`` bounds them.  Rows go in and out as they are:
    most pages have few of them, and a frame for each page costs more than its rows."""
    initial = None if initial_state is None else \
        initial_state.select("page_uid", "data_uid").groupBy("page_uid")
    return (fingerprinted.select("page_uid", "capture_seq", "data_uid")
            .groupBy("page_uid")
            .transformWithState(_processor_class()(), STATUS_SCHEMA, "Append", "None",
                                initialState=initial))
