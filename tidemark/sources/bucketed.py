"""Stored tables in key buckets: a run reads and writes what its own keys fall in.

``BucketedTarget`` (A3, A4, C7): the rows of a first-write-wins table, appended by runs, in
folders ``key_bucket=B/run_id=N``.  The anti join of a run reads the buckets of its keys
only (partition pruning), not the keys of the whole table.

``BucketedState`` (C6, I3): the latest logged digest of every page, in folders
``data/page_bucket=B/run_id=N``, and for each run a manifest: which run's folder holds each
bucket.  A run rewrites the buckets in which it logged a page, and refers to the others.

In both, a run reads folders of earlier runs only and overwrites its own, so it may be
repeated; the state's manifest is written last, so a run that failed is never read.  Lists of buckets
on the driver are bounded by the number of buckets, which must stay the same for a table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.change import compact_state
from tidemark.schemas import TargetSpec

KEY_BUCKETS = 256
STATE_BUCKETS = 1024

STATE_SCHEMA = "page_uid string, data_uid string, capture_seq long"
AUDIT_SCHEMA = "created_time timestamp, updated_time timestamp"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key: of its text, so that it doesn't depend on the integer type."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def touched(rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets that ``rows`` fall in."""
    found = rows.select(bucket_of(keys, buckets).alias("b")).distinct().collect()
    return sorted(r["b"] for r in found)


def _put(rows: DataFrame, path: str, bucket: str) -> None:
    """Overwrite the folders (bucket, run_id) of ``rows``; one file for each."""
    (rows.repartition(bucket).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(bucket, "run_id").parquet(path))


class BucketedTarget:
    def __init__(self, spark: SparkSession, path: str, spec: TargetSpec, run_id: int,
                 buckets: int = KEY_BUCKETS):
        self.spark, self.path, self.spec, self.run_id, self.buckets = spark, path, spec, run_id, buckets

    def upto(self, run_id: int) -> DataFrame | None:
        """The rows of runs up to ``run_id``; None when nothing was written yet."""
        columns = ", ".join(f"{c.name} {c.type}" for c in self.spec.columns)
        try:
            df = self.spark.read.schema(f"{columns}, {AUDIT_SCHEMA}, key_bucket int, run_id long").parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return df.filter(F.col("run_id") <= run_id)

    def earlier(self) -> DataFrame | None:
        """The rows of all earlier runs."""
        df = self.upto(self.run_id - 1)
        return None if df is None else df.select(*self.spec.column_names)

    def holding(self, batch: DataFrame) -> DataFrame | None:
        """The rows of earlier runs in the buckets of ``batch``'s keys."""
        df = self.upto(self.run_id - 1)
        if df is None:
            return None
        mine = touched(batch, list(self.spec.keys), self.buckets)
        return df.filter(F.col("key_bucket").isin(mine)).select(*self.spec.column_names)

    def append(self, rows: DataFrame) -> None:
        """This run's rows, with audit columns."""
        _put(rows.select("*", bucket_of(list(self.spec.keys), self.buckets).alias("key_bucket"),
                         F.lit(self.run_id).cast("long").alias("run_id")), self.path, "key_bucket")


class BucketedState:
    def __init__(self, spark: SparkSession, path: str, prior_run_id: int | None = None,
                 buckets: int = STATE_BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.data, self._manifests = f"{path}/data", f"{path}/manifest"
        self.versions = {} if prior_run_id is None else self._versions(prior_run_id)

    def _versions(self, run_id: int) -> dict[int, int]:
        """The run that wrote each bucket last, as of ``run_id``: a row for each bucket at most."""
        rows = self.spark.read.schema("page_bucket int, written_by long").parquet(f"{self._manifests}/run_id={run_id}")
        return {r["page_bucket"]: r["written_by"] for r in rows.collect()}

    def _read(self, buckets: list[int] | None = None) -> DataFrame | None:
        paths = [f"{self.data}/page_bucket={b}/run_id={self.versions[b]}"
                 for b in (self.versions if buckets is None else buckets) if b in self.versions]
        return self.spark.read.schema(STATE_SCHEMA).parquet(*paths) if paths else None

    def all(self) -> DataFrame:
        """The state of every page."""
        rows = self._read()
        return self.spark.createDataFrame([], STATE_SCHEMA) if rows is None else rows

    def of(self, pages: DataFrame) -> DataFrame | None:
        """The state of ``pages`` (page_uid), from their buckets; None where there is none."""
        rows = self._read(touched(pages, ["page_uid"], self.buckets))
        return None if rows is None else rows.join(pages, "page_uid", "left_semi")

    def advance(self, logged: DataFrame, run_id: int) -> None:
        """The state after ``run_id`` logged ``logged`` (page_uid, data_uid, capture_seq)."""
        mine = touched(logged, ["page_uid"], self.buckets)
        rows = logged.select("page_uid", "data_uid", "capture_seq", F.lit(1).alias("_run"))
        before = self._read(mine)
        if before is not None:
            rows = before.withColumn("_run", F.lit(0)).unionByName(rows)
        # what this run logs comes after all that earlier runs logged
        _put(compact_state(rows, arrival="_run").select(
            "page_uid", "data_uid", "capture_seq", bucket_of(["page_uid"], self.buckets).alias("page_bucket"),
            F.lit(run_id).cast("long").alias("run_id")), self.data, "page_bucket")
        now = self.versions | {b: run_id for b in mine}
        self.spark.createDataFrame(sorted(now.items()), "page_bucket int, written_by long").coalesce(1) \
            .write.mode("overwrite").parquet(f"{self._manifests}/run_id={run_id}")
