"""Session and shared-folder helpers."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this engine wants; a cluster may override them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (thousands of executors, ~100 TB of captures).
# Reads are split at 256 MiB; shuffles start wide and AQE coalesces them to
# ~256 MiB each, so no task holds more than a few hundred MiB whatever the
# data size; skewed partitions (> 5x the median and > 1 GiB) of sort-merge
# joins are split by AQE.  Hot keys of windows and aggregations are handled
# by the operators themselves (salting, map-side combine).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    # Arrow batches into the tokeniser are bounded by rows only; pages can be
    # megabytes, so a small row count keeps a batch in the tens of MiB
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the engine defaults (plus
    ``CLUSTER_CONF`` when ``cluster``)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``; only when it is unset
    (local runs and tests) a private folder is created and set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no context view
        sc = None
    if sc is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("name a shared folder in spark.checkpoint.dir")
        return current
    current = sc.getCheckpointDir()
    if not current:
        current = sc.getConf().get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("name a shared folder in spark.checkpoint.dir")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that
    tasks can import it from whatever folder they run in."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="tidemark-package-")) / "tidemark.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    sc.addPyFile(str(path))                # Spark's own file server hands it out
    sc._tidemark_shipped = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: computed once, without
    lineage, safe from the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
