"""I3 for every target: the whole batch run inside ``foreachBatch``.

Micro-batch N is run N (``plans.crawl_run.run_batch``): it reads only outputs
of earlier batch ids and overwrites its own ``run_id=N`` folders, so a
replayed micro-batch rewrites the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.crawl_run import run_batch


def start_crawl_stream(captures: DataFrame, out_root: str, checkpoint: str,
                       level_dim: DataFrame | None = None, manifest: DataFrame | None = None,
                       available_now: bool = True) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        out = run_batch(batch.sparkSession, batch, out_root, batch_id,
                        batch_id - 1 if batch_id > 0 else None,
                        level_dim=level_dim, manifest=manifest)
        out["plan"].write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/plan/run_id={batch_id}")

    w = captures.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
