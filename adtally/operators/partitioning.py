"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _has_exchange(plan) -> bool:
    """Whether a physical plan holds a shuffle or broadcast, by its nodes."""
    kind = plan.getClass().getSimpleName()
    if "Exchange" in kind:
        return True
    if kind == "AdaptiveSparkPlanExec":
        return _has_exchange(plan.initialPlan())
    children = plan.children()
    return any(_has_exchange(children.apply(i)) for i in range(children.size()))


def input_partitions(df: DataFrame) -> int | None:
    """Number of partitions a frame without a shuffle will have, or None when its plan
    already shuffles (then its width is the shuffle's) or cannot be inspected.

    Only the plan is built: for a plan that holds an exchange, asking its RDD would make
    adaptive execution run the shuffle stages, so such plans are not asked.
    """
    try:
        qe = df._jdf.queryExecution()
        if _has_exchange(qe.executedPlan()):
            return None
        return int(qe.toRdd().getNumPartitions())
    except Exception:  # noqa: BLE001 - e.g. a remote session without plan access
        return None


# Input bytes per spread partition: small enough that a single parquet file of a few MB
# feeds every local core, large enough that a small file on a cluster with thousands of
# cores does not become thousands of tiny tasks.
SPREAD_BYTES = 128 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the frame (None when unknown)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(size.toString())
    except Exception:  # noqa: BLE001
        return None


def spread(
    df: DataFrame, *keys: str, partitions: int | None = None, min_bytes: int = SPREAD_BYTES
) -> DataFrame:
    """Hash-partition ``df`` on ``keys`` when it has fewer partitions than it should.

    A single small file, one parquet row group or a few unsplittable archives give one
    task for all the per-row work that follows; spreading lets it use more cores. The
    target is ``partitions`` (default: the cluster's cores), capped at one partition per
    ``min_bytes`` of estimated input. With at least that many input partitions (the
    usual case on large inputs), or when the plan already ends in a shuffle, the frame is
    returned unchanged and no shuffle is added. ``keys`` should be close to unique so
    that no partition receives a hot key.
    """
    target = partitions or df.sparkSession.sparkContext.defaultParallelism
    size = estimated_bytes(df)
    if size is not None:
        target = max(1, min(target, size // min_bytes))
    n = input_partitions(df)
    if n is None or n >= target:
        return df
    return df.repartition(target, *keys)
