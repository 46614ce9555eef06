"""Incremental ingest of report archives with Structured Streaming.

The file source tracks which archives it has seen; only ``path`` and
``modificationTime`` are selected, so it never reads archive contents itself. Every
micro-batch goes through the same choice of new reports and idempotent per-date write as
the batch pipeline, which decides by modification time and not by the cut into batches.
Losing the checkpoint is harmless: the targets are checked again and a re-read date
replaces its own partition. Rejected archives are logged and, with ``problems``, stored; the
stream goes on.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adtally.plans.kinds import ReportKind, get_kind
from adtally.plans.loader import load_listing
from adtally.sources.archive import BINARY_SCHEMA, select_archives


LOG = logging.getLogger(__name__)


def archive_stream(
    spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming listing of ZIP files in ``source_dir`` (metadata columns only).

    ``max_files_per_trigger`` bounds the archives per micro-batch, so a large backlog
    is loaded in several bounded jobs instead of one.
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (
        reader.option("pathGlobFilter", "*.zip")
        .load(source_dir)
        .select("path", "modificationTime", "length")
    )


def start_ingest(
    spark: SparkSession,
    kind: str | ReportKind,
    source_dir: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "2 hours",
    query_name: str | None = None,
    max_files_per_trigger: int | None = None,
    **options,
) -> StreamingQuery:
    """Start the ingest of one report kind; ``options`` as for ``load_listing``.

    ``available_now`` drains what is there and stops (run it from a scheduler);
    otherwise the folder is polled every ``interval``.
    """
    k = get_kind(kind)

    def load_batch(files: DataFrame, epoch_id: int) -> None:
        # an exception here would fail the same batch again at every restart
        chosen = {"on_reject": "return", **options}
        loaded = load_listing(files.sparkSession, select_archives(files, k), k, **chosen)
        for path, reason in loaded.rejected:
            LOG.warning("not loaded: %s: %s", path, reason)

    writer = (
        archive_stream(spark, source_dir, max_files_per_trigger)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
