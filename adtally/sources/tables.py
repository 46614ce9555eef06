"""Target tables: DDL, loaded dates, idempotent per-date writes, a second sink, JDBC.

Targets are partitioned by ``date`` (text ``yyyy-MM-dd``). Writes replace exactly the
date partitions present in the written frame (dynamic partition overwrite), so a replay of
a report, even from a lost streaming checkpoint, leaves one copy. Columns are matched by
name, never by position.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.sources.archive import literal_path
from adtally.sources.published import PublishedSink, names_in, publish, published_dates, read_published

# --- fixed values: target table columns --------------------------------------------------
NATIONAL_DDL = (
    "page_name STRING, disclaimer STRING, amt_spent BIGINT, num_of_ads BIGINT, "
    "page_id STRING, date STRING"
)
REGIONAL_DDL = (
    "page_name STRING, disclaimer STRING, amt_spent BIGINT, region STRING, "
    "page_id STRING, date STRING"
)
# -----------------------------------------------------------------------------------------


def create_target(
    spark: SparkSession,
    table: str,
    regional: bool = False,
    location: str | None = None,
) -> None:
    """Create a date-partitioned parquet target unless it exists.

    A session's catalog may forget its tables (the default one does) while their folders
    last. So a folder that already holds data, at ``location`` or where a table of that name
    would lie, becomes the table's folder, and its partitions are recovered.
    """
    _create(spark, table, REGIONAL_DDL if regional else NATIONAL_DDL, location)


def open_table(spark: SparkSession, table: str) -> DataFrame:
    """A target's rows; a table the catalog has forgotten is found by its folder."""
    if not spark.catalog.tableExists(table):
        place = _default_location(spark, table)
        if not _exists(spark, place):
            raise ValueError(f"no table {table}, and no folder {place}")
        regional = "region" in spark.read.parquet(literal_path(place)).columns
        create_target(spark, table, regional)
    return spark.table(table)


def _create(spark: SparkSession, table: str, ddl: str, location: str | None, by: str = "PARTITIONED BY (date)") -> None:
    if spark.catalog.tableExists(table):
        return
    place = location or _default_location(spark, table)
    found = _exists(spark, place)
    where = " LOCATION '{}'".format(place.replace("'", "\\'")) if location or found else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {by}{where}")
    if found and by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _default_location(spark: SparkSession, table: str) -> str:
    *database, name = table.split(".")
    base = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{base.locationUri.rstrip('/')}/{name.strip('`').lower()}"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def create_like(spark: SparkSession, table: str, like: str, location: str | None = None) -> None:
    """New empty table with the columns and partitioning of ``like``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} LIKE {like}{where}")


def loaded_dates(spark: SparkSession, table: str) -> DataFrame:
    """Distinct report dates already in a table, as one string column ``date``.

    Where the table is partitioned by date, the catalog answers without opening a data file
    (``SHOW PARTITIONS``); writes here only ever create partitions of loaded dates. Another
    table is scanned instead.
    """
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if partitions == ["date"]:
        parts = spark.sql(f"SHOW PARTITIONS {table}")
        return parts.select(F.regexp_extract("partition", r"^date=(.*)$", 1).alias("date"))
    return spark.table(table).select(F.col("date").cast("string").alias("date")).distinct()


def loaded_dates_jdbc(spark: SparkSession, url: str, table: str, **props: str) -> DataFrame:
    """Distinct dates of a relational table; the DISTINCT runs in the database."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("query", f"SELECT DISTINCT date FROM {table}")
        .options(**props)
        .load()
        .select(F.col("date").cast("string").alias("date"))
    )


#: Spark's own file formats: an overwrite of these replaces just the written partitions.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


@dataclass(frozen=True)
class PathSink:
    """A date-partitioned folder in a file format of Spark's (``parquet``, ``orc``, ``json``,
    ``csv``, ``avro``), used where a table name is accepted. Other formats are refused: a
    connector need not replace single dates, and would then replace the whole target."""

    path: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.format not in FILE_FORMATS:
            raise ValueError(f"a folder's format must be one of {FILE_FORMATS}, not {self.format!r}")

    def __hash__(self) -> int:
        return hash((self.path, self.format))


Sink = str | PathSink | PublishedSink


def read_sink(spark: SparkSession, sink: Sink) -> DataFrame | None:
    """Rows of a sink with ``date`` as text, or None for a folder not written yet."""
    if isinstance(sink, str):
        return spark.table(sink)
    if isinstance(sink, PublishedSink):
        return read_published(spark, sink)
    if not _exists(spark, sink.path):
        return None
    try:
        df = spark.read.format(sink.format).options(**sink.options).load(literal_path(sink.path))
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None  # the folder holds no file yet
    return df.withColumn("date", F.col("date").cast("string"))


def sink_dates(spark: SparkSession, sink: Sink) -> DataFrame:
    """Distinct loaded dates of a table or folder sink, also those whose report was empty.

    No data file is opened: partitions, folder names or the manifest hold the dates.
    """
    if isinstance(sink, str):
        return loaded_dates(spark, sink)
    if isinstance(sink, PublishedSink):
        return published_dates(spark, sink).select("date")
    names = [n.removeprefix("date=") for n in names_in(spark, sink.path) if n.startswith("date=")]
    return spark.createDataFrame([(n,) for n in names], "date string")


def empty_dates(spark: SparkSession, sink: Sink, dates: list[str]) -> None:
    """Take the rows of ``dates`` away and keep the dates as loaded: their reports were empty.

    An overwrite replaces only the dates that have rows. A table gets an empty partition, a
    folder an empty one with a hidden marker file.
    """
    for d in dates:
        if isinstance(sink, str):
            columns = ", ".join(f"CAST(NULL AS {t}) AS `{c}`" for c, t in spark.table(sink).dtypes if c != "date")
            spark.sql(f"INSERT OVERWRITE TABLE {sink} PARTITION (date = '{d}') SELECT {columns} WHERE false")
            spark.sql(f"ALTER TABLE {sink} ADD IF NOT EXISTS PARTITION (date = '{d}')")
        else:
            jvm = spark._jvm.org.apache.hadoop.fs
            path = jvm.Path(f"{sink.path.rstrip('/')}/date={d}")
            fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
            fs.delete(path, True)
            fs.mkdirs(path)
            fs.create(jvm.Path(path, "_empty"), True).close()


def loaded_in_all(spark: SparkSession, tables: list[Sink]) -> DataFrame:
    """Dates present in every one of ``tables``: a date counts as loaded only when all
    sinks have it, so a crash between two sink writes is repaired by the next run."""
    frames = [sink_dates(spark, t) for t in tables]
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, "date", "left_semi")
    return out


@contextmanager
def _single_dates(spark: SparkSession):
    """``partitionOverwriteMode`` dynamic for a write, then as it was.

    insertInto ignores a per-write option and the v2 writer refuses v1 file tables, so the
    session's setting is the only way.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _by_name(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    cols = spark.table(table).columns
    return df.select(*[F.col(c) for c in cols])


def overwrite_dates(df: DataFrame, table: Sink, columns: list[str] | None = None) -> None:
    """Replace the date partitions present in ``df`` (idempotent load per date).

    The ``rebalance`` hint lets adaptive execution split a date that holds a large share
    of the rows over several writers and merge small dates, instead of one file per
    shuffle partition and date. That needs ``spark.sql.adaptive.enabled``, which is on by
    default; without it a large date is written by one task. A ``PathSink`` is written with
    ``columns`` (default: the frame's) partitioned by ``date``. Dates without rows in ``df`` stay
    as they are; see ``empty_dates``.
    """
    spark = df.sparkSession
    if isinstance(table, PathSink):
        cols = [c for c in (columns or df.columns) if c != "date"] + ["date"]
        (
            df.select(*cols).hint("rebalance", "date").write.format(table.format)
            .options(**table.options).mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("date").save(table.path)
        )
        return
    out = _by_name(spark, df, table).hint("rebalance", "date")
    with _single_dates(spark):
        out.write.insertInto(table, overwrite=True)


def replace_dates(df: DataFrame, sink: PathSink | PublishedSink, dates: list[str]) -> None:
    """Replace ``dates`` in a folder sink by the rows of ``df``; dates without rows become empty."""
    if isinstance(sink, PublishedSink):
        publish(df, [sink], dates)
        return
    overwrite_dates(df, sink)
    spark = df.sparkSession
    filled = {r.date for r in df.select("date").distinct().collect()}
    empty_dates(spark, sink, sorted(set(dates) - filled))


# --- the ledger of a target ---------------------------------------------------------------

_LEDGER_DDL = "path STRING, modified TIMESTAMP, date STRING"


def ledger_of(sink: Sink) -> Sink:
    """Beside a target: which archive each date came from, and when that was modified."""
    return f"{sink}__loads" if isinstance(sink, str) else PathSink(f"{sink.path.rstrip('/')}__loads")


def record_loads(spark: SparkSession, sink: Sink, loads: list[tuple]) -> None:
    """Appends notes of ``loads`` (archive, modified, date), one small file a load; of a date's
    notes the latest modification counts, so a repeated note does no harm.

    To be called before the rows of new dates are written and after those of replaced ones:
    a date that is noted but not in the target is loaded again, and so is a date whose note
    is older than its archive. A crash at any point then costs a reload, never a stale date.
    """
    if not loads:
        return
    ledger = ledger_of(sink)
    notes = spark.createDataFrame(loads, _LEDGER_DDL).coalesce(1)
    if isinstance(ledger, str):
        _create(spark, ledger, _LEDGER_DDL, None, by="")
        notes.write.insertInto(ledger, overwrite=False)
    else:
        notes.write.mode("append").parquet(ledger.path)


def with_ledger(spark: SparkSession, sink: Sink, dates: DataFrame) -> DataFrame:
    """``date, modified`` of the loaded ``dates``; ``modified`` is null for dates that no
    load has noted."""
    if isinstance(sink, PublishedSink):
        return dates.join(published_dates(spark, sink).select("date", "modified"), "date", "left")
    ledger = ledger_of(sink)
    unknown = dates.withColumn("modified", F.lit(None).cast("timestamp"))
    if isinstance(ledger, str):
        if not spark.catalog.tableExists(ledger) and not _exists(spark, _default_location(spark, ledger)):
            return unknown
        _create(spark, ledger, _LEDGER_DDL, None, by="")
    notes = read_sink(spark, ledger)
    if notes is None:
        return unknown
    return dates.join(notes.groupBy("date").agg(F.max("modified").alias("modified")), "date", "left")


def append(df: DataFrame, table: str) -> None:
    """Plain append by column name (no idempotency)."""
    spark = df.sparkSession
    _by_name(spark, df, table).write.insertInto(table, overwrite=False)


def overwrite_dates_two_sinks(df: DataFrame, first: Sink, second: Sink, dates: list[str]) -> None:
    """Write the same rows, all of report dates ``dates``, to two sinks.

    The frame is computed once: the second sink is filled from the date partitions just
    written to the first (partition pruning on ``date``), which also cuts the lineage
    before the second write.
    """
    spark = df.sparkSession
    overwrite_dates(df, first)
    loaded = spark.createDataFrame([(d,) for d in dates], "date string")
    # the dates of a load: at most one row a calendar day, and dynamic partition pruning by them
    written = read_sink(spark, first).join(F.broadcast(loaded), "date", "left_semi")
    overwrite_dates(written, second, columns=df.columns)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **props: str) -> None:
    """Append to a relational table over JDBC."""
    df.write.jdbc(url, table, mode=mode, properties=props)
