"""Published folders: the report dates of a load change all at once, in one sink or in two.

Rows are written to a folder of their own (``version=<id>/date=<d>/``), which no reader
looks at until the load's entry is in the manifest. An entry names the version, the dates it
holds (those without rows too) and the archives they came from; it appears by one rename
that fails if the name is taken. Of a date's entries the last counts. So a reader sees a
load whole or not at all, an emptied report takes its date's rows away, and where two sinks
share a manifest they can't show different reports, wherever a load stops. What a stopped
load leaves behind is never read, and ``sweep`` deletes it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ENTRY = (
    "seq BIGINT, version STRING, schema STRING, dates ARRAY<STRING>, filled ARRAY<STRING>, "
    "archives ARRAY<STRUCT<path: STRING, modified: BIGINT, date: STRING>>"
)
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


@dataclass(frozen=True)
class PublishedSink:
    """A folder of published versions; sinks given one ``manifest`` folder change together."""

    path: str
    manifest: str = ""

    @property
    def log(self) -> str:
        return (self.manifest or f"{self.path.rstrip('/')}/_manifest").rstrip("/")

    def version(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/version={name}"


# --- files, through Hadoop's file systems -------------------------------------------------


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def names_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder and when they were last changed (milliseconds); none if it isn't there."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path)}


def put_new(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Make ``folder/name`` with ``text`` by one rename; False if there is one already."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs, path = _fs(spark, folder)
    fs.mkdirs(path)
    draft, final = jvm.Path(path, f"_{uuid.uuid4().hex}"), jvm.Path(path, name)
    out = fs.create(draft, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    context = jvm.FileContext.getFileContext(fs.getUri(), fs.getConf())
    no_options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
    try:
        context.rename(draft, final, no_options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def add_entry(spark: SparkSession, log: str, entry: dict) -> int:
    """Add an entry under the next free number; loads that meet take one number after the other."""
    while True:
        taken = [int(n.removesuffix(".json")) for n in names_in(spark, log) if n.endswith(".json") and n[0] != "_"]
        seq = max(taken, default=0) + 1
        if put_new(spark, log, f"{seq:012d}.json", json.dumps({"seq": seq, **entry})):
            return seq


# --- publishing ---------------------------------------------------------------------------


def check_shared(sinks: list) -> None:
    """Sinks of one load are all published through one manifest, or none of them is."""
    kinds = {isinstance(s, PublishedSink) for s in sinks}
    if kinds == {True, False} or (kinds == {True} and len({s.log for s in sinks}) > 1):
        raise ValueError("published sinks of one load need one manifest, and no sink of another kind beside them")


def publish(df: DataFrame, sinks: list[PublishedSink], dates: list[str], archives: list[tuple] = ()) -> int:
    """Replace ``dates`` in all ``sinks`` by the rows of ``df``, at once; the entry's number.

    Dates without rows in ``df`` become empty. ``archives``: (path, modification time, date)
    of what was loaded. The frame is computed once: further sinks are filled from the first
    one's new version. Until the entry is made nothing that readers see has changed.
    """
    check_shared(sinks)
    spark, version = df.sparkSession, uuid.uuid4().hex
    df.hint("rebalance", "date").write.partitionBy("date").parquet(sinks[0].version(version))
    for sink in sinks[1:]:
        again = spark.read.schema(df.schema).parquet(sinks[0].version(version))
        again.hint("rebalance", "date").write.partitionBy("date").parquet(sink.version(version))
    filled = sorted(n.removeprefix("date=") for n in names_in(spark, sinks[0].version(version)) if n.startswith("date="))
    if extra := set(filled) - set(dates):
        raise ValueError(f"rows of dates that are not being published: {sorted(extra)}")
    micros = lambda t: (t.astimezone(dt.timezone.utc) - _EPOCH) // dt.timedelta(microseconds=1)
    notes = [{"path": p, "modified": micros(m) if m else None, "date": d} for p, m, d in archives]
    entry = {"version": version, "schema": df.schema.json(), "dates": sorted(dates), "filled": filled, "archives": notes}
    return add_entry(spark, sinks[0].log, entry)


def _entries(spark: SparkSession, sink: PublishedSink) -> DataFrame | None:
    if not any(n.endswith(".json") and n[0] != "_" for n in names_in(spark, sink.log)):
        return None
    return spark.read.schema(_ENTRY).json(sink.log)


def published_dates(spark: SparkSession, sink: PublishedSink) -> DataFrame:
    """``date, version, filled, modified`` of every published date: its last entry.

    ``modified`` is that of the archive the date came from. A row a date: the calendar bounds
    it, and it comes from the manifest alone.
    """
    entries = _entries(spark, sink)
    if entries is None:
        return spark.createDataFrame([], "date string, version string, filled boolean, modified timestamp")
    each = entries.select("seq", "version", "filled", "archives", F.explode("dates").alias("date"))
    of_date = F.filter("archives", lambda a: a["date"] == F.col("date"))
    state = F.struct(
        "version", F.array_contains("filled", F.col("date")).alias("filled"),
        F.timestamp_micros(F.array_max(F.transform(of_date, lambda a: a["modified"]))).alias("modified"),
    )
    return each.groupBy("date").agg(F.max_by(state, "seq").alias("s")).select("date", "s.*")


def read_published(spark: SparkSession, sink: PublishedSink) -> DataFrame | None:
    """The rows of all published dates, or None before the first load. Reads their folders only."""
    entries = _entries(spark, sink)
    if entries is None:
        return None
    schema = StructType.fromJson(json.loads(entries.agg(F.max_by("schema", "seq")).first()[0]))
    places = [f"{sink.version(r.version)}/date={r.date}" for r in published_dates(spark, sink).filter("filled").collect()]
    if not places:
        return spark.createDataFrame([], schema)
    # text that looks like a date stays text: the columns of the folders' names are declared
    declared = StructType([f for f in schema if f.name != "date"]).add("version", "string").add("date", "string")
    rows = spark.read.schema(declared).option("basePath", sink.path).parquet(*places)
    return rows.select(*schema.names)


def sweep(spark: SparkSession, sink: PublishedSink, hours: float = 24.0) -> list[str]:
    """Delete the versions that no date uses and nothing has written to for ``hours``; their names.

    These are replaced versions, and what stopped loads have left. ``hours`` must exceed the
    time a load or a read takes.
    """
    used = {r.version for r in published_dates(spark, sink).select("version").distinct().collect()}
    before = (dt.datetime.now(dt.timezone.utc) - _EPOCH - dt.timedelta(hours=hours)) // dt.timedelta(milliseconds=1)
    old = [n for n, at in names_in(spark, sink.path).items() if n.startswith("version=") and at <= before]
    gone = sorted(n.removeprefix("version=") for n in old if n.removeprefix("version=") not in used)
    for name in gone:
        fs, path = _fs(spark, sink.version(name))
        fs.delete(path, True)
    return gone
