"""An append that survives retries: each batch of rows is added once, whatever fails on the way.

Tasks write files under names of their own and return them in commit messages; the driver
then names the files of the attempts that counted in one note, made by a rename that fails
if the batch has a note already. Readers read the files that notes name. So neither a task
that fails after writing, nor a second attempt beside a slow one, nor a batch sent again
after a lost answer adds a row twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from adtally.session import ship_package
from adtally.sources.published import names_in, put_new
from adtally.sources.zip_members import filesystem_of

FORMAT = "adtally_append_once"


@dataclass
class Written(WriterCommitMessage):
    """A task's file, or None if it had no rows."""

    file: str | None
    rows: int


class AppendOnceWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, draft: str):
        self.folder, self.draft = folder, draft

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        file, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        filesystem, place = filesystem_of(f"{self.folder}/files/{file}")
        for batch in iterator:
            if batch.num_rows:
                out = out or pq.ParquetWriter(place, batch.schema, filesystem=filesystem)
                out.write_batch(batch)
                rows += batch.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(file, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """Hand the names to the caller: the driver's side of a write has no session."""
        done = [m for m in messages if m is not None and m.file]
        filesystem, place = filesystem_of(self.draft)
        with filesystem.open_output_stream(place) as f:
            f.write(json.dumps({"files": [m.file for m in done], "rows": sum(m.rows for m in done)}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files without a note are never read; those that are known go at once."""
        for m in messages:
            if m is not None and m.file:
                filesystem, place = filesystem_of(f"{self.folder}/files/{m.file}")
                filesystem.delete_file(place)


class AppendOnceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> AppendOnceWriter:
        return AppendOnceWriter(self.options["folder"], self.options["draft"])


def append_once(df: DataFrame, folder: str, batch: str) -> bool:
    """Add the rows of ``df`` to ``folder`` unless ``batch`` has been added; whether they were.

    ``batch`` names the rows for the caller (a load's date, say): the same name is for the
    same rows, sent again. ``folder`` lies where the driver and all executors can write.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    note = f"{quote(batch, safe='')}.json"
    if note in names_in(spark, f"{folder}/notes"):
        return False
    ship_package(spark)
    spark.dataSource.register(AppendOnceSource)
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(f"{folder}/files")
    fs = files.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(files)
    draft = f"{folder}/files/_{uuid.uuid4().hex}"
    df.write.format(FORMAT).option("folder", folder).option("draft", draft).mode("append").save()
    told = spark.read.schema("files array<string>, rows bigint").json(_visible(spark, draft)).first()
    text = json.dumps({"batch": batch, "schema": df.schema.json(), "files": told.files, "rows": told.rows})
    return put_new(spark, f"{folder}/notes", note, text)


def _visible(spark: SparkSession, draft: str) -> str:
    """The draft under a name that Spark's readers don't skip."""
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(draft)
    shown = jvm.Path(path.getParent(), "draft-" + path.getName().lstrip("_") + ".json")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).rename(path, shown)
    return shown.toString()


def read_appended(spark: SparkSession, folder: str) -> DataFrame | None:
    """All rows added so far, or None before the first batch."""
    folder = folder.rstrip("/")
    if not any(n.endswith(".json") and n[0] != "_" for n in names_in(spark, f"{folder}/notes")):
        return None
    notes = spark.read.schema("schema string, files array<string>").json(f"{folder}/notes")
    schema = StructType.fromJson(json.loads(notes.first().schema))
    files = [f"{folder}/files/{r.file}" for r in notes.select(F.explode("files").alias("file")).collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
