"""Upserts that readers see whole or not at all, and that a replayed batch leaves alone.

A table is a folder of data and one of versions. A version is a small JSON file that names the
data folder of each partition (a date, or a venue and date) and the last batch of each writer.
A batch is written beside the data in place and becomes the table when its version file takes
the next number: a rename that fails if the number is taken. So

* a run that dies at any point leaves the last version readable, and its batch is run again;
* a batch whose number the writer's last one has reached has been applied, and is not again;
* of two writers one gets the number, and the other merges anew into what it finds then.

Partitions are bounded by the calendar, so is a version. Folders that no version names any more
stay for readers of older versions; remove them when those are gone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.universe import dedupe, upsert
from tickloom.sources.sinks import replace_folders
from tickloom.specs.base import TableSpec, as_schema
from tickloom.streaming.incremental import advance

# Bookmarks are spread over so many partitions by their key.
SLOTS = 32


@dataclass
class Version:
    """One state of a table: its number, data folder by partition, and last batch by writer."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


class _Files:
    """Small files in the store that holds a table, by Hadoop's client."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.hadoop, self.io = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.commons.io
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.folder = f"{path}/versions"
        self.store = self.hadoop.Path(path).getFileSystem(self.conf)

    def numbers(self) -> list[int]:
        folder = self.hadoop.Path(self.folder)
        if not self.store.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.store.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _at(self, number: int):
        return self.hadoop.Path(f"{self.folder}/{number:012d}.json")

    def text(self, number: int) -> str:
        stream = self.store.open(self._at(number))
        try:
            return self.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def take(self, number: int, text: str) -> bool:
        """Write a version's file; False if its number is taken."""
        draft = self.hadoop.Path(f"{self.folder}/draft-{uuid.uuid4().hex}")
        stream = self.store.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = getattr(self.hadoop, "Options$Rename")
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.NONE
        target = self.store.makeQualified(self._at(number))
        context = self.hadoop.FileContext.getFileContext(target.toUri(), self.conf)
        try:
            context.rename(self.store.makeQualified(draft), target, how)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass()):
                raise
            self.store.delete(draft, False)
            return False
        return True


def latest(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The table's last version, or that of ``number``; an empty one where there is none."""
    files = _Files(spark, path)
    known = files.numbers()
    if number is None and not known:
        return Version()
    return Version(**json.loads(files.text(known[-1] if number is None else number)))


def commit(spark: SparkSession, path: str, version: Version) -> bool:
    """Make ``version`` the table's next; False if another writer was first."""
    return _Files(spark, path).take(version.number, json.dumps(vars(version), sort_keys=True))


def read_version(
    spark: SparkSession, path: str, schema: T.StructType | str, version: Version | None = None
) -> DataFrame:
    """The rows of a version, by default the last. Filters on partition columns prune folders."""
    schema = as_schema(schema)
    version = version or latest(spark, path)
    folders = [f"{path}/data/{f}" for f in version.folders.values()]
    if not folders:
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
        .select(*schema.names)
    )


def _written(spark: SparkSession, path: str, batch: str) -> dict[str, str]:
    """Data folder by partition of the folders written for a batch."""
    root = f"{path}/data/{batch}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    folder = F.regexp_extract("path", f"/{batch}/(.*)/[^/]*$", 1)
    names = [r[0] for r in files.load(root).select(folder).distinct().collect()]
    return {name: f"{batch}/{name}" for name in names}


def change(
    rows: DataFrame,
    path: str,
    folders: list[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    order: list[str],
    writer: str | None = None,
    batch_id: int = 0,
) -> Version:
    """Replace the partitions that ``rows`` touches by ``merge(their stored rows, rows)``.

    With a ``writer``, a batch is applied if its ``batch_id`` is past the writer's last one.
    """
    spark = rows.sparkSession
    while True:
        version = latest(spark, path)
        if writer is not None and version.batches.get(writer, -1) >= batch_id:
            return version
        # Dates, or venues and dates, of one batch: bounded by the calendar.
        touched = F.broadcast(rows.select(*folders).distinct())
        stored = read_version(spark, path, rows.schema, version)
        merged = merge(stored.join(touched, folders, "left_semi"), rows).select(*rows.columns)
        batch = f"batch={uuid.uuid4().hex}"
        replace_folders(merged, f"{path}/data/{batch}", folders, order)
        batches = version.batches if writer is None else version.batches | {writer: batch_id}
        made = Version(version.number + 1, version.folders | _written(spark, path, batch), batches)
        if commit(spark, path, made):
            return made


def upsert_version(
    df: DataFrame,
    spec: TableSpec,
    path: str,
    partition: str = "file_date",
    order: tuple[str, ...] = (),
    writer: str | None = None,
    batch_id: int = 0,
) -> Version:
    """Upsert ``df`` by the table's primary key, as one step for all readers.

    Of rows with the same key the last by ``order`` stays, and the batch's on ties.
    """
    keys = list(spec.primary_keys)
    if not set(keys) <= set(df.columns):
        raise ValueError(f"{spec.name} is keyed by {keys}; the data has {df.columns}")

    def merge(stored: DataFrame, rows: DataFrame) -> DataFrame:
        once = dedupe(rows, keys, list(order) or keys, keep="last")
        return upsert(stored, once, keys, list(order))

    return change(df, path, [partition], merge, [k for k in keys if k != partition], writer, batch_id)


def stream_upsert(
    stream: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    writer: str,
    partition: str = "file_date",
    order: tuple[str, ...] = (),
):
    """Upsert a stream's batches, each exactly once, until the present end of its input.

    A batch that had become a version before the stream could note it comes again with its
    number after a restart, and is recognised by it. ``writer`` must stay that of ``checkpoint``.
    """

    def apply(rows: DataFrame, batch_id: int) -> None:
        upsert_version(rows, spec, path, partition, order, writer, batch_id)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _slotted(marks: DataFrame, keys: list[str]) -> DataFrame:
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")
    return marks.select(*keys, "bookmark", slot.alias("slot"))


def commit_marks(
    marks: DataFrame, path: str, keys: list[str], writer: str | None = None, batch_id: int = 0
) -> Version:
    """Advance the stored bookmarks to ``marks`` (one row per key, or several: the largest counts).

    Writers of different keys, also of one slot, do not lose each other's marks.
    """

    def merge(stored: DataFrame, rows: DataFrame) -> DataFrame:
        return _slotted(advance(stored, rows, keys, "bookmark"), keys)

    return change(_slotted(marks, keys), path, ["slot"], merge, keys, writer, batch_id)


def read_marks(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The stored bookmarks; ``schema`` is that of the keys and ``bookmark``."""
    wanted = as_schema(schema)
    stored = T.StructType([*wanted.fields, T.StructField("slot", T.IntegerType())])
    return read_version(spark, path, stored).select(*wanted.names)
