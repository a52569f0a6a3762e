"""Token files: ids of whole documents in ascending doc_id order, range-coded in blocks.

A file set is a Parquet folder, so Spark's commit protocol makes each task's file appear
whole or not at all, on any file system Spark knows, and a retried task writes the same rows.
Each row is a frame: ``part`` (the writing task, in doc_id order), ``ids_before`` (ids of the
part's frames ahead), the doc_ids and id counts of its documents, and ``payload`` (see
``range_coder``), whose blocks are reset and checksummed one by one. A document lies in one
frame. Frames close at ``FRAME`` ids, so memory is bounded by a frame and the longest text.

* A null or empty text has the end-of-document id alone. Null ids come first.
* Repeated rows are written once each. An empty table gives an empty file set.
* A damaged block raises ValueError when read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm import range_coder
from tickloom.llm.tokens import END, byte_encoder

FRAME = 1024 * range_coder.BLOCK
_END = np.array([END], dtype="<u2").tobytes()


def _frames(path: str):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), byte_encoder(path).encode
        pending: list[bytes] = []
        doc_ids: list = []
        size = before = 0

        def close() -> pa.RecordBatch:
            counts = [len(x) // 2 for x in pending]
            payload = range_coder.encode(np.frombuffer(b"".join(pending), dtype="<u2"))
            values = {
                "part": pa.array([part], pa.int32()),
                "ids_before": pa.array([before], pa.int64()),
                "n_ids": pa.array([sum(counts)], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(kind)),
                "counts": pa.array([counts], pa.list_(pa.int64())),
                "payload": pa.array([payload], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(values.values()), list(values))

        for batch in batches:
            kind = batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py()) + _END
                if pending and size + len(ids) // 2 > FRAME:
                    yield close()
                    before, size = before + size, 0
                    pending, doc_ids = [], []
                pending.append(ids)
                doc_ids.append(doc_id)
                size += len(ids) // 2
        if pending:
            yield close()

    return apply


def write_tokens(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Write the ids of all documents, each ended by id 2, as a new file set."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    schema = (
        f"part int, ids_before long, n_ids long, doc_ids array<{kind}>, "
        "counts array<long>, payload binary"
    )
    # The payload is coded already.
    ordered.mapInArrow(_frames(tokenizer), schema).write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids = range_coder.decode(batch.column("payload")[row].as_py())
            counts = np.array(batch.column("counts")[row].as_py(), dtype=np.int64)
            ends = np.cumsum(counts)
            first = batch.column("first")[row].as_py()
            for at in range(0, len(counts), 256):
                some = slice(at, at + 256)
                begin = ends[some] - counts[some]
                wide = [ids[a:b].astype("<u4").tobytes() for a, b in zip(begin, ends[some])]
                values = {
                    "doc_id": batch.column("doc_ids")[row].values[some],
                    "start": pa.array(first + begin),
                    "ids": pa.array(wide, pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(list(values.values()), list(values))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (little-endian unsigned 32-bit) of every document of a file set."""
    frames = spark.read.parquet(path)
    # One row per writing task.
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("part").alias("__part"), F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("offset")
    )
    placed = frames.join(offsets, F.col("part") == F.col("__part")).select(
        "doc_ids", "counts", "payload", (F.col("offset") + F.col("ids_before")).alias("first")
    )
    kind = frames.schema["doc_ids"].dataType.elementType.simpleString()
    return placed.mapInArrow(_documents, f"doc_id {kind}, start long, ids binary")
