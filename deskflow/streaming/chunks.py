"""Tables that grow by committed chunks, with a high-water mark of their ids.

A chunk (one micro-batch) is written into a folder of its own; then one
small mark file is replaced, which holds the number of the last chunk, the
stream and batch it came from and the next free id.  The replacement commits
the chunk and the ids it took at once: readers see only chunks up to the
mark, a chunk that was not committed is written again from the same first
id, and a committed batch that is delivered again is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from deskflow.sources import files

MARK = "_mark"
CHUNK = "chunk-"


@dataclass(frozen=True)
class Mark:
    """State of a table: the last committed chunk, where it came from, and
    the next free id."""
    chunk: int = -1
    stream: str = ""
    batch: int = -1
    next_id: int = 0


class ChunkTable:
    """A table at ``path`` with the given parts (name -> schema), such as
    accepted and rejected rows, which every chunk writes together.  One
    stream writes a table at a time."""

    def __init__(self, spark: SparkSession, path: str, parts: dict[str, T.StructType], first_id: int = 0):
        self.spark, self.path, self.parts, self.first_id = spark, path.rstrip("/"), parts, first_id

    def mark(self) -> Mark:
        text = files.read_small(self.spark, f"{self.path}/{MARK}")
        return Mark(**json.loads(text)) if text else Mark(next_id=self.first_id)

    def _folder(self, chunk: int, part: str) -> str:
        return f"{self.path}/{part}/chunk={chunk:09d}"

    def read(self, part: str) -> DataFrame:
        """Rows of all committed chunks."""
        schema, last = self.parts[part], self.mark().chunk
        if last < 0:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("chunk", T.IntegerType())])
        rows = self.spark.read.schema(stored).parquet(f"{self.path}/{part}")
        return rows.where(rows["chunk"] <= last).select(*schema.names)

    def commit(self, stream: str, batch: int, build: Callable[[Mark], tuple[dict[str, DataFrame], int]]) -> bool:
        """Write one chunk, unless this batch of the stream has been committed.
        ``build`` gets the mark (all earlier chunks) and returns each part's
        rows and how many ids they take."""
        before = self.mark()
        if stream == before.stream and batch <= before.batch:
            return False
        rows, taken = build(before)
        for part, df in rows.items():
            files.align(df, self.parts[part]).write.mode("overwrite").parquet(self._folder(before.chunk + 1, part))
        after = replace(before, chunk=before.chunk + 1, stream=stream, batch=batch, next_id=before.next_id + taken)
        files.replace_small(self.spark, f"{self.path}/{MARK}", json.dumps(asdict(after)))
        return True


def drain(spark: SparkSession, landing: str, schema: T.StructType, checkpoint: str,
          load: Callable[[DataFrame, int], None], files_per_batch: int | None = 1) -> None:
    """Hand the landing folder's new files to ``load``, oldest first and a
    few a micro-batch (None: all that are there), until none is left
    (available-now trigger).  Progress is kept in the stream's checkpoint
    folder."""
    source = spark.readStream.schema(schema)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    stream = (source.parquet(landing)
              .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True).start())
    stream.awaitTermination()


def land_chunks(df: DataFrame, landing: str, order: str, bounds: list) -> None:
    """Write rows as one chunk folder for each range of ``order`` between the
    bounds, in turn (the test stand-in for chunks that arrive over time).  A
    chunk is sorted over as many files as its size asks for; rows equal in
    ``order`` stay in one file, as they came."""
    cuts = [None, *bounds, None]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        tests = ([df[order] >= lo] if lo is not None else []) + ([df[order] < hi] if hi is not None else [])
        part = df.where(reduce(lambda a, b: a & b, tests)) if tests else df
        part = part.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(order)
        part.sortWithinPartitions(order, "__tie").drop("__tie").write.mode("append").parquet(f"{landing}/{CHUNK}{i:09d}")


def landed(spark: SparkSession, landing: str, checkpoint: str, files_per_batch: int) -> Iterator[tuple[str, str, int | None]]:
    """(folder, checkpoint, files a micro-batch) of the streams that drain a
    landing folder, in turn: each chunk folder is one stream of one batch;
    without such folders the files in ``landing`` are one stream."""
    names = sorted(name for name in files.folder_names(spark, landing) if name.startswith(CHUNK))
    if not names:
        yield landing, checkpoint, files_per_batch
    for name in names:
        yield f"{landing}/{name}", f"{checkpoint}/{name}", None
