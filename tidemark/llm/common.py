"""What the operators of this subpackage share: column selection, shared folders and worker-side state."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
WORD_GAP = r"[\x20\x09-\x0D]+"


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of any table; every other column, clashing names included, is left out."""
    return docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one."""
    context = spark.sparkContext
    set_already = context._jsc.sc().getCheckpointDir()
    if set_already.isDefined():
        return set_already.get()
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as compressed Parquet in the shared folder and read again; for what is used more than once.

    Plans that read it need the files, so they stay until clear_written().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> int:
    """Deletes what this process has written so far; to be called when all results have been used. Returns how many."""
    jvm, n = spark._jvm, 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster's owner sizes with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def kept_in_worker(key, make: Callable):
    """make(), once in each Python worker process; later tasks of the process get the same object."""
    held = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def map_batches(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """df.mapInArrow(run, schema); when a task ends, its worker gives back the memory that it no longer uses.

    Workers are kept for later tasks, and an idle one would otherwise hold what its largest batch took.
    """
    name = run.__name__

    def released(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    released.__name__ = name
    return df.mapInArrow(released, schema)


def give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not this C library


def safe_parts(text: str, size: int = 1 << 16) -> Iterator[str]:
    """Cuts a long text where every match of a byte-level BPE split pattern surely ends.

    Such a pattern has no match that goes from an ASCII letter or digit on to white space, and looks only
    ahead, never back, so the matches of the parts are the matches of the text. Without such a place within
    `size` characters a part goes on to the next one.
    """
    import re

    if len(text) <= size:
        yield text
        return
    boundary = kept_in_worker("safe_boundary", lambda: re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])"))
    start = 0
    while start < len(text):
        found = boundary.search(text, min(start + size, len(text)))
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end
