"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, a local session (tests) gets a new folder and a cluster an error."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return _own_dirs[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/gridlake-{name}-{uuid.uuid4().hex}"


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and reread it: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    if (made := _scratch.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table that ``build`` gives, written; the tables that were written on the way to it are deleted then."""
    made: list[str] = []
    token, out = _scratch.set(made), None
    try:
        out = written(build(), name)
    finally:
        _scratch.reset(token)
        for path in made[:-1] if out is not None else made:
            _delete(spark, path)
    if (outer := _scratch.get()) is not None:
        outer.append(made[-1])
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def in_turns(df: DataFrame, key: Column, turns: int, name: str) -> Iterator[DataFrame]:
    """Write ``df`` once, dealt by ``key`` into ``turns`` tables, and give them one by one; each is deleted when the next is asked for."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    (turn,) = free_names(df, "turn")
    dealt = df.withColumn(turn, F.pmod(key, F.lit(turns)).cast("int"))
    (dealt.write.partitionBy(turn) if turns > 1 else dealt.write).parquet(path)
    if (made := _scratch.get()) is not None:
        made.append(path)
    table = spark.read.schema(dealt.schema).parquet(path)
    for k in range(turns):
        yield table.where(F.col(turn) == k).select(df.columns)
        _delete(spark, f"{path}/{turn}={k}" if turns > 1 else path)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, which may be a URI in any store that pyarrow knows."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri.removeprefix("file:")))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores after those that a column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: What tasks cut batches by where their arrays take many times a text's bytes, or rows of text are put out again.
SMALL_SLICE = 1 << 19


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches by the size of one text column, so a task holds a few MB of text at a time however long the rows are."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
