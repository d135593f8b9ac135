"""Replacing partitions of a Parquet table so that a stop at any point loses no row.

New files are staged beside the table, then a journal (one small file, put in place by a rename) names them and the files
that they replace. From that moment the new rows count: :func:`read` leaves the old files out and takes the new ones from
wherever they are. Moving them into the table and deleting the old ones can stop and be repeated at will (:func:`recover`,
which every write calls first; call it before a plan that reads the table and then replaces its partitions); before that moment the table is as it was and what was staged is thrown away.

One writer at a time. A table's touched files are listed on the driver, as Spark itself does to plan a read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources import files


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}-journal.json"


def _pending(spark: SparkSession, path: str) -> dict | None:
    text = files.get_text(spark, _journal(path))
    return json.loads(text) if text else None


def _finish(spark: SparkSession, path: str, told: dict) -> None:
    """Do, or do again, what the journal says: new files in, old files out, then nothing is pending any more."""
    for name in told["new"]:
        if files.exists(spark, f"{told['staged']}/{name}"):
            files.move(spark, f"{told['staged']}/{name}", f"{path}/{name}")
    for name in told["old"]:
        files.delete(spark, f"{path}/{name}")
    for folder in {name.rpartition("/")[0] for name in told["old"]} - {name.rpartition("/")[0] for name in told["new"]}:
        if folder and not any(files.data_files(spark, f"{path}/{folder}")):
            files.delete(spark, f"{path}/{folder}")
    files.delete(spark, _journal(path))
    files.delete(spark, told["staged"])


def recover(spark: SparkSession, path: str) -> None:
    """Finish a write that was stopped after its journal was there; throw away what one left that stopped before."""
    path = path.rstrip("/")
    if told := _pending(spark, path):
        _finish(spark, path, told)
    for pattern in (f"{path}-staged-*", f"{_journal(path)}.*"):
        for left in files.matching(spark, pattern):
            files.delete(spark, left)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows: the new ones from the moment that a journal names them, the old ones before. Writes nothing."""
    path, told = path.rstrip("/"), _pending(spark, path)
    if told is None:
        return spark.read.parquet(path)
    staged = [f for f in told["new"] if files.exists(spark, f"{told['staged']}/{f}")]
    held = [f for f in files.data_files(spark, path) if f not in set(told["old"]) | set(staged)]
    parts = [spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in names]) for base, names in ((path, held), (told["staged"], staged)) if names]
    if not parts:
        return spark.read.parquet(*[f"{path}/{f}" for f in files.data_files(spark, path)]).limit(0)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table with data files, whole or in the middle of a write."""
    try:
        read(spark, path).schema  # noqa: B018
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
    return True


def replace(df: DataFrame, path: str, partition: str, emptied: Iterable = ()) -> None:
    """Partitions that ``df`` has rows for, and those of the values ``emptied``, get the rows of ``df`` instead of theirs."""
    spark, path = df.sparkSession, path.rstrip("/")
    recover(spark, path)
    staged = f"{path}-staged-{uuid.uuid4().hex}"
    # A rebalance and not a repartition: a day that is too large for one task is dealt to several.
    df.hint("rebalance", partition).write.partitionBy(partition).parquet(staged)
    new = list(files.data_files(spark, staged))
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    touched = {f.rpartition("/")[0] for f in new} | {name(partition, str(v)) for v in emptied}
    old = [f for f in files.data_files(spark, path) if f.rpartition("/")[0] in touched]
    told = {"staged": staged, "new": new, "old": old}
    files.put_text(spark, _journal(path), json.dumps(told))
    _finish(spark, path, told)
