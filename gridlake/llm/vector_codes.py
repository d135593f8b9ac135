"""Vector code compression: product quantization whose nearest entries are found by equal-average search.

Components become integers, ``floor(256 * x)``, and vectors are cut into ``PARTS`` equal consecutive parts. A part's
codebook starts as that part of the vectors with the least ids; each round assigns every part to its nearest entry and
moves entries to the floored means of their parts.

The search sorts a codebook's entries by the sum of their components. By the Cauchy-Schwarz inequality two parts of ``w``
components whose sums are ``g`` apart are at least ``g * g / w`` apart (squared), so entries are tried outward from the
part's own sum until that bound strictly exceeds the best distance. All is integer arithmetic, so ties are exact and go to
the lower index. A batch of parts walks outward together, and parts that are done leave it.

A round is one scan: tasks add up counts and sums of their parts by (part, entry) and emit at most ``PARTS * ENTRIES``
rows, whatever they read, and as many reach the driver. Vectors are never shuffled.

Rows whose vector is null, empty, holds null or non-finite components, or has another length than that of the least id
(which has to divide by ``PARTS``) are dropped. Null ids come last, equal ids are ordered by their vectors, repeated rows
each get a row. Fewer vectors than ``ENTRIES`` give smaller codebooks; no vector gives no row. Integers are clipped
where their squares would leave 64 bits (components beyond 2**18 for parts of 4). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Labels up to which their sums are broadcast (a label and a number each); beyond, they are joined by label and salt.
MAX_LABELS, SALTS = 100_000, 16
BLOCK_ROWS = 2048


@dataclass
class Codebooks:
    """``entries`` has the shape (parts, entries, width)."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of every part, and its squared distance; both (rows, parts)."""
        parts, _, width = self.entries.shape
        cut = vectors.reshape(len(vectors), parts, width)
        found = [nearest(cut[:, p], self.entries[p]) for p in range(parts)]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal-average search: index and squared distance of the nearest entry of each row, ties to the lower index."""
    n, (size, width) = len(vectors), entries.shape
    order = np.argsort(entries.sum(axis=1), kind="stable")
    sums, own = entries.sum(axis=1)[order], vectors.sum(axis=1)
    best, index = np.zeros(n, np.int64), np.full(n, size)
    live, above = np.arange(n), np.searchsorted(sums, own)
    below = above - 1
    far = np.iinfo(np.int64).max
    while len(live):
        down = np.where(below >= 0, own[live] - sums[np.maximum(below, 0)], far)
        up = np.where(above < size, sums[np.minimum(above, size - 1)] - own[live], far)
        gap, lower = np.minimum(down, up), down <= up
        # The nearer side's bound exceeds the best distance, so that of every entry beyond does; or no entry is left.
        more = gap < far
        more[more] = (index[live[more]] == size) | (gap[more] ** 2 <= width * best[live[more]])
        live, lower, above, below = live[more], lower[more], above[more], below[more]
        tried = order[np.where(lower, below, np.minimum(above, size - 1))]
        distance = ((vectors[live] - entries[tried]) ** 2).sum(axis=1)
        better = (index[live] == size) | (distance < best[live]) | ((distance == best[live]) & (tried < index[live]))
        best[live[better]], index[live[better]] = distance[better], tried[better]
        above, below = above + ~lower, below - lower
    return index, best


def integers(column: pa.Array, dimension: int, parts: int) -> np.ndarray:
    """``floor(256 * x)`` of a column of vectors, (rows, dimension)."""
    limit = 1 << (28 - int(np.ceil(np.log2(dimension // parts))))
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    return np.clip(values, -limit, limit).astype(np.int64).reshape(len(column), dimension)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """``vec_id``, ``vector`` and ``label`` of the rows whose vector has finite components only."""
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    sound = F.forall("vector", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), label.alias("label")).where((F.size("vector") > 0) & sound)


def first_vectors(rows: DataFrame, n: int, parts: int = PARTS) -> np.ndarray:
    """The vectors of the ``n`` least ids, of those as long as the first one (n, dimension)."""
    least = rows.where(F.size("vector") % parts == 0).orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    first = least.select("vector").limit(n).collect()
    if any(len(r[0]) != len(first[0][0]) for r in first):
        first = least.where(F.size("vector") == len(first[0][0])).select("vector").limit(n).collect()
    if not first:
        return np.zeros((0, 0), np.int64)
    dimension = len(first[0][0])
    return integers(pa.array([r[0] for r in first], pa.list_(pa.float64())), dimension, parts)


def blocks(batches: Iterator[pa.RecordBatch], dimension: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(start, BLOCK_ROWS)
            yield some, integers(some.column("vector"), dimension, parts)


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: entries go to the floored means of the parts that are nearest to them; unused ones stay."""
    parts, entries, width = books.entries.shape
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for _, values in blocks(batches, parts * width, parts):
            slot = (sent.value.encode(values)[0] + np.arange(parts) * entries).ravel()
            np.add.at(total, slot, values.reshape(-1, width))
            count += np.bincount(slot, minlength=parts * entries)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), *(pa.array(total[used, i]) for i in range(width))], ["slot", "n", *(f"s{i}" for i in range(width))])

    schema = "slot long, n long, " + ", ".join(f"s{i} long" for i in range(width))
    sums = rows.select("vector").mapInArrow(summed, schema).groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("n", *(f"s{i}" for i in range(width)))])
    out = books.entries.copy().reshape(parts * entries, width)
    for slot, n, *total in sums.collect():
        out[slot] = np.array(total) // n
    return Codebooks(out.reshape(parts, entries, width))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks fitted on all :func:`usable` rows; None where there are none."""
    first = first_vectors(rows, entries, parts)
    if not len(first):
        return None
    books = Codebooks(np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2)))
    same = rows.where(F.size("vector") == first.shape[1])
    for _ in range(rounds):
        books = moved(same, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (one byte a part) and ``error`` of the :func:`usable` rows of the right length."""
    parts, _, width = books.entries.shape
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, values in blocks(batches, parts * width, parts):
            index, distance = sent.value.encode(values)
            codes = pa.array([row.tobytes() for row in index.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([some.column("vec_id"), some.column("label"), codes, pa.array(distance.sum(axis=1))], ["vec_id", "label", "code", "error"])

    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    return rows.where(F.size("vector") == parts * width).mapInArrow(coded, schema)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and the ``vector`` that a code stands for: the middle of each integer's cell, of the entries it names."""
    middles = [[[(x + 0.5) / SCALE for x in entry] for entry in part] for part in books.entries.tolist()]
    index = lambda p: F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int")
    named: list[Column] = [F.lit(part)[index(p)] for p, part in enumerate(middles)]
    return codes.select("vec_id", F.concat(*named).alias("vector"))


def label_sums(coded: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over rows of one label, those without one together."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    if sums.limit(max_labels + 1).count() <= max_labels:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    dealt = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = coded.withColumn("_of", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_of") == F.col("_salt"))).drop("_label", "_of", "_salt")


def compression_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    rows = usable(vectors, id_col, vector_col, label_col)
    books = train(rows)
    if books is None:
        none = rows.where("false").select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.select("*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = written(encode(rows, books), "vector-codes")
    return label_sums(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
