"""Resampling documents towards a target distribution by hashed n-gram importance weights (Xie et al., 2023).

A text's UTF-8 bytes pass a 256-byte table that lower-cases A-Z and blanks separators, ``bytes.split`` gives its words,
and n-grams grow by chained CRC-32: the checksum of a run is the seed for the next word. Counters of buckets are reduced
first in each task, then over tasks, to ``BUCKETS`` rows of the corpus and as many of the target, from which each bucket
gets a gain (a floored log ratio). A second scan sums each document's gains, and a Gumbel variable drawn from its id makes
the highest scores a sample without replacement.

Texts are read twice and never shuffled; what is sorted is one row of five numbers a document, cut into ranges, so no task
holds more than a range. Long texts are cut into pieces at separators, with the last words carried on.

Null texts have no words, no features and weight 0; they are never drawn. Repeated rows are drawn each by itself, with
equal scores; null ids draw as the empty text and come last among ties. Empty tables give empty results; an empty target
weighs by the corpus alone. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.ranking import ranked

from .runtime import slices, written

BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
PIECE = 1 << 20
#: Letters lower, digits and bytes of other scripts as they are, all else a blank.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def buckets(text: bytes, longest: int = LONGEST, piece: int = PIECE) -> Iterator[tuple[int, list[int]]]:
    """For each piece of a text its number of words and the buckets of the n-grams that end in it."""
    blanked = text.translate(TABLE)
    carried: list[bytes] = []
    start = 0
    while start < len(blanked):
        end = blanked.find(b" ", start + piece)
        end = len(blanked) if end < 0 else end
        fresh = blanked[start:end].split()
        words = carried + fresh
        follow = list(map(b" ".__add__, words))
        sums = [list(map(crc32, words))]
        for n in range(1, longest):
            sums.append(list(map(crc32, follow[n:], sums[-1])))
        # Runs of n + 1 words that lie in the carried words were counted with the piece before.
        new = chain.from_iterable(run[max(0, len(carried) - n) :] for n, run in enumerate(sums))
        yield len(fresh), (np.fromiter(new, np.int64) % BUCKETS).tolist()
        carried, start = words[len(words) - longest + 1 :] if len(words) >= longest else words, end


def bucket_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``bucket`` and ``n``, the features that all texts have in it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for part in slices(batches, "text"):
            for text in part.column("text"):
                for _, found in buckets(text.as_buffer().to_pybytes()):
                    total.update(found)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    held = texts.where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"))
    return held.mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str = "text") -> np.ndarray:
    """The floored log ratio of target and corpus of each bucket, with one feature added to every bucket."""
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for counts, table in ((s, corpus), (t, target)):
        for bucket, n in bucket_counts(table, text_col).collect():  # at most BUCKETS rows
            counts[bucket] = n
    total_s, total_t = float(s.sum() + BUCKETS), float(t.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1.0) * total_s / ((a + 1.0) * total_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = []
            for text in part.column("text"):
                words = features = weight = 0
                for n, found in buckets(text.as_buffer().to_pybytes()):
                    words, features, weight = words + n, features + len(found), weight + int(sent.value[found].sum())
                rows.append((words, features, weight))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(column, pa.int64()) for column in zip(*rows, strict=True))], ["doc_id", "n_words", "n_features", "weight"])

    return keyed.mapInArrow(scored, T.StructType([keyed.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))]))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times the Gumbel variable that an id draws, floored."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampling_report(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its weight and score, and its ``rank`` if it is among the ``percent`` drawn."""
    scored = weighted(docs, gains(docs, target, text_col), id_col, text_col).withColumn("score", F.col("weight") + gumbel(F.col("doc_id")))
    stored = written(scored.withColumn("fit", F.col("n_words") >= least_words).drop("n_words"), "scores")
    n_drawn = stored.where("fit").count() * percent // 100
    placed = ranked(stored, [F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "place", lambda df: written(df, "ranges"))
    rank = F.when(F.col("place") <= n_drawn, F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is drawn, all columns as they are."""
    drawn = resampling_report(docs, target, percent, id_col=id_col, text_col=text_col).where("rank IS NOT NULL").select(F.col("doc_id").alias(id_col))
    return docs.join(drawn, id_col, "left_semi")
