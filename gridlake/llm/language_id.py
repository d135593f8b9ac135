"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes (A-Z lower-cased, other ASCII that isn't a letter blanked) are cut into windows of ``WINDOW`` bytes
that overlap by the widest filter but one byte, so that no run of bytes is lost. Filters of several widths slide along
a window, each one's maximum is kept (max pooling), and a softmax layer over the pooled maxima gives a probability for
each language. A document's probabilities are the mean over all its windows, weighted by their letters' bytes.

The network is trained in numpy on the driver, on a bounded sample of labelled rows (documented bounds): languages are
the ``MAX_LANGS`` most frequent labels; of each, the distinct texts with the least hash, at most ``MAX_TEXTS``, and from
each of these ``CROPS`` windows at places that its hash chooses, of random lengths so that short texts are learned too;
``MAX_WINDOWS`` windows in all, about 6 MB. Only (label, hash) pairs are shuffled, pre-aggregated, so copies count once.
Scoring is one scan of whole texts.

A null text and one without a letter give ``und`` and score 0; so does every text where nothing can be learned. With one
label every other text has it, with score 1. Repeated rows score alike, null ids count as not held out. Other columns
are ignored; no input but the text reaches a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import slices, written
from .suffixes import text_bytes

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
OVERLAP = max(WIDTHS) - 1
MAX_LANGS, MAX_TEXTS, CROPS, MAX_WINDOWS = 256, 2000, 3, 24_000
ROUNDS, BATCH, RATE, SEED = 6, 64, 0.01, 13
UNKNOWN = "und"
BLANK = 0x20
FOLDED = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else BLANK for b in range(256)], np.uint8)
#: Windows that are pooled at a time, so that what a filter gives stays in the processor's cache.
BLOCK = 64


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of rows of folded bytes, blanks behind the end of a row, and the row of each (every row has one)."""
    sizes = np.diff(at)
    count = np.maximum(1, -(-(sizes - OVERLAP) // (WINDOW - OVERLAP)))
    owner = np.repeat(np.arange(len(sizes)), count)
    first = np.cumsum(count) - count
    start = at[owner] + (np.arange(len(owner)) - first[owner]) * (WINDOW - OVERLAP)
    padded = np.append(data, np.full(WINDOW, BLANK, np.uint8))
    out = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    out[np.arange(WINDOW) >= (at[owner + 1] - start)[:, None]] = BLANK
    return out, owner


@dataclass
class Network:
    """``filters[k]`` has the shape (width, 256, filters): what each byte at each place of the filter adds."""

    langs: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def drawn(cls, langs: list[str], rng: np.random.Generator) -> Network:
        n = FILTERS * len(WIDTHS)
        filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(langs, filters, np.zeros(n, np.float32), rng.normal(0, n**-0.5, (n, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.out, self.out_bias]

    def responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """What the filters of each width give at every place of a window, (windows, places, filters)."""
        for table in self.filters:
            places = x.shape[1] - len(table) + 1
            total = table[0][x[:, :places]]
            for j in range(1, len(table)):
                total += table[j][x[:, j : j + places]]
            yield total

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """The filters' maxima over each window, rectified."""
        parts = [np.concatenate([r.max(axis=1) for r in self.responses(x[i : i + BLOCK])], axis=1) for i in range(0, len(x), BLOCK)]
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def softmax(self, hidden: np.ndarray) -> np.ndarray:
        raw = hidden @ self.out + self.out_bias
        lifted = np.exp(raw - raw.max(axis=1, keepdims=True))
        return lifted / lifted.sum(axis=1, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the log loss, for :meth:`parameters`. Through a maximum, only the place that has it is changed."""
        given = list(self.responses(x))
        best = [r.argmax(axis=1) for r in given]
        peaks = np.concatenate([np.take_along_axis(r, b[:, None], 1)[:, 0] for r, b in zip(given, best, strict=True)], axis=1) + self.bias
        hidden = np.maximum(peaks, 0)
        error = self.softmax(hidden)
        error[np.arange(len(y)), y] -= 1
        error /= len(y)
        back = (error @ self.out.T) * (peaks > 0)
        rows, own = np.arange(len(x))[:, None], np.arange(FILTERS)
        changed = []
        for k, (table, place) in enumerate(zip(self.filters, best, strict=True)):
            part = back[:, k * FILTERS : (k + 1) * FILTERS].ravel()
            slots = [(x[rows, place + j].astype(np.int64) * FILTERS + own).ravel() for j in range(len(table))]
            changed.append(np.stack([np.bincount(s, part, 256 * FILTERS).reshape(256, FILTERS) for s in slots]))
        return [*changed, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]

    def predict(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probabilities of each row, given all rows' bytes and where rows begin."""
        x, owner = windows(FOLDED[data], at)
        weight = (x != BLANK).sum(axis=1) + 1e-6
        shares = self.softmax(self.pooled(x)) * weight[:, None]
        first = np.searchsorted(owner, np.arange(len(at) - 1))
        return np.add.reduceat(shares, first, axis=0) / np.add.reduceat(weight, first)[:, None]


def fit(x: np.ndarray, y: np.ndarray, langs: list[str], rounds: int = ROUNDS, seed: int = SEED) -> Network:
    """Adam in batches; the rate falls to nothing along a line."""
    rng = np.random.default_rng(seed)
    net = Network.drawn(langs, rng)
    fast, slow = ([np.zeros(p.shape, np.float32) for p in net.parameters()] for _ in range(2))
    steps = rounds * -(-len(x) // BATCH)
    done = 0
    for _ in range(rounds):
        order = rng.permutation(len(x))
        for i in range(0, len(x), BATCH):
            some, done = order[i : i + BATCH], done + 1
            for p, g, a, b in zip(net.parameters(), net.gradients(x[some], y[some]), fast, slow, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= RATE * (1 - done / (steps + 1)) * (a / (1 - 0.9**done)) / (np.sqrt(b / (1 - 0.99**done)) + 1e-7)
    return net


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def crops(texts: pa.Array, hashes: np.ndarray) -> list[tuple[int, bytes]]:
    """Row and bytes of the windows that are learned from: places and lengths are drawn from a text's hash."""
    data, at = text_bytes(texts)
    folded, out = FOLDED[data], []
    for row, h in enumerate(hashes.tolist()):
        whole = folded[at[row] : at[row + 1]]
        rng = np.random.default_rng([SEED, h & 0xFFFFFFFFFFFFFFFF])
        for k in range(CROPS):
            length = min(len(whole), WINDOW if k == 0 else int(rng.integers(8, WINDOW + 1)))
            start = int(rng.integers(0, len(whole) - length + 1))
            out.append((row, whole[start : start + length].tobytes().ljust(WINDOW)))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | str | None:
    """The network; the language where there is but one; None where nothing is labelled."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.where(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    pairs = written(known.groupBy("lang", "h").agg(F.count("*").alias("n")), "label-hashes")
    counts = pairs.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    langs = [r["lang"] for r in counts]
    if len(langs) < 2:
        return langs[0] if langs else None
    per_lang = min(MAX_TEXTS, MAX_WINDOWS // CROPS // len(langs))
    # Hashes are even, so twice the share that is wanted has the least ones, and few more rows are ranked than are taken.
    below = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(2.0 * per_lang / r["texts"], 1.0) * 2.0**64 - 2.0**63)])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = pairs.where(F.col("h") <= F.element_at(below, F.col("lang"))).select("lang", "h", place.alias("k")).where(F.col("k") <= per_lang).drop("k")

    def cropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows, found = zip(*crops(part.column("text"), part.column("h").to_numpy()), strict=True)
            yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(rows)), part.column("h").take(pa.array(rows)), pa.array(found, pa.binary())], ["lang", "h", "bytes"])

    sample = known.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", "text").mapInArrow(cropped, "lang string, h long, bytes binary")
    rows = sorted(sample.distinct().collect())
    x = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8).reshape(-1, WINDOW)
    return fit(x, np.array([langs.index(r["lang"]) for r in rows]), langs)


def predicted(docs: DataFrame, model: Network | str | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    text = F.col(text_col).cast("string")
    spoken = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    keyed = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.when(spoken, text).otherwise("").alias("text"), spoken.alias("spoken"))
    if not isinstance(model, Network):
        told = F.col("spoken") & F.lit(model is not None)
        return keyed.select("doc_id", "held_out", F.when(told, F.lit(model)).otherwise(UNKNOWN).alias("lang_pred"), F.when(told, 1.0).otherwise(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            shares = sent.value.predict(*text_bytes(part.column("text")))
            told = part.column("spoken").to_numpy(zero_copy_only=False)
            names = np.where(told, np.array(sent.value.langs, object)[shares.argmax(axis=1)], UNKNOWN)
            score = np.where(told, shares.max(axis=1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    schema = T.StructType([keyed.schema["doc_id"], keyed.schema["held_out"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return keyed.mapInArrow(scored, schema)


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return predicted(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
