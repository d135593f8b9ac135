"""Quality classifier by attention-based multiple-instance learning (Ilse et al., 2018).

A document is a bag of passages of ``PASSAGE`` words. A small layer encodes every passage from counts of its
characters, words and repetitions and from its words, hashed to ``BUCKETS`` shares; gated attention gives each passage a
weight among those of its document; the weighted sum is scored. Only document labels are known, so attention is learned
from them alone.

Training takes at most ``MAX_LABELLED`` labelled documents, those with the least hash of their id, whole and in that
order until they have ``MAX_PASSAGES`` passages together (documented bounds on the rows that are fitted; one text of an
id with several, that with the least hash). Their features are all that reaches the driver, at most ``MAX_PASSAGES`` rows
of ``N_FEATURES`` numbers, about 40 MB. Scores come from whole texts of all documents, in one scan without a shuffle.

Null and empty texts are one passage without words. Repeated rows score alike. Labels that disagree count by majority,
ties and null labels are left out; with labels of one class or none, every score is the share of ones (0.5 if none).
Other columns are ignored and no input but the text reaches a score.
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
from .suffixes import BYTE_KEYS, place_keys, text_bytes

#: ``MAX_PASSAGES`` is the sum over the labelled rows; rows are taken whole until it is reached.
PASSAGE, MAX_LABELLED, MAX_PASSAGES = 50, 8000, 256_000
HIDDEN, ATTENTION, ROUNDS, RATE, DECAY = 16, 8, 300, 0.02, 1e-4

#: Kinds of bytes that passages count.
KINDS = ["space", "line", "lower", "upper", "digit", "stop", "shout", "quote", "symbol", "other", "high"]
_KIND = {**dict.fromkeys(b" \t\v\f\r", 0), 0x0A: 1, **dict.fromkeys(range(0x61, 0x7B), 2), **dict.fromkeys(range(0x41, 0x5B), 3), **dict.fromkeys(range(0x30, 0x3A), 4), **dict.fromkeys(b".,;:?", 5), **dict.fromkeys(b"!", 6), **dict.fromkeys(b"'\"", 7), **dict.fromkeys(b"#*$%&|<>@=_~^+/\\{}[]", 8), **dict.fromkeys(range(0x80, 0x100), 10)}
KIND_OF = np.array([_KIND.get(b, 9) for b in range(256)], np.int64)
BUCKETS = 16
N_FEATURES = len(KINDS) + 8 + BUCKETS


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of all rows, in order, and the row of each passage (every row has one at least)."""
    data, at = text_bytes(column)
    rows = len(column)
    kind = KIND_OF[data]
    inside = kind > 1
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = at[:-1][np.diff(at) > 0]
    begins[cuts] |= inside[cuts]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, at))
    first_word = np.cumsum(counts) - counts
    parts = np.maximum(1, -(-counts // PASSAGE))
    first_part = np.cumsum(parts) - parts
    owner = np.repeat(np.arange(rows), parts)
    n = len(owner)
    row_of_word = np.repeat(np.arange(rows), counts)
    inner = np.arange(len(starts)) - first_word[row_of_word]
    part_of_word = first_part[row_of_word] + inner // PASSAGE
    # Bytes belong to the passage of the last word that began in their row, or to the row's first passage.
    row_of_byte = np.repeat(np.arange(rows), np.diff(at))
    word_of_byte = np.cumsum(begins) - 1
    part_of_byte = first_part[row_of_byte] + np.maximum(0, word_of_byte - first_word[row_of_byte]) // PASSAGE
    seen = np.bincount(part_of_byte * len(KINDS) + kind, minlength=n * len(KINDS)).reshape(n, len(KINDS)).astype(np.float64)
    size = np.maximum(1.0, seen.sum(axis=1))
    words = np.bincount(part_of_word, minlength=n).astype(np.float64)
    safe = np.maximum(1.0, words)
    out = np.zeros((n, N_FEATURES))
    out[:, : len(KINDS)] = seen / size[:, None]
    k = len(KINDS)
    out[:, k] = np.log1p(words) / 4
    out[:, k + 1] = np.log1p(counts[owner]) / 8
    out[:, k + 2] = (size - seen[:, 0] - seen[:, 1]) / safe / 8
    out[:, k + 3] = seen[:, 8] / safe
    out[:, k + 4] = seen[:, 6] / safe
    if len(starts):
        place = np.flatnonzero(inside)
        sizes = np.diff(np.append(np.searchsorted(place, starts), len(place)))
        within = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        hashed = np.add.reduceat(BYTE_KEYS[data[place]] * place_keys(int(sizes.max()))[within], np.cumsum(sizes) - sizes)
        grams = hashed.copy()
        for d, salt in ((1, 3), (2, 5)):
            grams[:-d] += hashed[d:] * np.uint64(0x9E3779B97F4A7C15 ^ salt)
        grams += row_of_word.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        whole = inner + 2 < counts[row_of_word]
        out[:, k + 5] = np.bincount(part_of_word[whole], again(grams[whole]), minlength=n) / safe
        line = np.cumsum(kind == 1)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (line[1:] != line[:-1]) | (row_of_word[1:] != row_of_word[:-1])
        head = np.flatnonzero(new)
        mixed = np.add.reduceat(hashed * place_keys(len(hashed))[np.arange(len(hashed)) - np.repeat(head, np.diff(np.append(head, len(hashed))))], head)
        mixed += row_of_word[head].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        lines = np.maximum(1.0, np.bincount(part_of_word[head], minlength=n))
        out[:, k + 6] = np.bincount(part_of_word[head], again(mixed), minlength=n) / lines
        out[:, k + 7] = np.bincount(part_of_word, sizes > 15, minlength=n) / safe
        bucket = ((hashed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.int64) % BUCKETS
        out[:, k + 8 :] = np.bincount(part_of_word * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS) / safe[:, None]
    return out, owner


def again(values: np.ndarray) -> np.ndarray:
    """True for values that occur twice or more."""
    _, back, n = np.unique(values, return_inverse=True, return_counts=True)
    return n[back] > 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, owner: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        w = self.weights
        coded = np.tanh(x @ w["encode"] + w["encode0"])
        told, gate = np.tanh(coded @ w["tell"]), _sigmoid(coded @ w["gate"])
        raw = (told * gate) @ w["attend"]
        # Passages stand in the order of their documents, and each document has one at least.
        first = np.searchsorted(owner, np.arange(bags))
        lifted = np.exp(raw - np.maximum.reduceat(raw, first)[owner])
        share = lifted / np.add.reduceat(lifted, first)[owner]
        bag = np.add.reduceat(share[:, None] * coded, first, axis=0)
        return {"coded": coded, "told": told, "gate": gate, "share": share, "bag": bag, "score": _sigmoid(bag @ w["score"] + w["score0"][0])}

    def score(self, features: np.ndarray, owner: np.ndarray, bags: int) -> np.ndarray:
        if self.constant is not None or not bags:
            return np.full(bags, self.constant or 0.0)
        return self.forward((features - self.mean) / self.spread, owner, bags)["score"]


def fit(features: np.ndarray, owner: np.ndarray, labels: np.ndarray, seed: int = 11, rounds: int = ROUNDS) -> Model:
    """Adam on the log loss of whole bags."""
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, 0.5 if len(labels) == 0 else float(labels[0]))
    rng = np.random.default_rng(seed)
    draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
    w = {"encode": draw(N_FEATURES, HIDDEN), "encode0": np.zeros(HIDDEN), "tell": draw(HIDDEN, ATTENTION), "gate": draw(HIDDEN, ATTENTION), "attend": draw(ATTENTION, 1)[:, 0], "score": draw(HIDDEN, 1)[:, 0], "score0": np.zeros(1)}
    model = Model(features.mean(axis=0), features.std(axis=0) + 1e-3, w)
    x, bags = (features - model.mean) / model.spread, len(labels)
    fast, slow = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        f = model.forward(x, owner, bags)
        coded, told, gate, share = f["coded"], f["told"], f["gate"], f["share"]
        error = (f["score"] - labels) / bags
        d_bag = error[:, None] * w["score"]
        d_share = (d_bag[owner] * coded).sum(axis=1)
        d_raw = share * (d_share - np.bincount(owner, share * d_share, minlength=bags)[owner])
        d_told = d_raw[:, None] * w["attend"] * gate * (1 - told**2)
        d_gate = d_raw[:, None] * w["attend"] * told * gate * (1 - gate)
        d_coded = (share[:, None] * d_bag[owner] + d_told @ w["tell"].T + d_gate @ w["gate"].T) * (1 - coded**2)
        grads = {"encode": x.T @ d_coded, "encode0": d_coded.sum(axis=0), "tell": coded.T @ d_told, "gate": coded.T @ d_gate, "attend": (told * gate).T @ d_raw, "score": f["bag"].T @ error, "score0": np.array([error.sum()])}
        for k, g in grads.items():
            g = g + DECAY * w[k]
            fast[k] = 0.9 * fast[k] + 0.1 * g
            slow[k] = 0.999 * slow[k] + 0.001 * g * g
            w[k] -= RATE * (fast[k] / (1 - 0.9**step)) / (np.sqrt(slow[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", max_labelled: int = MAX_LABELLED, max_passages: int = MAX_PASSAGES) -> Model:
    """Fit on a bounded sample of labelled documents that aren't held out."""
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg(F.col(target).cast("double")).alias("share")).where("share <> 0.5")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).select("doc_id", (F.col("share") > 0.5).cast("double").alias("label"))
    # At most max_labelled rows of two numbers.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found, owner = passages(part.column("text"))
            rows = []
            for own in np.split(found.astype("<f4"), np.searchsorted(owner, np.arange(1, part.num_rows))):
                rows.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "features"])

    schema = T.StructType([texts.schema["doc_id"], T.StructField("label", T.DoubleType()), T.StructField("features", T.BinaryType())])
    least = F.min_by(F.struct("label", "features"), F.struct(F.xxhash64("features"), "features"))
    every = written(texts.mapInArrow(described, schema).groupBy("doc_id").agg(least.alias("b")).select("doc_id", "b.*"), "bags")
    # One partition of at most max_labelled rows of two numbers; at least the first row is taken, however long it is.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    size = every.select("doc_id", (F.octet_length("features") / (4 * N_FEATURES)).alias("n"))
    fit_in = size.select("doc_id", F.sum("n").over(order).alias("until"), F.row_number().over(order).alias("at")).where((F.col("until") <= max_passages) | (F.col("at") == 1))
    rows = sorted(every.join(F.broadcast(fit_in.select("doc_id")), "doc_id").collect(), key=lambda r: r["doc_id"])
    bags = [np.frombuffer(r["features"], "<f4").reshape(-1, N_FEATURES).astype(np.float64) for r in rows]
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return fit(np.concatenate(bags) if bags else np.zeros((0, N_FEATURES)), owner, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sent.value.score(*passages(part.column("text")), part.num_rows))], ["doc_id", "score"])

    return keyed.mapInArrow(scored, T.StructType([keyed.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    found = score(docs, train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
