"""Benchmark decontamination with suffix arrays of the training documents.

Documents are cut into shards of a few MB of text. A shard lower-cases A-Z, takes words, and sorts its suffixes into
a suffix array. Every suffix of every benchmark item that starts a window is then looked up there by binary search;
equal ranges give the places of all verbatim matches, and matches that go on along an item give the longest ones.
A shard's array is sparse: a suffix that cannot begin a window (a word in reach that no item has) is left out.

Documents stay where they were read, in one scan, and nothing of them is shuffled. The benchmark's suffixes are sorted in
blocks of about ``BLOCK_BYTES`` of text by a job of their own and written to the shared folder; a task holds a shard and
walks through the blocks, one in memory at a time, and results add up. So a benchmark of any size works, and nothing of
it passes through the driver. Words are compared as 64-bit hashes.

A window is ``WIDTH`` consecutive item words; an item of fewer words, but not none, is one window. Null texts have no
words. Repeated rows each get their own result; several items with one id count as one item. Other columns pass.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import SMALL_SLICE, new_folder, opened, slices, written

WIDTH = 10
BLOCK_BYTES = 4 << 20

IS_WORD = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWERED = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
BYTE_KEYS = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def place_keys(n: int) -> np.ndarray:
    """Odd multipliers by place in a word; the first ones don't depend on ``n``."""
    x = (np.arange(1, n + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, and where each row begins (one more at the end)."""
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the number of words of each row."""
    data, at = text_bytes(column)
    inside = IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = at[:-1][np.diff(at) > 0]
    begins[cuts] |= inside[cuts]
    place = np.flatnonzero(inside)
    first = np.flatnonzero(begins[place])
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    size = np.diff(np.append(first, len(place)))
    inner = np.arange(len(place)) - np.repeat(first, size)
    hashed = np.add.reduceat(BYTE_KEYS[LOWERED[data[place]]] * place_keys(int(size.max()))[inner], first)
    hashed = (hashed ^ (hashed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return hashed ^ (hashed >> np.uint64(29)), np.diff(np.searchsorted(place[first], at))


def keys_of(ids: np.ndarray) -> np.ndarray:
    """Rows of word ids as fixed-width strings that sort like the rows."""
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * ids.shape[1]}").ravel()


@dataclass
class TestSuffixes:
    """The windows of a block of benchmark items, as sorted keys, and the places in items where each one starts."""

    vocabulary: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    items: np.ndarray
    places: np.ndarray
    names: list[str]
    width: int
    shortest: int

    @classmethod
    def of(cls, names: list[str], texts: list[str], width: int = WIDTH) -> TestSuffixes:
        hashed, counts = word_hashes(pa.array(texts, pa.string()))
        vocabulary, ids = np.unique(hashed, return_inverse=True)
        ids = np.append(ids + 1, np.zeros(width, np.int64))
        start = np.cumsum(counts) - counts
        n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(counts)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        size = np.minimum(counts, width)[item]
        rows = ids[(start[item] + place)[:, None] + np.arange(width)] if len(item) else np.zeros((0, width), np.int64)
        beyond = np.arange(width) >= size[:, None]
        low, high = keys_of(np.where(beyond, 0, rows)), keys_of(np.where(beyond, 0xFFFFFFFF, rows))
        order = np.lexsort((place, item, size, low))
        new = np.ones(len(order), bool)
        new[1:] = (low[order][1:] != low[order][:-1]) | (size[order][1:] != size[order][:-1])
        at = np.flatnonzero(new)
        return cls(vocabulary, low[order][at], high[order][at], size[order][at], np.append(at, len(order)), item[order], place[order], names, width, int(size.min(initial=width)))


@dataclass
class Matches:
    """Of each match the word it starts at in the shard and its window; words that any match covers; row of each word."""

    at: np.ndarray
    window: np.ndarray
    hit: np.ndarray
    row: np.ndarray
    counts: np.ndarray


class Shard:
    """The sparse suffix array of some rows of text, given by :func:`word_hashes`."""

    def __init__(self, hashed: np.ndarray, counts: np.ndarray, test: TestSuffixes):
        self.counts = counts
        n, width = len(hashed), test.width
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        found = np.minimum(np.searchsorted(test.vocabulary, hashed), max(len(test.vocabulary) - 1, 0))
        ids = np.where(test.vocabulary[found] == hashed, found + 1, 0) if len(test.vocabulary) else np.zeros(n, np.int64)
        # Where the words that a suffix may use end: at the row's end, or at a word that no item has.
        ends = np.cumsum(self.counts)[self.row] if n else np.empty(0, np.int64)
        unknown = np.where(ids == 0, np.arange(n), n)
        ends = np.minimum(ends, np.minimum.accumulate(unknown[::-1])[::-1]) if n else ends
        start = np.flatnonzero(ends - np.arange(n) >= test.shortest)
        ids = np.append(ids, np.zeros(width, np.int64))
        rows = ids[start[:, None] + np.arange(width)] * (np.arange(width) < (ends[start] - start)[:, None])
        keys = keys_of(rows)
        order = np.argsort(keys, kind="stable")
        self.keys, self.suffixes, self.n = keys[order], start[order], n

    def search(self, test: TestSuffixes) -> Matches:
        """Look up every window; neighbours in the array with one key are one equal range."""
        lo, hi = np.searchsorted(self.keys, test.low, "left"), np.searchsorted(self.keys, test.high, "right")
        many = hi - lo
        window = np.repeat(np.arange(len(many)), many)
        at = self.suffixes[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]
        change = np.zeros(self.n + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + test.sizes[window], -1)
        return Matches(at, window, np.cumsum(change)[: self.n] > 0, self.row, self.counts)


def row_items(found: Matches, test: TestSuffixes) -> list[list[str]]:
    """The ids of the items of each row, sorted as strings."""
    out: list[list[str]] = [[] for _ in found.counts]
    if not len(found.at):
        return out
    pair = np.unique(found.row[found.at] * len(test.sizes) + found.window)
    row, window = pair // len(test.sizes), pair % len(test.sizes)
    many = np.diff(test.first)[window]
    where = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(test.first[:-1][window], many)
    pair = np.unique(np.repeat(row, many) * len(test.names) + test.items[where])
    for r, i in zip((pair // len(test.names)).tolist(), (pair % len(test.names)).tolist(), strict=True):
        out[r].append(test.names[i])
    return [sorted(set(x)) for x in out]


def row_spans(found: Matches) -> list[list[tuple[int, int]]]:
    """The stretches of hit words of each row: first word, and the word after the last."""
    out: list[list[tuple[int, int]]] = [[] for _ in found.counts]
    if not found.hit.any():
        return out
    first = np.cumsum(found.counts) - found.counts
    begins, stops = found.hit.copy(), found.hit.copy()
    begins[1:] &= ~found.hit[:-1] | (found.row[1:] != found.row[:-1])
    stops[:-1] &= ~found.hit[1:] | (found.row[1:] != found.row[:-1])
    for a, b in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(stops).tolist(), strict=True):
        r = int(found.row[a])
        out[r].append((a - int(first[r]), b + 1 - int(first[r])))
    return out


def row_longest(found: Matches, test: TestSuffixes) -> list[list[tuple[str, int, int, int]]]:
    """The longest matches of each row: item, first word in the item, first word in the row, words."""
    out: list[list[tuple[str, int, int, int]]] = [[] for _ in found.counts]
    if not len(found.at):
        return out
    many = np.diff(test.first)[found.window]
    where = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(test.first[:-1][found.window], many)
    at, size = np.repeat(found.at, many), test.sizes[np.repeat(found.window, many)]
    item, place, row = test.items[where], test.places[where], found.row[np.repeat(found.at, many)]
    order = np.lexsort((at, at - place, item, row))
    at, size, item, place, row = at[order], size[order], item[order], place[order], row[order]
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] != 1) | (place[1:] - place[:-1] != 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    first = np.cumsum(found.counts) - found.counts
    for b, e in zip(begin.tolist(), last.tolist(), strict=True):
        r = int(row[b])
        out[r].append((test.names[int(item[b])], int(place[b]), int(at[b] - first[r]), int(at[e] + size[e] - at[b])))
    return out


def united(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if not a or not b:
        return a or b
    out: list[tuple[int, int]] = []
    for x, y in sorted(a + b):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def written_blocks(benchmark: DataFrame, id_col: str, text_col: str, width: int, block_bytes: int) -> list[str]:
    """The files of the benchmark's sorted suffixes, one for each block of about ``block_bytes`` of distinct items."""
    items = benchmark.select(F.col(id_col).cast("string").alias("name"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = items.where("text <> ''").groupBy("name", "text").agg(F.lit(1).alias("one")).drop("one")
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).collect()[0][0] or 0
    n, folder = max(1, -(-total // block_bytes)), new_folder(benchmark.sparkSession, "benchmark")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(n))).repartition(n, "block").sortWithinPartitions("block", "name", "text")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for _, own in groupby(rows, lambda r: r["block"]):
            held = list(own)
            file = f"{folder}/{uuid.uuid4().hex}.block"
            store, path = opened(file)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(path) as out:
                out.write(pickle.dumps(TestSuffixes.of([r["name"] or "" for r in held], [r["text"] for r in held], width)))
            yield pa.RecordBatch.from_pydict({"file": [file]})

    return sorted(r["file"] for r in written(dealt.mapInArrow(put, "file string"), "benchmark-blocks").collect())


@lru_cache(maxsize=1)
def block_of(file: str) -> TestSuffixes:
    """A block as written; the last one stays in memory, so a benchmark of one block is read once by a worker."""
    store, path = opened(file)
    with store.open_input_stream(path) as stream:
        return pickle.loads(stream.read())


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``spans`` (stretches of hit words) and ``items`` (ids, sorted as strings)."""
    keys = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    files = written_blocks(benchmark, "item_id", "text", width, block_bytes)
    place = T.StructType([T.StructField(c, T.IntegerType()) for c in ("start", "stop")])
    schema = T.StructType([keys.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(place)), T.StructField("items", T.ArrayType(T.StringType()))])
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, counts = word_hashes(part.column("text"))
            spans: list[list[tuple[int, int]]] = [[] for _ in counts]
            items: list[list[str]] = [[] for _ in counts]
            for file in files:
                test = block_of(file)
                found = Shard(hashed, counts, test).search(test)
                if len(found.at):
                    spans = [united(a, b) for a, b in zip(spans, row_spans(found), strict=True)]
                    items = [sorted({*a, *b}) if a and b else a or b for a, b in zip(items, row_items(found, test), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array([[{"start": a, "stop": b} for a, b in x] for x in spans], spans_type), pa.array(items, pa.list_(pa.string()))],
                schema.names,
            )

    return keys.mapInArrow(searched, schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    found = contamination(docs, benchmark, width=width, block_bytes=block_bytes)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each longest verbatim match: ``doc_id``, ``item_id`` (string), where it starts in words, and its words."""
    keys = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    files = written_blocks(benchmark, "item_id", "text", width, block_bytes)
    schema = T.StructType([keys.schema["doc_id"], T.StructField("item_id", T.StringType())] + [T.StructField(c, T.IntegerType()) for c in ("item_word", "doc_word", "n_words")])

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashed, counts = word_hashes(part.column("text"))
            ids = part.column("doc_id").to_pylist()
            for file in files:
                test = block_of(file)
                rows = [(ids[r], *x) for r, found in enumerate(row_longest(Shard(hashed, counts, test).search(test), test)) for x in found]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [part.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema.names)

    return keys.mapInArrow(located, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    files = written_blocks(benchmark, "item_id", "text", width, block_bytes)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, SMALL_SLICE):
            hashed, counts = word_hashes(part.column(text_col).fill_null(""))
            dirty = np.zeros(part.num_rows, bool)
            for file in files:
                test = block_of(file)
                found = Shard(hashed, counts, test).search(test)
                dirty[found.row[found.at]] = True
            yield part.filter(pa.array(~dirty))

    return docs.mapInArrow(cleaned, docs.schema)
