"""SimHash near-duplicates, compared in bit slices.

A document's shingles are hashed and each bit of its fingerprint is the majority of theirs. Documents of one
fingerprint are one class. Two fingerprints within ``radius`` bits of each other agree wholly on some ``blocks -
radius`` of ``blocks`` bit ranges, so each class goes into one bucket for every such choice of ranges, and no linked
pair is missed. More classes get more, longer keys, which keeps buckets small; a bucket of over ``MAX_BUCKET`` classes
is dealt out as pairs of chunks, so that no task holds more than two chunks of it.

Inside buckets, sorted rows are stored as 64 vertical bit planes. Shifting planes by d rows puts each row against the
d-th after it; the differing planes run through carry-save counters that add up 64 distances with each word operation,
and a block stops early once no pair in it is within the radius. Links that a bucket already implies aren't repeated.

A text of fewer words than a shingle is one shingle; one without words, or null, has fingerprint 0 and links like any
other. Repeated rows are alike and link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .runtime import kept, slices, written

SHINGLE, SEED, RADIUS = 4, 42, 4
MAX_BUCKET = 8192
BLOCK_ROWS = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The SimHash of UTF-8 text: white space splits words, A-Z are lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    plain = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[width - 1 :].tolist()
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(plain[a:b], SEED) for a, b in zip(starts.tolist(), ends)])  # noqa: B905  the last starts have no end
    bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """All columns but the text, and ``fingerprint`` (the 64 bits as a signed long)."""
    rest = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*rest, T.StructField("fingerprint", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            texts = part.column(text_col).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(x or b"", width) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in rest], pa.array(found)], schema.names)

    return docs.mapInArrow(hashed, schema)


def blocks_for(classes: int, radius: int) -> int:
    """The fewest bit ranges with which a bucket of evenly spread fingerprints has at most 64 of them."""
    n = radius + 1
    while n < 2 * radius and 2 ** (64 * (n - radius) // n) * 64 < classes:
        n += 1
    return n


def bucket_keys(fp: Column, blocks: int, radius: int) -> Column:
    """(table, key) of each choice of ranges on which two fingerprints may agree."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    out = []
    for table, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in chosen)
        out.append(F.struct(F.lit(table).alias("table"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key")))
    return F.array(*out)


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes: word w of plane b holds bit b of rows 64 w to 64 w + 63. Fingerprints are words, or rows of words."""
    width = 64 * (fps.shape[1] if fps.ndim > 1 else 1)
    padded = np.zeros((-(-len(fps) // 64) * 64, width // 64), np.uint64)
    padded[: len(fps)] = fps.reshape(len(fps), width // 64)
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def shifted(planes: np.ndarray, d: int) -> np.ndarray:
    """Lane i of the result is lane i + d."""
    words, bits = divmod(d, 64)
    out = np.zeros_like(planes)
    if words < planes.shape[1]:
        out[:, : planes.shape[1] - words] = planes[:, words:]
        if bits:
            low = out >> np.uint64(bits)
            low[:, :-1] |= out[:, 1:] << np.uint64(64 - bits)
            out = low
    return out


def added(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A carry-save adder: sum and carry of three planes."""
    odd = a ^ b
    return odd ^ c, (a & b) | (odd & c)


def near_lanes(differing: Callable[[int], np.ndarray], bits: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Lanes of ``wanted`` (packed) with at most ``radius`` ones over all planes; ``differing(b)`` gives planes b to b + 7.

    Eight planes at a time run through carry-save adders into vertical counters of 64 lanes a word. The block is left
    as soon as every wanted lane is beyond the radius.
    """
    size = max(3, radius.bit_length())
    counters = [np.zeros(len(wanted), np.uint64) for _ in range(size)]
    over, alive = np.zeros(len(wanted), np.uint64), wanted
    for b in range(0, bits, 8):
        d = differing(b)
        counters[0], two1 = added(counters[0], d[0], d[1])
        counters[0], two2 = added(counters[0], d[2], d[3])
        counters[1], four1 = added(counters[1], two1, two2)
        counters[0], two1 = added(counters[0], d[4], d[5])
        counters[0], two2 = added(counters[0], d[6], d[7])
        counters[1], four2 = added(counters[1], two1, two2)
        counters[2], carry = added(counters[2], four1, four2)
        for i in range(3, size):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        more, equal = over.copy(), ~over
        for i in reversed(range(size)):
            if radius >> i & 1:
                equal &= counters[i]
            else:
                more |= equal & counters[i]
                equal &= ~counters[i]
        alive = wanted & ~more
        if not alive.any():
            return np.empty(0, np.int64)
    return np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))


def packed_lanes(lanes: np.ndarray, words: int) -> np.ndarray:
    """Booleans as bits of so many words."""
    out = np.zeros(words * 64, bool)
    out[: len(lanes)] = lanes
    return np.packbits(out, bitorder="little").view(np.uint64)


def bucket_links(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all near fingerprints of each group (rows sorted by group): pairs (fingerprint, its root)."""
    root = np.arange(len(fps))
    rows = np.arange(len(fps))
    sizes = np.unique(group, return_counts=True)[1]
    left = np.repeat(sizes, sizes)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    d, planes = 1, planes_of(fps)
    while len(rows) > d:
        same = packed_lanes(group[rows[:-d]] == group[rows[d:]], planes.shape[1])
        found = near_lanes(lambda b: planes[b : b + 8] ^ shifted(planes[b : b + 8], d), 64, same, radius)  # noqa: B023  called at once
        a, b = rows[found], rows[found + d]
        differ = root[a] != root[b]
        for i, j in zip(a[differ].tolist(), b[differ].tolist(), strict=True):
            i, j = top(i), top(j)
            root[max(i, j)] = min(i, j)
        while (root[root] != root).any():
            root = root[root]
        d += 1
        if (keep := left[rows] > d).sum() < 0.75 * len(rows):
            rows = rows[keep]
            planes = planes_of(fps[rows])
    apart = root != np.arange(len(fps))
    return fps[apart], fps[root[apart]]


def _compared(radius: int):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(fps), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            a, b = bucket_links(fps.view(np.uint64), np.cumsum(new), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        keys, fps = np.empty((0, 4), np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, np.column_stack([batch.column(c).to_numpy() for c in ("table", "key", "chunk", "other")]).astype(np.int64)])
            fps = np.concatenate([fps, batch.column("fingerprint").to_numpy()])
            if len(fps) >= BLOCK_ROWS:
                inside = (keys == keys[-1]).all(axis=1)
                whole = int(np.flatnonzero(~inside)[-1]) + 1 if not inside.all() else 0
                if whole:
                    yield out(keys[:whole], fps[:whole])
                    keys, fps = keys[whole:], fps[whole:]
        if len(fps):
            yield out(keys, fps)

    return compared


def links(classes: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``radius`` bits of each other."""
    blocks = blocks_for(classes.count(), radius)
    rows = classes.select("fingerprint", F.explode(bucket_keys(F.col("fingerprint"), blocks, radius)).alias("k")).select("k.table", "k.key", "fingerprint")
    large = rows.groupBy("table", "key").count().where(F.col("count") > max_bucket)
    parts = F.ceil(F.col("count") / max_bucket).cast("int")
    large = written(large.select("table", "key", parts.alias("parts")), "large-buckets")
    plain = F.lit(0)
    if large.isEmpty():
        dealt = rows.withColumns({"chunk": plain, "other": plain})
    else:
        chunk = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
        hot = rows.join(large, ["table", "key"]).withColumn("own", chunk).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        hot = hot.select("table", "key", "fingerprint", F.least("own", "with").alias("chunk"), F.greatest("own", "with").alias("other"))
        dealt = rows.join(large, ["table", "key"], "left_anti").withColumns({"chunk": plain, "other": plain}).unionByName(hot)
    keys = ["table", "key", "chunk", "other"]
    near = dealt.repartition(*keys).sortWithinPartitions(*keys, "fingerprint")
    return near.select(*keys, "fingerprint").mapInArrow(_compared(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (long) and ``component_id``, the least id that links reach."""
    marked = written(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))), "fingerprints")

    def named() -> DataFrame:
        classes = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
        found = components(links(classes, radius, max_bucket)).withColumnRenamed("node", "fingerprint")
        linked = found.join(classes, "fingerprint")
        least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
        told = linked.join(least, "root").select("fingerprint", "component_id")
        return classes.join(told, "fingerprint", "left").select("fingerprint", F.coalesce("component_id", "first").alias("component_id"))

    # Written, so that both sides of the last join are plain exchanges and Spark can split a hot fingerprint's partition.
    every = kept(docs.sparkSession, named, "class-components")
    return marked.join(every, "fingerprint").select("doc_id", "fingerprint", "component_id")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
