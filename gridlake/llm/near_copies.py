"""One text of each group of near copies: a Jaccard similarity of at least 0.8 over sets of 5-word shingles.

Texts with one set of shingles are one node, named by 128 bits. 64-bit fingerprints of linked nodes differ in about 10
bits, too many for the bit ranges of :mod:`simhash`, so nodes meet in the buckets of 32 keys, each made of 5 least
hashes (a pair at 0.8 shares none with probability 3e-6), and have SimHash fingerprints of 256 bits. In buckets,
fingerprints are compared in bit planes by carry-save counters, and pairs within ``RADIUS`` go on to the exact check on
whole sets. At 0.8 at most 0.161 of the bits are expected to differ (0.188 for sets of 4 and 5), so a pair is beyond
the radius with probability 3e-7.

A group of n near copies isn't compared pair by pair. Each bucket draws ``CENTRES`` members, each other member takes the
first centre that is close, else one within the radius, and one pair is checked; this goes on with new centres for
nodes that aren't linked yet while it halves what is left. Then only buckets of several components are left. Their
members meet with their sets, in chunks of at most ``CHUNK`` rows and about ``CHUNK_HASHES`` shingles, so that a task holds no
more than two chunks of a bucket, however long texts are: pairs of different components within the radius are checked in place and only links leave the task, so no pair is ever written or moved.
A large group of texts that are all just under 0.8 from each other, and only such a group, still costs comparisons in
the square of its size.

Sets are made once for names and keys and again for nodes that meet others, so sets of all texts are never stored.

Null texts and texts without words are alike. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .runtime import SMALL_SLICE, free_names, kept, slices, written
from .simhash import SEED, near_lanes, packed_lanes, planes_of, shifted

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5
BITS, CLOSE = 256, 39
#: Distances that pairs of 0.8 stay within: of sets of up to SMALL shingles, and of larger ones.
SMALL, SMALL_RADIUS, RADIUS = 5, 80, 71
CENTRES, CHUNK, CHUNK_HASHES = 4, 2048, 1 << 21
#: Bytes of rows that a task compares at once (beside the rest of a bucket), and of the table of common shingles of a turn.
BLOCK_BYTES, DENSE_BYTES = 64 << 20, 64 << 20
#: The kept and dropped keys are broadcast up to this many rows (two numbers each), else joined by a shuffle.
MAX_BROADCAST = 1_000_000
_random = np.random.default_rng(SEED)
LOW_FACTORS, HIGH_FACTORS = (_random.integers(0, 1 << 32, (BANDS * ROWS, 1), np.uint32) | np.uint32(1) for _ in range(2))
SALTS = _random.integers(1, 1 << 63, BITS // 64, np.uint64)


def shingle_set(text: bytes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of UTF-8 text: white space splits words, A-Z are lower-cased."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    plain = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(plain[a:b], SEED) for a, b in zip(starts.tolist(), ends)]), np.uint64))  # noqa: B905  the last starts have no end


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """``BANDS`` keys; two sets of similarity s share none with probability (1 - s ** ROWS) ** BANDS."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(hashes), 512):
        mixed = LOW_FACTORS * low[start : start + 512] + HIGH_FACTORS * high[start : start + 512]
        np.minimum(least, mixed.min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), b) for b, band in enumerate(least.reshape(BANDS, ROWS))], np.uint64)


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of a set in ``BITS`` bits: a bit is 1 if it is set in over half of the hashes."""
    count = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 4096):
        x = hashes[start : start + 4096, None] ^ SALTS
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        count += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(count * 2 > len(hashes), bitorder="little").view(np.uint64)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Per row: ``id``, ``text_hash``, ``node`` (128 bits of its set of shingles), ``size``, ``keys`` and ``print``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kinds = [("node", T.BinaryType()), ("size", T.IntegerType()), ("keys", T.ArrayType(T.LongType())), ("print", T.BinaryType())]
    schema = T.StructType([rows.schema["id"], rows.schema["text_hash"], *[T.StructField(*k) for k in kinds]])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SMALL_SLICE):
            sets = [shingle_set(x, width) for x in part.column("text").cast(pa.binary()).to_pylist()]
            held = [x.tobytes() for x in sets]
            keys = pa.array([band_keys(x).view(np.int64) if len(x) else [] for x in sets], pa.list_(pa.int64()))
            columns = [
                pa.array([xxhash.xxh3_128_digest(x) for x in held], pa.binary()),
                pa.array([len(x) for x in sets], pa.int32()),
                keys,
                pa.array([wide_fingerprint(x).tobytes() for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_hash"), *columns], schema.names)

    return rows.mapInArrow(sketched, schema)


def sets_of(docs: DataFrame, nodes: DataFrame, met: DataFrame, text_col: str, width: int, max_broadcast: int) -> DataFrame:
    """(node, hashes): the set of each node that is met, made from one text of it."""
    wanted = written(nodes.join(met, "node", "left_semi").select("text_hash").distinct(), "met-texts")
    side = F.broadcast(wanted) if wanted.count() <= max_broadcast else wanted
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text")).join(side, "text_hash", "left_semi").select("text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SMALL_SLICE):
            # Exact copies stand for one node, of which one is enough here.
            held = dict.fromkeys(part.column("text").cast(pa.binary()).to_pylist())
            sets = {xxhash.xxh3_128_digest(x): x for x in (shingle_set(t, width).tobytes() for t in held)}
            yield pa.RecordBatch.from_arrays([pa.array(sets.keys(), pa.binary()), pa.array(sets.values(), pa.binary())], ["node", "hashes"])

    made_sets = rows.mapInArrow(made, "node binary, hashes binary").groupBy("node").agg(F.first("hashes").alias("hashes"))
    return written(made_sets.join(met, "node", "left_semi"), "shingle-sets")


def words_of(column: pa.Array, n: int) -> np.ndarray:
    """A binary column of ``8 n`` bytes each as rows of n words."""
    _, offsets, data = column.buffers()
    at = int(np.frombuffer(offsets, np.int32)[column.offset]) if len(column) else 0
    return np.frombuffer(data or b"", np.uint64, len(column) * n, at).reshape(len(column), n) if len(column) else np.zeros((0, n), np.uint64)


def _fit(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Sizes that sets of this similarity can have."""
    return np.minimum(a, b) >= (similarity - 1e-9) * np.maximum(a, b)


def _near_centres(similarity: float):
    """Each row with one centre of its bucket that is close, else within the radius, and of another component."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            planes = planes_of(words_of(batch.column("print"), BITS // 64))
            root, size = batch.column("mark").to_numpy(), batch.column("size").to_numpy()
            left, pairs = np.ones(batch.num_rows, bool), []
            for radius in (CLOSE, RADIUS, SMALL_RADIUS):
                for k in range(CENTRES):
                    theirs = batch.column(f"c{k}")
                    mark, big, node, prints = (theirs.field(f) for f in ("mark", "size", "node", "print"))
                    wanted = left & (root != mark.to_numpy()) & _fit(size, big.to_numpy(), similarity)
                    if radius == SMALL_RADIUS:
                        wanted &= size <= SMALL
                    if not wanted.any():
                        continue
                    other = planes_of(words_of(prints, BITS // 64))
                    found = near_lanes(lambda b: planes[b : b + 8] ^ other[b : b + 8], BITS, packed_lanes(wanted, planes.shape[1]), radius)  # noqa: B023  called at once
                    left[found] = False
                    at = pa.array(found)
                    pairs.append(pa.RecordBatch.from_arrays([batch.column("node").take(at), node.take(at)], ["a", "b"]))
            yield from pairs

    return near


def shared_bits(sets: list[np.ndarray], most: int = DENSE_BYTES) -> np.ndarray | None:
    """Of each set a row of bits: the members that two sets or more have, so that counts of common bits are sizes of intersections; None if that takes over ``most`` bytes."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    values, column, many = np.unique(flat, return_inverse=True, return_counts=True)
    places = np.cumsum(many > 1) - 1
    row, common = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), many[column] > 1
    wide = -(-int((many > 1).sum()) // 64) or 1
    if 8 * wide * len(sets) > most:
        return None
    bits = np.zeros((len(sets), wide), np.uint64)
    at = places[column[common]]
    np.bitwise_or.at(bits, (row[common], at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return bits


def _near_pairs(similarity: float):
    """Links of rows of one bucket (sorted by it) and of different components: within the radius, and similar by their whole sets."""

    def pairs(held: pa.Table) -> Iterator[pa.RecordBatch]:
        held = held.combine_chunks().to_batches()[0]
        keys = np.column_stack([held.column(c).to_numpy() for c in ("key", "chunk", "other")])
        group = np.cumsum(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) - 1
        begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        size, own = (held.column(c).to_numpy() for c in ("size", "own"))
        root = np.unique(held.column("mark").to_numpy(), return_inverse=True)[1]
        prints, apart = words_of(held.column("print"), BITS // 64), held.column("chunk").to_numpy() != held.column("other").to_numpy()
        sets, bits = held.column("hashes"), {}
        sizes = np.bincount(group)
        left, rows, d, planes = np.repeat(sizes, sizes), np.arange(len(group)), 1, planes_of(prints)
        linked: list[np.ndarray] = []
        _, offsets, data = sets.buffers()
        ends, members = np.frombuffer(offsets, np.int32 if pa.types.is_binary(sets.type) else np.int64)[sets.offset :], np.frombuffer(data or b"", np.uint8)

        def set_at(k: int) -> np.ndarray:
            return members[ends[k] : ends[k + 1]].view(np.uint64)

        def similar(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.zeros(len(i), bool)
            for g in np.unique(group[i]).tolist():
                start, some = begins[g], np.flatnonzero(group[i] == g)
                if g not in bits:
                    bits[g] = shared_bits([set_at(k) for k in range(start, start + sizes[g])])
                if bits[g] is None:
                    shared = np.array([len(np.intersect1d(set_at(x), set_at(y), assume_unique=True)) for x, y in zip(i[some].tolist(), j[some].tolist(), strict=True)])
                    out[some] = shared >= similarity * (size[i[some]] + size[j[some]] - shared) - 1e-9
                    continue
                for few in np.array_split(some, -(-len(some) * bits[g].shape[1] // (1 << 20))):
                    a, b = i[few], j[few]
                    shared = np.bitwise_count(bits[g][a - start] & bits[g][b - start]).sum(axis=1, dtype=np.int64)
                    out[few] = shared >= similarity * (size[a] + size[b] - shared) - 1e-9
            return out

        while len(rows) > d:
            i, j = rows[:-d], rows[d:]
            # Chunks meet others here; pairs inside a chunk have a turn of their own.
            wanted = (group[i] == group[j]) & (root[i] != root[j]) & _fit(size[i], size[j], similarity) & ~(apart[i] & (own[i] == own[j]))
            small = np.minimum(size[i], size[j]) <= SMALL
            differing = lambda b: planes[b : b + 8] ^ shifted(planes[b : b + 8], d)  # noqa: B023, E731  called at once
            for lanes, radius in ((wanted & ~small, RADIUS), (wanted & small, SMALL_RADIUS)):
                if not lanes.any():
                    continue
                found = near_lanes(differing, BITS, packed_lanes(lanes, planes.shape[1]), radius)
                a, b = i[found], j[found]
                sure = similar(a, b)
                linked.append(np.column_stack([a[sure], b[sure]]))
                for x, y in linked[-1].tolist():
                    if root[x] != root[y]:
                        # Rows of one component, in whatever bucket of this block, need no further link.
                        root[root == root[y]] = root[x]
            d += 1
            if (keep := left[rows] > d).sum() < 0.75 * len(rows):
                rows = rows[keep]
                planes = planes_of(prints[rows])
        found = np.concatenate(linked) if linked else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([held.column("node").take(pa.array(found[:, 0])), held.column("node").take(pa.array(found[:, 1]))], ["a", "b"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in batches:
            for batch in slices([whole], "hashes", BLOCK_BYTES):
                # A slice still points to all of its batch; only rows that wait for more are copied.
                new = pa.Table.from_batches([batch])
                held = new if held is None else pa.concat_tables([held, new])
                if held.nbytes >= BLOCK_BYTES:
                    keys = np.column_stack([held.column(c).to_numpy() for c in ("key", "chunk", "other")])
                    before = np.flatnonzero((keys != keys[-1]).any(axis=1))
                    if len(before):
                        yield from pairs(held.slice(0, int(before[-1]) + 1))
                        held = held.slice(int(before[-1]) + 1)
            held = held.combine_chunks() if held is not None else None
        if held is not None and held.num_rows:
            yield from pairs(held)

    return near


def _similar(similarity: float):
    """Keep pairs whose sets have at least this Jaccard similarity."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "x"):
                keep = []
                for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return similar


def _dealt(rows: DataFrame, sets: DataFrame, keys: DataFrame, chunk: int) -> DataFrame:
    """Rows of open buckets with the turn (chunk, other) that they take part in; a bucket of over ``chunk`` rows, or of very long texts, gives a turn to each pair of chunks."""
    parts = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("hashes_in") / CHUNK_HASHES)).cast("int")
    placed = rows.join(keys.select("key", parts.alias("parts")), "key").join(sets, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    turns = placed.select("key", F.least("own", "with").alias("chunk"), F.greatest("own", "with").alias("other"), "own", "node", "mark", "size", "print", "hashes")
    order = ["key", "chunk", "other"]
    return turns.repartition(*order).sortWithinPartitions(*order, "node")


def similar_links(docs: DataFrame, sketched: DataFrame, text_col: str, width: int, similarity: float, max_broadcast: int, chunk: int | None = None) -> DataFrame:
    """(node, root) of sets that links of at least ``similarity`` connect to others."""
    nodes = sketched.groupBy("node").agg(F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("print").alias("print"), F.min("text_hash").alias("text_hash"))
    nodes = written(nodes, "nodes")
    rows = nodes.select("node", F.explode("keys").alias("key"))
    shared = written(rows.groupBy("key").count().where("count > 1").select("key"), "shared-keys")
    rows = written(rows.join(shared, "key", "left_semi"), "band-rows")
    met = written(rows.select("node").distinct(), "met")
    state = nodes.join(met, "node", "left_semi").select("node", "size", "print")
    sets = sets_of(docs, nodes, met, text_col, width, max_broadcast)

    def confirmed(pairs: DataFrame) -> DataFrame:
        some = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
        if some.count() <= max_broadcast:
            # Only the sets of candidates move, to their pair; sets that no pair asks for stay where they are.
            ends = some.select("a", "b", F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(True).alias("first")), F.struct(F.col("b").alias("node"), F.lit(False).alias("first")))).alias("e"))
            met_pairs = sets.join(F.broadcast(ends.select("a", "b", "e.*")), "node").groupBy("a", "b")
            both = met_pairs.agg(F.max(F.when(F.col("first"), F.col("hashes"))).alias("x"), F.max(F.when(~F.col("first"), F.col("hashes"))).alias("y"))
        else:
            both = some.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(_similar(similarity), "a binary, b binary")

    found: DataFrame | None = None
    before, turn, over = 0.0, 0, False

    def next_roots() -> DataFrame:
        """The components after one more turn; nothing but them is kept of it."""
        nonlocal before, over
        known = state.withColumn("root", F.col("node")) if found is None else state.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
        now = rows.join(known.withColumn("mark", F.xxhash64("root")).drop("root"), "node")
        now = written(now, "rooted-rows")
        each = now.groupBy("key", "mark").agg(F.count("*").alias("n"), F.sum("size").alias("hashes_in"))
        each = each.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"), F.sum("hashes_in").alias("hashes_in"))
        open_keys = written(each.where("n * n > own"), "open-keys")
        open_pairs = open_keys.agg(F.sum((F.col("n") * F.col("n") - F.col("own")).cast("double")), F.sum("n")).collect()[0]
        if open_pairs[0] is None:
            over = True
            return found if found is not None else sketched.sparkSession.createDataFrame([], "node binary, root binary")
        over = bool(turn and (open_pairs[0] <= 16 * open_pairs[1] or open_pairs[0] > before / 2))
        before = open_pairs[0]
        if over:
            links = _dealt(now, sets, open_keys, chunk or CHUNK).mapInArrow(_near_pairs(similarity), "a binary, b binary")
        else:
            member = lambda k: F.min(F.struct(F.xxhash64("node", F.lit(turn * CENTRES + k)), "node", "mark", "size", "print"))
            centres = now.join(open_keys.select("key"), "key", "left_semi").groupBy("key").agg(*[member(k).alias(f"c{k}") for k in range(CENTRES)])
            links = confirmed(now.join(written(centres, "centres"), "key").mapInArrow(_near_centres(similarity), "a binary, b binary"))
        edges = written(links, "confirmed")
        if found is not None:
            edges = edges.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return components(edges)

    while not over:
        found = kept(sketched.sparkSession, next_roots, "roots")
        turn += 1
    return found


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, similarity: float = SIMILARITY, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One document of each component of texts whose sets of ``width``-word shingles are similar, the one with the least id, with all columns.

    Ids play no part in what is linked: rows without one, or that share one, stay apart unless their texts are near. Rows
    without an id come last, and rows alike in id and text are reduced to one.
    """
    own_id, own_hash, first, text = free_names(docs, "own_id", "own_hash", "is_first", "text_hash")

    def marks() -> DataFrame:
        """Rows that aren't simply kept: those of another place than their group's first, and several rows of the first place."""
        sketched = written(sketches(docs, id_col, text_col, width), "sketches")
        found = similar_links(docs, sketched, text_col, width, similarity, max_broadcast)
        rooted = sketched.select("id", "text_hash", "node").join(found, "node", "left").select("id", "text_hash", F.coalesce("root", "node").alias("root"))
        rows = rooted.groupBy("root", "id", "text_hash").agg(F.count("*").alias("n"))
        place = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
        least = written(rows.groupBy("root").agg(F.min(place).alias("p")), "least-places")
        marked = rows.join(least, "root").select(F.col("id").alias(own_id), F.col("text_hash").alias(own_hash), (place == F.col("p")).alias(first), "n")
        return marked.where(f"NOT {first} OR n > 1").drop("n")

    marked = kept(docs.sparkSession, marks, "marked-rows")
    n, again = marked.agg(F.count("*"), F.count_if(first)).collect()[0]
    if not n:
        return docs
    keyed = docs.withColumn(text, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    side = F.broadcast(marked) if n <= max_broadcast else marked
    keyed = keyed.join(side, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(text) == F.col(own_hash)), "left")
    single = keyed.where(F.col(first).isNull()).select(*docs.columns)
    if not again:
        return single
    return single.unionByName(keyed.where(first).dropDuplicates([id_col, text]).select(*docs.columns))
