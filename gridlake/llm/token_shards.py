"""Token ids in raw binary shards with a minimal perfect hash index.

Documents are range-partitioned and sorted by id; each partition encodes its texts and streams one shard file into the
shared folder: first the ids of all its documents, one after the other, as little-endian unsigned integers (2 bytes
where the vocabulary and the end id fit, else 4), then an index, then the length of the index (8 bytes) and a mark.

The index maps keys to documents in constant time. Keys go through levels of bit arrays (Limasset et al., 2017): at a
level each key hashes to one bit, keys alone on theirs are placed and the others go on to the next level; a key's slot is
the rank of its bit over all levels, so n keys have the slots 0 to n - 1. Each slot stores a 32-bit fingerprint of its
key, which tells foreign keys apart, and its first document and number of documents (several rows may share an id).

There are as many shards as shuffle partitions, and a task holds the ids of one shard's documents and their counts, so
``spark.sql.shuffle.partitions`` has to grow with the number of documents.

Files carry a random part in their name, and only those that a finished task reports are read, so tasks may run twice.
Null and empty texts have the end id alone; a null id is a key of its own and stands first. Other columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import new_folder, opened, slices, written

MARK = b"IDSHARD1"
END_ID = 1
#: Stands for null among the bounds of shards.
NO_ID = -(1 << 63)
CACHED_LETTERS = 800_000
GAMMA = 2.0
#: Letters of Latin-1 alone, which every version of Unicode calls letters, and punctuation after them.
PLAIN = r"^(?P<letters>[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<rest>[.,;:!?#$%&*|<>()]*)$"
#: Fixed value: the pattern by which the known tokenizer cuts text.
SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def drops_white_space(path: str) -> bool:
    """True for a tokenizer file of which this is known: lower case, no piece across white space or from letters to punctuation."""
    with open(path, encoding="utf-8") as lines:
        told = json.load(lines)
    steps = [(x["type"], x.get("pattern"), x.get("content")) for x in (told.get("normalizer") or {}).get("normalizers", [])]
    cuts = [(x["type"], x.get("pattern"), x.get("behavior"), x.get("invert"), x.get("add_prefix_space")) for x in (told.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    model = told["model"]
    return (
        steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        and cuts == [("Split", {"Regex": SPLITS}, "Removed", True, None), ("ByteLevel", None, None, None, False)]
        and (model["type"], model.get("end_of_word_suffix"), model.get("dropout"), model.get("unk_token"), told.get("truncation"), told.get("padding")) == ("BPE", "</w>", None, None, None, None)
        and all(not any(x[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) and not any(c.isspace() for c in x["content"]) for x in told.get("added_tokens", []))
    )


class Coder:
    """Ids of texts. Of a tokenizer that drops white space, distinct words alone are encoded; of any other one, whole texts.

    Words are told apart by Arrow's dictionary encoding. A word of Latin letters with punctuation after it is its
    letters, in lower case, and its punctuation; so words that differ in these alone share their letters' ids. Ids of
    letters stay in a cache.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.type = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.by_word = drops_white_space(path)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters: dict[str, bytes] = {}

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not self.by_word:
            return [np.array(x.ids, self.type).tobytes() for x in self.model.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        # Many short-lived strings and no cycles: the cycle collector would only walk them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: pa.Array) -> list[bytes]:
        cut = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " "), " ")
        words = pc.dictionary_encode(cut.flatten())
        if len(self.letters) > CACHED_LETTERS:
            self.letters = {}
        distinct = words.dictionary
        parts = pc.extract_regex(distinct, PLAIN)
        plain = pc.is_valid(parts)
        letters = pc.dictionary_encode(pc.if_else(plain, pc.utf8_lower(pc.struct_field(parts, "letters")), ""))
        rest = pc.dictionary_encode(pc.if_else(plain, pc.struct_field(parts, "rest"), distinct))
        heads, tails = letters.dictionary.to_pylist(), rest.dictionary.to_pylist()
        held = self.letters
        held[""] = b""
        new = [x for x in heads if x not in held]
        for start in range(0, len(new), 512):
            self._learn_plain(new[start : start + 512])
        self._learn([x for x in tails if x not in held])
        pool = [held[x] for x in heads] + [held[x] for x in tails]
        # Ids of all words in their order: of each the piece of its letters and that of the rest.
        at = words.indices.to_numpy()
        pieces = np.column_stack([letters.indices.to_numpy()[at], rest.indices.to_numpy()[at] + len(heads)]).ravel()
        sizes = np.fromiter(map(len, pool), np.int64, len(pool)) // self.type.itemsize
        ids = np.frombuffer(b"".join(pool), self.type)[spread(np.cumsum(sizes) - sizes, sizes, pieces)]
        ends = np.append(0, np.cumsum(sizes[pieces].reshape(-1, 2).sum(axis=1)))[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        data, wide = memoryview(ids.tobytes()), self.type.itemsize
        return [bytes(data[a * wide : b * wide]) for a, b in zip(ends, ends[1:])]  # noqa: B905  the last end has no next

    def _learn_plain(self, words: list[str]) -> None:
        """Words of letters alone: one piece each, whose last token, and no other, closes a word."""
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.type)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            return self._learn(words)
        for w, a, b in zip(words, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            self.letters[w] = ids[a:b].tobytes()

    def _learn(self, words: list[str]) -> None:
        for start in range(0, len(words), 256):
            part = words[start : start + 256]
            found = self.model.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, owner = np.array(found.ids, self.type), np.array(found.word_ids, np.int64)
            edges = np.searchsorted(owner, np.arange(len(part) + 1))
            for i, w in enumerate(part):
                self.letters[w] = ids[edges[i] : edges[i + 1]].tobytes()


def spread(begin: np.ndarray, size: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The places of all members of the chosen ranges, one range after the other."""
    many = size[chosen]
    return np.repeat(begin[chosen] - (np.cumsum(many) - many), many) + np.arange(many.sum())


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(path)


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    x = keys + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 of n distinct 64-bit keys."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.begins = np.cumsum([0, *sizes])
        self.ranks = np.cumsum(bits) - bits

    @classmethod
    def of(cls, keys: np.ndarray, gamma: float = GAMMA) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            size = max(8, int(gamma * len(keys)))
            at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slots of keys; a foreign key gets any slot, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (mixed(keys[left], level) % np.uint64(size)).astype(np.int64) + self.begins[level]
            placed = self.bits[at]
            out[left[placed]] = self.ranks[at[placed]]
            left = left[~placed]
        return out


def key_hashes(ids: list) -> np.ndarray:
    """Distinct 64-bit hashes of distinct integer ids; a null id is a key of its own among practical ids."""
    return mixed(np.array([(1 << 63) if x is None else int(x) % (1 << 64) for x in ids], np.uint64), 77)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1001) >> np.uint64(32)).astype("<u4")


class ShardWriter:
    def __init__(self, uri: str, kind: np.dtype):
        store, path = opened(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.kind = store.open_output_stream(path), kind
        self.ids: list = []
        self.counts: list[int] = []

    def add(self, doc_id, payload: bytes) -> None:
        self.out.write(payload)
        self.ids.append(doc_id)
        self.counts.append(len(payload) // self.kind.itemsize)

    def close(self) -> int:
        """Write the index; the number of ids in the shard."""
        offsets = np.append(0, np.cumsum(np.array(self.counts, np.int64)))
        hashed = key_hashes(self.ids)
        new = np.ones(len(hashed), bool)
        new[1:] = hashed[1:] != hashed[:-1]
        first = np.flatnonzero(new)
        keys = hashed[first]
        index = PerfectHash.of(keys)
        slot = index.slots(keys)
        prints, begin, many = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<i8"), np.zeros(len(keys), "<i8")
        prints[slot], begin[slot], many[slot] = fingerprints(keys), first, np.diff(np.append(first, len(hashed)))
        valid = np.array([x is not None for x in self.ids], bool)
        parts = {
            "offsets": offsets.astype("<i8"), "prints": prints, "begin": begin, "many": many, "bits": np.packbits(index.bits),
            "ids": np.array([x or 0 for x in self.ids], "<i8"), "valid": np.packbits(valid),
        }
        head = json.dumps({"kind": self.kind.str, "sizes": index.sizes, "docs": len(self.ids), "parts": [[k, v.dtype.str, len(v)] for k, v in parts.items()]}).encode()
        body = len(head).to_bytes(8, "little") + head + b"".join(v.tobytes() for v in parts.values())
        self.out.write(body + len(body).to_bytes(8, "little") + MARK)
        self.out.close()
        return int(offsets[-1])


class ShardReader:
    """Constant-time access by key to the ids of a shard's documents."""

    def __init__(self, uri: str):
        store, path = opened(uri)
        self.file = store.open_input_file(path)
        end = self.file.size()
        tail = self.file.read_at(16, end - 16)
        if tail[8:] != MARK:
            raise ValueError(f"{uri} isn't a whole shard")
        body = self.file.read_at(size := int.from_bytes(tail[:8], "little"), end - 16 - size)
        n = int.from_bytes(body[:8], "little")
        head, at = json.loads(body[8 : 8 + n]), 8 + n
        parts = {}
        for name, kind, count in head["parts"]:
            parts[name] = np.frombuffer(body, kind, count, at)
            at += parts[name].nbytes
        self.kind, self.offsets = np.dtype(head["kind"]), parts["offsets"]
        self.prints, self.begin, self.many = parts["prints"], parts["begin"], parts["many"]
        self.index = PerfectHash(head["sizes"], np.unpackbits(parts["bits"], count=sum(head["sizes"])).astype(bool))
        valid = np.unpackbits(parts["valid"], count=head["docs"]).astype(bool)
        self.ids = [x if ok else None for x, ok in zip(parts["ids"].tolist(), valid.tolist(), strict=True)]

    def places(self, ids: list) -> tuple[np.ndarray, np.ndarray]:
        """The first document and the number of documents of each id; 0 documents for ids that the shard doesn't have."""
        keys = key_hashes(ids)
        slot = self.index.slots(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        own = (slot >= 0) & (self.prints[np.maximum(slot, 0)] == fingerprints(keys))
        return np.where(own, self.begin[slot], 0), np.where(own, self.many[slot], 0)

    def tokens(self, document: int, documents: int = 1) -> np.ndarray:
        a, b = int(self.offsets[document]), int(self.offsets[document + documents])
        return np.frombuffer(self.file.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), self.kind)


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the shards of all documents; a row (shard, file, n_docs, n_tokens, low, high, start) for each file.

    ``low`` and ``high`` are the first and the last id (``NO_ID`` for null). Rows of one id are spread over shards by
    their texts, so that an id, or null, may have any share of all rows.
    """
    folder = new_folder(docs.sparkSession, "shards")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = keyed.withColumn("part", F.xxhash64("text"))
    placed = keyed.repartitionByRange("doc_id", "part").sortWithinPartitions("doc_id", "part", "text").drop("part")
    names = ["shard", "file", "n_docs", "n_tokens", "low", "high"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        kind = code.type if end_id < 1 << (8 * code.type.itemsize) else np.dtype("<u4")
        end = np.array([end_id], kind).tobytes()
        shard, file, out = TaskContext.get().partitionId(), f"{folder}/{uuid.uuid4().hex}.ids", None
        for part in slices(batches, "text", 8 << 20):
            out = out or ShardWriter(file, kind)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), code.encode(part.column("text")), strict=True):
                out.add(doc_id, (ids if kind == code.type else np.frombuffer(ids, code.type).astype(kind).tobytes()) + end)
        if out:
            n = out.close()
            ends = [NO_ID if x is None else x for x in (out.ids[0], out.ids[-1])]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if isinstance(x, str) else pa.int64()) for x in (shard, file, len(out.ids), n, *ends)], names)

    shards = written(placed.mapInArrow(put, "shard long, file string, n_docs long, n_tokens long, low long, high long"), "shard-list")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``; each key of a file is looked up in its index."""
    kinds = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def got(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(row["file"])
                keys = list(dict.fromkeys(shard.ids))
                first, many = shard.places(keys)
                owner, found = np.repeat(np.arange(len(keys)), many), spread(first, many, np.arange(len(keys)))
                if not np.array_equal(found, np.arange(len(shard.ids))):
                    raise ValueError(f"the index of {row['file']} doesn't have its documents")
                done = 0
                while done < len(found):
                    stop = max(done + 1, int(np.searchsorted(shard.offsets, shard.offsets[done] + (4 << 20), "right")) - 1)
                    tokens, base = shard.tokens(done, stop - done), int(shard.offsets[done])
                    out = []
                    for i in range(done, stop):
                        a, b = int(shard.offsets[found[i]]), int(shard.offsets[found[i] + 1])
                        out.append((keys[owner[i]], row["start"] + a, b - a, zlib.crc32(tokens[a - base : b - base].astype("<u4").tobytes())))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=kinds)
                    done = stop

    n = shards.count()
    spaced = shards.select("file", "start").repartition(max(1, n), "file")
    return spaced.mapInArrow(got, T.StructType([T.StructField(c, T.LongType()) for c in kinds.names]))


def lookup(shards: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids as binary) of the documents that have the keys, any number of them; a null key finds rows without an id.

    Shards are ranges of ids in order, so a key goes to the shards whose range holds it, found by binary search in their
    bounds (a row of a few numbers for each file). Keys are dealt out by file, and a task opens each of its files once.
    """
    listed = shards.orderBy("shard").select("file", "low", "high").collect()
    low, high = (np.array([r[c] for r in listed], np.int64) for c in ("low", "high"))
    files = [r["file"] for r in listed]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            begin, stop = np.searchsorted(high, ids, "left"), np.searchsorted(low, ids, "right")
            many = np.maximum(stop - begin, 0)
            at = np.repeat(np.arange(len(ids)), many)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), pa.array([files[i] for i in spread(begin, many, np.arange(len(ids)))], pa.string())], ["doc_id", "file"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, shard = None, None
        for batch in batches:
            rows = batch.to_pylist()
            for name, own in groupby(rows, lambda r: r["file"]):
                if name != file:
                    file, shard = name, ShardReader(name)
                keys = [r["doc_id"] for r in own]
                for key, first, many in zip(keys, *[x.tolist() for x in shard.places(keys)], strict=True):
                    for d in range(first, first + many):
                        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([shard.tokens(d).astype("<u4").tobytes()], pa.binary())], ["doc_id", "ids"])

    wanted = keys.select(F.col(id_col).cast("long").alias("doc_id")).distinct().mapInArrow(placed, "doc_id long, file string")
    return wanted.repartition("file").sortWithinPartitions("file", "doc_id").mapInArrow(found, "doc_id long, ids binary")


def shard_report(docs: DataFrame, path: str) -> DataFrame:
    return read_shards(write_shards(docs, path))
