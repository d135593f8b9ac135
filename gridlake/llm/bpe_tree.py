"""Byte-level BPE as a monoid: encode halves, join neighbours at their boundary, decode by concatenation.

A text is halved until a piece has at most ``LEAF`` code points, the leaves are encoded, and neighbours are joined up
the tree. A join re-encodes a window around the boundary and keeps all tokens outside. The window grows until one of
two facts proves that tokens outside cannot change:

* It starts and ends where a non-space is followed by a space or a newline. No match of the pattern has white space
  after a non-space, so a match ends there whatever stands on either side, and merges never cross a match.
* It lies inside one long run of ASCII letters, hence inside one match, and each of its two edges joins a pair of
  tokens whose bytes encode to just that pair. A sequence of tokens is the BPE of its bytes if each neighbouring pair
  is the BPE of the pair's bytes (this needs ranks that merges can reach; the tests check the file's).

If neither comes about, the window ends as the whole node. Each document is a row of its own and needs no shuffle.

Null and empty texts encode to no ids. Repeated rows each get their own result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import slices

LEAF = 4096
WINDOW = 64
SAFE = re.compile(r"\S[ \n]")
LETTERS = re.compile(rb"[A-Za-z]+")


class Vocabulary:
    """Ranks of a tiktoken file with the pattern that splits text before merges."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token

    def leaf(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(text)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of bytes that lie inside one match."""
        return self.coder._core_bpe.encode_single_piece(piece)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def encode(vocab: Vocabulary, text: str, leaf: int = LEAF, window: int = WINDOW) -> list[int]:
    """The ids of ``text``, the same as of the whole text at once."""
    return _node(vocab, text, 0, len(text), max(leaf, 1), max(window, 1))


def _node(vocab: Vocabulary, text: str, a: int, b: int, leaf: int, window: int) -> list[int]:
    if b - a <= leaf:
        return vocab.leaf(text[a:b])
    m = (a + b) // 2
    return _join(vocab, text, a, m, b, _node(vocab, text, a, m, leaf, window), _node(vocab, text, m, b, leaf, window), window)


def _join(vocab: Vocabulary, text: str, a: int, m: int, b: int, left: list[int], right: list[int], window: int) -> list[int]:
    reach = window
    start = end = None
    while start is None or end is None:
        if start is None:
            low = max(a, m - reach)
            for found in SAFE.finditer(text, low, m):
                start = found.end() - 1
            if start is None and low == a:
                start = a
        if end is None:
            high = min(b, m + reach)
            # The boundary itself may be the safe place, so one code point before it is read too.
            found = SAFE.search(text, m - 1, high)
            if found:
                end = found.end() - 1
            elif high == b:
                end = b
        if (start is None or end is None) and (joined := _inside_letters(vocab, left, right, reach)) is not None:
            return joined
        reach *= 2
    kept_left = _tokens_from_end(vocab, left, len(text[start:m].encode()))
    kept_right = _tokens_from_start(vocab, right, len(text[m:end].encode()))
    return left[: len(left) - kept_left] + vocab.leaf(text[start:end]) + right[kept_right:]


def _tokens_from_end(vocab: Vocabulary, tokens: list[int], size: int) -> int:
    n = 0
    while size > 0:
        n += 1
        size -= len(vocab.bytes_of[tokens[-n]])
    return n


def _tokens_from_start(vocab: Vocabulary, tokens: list[int], size: int) -> int:
    n = 0
    while size > 0:
        size -= len(vocab.bytes_of[tokens[n]])
        n += 1
    return n


def _inside_letters(vocab: Vocabulary, left: list[int], right: list[int], reach: int) -> list[int] | None:
    """The join if ``reach`` tokens on either side and what is next to them are letters and both edges hold, else None."""
    if len(left) < reach + 4 or len(right) < reach + 2:
        return None
    out, bytes_of = len(left) - reach, vocab.bytes_of
    # Three tokens more on the left: a contraction such as 'll could end its match up to two letters before the window.
    if not LETTERS.fullmatch(b"".join(bytes_of[t] for t in left[out - 4 :] + right[: reach + 1])):
        return None
    middle = vocab.merged(b"".join(bytes_of[t] for t in left[out:] + right[:reach]))
    for pair in ((left[out - 1], middle[0]), (middle[-1], right[reach])):
        if vocab.merged(bytes_of[pair[0]] + bytes_of[pair[1]]) != [*pair]:
            return None
    return left[:out] + middle + right[reach:]


def decode(vocab: Vocabulary, ids: list[int], leaf: int = LEAF) -> bytes:
    """The bytes of ids; halves are decoded and concatenated up the tree."""
    if len(ids) <= leaf:
        return b"".join(map(vocab.bytes_of.__getitem__, ids))
    m = len(ids) // 2
    return decode(vocab, ids[:m], leaf) + decode(vocab, ids[m:], leaf)


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if out.itemsize != 4:
        raise RuntimeError("unsigned int isn't 4 bytes here")
    if array("H", [1]).tobytes() != b"\x01\x00":
        out.byteswap()
    return out.tobytes()


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF, max_bytes: int = 4 << 20) -> DataFrame:
    """Per row: ``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (binary, from the ids); a task holds ids of ``max_bytes`` of text."""
    keys = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([keys.schema["doc_id"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for part in slices(batches, "text", max_bytes):
            ids, back = [], []
            for text in part.column("text"):
                found = encode(vocab, text.as_py(), leaf)
                ids.append(packed(found))
                back.append(decode(vocab, found))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(back, pa.binary())], ["doc_id", "ids", "decoded"])

    return keys.mapInArrow(coded, schema)


def token_digests(coded: DataFrame, *also: str) -> DataFrame:
    """Counts and digests of what :func:`encode_documents` returns, and columns of it that ``also`` names."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *also,
    )
