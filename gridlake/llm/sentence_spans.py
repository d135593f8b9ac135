"""Substring dedup by sliding spans of sentences.

A span starts or ends at each sentence and takes the fewest sentences that are at least ``SENTENCES`` and hold at least
``WORDS`` words, so that short stock phrases alone never count and a passage is covered to its last sentence. Sentences end at ``.``, ``!`` or ``?`` before white
space and at line ends; one of over ``LONG`` words is cut where its words' checksums say so, so that equal passages
are cut alike wherever they stand. Spans are compared by the 128-bit hash of their words, lower-cased and joined by
single blanks, so that among 10^13 spans a chance match has a probability of about 10^-13.

All spans of all documents are counted by half of their hash, with partial counts before the shuffle, in turns of some 50
million. A bitmap of the repeated halves, which is broadcast, leaves most other spans behind where they are, and a turn's
spans are deleted. Each repeated span's first place (least ``doc_id``, then sentence) is a grouped minimum, and sentences that
any later place covers are removed from their documents. A hot passage is therefore one row before it is joined, and its join
can be split. What is to be removed, as ranges of sentences, is broadcast if these and the documents they repeat are at most
``MAX_BROADCAST``; then no text moves. Else texts of documents that lose something are joined to it by a shuffle; a bitmap
tells most others, whose texts stay where they are.

Null and empty texts have no sentences. Rows alike in id and text are one document and get equal results: what one of
them keeps, all keep. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import in_turns, kept, slices, written

SENTENCES, WORDS, LONG, PIECE = 2, 20, 32, 4
MAX_BROADCAST = 2_000_000
#: Words of 64 bits that tell which documents lose something, or which spans of a turn repeat; about 40 MB as a broadcast table.
MAX_WORDS = 1 << 20
#: Characters of text whose spans are counted in a turn: some 50 million spans, so that the bitmap of those that repeat isn't full.
TURN = 1 << 30
CUT = re.compile(r"(?<=[.!?])\s+|\n\s*")
WORD = re.compile(r"\S+")


def sentences(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end with the white space after it, words in lower case, number of words) of each sentence."""
    out: list[tuple[int, int, str, int]] = []
    at = 0
    for m in CUT.finditer(text):
        _add(out, text, at, m.start(), m.end())
        at = m.end()
    _add(out, text, at, len(text), len(text))
    return out


def _add(out: list[tuple[int, int, str, int]], text: str, start: int, stop: int, end: int) -> None:
    words = text[start:stop].split()
    if len(words) <= LONG:
        if words:
            out.append((start, end, " ".join(words).lower(), len(words)))
        return
    held: list[str] = []
    begin = start
    for m in WORD.finditer(text, start, stop):
        held.append(m[0].lower())
        if len(held) >= PIECE and zlib.crc32(held[-1].encode("utf-8", "replace")) % PIECE == 0:
            out.append((begin, m.end(), " ".join(held), len(held)))
            begin, held = m.end(), []
    if held:
        out.append((begin, end, " ".join(held), len(held)))


def spans(text: str, least: int = SENTENCES, words: int = WORDS) -> list[tuple[int, int, int, int]]:
    """(first sentence, one past the last, both halves of the hash) of the shortest spans that start and that end at each sentence."""
    found = sentences(text)
    runs = set()
    stop = count = 0
    for i in range(len(found)):
        while stop < len(found) and (stop - i < least or count < words):
            count += found[stop][3]
            stop += 1
        if stop - i < least or count < words:
            break
        runs.add((i, stop))
        count -= found[i][3]
    first = count = 0
    for stop in range(1, len(found) + 1):
        count += found[stop - 1][3]
        while stop - first > least and count - found[first][3] >= words:
            count -= found[first][3]
            first += 1
        if stop - first >= least and count >= words:
            runs.add((first, stop))
    out = []
    for i, stop in sorted(runs):
        run = " ".join([s[2] for s in found[i:stop]]).encode("utf-8", "replace")
        high, low = divmod(xxhash.xxh3_128_intdigest(run), 1 << 64)
        out.append((i, stop, high - (1 << 63), low - (1 << 63)))
    return out


def span_table(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """Rows (doc_id, doc_key, first, stop, high, low) of documents given as (doc_id, doc_key, text)."""
    kinds = [("first", T.IntegerType()), ("stop", T.IntegerType()), ("high", T.LongType()), ("low", T.LongType())]
    schema = T.StructType([docs.schema["doc_id"], docs.schema["doc_key"], *[T.StructField(*x) for x in kinds]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows, owner = [], []
            for i, text in enumerate(part.column("text")):
                found = spans(text.as_py() or "", least, words)
                rows += found
                owner += [i] * len(found)
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            whose = pa.array(owner, pa.int32())
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(whose), part.column("doc_key").take(whose), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], schema.names)

    return docs.mapInArrow(cut, schema)


def may_be_in(rows: DataFrame, columns: list[str], keys: DataFrame, most: int = MAX_WORDS) -> DataFrame:
    """``rows`` with a column ``_may``: whether the values of ``columns`` may be a row of ``keys``, which has as many columns. It is true for all that are.

    The keys set bits of a bitmap, 16 to 32 bits for each, in at most ``most`` words of 64, which is broadcast. About one in 16 of the
    other rows, or more where the bitmap is full, shares a bit.
    """
    words = min(most, 1 << (keys.count() // 4).bit_length())
    at = lambda c: F.pmod(F.xxhash64(*c), F.lit(64 * words))
    bits = keys.select(at(keys.columns).alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(_at & 63 as int)))").alias("_bits"))
    marked = rows.withColumn("_at", at(columns)).join(F.broadcast(bits), F.shiftright("_at", 6) == F.col("_word"), "left")
    return marked.select(*rows.columns, F.coalesce(F.expr("(shiftright(_bits, cast(_at & 63 as int)) & 1) = 1"), F.lit(False)).alias("_may"))


def likely_repeated(table: DataFrame, most: int = MAX_WORDS) -> DataFrame:
    """All spans that share half of their hash with another one, and a few others. Only halves of hashes are shuffled, to count them."""
    halves = written(table.groupBy("high").count().where("count > 1").select("high"), "repeated-keys")
    return may_be_in(table, ["high"], halves, most).where("_may").drop("_may")


def repeated_spans(docs: DataFrame, least: int = SENTENCES, words: int = WORDS, turn: int = TURN) -> DataFrame:
    """``likely_repeated`` of all spans of documents, which are dealt by their hashes into one turn for each ``turn`` characters of text."""
    turns = 1 + (docs.agg(F.sum(F.length("text"))).collect()[0][0] or 0) // turn
    tables = in_turns(span_table(docs, least, words), F.col("high"), turns, "spans")
    return reduce(DataFrame.unionByName, [kept(docs.sparkSession, partial(likely_repeated, x), "repeated-spans") for x in tables])


def later_places(places: DataFrame) -> DataFrame:
    """The places of repeated spans that aren't their first ones, and the document of the first. Spans that don't repeat are first places of their own."""
    key = ["high", "low"]
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key", "first")
    # Written, so that both sides of the join are plain exchanges and Spark can split a hot span's partition.
    first = written(places.groupBy(*key).agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-places")
    return places.join(first, key).where(place != F.col("origin")).select("doc_id", "doc_key", "first", "stop", F.col("origin.doc_id").alias("origin_id"))


def removals(places: DataFrame) -> DataFrame:
    """Per document that loses something: ``gone``, ranges of sentences (first, stop) that don't touch, and ``repeats_of``, from ``later_places``.

    A document's spans in order of their starts are in order of their ends too, as each is the shortest from its start or to its
    end. So a range begins where a span starts after the end of the one before.
    """
    both = F.shiftleft(F.col("first").cast("long"), 32) + F.col("stop")
    gathered = places.groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set(both)).alias("_all"), F.sort_array(F.collect_set("origin_id")).alias("repeats_of"))
    starts = F.expr("filter(_all, (x, i) -> i = 0 or shiftright(x, 32) > (_all[i - 1] & 4294967295))")
    stops = F.expr("filter(_all, (x, i) -> i = size(_all) - 1 or shiftright(_all[i + 1], 32) > (x & 4294967295))")
    ranges = F.zip_with(starts, stops, lambda a, b: F.struct(F.shiftright(a, 32).cast("int").alias("first"), b.bitwiseAND(F.lit(4294967295)).cast("int").alias("stop")))
    return gathered.select("doc_id", "doc_key", ranges.alias("gone"), "repeats_of")


def parted(docs: DataFrame, gone: DataFrame, most: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """Documents that ``gone`` (_id, _key) may hold, and those that it surely doesn't."""
    marked = may_be_in(docs, ["doc_id", "doc_key"], gone.select("_id", "_key"), most)
    return marked.where("_may").drop("_may"), marked.where("NOT _may").drop("_may")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = SENTENCES, words: int = WORDS, max_broadcast: int = MAX_BROADCAST, turn: int = TURN) -> DataFrame:
    """Per row: ``doc_id``, ``text`` without repeated sentences, ``n_sentences``, ``removed`` (sentence numbers), ``repeats_of``."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("doc_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def repeats() -> DataFrame:
        return removals(later_places(repeated_spans(keyed, least, words, turn)))

    gone = kept(docs.sparkSession, repeats, "removed").withColumnsRenamed({"doc_id": "_id", "doc_key": "_key"})
    size = gone.agg(F.sum(F.size("gone") + F.size("repeats_of"))).collect()[0][0] or 0
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_key") == F.col("_key"))
    joined = lambda rows, side: rows.join(side, same, "left").select("doc_id", "text", "gone", "repeats_of")
    if size <= max_broadcast:
        both = joined(keyed, F.broadcast(gone))
    else:
        moved, still = parted(keyed, gone)
        both = joined(moved, gone).unionByName(still.select("doc_id", "text", *[F.lit(None).cast(gone.schema[c].dataType).alias(c) for c in ("gone", "repeats_of")]))
    schema = T.StructType([both.schema["doc_id"], both.schema["text"], T.StructField("n_sentences", T.LongType()), T.StructField("removed", T.ArrayType(T.IntegerType())), both.schema["repeats_of"]])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts, counts, lost = [], [], []
            for text, gone in zip(part.column("text").to_pylist(), part.column("gone").to_pylist(), strict=True):
                found = sentences(text)
                out = sorted({i for span in gone or [] for i in range(span["first"], span["stop"])})
                if out:
                    drop, kept, at = set(out), [], 0
                    for i, (start, end, _, _) in enumerate(found):
                        if i in drop:
                            kept.append(text[at:start])
                            at = end
                    text = "".join([*kept, text[at:]])
                texts.append(text)
                counts.append(len(found))
                lost.append(out)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, part.column("text").type), pa.array(counts, pa.int64()), pa.array(lost, pa.list_(pa.int32())), part.column("repeats_of")], schema.names)

    return both.mapInArrow(cleaned, schema)


def dedup_report(docs: DataFrame) -> DataFrame:
    """Counts, removed sentences, documents that they were first in, and a digest of the text that stays."""
    return deduplicated(docs).select(
        "doc_id",
        "n_sentences",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"),
        F.coalesce("repeats_of", F.array().cast("array<long>")).alias("repeats_of"),
        F.sha2("text", 256).alias("kept_sha256"),
    )
