"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base kinds are found by pattern. Other runs of at least ``MIN_RUN`` key characters that no base span touches are
candidates if they can hold ``MIN_BITS`` bits in their encoding: the smallest of hexadecimal, base 32, the classes of
letters and digits that occur, and base 64 in both forms. A run that fits none is split at its separators. A UUID is
tested without its dashes.

The battery measures how far a candidate is from "characters are drawn evenly from that alphabet": chi-squared on the
shares of lower case, upper case and digits and on pools of characters within each (letters stand in the order of their
frequency in the corpus), runs tests on these classes and on vowels and consonants, lag-1 serial correlation, and how
well neighbouring letters go together in the corpus (the log frequency of their pair, whose mean and variance under even
draws are exact). Fisher's method combines the p-values to a distance, -log10 p.

A secret is what is nearer to even than people write. The null hypothesis is therefore "written by people", and its
distribution comes from the corpus: every document with enough words gives one name glued from consecutive words in one
of ``STYLES`` styles, and the square root of the names' distance is fitted by encoding as a line over the square root of
the length, with a normal spread (names from texts that are themselves secrets are clipped off). A candidate's p-value is the chance that a written name is as near to even; longer
names are farther away, so that length decides how sure a find can be. A weighted Benjamini-Hochberg step over the
distinct candidates of all documents, with weights in proportion to length (up to ``WEIGHED`` characters), makes those
secrets of which at most ``FDR`` are expected to be written by people. Counts for it are aggregates and a histogram of
``BINS`` rows; the threshold is a bin's edge, on the safe side. How many secrets are found grows with their length and
with their share among candidates.

Null and empty texts have no spans. Repeated rows each get theirs. Other columns pass through :func:`with_spans`,
whatever their names; ``base`` and ``spans`` get underscores after them where a column has that name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import free_names, slices, written
from .suffixes import text_bytes

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]
MIN_RUN, MIN_BITS, FDR, BINS, WEIGHED = 20, 80.0, 0.05, 2000, 64
RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_RUN},}}")
#: Key characters become x and all other bytes become blanks, so that a long run is one substring search away.
RUN_MAP = bytes(0x78 if re.match(rb"[A-Za-z0-9+/_-]", bytes([b])) else 0x20 for b in range(256))

UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets, and the classes of which a run has to have some.
ENCODINGS = [
    (DIGITS + "abcdef", "lower digit"),
    (DIGITS + "ABCDEF", "upper digit"),
    (LOWER, "lower"),
    (UPPER, "upper"),
    (UPPER + "234567", "upper digit"),
    (LOWER + DIGITS, "lower digit"),
    (UPPER + DIGITS, "upper digit"),
    (UPPER + LOWER, "upper lower"),
    (UPPER + LOWER + DIGITS, "upper lower digit"),
    (UPPER + LOWER + DIGITS + "+/", "upper lower digit"),
    (UPPER + LOWER + DIGITS + "-_", "upper lower digit"),
]
CLASSES = {"lower": set(LOWER), "upper": set(UPPER), "digit": set(DIGITS)}
VOWELS = set("aeiouyAEIOUY")
#: Names glued from a document's words: lengths and styles, of which each document has one.
LENGTHS, STYLES = (20, 24, 28, 32, 40, 48, 64, 96), 8
#: Line and spread of written names where the corpus has none, and how many names they count as.
WRITTEN, WRITTEN_COUNT = (-0.6, 0.53, 0.5), 50
#: Fits of the line, below which so many spreads names are left out of the next one, and how much wider than there names vary elsewhere.
FITS, CLIP, WIDER = 3, 2.5, 1.25

#: The number of a letter, in either case; 26 for other bytes.
LETTER = np.array([LOWER.find(chr(b).lower()) if chr(b) in LOWER + UPPER else 26 for b in range(256)])


@dataclass(frozen=True)
class Usage:
    """How the corpus uses letters: a to z in falling order of frequency, and how often one follows another (26 x 26)."""

    letters: str = LOWER
    pairs: tuple[int, ...] = (0,) * 676


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())])
TESTED = [T.StructField("encoding", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("distance", T.DoubleType())]
CANDIDATE = T.StructType([*SPAN.fields, *TESTED, T.StructField("key", T.LongType())])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), by start and kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"x" * MIN_RUN in text.encode("utf-8", "replace").translate(RUN_MAP):
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(out)


def encoding_of(run: str) -> int | None:
    """The number of the smallest encoding that holds all characters and whose classes all occur."""
    seen = set(run)
    for i, (alphabet, classes) in enumerate(ENCODINGS):
        if seen <= set(alphabet) and all(seen & CLASSES[c] for c in classes.split()):
            return i
    return None


def tails(z: np.ndarray) -> np.ndarray:
    """P(a standard normal exceeds z)."""
    return np.array([math.erfc(x / math.sqrt(2)) / 2 for x in z.tolist()])


def chi2_tails(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(chi-squared > x) by the cube-root normal approximation; 1 without degrees of freedom."""
    some = np.maximum(df, 1)
    return np.where(df > 0, tails(((x / some) ** (1 / 3) - (1 - 2 / (9 * some))) / np.sqrt(2 / (9 * some))), 1.0)


def class_of(c: str) -> int:
    return 0 if c in LOWER else 1 if c in UPPER else 2 if c in DIGITS else 3


@lru_cache(maxsize=64)
def characters(encoding: int, letters: str) -> dict[str, np.ndarray]:
    """Of each byte: its place in the alphabet, its class, its class by sound, and its pool among two and four; and shares of these."""
    alphabet = ENCODINGS[encoding][0]
    at = {k: np.zeros(256, np.int64) for k in ("place", "class", "sound", "pool2", "pool4")}
    for kind in range(4):
        own = [c for c in alphabet if class_of(c) == kind]
        if kind < 2:
            own.sort(key=lambda c: letters.index(c.lower()))
        for i, c in enumerate(own):
            b = ord(c)
            at["place"][b], at["class"][b] = alphabet.index(c), kind
            at["sound"][b] = 0 if c in VOWELS else 1 if kind < 2 else 2
            at["pool2"][b], at["pool4"][b] = 2 * kind + i * 2 // len(own), 4 * kind + i * 4 // len(own)
    used = np.array([ord(c) for c in alphabet])
    sizes = {"class": 4, "sound": 3, "pool2": 8, "pool4": 16}
    return at | {f"{k} share": np.bincount(at[k][used], minlength=n) / len(alphabet) for k, n in sizes.items()}


@lru_cache(maxsize=64)
def pair_scores(encoding: int, pairs: tuple[int, ...]) -> tuple[np.ndarray, float, float, float]:
    """Log frequency of each pair of bytes that are letters (0 for others), with its mean, variance and the covariance of neighbours under even draws."""
    alphabet = ENCODINGS[encoding][0]
    code = LETTER[[ord(c) for c in alphabet]]
    own = np.unique(code[code < 26])
    counts = np.array(pairs, np.float64).reshape(26, 26)[np.ix_(own, own)]
    score = np.zeros((27, 27))
    score[np.ix_(own, own)] = np.log((counts + 1) * counts.size / (counts.sum() + counts.size))
    drawn = score[np.ix_(code, code)]
    mean = drawn.mean()
    shared = (drawn.mean(axis=0) * drawn.mean(axis=1)).mean() - mean * mean
    return score, float(mean), float(drawn.var()), float(shared)


def battery(runs: list[str], encoding: int, usage: Usage = Usage()) -> np.ndarray:
    """-log10 of the combined p-values of "evenly drawn from the alphabet"."""
    if not runs:
        return np.zeros(0)
    of, rows = characters(encoding, usage.letters), len(runs)
    n = np.array([len(x) for x in runs], np.float64)
    flat = np.frombuffer("".join(runs).encode(), np.uint8)
    row = np.repeat(np.arange(rows), n.astype(np.int64))
    inner = row[1:] == row[:-1]
    counted = lambda k, m: np.bincount(row * m + of[k][flat], minlength=rows * m).reshape(rows, m)
    share, own = of["class share"], counted("class", 4)
    there = share > 0
    expected = n[:, None] * share[there]
    tests = [chi2_tails(((own[:, there] - expected) ** 2 / expected).sum(axis=1), np.full(rows, there.sum() - 1))]
    within, free = np.zeros(rows), np.zeros(rows)
    for k, m, least, most in (("pool2", 2, 10, 20), ("pool4", 4, 20, math.inf)):
        seen = counted(k, 4 * m)
        for kind in range(3):
            if share[kind]:
                part = of[f"{k} share"][kind * m : kind * m + m] / share[kind]
                fits = (own[:, kind] >= least) & (own[:, kind] < most)
                wanted = np.maximum(own[:, kind], 1)[:, None] * part
                within += np.where(fits, ((seen[:, kind * m : kind * m + m] - wanted) ** 2 / wanted).sum(axis=1), 0)
                free += fits * (m - 1)
    tests.append(chi2_tails(within, free))
    for k in ("class", "sound"):
        p = of[f"{k} share"]
        alike, thrice = (p**2).sum(), (p**3).sum()
        if alike < 1 - 1e-9:
            kind = of[k][flat]
            same = np.bincount(row[1:][inner & (kind[1:] == kind[:-1])], minlength=rows)
            spread = np.sqrt((n - 1) * alike * (1 - alike) + 2 * (n - 2) * (thrice - alike**2))
            tests.append(2 * tails(np.abs(same - (n - 1) * alike) / spread))
    size = len(ENCODINGS[encoding][0])
    place = of["place"][flat] - (size - 1) / 2
    lagged = np.bincount(row[1:][inner], (place[1:] * place[:-1])[inner], minlength=rows) / ((size * size - 1) / 12)
    tests.append(2 * tails(np.abs(lagged) / np.sqrt(n - 1)))
    score, mean, variance, shared = pair_scores(encoding, usage.pairs)
    if variance > 1e-9:
        letter = LETTER[flat]
        together = np.bincount(row[1:][inner], score[letter[:-1], letter[1:]][inner], minlength=rows)
        tests.append(tails((together - (n - 1) * mean) / np.sqrt((n - 1) * variance + 2 * (n - 2) * shared)))
    fisher = -2 * np.log(np.maximum(tests, 1e-300)).sum(axis=0)
    return -np.log10(np.maximum(chi2_tails(fisher, np.full(rows, 2 * len(tests))), 1e-300))


def pieces(run: str, start: int = 0) -> Iterator[tuple[int, int, str, int]]:
    """(start, end, what is tested, encoding) of the run if it fits an encoding, else of its pieces between separators of one encoding."""
    if len(run) < MIN_RUN:
        return
    if UUID.fullmatch(run):
        yield start, start + len(run), run.replace("-", "").lower(), 0
        return
    if (encoding := encoding_of(run)) is not None:
        yield start, start + len(run), run, encoding
        return
    splits = [[(start + m.start(), m[0]) for m in re.finditer(f"[^{seps}]+", run)] for seps in ("+/", "_-") if set(seps) & set(run)]
    if splits:
        for at, piece in max(splits, key=lambda s: max((len(x) for _, x in s if encoding_of(x) is not None), default=0)):
            yield from pieces(piece, at)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int]]:
    """(start, end, what is tested, encoding) of runs that fit an encoding, can hold enough bits and touch no base span."""
    if b"x" * MIN_RUN not in text.encode("utf-8", "replace").translate(RUN_MAP):
        return []
    # Base spans by their start, with the greatest end so far: runs come in order too, so both are walked through once.
    out, k, reach = [], 0, 0
    for m in RUN.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach, k = max(reach, taken[k][2]), k + 1
        if reach <= m.start():
            out += [x for x in pieces(m[0], m.start()) if len(x[2]) * math.log2(len(ENCODINGS[x[3]][0])) >= MIN_BITS]
    return out


def glued_name(text: str) -> str:
    """A name of consecutive words of the text, as people write names; its place, length and style depend on the text alone."""
    draw = zlib.crc32(text.encode("utf-8", "replace"))
    size, style = LENGTHS[draw % len(LENGTHS)], draw // 8 % STYLES
    start = draw // 64 % max(1, len(text) - 8 * size)
    words = re.findall("[A-Za-z]+", text[start : start + 8 * size])[1:-1]
    digit = str(draw // 4096 % 10)
    if style == 0:
        name = "".join(words).lower()
    elif style == 1:
        name = "".join(w.capitalize() for w in words)
    elif style == 2:
        name = "".join(w.capitalize() for w in words)[: size - 2] + digit + "2"
    elif style == 3:
        name = "".join(f"{w.lower()}{i % 10}" for i, w in enumerate(words, 1))
    elif style == 4:
        name = "".join(words).upper()[: size - 2] + "1" + digit
    elif style == 7:
        # What a hexadecimal run has that is written and not drawn: letters as texts use them, and numbers that count on.
        name = "".join(re.sub("[^a-f]", "", w.lower()) + str(i % 10) for i, w in enumerate(words, 1))
    else:
        name = ("_" if style == 5 else "/").join(w.capitalize() if i % 2 else w.lower() for i, w in enumerate(words))[: size - 1] + digit
    return name[:size] if len(name) >= size else ""


def letter_usage(docs: DataFrame, text_col: str) -> Usage:
    """Letters and pairs of letters in all texts; each task counts first, and 702 numbers reach the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27 * 27 + 27, np.int64)
        for part in slices(batches, text_col, 1 << 20):
            data, at = text_bytes(part.column(text_col).fill_null(""))
            letter = LETTER[data]
            follows = letter[:-1] * 27 + letter[1:]
            # Where one text ends and the next begins nothing follows; 728 is a pair of no letters.
            ends = at[1:-1]
            follows[ends[(ends > 0) & (ends < len(data))] - 1] = 728
            total += np.bincount(follows, minlength=len(total)) + np.bincount(letter + 729, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "n"])

    counts = np.zeros(27 * 27 + 27, np.int64)
    for at, n in docs.select(text_col).mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        counts[at] = n
    alone = counts[729:]
    letters = "".join(sorted(LOWER, key=lambda c: (-alone[ord(c) - 97], c)))
    return Usage(letters, tuple(counts[:729].reshape(27, 27)[:26, :26].ravel().tolist()))


def _tested(docs: DataFrame, text_col: str, keep: list[str], names: list[str]) -> DataFrame:
    """The columns to keep, base spans, candidates and glued names under ``names``, written so that the scan runs once."""
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(names[0], T.ArrayType(SPAN)), T.StructField(names[1], T.ArrayType(CANDIDATE)), T.StructField(names[2], T.ArrayType(T.StructType(TESTED)))])
    usage = letter_usage(docs, text_col)

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([(f, pa.int32()) for f in ("start", "kind", "end")]))
        measured = [("encoding", pa.int32()), ("size", pa.int32()), ("distance", pa.float64())]
        found = pa.list_(pa.struct([(f, pa.int32()) for f in ("start", "kind", "end")] + measured + [("key", pa.int64())]))
        for part in slices(batches, text_col):
            base, more, drawn, by_encoding = [], [], [], {}
            for text in part.column(text_col):
                text = text.as_py() or ""
                own = base_spans(text)
                base.append([dict(zip(("start", "kind", "end"), x, strict=True)) for x in own])
                more.append([{"start": a, "kind": 3, "end": b, "encoding": e, "size": len(x), "key": xxhash.xxh64_intdigest(x.encode()) - (1 << 63), "run": x} for a, b, x, e in candidates(text, own)])
                name = glued_name(text)
                e = encoding_of(name) if name else None
                drawn.append([] if e is None else [{"encoding": e, "size": len(name), "run": name}])
                for x in more[-1] + drawn[-1]:
                    by_encoding.setdefault(x["encoding"], []).append(x)
            for e, some in by_encoding.items():
                for x, distance in zip(some, battery([x.pop("run") for x in some], e, usage).tolist(), strict=True):
                    x["distance"] = distance
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(base, spans), pa.array(more, found), pa.array(drawn, pa.list_(pa.struct(measured)))], schema.names)

    return written(docs.mapInArrow(tested, schema), "secrets")


def line_of(n: float, x: float, y: float, xx: float, xy: float, yy: float, before: tuple[float, float, float], count: float) -> tuple[float, float, float]:
    """Intercept, slope and spread of the least-squares line of so many points with these sums, mixed with a line that counts as ``count`` points."""
    varied = n * xx - x * x
    if n < 3 or varied < 1e-6 * n * n:
        return before
    slope = (n * xy - x * y) / varied
    start = (y - slope * x) / n
    spread = math.sqrt(max(1e-4, (yy - start * y - slope * xy) / n))
    return tuple((n * a + count * b) / (n + count) for a, b in zip((start, slope, spread), before, strict=True))


def written_names(drawn: DataFrame) -> list[tuple[float, float, float]]:
    """For each encoding the line of the square root of the distance of written names over the square root of their length, and its spread.

    Names glued from a document that is all secrets are no written names: those more than ``CLIP`` spreads below the line
    are left out of the next fit. What is left is one corpus' way to write, so spreads are ``WIDER`` for other ways.
    """
    x, y = F.sqrt("size"), F.sqrt("distance")
    lines: list[tuple[float, float, float]] = []
    for _ in range(FITS):
        near = F.lit(True)
        if lines:
            start, slope, spread = _of_encoding(lines, F.col("encoding"))
            near = y >= start + slope * x - CLIP * spread
        rows = drawn.where(near).groupBy("encoding").agg(*[F.sum(c).alias(k) for k, c in (("n", F.lit(1.0)), ("x", x), ("y", y), ("xx", x * x), ("xy", x * y), ("yy", y * y))]).collect()
        sums = {r["encoding"]: tuple(r)[1:] for r in rows}
        # An encoding in which no names are written has the mean line, and also varies as lines vary.
        own = [(s[0], line_of(*s, WRITTEN, 0.0)) for s in sums.values() if s[0] >= WRITTEN_COUNT]
        usual = WRITTEN
        if own:
            mean = lambda of: sum(n * of(line) for n, line in own) / sum(n for n, _ in own)
            start, slope = mean(lambda line: line[0]), mean(lambda line: line[1])
            apart = lambda line: (line[0] - start + (line[1] - slope) * 6.0) ** 2
            usual = (start, slope, math.sqrt(mean(lambda line: line[2] ** 2 + apart(line))))
        lines = [line_of(*sums.get(e, (0.0,) * 6), usual, WRITTEN_COUNT) for e in range(len(ENCODINGS))]
    return [(start, slope, spread * WIDER) for start, slope, spread in lines]


def _of_encoding(lines: list[tuple[float, float, float]], encoding: Column) -> list[Column]:
    return [F.get(F.array(*[F.lit(line[i]) for line in lines]), encoding) for i in range(3)]


def log_p(encoding: Column, size: Column, distance: Column, lines: list[tuple[float, float, float]]) -> Column:
    """log10 of (a bound from above of) the chance that a written name is as near to even (Sampford's bound of the normal tail)."""
    start, slope, spread = _of_encoding(lines, encoding)
    t = (start + slope * F.sqrt(size) - F.sqrt(distance)) / spread
    return F.when(t > 0, F.least(F.lit(0.0), F.log10(F.lit(4 / math.sqrt(2 * math.pi))) - t * t / (2 * math.log(10)) - F.log10(3 * t + F.sqrt(t * t + 8)))).otherwise(F.lit(0.0))


def _weight(size: Column, mean: float) -> Column:
    return F.least(F.lit(WEIGHED), size) / F.lit(mean)


def threshold(tested: DataFrame, fdr: float) -> tuple[float, float]:
    """Of distinct candidates (size, log_p): the mean of their weighed lengths, and the weighted log10 p-value up to which they are secrets."""
    m, mean = tested.agg(F.count("*"), F.avg(F.least(F.lit(WEIGHED), F.col("size")))).collect()[0]
    if not m:
        return 1.0, -math.inf
    step = 40.0 / BINS
    up = F.least(F.lit(0), F.greatest(F.lit(-BINS), F.ceil((F.col("log_p") - F.log10(_weight(F.col("size"), mean))) / step))).cast("int")
    below, cut = 0, -math.inf
    for edge, n in sorted((r["edge"], r["n"]) for r in tested.groupBy(up.alias("edge")).agg(F.count("*").alias("n")).collect()):
        below += n
        if edge < 0 and m * 10 ** (edge * step) <= fdr * below:
            cut = edge * step
    return mean, cut


def with_spans(docs: DataFrame, text_col: str = "text", fdr: float = FDR, keep: list[str] | None = None) -> DataFrame:
    """All columns (or those to keep) and ``base`` and ``spans``: arrays of (start, kind, end) by start, then kind; code points, end exclusive."""
    keep = docs.columns if keep is None else keep
    base, spans, found, drawn, each = free_names(docs.select(*keep), "base", "spans", "found", "drawn", "each")
    tested = _tested(docs, text_col, keep, [base, found, drawn])
    lines = written_names(tested.select(F.explode(drawn).alias(each)).select(f"{each}.*"))
    unlikely = lambda c: log_p(c["encoding"], c["size"], c["distance"], lines)
    # One row for each distinct candidate: a name that very many documents have counts once.
    distinct = tested.select(F.explode(found).alias(each)).groupBy(f"{each}.key").agg(F.max(f"{each}.size").alias("size"), F.max(unlikely(F.col(each))).alias("log_p"))
    mean, cut = threshold(distinct, fdr)
    kept = F.filter(found, lambda c: unlikely(c) - F.log10(_weight(c["size"], mean)) <= F.lit(cut))
    added = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return tested.select(*keep, F.col(base), F.array_sort(F.concat(base, added)).alias(spans))


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    found = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", fdr, ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def without(text: str, spans: list[tuple[int, int]], tag: str) -> str:
    """The text with ``tag`` in place of spans (by start); those that overlap become one tag."""
    out, at = [], 0
    for start, end in spans:
        if end > at:
            out += [text[at:start], tag] if start >= at else []
            at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text_col: str = "text", tag: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """The documents with ``tag`` in place of each secret; overlapping spans become one tag."""
    found = with_spans(docs, text_col, fdr)
    columns, spans = docs.columns, found.columns[-1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            texts = [t if not own else without(t, [(s["start"], s["end"]) for s in own], tag) for t, own in zip(part.column(text_col).to_pylist(), part.column(spans).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text_col else part.column(c) for c in columns], columns)

    return found.select(*columns, spans).mapInArrow(cut, docs.schema)
