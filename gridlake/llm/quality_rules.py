"""Quality rules as a short-circuit cascade of column expressions; no Python runs on the executors.

A rule is a condition that rejects a document. The cascade is one ``CASE WHEN``, which stops at the first rule that
holds, so a rule's expressions are computed only for documents that all rules before it let through. Before it is
built, every rule runs on a sample: the ``sample_rows`` distinct texts with the least hash, of each at most ``SAMPLE_CHARS``
code points (documented bounds, as the sample sets the order alone and never a verdict). The share that it rejects is
the rule's selectivity, its seconds beyond what any job takes its cost, and rules go by rejection per cost, best first.
Verdicts are the same in any order.

Null and empty texts have no words and fail the base rule. Repeated rows each get their own verdict. Other columns pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = r"[^#*$%&|<>]+"
SAMPLE_ROWS, SAMPLE_CHARS, COPIES = 400, 20_000, 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it (also inside other lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def char_count(text: Column, others: str) -> Column:
    """Code points left after runs that match ``others`` go."""
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words in windows of ``width`` words found twice or more in the text, the first place included.

    Windows are compared as 64-bit hashes. Texts whose windows all differ, nearly all of them, stop at one hash set;
    others sort (hash, place) pairs and add up what each repeated window covers beyond the one before it.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    none = F.lit(0).cast("long")
    return F.when(F.size(words) < width, none).otherwise(let(hashes, lambda h: let(_windows(h, width), lambda w: _covered(w, width))))


def _windows(hashes: Column, width: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - width), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))


def _covered(windows: Column, width: int) -> Column:
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda a, x, k: F.coalesce(F.get(a, k)["h"] == x["h"], F.lit(False))
    repeated = lambda a: F.transform(F.filter(a, lambda x, k: same(a, x, k - 1) | same(a, x, k + 1)), lambda x: x["i"])
    total = F.aggregate(
        F.sort_array(let(ordered, repeated)),
        F.struct(F.lit(0).alias("n"), F.lit(-1_000_000_000).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(total).cast("long")


def duplicate_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the text column and gives the condition under which a document goes."""

    name: str
    rejects: Callable[[Column], Column]


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


BASE_RULES = [
    Rule("few_words", lambda t: F.size(words_of(t)) < 10),
    Rule("repeats_itself", lambda t: let(words_of(t), lambda w: 100 * repeat_words(w) > 20 * F.size(w))),
]
#: Thresholds are the operator's parameters: shares of words, of letters and of lines.
METHOD_RULES = [
    Rule("symbols", lambda t: char_count(t, SYMBOLS) > 0.1 * F.size(words_of(t))),
    Rule("shouting", lambda t: share(char_count(t, r"[^\p{Lu}]+"), char_count(t, r"[^\p{L}]+")) > 0.3),
    Rule("repeated_lines", lambda t: let(lines_of(t), lambda x: share(duplicate_lines(x), F.size(x)) > 0.3)),
    Rule("not_letters", lambda t: share(char_count(t, r"[^\p{L}]+"), char_count(t, SPACE)) < 0.6),
    Rule("word_length", lambda t: share(char_count(t, SPACE), F.size(words_of(t))) > 20.0),
]


def sampled(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> DataFrame:
    """At most ``sample_rows`` distinct texts, those with the least hash, from all of the table; of a longer text the first ``max_chars`` code points."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    drawn = docs.select(text.alias("text"), F.xxhash64(text, F.lit(7)).alias("draw"))
    least = [r["draw"] for r in drawn.select("draw").distinct().orderBy("draw").limit(sample_rows).collect()]
    return drawn.where(F.col("draw").isin(least)).groupBy("draw").agg(F.min(F.substring("text", 1, max_chars)).alias("text")).orderBy("draw").select("text")


def cascade_order(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS, rated: Callable[[DataFrame, list[Rule]], list[Rating]] | None = None) -> list[Rule]:
    """Rules by rejection per cost on a sample of the documents, best first; equal ones by name."""
    if len(rules) < 2:
        return rules
    taken = sampled(docs, text_col, sample_rows).collect()
    if not taken:
        return rules
    # From an Arrow table: rows are pickled by Python workers, which then stay in the executors' memory while the rules run.
    sample = docs.sparkSession.createDataFrame(pa.table({"text": pa.array([r["text"] for r in taken], pa.string())})).coalesce(1)
    found = (ratings if rated is None else rated)(sample, rules)
    return [r.rule for r in sorted(found, key=lambda r: (-r.rejected / r.seconds, r.rule.name))]


@dataclass(frozen=True)
class Rating:
    """A rule with the share of the sample that it rejects and its seconds over the sample."""

    rule: Rule
    rejected: float
    seconds: float


def ratings(sample: DataFrame, rules: list[Rule], copies: int = COPIES, rounds: int = 2) -> list[Rating]:
    """Each rule's rejection and cost. A job over the sample and one over ``copies`` of it differ by the rule's own work:
    planning, code generation and scheduling, which a cluster pays once, cancel out. The least of some rounds counts."""
    rows = sample.count()
    many = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select("text")

    def seconds(data: DataFrame, rule: Rule) -> tuple[float, float]:
        asked = data.select(F.avg(F.coalesce(rule.rejects(F.col("text")), F.lit(False)).cast("double")))
        began = time.perf_counter()
        share = asked.collect()[0][0] or 0.0
        return time.perf_counter() - began, share

    out = []
    for rule in rules:
        short, share = seconds(sample, rule)
        short = min([short] + [seconds(sample, rule)[0] for _ in range(rounds - 1)])
        long = min(seconds(many, rule)[0] for _ in range(rounds))
        out.append(Rating(rule, share + 0.5 / rows, max(long - short, 1e-3) / (copies - 1)))
    return out


def verdict(text: Column, rules: list[Rule]) -> Column:
    """True where no rule rejects; rules after the first that does aren't computed."""
    out = F
    for rule in rules:
        out = out.when(F.coalesce(rule.rejects(text), F.lit(False)), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def keep_good(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    ordered = cascade_order(docs, BASE_RULES + METHOD_RULES if rules is None else rules, text_col, sample_rows)
    return docs.where(verdict(F.coalesce(F.col(text_col), F.lit("")), ordered))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts, base verdict and the cascade's verdict of every document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = cascade_order(docs, METHOD_RULES if rules is None else rules, "text", sample_rows)
    counted = docs.withColumn("words", words_of(F.col("text"))).select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        char_count(F.col("text"), SPACE).alias("word_chars"),
        char_count(F.col("text"), SYMBOLS).alias("n_symbols"),
        let(lines_of(F.col("text")), duplicate_lines).alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(F.col("text"), ordered)).drop("text")
