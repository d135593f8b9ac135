"""Chat formatting by quotation linking; DataFrame operations only.

A line's quote level is the number of ``>`` it begins with. Consecutive lines of one level are a quoted passage; the
rest of a message, without lines that only announce a quote, is its own text. Passages and own texts are normalised
(lower case, single blanks) and hashed: a passage joins the message of its conversation that first said it, as a whole,
as a paragraph, or line by line (single lines of under ``MIN_LINE`` code points are too common to link on their own). A message replies to the origin of its outermost linked passage, the later one of
several; without one it replies to the turn before it.

Replies make a tree. ``position`` numbers a conversation's turns in reply order: a message that replies to an older one
than the turn before it opens a branch, which stands right after the message it replies to, before what followed there;
branches of one message stand by their first turns. Turns between branch points are one piece, pieces and branch ends
are a linked list, and the list is ranked by pointer doubling: as many rounds as the logarithm of the number of
branches in a conversation, however deep they nest.

Origins are grouped minima before any join, so no hot line meets all its copies. Running maxima and counts over turns
are taken in stretches of ``STRETCH`` turns and then over stretches, so no window holds a whole hot conversation.

Null texts count as empty. Repeated rows are one message of which each row gets the results; repeated (conversation,
turn) rows share replies and positions. Null conversations or turns have neither. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import kept, written

STRETCH = 512
MIN_LINE = 12
PREFIX = r"^((?:[ \t]?>)+)[ \t]?"
ANNOUNCES = r"(?i)\b(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$"


def level_of(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, PREFIX, 1), "[^>]", ""))


def bare(line: Column) -> Column:
    return F.regexp_replace(line, PREFIX, "")


def normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"[\s]+", " "))


def own_text(text: Column) -> Column:
    """The message without quoted lines and without lines that announce them."""
    lines = F.split(text, "\n")
    announces = lambda x, i: x.rlike(ANNOUNCES) & (level_of(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 0)
    kept = F.filter(lines, lambda x, i: (level_of(x) == 0) & ~announces(x, i))
    return F.when(text.rlike(r"(?m)^[ \t]?>"), F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")).otherwise(text)


def passages(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, key, passage, level, place, hash, whole): each quoted passage, and each of its lines, of messages."""
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]?>")).select("conv_id", "turn", "key", "text")
    # Repeated rows would put their lines between each other's.
    quoting = quoting.distinct()
    lines = quoting.select("conv_id", "turn", "key", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.select("conv_id", "turn", "key", "place", level_of(F.col("line")).alias("level"), bare(F.col("line")).alias("line"))
    message = Window.partitionBy("conv_id", "turn", "key").orderBy("place")
    changed = F.when(F.lag("level").over(message) == F.col("level"), 0).otherwise(1)
    runs = lines.withColumn("new", changed).withColumn("passage", F.sum("new").over(message)).where("level > 0")
    whole = runs.groupBy("conv_id", "turn", "key", "passage", "level").agg(
        F.min("place").alias("place"),
        normal(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n")).alias("said"),
        F.lit(True).alias("whole"),
    )
    single = runs.select("conv_id", "turn", "key", "passage", "level", "place", normal(F.col("line")).alias("said"), F.lit(False).alias("whole")).where(F.char_length("said") >= MIN_LINE)
    return whole.unionByName(single).where("said <> ''").withColumn("hash", F.xxhash64("said"))


def origins(messages: DataFrame) -> DataFrame:
    """(conv_id, hash, said, origin): the first turn of a conversation that says a text, a paragraph or a line."""
    own = F.col("own")
    units = F.array_distinct(F.transform(F.concat(F.array(own), F.split(own, r"\n\s*\n"), F.split(own, "\n")), normal))
    said = messages.select("conv_id", "turn", F.explode(units).alias("said")).where("said <> ''")
    return said.groupBy("conv_id", F.xxhash64("said").alias("hash"), "said").agg(F.min("turn").alias("origin"))


def quote_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, key, passage, level, place, origin): each passage with the turn that it quotes, if one is found."""
    units = passages(messages)
    known = origins(messages).withColumnsRenamed({"conv_id": "_conv", "said": "_said", "hash": "_hash"})
    same = (F.col("conv_id") == F.col("_conv")) & (F.col("hash") == F.col("_hash")) & (F.col("said") == F.col("_said")) & (F.col("origin") < F.col("turn"))
    found = units.join(known, same, "left")
    # The whole passage decides if it is found; else the line of the latest origin.
    best = F.max(F.when(F.col("origin").isNotNull(), F.struct("whole", "origin")))["origin"]
    return found.groupBy("conv_id", "turn", "key", "passage", "level").agg(F.min("place").alias("place"), best.alias("origin"))


def running(rows: DataFrame, keys: list[str], order: Column, **values: tuple[Column, str, bool]) -> DataFrame:
    """Columns over the rows of equal keys that come before in order: (value, "max" or "sum", True to take in the row itself)."""
    split = rows.withColumns({"_order": order, "_stretch": F.floor(order / STRETCH), **{f"_v_{c}": v for c, (v, _, _) in values.items()}})
    fold = {"max": F.max, "sum": F.sum}
    until = lambda parts, by, own: Window.partitionBy(*parts).orderBy(by).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    ends = split.groupBy(*keys, "_stretch").agg(*[fold[f](f"_v_{c}").alias(f"_e_{c}") for c, (_, f, _) in values.items()])
    before = ends.select(*keys, "_stretch", *[fold[f](f"_e_{c}").over(until(keys, "_stretch", False)).alias(f"_b_{c}") for c, (_, f, _) in values.items()])
    out = split.withColumns({c: fold[f](f"_v_{c}").over(until([*keys, "_stretch"], "_order", own)) for c, (_, f, own) in values.items()})
    out = out.join(before, [*keys, "_stretch"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    whole = {c: F.greatest(c, f"_b_{c}") if f == "max" else zero(c) + zero(f"_b_{c}") for c, (_, f, _) in values.items()}
    return out.withColumns(whole).select(*rows.columns, *values)


def reply_tree(turns: DataFrame) -> DataFrame:
    """Of distinct (conv_id, turn, linked): ``reply_to`` and ``position`` of each turn."""
    conv, turn, one = ["conv_id"], F.col("turn"), F.lit(1).cast("long")
    told = running(turns, conv, turn, previous=(turn, "max", False), place=(one, "sum", False))
    told = told.withColumns({"reply_to": F.coalesce("linked", "previous"), "opens": F.coalesce(F.col("linked") < F.col("previous"), F.lit(False))})
    told = written(told.select("conv_id", "turn", "previous", "place", "reply_to", "opens"), "replies")
    branches = written(told.where("opens").select("conv_id", F.col("reply_to").alias("at"), F.col("turn").alias("start")), "branches")
    if branches.isEmpty():
        return told.select("conv_id", "turn", "reply_to", F.col("place").alias("position"))
    sizes = told.join(branches.select("conv_id").distinct(), "conv_id", "left_semi").groupBy("conv_id").agg(F.count("*").alias("n"), F.max("turn").alias("end"))
    cuts = branches.select("conv_id", F.col("at").alias("previous"), F.lit(True).alias("cut")).distinct()
    marked = told.join(sizes.select("conv_id"), "conv_id", "left_semi").join(cuts, ["conv_id", "previous"], "left")
    marked = written(marked.withColumn("first", F.col("previous").isNull() | F.col("opens") | F.coalesce("cut", F.lit(False))), "marked-turns")
    ranks = piece_ranks(marked.where("first"), branches, sizes)
    held = running(marked, conv, turn, start=(F.when(F.col("first"), turn), "max", True)).select("conv_id", "turn", "start", "place")
    placed = held.join(ranks, ["conv_id", "start"]).select("conv_id", "turn", (F.col("rank") + F.col("place") - F.col("from")).alias("position"))
    return told.join(placed, ["conv_id", "turn"], "left").select("conv_id", "turn", "reply_to", F.coalesce("position", "place").alias("position"))


def piece_ranks(firsts: DataFrame, branches: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, start, from, rank): how many turns stand before each piece in reply order, and before its first turn in time."""
    conv, start = ["conv_id"], F.col("start")
    pieces = firsts.select("conv_id", F.col("turn").alias("start"), "place", "previous", "opens")
    pieces = running(pieces, conv, -start, later=(-start, "max", False)).withColumn("later", -F.col("later"))
    pieces = running(pieces, conv, start, branch=(F.when(F.col("opens"), start), "max", True))
    after = pieces.select("conv_id", start.alias("later"), F.col("place").alias("later_place"), F.col("previous").alias("later_previous"), F.col("opens").alias("later_opens"))
    pieces = pieces.join(after, ["conv_id", "later"], "left").join(sizes, conv)
    last = F.coalesce("later_previous", "end")
    goes_on = F.when(~F.col("later_opens"), F.col("later"))
    pieces = pieces.select("conv_id", "start", "place", "branch", "n", last.alias("at"), goes_on.alias("goes_on"), (F.coalesce("later_place", "n") - F.col("place")).alias("weight"))
    pieces = written(pieces, "pieces")
    link = lambda number, is_end: F.when(number.isNotNull(), F.struct(number.alias("number"), F.lit(is_end).alias("is_end")))
    child = branches.groupBy("conv_id", "at").agg(F.min("start").alias("child"))
    own = pieces.join(child, ["conv_id", "at"], "left")
    own = own.select("conv_id", F.struct(start.alias("number"), F.lit(False).alias("is_end")).alias("item"), "weight", F.coalesce(link(F.col("child"), False), link(F.col("branch"), True)).alias("next"))
    sibling = running(branches, ["conv_id", "at"], -start, sibling=(-start, "max", False)).withColumn("sibling", -F.col("sibling"))
    ends = sibling.join(pieces.select("conv_id", "at", "goes_on", "branch"), ["conv_id", "at"])
    ends = ends.select("conv_id", F.struct(start.alias("number"), F.lit(True).alias("is_end")).alias("item"), F.lit(0).cast("long").alias("weight"), F.coalesce(link(F.col("sibling"), False), link(F.col("goes_on"), False), link(F.col("branch"), True)).alias("next"))
    items = written(own.unionByName(ends), "reply-items")
    # Each round adds the weight of the next item and steps over it, so a round doubles how far items have seen.
    while not items.where("next IS NOT NULL").isEmpty():
        ahead = items.select("conv_id", F.col("item").alias("next"), F.col("weight").alias("more"), F.col("next").alias("then"))
        seen = items.join(ahead, ["conv_id", "next"], "left")
        items = written(seen.select("conv_id", "item", (F.col("weight") + F.coalesce("more", F.lit(0).cast("long"))).alias("weight"), F.col("then").alias("next")), "reply-items")
    left = items.where("NOT item.is_end").select("conv_id", F.col("item.number").alias("start"), F.col("weight").alias("until_end"))
    return pieces.join(left, ["conv_id", "start"]).select("conv_id", "start", F.col("place").alias("from"), (F.col("n") - F.col("until_end")).alias("rank"))


def linked_conversations(messages: DataFrame) -> DataFrame:
    """Per message: own text without quotes, what it replies to, its place in reply order, and counts of quotes."""
    text = F.coalesce("text", F.lit(""))
    told = messages.select("conv_id", "turn", "role", text.alias("text")).withColumn("key", F.xxhash64("role", "text")).withColumn("own", own_text(F.col("text")))
    links = written(quote_links(told), "quote-links")
    each = links.groupBy("conv_id", "turn", "key").agg(
        F.count("*").alias("n_passages"),
        F.count("origin").alias("n_linked"),
        F.max("level").alias("quote_depth"),
        F.min_by("origin", F.struct(F.when(F.col("origin").isNull(), 1).otherwise(0), "level", -F.col("origin"))).alias("linked"),
    )
    turns = told.select("conv_id", "turn").where("conv_id IS NOT NULL AND turn IS NOT NULL").distinct()
    first = each.groupBy("conv_id", "turn").agg(F.max("linked").alias("linked"))
    tree = kept(messages.sparkSession, lambda: reply_tree(turns.join(first, ["conv_id", "turn"], "left")), "reply-tree")
    counts = each.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), F.col("key").alias("_key"), "n_passages", "n_linked", "quote_depth")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("key") == F.col("_key"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        told.join(counts, same, "left")
        .join(tree, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", "role", F.col("own").alias("text"), "reply_to", "position", zero("n_passages"), zero("n_linked"), zero("quote_depth"))
    )


def conversation_report(messages: DataFrame) -> DataFrame:
    found = linked_conversations(messages)
    return found.select("conv_id", "turn", "role", "reply_to", "position", "n_passages", "n_linked", "quote_depth", F.md5("text").alias("text_md5"))
