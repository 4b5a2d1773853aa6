"""Conversations from messages that quote each other: quotes are parsed, linked to their originals, and left out.

A line's quote level is the number of ``>`` marks it begins with (white space between them is allowed). Lines of one level
that follow each other are a passage. Passages are normalised (marks off, white space runs to one space, lower case) and
hashed; so are the whole own text, the own paragraphs and the own lines of every message. A quoted passage is linked to
the first message, in turn order, of its conversation that holds it as one of these and comes earlier; where none does,
to the first message of another conversation that holds it. A passage that nobody holds is tried by its longest line.

A message replies to the message that its first linked passage of level 1 quotes, if that is in its conversation.
``thread`` is the turn at which the chain of replies begins, ``depth`` the number of replies up to it. Ordered by
``thread`` and ``turn``, every message comes after the one it replies to. Links and chains are those of messages, not of
turns: of several messages at one turn, only those that quote have a parent, each its own. Of equal passages at one turn, that of
the message with the least hash is the original. A line that ends in ``wrote:`` directly before a
quote is part of the quote.

Rows that are equal in all of conversation, turn, role and text are one message. Null texts are empty and stay null in
the result; a message with a null conversation or turn is never linked. A message of quotes only has an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.joins import fits_broadcast
from tidemark.session import materialize

# The marks of a quoted line, and the line that introduces a quote.
MARKS = r"^[ \t]*(?:>[ \t]*)+"
INTRODUCTION = r"(?i)wrote:[ \t\r]*$"


def normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _level(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def _parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with ``lines``: place, level, content, and whether the line introduces a quote."""
    raw = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    lines = F.transform(raw, lambda line, i: F.struct(
        i.alias("at"), _level(line).alias("level"), F.regexp_replace(line, MARKS, "").alias("content")))
    placed = messages.withColumn("lines", lines)
    following = lambda i: F.coalesce(F.get("lines", i + 1)["level"], F.lit(0))
    return placed.withColumn("lines", F.transform("lines", lambda x, i: x.withField(
        "intro", (x["level"] == 0) & x["content"].rlike(INTRODUCTION) & (following(i) > 0))))


def _own_text() -> Column:
    own = F.filter("lines", lambda x: (x["level"] == 0) & ~x["intro"])
    quoting = F.exists("lines", lambda x: x["level"] > 0)
    shorter = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["content"]), "\n"), r"^\s+|\s+$", "")
    return F.when(quoting, shorter).otherwise(F.col("text"))


def _quotes(parsed: DataFrame) -> DataFrame:
    """Quoted passages: ``message``, conversation and turn, ``number``, ``level``, ``hash``, ``line_hash``."""
    rows = parsed.where(F.exists("lines", lambda x: x["level"] > 0)).select(
        "message", "conv", "turn", F.explode("lines").alias("x")).select("message", "conv", "turn", "x.*").distinct()
    in_message = Window.partitionBy("message").orderBy("at")       # the lines of one message
    begins = F.coalesce(F.col("level") != F.lag("level").over(in_message), F.lit(True)).cast("int")
    numbered = rows.withColumn("begins", begins).withColumn("number", F.sum("begins").over(in_message))
    passages = numbered.where("level > 0").groupBy("message", "conv", "turn", "number", "level").agg(
        F.array_sort(F.collect_list(F.struct("at", "content"))).alias("held"))
    whole = normal(F.array_join(F.transform("held", lambda x: x["content"]), " "))
    longest = F.array_max(F.transform("held", lambda x: F.struct(
        F.char_length(normal(x["content"])).alias("n"), normal(x["content"]).alias("line"))))["line"]
    return passages.select("message", "conv", "turn", "number", "level", whole.alias("passage"), longest.alias("line")).where(
        "passage <> ''").select("message", "conv", "turn", "number", "level", F.sha2("passage", 256).alias("hash"),
                                F.sha2("line", 256).alias("line_hash"))


def _sized(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if fits_broadcast(small) else small


def _held(parsed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``hash``, ``conv`` and ``original``: turn and message of the first that holds the passage as its text, a paragraph or
    a line."""
    own = F.filter("lines", lambda x: (x["level"] == 0) & ~x["intro"])
    joined = F.array_join(F.transform(own, lambda x: x["content"]), "\n")
    units = F.concat(F.array(joined), F.split(joined, r"\n\s*\n", -1), F.split(joined, "\n", -1))
    hashes = F.array_distinct(F.transform(F.filter(F.transform(units, normal), lambda u: u != ""), lambda u: F.sha2(u, 256)))
    rows = parsed.where("conv IS NOT NULL AND turn IS NOT NULL").select(
        "conv", "turn", "message", F.explode(hashes).alias("hash"))
    return rows.join(_sized(wanted), "hash", "left_semi").groupBy("hash", "conv").agg(
        F.min(F.struct("turn", "message")).alias("original"))


def links(parsed: DataFrame) -> DataFrame:
    """Each quoted passage with its original: ``message``, ``number``, ``level``, ``to_conv``, ``to_turn``, ``to_message``."""
    quotes = materialize(_quotes(parsed), "quotes")
    wanted = quotes.select("hash").union(quotes.select(F.col("line_hash").alias("hash"))).distinct()
    held = materialize(_held(parsed, wanted), "originals")
    anywhere = held.groupBy("hash").agg(F.min(F.struct("conv", "original")).alias("first"))
    found = quotes.select("message", "conv", "turn", "number", "level", "hash", "line_hash")
    for kind in ("hash", "line_hash"):
        same = held.select(F.col("hash").alias(kind), "conv", F.col("original").alias(f"same_{kind}"))
        far = anywhere.select(F.col("hash").alias(kind), F.col("first").alias(f"far_{kind}"))
        found = found.join(same, [kind, "conv"], "left").join(far, kind, "left")
    earlier = [F.when(F.col(f"same_{k}.turn") < F.col("turn"), F.struct(F.col("conv"), F.col(f"same_{k}").alias("original")))
               for k in ("hash", "line_hash")]
    other = [F.when(F.col(f"far_{k}.conv") != F.col("conv"), F.col(f"far_{k}")) for k in ("hash", "line_hash")]
    to = F.coalesce(earlier[0], other[0], earlier[1], other[1])
    return found.select("message", "conv", "turn", "number", "level", to.alias("to")).select(
        "message", "conv", "turn", "number", "level", F.col("to.conv").alias("to_conv"),
        F.col("to.original.turn").alias("to_turn"), F.col("to.original.message").alias("to_message"))


def _threads(replies: DataFrame) -> DataFrame:
    """``message``, ``thread`` (turn of the first of its chain) and ``depth`` of replies (``message``, ``parent``,
    ``parent_turn``), by pointer doubling."""
    now = materialize(replies.select("message", F.col("parent").alias("up"), F.col("parent_turn").alias("thread"),
                                     F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = now.select(F.col("message").alias("up"), F.col("up").alias("next"), F.col("thread").alias("far"),
                           F.col("depth").alias("more"))
        after = materialize(now.join(above, "up", "left").select(
            "message", F.coalesce("next", "up").alias("up"), F.coalesce("far", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")), "threads")
        now = after.drop("moved")
        if not after.where("moved").limit(1).count():
            return now.drop("up")


def conversations(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """Per row: conversation, turn, role, own text, ``n_quotes``, ``n_linked``, ``parent_turn``, ``thread``, ``depth``."""
    named = messages.select(F.col(conversation).alias("conv"), F.col(turn).cast("long").alias("turn"),
                            F.col(role).alias("role"), F.col(text).alias("text"))
    parsed = _parsed(named.withColumn("message", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0"))
                                                              for c in ("conv", "turn", "role", "text")])))
    found = materialize(links(parsed), "quote-links")
    counted = found.groupBy("message").agg(F.count(F.lit(1)).alias("n_quotes"), F.count("to_conv").alias("n_linked"))
    inside = found.where("level = 1 AND to_conv = conv")
    replies = materialize(inside.groupBy("message").agg(F.min(F.struct("number", "to_turn", "to_message")).alias("first")).select(
        "message", F.col("first.to_turn").alias("parent_turn"), F.col("first.to_message").alias("parent")), "replies")
    threads = _threads(replies).join(replies.drop("parent"), "message")
    base = parsed.select("message", "conv", "turn", "role", _own_text().alias("text"))
    zero = F.lit(0).cast("long")
    return (base.join(_sized(materialize(counted, "quote-counts")), "message", "left")
            .join(_sized(materialize(threads, "threads")), "message", "left")
            .select(F.col("conv").alias(conversation), F.col("turn").alias(turn), F.col("role").alias(role),
                    F.col("text").alias(text), F.coalesce("n_quotes", zero).alias("n_quotes"),
                    F.coalesce("n_linked", zero).alias("n_linked"), "parent_turn", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", zero).alias("depth")))
