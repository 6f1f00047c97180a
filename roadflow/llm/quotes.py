"""Chat formatting by quotation linking, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage, unstage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
QUOTED = r"^(?:\x20*>)+"
#: Where sentences end; words that an unmarked repeat must have; the level that stands for it, below all marked ones.
SENTENCE, REPEATED, UNMARKED = r"(?<=[.!?])[\x20\x09-\x0D]+", 2, 1 << 20


def normalised(text: Column) -> Column:
    """A-Z lowered, white space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), SPACE, " "))


def lines_of(text: Column) -> Column:
    """Array of (level, body) of the lines; the level is the number of leading `>`, 0 is the writer's own text."""
    return F.transform(
        F.split(text, r"\r?\n", -1),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, QUOTED, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, QUOTED + r"\x20?", "").alias("body"),
        ),
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body reads it and wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), 0)


def runs_of(lines: Column) -> Column:
    """Array of (level, lines): runs of lines of one level, from what ``lines_of`` gives. Each line is read a fixed number
    of times, however many there are."""

    def cut(x: Column) -> Column:
        level = lambda i: F.get(x, i)["level"]
        begins = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | (level(i) != level(i - 1)))
        ends = lambda b: F.array_append(F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))), F.size(x))
        run = lambda s, e: F.struct(level(s).alias("level"), F.transform(F.slice(x, s + 1, e - s), lambda y: y["body"]).alias("lines"))
        return bound(begins, lambda b: F.zip_with(b, ends(b), run))

    return bound(lines, cut)


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a message: ``conv_id, turn, role, reply_to, thread, n_quotes, n_repeats, deepest, own_text, chat_text``.

    Passages are normalised and hashed. A message's own passages are its whole own text, its runs of own lines, its lines
    and its sentences. Quoted passages (runs of lines with `>`, their lines and sentences) are joined within the
    conversation to the first message that wrote the passage itself. Lines and sentences of REPEATED words or more that
    a message repeats from an earlier one without marking them count as quotes of the deepest level. A message replies
    to the one with the longest passage it quotes at the shallowest level (ties: the later turn). ``thread`` is the turn
    at which the chain of replies starts: conversations in reply order are the rows by conv_id, thread, turn.
    ``own_text`` has no marked quotes (repeats are the writer's own words and stay); ``chat_text`` wraps it in role
    marks. ``n_quotes`` counts runs of marked lines, ``n_repeats`` distinct passages that an earlier message wrote.

    A null text counts as empty; a null role is ``user``; messages with a null conversation or turn link with
    nothing and are their own thread. Repeated (conversation, turn) rows all stay and get the same links, and do not
    quote each other. Originals are reduced to one row a conversation and passage before the joins, so a line that all
    messages share makes no pairs; no conversation is gathered, so a hot one is no group. Further columns are not read.
    """
    m = messages.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("user")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    cut = lambda rows: rows.withColumn("runs", runs_of(lines_of(F.col("text")))).drop("text")
    own_runs = F.filter("runs", lambda r: r["level"] == 0)
    line_keys = lambda runs: F.flatten(F.transform(runs, lambda r: r["lines"]))
    joined = lambda runs: F.transform(runs, lambda r: F.array_join(r["lines"], " "))
    sentences = lambda texts: F.flatten(F.transform(texts, lambda t: F.split(t, SENTENCE)))
    placed = m.where("conv_id IS NOT NULL AND turn IS NOT NULL")

    # Own passages, of which lines and sentences may repeat earlier ones.
    own = cut(placed).select("conv_id", "turn", own_runs.alias("o")).select("conv_id", "turn", joined(F.col("o")).alias("o_runs"), line_keys(F.col("o")).alias("o_lines"))
    parts = F.array_union(F.col("o_lines"), sentences(F.col("o_runs")))
    wholes = F.array_except(F.array_union(F.array(F.array_join("o_lines", " ")), F.col("o_runs")), parts)
    tagged = F.concat(F.transform(parts, lambda k: F.struct(k.alias("k"), F.lit(True).alias("part"))), F.transform(wholes, lambda k: F.struct(k.alias("k"), F.lit(False).alias("part"))))
    said = own.select("conv_id", "turn", F.explode(tagged).alias("p")).select("conv_id", "turn", normalised(F.col("p.k")).alias("k"), "p.part").where("k <> ''")
    words = F.length("k") - F.length(F.replace(F.col("k"), F.lit(" "))) + 1
    said = said.select("conv_id", "turn", F.xxhash64("k").alias("h"), F.length("k").alias("size"), (F.col("part") & (words >= REPEATED)).alias("part"))
    said = stage(said, "said")  # hashes only, no text
    first = stage(said.groupBy("conv_id", "h").agg(F.min("turn").alias("said"), F.max(F.when(F.col("part"), F.col("turn"))).alias("last")), "first")
    repeats = said.where("part").join(first.where("last > said").select("conv_id", "h", "said"), ["conv_id", "h"]).where("said < turn")
    repeats = repeats.select("conv_id", "turn", F.lit(UNMARKED).alias("level"), "size", "h", "said").distinct()

    marked = (
        cut(placed.where(F.col("text").rlike(r"(?:^|\n)\x20*>")))
        .select("conv_id", "turn", F.explode(F.filter("runs", lambda r: r["level"] > 0)).alias("q"))
        .select("conv_id", "turn", "q.level", F.array_join("q.lines", " ").alias("whole"), "q.lines")
        .select("conv_id", "turn", "level", F.explode(F.array_union(F.array_union(F.array("whole"), F.col("lines")), F.split("whole", SENTENCE))).alias("k"))
        .withColumn("k", normalised(F.col("k")))
        .where("k <> ''")
        .select("conv_id", "turn", "level", F.length("k").alias("size"), F.xxhash64("k").alias("h"))
        .distinct()
    )
    marked = marked.join(first.select("conv_id", "h", "said"), ["conv_id", "h"]).where("said < turn").select("conv_id", "turn", "level", "size", "h", "said")
    links = stage(
        marked.unionByName(repeats)
        .groupBy("conv_id", "turn")
        .agg(F.max(F.struct(-F.col("level"), F.col("size"), F.col("said"))).alias("best"), F.count_if(F.col("level") == UNMARKED).alias("n_repeats"))
        .select("conv_id", "turn", F.col("best.said").alias("reply_to"), F.col("best.said").alias("thread"), "n_repeats"),
        "links",
    )
    while True:
        up = links.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("up"))
        jumped = stage(
            links.join(up, ["conv_id", "thread"], "left").select(
                "conv_id", "turn", "reply_to", F.coalesce("up", "thread").alias("thread"), "n_repeats", F.col("up").isNotNull().alias("moved")
            ),
            "links",
        )
        unstage(links)
        links = jumped
        if links.where("moved").isEmpty():
            break
    unstage(said, first)
    linked = cut(m).join(links.drop("moved"), ["conv_id", "turn"], "left")
    own_text = F.regexp_replace(F.array_join(line_keys(own_runs), "\n"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return linked.select(
        "conv_id", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"),
        F.size(F.filter("runs", lambda r: r["level"] > 0)).alias("n_quotes"), F.coalesce("n_repeats", F.lit(0)).alias("n_repeats"),
        F.array_max(F.transform("runs", lambda r: r["level"])).alias("deepest"),
        own_text.alias("own_text"),
    ).withColumn("chat_text", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("own_text"), F.lit("<|end|>")))
