"""Chat formatting in windows of bounded length (native).

``windows(turns)`` writes each conversation as one or more training windows. A turn is written
``<turn ROLE>TEXT</turn>`` and a line end; in roles and texts the characters that could be taken for
the template are escaped, so any text can be read back. A window has at most BUDGET tokens:
the system turn that opens the conversation, then the last few turns before the span again, then a span
of turns. Spans are turn-aligned and chosen on prefix sums of the turns' tokens: each is the longest
that fits beside the system turn and HISTORY, the room kept for repeats. A turn longer than that is a span alone and may pass
BUDGET, because turns are never cut. Repeated turns fill HISTORY tokens and HISTORY_TURNS turns at most. The loss mask holds the
texts of assistant turns inside the span, never those of repeated turns, so each is learnt once.

Spans are chosen in blocks of BLOCK turns, a span never crossing into the next block, so one conversation with a third of
all turns is worked on by many tasks; longer conversations are numbered by distributed running
sums. A block knows the turns before it, and every block the system turn.

Tokens: runs of up to TOKEN_LETTERS letters or digits, and each other character but blanks, of the turn as written.
Turns are in order of ``turn``, ties by role, then by the text's SHA-256; null turns first. Null role or text: empty. A null conv_id is
a conversation too. Repeated rows are turns of their own. Other columns are not read. An empty
table has no windows; a turn with an empty text is a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from energy_mart.llm.common import settle
from energy_mart.operators.joins import join_null_safe
from energy_mart.operators.numbering import running_total

BUDGET, HISTORY, HISTORY_TURNS, BLOCK = 1024, 256, 4, 1024
TOKEN_LETTERS = 6
TOKEN = r"[\p{L}\p{N}]{1,%d}|[^\p{L}\p{N}\x20\x09-\x0D]" % TOKEN_LETTERS
#: The template, and what its characters become inside roles and texts.
OPEN, BODY, CLOSE = "<turn ", ">", "</turn>\n"
ESCAPES = (("\\", "\\0"), ("<", "\\1"), (">", "\\2"))
SYSTEM, LEARNT = "system", "assistant"


def escaped(c: Column) -> Column:
    for plain, written in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescaped(c: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, tie, place, long): ``long`` is the number of turns where it is above BLOCK.

    In these conversations ``place`` numbers the turns from 0; it is null in others, which ``blocks`` sorts whole.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.sha2(text.cast("binary"), 256).alias("tie"))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("long")).filter(F.col("long") > BLOCK)
    marked = join_null_safe(rows, settle(sizes), ["conv_id"], "left")
    ordinary = marked.filter("long IS NULL").withColumn("place", F.lit(None).cast("long"))
    # Rows that are equal in this order are equal in all columns, so any order among them will do.
    many = marked.filter("long IS NOT NULL").withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(many, ["turn", "role", "tie"], "one", "place", by=["conv_id"]).drop("one")
    return ordinary.unionByName(ranked.withColumn("place", F.col("place") - 1))


def _written(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(turn.role), F.lit(BODY), escaped(turn.text), F.lit(CLOSE))


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, system, before, turns): turns (role, text, tokens) of each block in order.

    ``system``: the opening system turn or null, in no other column; ``before``: up to HISTORY_TURNS turns before the block.
    """
    rows = numbered(turns)
    place, block = F.col("place"), F.floor(F.coalesce("place", F.lit(0)) / BLOCK)
    opens = F.coalesce((place == 0) & (F.col("role") == SYSTEM), F.lit(False))
    near_end = F.coalesce(place % BLOCK >= BLOCK - HISTORY_TURNS, F.lit(False))
    everywhere = F.sequence(F.lit(0).cast("long"), F.floor((F.coalesce("long", F.lit(1)) - 1) / BLOCK))
    targets = F.when(opens, everywhere).when(near_end, F.array(block, block + 1)).otherwise(F.array(block))
    turn = F.struct(F.coalesce("place", F.lit(-1)).alias("place"), "turn", "role", "tie", "text")
    spread = rows.select(turn.alias("t"), "conv_id", block.alias("own"), opens.alias("opens"), F.explode(targets).alias("block"))
    listed = lambda test: F.array_sort(F.collect_list(F.when(test, F.col("t"))))
    own = F.col("own") == F.col("block")
    grouped = spread.groupBy("conv_id", "block").agg(
        listed(own).alias("turns"), listed(~own & ~F.col("opens")).alias("before"), listed(~own & F.col("opens")).alias("lead")
    )
    counted = lambda c: F.transform(c, lambda t: F.struct(t.role.alias("role"), t.text.alias("text"), F.regexp_count(_written(t), F.lit(TOKEN)).alias("tokens")))
    there = grouped.filter((F.size("turns") > 0) | (F.size("lead") > 0) & (F.col("block") == 0))
    sized = there.select("conv_id", "block", *[counted(F.col(c)).alias(c) for c in ("turns", "before", "lead")])
    first = F.get("turns", F.lit(0))
    leads = (F.col("block") == 0) & F.coalesce(first.role == SYSTEM, F.lit(False))
    return sized.select(
        "conv_id", "block", F.when(leads, first).otherwise(F.get("lead", F.lit(0))).alias("system"), "before",
        F.when(leads, F.slice("turns", F.lit(2), F.size("turns"))).otherwise(F.col("turns")).alias("turns"),
    )


def _recent(turns: Column) -> Column:
    """The last turns that HISTORY tokens hold."""
    start = F.struct(F.slice(turns, 1, 0).alias("kept"), F.lit(HISTORY).alias("room"))

    def step(a: Column, t: Column) -> Column:
        fits = t.tokens <= a.room
        kept = F.when(fits, F.concat(F.array(t), a.kept)).otherwise(a.kept)
        return F.struct(kept.alias("kept"), F.when(fits, a.room - t.tokens).otherwise(F.lit(-1)).alias("room"))

    return F.aggregate(F.reverse(turns), start, step, lambda a: a.kept)


def spans(cut: DataFrame) -> DataFrame:
    """(conv_id, block, window, repeated, fresh): repeated and fresh turns of every window of ``blocks``."""
    room = F.lit(BUDGET - HISTORY) - F.coalesce("system.tokens", F.lit(0))
    sums = F.aggregate("turns", F.array(F.lit(0).cast("long")), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t.tokens)))
    summed = cut.withColumn("sums", sums)
    over = lambda s, i: F.get("sums", i + 1) - F.get("sums", F.element_at(s, -1)) > room
    later = F.when(F.size("turns") > 1, F.sequence(F.lit(1), F.size("turns") - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.aggregate(later, F.array(F.lit(0)), lambda s, i: F.when(over(s, i), F.concat(s, F.array(i))).otherwise(s))
    chosen = summed.withColumn("starts", starts).withColumn("all", F.concat("before", "turns"))
    end = lambda k: F.coalesce(F.get("starts", k + 1), F.size("turns"))
    until = lambda a: a + F.size("before")
    back = lambda a: F.least(until(a), F.lit(HISTORY_TURNS))
    window = F.transform("starts", lambda a, k: F.struct(
        k.alias("window"), F.slice("turns", a + 1, end(k) - a).alias("span"),
        _recent(F.slice("all", until(a) - back(a) + 1, back(a))).alias("history"),
    ))
    cells = chosen.select("conv_id", "block", "system", F.inline(window))
    lead = F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.slice("span", 1, 0))
    first = (F.col("block") == 0) & (F.col("window") == 0)
    return cells.select(
        "conv_id", "block", "window",
        F.when(first, F.col("history")).otherwise(F.concat(lead, "history")).alias("repeated"),
        F.when(first, F.concat(lead, "span")).otherwise(F.col("span")).alias("fresh"),
    )


def windows(turns: DataFrame) -> DataFrame:
    """(conv_id, block, window, text, n_turns, n_repeated, n_tokens, loss): the formatted windows, in order of (block, window).

    The first ``n_repeated`` turns of ``text`` are repeats. ``loss``: start (from 0) and length in code points of the stretches to learn.
    """
    chosen = spans(blocks(turns))
    n, m = F.size("repeated"), F.size(F.concat("repeated", "fresh"))
    marked = F.transform(F.concat("repeated", "fresh"), lambda t, i: F.struct(
        _written(t).alias("written"), F.length(escaped(t.role)).alias("role"), F.length(escaped(t.text)).alias("text"),
        ((i >= n) & (t.role == LEARNT)).alias("learnt"), t.tokens.alias("tokens"),
    ))
    laid = chosen.select("conv_id", "block", "window", n.alias("n_repeated"), m.alias("n_turns"), marked.alias("turns"))
    none = F.array().cast("array<struct<start:int,length:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("loss"))

    def step(a: Column, t: Column) -> Column:
        body = a.at + t.role + len(OPEN) + len(BODY)
        mark = F.array(F.struct(body.alias("start"), t.text.alias("length")))
        return F.struct((body + t.text + len(CLOSE)).alias("at"), F.when(t.learnt, F.concat(a.loss, mark)).otherwise(a.loss).alias("loss"))

    return laid.select(
        "conv_id", "block", "window", F.array_join(F.transform("turns", lambda t: t.written), "").alias("text"), "n_turns", "n_repeated",
        F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + t.tokens).alias("n_tokens"),
        F.aggregate("turns", start, step, lambda a: a.loss).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, block, window, turns, learnt, chars): fresh turns (role, text) and learnt texts, from ``text`` and ``loss`` alone."""
    pieces = F.slice(F.split("text", CLOSE), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    head = lambda p: F.substring_index(p, BODY, 1)
    turn = lambda p: F.struct(
        unescaped(F.substring(head(p), F.lit(len(OPEN) + 1), F.length(p))).alias("role"),
        unescaped(F.substring(p, F.length(head(p)) + len(BODY) + 1, F.length(p))).alias("text"),
    )
    learnt = F.transform("loss", lambda x: unescaped(F.substring(F.col("text"), x.start + 1, x.length)))
    return formatted.select("conv_id", "block", "window", F.transform(pieces, turn).alias("turns"), learnt.alias("learnt"), F.length("text").alias("chars"))


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation: counts and SHA-256 digests of what ``read_back`` finds, and all characters written.

    A digest needs a conversation's text in one value; the windows themselves do not.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    cells = read_back(formatted).select(
        "conv_id", "chars", F.size("turns").alias("n"), F.struct("block", "window", said.alias("said"), F.array_join("learnt", "").alias("learnt")).alias("w")
    )
    whole = cells.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("chars"), F.array_sort(F.collect_list("w")).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("said").cast("binary"), 256).alias("turns_sha256"),
        F.length(joined("learnt")).cast("long").alias("loss_chars"), F.sha2(joined("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
