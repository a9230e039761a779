"""Conversations formatted as budgeted, turn-aligned training windows, in DataFrame expressions.

Template. A turn is ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts every ``<``
followed by backslashes and a bar gets one more backslash before the bar, so no control string can
stand there; taking one away restores the text. A line break in a role is written ``<|nl|>``.

Windows. Prefix sums of turn tokens over the whole conversation choose spans: a span starts a new window
when the next turn would exceed what the budget leaves after the system turn and the history, and where
the sum passes a multiple of ``block_budgets`` budgets, so that a conversation of any length is cut by
many tasks. A window holds the conversation's first system turn (if it comes before the window), the
last turns before the span that fit the history limit, on whichever side of such a multiple they are,
and the span. Turns are never cut: a turn longer than the budget has a window of its own. Repeated turns
are masked: only assistant texts of the span are under the loss, so each is learned once. How turns are
numbered decides their order and nothing else.

Prefix sums take two steps: turns are gathered by ``block_turns`` numbers, and one small row per gathering,
dealt over ranges of the order, is summed within its range and then over the ranges.

Tokens are estimated by a regular expression (up to six letters, up to three digits, or one other
sign each) plus four a turn, unless a column of counts is named.

Defined results: null role or text counts as empty; turns are ordered by number, role and text, turns
without a number first (dealt by a hash into blocks of their own); a null conv_id is a conversation;
rows that repeat are turns of their own; no rows give no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.session import staged

START, END, BREAK = "<|im_start|>", "<|im_end|>", "<|nl|>"
TOKEN = r"\p{L}{1,6}|\p{N}{1,3}|[^\p{L}\p{N}\x00-\x20]"
TURN_TOKENS = 4


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _written(role: Column, text: Column) -> Column:
    return F.concat(
        F.lit(START), F.replace(escaped(role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"), escaped(text), F.lit(END + "\n")
    )


#: A conversation's number and whether it is null, so that joins compare plain columns.
CONV = ("_conv", "_none")


def counted(turns: DataFrame, block_turns: int, tokens: str | None) -> DataFrame:
    """The columns of turns that matter, their tokens, and the gathering (numbered, block) of each."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.regexp_count(text, F.lit(TOKEN)) if tokens is None else F.coalesce(F.col(tokens), F.lit(0))
    named = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("_conv"),
        F.col("conv_id").cast("long").isNull().alias("_none"),
        F.col("turn").cast("long"), role.alias("role"), text.alias("text"),
        (size + TURN_TOKENS).cast("long").alias("tokens"),
    )
    block = F.when(F.col("turn").isNull(), F.pmod(F.xxhash64("role", "text"), F.lit(1024))).otherwise(
        F.floor(F.col("turn") / block_turns)
    )
    # never null, so that no join filters one of the plans that share the exchange of the gatherings
    block = F.coalesce(block.cast("long"), F.lit(0))
    return named.withColumns({"numbered": F.col("turn").isNotNull(), "block": block})


def gathered(rows: DataFrame) -> DataFrame:
    """CONV, numbered, block, rows: the ordered turns of each gathering, written and counted."""
    row = F.struct("turn", "role", "text", "tokens", _written(F.col("role"), F.col("text")).alias("written"))
    return (
        rows.groupBy(*CONV, "numbered", "block")
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
        .withColumn("system", F.expr("array_position(transform(rows, r -> r.role), 'system') - 1"))
    )


def offsets(rows: DataFrame) -> DataFrame:
    """CONV, numbered, block, before: the tokens of the conversation before each gathering."""
    order = [*CONV, "numbered", "block"]
    sizes = rows.groupBy(*order).agg(F.sum("tokens").alias("own"))
    ranged = staged(
        sizes.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "chat-offsets"
    )
    earlier = (Window.unboundedPreceding, -1)
    ranges = (
        ranged.groupBy(*CONV, "_range")
        .agg(F.sum("own").alias("_own"))
        .select(*CONV, "_range", F.sum("_own").over(Window.partitionBy(*CONV).orderBy("_range").rowsBetween(*earlier)).alias("_of"))
    )
    inside = F.sum("own").over(Window.partitionBy(*CONV, "_range").orderBy("numbered", "block").rowsBetween(*earlier))
    return (
        ranged.withColumn("_in", inside)
        .join(ranges, [*CONV, "_range"])
        .select(*order, (F.coalesce("_in", F.lit(0)) + F.coalesce("_of", F.lit(0))).alias("before"))
    )


def windows(
    turns: DataFrame,
    *,
    budget: int = 2048,
    history: int = 256,
    block_turns: int = 128,
    block_budgets: int = 64,
    tokens: str | None = None,
) -> DataFrame:
    """conv_id, block, window, n_repeated, n_new, n_tokens, formatted, loss (spans of code points in
    formatted: start from 0 and length)."""
    rows = counted(turns, block_turns, tokens)
    held = gathered(rows)
    first = (
        held.where("system >= 0")
        .groupBy(*CONV)
        .agg(
            F.min(
                F.struct("numbered", "block", "system", F.expr("rows[system].written as written"), F.expr("rows[system].tokens as tokens"))
            ).alias("sys")
        )
    )
    placed = held.join(offsets(rows), [*CONV, "numbered", "block"]).withColumn(
        "sums", F.expr("aggregate(rows, array(before), (a, r) -> concat(a, array(element_at(a, -1) + r.tokens)))")
    )
    width = max(block_budgets * budget, history, 1)
    each = placed.select(
        *CONV,
        F.col("numbered"),
        F.col("block").alias("gathering"),
        F.expr(
            "inline(transform(rows, (r, i) -> struct(sums[i] as pos, i as place, r.role as role,"
            " r.tokens as tokens, r.written as written)))"
        ),
    )
    # a turn near the end of a block is told to the next one too, as history
    own = f"pos div {width}"
    dealt = each.withColumn(
        "block", F.expr(f"explode(if(pos >= ({own} + 1) * {width} - {history}, array({own}, {own} + 1), array({own})))")
    )
    parts = (
        dealt.groupBy(*CONV, "block", F.hash(*CONV).alias("_spread"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "numbered", "gathering", "place", "role", "tokens", "written"))).alias("rows"))
        .drop("_spread")
        .withColumn("told", F.expr(f"size(filter(rows, r -> r.pos < block * {width}))"))
        .where("told < size(rows)")
    )
    sums = (
        parts.join(first, [*CONV], "left")
        .withColumn("sums", F.expr("concat(transform(rows, r -> r.pos), array(rows[size(rows) - 1].pos + rows[size(rows) - 1].tokens))"))
        .withColumn("room", F.greatest(F.lit(budget // 4), F.lit(budget - history) - F.coalesce("sys.tokens", F.lit(0))))
    )
    spans = sums.withColumn(
        "starts",
        F.expr(
            "aggregate(sequence(told + 1, size(rows)), array(told), (a, i) ->"
            " if(i < size(rows) AND sums[i + 1] - sums[element_at(a, -1)] > room, concat(a, array(i)), a))"
        ),
    )
    cut = spans.select(
        F.when(~F.col("_none"), F.col("_conv")).alias("conv_id"),
        "block", "rows", "sums", "sys", "starts", F.posexplode("starts").alias("window", "start"),
    ).withColumn("stop", F.expr("coalesce(get(starts, window + 1), size(rows))"))
    back = cut.withColumn(
        "back", F.expr(f"array_min(filter(sequence(0, start), h -> sums[start] - sums[h] <= {history}))")
    )
    told = back.withColumn(
        "lead",
        F.expr(
            "sys is not null AND struct(sys.numbered, sys.block, cast(sys.system as int))"
            " < struct(rows[back].numbered, rows[back].gathering, rows[back].place)"
        ),
    )
    pieces = told.select(
        "conv_id",
        "block",
        "window",
        (F.col("start") - F.col("back") + F.col("lead").cast("int")).alias("n_repeated"),
        (F.col("stop") - F.col("start")).alias("n_new"),
        F.expr("sums[stop] - sums[back] + if(lead, sys.tokens, 0L)").alias("n_tokens"),
        F.expr("concat(if(lead, sys.written, ''), array_join(transform(slice(rows, back + 1, start - back), r -> r.written), ''))").alias("before"),
        F.expr("slice(rows, start + 1, stop - start)").alias("own"),
    )
    ends = "aggregate(own, array(length(before)), (a, r) -> concat(a, array(element_at(a, -1) + length(r.written))))"
    # the text of a turn ends before the end mark; it starts after the role's line
    return pieces.select(
        "conv_id",
        "block",
        "window",
        "n_repeated",
        "n_new",
        "n_tokens",
        F.concat("before", F.array_join(F.expr("transform(own, r -> r.written)"), "")).alias("formatted"),
        F.expr(
            f"transform(filter(zip_with(own, slice({ends}, 1, size(own)), (r, s) -> struct(r.role as role,"
            f" s + {len(START)} + length('assistant') + 1 as start,"
            f" length(r.written) - {len(START) + len(END) + 2} - length('assistant') as length)),"
            " x -> x.role = 'assistant'), x -> struct(x.start as start, x.length as length))"
        ).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows say: turns and texts under the loss, each once, in order.

    The digest of a conversation needs its whole text in one row, as the window of a chat does.
    """
    parts = F.slice(F.split("formatted", START.replace("|", r"\|"), -1), F.col("n_repeated") + 2, F.greatest(F.col("n_new"), F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        text = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - 2 - len(END))
        return F.concat(
            unescaped(F.replace(role, F.lit(BREAK), F.lit("\n"))), F.lit("\n"), unescaped(text), F.lit("\n")
        )

    told = formatted.select(
        "conv_id",
        F.struct(
            F.col("block"),
            F.col("window"),
            F.array_join(F.transform(parts, turn), "").alias("turns"),
            F.expr(
                "array_join(transform(loss, s -> substring(formatted, s.start + 1, s.length)), '<|')"
            ).alias("loss"),
            F.size(parts).cast("long").alias("n"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    # texts under the loss hold no "<|", so it can part them until each is unescaped
    loss = "transform(w, x -> array_join(transform(split(x.loss, '<[|]', -1), t -> regexp_replace(t, '<[\\\\\\\\]([\\\\\\\\]*)[|]', '<$1|')), ''))"
    return (
        told.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("w")).alias("w"))
        .select(
            "conv_id",
            F.expr("aggregate(w, 0L, (a, x) -> a + x.n)").alias("n_turns"),
            F.sha2(F.array_join(F.expr("transform(w, x -> x.turns)"), ""), 256).alias("turns_sha256"),
            F.array_join(F.expr(loss), "").alias("_loss"),
            F.expr("aggregate(w, 0L, (a, x) -> a + x.chars)").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("_loss").cast("long").alias("loss_chars"),
            F.sha2("_loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
