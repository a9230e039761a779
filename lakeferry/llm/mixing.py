"""Sources interleaved by target weights: Pfair windows and earliest deadline first.

Documents of a source form blocks of ``block_docs``. A source with weight w of W in all is a task:
its i-th block (from 0) is released at slot floor(i W / w) and due by slot ceil((i + 1) W / w). Each
slot takes, of the released blocks, the one with the earliest deadline (ties to the first source by
name). Weights fill all slots, so every block meets its deadline and at every slot each source's count
is within less than one block of its weight times the slot. The pattern repeats after a period, a
multiple of W slots, so nothing is rounded. A source that has run out leaves its slots empty, and
every document stays. Everything is DataFrame expressions; the pattern is one bounded row.

Where W is more than ``most_slots``, period p (about ``slots`` = D slots) has as many blocks of a source as
lie between floor(p D w / W) and floor((p + 1) D w / W) and is scheduled by these quotas: what one
period rounds off the next one has, so the deviation is less than one block a source plus one however
long the mix. Only periods that documents reach are worked out, each in a row of its own.

The order inside a source is that of a hash of id and text. Ranks come from counts of 4,096 hash
ranges and numbers inside a range, so a source with most rows is spread over all tasks.

Defined results: a null source is a source of its own, first by name; null ids and texts count as
empty in the hash; equal rows take neighbouring ranks; sources without a given weight get none and
are an error, as are weights below 1; no rows give no rows; columns named ``slot``, ``block`` or ``within`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OWN = ["slot", "block", "within"]


def source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def sized(weights: DataFrame, slots: int, most_slots: int = 100_000) -> DataFrame:
    """One row: tasks (_s and weight, by name), total (of the weights), slots (of a period), rounds
    (periods until the quotas repeat)."""
    return (
        weights.where("weight > 0")
        .groupBy()
        .agg(
            F.sort_array(F.collect_list(F.struct("_s", F.col("weight").cast("long").alias("weight")))).alias("tasks"),
            F.sum("weight").cast("long").alias("total"),
        )
        .where("total is not null")
        .withColumn("_least", F.expr(f"greatest({slots}L, 2L * size(tasks))"))
        .withColumn(
            "slots", F.expr(f"if(total <= {most_slots}, (_least + total - 1) div total * total, _least)")
        )
        .withColumn("rounds", F.expr("if(slots % total = 0, 1L, total)"))
        .drop("_least")
    )


def _upto(period: str, weight: str) -> str:
    """Blocks of a source before a period; the product may leave 64 bits."""
    return f"(cast({period} as decimal(19, 0)) * cast(slots * {weight} as decimal(19, 0))) div total"


def quotas(weights: DataFrame, slots: int, rounds: DataFrame | None = None) -> DataFrame:
    """round, _s, quota, slots: blocks of each source in the rounds named (the first by default)."""
    plan = sized(weights, slots)
    each = F.expr("inline(zip_with(tasks, quota, (s, q) -> struct(s._s as _s, q as quota)))")
    return _rounds(plan, rounds).select("round", each, F.col("length").alias("slots"))


def _rounds(plan: DataFrame, rounds: DataFrame | None) -> DataFrame:
    """The plan's row for each round with start (its first slot), quota (of each task) and length."""
    each = plan.withColumn("round", F.lit(0).cast("long")) if rounds is None else rounds.join(F.broadcast(plan))
    return (
        each.withColumn("_before", F.expr(f"transform(tasks, s -> {_upto('round', 's.weight')})"))
        .withColumn("_after", F.expr(f"transform(tasks, s -> {_upto('(round + 1)', 's.weight')})"))
        .withColumn("quota", F.expr("zip_with(_after, _before, (a, b) -> a - b)"))
        .withColumn("start", F.expr("aggregate(_before, 0L, (a, x) -> a + x)"))
        .withColumn("length", F.expr("aggregate(quota, 0L, (a, x) -> a + x)"))
        .drop("_before", "_after")
    )


def pattern(rounds: DataFrame) -> DataFrame:
    """round, _s, nth, at: the slot of each source's nth block of a round."""
    due = "((now.taken[i] + 1) * length + quota[i] - 1) div quota[i]"
    ready = "now.taken[i] < quota[i] AND (now.taken[i] * length) div quota[i] <= t"
    pick = (
        f"array_min(transform(filter(sequence(0, size(tasks) - 1), i -> {ready}),"
        f" i -> struct({due} AS due, i AS i))).i"
    )
    none = "cast(array() AS array<struct<i: int, nth: bigint>>)"
    # a thousand steps at a time, so that the list that grows step by step stays short
    part = f"""aggregate(
            sequence(first, least(first + 999, length - 1)),
            struct(st.taken AS taken, {none} AS picks),
            (now, t) -> transform(array({pick}), p -> struct(
                transform(now.taken, (c, i) -> if(i = p, c + 1, c)) AS taken,
                concat(now.picks, array(struct(p AS i, now.taken[p] AS nth))) AS picks))[0])"""
    steps = f"""aggregate(
        sequence(0L, length - 1, 1000L),
        struct(array_repeat(0L, size(tasks)) AS taken,
            cast(array() AS array<array<struct<i: int, nth: bigint>>>) AS parts),
        (st, first) -> transform(array({part}), d ->
            struct(d.taken AS taken, concat(st.parts, array(d.picks)) AS parts))[0],
        st -> flatten(st.parts))"""
    return (
        rounds.where("length > 0")
        .select("round", "tasks", "start", F.posexplode(F.expr(steps)).alias("at", "pick"))
        .select(
            "round",
            F.expr("tasks[pick.i]._s").alias("_s"),
            F.col("pick.nth").alias("nth"),
            (F.col("start") + F.col("at")).alias("at"),
        )
    )


def root_weights(docs: DataFrame) -> DataFrame:
    """_s, weight: the square root of each source's row count, rounded up."""
    return docs.groupBy(source_key().alias("_s")).agg(
        F.ceil(F.sqrt(F.count("*").cast("double"))).cast("long").alias("weight")
    )


def ranked(docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
    """row (the document, or its columns ``carry``), _s and _rank (from 0) in the source's hash order."""
    key = F.md5(
        F.concat(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.lit("\n"),
            F.coalesce(F.col("text").cast("string"), F.lit("")),
        ).cast("binary")
    )
    # the row travels as one column, so that its columns meet none of ours
    row = F.struct(*(docs.columns if carry is None else carry)).alias("row")
    keyed = docs.select(row, source_key().alias("_s"), key.alias("_key")).withColumn(
        "_range", F.substring("_key", 1, 3)
    )
    counts = keyed.groupBy("_s", "_range").agg(F.count("*").alias("_c"))
    upto = Window.partitionBy("_s").orderBy("_range")
    before = counts.select("_s", "_range", (F.sum("_c").over(upto) - F.col("_c")).alias("_before"))
    inside = Window.partitionBy("_s", "_range").orderBy("_key")
    return (
        keyed.withColumn("_in", F.row_number().over(inside) - 1)
        .join(before, ["_s", "_range"])
        .select("row", "_s", (F.col("_before") + F.col("_in")).alias("_rank"))
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    block_docs: int = 16,
    slots: int = 1000,
    most_slots: int = 100_000,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with slot, block and within: reading order is (slot, within).

    ``carry``: the columns that come along, all by default; texts that nobody needs behind the hash
    are not shuffled and sorted.

    ``weights``: source and positive integer weight; by default square roots of the row counts.
    """
    docs = docs.drop(*_OWN)
    own = root_weights(docs) if weights is None else weights.select(source_key().alias("_s"), "weight")
    plan = sized(own, slots, most_slots)
    # one row a source
    task = F.broadcast(
        plan.select("total", "slots", "rounds", F.inline("tasks")).withColumnRenamed("_s", "_task")
    )
    period = "((block + 1) * total + weight * slots - 1) div (weight * slots) - 1"
    repeats = (plan.select("rounds").first() or [1])[0] == 1
    if repeats:
        # the pattern has one row a slot of a period, ``most_slots`` or a little more than ``slots``
        at = F.broadcast(pattern(_rounds(plan, None)))
    else:
        reached = (
            docs.groupBy(source_key().alias("_s"))
            .agg(F.count("*").alias("_c"))
            .join(task, F.col("_s") == F.col("_task"))
            .withColumn("block", F.explode(F.expr(f"sequence(0L, (_c - 1) div {block_docs})")))
            .select(F.expr(f"({period}) % rounds").alias("round"))
            .distinct()
        )
        at = pattern(_rounds(plan, reached))
    unknown = F.raise_error(F.concat(F.lit("no weight for source "), F.col("_s"))).cast("long")
    return (
        ranked(docs, carry)
        .withColumn("block", F.expr(f"_rank div {block_docs}"))
        .withColumn("within", F.col("_rank") % block_docs)
        .join(task, F.col("_s") == F.col("_task"), "left")
        .withColumn("_period", F.coalesce(F.expr(period), unknown))
        .withColumn("round", F.expr("_period % rounds"))
        .withColumn("nth", F.expr(f"block - ({_upto('_period', 'weight')})"))
        .join(at, ["_s", "round", "nth"])
        .withColumn("slot", F.expr("(_period div rounds) * rounds * slots + at"))
        .select("row.*", *_OWN)
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """Rows range-partitioned and sorted into reading order, without the columns ``mix`` added. The
    alias hides the places that the rows had in the files they came from."""
    return mixed.sort("slot", "within").drop(*_OWN).alias("mixed")


SQL = """
WITH RECURSIVE keyed AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS s,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')) AS key
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY key) - 1 AS rank FROM keyed
), weights AS (
  SELECT s, CAST(ceil(sqrt(CAST(count(*) AS DOUBLE))) AS BIGINT) AS w FROM keyed GROUP BY s
), sized AS (
  SELECT s, w, sum(w) OVER () AS total, greatest(1000, 2 * count(*) OVER ()) AS least FROM weights
), quotas AS (
  -- a period is a whole number of rounds of all weights, so every source gets its exact share of it
  SELECT s, (least + total - 1) // total * total AS slots, (least + total - 1) // total * w AS quota FROM sized
), tasks AS (
  SELECT list(s ORDER BY s) AS names, list(CAST(quota AS BIGINT) ORDER BY s) AS q,
         CAST(max(slots) AS BIGINT) AS slots
  FROM quotas
), steps AS (
  SELECT CAST(-1 AS BIGINT) AS t, list_transform(q, lambda x: CAST(0 AS BIGINT)) AS taken,
         CAST(NULL AS BIGINT) AS pick, q, slots
  FROM tasks
  UNION ALL
  SELECT t + 1, list_transform(taken, lambda c, i: CASE WHEN i = p THEN c + 1 ELSE c END), p, q, slots
  FROM (
    SELECT *, list_sort(list_transform(
      list_filter(range(1, len(q) + 1), lambda i: taken[i] < q[i] AND (taken[i] * slots) // q[i] <= t + 1),
      lambda i: {'due': ((taken[i] + 1) * slots + q[i] - 1) // q[i], 'i': i}))[1].i AS p
    FROM steps WHERE t + 1 < slots
  )
), pattern AS (
  SELECT names[pick] AS s, t AS at, taken[pick] - 1 AS nth, steps.q[pick] AS quota, steps.slots
  FROM steps, tasks WHERE pick IS NOT NULL
)
SELECT r.doc_id, r.source, r.rank // 16 AS block, r.rank % 16 AS within,
       ((r.rank // 16) // p.quota) * p.slots + p.at AS slot
FROM ranked r
JOIN (SELECT DISTINCT s, quota FROM pattern) u ON u.s = r.s
JOIN pattern p ON p.s = r.s AND p.nth = (r.rank // 16) % u.quota
"""
