"""Merkle manifest of a dataset: a proof for every row that it belongs to one root digest.

A row's leaf is the SHA-256 of its columns, each written with its length. The leaves of a group
(language) in ascending order of the row id form one tree of fan-out 8, whose root is the group's
subroot; the subroots, in order of the groups, form a last tree, whose root is the dataset's.

A tree is built as a nested rollup. A row's place in its group gives octal digits; rows meet in
blocks of 512 neighbours (three digits), and inside a block the lowest digit is grouped away, then
the next, then the next, each time nesting the children's structs in the parent. All three groupings
keep the partitioning by block, so a round costs one shuffle of digests. A block's root is a leaf of
the next round, a 512th of the rows. Proofs come out by the way back: one ``transform`` over a block's
nested structs writes down the siblings of each leaf, ``explode`` makes rows of them. Only between
rounds a block meets the proof of its own root, by an equi-join of one row a block; holding the whole
tree in one row would need no join at all, but would not be bounded.

Places are counted without a window over a group: rows are sorted into ranges, numbered inside their
range and moved by the counts of the ranges before. So a group may hold all rows.

Defined results: null columns are written as ``-`` (a null id comes first in its group, null groups
form a group of their own, first in order); rows of the same id are in the order of their leaves;
repeated rows are leaves of their own; an empty table has an empty manifest; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.session import staged

FAN_OUT, DIGITS = 8, 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_EMPTY_PATH = "array<struct<left:string,right:string>>"


def digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each as its length in bytes, a colon and itself, or ``-`` for null."""
    written = [
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
        for v in (value.cast("string") for value in values)
    ]
    return F.sha2(F.concat(*written), 256)


def tampered_text(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaves(docs: DataFrame, tamper: Column | None = None, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """``doc_id``, the group key, the leaf and, where ``tamper`` holds, the leaf of the changed row.

    The key keeps the order of the languages and tells null from every text.
    """
    original = digest([F.col(c) for c in columns])
    changed = digest([tampered_text(F.col(c)) if c == "text" else F.col(c) for c in columns])
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0")).alias("key"),
        original.alias("leaf"),
        (F.when(tamper, changed) if tamper is not None else F.lit(None).cast("string")).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"),
    )


def places(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) inside its ``key`` by ``order`` and ``n``, the key's rows.

    Sorted ranges number their rows themselves; only one row a range and key goes through a window.
    """
    ranged = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    numbered = staged(ranged.withColumn("at", F.monotonically_increasing_id()), "manifest-order")
    numbered = numbered.withColumn("part", F.shiftright("at", 33))
    counts = numbered.groupBy("part", "key").agg(F.count("*").alias("own"), F.min("at").alias("first"))
    offsets = counts.selectExpr(
        "part",
        "key",
        "sum(own) over (partition by key order by part) - own - first as shift",
        "sum(own) over (partition by key) as n",
    )
    return numbered.join(offsets, ["part", "key"]).withColumn("rank", F.col("at") + F.col("shift")).drop(
        "part", "at", "shift"
    )


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")


def _rolled(nodes: DataFrame, base: int) -> DataFrame:
    """Blocks of ``nodes`` (key, rank, n, hash, item): ``hash`` of the block and its nested ``tree``.

    ``base`` is the level of the nodes in their tree; a level is hashed only where the key has more
    than one node there.
    """
    digits = [f"d{i}" for i in range(DIGITS)]
    rows = nodes.select(
        "key",
        "n",
        F.shiftright("rank", 3 * DIGITS).alias("block"),
        *[F.shiftright("rank", 3 * i).bitwiseAND(F.lit(FAN_OUT - 1)).alias(d) for i, d in enumerate(digits)],
        "hash",
        "item",
    ).repartition("key", "block")
    child = "item"
    for i, digit in enumerate(digits):
        rows = rows.groupBy("key", "block", "n", *digits[i + 1 :]).agg(
            F.sort_array(F.collect_list(F.struct(digit, "hash", child))).alias("kids")
        )
        parent = F.sha2(_joined(F.col("kids")), 256)
        single = F.element_at("kids", 1)["hash"]
        rows = rows.withColumn("hash", F.when(F.col("n") > FAN_OUT ** (base + i), parent).otherwise(single))
        child = "kids"
    return rows.withColumnRenamed("kids", "tree")


def _step(nodes: Column, at: Column) -> Column:
    """Digests left and right of the node numbered ``at`` (from 0) in its run."""
    left = _joined(F.slice(nodes, F.lit(1), at))
    right = _joined(F.slice(nodes, at + F.lit(2), F.lit(FAN_OUT)))
    return F.struct(left.alias("left"), right.alias("right"))


def _unrolled(blocks: DataFrame, base: int) -> DataFrame:
    """One row a node of the blocks (key, n, tree, path): ``item`` and its ``path`` to the root."""
    tree, n = F.col("tree"), F.col("n")

    def path(*steps: Column) -> Column:
        own = [
            F.when(n > FAN_OUT ** (base + i), F.array(s)).otherwise(F.array().cast(_EMPTY_PATH))
            for i, s in enumerate(steps)
        ]
        return F.concat(*own, F.col("path"))

    found = F.transform(
        tree,
        lambda a, i: F.flatten(
            F.transform(
                a["kids"],
                lambda b, j: F.transform(
                    b["kids"],
                    lambda c, k: F.struct(
                        c["hash"].alias("hash"),
                        c["item"].alias("item"),
                        path(_step(b["kids"], k), _step(a["kids"], j), _step(tree, i)).alias("path"),
                    ),
                ),
            )
        ),
    )
    return blocks.select("key", "n", *_carried(blocks), F.explode(F.flatten(found)).alias("node")).select(
        "key", "n", *_carried(blocks), "node.*"
    )


def _carried(df: DataFrame) -> list[str]:
    return [c for c in ("subroot", "root") if c in df.columns]


def _rounds(nodes: DataFrame, label: str) -> list[DataFrame]:
    """Blocks of every round of a forest, the last one with one row a key."""
    most = nodes.agg(F.max("n")).head()[0] or 1
    out, span = [], 1
    while True:
        blocks = staged(_rolled(nodes, DIGITS * len(out)), f"manifest-{label}-{len(out)}")
        out.append(blocks)
        span *= FAN_OUT**DIGITS
        if span >= most:
            return out
        nodes = blocks.select("key", "n", F.col("block").alias("rank"), "hash", F.col("block").alias("item"))


def _paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Items of the first round with their paths; ``tops`` has the path above each key's root."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for base in range(len(rounds) - 1, -1, -1):
        blocks = rounds[base].select("key", "block", "n", "tree").join(above, ["key", "block"])
        nodes = _unrolled(blocks, DIGITS * base)
        if base:
            above = nodes.select("key", F.col("item").alias("block"), "path", *_carried(nodes))
    return nodes


def manifest(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """Per row: leaf, subroot, root, digest of its proof, and the root folded from the proof.

    Where ``tamper`` (on the columns of ``docs``) holds, the fold starts from the row with its text
    lower-cased, which a verifier must notice.
    """
    rows = places(staged(leaves(docs, tamper), "manifest-leaves"), ["doc_id", "leaf", "tie"])
    rows = staged(rows, "manifest-places")
    item = F.struct("doc_id", "tampered")
    first = rows.select("key", "n", "rank", F.col("leaf").alias("hash"), item.alias("item"))
    trees = _rounds(first, "rows")

    subroots = trees[-1].select(F.lit("").alias("key"), F.col("key").alias("lang"), "hash")
    ordered = staged(places(subroots, ["lang"]), "manifest-subroots")
    crown = _rounds(ordered.select("key", "n", "rank", "hash", F.col("lang").alias("item")), "crown")
    no_path = F.array().cast(_EMPTY_PATH)
    top = crown[-1].select("key", F.col("hash").alias("root"), no_path.alias("path"))
    tops = _paths(crown, top).select(
        F.col("item").alias("key"), F.col("hash").alias("subroot"), "root", "path"
    )

    found = _paths(trees, tops)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    start = F.coalesce(F.col("item.tampered"), F.col("hash"))
    folded = F.aggregate(
        "path", start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256)
    )
    return found.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(levels: int = 8, crown: int = 3) -> str:
    """The manifest of ``documents`` for DuckDB, levels written out; rows whose id's CRC-32 is a
    multiple of 3 are tampered with. Enough for 8 ** ``levels`` rows a language."""
    steps = []

    def climb(name: str, group: str, count: int) -> list[str]:
        for i in range(count):
            # k numbers the nodes of a level from 0, n counts them
            steps.append(
                f"{name}{i}p AS (SELECT {group}, k // 8 AS k, count(*) AS m,"
                f" CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY k)) ELSE max(h) END AS h,"
                f" list(h ORDER BY k) AS run FROM {name}{i} GROUP BY {group}, k // 8)"
            )
            steps.append(
                f"{name}{i + 1} AS (SELECT {group}, k, h, count(*) OVER (PARTITION BY {group}) AS n"
                f" FROM {name}{i}p)"
            )
        return [
            f"CASE WHEN len({name}{i}p.run) > 1 OR {name}{i}.n > 1 THEN"
            f" [{{'l': array_to_string({name}{i}p.run[1:{name}{i}.k % 8], ''),"
            f" 'r': array_to_string({name}{i}p.run[{name}{i}.k % 8 + 2:], '')}}] ELSE [] END"
            for i in range(count)
        ]

    columns = ", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in COLUMNS)
    changed = columns.replace("text::", f"translate(text, '{_UPPER}', '{_LOWER}')::")
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),"
        " lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda x, y:"
        " CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END), 4294967295)"
    )
    below = climb("t", "key", levels)
    joins = "".join(
        f" JOIN t{i}p ON t{i}p.key = t{i}.key AND t{i}p.k = t{i}.k // 8"
        f" JOIN t{i + 1} ON t{i + 1}.key = t{i}.key AND t{i + 1}.k = t{i}.k // 8"
        for i in range(levels)
    )
    steps.append("c0 AS (SELECT '' AS g, key AS lang, row_number() OVER (ORDER BY key) - 1 AS k, h,"
                 f" count(*) OVER () AS n FROM t{levels})")
    above = climb("c", "g", crown)
    over = "".join(
        f" JOIN c{i}p ON c{i}p.k = c{i}.k // 8 JOIN c{i + 1} ON c{i + 1}.k = c{i}.k // 8" for i in range(crown)
    )
    return f"""
WITH base AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS key, sha256(concat({columns})) AS h,
         CASE WHEN {crc} % 3 = 0 THEN sha256(concat({changed})) END AS x
  FROM documents
), t0 AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, h) - 1 AS k,
         count(*) OVER (PARTITION BY key) AS n FROM base
), {", ".join(steps)}, tops AS (
  SELECT c0.lang, c0.h AS subroot, c{crown}.h AS root, flatten([{", ".join(above)}]) AS path FROM c0{over}
), found AS (
  SELECT t0.doc_id, t0.h AS leaf, coalesce(t0.x, t0.h) AS start, subroot, root,
         list_concat(flatten([{", ".join(below)}]), path) AS path
  FROM t0{joins} JOIN tops ON tops.lang = t0.key
), folded AS (
  SELECT *, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': start, 'r': ''}}, path),
                     lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root
  FROM found
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
