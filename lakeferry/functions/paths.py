"""Substring and prefix matching of two path columns as equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.joins import lookup


def contains_pairs(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """Distinct pairs (longer, shorter) where the longer text contains the shorter one.

    Both inputs have one column ``text``. Every text of ``shorter`` has a shape: the offset of
    its first ``/``, the characters beside that slash, and its length. Where it occurs in a longer
    text, that slash lies on a slash with the same neighbours, so it is enough to cut each longer
    text once per such slash and shape (once per position for shapes without a slash) and to look
    the cuts up by equality. A URI has one ``://``, so it is cut about once per length that
    occurs. The work follows the texts and the matches, not the product of the two sides; the list
    of shapes is bounded by the longest path, not by the number of rows.
    """
    cuts, shorter = _cuts(longer, shorter)
    return cuts.join(shorter, "shorter").select("longer", "shorter").distinct()


def contained_texts(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """Texts of ``shorter`` that some longer text contains, as ``text``; no pairs are formed."""
    cuts, shorter = _cuts(longer, shorter)
    found = shorter.join(lookup(cuts, "shorter"), "shorter", "left_semi")
    return found.select(F.col("shorter").alias("text"))


def containing_texts(longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """Texts of ``longer`` that contain some text of ``shorter``, as ``text``."""
    cuts, shorter = _cuts(longer, shorter)
    return cuts.join(shorter, "shorter", "left_semi").select(F.col("longer").alias("text")).distinct()


def _cuts(longer: DataFrame, shorter: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(longer, shorter) candidates cut out of the longer texts, and the distinct shorter texts."""
    shorter = lookup(
        shorter.select(F.col("text").alias("shorter")).where("shorter is not null"), "shorter"
    )
    longer = longer.select(F.col("text").alias("longer")).where("longer is not null").distinct()
    slash = F.instr("shorter", "/")
    lead = F.when(slash > 1, 1).otherwise(0)
    beside = F.when(slash > 0, F.substr("shorter", slash - lead, lead + 2)).otherwise("")
    shapes = shorter.agg(
        F.collect_set(
            F.struct(
                slash.alias("slash"),
                lead.alias("lead"),
                beside.alias("beside"),
                F.length("shorter").alias("size"),
            )
        )
    ).scalar()
    text, shape = F.col("longer"), F.col("shape")
    positions = F.sequence(F.lit(1), F.length(text) + 1)
    slashes = F.filter(
        positions,
        lambda p: (F.substr(text, p, F.lit(1)) == "/")
        & (F.substr(text, p - shape["lead"], F.length(shape["beside"])) == shape["beside"]),
    )
    starts = F.when(
        shape["slash"] > 0, F.transform(slashes, lambda p: p - shape["slash"] + 1)
    ).otherwise(positions)
    cuts = (
        longer.withColumn("shape", F.explode(shapes))
        .where(shape["size"] <= F.length(text))
        .withColumn("start", F.explode(starts))
        .where(
            (F.col("start") >= 1) & (F.col("start") + shape["size"] - 1 <= F.length(text))
        )
        .select("longer", F.substr(text, F.col("start"), shape["size"]).alias("shorter"))
    )
    return cuts, shorter


def path_prefixes(path: Column) -> Column:
    """All prefixes of a path that end on a segment boundary, the path itself included. Those of a
    URI start after its authority: no location is only a scheme."""
    parts = F.split(F.rtrim(path, F.lit("/")), "/")
    first = F.when(F.contains(path, F.lit("://")), F.least(F.lit(3), F.size(parts))).otherwise(1)
    return F.transform(
        F.sequence(first, F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )
