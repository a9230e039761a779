"""Small frames with the awkward rows every operator must take."""

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Null and repeated ids, null, empty and letterless texts, repeated rows, a very long text.
AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 1),
    (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 1),
    (1, "another text under the same number", "en", "s2", 1),
    (2, None, None, None, None),
    (3, "", "en", "s1", 0),
    (4, "1234 !!! \n\t 99", "en", None, 5),
    (None, "a row without a number but with some words in it", "en", "s1", 9),
    (None, None, None, "s1", None),
    (5, "word " * 40000, "en", "s1", 200000),
    (6, "tab\tand  two blanks \n and <|endoftext|> éß日\U0001f642", "de", "s3", 3),
]


def awkward(spark):
    """With extra columns, some of them named like columns operators make."""
    from pyspark.sql import functions as F

    return (
        spark.createDataFrame(AWKWARD, DOCS)
        .withColumn("score", F.lit("kept"))
        .withColumn("_rank", F.lit(1))
        .withColumn("key", F.lit("k"))
    )


def empty(spark):
    return spark.createDataFrame([], DOCS)


def held_out(doc_id: int, by: int, rest: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % by == rest
