"""Merkle manifest against a plain recursive tree."""

import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from lakeferry.llm import manifest
from tests.llm.helpers import AWKWARD, DOCS, awkward, empty


def hashed(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def written(values) -> str:
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def proofs(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of a list of digests and each one's siblings, level by level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a : a + 8]
            for i in range(len(run)):
                for leaf in owners[a + i]:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            up.append(hashed(*run))
            up_owners.append([x for own in owners[a : a + 8] for x in own])
        nodes, owners = up, up_owners
    return nodes[0], paths


def plain(rows: list[tuple]) -> list[tuple]:
    """rows: doc_id, text, lang, source, n_chars."""
    groups: dict[str | None, list] = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = hashed(written([doc_id, source, lang, n_chars, text]))
        start = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            start = hashed(written([doc_id, source, lang, n_chars, low]))
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, start))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = {k: (sorted(groups[k]), *proofs([g[2] for g in sorted(groups[k])])) for k in order}
    root, above = proofs([built[k][1] for k in order])
    out = []
    for k, upper in zip(order, above, strict=True):
        leaves, subroot, paths = built[k]
        for (known, doc_id, leaf, start), path in zip(leaves, paths, strict=True):
            whole, fold = path + upper, start
            for left, right in whole:
                fold = hashed(left, fold, right)
            proof = hashed(*(side for step in whole for side in step))
            out.append((doc_id if known else None, leaf, subroot, root, proof, fold, fold == root))
    return out


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def same(df, rows) -> None:
    order = lambda row: tuple((x is not None, x) for x in row)
    assert sorted(map(tuple, df.collect()), key=order) == sorted(plain(rows), key=order)


def test_awkward_rows(spark):
    same(manifest.manifest(awkward(spark), tampered()), AWKWARD)
    assert manifest.manifest(empty(spark), tampered()).count() == 0


def test_one_row_has_no_siblings(spark):
    row = spark.createDataFrame(AWKWARD[:1], DOCS)
    found = manifest.manifest(row).collect()[0]
    assert found["leaf"] == found["subroot"] == found["root"] and found["verified"]
    assert found["proof_sha256"] == sha256(b"").hexdigest()


def test_hot_group_over_several_blocks_and_many_small_ones(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(1100)]
    rows += [(i, f"Text {i}", f"l{i % 70}", None, i) for i in range(1100, 1300)]
    rows += [(7, "the same", "de", "s", 1)] * 60
    same(manifest.manifest(spark.createDataFrame(rows, DOCS), tampered()), rows)


def test_places_need_no_window_over_a_group(spark):
    rows = spark.range(1000).selectExpr("'k' as key", "id % 10 as v", "id as tie")
    found = manifest.places(rows, ["v", "tie"])
    expected = sorted((i % 10, i) for i in range(1000))
    got = sorted((r["rank"], r["v"], r["tie"], r["n"]) for r in found.collect())
    assert [(v, t) for _, v, t, _ in got] == expected and [g[0] for g in got] == list(range(1000))
    assert {g[3] for g in got} == {1000}


def test_a_round_shuffles_once(spark):
    nodes = spark.range(3000).selectExpr(
        "cast(id % 2 as string) as key",
        "id div 2 as rank",
        "1500 + 0 * id as n",
        "sha2(cast(id as string), 256) as hash",
        "id as item",
    )
    plan = manifest._rolled(nodes, 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
