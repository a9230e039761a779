"""The stages on a small corpus whose right result is worked out by hand."""

import pytest

import corpus_pipeline
from lakeferry.llm import lang_cnn, queries
from tests.llm.helpers import AWKWARD, awkward, empty
from tests.llm.test_jaccard import brute_force

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def models(spark):
    return {"lang": queries.language_model(spark, SF_DIR), "tox": queries.toxicity_model(spark, SF_DIR)}


@pytest.fixture
def trained(models, monkeypatch):
    monkeypatch.setattr(queries, "language_model", lambda *_: models["lang"])
    monkeypatch.setattr(queries, "toxicity_model", lambda *_: models["tox"])


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_decides_and_the_others_keep(spark, trained):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumnRenamed("n_chars", "size")
    stages = dict(corpus_pipeline.STAGES)
    languages = {r.doc_id: r for r in lang_cnn.predict(docs, queries.language_model()).collect()}
    kept = stages["language"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i, r in languages.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SURE}
    clean = stages["toxicity"](spark, kept, SF_DIR)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    gone = ids - {r.doc_id for r in clean.collect()}
    assert gone and not any(labels.get(i) == 0 for i in gone)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    once = stages["near_duplicates"](spark, clean, SF_DIR)
    assert sorted(r.doc_id for r in once.collect()) == sorted({c for _, c in brute_force(rows).values()})
    mixed = stages["mixing"](spark, once, SF_DIR)
    assert mixed.columns == docs.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, once.collect()))
    packed = stages["packing"](spark, mixed, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in once.collect()}


def test_stages_take_awkward_and_empty_tables(spark, trained):
    for frame in (awkward(spark), empty(spark)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), stage(spark, docs, SF_DIR).schema)
            if name == "language":
                assert not {r.text for r in docs.collect()} & {None, "", "1234 !!! \n\t 99"}
        assert len({r.doc_id for r in docs.collect()}) <= len(AWKWARD)


def test_run_returns_the_last_stage(spark, trained):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
    fill = rows.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 1024


def test_sequences_follow_the_mix(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(600).select("doc_id", "text", "source")
    mixed = corpus_pipeline.mixed(spark, docs, SF_DIR)
    order = [r.doc_id for r in mixed.collect()]
    for given in (corpus_pipeline.staged(mixed, "mixed"), mixed):
        rows = corpus_pipeline.packed(spark, given, SF_DIR).collect()
        firsts = {}
        for r in rows:
            firsts[r.sequence_id] = min(firsts.get(r.sequence_id, len(order)), order.index(r.doc_id))
        read = [firsts[s] for s in sorted(firsts)]
        assert read == sorted(read)
        assert {r.doc_id for r in rows} == set(order)


def test_pieces_far_apart_in_the_mix_share_no_sequence(spark):
    items = spark.range(400).selectExpr(
        "id AS doc_id", "0 AS piece", "0L AS start", "100 + id % 50 AS length", "id AS ids_crc32", "id AS position"
    )
    packs = packing_groups(corpus_pipeline.packing.pack(items, block=40).collect())
    assert max(max(g) - min(g) for g in packs) <= 40


def packing_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.sequence_id, []).append(r.doc_id)
    return groups.values()
