"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import bpe, bradley_terry, chat, host_rules, media, mixing, paragraphs, simhash, suffix, toxicity

LONG = "alpha beta gamma delta " * 20_000
ROWS = [
    (1, "one two three four five six seven eight nine ten. " * 4, "en", "a", 5), (2, None, None, None, None), (3, "", "en", "a", 0), (4, "   \n\t", "en", None, 5),
    (5, "one two three four five six seven eight nine ten. " * 4, "en", "b", 5), (5, "one two three four five six seven eight nine ten. " * 4, "en", "b", 5),
    (None, "idiot words here", "en", "a", 1), (6, LONG, "en", "a", 7), (7, "á€\U0001f600 \x00 x" * 40, "xx", "", 3), (8, "x", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = [(1, 1, 0), (2, 0, None), (3, 0, 0), (4, None, 1), (6, 1, 1), (7, 0, 0), (None, 1, 1), (8, 1, 0), (8, 1, 0)]
CLASHING = ["shard", "score", "features", "fp", "k_id", "id", "hits", "_copy", "copy", "times", "target", "size", "y", "component_id", "held_out"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("kept") for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


PER_ROW = {
    "suffix": lambda d, l: suffix.deduplicate(d), "quality": lambda d, l: bradley_terry.score(d, l), "rules": lambda d, l: host_rules.apply(d), "bpe": lambda d, l: bpe.round_trip(d),
    "simhash": lambda d, l: simhash.near_duplicates(d), "mixing": lambda d, l: mixing.mix(d), "media": lambda d, l: media.features(media.store(d)), "toxicity": lambda d, l: toxicity.score(d, l),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(name, docs, labels):
    assert PER_ROW[name](docs, labels).count() == len(ROWS)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(name, docs, labels):
    assert PER_ROW[name](docs.limit(0), labels.limit(0)).count() == 0


def test_empty_labels(docs, labels):
    assert {r.score for r in bradley_terry.score(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.predicted for r in toxicity.score(docs, labels.limit(0)).collect()} == {0}


def test_paragraphs(docs):
    rows = paragraphs.duplicates(docs).collect()
    assert {r.doc_id for r in rows} == {1, 5} and sum(not r.removed for r in rows) == 1
    assert paragraphs.duplicates(docs.limit(0)).count() == 0
    assert paragraphs.removals(docs).count() >= 1


def test_conversations(spark):
    schema = "conv_id long, turn int, role string, text string, n_turns string"
    rows = [(1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (1, None, None, "", "x"), (None, 1, "assistant", "hi", "x"), (2, 0, "assis\ntant", "[INST]" * 9999, "x")]
    found = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, schema)).collect()}
    assert found[1].n_turns == 3 and found[None].loss_chars == 2 and set(found) == {1, 2, None}
    assert chat.digests(spark.createDataFrame([], schema)).count() == 0
    assert chat.format_conversations(spark.createDataFrame(rows, schema)).count() == 3


def test_pipeline_stages(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (docs, docs.limit(0)):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, str(tmp_path))
            if name != "bpe":
                assert out.columns == docs.columns
            out.write.mode("overwrite").parquet(str(tmp_path / name))
            now = spark.read.parquet(str(tmp_path / name))


def test_keep_one_keeps_one_of_each(docs):
    kept = simhash.keep_one(docs).collect()
    texts = [r.text for r in kept]
    assert len(texts) == len(set(texts))
    assert len([r for r in kept if r.doc_id == 5]) == 0 and len([r for r in kept if r.doc_id == 1]) == 1


def test_a_cluster_needs_a_shared_folder(spark):
    from corpusloom.llm import common

    class Cluster:
        conf = type("conf", (), {"get": staticmethod(lambda key, default: "")})
        sparkContext = type("sc", (), {"master": "spark://host:7077", "_jsc": type("j", (), {"sc": staticmethod(lambda: type("s", (), {"getCheckpointDir": staticmethod(lambda: type("o", (), {"isDefined": staticmethod(lambda: False)}))}))})})

    with pytest.raises(RuntimeError):
        common.shared_folder(Cluster)
    assert common.shared_folder(spark)


def test_values_of_odd_rows(docs, labels):
    """The defined results that the docstrings state, row by row."""
    by = lambda rows, key="doc_id": {r[key]: r for r in rows.collect()}
    cut = by(suffix.deduplicate(docs))
    assert (cut[2].n_bytes, cut[2].n_removed, cut[2].n_spans) == (0, 0, 0) == (cut[3].n_bytes, cut[3].n_removed, cut[3].n_spans)
    assert cut[1].n_removed < cut[1].n_bytes and cut[5].n_removed == cut[5].n_bytes and cut[6].n_removed > 0.99 * cut[6].n_bytes and cut[None].n_removed == 0
    rules = by(host_rules.apply(docs))
    assert all(rules[i].n_words == 0 and rules[i].base_failed and not rules[i].kept for i in (2, 3, 4)) and rules[6].n_words == 80_000 and rules[6].base_failed
    tokens = by(bpe.round_trip(docs))
    assert (tokens[2].n_tokens, tokens[2].ids_sha256) == (0, tokens[3].ids_sha256) and tokens[4].n_tokens > 0
    prints = by(simhash.near_duplicates(docs), "id")
    assert {prints[i].fp for i in (2, 3, 4)} == {0} and prints[1].fp == prints[5].fp and prints[5].component_id == 1 and prints[2].component_id == prints[4].component_id == 2
    mixed = by(mixing.mix(docs))
    assert all(mixed[i].size == 0 and mixed[i].taken == 0 for i in (2, 3, 4)) and mixed[6].size == 80_000 and all(r.taken <= 3 * r.size for r in mixed.values())
    stored = by(media.features(media.store(docs)))
    assert stored[2].payload_bytes == 64 and stored[2].payload_sha256 == stored[3].payload_sha256 and stored[2].n_bytes == 0 and stored[1].feature == stored[5].feature
    quality, toxic = by(bradley_terry.score(docs, labels)), by(toxicity.score(docs, labels))
    for found in (quality, toxic):
        assert all(0 <= r.score <= 1 for r in found.values()) and found[2].score == found[3].score and found[1].score == found[5].score
