"""Corpus operators, stores, streams, and the registered queries against their oracles."""

from __future__ import annotations

import datetime as dt
import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import annotate, api, audit, dedup, queueing, store
from corpusloom.plans import registry
from corpusloom.sources import objects
from corpusloom.sources import registry as sources
from corpusloom.streaming import jobs

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    relation = duck.sql(registry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    places = [list(relation.columns).index(c) for c in columns]
    theirs = sorted(repr(tuple(canonical(r[i]) for i in places)) for r in relation.fetchall())
    assert sorted(repr(tuple(canonical(r[c]) for c in columns)) for r in df.collect()) == theirs


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() >= 0


def test_near_duplicates(spark):
    ten = "one two three four five six seven eight nine ten"
    rows = [(1, ten), (2, ten + " eleven"), (3, ten.upper()), (4, "a b c"), (5, None), (6, " ".join(f"w{i}" for i in range(10)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.id_a, r.id_b, round(r.similarity, 3)) for r in dedup.near_duplicates(docs).collect()] == [(1, 2, 0.909)]
    assert {r.id: r.class_id for r in dedup.classes(docs).collect()} == {1: 1, 2: 2, 3: 1, 6: 6}
    assert dedup.near_duplicates(docs, threshold=0.95).count() == 0 and dedup.near_duplicates(docs.limit(0)).count() == 0


def test_versions(spark):
    df = spark.createDataFrame([("c", i, t) for i, t in enumerate(["A", "A!", "B b", "A"])], "ctx string, ts int, text string")
    got = dedup.history(dedup.versions(df, "ctx", ["ts"]), "ctx").collect()
    assert [(r.version_number, r.ts) for r in got] == [(3, 3), (2, 2), (1, 0)] and got[0].changes_summary == "Updated from version 2" and got[2].changes_summary is None


def _queue(spark, attempts):
    now = dt.datetime(2024, 1, 1)
    rows = [("1", "https://a.org/x", "a.org", 0.5, "pending", now, now, attempts, 3)]
    return spark.createDataFrame(rows, "id string, url string, domain string, priority_score double, status string, scheduled_time timestamp, created_at timestamp, attempts int, max_attempts int")


def test_two_tries_of_three(spark):
    now, failure = F.to_timestamp(F.lit("2024-01-01 10:00:00")), spark.createDataFrame([("1", False, "e", None)], "id string, success boolean, error string, context_id string")
    q = _queue(spark, 0)
    q = queueing.transition(queueing.claim(q, q.select("id"), now), failure, now)
    row = q.first()
    assert (row.attempts, row.status, row.scheduled_time) == (2, "pending", dt.datetime(2024, 1, 1, 10, 4))
    q = queueing.transition(queueing.claim(q, q.select("id"), now), failure, now)
    assert (q.first().attempts, q.first().status) == (4, "failed")
    done = queueing.ocr_transition(_queue(spark, 0), spark.createDataFrame([("1", False, "e", None)], failure.schema), now)
    assert done.first().status == "failed"


def test_audit_of_twenty(spark):
    rows = [(lang, False, None, "dengue", None) for lang in ["sinhala"] * 10 + ["tamil"] + ["english"] * 9]
    docs = spark.createDataFrame(rows, "detected_language string, is_romanized boolean, romanized_type string, domain string, region string")
    counts, found, gaps = api.bias_report(api.Catalog(docs, docs))
    assert {(r.category_value, r.severity, r.expected_minimum) for r in found.collect()} == {
        ("tamil", "critical", 3), ("mental_health", "high", 1), ("maternal_health", "high", 1), ("child_health", "high", 1)
    }
    assert {r.category_value: r.needed for r in gaps.collect()} == {"tamil": 2, "mental_health": 1, "maternal_health": 1, "child_health": 1}
    report = audit.markdown(counts, found, 3, "2024-01-01")
    assert "- **Total Documents:** 20" in report and "- Sinhala: 10 (50.0%)" in report and "Tamil content is underrepresented: 5.0% (minimum: 15%)" in report
    empty = docs.limit(0)
    assert audit.alerts(audit.distributions(empty), audit.thresholds(spark)).count() == 0 and audit.percentages(empty).first().tamil_percentage == 0


def test_annotation(spark):
    df = annotate.annotate(spark.createDataFrame([("d1", "mage amma dengue clinic eka koheda"), ("d2", None)], "id string, text string"))
    rows = {r.id: r for r in annotate.table_columns(df).collect()}
    assert (rows["d1"].romanized_type, rows["d1"].is_romanized, rows["d1"].intent, rows["d1"].domain) == ("singlish", True, "asking_location", "dengue")
    assert rows["d2"].detected_language == "unknown" and not rows["d2"].is_romanized
    qa = annotate.qa_rows(df).collect()
    assert {r.intent for r in qa} == {"asking_location", "asking_time"} and all(not r.verified for r in qa)


def test_store_and_streams(spark, tmp_path):
    kept = store.Store(spark, str(tmp_path / "tables"))
    docs = spark.createDataFrame([(1, "Where is the dengue clinic?"), (2, "ඩෙංගු")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        jobs.annotate_stream(spark, str(tmp_path / "in"), docs.schema, kept, str(tmp_path / "chk")).awaitTermination()
    assert kept.read("raw_ingest").count() == 2
    kept.append("log", docs)
    kept.append("log", docs)
    kept.upsert("raw_ingest", kept.read("raw_ingest").where("id = 1").withColumn("intent", F.lit("x")))
    assert kept.read("log").count() == 4 and {r.intent for r in kept.read("raw_ingest").collect()} == {"x", "unknown"}
    with pytest.raises(ValueError):
        store.upsert(docs, docs.withColumn("doc_id", F.lit(None).cast("long")), "doc_id")
    queue = _queue(spark, 1)
    kept.replace("crawl_queue", queue)
    jobs.outcome_sink(kept)(spark.createDataFrame([("1", True, None, "c9")], "id string, success boolean, error string, context_id string"), 0)
    assert kept.read("crawl_queue").first().status == "completed"


def test_new_content_is_streamed_once(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), "Hello, World!"), (dt.datetime(2024, 1, 1), "hello world"), (dt.datetime(2024, 1, 1), "b")], "ts timestamp, text string")
    rows.write.parquet(str(tmp_path / "s"))
    stream = jobs.new_content(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s")))
    q = stream.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"sources": [{"id": " a ", "agency": "A", "seed_urls": ["u1", "u2"], "topics": ["t"], "reliability": 0.9}, {"id": "", "agency": "B"}, {"id": "a", "agency": "C"}], "language_targets": {"si": 0.4}}')
    s = sources.load(spark, str(tmp_path / "s.json"))
    assert s.count() == 2 and sources.lookup(s, "a").first().agency == "C" and sources.seed_urls(s).count() == 2 and sources.topics(s).count() == 1
    assert sources.source_config(s, "a")["agency"] == "C" and sources.language_targets(spark, str(tmp_path / "s.json")).count() == 1
    with pytest.raises(KeyError):
        sources.source_config(s, "zz")


def test_ocr(spark, tmp_path):
    (tmp_path / "o" / "pdfs-raw").mkdir(parents=True)
    (tmp_path / "o" / "pdfs-raw" / "a.pdf").write_bytes(b"hello from pdf ")
    entries = spark.createDataFrame([("q1", "c1", "pdf", "pdfs-raw/a.pdf"), ("q2", "c2", "pdf", "none")], "id string, context_id string, asset_type string, storage_path string")
    got = {r.id: r for r in objects.ocr(entries, objects.read_objects(spark, str(tmp_path / "o")), lambda k, c: c.decode()).collect()}
    assert (got["q1"].text, got["q1"].text_length) == ("hello from pdf", 14) and got["q2"].error == "no such object"


def test_entry_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q) and not any(x.startswith('op') or x == 'pipeline' for x in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=env).returncode == 0


def test_keys_changed_twice_keep_one_row(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    new = spark.createDataFrame([(1, "c"), (1, "d"), (3, "e"), (3, "e")], "id long, x string")
    for changed in (store.upsert(old, new), store.patch(old, new, ["x"])):
        rows = changed.collect()
        assert len({r.id for r in rows}) == len(rows) and {r.x for r in rows if r.id == 1} <= {"c", "d"}
    assert sorted(store.upsert(old, new).collect()) == sorted(store.upsert(old, new.repartition(3)).collect())
    now = F.to_timestamp(F.lit("2024-01-10"))
    queue = spark.createDataFrame([("1", "processing", 0, 3)], "id string, status string, attempts int, max_attempts int")
    outcomes = spark.createDataFrame([("1", True, None, "c"), ("1", False, "e", None)], "id string, success boolean, error string, context_id string")
    assert queueing.transition(queue, outcomes, now).count() == 1 and queueing.claim(queue, queue.select("id").union(queue.select("id")), now).count() == 1


def test_a_version_counts_once_its_pointer_is_there(spark, tmp_path):
    kept = store.Store(spark, str(tmp_path / "s"))
    kept.append("t", spark.range(3))
    kept._numbers, numbers = (lambda table: []), kept._numbers  # a second writer that saw no version
    with pytest.raises(RuntimeError):
        kept.append("t", spark.range(9))
    kept._numbers = numbers
    assert kept.read("t").count() == 3
    spark.range(5).write.parquet(str(tmp_path / "s" / "t" / "v00000001-dead"))  # a writer that died before its pointer
    assert kept.read("t").count() == 3
    kept.append("t", spark.range(2))
    assert kept.read("t").count() == 5


def test_near_duplicates_are_ranked(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.95), (2, 3, 0.9)], "id_a long, id_b long, similarity double")
    assert sorted((r.id, r.rank, r.other) for r in dedup.ranked(pairs).collect()) == [(1, 1, 3), (1, 2, 2), (2, 1, 1), (2, 2, 3), (3, 1, 1), (3, 2, 2)]


def test_near_duplicates_shuffle_no_row_for_a_token(spark):
    plan = dedup.near_duplicates(spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "AS token" not in plan


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["\u0d91\u0d9a", "\u00e9t\u00e9"]
    texts = [rng.sample(vocabulary, rng.choice([5, 8, 9, 10, 11, 19, 20, 40, 41, 99, 100, 180])) for _ in range(60)]
    for base in texts[:50]:
        for _ in range(3):
            kept = rng.sample(base, len(base) - rng.randint(0, len(base) // 8))
            texts.append(kept + rng.sample(vocabulary, rng.randint(0, len(base) // 12)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    first: dict[frozenset, int] = {}
    for i, t in enumerate(texts):
        if len(set(t)) >= 5:
            first.setdefault(frozenset(t), i)
    for threshold in (0.8, 0.9, 0.95):
        expected = {(i, j) for a, i in first.items() for b, j in first.items() if i < j and len(a & b) / len(a | b) >= threshold}
        assert {(r.id_a, r.id_b) for r in dedup.near_duplicates(docs, threshold=threshold).collect()} == expected and expected


def test_ranks_make_the_pairs_once(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9)], "id_a long, id_b long, similarity double")
    assert "Union" not in dedup.ranked(pairs)._jdf.queryExecution().optimizedPlan().toString()
