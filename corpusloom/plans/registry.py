"""All registered queries of the corpus operators, over whole tables.

Stand-ins: ``documents`` are stored texts, ``pages`` crawl results, ``conversations`` question-answer pairs
(a user turn and the assistant turn after it), ``events`` queue rows, ``benchmark`` known contents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import domains, entities, hashing, intents, language, pages, preprocess, questions, romanized, scoring, translate
from corpusloom.functions.textkit import ascii_tokens
from corpusloom.operators import annotate, api, audit, dedup, jobs, queueing, store
from corpusloom.sources import objects
from corpusloom.sources import registry as registry_source

from . import oracles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Sentences of the domain that the tables' own vocabulary lacks, so that every lexicon operator has work.
SENTENCES = (
    "mage amma dengue clinic eka koheda", "hospital time eka mokakda aney", "dengue clinic enga irukku hospital la", "naan hospital ponga theriyuma",
    "Where is the dengue clinic located?", "koheda", "mama hospital eke appointment ganna enna", "i visited national hospital for dengue treatment",
    "dengue clinic open 8:00 am monday", "crash", "Call me at 0771234567", "mail a.b@x.lk", "id 123456789v", "Go to the hosiptal", "Hi?! Bye.",
    "ඩෙංගු clinic එක කොහෙද", "ඩෙංගු සායනය විවෘතයි", "டெங்கு" " கிளினிக்", "booster dose and blood test", "National Hospital is located in Colombo. Open 24 hours.",
)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a table of fewer files than cores (one row group is one task) is dealt out to all of them."""
    d, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return d.repartition(cores) if len(d.inputFiles()) < cores else d


def with_sentences(rows: DataFrame, *columns) -> DataFrame:
    """Rows of an id, more columns and a text, and SENTENCES with ids below zero; a further column of theirs is zero."""
    spark = rows.sparkSession
    own = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(SENTENCES)], "id long, text string")
    return rows.select(*columns).union(own.select("id", *[F.lit(0)] * (len(columns) - 2), "text"))


def r6(c) -> F.Column:
    return F.round(c, 6)


# -- language and script --
@query
def language_distribution(spark, sf_dir):
    d = docs(spark, sf_dir).select(language.detect(F.col("text")).alias("l"))
    return d.groupBy(F.col("l.language").alias("language"), F.col("l.script_type").alias("script_type")).agg(F.count(F.lit(1)).alias("n"))


@query
def script_shares(spark, sf_dir):
    s = docs(spark, sf_dir).select("doc_id", language.script_shares(F.col("text")).alias("s"))
    return s.select("doc_id", *[r6(F.col(f"s.{k}")).alias(k) for k in ("sinhala", "tamil", "latin", "other")])


@query
def detect_language(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", language.detect(F.col("text")).alias("l"))
    return d.select("doc_id", "l.language", r6(F.col("l.confidence")).alias("confidence"), "l.script_type", "l.is_mixed_script", "l.dominant_script")


@query
def script_flags(spark, sf_dir):
    t = F.col("text")
    return docs(spark, sf_dir).select(
        "doc_id", language.contains_script(t, "sinhala").alias("has_sinhala"), language.contains_script(t, "tamil").alias("has_tamil"),
        language.is_native(t).alias("is_native"), F.length(language.extract_script(t, "latin")).alias("latin_chars"),
    )


# -- romanized text --
def _romanized(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", romanized.classify(F.col("text")).alias("r"))


@query
def romanized_class(spark, sf_dir):
    d = _romanized(spark, sf_dir)
    return d.select(
        "doc_id", "r.classification", *[r6(F.col(f"r.{c}")).alias(c) for c in ("confidence", "singlish_score", "tamilish_score", "english_score")],
        F.size("r.matched_markers").alias("n_matched"), romanized.translation_language(F.col("r")).alias("target"), "r.is_code_mixed",
    )


@query
def code_switches(spark, sf_dir):
    d = _romanized(spark, sf_dir).select("doc_id", F.posexplode("r.code_switches").alias("number", "s"))
    return d.select("doc_id", "number", "s.start_pos", "s.end_pos", "s.from_lang", "s.to_lang", "s.text_segment")


@query
def marker_counts(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.explode(romanized.matched_markers(ascii_tokens(F.coalesce("text", F.lit(""))))).alias("marker"))
    return d.groupBy("marker").agg(F.count(F.lit(1)).alias("n"))


# -- cleaning and personal data --
@query
def clean_text(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2(preprocess.clean(F.col("text")), 256).alias("cleaned_sha256"))


@query
def normalized_spelling(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.length(preprocess.normalize_spelling(F.col("text"))).alias("n"))


@query
def email_spans(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", preprocess.personal_data(F.coalesce("text", F.lit(""))).alias("p"))
    p = d.select("doc_id", F.explode("p").alias("m")).where("m.kind = 'EMAIL'")
    return p.select("doc_id", F.col("m.start").alias("start"), F.col("m.text").alias("email"))


@query
def pii_counts(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.explode(preprocess.personal_data(F.coalesce("text", F.lit("")))).alias("m"))
    return d.groupBy("m.kind").agg(F.count(F.lit(1)).alias("n"))


@query
def masked_texts(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", preprocess.preprocess(F.col("text")).alias("p"))
    return d.select("doc_id", F.sha2("p.cleaned", 256).alias("cleaned_sha256"), "p.pii_removed", F.size("p.pii").alias("n_pii"), F.size("p.sentences").alias("n_sentences"))


@query
def sentence_counts(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.size(preprocess.sentences(F.coalesce("text", F.lit("")))).alias("n_sentences"))


@query
def health_numbers(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", preprocess.health_numbers(F.coalesce("text", F.lit(""))).alias("h"))
    return d.select("doc_id", F.array_join("h.temperatures", "|").alias("temperatures"), F.size("h.times").alias("n_times"))


@query
def preprocess_sentences(spark, sf_dir):
    s = with_sentences(docs(spark, sf_dir), F.col("doc_id").alias("id"), "text")
    p = s.select("id", preprocess.preprocess(F.col("text")).alias("p"))
    return p.select("id", "p.cleaned", "p.pii_removed", F.array_join(F.transform("p.pii", lambda x: x["kind"]), "|").alias("kinds"), F.array_join("p.sentences", "|").alias("sentences"))


# -- intents, domains, entities, questions --
def turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


@query
def intent_primary(spark, sf_dir):
    d = turns(spark, sf_dir).select("conv_id", "turn", intents.classify(F.col("text")).alias("i"))
    return d.select("conv_id", "turn", "i.intent", r6(F.col("i.confidence")).alias("confidence"), F.size("i.matched_patterns").alias("n_patterns"))


@query
def intent_scores(spark, sf_dir):
    s = with_sentences(turns(spark, sf_dir), F.col("conv_id").alias("id"), "turn", "text")
    rows = s.select("id", "turn", F.explode(intents.scored(F.col("text"))).alias("r"))
    return rows.select("id", "turn", "r.intent", r6(F.col("r.score")).alias("score"), F.size("r.patterns").alias("n_patterns"))


@query
def domain_primary(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", domains.tag(F.col("text")).alias("d"))
    return d.select("doc_id", "d.primary_domain", r6(F.col("d.confidence")).alias("confidence"), F.size("d.keywords_found").alias("n_keywords"))


@query
def domain_tags(spark, sf_dir):
    s = with_sentences(docs(spark, sf_dir), F.col("doc_id").alias("id"), "text")
    rows = s.select("id", F.explode(domains.tag(F.col("text"))["all_domains"]).alias("d"))
    return rows.select("id", "d.domain", r6(F.col("d.confidence")).alias("confidence"), F.size("d.matched_keywords").alias("n_keywords"))


@query
def entity_rows(spark, sf_dir):
    own = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(SENTENCES)], "doc_id long, text string")
    rows = docs(spark, sf_dir).select("doc_id", "text").union(own).select("doc_id", F.explode(entities.extract(F.lower("text"))).alias("e"))
    return rows.select("doc_id", "e.start", "e.end", "e.type", "e.text", "e.normalized", "e.confidence")


@query
def entity_counts(spark, sf_dir):
    own = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(SENTENCES)], "doc_id long, text string")
    rows = docs(spark, sf_dir).select("doc_id", "text").union(own).select(F.explode(entities.counts(entities.extract(F.lower("text")))).alias("type", "n"))
    return rows.groupBy("type").agg(F.sum("n").alias("n"))


@query
def faq_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(questions.from_faq(F.col("html"))).alias("number", "p"))
    return rows.select("page_id", "number", "p.question", "p.answer", "p.confidence")


@query
def page_questions(spark, sf_dir):
    html = F.col("html")
    found = questions.first_of_each(F.concat(questions.from_faq(html), questions.from_entities(entities.extract(F.col("plain")), F.col("plain"))))
    of_pages = table(spark, sf_dir, "pages").withColumn("plain", questions.plain(html)).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.posexplode(found).alias("number", "p"))
    texts = with_sentences(docs(spark, sf_dir), F.col("doc_id").alias("id"), "text")
    of_texts = texts.select(F.lit("document").alias("kind"), "id", F.posexplode(questions.from_content(F.col("text"), entities.extract(F.col("text")))).alias("number", "p"))
    return of_pages.union(of_texts).select("kind", "id", "number", "p.question", "p.answer", "p.intent", "p.domain", "p.confidence")


# -- question-answer requests --
def qa(spark, sf_dir):
    t = turns(spark, sf_dir)
    by = Window.partitionBy("conv_id").orderBy("turn")
    rows = t.withColumn("answer_text", F.lead("text").over(by)).withColumn("next_role", F.lead("role").over(by))
    rows = rows.where("role = 'user' and next_role = 'assistant'")
    return rows.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("question_text"), "answer_text",
        F.when(F.col("conv_id") % 3 == 0, "sinhala").when(F.col("conv_id") % 3 == 1, "tamil").otherwise("english").alias("question_language"),
        F.when(F.col("conv_id") % 2 == 0, "dengue").otherwise("opd").alias("domain"), (F.col("conv_id") % 5 == 0).alias("verified"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("conv_id") * 60 + F.col("turn")).alias("created_at"),
    )


@query
def qa_filtered(spark, sf_dir):
    return api.qa_pairs(api.Catalog(None, qa(spark, sf_dir)), 20, "tamil", "opd").select("id", "question_language", "domain", "verified")


@query
def qa_review_page(spark, sf_dir):
    return api.review_page(api.Catalog(None, qa(spark, sf_dir))).select("id", "domain")


@query
def qa_verified(spark, sf_dir):
    pairs = qa(spark, sf_dir).withColumns({"reviewer_id": F.lit("a"), "review_notes": F.lit("x"), "updated_at": F.col("created_at")})
    decisions = pairs.where(F.col("domain") == "opd").select("id", F.lit("b").alias("reviewer_id"), F.lit(None).cast("string").alias("review_notes"))
    out = store.verify(pairs, decisions, F.timestamp_seconds(F.lit(1_800_000_000)))
    return out.groupBy("verified", "reviewer_id", "review_notes").agg(F.count(F.lit(1)).alias("n"))


@query
def multilingual_qa(spark, sf_dir):
    pairs = qa(spark, sf_dir).select(F.col("question_text").alias("question"), F.col("answer_text").alias("answer"), "question_language", F.lit(0.8).alias("confidence"), "id")
    return annotate.multilingual_pairs(pairs).groupBy("language", "translated").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("question")).alias("chars"), F.sum("confidence").alias("weight")).withColumn("weight", F.round("weight", 3))


@query
def stand_in_translation(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.explode(translate.multilingual(F.col("text"))).alias("language", "translated")).select("doc_id", "language", translate.language_code(F.col("language")).alias("code"), F.sha2("translated", 256).alias("translated_sha256"))


# -- hashes, duplicates, versions --
@query
def content_hashes(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", hashing.content_hash(F.col("text")).alias("content_hash"))


@query
def duplicate_groups(spark, sf_dir):
    return dedup.duplicate_groups(docs(spark, sf_dir))


@query
def duplicate_lookup(spark, sf_dir):
    known = docs(spark, sf_dir).where(F.col("source") == "src0")
    return dedup.exact_lookup(docs(spark, sf_dir).where(F.col("source") != "src0"), known, "doc_id", "doc_id")


@query
def near_duplicates(spark, sf_dir):
    return dedup.near_duplicates(docs(spark, sf_dir)).withColumn("similarity", r6(F.col("similarity")))


@query
def token_set_classes(spark, sf_dir):
    return dedup.class_rows(docs(spark, sf_dir), "doc_id", "text", 5).select(F.col("id").alias("doc_id"), "class_id", F.col("n").alias("n_tokens"))


@query
def content_versions(spark, sf_dir):
    out = dedup.versions(docs(spark, sf_dir), "source", ["doc_id"])
    return out.select("source", "doc_id", "version_number", "content_hash", "previous_hash", "changes_summary", "diff_summary")


# -- queues --
def queue(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 5 < 2, "pending").when(F.col("event_id") % 5 == 2, "processing").when(F.col("event_id") % 5 == 3, "completed").otherwise("failed")
    return e.select(
        F.col("event_id").cast("string").alias("id"), F.concat(F.lit("https://site"), F.col("user_id") % 7, F.lit(".example.org/p/"), F.col("event_id")).alias("url"),
        F.concat(F.lit("site"), F.col("user_id") % 7, F.lit(".example.org")).alias("domain"), F.col("value").alias("priority_score"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("scheduled_time"), F.col("ts").cast("timestamp").alias("created_at"), (F.col("event_id") % 4).cast("int").alias("attempts"), F.lit(3).alias("max_attempts"),
        F.lit(None).cast("string").alias("last_error"), F.when(status == "completed", F.col("ts").cast("timestamp")).alias("completed_at"), F.lit(None).cast("string").alias("context_id"),
    )


def now() -> F.Column:
    return F.to_timestamp(F.lit("2024-01-10 00:00:00"))


@query
def next_urls(spark, sf_dir):
    return queueing.next_urls(queue(spark, sf_dir), now(), 10).select("id", "priority_score", "domain")


@query
def next_urls_of_domain(spark, sf_dir):
    return queueing.next_urls(queue(spark, sf_dir), now(), 5, "site3.example.org").select("id", "priority_score")


@query
def pending_ocr(spark, sf_dir):
    return queueing.pending_ocr(queue(spark, sf_dir), 5).select("id", "status")


@query
def queue_statistics(spark, sf_dir):
    return queueing.statistics(queue(spark, sf_dir))


@query
def queue_claim(spark, sf_dir):
    q = queue(spark, sf_dir)
    return queueing.claim(q, queueing.due(q, now(), "site1.example.org").select("id"), now()).groupBy("status", "attempts").agg(F.count(F.lit(1)).alias("n"))


@query
def queue_transition(spark, sf_dir):
    q = queue(spark, sf_dir)
    number = F.col("id").cast("long")
    outcomes = q.where("status = 'processing'").select("id", (number % 3 == 0).alias("success"), F.lit("timeout").alias("error"), F.concat(F.lit("ctx"), "id").alias("context_id"))
    out = queueing.transition(q, outcomes, now())
    waited = F.when(F.col("status") == "pending", F.unix_seconds("scheduled_time") - F.unix_seconds(now()))
    return out.where("last_error is not null or context_id is not null").select("id", "status", "attempts", "last_error", "context_id", waited.alias("wait_s"))


@query
def unexpired_rows(spark, sf_dir):
    return queueing.without_expired(queue(spark, sf_dir), now(), 5).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query
def throttled_starts(spark, sf_dir):
    q = queueing.start_times(queue(spark, sf_dir).where("status = 'pending'"), 2.0)
    return q.groupBy("domain").agg(F.max("start_after").alias("last_start"), F.count(F.lit(1)).alias("n"))


@query
def new_queue_rows(spark, sf_dir):
    q = queue(spark, sf_dir)
    urls = q.where("status in ('completed', 'pending')").select("url", F.lit(0.9).alias("reliability"), F.lit(0.5).alias("user_demand"))
    return queueing.enqueue(q, urls, now()).select("url", "domain", r6(F.col("priority_score")).alias("priority_score"), "status", "attempts")


@query
def jobs_due(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.col("ts").cast("timestamp")
    last = F.lag(t).over(Window.partitionBy("user_id").orderBy("event_id"))
    return e.select("event_id", queueing.crawl_due(last, t, 12).alias("crawl_due"), queueing.audit_due(last, t).alias("audit_due"))


# -- pages --
def page_rows(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query
def priority_scores(spark, sf_dir):
    level = F.when(F.col("page_id") % 5 == 0, "critical").when(F.col("page_id") % 5 == 1, "high").when(F.col("page_id") % 5 == 2, "medium").when(F.col("page_id") % 5 == 3, "low").otherwise("other")
    score = scoring.priority(F.col("url"), level, F.col("page_id") % 45, (F.col("page_id") % 10) / 10)
    return page_rows(spark, sf_dir).select("page_id", scoring.host(F.col("url")).alias("host"), r6(score).alias("score"))


@query
def link_relevance(spark, sf_dir):
    p = page_rows(spark, sf_dir).select("page_id", "url", pages.title(F.col("html")).alias("title"))
    return p.select("page_id", "title", r6(scoring.link_relevance(F.col("url"), F.col("title"))).alias("score"))


@query
def page_links(spark, sf_dir):
    p = page_rows(spark, sf_dir).select("page_id", pages.context_object(F.col("url"), F.col("html")).alias("c"))
    return p.select(
        "page_id", F.size("c.content.links.internal").alias("n_internal"), F.size("c.content.links.external").alias("n_external"),
        F.length("c.content.html").alias("n_html"), F.col("c.provenance.domain").alias("domain"), F.col("c.provenance.source_agency").alias("agency"),
    )


@query
def relevant_links(spark, sf_dir):
    p = page_rows(spark, sf_dir).select("page_id", F.explode(pages.context_object(F.col("url"), F.col("html"))["content"]["links"]["internal"]).alias("link"))
    scored = p.withColumn("score", scoring.link_relevance(F.col("link"), F.lit("hospital clinic doctor vaccine dengue report")))
    kept = scored.where(F.col("score") > 0.5).withColumn("priority", F.when(F.col("score") > 0.8, "high").otherwise("medium"))
    return kept.groupBy("priority").agg(F.count(F.lit(1)).alias("n"))


@query
def asset_types(spark, sf_dir):
    endings = F.array(*[F.lit(x) for x in ("report.pdf", "photo.PNG", "a.jpeg", "page.html", "x.docx", "data.zip", "plain", "dir/", "a.b/c", "")])
    p = page_rows(spark, sf_dir).select("page_id", F.posexplode(endings).alias("number", "ending"))
    url = F.concat(F.lit("https://h.example.org/"), F.col("ending"))
    kind = F.when(F.col("page_id") % 4 == 0, "Application/PDF").when(F.col("page_id") % 4 == 1, "")
    return p.select(pages.asset_type(url, kind).alias("asset_type")).groupBy("asset_type").agg(F.count(F.lit(1)).alias("n"))


@query
def asset_statistics(spark, sf_dir):
    linked = F.transform(pages.links(F.col("html")), lambda x, i: F.concat(x, F.when(i % 3 == 0, ".pdf").when(i % 3 == 1, ".png").otherwise(".doc")))
    p = page_rows(spark, sf_dir).select(pages.segregate(linked, pages.images(F.col("html"))).alias("a"))
    return api.asset_statistics(p.select("a.counts.pdf", "a.counts.images", "a.ocr_required"))


@query
def allowed_pages(spark, sf_dir):
    p = page_rows(spark, sf_dir)
    site = F.concat(F.try_parse_url("url", F.lit("PROTOCOL")), F.lit("://"), scoring.host(F.col("url")))
    rules = p.where(F.col("page_id") % 2 == 0).select(site.alias("site"), F.lit("/en").alias("disallow_prefix")).distinct()
    return queueing.allowed(p, rules).select("page_id", "url")


@query
def text_chunks(spark, sf_dir):
    p = page_rows(spark, sf_dir).select("page_id", F.explode(pages.chunks(F.array_join(pages.paragraphs(F.col("html")), "\n\n"))).alias("chunk"))
    return p.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_chunks"))


# -- audits --
def audited(spark, sf_dir):
    topic = F.when(F.col("doc_id") % 50 == 0, "mental_health").when(F.col("doc_id") % 7 == 0, "dengue").when(F.col("doc_id") % 11 == 0, "")
    named = {"en": "english", "de": "sinhala", "fr": "tamil"}
    lang = F.element_at(F.create_map(*[F.lit(x) for kv in named.items() for x in kv]), F.col("lang"))
    return docs(spark, sf_dir).select(
        lang.alias("detected_language"), (F.col("doc_id") % 9 == 0).alias("is_romanized"), F.when(F.col("doc_id") % 18 == 0, "singlish").alias("romanized_type"),
        topic.alias("domain"), F.col("source").alias("region"),
    )


@query
def audit_distributions(spark, sf_dir):
    return audit.distributions(audited(spark, sf_dir))


@query
def audit_percentages(spark, sf_dir):
    p = audit.percentages(audited(spark, sf_dir))
    return p.select(*[r6(F.col(c)).alias(c) if c.endswith("percentage") else c for c in p.columns])


@query
def audit_alerts(spark, sf_dir):
    out = audit.alerts(audit.distributions(audited(spark, sf_dir)), audit.thresholds(spark))
    return out.withColumn("current_pct", r6(F.col("current_pct")))


@query
def audit_gaps(spark, sf_dir):
    out = audit.gaps(audit.alerts(audit.distributions(audited(spark, sf_dir)), audit.thresholds(spark)))
    return out.select("category_type", "category_value", "current", "needed", F.size("suggestions").alias("n_suggestions"))


@query
def language_shares(spark, sf_dir):
    return audit.shares(audit.distributions(audited(spark, sf_dir)), "language")


@query
def corpus_snapshot(spark, sf_dir):
    out = audit.snapshot(audit.distributions(audited(spark, sf_dir)), 12, "2024-01-10")
    return out.select("total_documents", "total_qa_pairs", F.size("region_distribution").alias("n_regions"), F.element_at("language_distribution", "english").alias("english"))


# -- tables and composites --
@query
def table_upsert(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "lang", "source")
    new = d.where("id % 3 = 0").select((F.col("id") * 2).alias("id"), F.lit("xx").alias("lang"), "source")
    return store.upsert(d, new)


@query
def table_patch(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.col("doc_id").alias("id"), "lang", "source")
    changes = d.where("id % 4 = 0").select("id", F.when(F.col("id") % 8 == 0, "").otherwise("yy").alias("lang"))
    return store.patch(d, changes, ["lang"], only_filled=True)


@query
def orphan_labels(spark, sf_dir):
    known = docs(spark, sf_dir).where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"))
    return store.orphans(table(spark, sf_dir, "labels"), known, "doc_id").select("doc_id", "quality", "toxic")


@query
def system_status(spark, sf_dir):
    q, pairs = queue(spark, sf_dir), qa(spark, sf_dir)
    return api.stats(api.Catalog(docs(spark, sf_dir), pairs, q))


@query
def gazetteer(spark, sf_dir):
    g = objects.gazetteer_table(spark)
    return g.groupBy("category").agg(F.count_if("is_canonical").alias("names"), F.count_if(~F.col("is_canonical")).alias("aliases"))


@query
def annotated_documents(spark, sf_dir):
    rows = annotate.table_columns(annotate.annotate(docs(spark, sf_dir).select("doc_id", "text")), "doc_id")
    return rows.select("id", "detected_language", r6(F.col("language_confidence")).alias("language_confidence"), "is_romanized", "romanized_type", "intent", "domain", F.size("entities").alias("n_entities"), "content_hash")


# -- requests, lookups and rankings --
@query
def entity_summary(spark, sf_dir):
    rows = with_sentences(docs(spark, sf_dir), F.col("doc_id").alias("id"), "text").select("id", F.explode(entities.summary(entities.extract(F.lower("text")))).alias("type", "names"))
    return rows.select("id", "type", F.array_join(F.array_sort("names"), "|").alias("names"))


@query
def dengue_keywords(spark, sf_dir):
    s = with_sentences(docs(spark, sf_dir), F.col("doc_id").alias("id"), "text")
    return s.select("id", F.array_join(domains.keywords_of(F.col("text"), "dengue"), "|").alias("keywords")).where("keywords <> ''")


@query
def domain_labels(spark, sf_dir):
    s = with_sentences(docs(spark, sf_dir), F.col("doc_id").alias("id"), "text").select(domains.tag(F.col("text"))["primary_domain"].alias("domain"))
    return s.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).select("domain", domains.description(F.col("domain")).alias("description"), "n")


@query
def intent_examples(spark, sf_dir):
    return intents.examples(spark).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


def sources(spark, sf_dir):
    """A source registry made of pages: every fifth has no agency, and ids of hosts come again."""
    p = page_rows(spark, sf_dir)
    none = F.lit(None).cast("string")
    return registry_source.tidy(p.select(
        F.col("page_id").alias("ordinal"), F.concat(F.lit(" "), scoring.host(F.col("url")), F.lit(" ")).alias("id"), F.when(F.col("page_id") % 5 > 0, F.concat(F.lit("Agency "), F.col("page_id") % 3)).alias("agency"),
        F.when(F.col("page_id") % 2 == 0, F.array("url")).alias("seed_urls"), F.when(F.col("page_id") % 3 == 0, F.lit(0.5)).alias("reliability"), F.lit(0.25).alias("user_demand"),
        none.alias("country"), F.lit(" west ").alias("region"), F.array(F.lit("a"), F.concat(F.lit("t"), F.col("page_id") % 4)).alias("topics"), none.alias("notes"),
    ))


@query
def source_rows(spark, sf_dir):
    return sources(spark, sf_dir).select("ordinal", "id", "agency", "reliability", "region", "notes", F.size("seed_urls").alias("n_seeds"))


@query
def source_seeds(spark, sf_dir):
    s = sources(spark, sf_dir)
    return registry_source.seed_urls(s).groupBy("id").agg(F.count(F.lit(1)).alias("n_urls")).join(registry_source.topics(s).groupBy(F.col("source_id").alias("id")).agg(F.count_distinct("topic").alias("n_topics")), "id", "full")


@query
def source_lookup(spark, sf_dir):
    s = sources(spark, sf_dir)
    wanted = [r[0] for r in s.select("id").distinct().orderBy("id").limit(1).collect()]
    return registry_source.lookup(s, wanted[0] if wanted else "").select("ordinal", "id", "agency")


@query
def version_history(spark, sf_dir):
    out = dedup.history(dedup.versions(docs(spark, sf_dir), "source", ["doc_id"]), "source")
    return out.groupBy("source").agg(F.max("version_number").alias("versions"), F.max_by("content_hash", "version_number").alias("latest_hash"))


@query
def latest_statistics(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("timestamp").cast("date").alias("snapshot_date")).agg(F.count(F.lit(1)).alias("total_documents"))
    return api.latest_statistics(api.Catalog(None, None, statistics=daily))


@query
def full_status(spark, sf_dir):
    linked = F.transform(pages.links(F.col("html")), lambda x: F.concat(x, F.lit(".pdf")))
    assets = page_rows(spark, sf_dir).select(pages.segregate(linked, pages.images(F.col("html"))).alias("a")).select("a.counts.pdf", "a.counts.images", "a.ocr_required")
    out = api.system_status(api.Catalog(None, None, queue(spark, sf_dir)), assets, now())
    return out.select("pending", "processing", "completed", "failed", "total", "total_documents", "pdf_assets", "image_assets", "ocr_required", F.unix_seconds("at").alias("at"))


@query
def review_cards(spark, sf_dir):
    return api.review_cards(qa(spark, sf_dir).withColumn("domain", F.when(F.col("verified"), "").otherwise(F.col("domain"))))


@query
def document_reads(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "source", hashing.content_hash(F.col("text")).alias("content_hash"))
    catalog = api.Catalog(d, None)
    known = api.document(catalog, "7").select("content_hash").first()
    return api.document(catalog, "7").union(api.by_hash(catalog, known[0] if known else "")).select("id", "source", "content_hash")


def contexts(spark, sf_dir):
    """Context objects of all pages; every second link of a page ends in .pdf here."""
    linked = F.transform(pages.links(F.col("html")), lambda x, i: F.concat(x, F.when(i % 2 == 0, ".pdf").otherwise("")))
    p = page_rows(spark, sf_dir).select(F.col("page_id").cast("string").alias("id"), "url", linked.alias("linked"), pages.context_object(F.col("url"), F.col("html")).alias("c"))
    return p.select("id", "url", "c.content", "c.provenance", pages.segregate(F.col("linked"), F.col("c.content.media.images")).alias("assets"))


@query
def discovered_links(spark, sf_dir):
    out = jobs.discovered(contexts(spark, sf_dir), above=-0.5, urgent=0.2)
    return out.select("url", r6(F.col("score")).alias("score"), "priority")


@query
def ocr_queue_rows(spark, sf_dir):
    return jobs.ocr_entries(contexts(spark, sf_dir), now()).select("context_id", "storage_path", "asset_type", "priority", "status", "max_attempts")


@query
def crawl_summary(spark, sf_dir):
    q = queue(spark, sf_dir)
    return jobs.summary(q.where("status in ('completed', 'failed')").select("id", (F.col("status") == "completed").alias("success")))


@query
def ocr_batch_counts(spark, sf_dir):
    q = queue(spark, sf_dir).where("status = 'pending'")
    read = q.select("id", F.when(F.col("attempts") == 3, "no text").alias("error"))
    return jobs.ocr_counts(read)


@query
def ocr_transition(spark, sf_dir):
    q = queue(spark, sf_dir).drop("scheduled_time")
    outcomes = q.where("status = 'processing'").select("id", (F.col("attempts") % 2 == 0).alias("success"), F.lit("blank page").alias("error"), F.lit(None).cast("string").alias("context_id"))
    return queueing.ocr_transition(q, outcomes, now()).groupBy("status", "last_error").agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").alias("attempts"))


@query
def queue_batch(spark, sf_dir):
    out = queueing.enqueue_batch(page_rows(spark, sf_dir).select("url"), now(), "high", "Ministry")
    return out.select("id", "url", "domain", "source_agency", "priority", r6(F.col("priority_score")).alias("priority_score"), "status", "max_attempts")


@query
def page_extract(spark, sf_dir):
    e = page_rows(spark, sf_dir).select("page_id", pages.extracted(F.col("html")).alias("e"))
    return e.select("page_id", "e.title", F.sha2("e.content", 256).alias("content_sha256"), "e.date")


@query
def context_fields(spark, sf_dir):
    c = page_rows(spark, sf_dir).select("page_id", pages.context_object(F.col("url"), F.col("html")).alias("c"))
    return c.select(
        "page_id", "c.provenance.source_url", "c.provenance.original_format", "c.provenance.reliability_score", F.size("c.content.media.images").alias("n_images"),
        F.size("c.content.media.videos").alias("n_videos"), "c.processing_status.ocr_required", "c.processing_status.language_detected", "c.metadata.title", "c.metadata.language",
    )


@query
def similarity_ranks(spark, sf_dir):
    out = dedup.ranked(dedup.near_duplicates(docs(spark, sf_dir)))
    return out.select("id", "other", r6(F.col("similarity")).alias("similarity"), "rank")


@query
def audit_report(spark, sf_dir):
    counts = audit.distributions(audited(spark, sf_dir))
    text = audit.markdown(counts, audit.alerts(counts, audit.thresholds(spark)), 12, "2024-01-10")
    report = text.split("## \u26a0")[0].rstrip().split("\n")
    return spark.createDataFrame(list(enumerate(report)), "number long, line string")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
