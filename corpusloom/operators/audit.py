"""Representation audits: distributions, shares, alerts, gaps, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.lexicons import THRESHOLDS
from corpusloom.functions.textkit import or_default

#: Where to look for what is missing, the last place first; anything else gets the two general hints.
_NATIONAL, _OFFICE = "http://www.health.gov.lk/", "MOH"
SUGGESTIONS: dict[tuple[str, str], tuple[str, ...]] = {
    ("domain", "maternal_health"): (f"{_OFFICE} maternal health programs", "Antenatal clinic schedules", "De Soysa Hospital for Women website"),
    ("domain", "mental_health"): ("Psychiatric ward FAQs", "Suicide prevention hotline transcripts", "National Institute of Mental Health website"),
    ("language", "sinhala"): (f"{_OFFICE} area office documents", "Sinhala health brochures", f"{_NATIONAL}si/"),
    ("language", "tamil"): ("Tamil language health hotline transcripts", "Jaffna Teaching Hospital website", f"{_NATIONAL}ta/"),
}
DIMENSIONS = ("language", "romanized", "domain", "region")


def dimensions(docs: DataFrame) -> DataFrame:
    """The audited columns with their defaults: language, romanized (null where it isn't), domain, region."""
    return docs.select(
        or_default(F.col("detected_language"), "unknown").alias("language"),
        F.when(F.col("is_romanized"), or_default(F.col("romanized_type"), "mixed")).alias("romanized"),
        or_default(F.col("domain"), "general").alias("domain"),
        or_default(F.col("region"), "unknown").alias("region"),
    )


def distributions(docs: DataFrame) -> DataFrame:
    """category_type, category_value and n, all four distributions in one pass and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(d).alias("category_type"), F.col(d).alias("category_value")) for d in DIMENSIONS])
    rows = dimensions(docs).select(F.explode(pairs).alias("p")).select("p.*").where(F.col("category_value").isNotNull())
    return rows.groupBy("category_type", "category_value").agg(F.count(F.lit(1)).alias("n"))


def percentages(docs: DataFrame) -> DataFrame:
    """One row: documents and the shares, in per cent, of three languages and of romanized texts."""
    d = dimensions(docs)
    n = F.count(F.lit(1))
    share = lambda c: F.when(n > 0, F.count_if(c) / n * 100).otherwise(0.0)
    shares = [share(F.col("language") == x).alias(f"{x}_percentage") for x in ("sinhala", "tamil", "english")]
    return d.agg(n.alias("total_documents"), *shares, share(F.col("romanized").isNotNull()).alias("romanized_percentage"))


def thresholds(spark, rows: tuple[tuple[str, str, float], ...] = THRESHOLDS) -> DataFrame:
    return spark.createDataFrame([(a, b, float(c)) for a, b, c in rows], "category_type string, category_value string, min_pct double")


def alerts(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Categories below their least share: severity, current_count, expected_minimum, share; none for an empty corpus."""
    total = counts.where("category_type = 'language'").agg(F.sum("n").alias("total"))
    # a row for each threshold and one total: both are tiny, whatever the corpus is
    base = wanted.join(F.broadcast(total)).join(counts, ["category_type", "category_value"], "left")
    pct = F.col("current_count") / F.col("total") * 100
    low = base.withColumn("current_count", F.coalesce("n", F.lit(0))).where("total > 0").withColumn("current_pct", pct).where("current_pct < min_pct")
    language = F.when(F.col("current_pct") < F.col("min_pct") / 2, "critical").otherwise("high")
    severity = F.when(F.col("category_type") == "language", language).otherwise(F.when(F.col("current_pct") > 0, "medium").otherwise("high"))
    expected = F.floor(F.col("total") * F.col("min_pct") / 100)
    return low.select("category_type", "category_value", severity.alias("severity"), "current_count", expected.alias("expected_minimum"), "current_pct", "min_pct")


def gaps(found: DataFrame) -> DataFrame:
    """Severe alerts with what is needed and where to look."""
    known = F.lit(None).cast("array<string>")
    for (kind, value), hints in SUGGESTIONS.items():
        known = F.when((F.col("category_type") == kind) & (F.col("category_value") == value), F.array(*map(F.lit, reversed(hints)))).otherwise(known)
    general = F.array(F.concat(F.lit("Search for more "), "category_value", F.lit(" content")), F.concat(F.lit("Add "), "category_value", F.lit(" sources to crawl queue")))
    severe = found.where(F.col("severity").isin("high", "critical"))
    return severe.select("category_type", "category_value", F.col("current_count").alias("current"), (F.col("expected_minimum") - F.col("current_count")).alias("needed"), F.coalesce(known, general).alias("suggestions"))


def shares(counts: DataFrame, kind: str) -> DataFrame:
    """category_value, n and its share of the distribution in per cent, to one place."""
    rows = counts.where(F.col("category_type") == kind)
    total = rows.agg(F.sum("n").alias("total"))
    return rows.join(F.broadcast(total)).select("category_value", "n", F.bround(F.col("n") * 100 / F.col("total"), 1).alias("share"))


def _title(value: Column) -> Column:
    return F.initcap(F.replace(value, F.lit("_"), F.lit(" ")))


def markdown(counts: DataFrame, found: DataFrame, qa_total: int, date: str) -> str:
    """The report as text; counts and alerts have at most some dozens of rows here."""
    rows = counts.where(F.col("category_type").isin("language", "domain")).orderBy(F.desc("n"), "category_value").collect()
    total = sum(r["n"] for r in rows if r["category_type"] == "language")
    name = lambda v: v.replace("_", " ").title()
    bold = lambda key, value: f"**{key}:** {value}"
    lines = ["# Corpus Bias Audit Report", bold("Date", date), "", "## Summary"]
    lines += ["- " + bold(f"Total {k}", f"{v:,}") for k, v in (("Documents", total), ("Q&A Pairs", qa_total))]
    for kind in ("language", "domain"):
        lines += ["", f"## {kind.title()} Distribution"]
        lines += [f"- {name(r['category_value'])}: {r['n']:,} ({r['n'] / total * 100 if total else 0:.1f}%)" for r in rows if r["category_type"] == kind]
    warned = found.orderBy(F.desc("category_type"), F.desc("min_pct"), "category_value").collect()
    if warned:
        lines += ["", f"## ⚠️ Bias Alerts ({len(warned)})"]
        mark = {"critical": "\U0001f534", "high": "\U0001f7e0"}
        for r in warned:
            what = f"content is underrepresented: {r['current_pct']:.1f}% (minimum: {r['min_pct']:g}%)" if r["category_type"] == "language" else f"content needs more coverage: {r['current_pct']:.1f}%"
            lines.append(f"- {mark.get(r['severity'], chr(0x1F7E1))} **{r['severity'].upper()}**: {name(r['category_value'])} {what}")
    return "\n".join(lines)


def snapshot(counts: DataFrame, qa_total: int, date: str) -> DataFrame:
    """One row of corpus statistics, distributions as maps."""
    of = lambda kind: F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("category_type") == kind, F.struct("category_value", "n")))))
    columns = [of(kind).alias(f"{kind}_distribution") for kind in DIMENSIONS]
    total = F.sum(F.when(F.col("category_type") == "language", F.col("n")))
    return counts.agg(total.alias("total_documents"), *columns).select(F.lit(date).cast("date").alias("snapshot_date"), "total_documents", F.lit(qa_total).alias("total_qa_pairs"), *[f"{k}_distribution" for k in DIMENSIONS])
