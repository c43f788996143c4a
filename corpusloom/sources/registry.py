"""Registry of sources: JSON to rows, lookups, seed URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "sources array<struct<id:string,agency:string,seed_urls:array<string>,reliability:double,user_demand:double,country:string,region:string,topics:array<string>,notes:string>>, "
    "language_targets map<string,double>"
)


def load(spark: SparkSession, path: str) -> DataFrame:
    """Sources with defaults, trimmed; those without id or agency are left out. ``ordinal`` is the place in the file."""
    rows = spark.read.schema(SCHEMA).json(path, multiLine=True).select(F.posexplode("sources").alias("ordinal", "s")).select("ordinal", "s.*")
    return tidy(rows)


def tidy(rows: DataFrame) -> DataFrame:
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c)
    array = lambda c: F.coalesce(F.col(c), F.expr("cast(array() as array<string>)")).alias(c)
    number = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    out = rows.select("ordinal", text("id"), text("agency"), array("seed_urls"), number("reliability"), number("user_demand"), text("country"), text("region"), array("topics"), text("notes"))
    return out.where((F.col("id") != "") & (F.col("agency") != ""))


def language_targets(spark: SparkSession, path: str) -> DataFrame:
    """language and target share."""
    return spark.read.schema(SCHEMA).json(path, multiLine=True).select(F.explode("language_targets").alias("language", "target"))


def lookup(sources: DataFrame, id: str) -> DataFrame:
    """The source of an id; of several with it the last in the file."""
    return sources.where(F.col("id") == id).orderBy(F.desc("ordinal")).limit(1)


def seed_urls(sources: DataFrame) -> DataFrame:
    return sources.select("id", F.explode("seed_urls").alias("url"))


def topics(sources: DataFrame) -> DataFrame:
    return sources.select(F.col("id").alias("source_id"), F.explode("topics").alias("topic"))


def source_config(sources: DataFrame, id: str, priority: str = "medium") -> dict:
    """The configuration that crawls carry; an unknown id is an error."""
    row = lookup(sources, id).first()
    if row is None:
        raise KeyError(id)
    keys = ("agency", "reliability", "user_demand", "country", "region", "topics")
    return {"source_id": row["id"], "priority": priority, **{k: row[k] for k in keys}}
