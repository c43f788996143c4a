"""The annotation pipeline over texts, and the rows it gives to each table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import domains, entities, hashing, intents, language, preprocess, questions, romanized
from corpusloom.functions.lexicons import GAZETTEER, Markers, Name

Stage = Callable[[DataFrame], DataFrame]


def stages(names: tuple[Name, ...] = GAZETTEER, markers: Markers = Markers(), generate_qa: bool = True) -> dict[str, Stage]:
    """The stages in order, each a function of DataFrames; replace or drop any of them."""
    cleaned = F.col("preprocessing")["cleaned"]
    found: dict[str, Stage] = {
        "language": lambda df: df.withColumn("language", language.detect(F.col("text"))),
        "romanized": lambda df: df.withColumn("romanized", F.when(F.col("language")["script_type"] == "latin", romanized.classify(F.col("text"), markers))),
        "preprocessing": lambda df: df.withColumn("preprocessing", preprocess.preprocess(F.col("text"), F.col("language")["language"])),
        "entities": lambda df: df.withColumn("entities", entities.extract(cleaned, names)),
        "intent": lambda df: df.withColumn("intent", intents.classify(cleaned)),
        "domain": lambda df: df.withColumn("domain", domains.tag(cleaned)),
        "content_hash": lambda df: df.withColumn("content_hash", hashing.content_hash(F.col("text"))),
    }
    if generate_qa:
        fill = lambda p: F.struct(
            p["question"].alias("question"), p["answer"].alias("answer"), F.coalesce(p["intent"], F.col("intent")["intent"]).alias("intent"),
            F.coalesce(p["domain"], F.col("domain")["primary_domain"]).alias("domain"), p["confidence"].alias("confidence"),
        )
        found["qa"] = lambda df: df.withColumn("qa_pairs", F.transform(questions.from_content(cleaned, F.col("entities")), fill))
    return found


def annotate(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with one column for each annotation; lazily, in one pass, without a shuffle."""
    df = docs if text == "text" else docs.withColumnRenamed(text, "text")
    for stage in stages(**options).values():
        df = df.transform(stage)
    return df


def table_columns(annotated: DataFrame, id: str = "id") -> DataFrame:
    """What the documents' table stores: unknown texts don't count as romanized."""
    kind = F.col("romanized")["classification"]
    return annotated.select(
        F.col(id).alias("id"), F.col("language")["language"].alias("detected_language"), F.col("language")["confidence"].alias("language_confidence"),
        F.coalesce(romanized.is_romanized(kind), F.lit(False)).alias("is_romanized"), kind.alias("romanized_type"), F.col("intent")["intent"].alias("intent"),
        F.col("domain")["primary_domain"].alias("domain"), "entities", "content_hash",
    )


def qa_rows(annotated: DataFrame, id: str = "id") -> DataFrame:
    """A row for each question-answer pair, with the language of its document."""
    rows = annotated.select(F.col(id).alias("source_context_id"), F.col("language")["language"].alias("question_language"), F.posexplode("qa_pairs").alias("number", "p"))
    key = F.sha2(F.concat_ws("\u0001", F.col("source_context_id").cast("string"), F.col("number").cast("string")), 256)
    return rows.select(
        key.alias("id"), "source_context_id", "question_language", F.col("p")["question"].alias("question_text"), F.col("p")["answer"].alias("answer_text"),
        F.col("question_language").alias("answer_language"), F.col("p")["intent"].alias("intent"), F.col("p")["domain"].alias("domain"), F.lit(False).alias("verified"),
    )


def multilingual_pairs(pairs: DataFrame) -> DataFrame:
    """Each pair and its versions in the languages it isn't in (Sinhala, Tamil, and English unless it is English)."""
    from corpusloom.functions.translate import LANGUAGES, stand_in

    own = F.col("question_language")
    targets = F.filter(F.array(*map(F.lit, LANGUAGES)), lambda x: x != own)
    rows = pairs.withColumn("target", F.explode(F.concat(F.array(F.lit(None).cast("string")), targets)))
    new = F.col("target").isNotNull()
    say = lambda c: F.when(new, stand_in(F.col(c), F.col("target"))).otherwise(F.col(c))
    return rows.select(
        say("question").alias("question"), say("answer").alias("answer"), F.coalesce("target", own).alias("language"),
        (F.col("confidence") * F.when(new, 0.9).otherwise(1.0)).alias("confidence"), new.alias("translated"),
        *[c for c in pairs.columns if c not in ("question", "answer", "question_language", "confidence")],
    )
