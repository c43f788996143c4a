"""Translation hook: a stand-in backend as an expression, and a batch hook for a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("sinhala", "tamil", "english")
_SCRIPTS = {"sin_Sinh": ("sinhala", "si"), "tam_Taml": ("tamil", "ta"), "eng_Latn": ("english", "en")}
CODES = {alias: code for code, aliases in _SCRIPTS.items() for alias in aliases}


def language_code(name: Column) -> Column:
    """The model's code for a language name; an unknown name passes through."""
    pairs = [F.lit(x) for kv in CODES.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(name)), name)


def stand_in(text: Column, target: Column | str) -> Column:
    """``[target] text``: what the stand-in backend answers."""
    return F.concat(F.lit("["), F.lit(target) if isinstance(target, str) else target, F.lit("] "), text)


def multilingual(text: Column) -> Column:
    """map of the three languages to the stand-in's translations."""
    return F.create_map(*[x for lang in LANGUAGES for x in (F.lit(lang), stand_in(text, lang))])


def with_model(df: DataFrame, load: Callable[[], Callable[[list[str]], list[str]]], text: str, into: str) -> DataFrame:
    """A translated column by a model that each task loads once; blank texts stay blank."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            texts = batch[text].fillna("").tolist()
            filled = [i for i, x in enumerate(texts) if x.strip()]
            out = [""] * len(texts)
            for i, y in zip(filled, model([texts[i] for i in filled])):
                out[i] = y
            yield batch.assign(**{into: out})

    from pyspark.sql.types import StringType, StructField, StructType

    return df.mapInPandas(run, StructType([*df.schema.fields, StructField(into, StringType())]))
