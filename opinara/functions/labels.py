"""Label vocabularies."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw model outputs and the three classes they stand for.
THREE_CLASSES = {
    "LABEL_0": "negative",
    "LABEL_1": "neutral",
    "LABEL_2": "positive",
    "negative": "negative",
    "neutral": "neutral",
    "positive": "positive",
    "1 star": "negative",
    "2 stars": "negative",
    "3 stars": "neutral",
    "4 stars": "positive",
    "5 stars": "positive",
}

# Letters the annotators type.
ANNOTATION_LETTERS = {"n": "negative", "ne": "neutral", "p": "positive"}


def normalize_label(raw: Column) -> Column:
    """Any known raw label to positive / negative / neutral; everything else is neutral."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(THREE_CLASSES.items())])
    return F.coalesce(F.try_element_at(lookup, raw), F.lit("neutral"))


def recode_letter(value: Column) -> Column:
    """Annotation letters to class names; other values stay."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(ANNOTATION_LETTERS.items())])
    return F.coalesce(F.try_element_at(lookup, value), value)
