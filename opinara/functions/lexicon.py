"""Two built-in word-list scorers, as native expressions and as plain Python batch scorers.

They stand in for pretrained models, which are supplied by the user, and speak the two
vocabularies such models use: LABEL_0..2 and stars.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent words of the test prose, not opinions.
UP = ("the", "and", "a", "is", "der", "und", "das", "la", "el", "y", "le", "et")
DOWN = ("of", "to", "in", "that", "die", "den", "von", "de", "que", "en", "des", "les")
LONGEST = max(len(w) for w in UP + DOWN)


def balance(text: Column) -> Column:
    """Number of UP words minus number of DOWN words, in one pass over the blank-separated tokens."""
    return F.aggregate(
        F.split(F.lower(text), " "),
        F.lit(0),
        lambda total, word: total
        + F.when(F.octet_length(word) > LONGEST, 0)
        .when(word.isin(*UP), 1)
        .when(word.isin(*DOWN), -1)
        .otherwise(0),
    )


def three_class(score: Column) -> Column:
    return F.when(score > 0, "LABEL_2").when(score < 0, "LABEL_0").otherwise("LABEL_1")


def five_star(score: Column) -> Column:
    stars = F.greatest(F.lit(1), F.least(F.lit(5), score + 3))
    return F.when(stars == 1, "1 star").otherwise(F.concat(stars.cast("string"), F.lit(" stars")))


class WordListScorer:
    """The same lists behind the interface of a pluggable scorer: texts in, raw labels out."""

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        self.weights = {**dict.fromkeys(UP, 1), **dict.fromkeys(DOWN, -1)}

    def predict(self, texts: Sequence[str]) -> list[str]:
        return [self.label_of(w) for w in self.weigh(texts)]

    def weigh(self, texts: Sequence[str]) -> list[int]:
        return [sum(self.weights.get(t, 0) for t in text.lower().split(" ")) for text in texts]

    def label_of(self, score: int) -> str:
        if self.vocabulary == "three_class":
            return "LABEL_2" if score > 0 else "LABEL_0" if score < 0 else "LABEL_1"
        stars = min(5, max(1, score + 3))
        return "1 star" if stars == 1 else f"{stars} stars"


class UnsteadyScorer(WordListScorer):
    """Fails on some texts and gives a wrong number of answers for others, for checks of both rules."""

    def predict(self, texts: Sequence[str]) -> list[str]:
        if any(len(t) % 7 == 0 for t in texts):
            raise RuntimeError("no answer")
        return super().predict(texts) * (2 if any(len(t) % 7 == 1 for t in texts) else 1)


def unsteady_scorer() -> UnsteadyScorer:
    return UnsteadyScorer("three_class")


def three_class_scorer() -> WordListScorer:
    return WordListScorer("three_class")


def five_star_scorer() -> WordListScorer:
    return WordListScorer("five_star")
