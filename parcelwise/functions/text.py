"""Features of free review text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword lists and labels.
PRAISE = ("recomendo", "ótimo", "adorei", "excelente", "nota 10", "antes do prazo")
COMPLAINT = ("não chegou", "não recebi", "péssimo", "não gostei", "gato por lebre", "não recomendo")


def char_count(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0))


def word_count(text: Column) -> Column:
    """White-space runs plus one; 0 without text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\s+")) + 1, F.lit(0))


def all_caps(text: Column) -> Column:
    """Equal to its own upper case, so digits alone count too; false without text."""
    return F.coalesce(text == F.upper(text), F.lit(False))


def has_exclamation(text: Column) -> Column:
    return F.coalesce(text.contains("!"), F.lit(False))


def contains_any(lowered: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, [lowered.contains(word) for word in words])


def keyword_sentiment(lowered: Column, negation_first: bool = False) -> Column:
    """Label from keywords; the first list that matches wins.

    By default praise is tested first, so a negated recommendation counts as praise; ``negation_first`` swaps the order.
    """
    rules = [(PRAISE, "positivo"), (COMPLAINT, "negativo")]
    label = F.when(lowered.isNull(), "sem_comentario")
    for words, name in reversed(rules) if negation_first else rules:
        label = label.when(contains_any(lowered, words), name)
    return label.otherwise("neutro")


def score_sentiment(score: Column) -> Column:
    """A missing score is neutral."""
    return F.when(score >= 4, "positivo").when(score <= 2, "negativo").otherwise("neutro")


def coherence(score_label: Column, text_label: Column) -> Column:
    """Whether the score and the text point in opposite directions."""
    opposed = F.concat_ws("/", score_label, text_label).isin("positivo/negativo", "negativo/positivo")
    return F.when(text_label == "sem_comentario", "sem_texto").when(opposed, "divergente").otherwise("coerente")
