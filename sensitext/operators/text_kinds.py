"""Kinds of probe texts: digits alone, one repeated character, random Latin letters, or prose.

Random letters are told from prose by a model of letter pairs: the corpus says how probable each
letter is after another, and a text whose mean log-probability lies nearer to that of letters drawn
at random than to that of the corpus is noise. The model is a table of 27 x 27 counts, whatever the
corpus holds; texts are judged by column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sensitext.functions.binding import bind
from sensitext.functions.text import characters

# a to z, and what stands between words.
SYMBOLS = 27
# Shorter texts are too short to tell.
MIN_PAIRS = 8


def latin_form(text: Column) -> Column:
    """Lower-case ASCII words with single blanks between them."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(lower, "[^a-z]+", " "))


def _pairs(form: Column) -> Column:
    """Numbers of the letter pairs of a form, in order."""

    def code(letter: Column) -> Column:
        at = F.ascii(letter)
        return F.when(at == 32, SYMBOLS - 1).otherwise(at - 97)

    def paired(codes: Column) -> Column:
        rest = F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0)))
        first = F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0)))
        return F.zip_with(first, rest, lambda a, b: a * SYMBOLS + b)

    # Letters by one pass; places in a string are counted from its start each time.
    return bind(F.transform(characters(form), code), paired)


def _with_blanks(words: Column) -> Column:
    """The words of a form with the blanks around them: their letter pairs are those of the form."""
    last = F.size(words) - 1

    def padded(word: Column, i: Column) -> Column:
        before, after = F.when(i > 0, " ").otherwise(""), F.when(i < last, " ").otherwise("")
        return F.concat(before, word, after)

    return F.transform(words, padded)


@dataclass(frozen=True)
class PairModel:
    """Log-probability of each letter after another, and the mean below which a text is noise."""

    log_p: list[float]
    least: float


def fit_pairs(df: DataFrame, text_col: str = "text") -> PairModel:
    """The letter pairs of all whole texts; an empty corpus gives even probabilities."""
    form = F.coalesce(latin_form(F.col(text_col)), F.lit(""))
    words = df.select(form.alias("form")).select(
        F.explode(bind(F.split("form", " "), _with_blanks)).alias("word")
    )
    # Each distinct word is taken apart once, however often it stands in the texts.
    distinct = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    pairs = distinct.select(F.explode(bind(F.col("word"), _pairs)).alias("pair"), "n")
    counts = {r.pair: r.n for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    firsts = [sum(counts.get(a * SYMBOLS + b, 0) for b in range(SYMBOLS)) for a in range(SYMBOLS)]
    log_p = [
        math.log((counts.get(k, 0) + 1) / (firsts[k // SYMBOLS] + SYMBOLS)) for k in range(SYMBOLS**2)
    ]
    total = sum(counts.values())
    of_corpus = sum(n * log_p[k] for k, n in counts.items()) / total if total else -math.inf
    of_chance = sum(log_p) / len(log_p)
    return PairModel(log_p, (of_corpus + of_chance) / 2)


def text_kind(text: Column, model: PairModel) -> Column:
    """``blank``, ``digits``, ``repeated``, ``noise`` or ``text``; null counts as blank.

    White space is left out of account for digits and repeats. Noise is judged only where
    Latin letters make up the whole text but for white space.
    """
    table = F.array(*map(F.lit, model.log_p))
    solid = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r]+", "")

    def judged(pairs: Column) -> Column:
        mean = F.aggregate(
            pairs, F.lit(0.0), lambda total, k: total + F.element_at(table, k + 1)
        ) / F.size(pairs)
        return (F.size(pairs) >= MIN_PAIRS) & F.when(F.size(pairs) > 0, mean < model.least)

    noise = solid.rlike("^[A-Za-z]+$") & bind(
        F.coalesce(latin_form(text), F.lit("")), lambda form: bind(_pairs(form), judged)
    )
    same = F.replace(solid, F.substring(solid, F.lit(1), F.lit(1)), F.lit("")) == ""
    return (
        F.when(solid == "", "blank")
        .when(solid.rlike("^[0-9]+$"), "digits")
        .when((F.length(solid) > 1) & same, "repeated")
        .when(noise, "noise")
        .otherwise("text")
    )


def kind_counts(df: DataFrame, model: PairModel, text_col: str = "text") -> DataFrame:
    """``kind, n`` of all texts."""
    return df.groupBy(text_kind(F.col(text_col), model).alias("kind")).agg(
        F.count(F.lit(1)).alias("n")
    )
