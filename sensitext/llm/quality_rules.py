"""Quality rules: a threshold table compiled into one projection of column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sensitext.functions.binding import bind

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

# Frequent words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for on was be with as by this are at an from or not have "
    "de la le et les des un une en que qui dans pour par sur au du est pas ne ce il elle "
    "der die das und den von zu mit ist ein eine im auf nicht el los las se por con su al "
    "del una como para es no y lo er sie dem sich des auch"
).split()
MARKS = ".,;:!?\"'()[]"


@dataclass(frozen=True)
class Rule:
    """A text fails if ``measure`` lies outside ``[least, most]``; short texts are spared."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


RULES = (
    Rule("words_too_long", "mean_word_chars", most=20.0),
    Rule("words_too_short", "mean_word_chars", least=1.5, from_words=20),
    Rule("symbols", "symbols_per_word", most=0.25),
    Rule("exclamations", "exclamations_per_word", most=0.5, from_words=20),
    Rule("stop_words", "stop_word_ratio", least=0.04, from_words=100),
    Rule("repeated_lines", "dup_line_ratio", most=0.5, from_words=20),
    Rule("bullets", "bullet_line_ratio", most=0.9, from_words=50),
    Rule("ellipses", "ellipsis_line_ratio", most=0.5, from_words=50),
)

def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words(text: Column) -> Column:
    """Maximal runs of characters that are not ASCII white space."""
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def dup_lines(text: Column) -> Column:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, SPACES) != "")
    return bind(
        lines,
        lambda x: F.struct(
            F.size(x).alias("lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("dup"),
            F.size(F.filter(x, lambda y: F.ltrim(y).rlike("^[-*•]"))).alias("bullets"),
            F.size(F.filter(x, lambda y: F.rtrim(y).rlike("(\\.\\.\\.|…)$"))).alias("ellipses"),
        ),
    )


def repeated_words(w: Column, n: int = WINDOW) -> Column:
    """Words inside windows of ``n`` words that stand in the text more than once.

    Windows are sorted, so equal ones are neighbours; the places of those that have an equal
    neighbour are sorted again, and each adds the words up to the next place.
    """
    size = F.size(w)
    windows = F.transform(
        F.sequence(F.lit(1), size - n + 1),
        lambda i: F.struct(F.array_join(F.slice(w, i, n), " ").alias("w"), i.alias("i")),
    )

    def places(s: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            back = F.try_element_at(s, F.greatest(k, F.lit(1)))["w"]
            ahead = F.try_element_at(s, k + 2)["w"]
            return ((k > 0) & (back == x["w"])) | F.coalesce(ahead == x["w"], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, k: F.least(F.lit(n), F.coalesce(F.try_element_at(p, k + 2) - x, F.lit(n)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def distinct_windows(s: Column) -> Column:
        return F.size(F.array_distinct(F.transform(s, lambda x: x["w"])))

    # Most texts repeat nothing; only the others are sorted.
    repeated = bind(
        windows,
        lambda s: F.when(distinct_windows(s) == F.size(s), 0).otherwise(
            bind(F.sort_array(s), lambda t: bind(places(t), covered))
        ),
    )
    return F.when(size > n, repeated).otherwise(0)


def measures(text: Column) -> Column:
    """Struct of all counts of one text."""
    chars = F.char_length(text)

    def counts(w: Column) -> Column:
        plain = F.transform(w, lambda x: F.lower(F.btrim(x, F.lit(MARKS))))
        stops = F.filter(plain, lambda x: x.isin(*STOP_WORDS))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(without(text, SPACES)).cast("bigint").alias("word_chars"),
            (chars - F.char_length(without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
            (chars - F.char_length(without(text, "!"))).cast("bigint").alias("n_exclamations"),
            F.size(stops).cast("bigint").alias("n_stop_words"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
            dup_lines(text).alias("line"),
        )

    return bind(words(text), counts)


def _ratios(m: Column) -> dict[str, Column]:
    per_word, per_line = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["line"]["lines"], F.lit(1))
    return {
        "mean_word_chars": m["word_chars"] / per_word,
        "symbols_per_word": m["n_symbols"] / per_word,
        "exclamations_per_word": m["n_exclamations"] / per_word,
        "stop_word_ratio": m["n_stop_words"] / per_word,
        "dup_line_ratio": m["line"]["dup"] / per_line,
        "bullet_line_ratio": m["line"]["bullets"] / per_line,
        "ellipsis_line_ratio": m["line"]["ellipses"] / per_line,
    }


def compile_rules(m: Column, rules: tuple[Rule, ...]) -> Column:
    """Names of the rules a text fails, as one array."""
    ratios = _ratios(m)
    failed = []
    for rule in rules:
        value = ratios[rule.measure]
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        failed.append(F.when(bad & (m["n_words"] >= rule.from_words), F.lit(rule.name)))
    return F.array_compact(F.array(*failed))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base verdict and verdict of all rules for every row of ``doc_id, text``.

    A null text has no words and fails; ids may be null or repeat, each row is judged alone.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    failed = (F.col("m.n_words") < MIN_WORDS) | (
        100 * F.col("m.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("m.n_words")
    )
    judged = bind(
        measures(text), lambda m: F.struct(m.alias("m"), compile_rules(m, rules).alias("failed"))
    )
    return (
        docs.select("doc_id", judged.alias("j"))
        .select("doc_id", F.col("j.m").alias("m"), F.col("j.failed").alias("failed_rules"))
        .select(
            "doc_id",
            "m.n_words",
            "m.word_chars",
            "m.n_symbols",
            F.col("m.line.dup").cast("bigint").alias("n_dup_lines"),
            "m.n_repeat_words",
            failed.alias("base_failed"),
            (~failed & (F.size("failed_rules") == 0)).alias("kept"),
            F.array_join("failed_rules", ",").alias("failed_rules"),
        )
    )
