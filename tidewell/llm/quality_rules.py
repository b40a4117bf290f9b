"""Line-first cleaning and rule-based rejection of documents (DataFrame functions only).

Every line of a text is judged on its own by the punctuation, navigation and boilerplate rules.
Failing lines are removed. A document is rejected if the base rules reject it or if the removed
lines held more than ``max_loss`` of the characters of its words.

Defined results for odd input: a null text counts as the empty text, has no words and is rejected by
the base rules; an empty table gives an empty table; repeated rows give repeated rows; further
columns of the input, whatever their names, pass through ``clean_documents`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, split_words

SYMBOLS = "[^#*$%&|<>]+"
#: A mark that ends a sentence, perhaps closed by quotes or brackets, before white space or the end.
SENTENCE_END = r"[.!?:;…。！？][\"'\)\]»”’]*(\s|$)"
BOILERPLATE = (
    r"[Aa]ll [Rr]ights [Rr]eserved|[Ll]icensed [Uu]nder|[Tt]erms [Oo]f (?:[Uu]se|[Ss]ervice)|[Pp]rivacy [Pp]olicy|[Cc]ookie"
    r"|[Jj]ava[Ss]cript|[Cc]opyright|©|[Ss]ubscribe|[Nn]ewsletter|[Cc]lick [Hh]ere|[Ll]orem [Ii]psum|[Pp]ermission is hereby granted"
)
#: The same, led by the characters that can begin one, so that the search passes over all others at once.
BOILERPLATE = rf"(?=[AaLlTtPpCcJj©SsNn])(?:{BOILERPLATE})"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the rejection that follows them."""

    max_bars: int = 3  # a line with so many vertical bars is a menu or a table
    symbols_per_words: float = 0.25  # symbols for each word of a line
    shouts_per_words: float = 0.25  # doubled exclamation marks for each word of a line
    no_end_words: int = 4  # a line of so many words needs a sentence end
    max_loss: float = 0.5  # share of the word characters that may go
    min_words: int = 20
    repeat_window: int = 8
    max_repeat_percent: int = 30


def _length_without(text: Column, regex: str) -> Column:
    return F.char_length(F.regexp_replace(text, regex, ""))


def _line(line: Column, rules: LineRules) -> Column:
    """Struct of a line: its words, its symbols, and whether a rule rejects it. Blank lines don't fail."""
    gone = lambda x, what: F.char_length(x) - F.char_length(F.replace(x, F.lit(what), F.lit("")))

    def judge(words: Column) -> Column:
        n_words = F.size(words)

        def fails(symbols: Column) -> Column:
            navigation = gone(line, "|") >= rules.max_bars
            punctuation = (
                (symbols > rules.symbols_per_words * n_words)
                | (gone(line, "!!") > 2 * rules.shouts_per_words * n_words)
                | ((n_words >= rules.no_end_words) & ~line.rlike(SENTENCE_END))
            )
            return F.struct(
                line.alias("line"),
                words.alias("words"),
                symbols.alias("symbols"),
                ((n_words > 0) & (navigation | punctuation | line.rlike(BOILERPLATE))).alias("fails"),
            )

        return let(_length_without(line, SYMBOLS), fails)

    return let(split_words(line), judge)


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    """True if a rule rejects the line; false for blank lines."""
    return _line(line, rules)["fails"]


def clean_text(text: Column, rules: LineRules = LineRules()) -> Column:
    """text without the lines that fail; null stays null."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~line_fails(x, rules)), "\n")


def repeat_words(words: Column, window: int) -> Column:
    """How many words lie in a window of so many words that occurs twice or more in the text.

    Windows are compared by the 64-bit hash of their words' hashes. The windows of one text are
    sorted, not compared pair by pair, so a long text costs n log n.
    """

    def windows(hashes: Column) -> Column:
        return F.when(
            F.size(hashes) >= window,
            F.transform(F.sequence(F.lit(0), F.size(hashes) - window), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        """Words under windows that begin at the sorted places starts."""
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def twice(pairs: Column) -> Column:
        """Places of the windows whose hash is also its neighbour's, after sorting by hash."""
        same = lambda a, b: F.coalesce(F.get(pairs, a)["h"] == F.get(pairs, b)["h"], F.lit(False))
        at = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda k: same(k, k + 1) | ((k > 0) & same(k, F.greatest(k - 1, F.lit(0)))))
        return F.sort_array(F.transform(at, lambda k: F.get(pairs, k)["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(pairs, lambda p: let(twice(p), covered))
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), count))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules(), cleaned: bool = False) -> DataFrame:
    """One row per input row: the base counts, base_failed, kept and the figures behind them.

    With cleaned, also clean: the text without the lines that fail (see clean_text). Lines are judged once.
    """
    chars = lambda words: F.char_length(F.array_join(words, "")).cast("bigint")
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def figures(lines: Column) -> Column:
        texts = F.transform(F.filter(lines, lambda x: F.size(x["words"]) > 0), lambda x: x["line"])
        return let(
            F.flatten(F.transform(lines, lambda x: x["words"])),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                chars(w).alias("word_chars"),
                total(F.transform(lines, lambda x: x["symbols"])).alias("n_symbols"),
                let(texts, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
                repeat_words(w, rules.repeat_window).alias("n_repeat_words"),
                total(F.transform(F.filter(lines, lambda x: x["fails"]), lambda x: chars(x["words"]))).alias("lost_chars"),
                *([F.array_join(F.transform(F.filter(lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean")] if cleaned else []),
            ),
        )

    lines = F.transform(F.split(F.coalesce(F.col("__text"), F.lit("")), "\n"), lambda x: _line(x, rules))
    # Unnested by explode, as a filter would else be pushed below and judge all lines a second time.
    flat = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")).select("__id", F.explode(F.array(let(lines, figures))).alias("f")).select("__id", "f.*")
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    return (
        flat.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= rules.max_loss * F.col("word_chars")))
        .withColumnRenamed("__id", id_col)
    )


def clean_documents(docs: DataFrame, text_col: str = "text", rules: LineRules = LineRules(), rewrite: bool = True) -> DataFrame:
    """The documents that the rules keep, all columns of theirs, with failing lines removed if rewrite."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = measure(docs.select(row.alias("__row"), F.col(f"`{text_col}`").alias("__t")), "__row", "__t", rules, rewrite)
    return judged.filter("kept").select(*[F.col("clean").alias(c) if rewrite and c == text_col else F.col(f"__row.`{c}`") for c in docs.columns])
