"""Quality rules: a threshold table compiled into Spark expressions, without user functions.

``measures`` is one projection of counts over the whole text; ``RULES``
bounds ratios of them.  A rule (name, numerator, denominator, low, high) holds
when ``low * denominator <= 100 * numerator <= high * denominator``, with
whole numbers, so that any engine agrees on it.

Repeated 8-word windows are found by 64-bit hashes of the windows of one
text; two different windows of a text of a million words share one with a
probability below 1e-7.

Defined cases: null text has no words and fails the base rule; empty and
blank texts likewise; repeated rows each get their result; all columns of the
input are kept, and result columns replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortlake.llm.common import free_name

BLANKS = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Frequent words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "was", "on", "with", "are", "as", "it",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "ist", "ein", "eine", "nicht", "im",
    "de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "una",
    "le", "les", "et", "est", "pour", "dans", "par", "au", "du",
)
#: name, numerator, denominator, low and high in percent (None: no bound)
RULES = (
    ("word_length", "word_chars", "n_words", 200, 1500),
    ("symbols", "n_symbols", "n_words", None, 10),
    ("marks", "n_marks", "n_words", None, 30),
    ("stop_words", "n_stop_words", "n_words", 2, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 40),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_marks", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, size: int = 8) -> Column:
    """How many words lie in windows of ``size`` words that the array holds twice or more."""

    def covered(hashes):
        def of_sorted(s):
            last = F.size(s) - 1
            twice = F.filter(s, lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | ((k < last) & (s[F.least(k + 1, last)]["h"] == x["h"])))
            places = F.sort_array(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            add = lambda acc, p: F.struct((acc["n"] + p + size - F.greatest(p, acc["end"])).alias("n"), (p + size).alias("end"))
            return F.aggregate(places, start, add, lambda acc: acc["n"])

        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(ordered, of_sorted))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) <= size, F.lit(0)).otherwise(let(windows, covered))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of COUNTS (long)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS + " ", "")) > 0)
    of_words = let(words, lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).alias("stop"), repeated_words(w).alias("repeat")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    w, ln, chars, symbols, marks = (free_name(docs, x) for x in ("w", "l", "chars", "symbols", "marks"))
    held = docs.select(*[c for c in docs.columns if c not in COUNTS], of_words.alias(w), of_lines.alias(ln),
        F.length(F.translate(text, BLANKS + " ", "")).alias(chars), occurrences(text, SYMBOLS).alias(symbols), occurrences(text, MARKS).alias(marks))
    values = (f"{w}.n", chars, symbols, marks, f"{w}.stop", f"{ln}.n", f"{ln}.dup", f"{w}.repeat")
    made = [F.col(v).cast("long").alias(c) for c, v in zip(COUNTS, values)]
    return held.select(*[c for c in docs.columns if c not in COUNTS], *made)


def rule(numerator: str, denominator: str, low: int | None, high: int | None) -> Column:
    value, of = 100 * F.col(numerator), F.col(denominator)
    held = F.lit(True)
    if low is not None:
        held &= value >= low * of
    if high is not None:
        held &= value <= high * of
    return held


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with the counts, base_failed, failed (names of rules) and kept."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~rule(*bounds), F.lit(name)) for name, *bounds in rules]))
    judged = measures(docs.drop("base_failed", "failed", "kept")).withColumns({"base_failed": base, "failed": failed})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
