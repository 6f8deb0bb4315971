"""Quality rules: a table of thresholds compiled into one projection over each text. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.llm.line_dedup import free_names

#: Words are runs without ASCII white space.
WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
#: Words without any letter.
NO_LETTER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])"
#: Words in a window that counts as repeated when it stands twice in a text.
WINDOW = 5

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "with", "on", "as", "are", "was", "this", "it", "by", "an", "at", "from",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "im", "auf", "ist", "ein", "eine", "für", "des", "dem", "nicht", "sich", "als",
    "le", "la", "les", "de", "et", "en", "un", "une", "du", "que", "pour", "dans", "est", "qui", "au", "par", "sur", "pas", "plus",
    "el", "los", "las", "y", "una", "por", "con", "para", "del", "se", "es", "al", "lo", "como",
)


class Rule(NamedTuple):
    """`part` must be from `least` to `most` percent of `whole` (None: no bound) in texts of `from_words` words or more."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None
    from_words: int = 1


#: The published heuristics for web text, each as a share in percent.
RULES = (
    Rule("mean word length", "word_chars", "n_words", 200, 1200),
    Rule("symbols to words", "n_symbols", "n_words", None, 10),
    Rule("words with a letter", "n_letter_words", "n_words", 60),
    Rule("stop words", "n_stop_words", "n_words", 2, None, 50),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 30),
    Rule("bullet lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("lines cut short", "n_cut_lines", "n_lines", None, 30),
)

#: Base rules: fewer words than this, or a larger share of words in repeated windows, in percent.
FEWEST_WORDS, MOST_REPEATED = 10, 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once for a row, however often body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _count(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words of an array that stand in windows of `size` words found twice or more in it, the first ones too. Windows are
    compared by 64-bit digests: two of a text of 20,000 words agree by chance once in 10^11 texts."""
    def windows(each: Column) -> Column:
        own = F.transform(each, lambda x, i: F.when(i + size <= F.size(each), F.xxhash64(x, *(F.get(each, i + k) for k in range(1, size)))))
        return F.slice(own, 1, F.greatest(F.size(each) - size + 1, F.lit(0)))

    def covered(sorted_: Column) -> Column:
        again = F.filter(sorted_, lambda s, k: (F.get(sorted_, k - 1)["digest"] == s["digest"]) | (F.get(sorted_, k + 1)["digest"] == s["digest"]))
        places = F.array_sort(F.transform(again, lambda s: s["at"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        step = lambda acc, at: F.struct((at + size).alias("end"), (acc["n"] + at + size - F.greatest(at, acc["end"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def by_digest(d: Column) -> Column:
        sorted_ = F.sort_array(F.transform(d, lambda x, i: F.struct(x.alias("digest"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(d)) == F.size(d), F.lit(0)).otherwise(_let(sorted_, covered))

    each = F.transform(words, lambda w: F.xxhash64(w))
    return _let(_let(each, windows), by_digest).cast("long")


def measures(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """A struct of counts over a whole text: words and their characters, symbols, lines with a word and how many of them
    repeat an earlier one, begin as bullets or end in dots, stop words, words with a letter, words in repeated windows."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def counted(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            _count(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")).alias("n_bullet_lines"),
            _count(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")).alias("n_cut_lines"),
            _count(words, lambda w: F.lower(w).isin(*stop_words)).alias("n_stop_words"),
            (F.size(words) - F.regexp_count(text, F.lit(NO_LETTER))).cast("long").alias("n_letter_words"))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(SPACE))
    return _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: _let(lines, lambda own: counted(words, own)))


def broken(rule: Rule, of: Column) -> Column:
    """Whether counts break a rule; a share of nothing breaks none. Whole numbers only, so that no rounding decides."""
    part, whole = 100 * of[rule.part], of[rule.whole]
    out = F.lit(False)
    if rule.least is not None:
        out = out | (part < rule.least * whole)
    if rule.most is not None:
        out = out | (part > rule.most * whole)
    return (of["n_words"] >= rule.from_words) & (whole > 0) & out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """docs and a last column `_rules` (with more underscores where docs has it): the counts of `measures`, `base_failed`,
    `failed` (names of broken rules in the table's order) and `kept`.

    Everything is one projection: no shuffle, and a text of any length is one row's work. Null and empty texts have no words
    and fail the base rules, as all under 10 words do. Rows that repeat are judged alike, no rows give none, and other
    columns pass unchanged whatever their names.
    """
    names = F.array_compact(F.array(*(F.when(broken(r, F.col("of")), F.lit(r.name)) for r in rules))) if rules else F.array().cast("array<string>")
    base = (F.col("of.n_words") < FEWEST_WORDS) | (100 * F.col("of.n_repeat_words") > MOST_REPEATED * F.col("of.n_words"))
    out, = free_names(docs, "_rules")
    # explode of one struct keeps the counts apart: a later filter on them isn't pushed below and worked out again.
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.explode(F.array(measures(F.col(f"`{text_col}`"), stop_words))).alias("of"))
    return (row.select("row", "of", base.alias("base_failed"), names.alias("failed"))
            .select(*(F.col(f"row.`{c}`") for c in docs.columns),
                    F.struct("of.*", "base_failed", "failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept")).alias(out)))
