"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, let

# Frequent function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be",
    "by", "on", "are", "this", "an", "or", "from", "at",
    "der", "die", "das", "und", "zu", "den", "ist", "von", "mit", "ein", "eine", "nicht", "auf",
    "für", "im", "sich", "des", "dem", "auch", "als", "er", "es",
    "de", "la", "le", "et", "les", "du", "un", "une", "est", "en", "que", "qui", "dans", "pour",
    "au", "par", "sur", "pas", "avec", "il", "elle",
    "el", "los", "las", "y", "se", "no", "con", "su", "para", "del", "una", "lo",
)


@dataclass(frozen=True)
class Rule:
    """A text fails if ``measure`` lies outside [least, most]; None is no bound."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Bounds of the second step; measures are those of ``measures``.
RULES = (
    Rule("long enough", "n_words", least=50),
    Rule("few repeats", "repeat_ratio", most=0.5),
    Rule("word length", "mean_word", least=2.0, most=12.0),
    Rule("few symbols", "symbol_ratio", most=0.05),
    Rule("function words", "stop_ratio", least=0.04),
    Rule("few equal lines", "dup_line_ratio", most=0.5),
    Rule("few open lines", "ellipsis_ratio", most=0.5),
    Rule("few bullets", "bullet_ratio", most=0.9),
)


def _repeated(words: Column) -> Column:
    """Words inside a 3-word window whose three words occur again in the text.

    A window is known by the 64-bit hash of its words' hashes. Windows sorted by it
    stand beside their equals; the starting points of those that repeat cover three
    words each, less what the next one covers.
    """
    def of(w: Column) -> Column:
        h = F.transform(w, lambda x: F.xxhash64(x))
        return let(h, lambda v: F.zip_with(
            F.zip_with(v, F.slice(v, 2, F.size(v) - 2), lambda a, b: F.xxhash64(a, b)),
            F.slice(v, 3, F.size(v) - 2), lambda a, b: F.xxhash64(a, b)))

    def count(v: Column) -> Column:
        # The padding of the shorter arrays leaves two entries that are no windows.
        return let(F.slice(v, 1, F.size(v) - 2), lambda x: let(F.sort_array(x), lambda s: let(
            F.array_distinct(F.filter(s, lambda y, i: y == F.get(s, i + 1))), lambda d: F.when(
                F.size(d) == 0, F.lit(0)).otherwise(let(starts(x, d), covered)))))

    def starts(x: Column, twice: Column) -> Column:
        """Starting points, rising, of the windows whose hash occurs twice or more:
        a search of the list while it is short, a sort of all windows otherwise."""
        few = F.filter(F.transform(x, lambda y, i: F.when(F.array_contains(twice, y), i)), lambda i: i.isNotNull())
        pairs = F.sort_array(F.transform(x, lambda y, i: F.struct(y.alias("h"), i.alias("i"))))
        many = let(pairs, lambda s: F.sort_array(F.transform(F.filter(
            s, lambda y, i: (F.get(s, i - 1)["h"] == y["h"]) | (F.get(s, i + 1)["h"] == y["h"])),
            lambda y: y["i"])))
        return F.when(F.size(twice) <= 24, few).otherwise(many)

    def covered(q: Column) -> Column:
        return F.aggregate(F.transform(q, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(q, i + 1) - p, F.lit(3)))),
                           F.lit(0), lambda a, b: a + b)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(of(words), count))


def measures(text: Column) -> Column:
    """One struct with all measures of a text. A null text has no words and no lines."""
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, f"[{SPACE}]+", -1), "")
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))

    def of(w: Column) -> Column:
        n = F.size(w).cast("long")
        chars = F.length(F.array_join(w, "")).cast("long")
        symbols = F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long")
        stops = F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS])))
        repeats = _repeated(w).cast("long")
        return let(lines, lambda ls: let(repeats, lambda r: F.struct(
            n.alias("n_words"), chars.alias("word_chars"), symbols.alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            r.alias("n_repeat_words"),
            _ratio(r, n).alias("repeat_ratio"),
            _ratio(chars, n).alias("mean_word"), _ratio(symbols, chars).alias("symbol_ratio"),
            _ratio(stops, n).alias("stop_ratio"),
            _ratio(F.size(ls) - F.size(F.array_distinct(ls)), F.size(ls)).alias("dup_line_ratio"),
            _ratio(F.size(F.filter(ls, lambda x: x.rlike(f"(\\.\\.\\.|…)[{SPACE}]*$"))), F.size(ls)).alias("ellipsis_ratio"),
            _ratio(F.size(F.filter(ls, lambda x: x.rlike(f"^[{SPACE}]*[-*•]"))), F.size(ls)).alias("bullet_ratio"))))

    return let(words, of)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def compiled(rules: tuple[Rule, ...], values: Column) -> Column:
    """The threshold table as one condition on a struct of measures."""
    good = F.lit(True)
    for rule in rules:
        if rule.least is not None:
            good = good & (values[rule.measure] >= rule.least)
        if rule.most is not None:
            good = good & (values[rule.measure] <= rule.most)
    return good


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of every row; other columns are ignored.

    ``base_failed``: under 50 words, or over half of them in repeated 3-word windows.
    A null or empty text has measures of 0 and fails. Repeated rows each get a row.
    """
    rows = docs.select(F.col(key).alias("doc_id"), measures(F.col(text)).alias("_m"))
    failed = (F.col("_m.n_words") < 50) | (100 * F.col("_m.n_repeat_words") > 50 * F.col("_m.n_words"))
    return rows.select("doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines",
                       "_m.n_repeat_words", failed.alias("base_failed"),
                       (~failed & compiled(rules, F.col("_m"))).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes, with all their columns as they are."""
    def passes(m: Column) -> Column:
        return ((m["n_words"] >= 50) & (100 * m["n_repeat_words"] <= 50 * m["n_words"])
                & compiled(rules, m))
    return docs.where(let(measures(F.col(text)), passes))
