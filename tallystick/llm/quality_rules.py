"""Quality rules: a threshold table compiled into one projection of built-in functions.

``MEASURES`` counts things in a text, ``RULES`` bounds a count or the ratio of two counts;
``judged`` compiles both into a single struct column. Words and lines are cut once per text and
bound as arguments of a one-element ``transform``, so that no measure cuts them again. Ratios
are compared as integers (per mille times the denominator), so nothing is rounded.

Words of repeated windows are found by sorting, in n log n. A row needs memory in proportion
to its own text and no other.

Cases: a NULL or empty text has all counts 0 and fails the rule on words alone, as ratios over
nothing pass; rows are judged one by one, so repeated rows get equal verdicts, an empty table
gives no rows, and other columns are never looked at. Texts are judged whole at any length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystick.llm.common import WORD, let

WINDOW = 3
SPACES = " \t\n\x0b\f\r"  # what stands between words

# Frequent words of English, German, French and Spanish, as they stand in a
# running text; accented ones are left out.
STOP_WORDS = (
    "the of and to in is that it for on with as was by at be this are from or an "
    "der die das und den zu von mit ist im ein eine nicht auf "
    "le la les de des du et un une en que qui est dans pour par sur au "
    "el los las y se con una por del su no lo es para"
).split()


@dataclass(frozen=True)
class Rule:
    """Bounds on ``measure``, in units; with ``per``, on a thousand times their ratio."""

    name: str
    measure: str
    per: str | None = None
    least: int | None = None
    most: int | None = None


BASE_RULES = (
    Rule("too few words", "n_words", least=50),
    Rule("repeated words", "n_repeat_words", "n_words", most=500),
)
RULES = (
    *BASE_RULES,
    Rule("word length", "word_chars", "n_words", least=3000, most=10_000),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("stop words", "n_stop_words", "n_words", least=50),
    Rule("words with letters", "n_lettered_words", "n_words", least=800),
    Rule("words in capitals", "n_capital_words", "n_words", most=500),
    Rule("equal lines", "n_dup_lines", "n_lines", most=300),
    Rule("bullet lines", "n_bullet_lines", "n_lines", most=900),
    Rule("cut lines", "n_cut_lines", "n_lines", most=300),
)


def _spelled(words: Sequence[str]) -> list[str]:
    """Small, with a capital, all capitals: no text has to be lower-cased."""
    return sorted({form for w in words for form in (w, w.capitalize(), w.upper())})


def _ends_cut(line: Column) -> Column:
    return line.endswith("...") | line.endswith("…")


def _counted(items: Column, holds: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, holds))


def repeated_window_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window found twice or more among ``words``, the first one included.

    33 bits of each window's hash and its place in 31 are sorted as one number: equal windows
    share their hash, so only places with an equal neighbour are candidates. Those alone are
    compared word by word, by sorting them and looking at the neighbours again.
    """
    place_bits = 31

    def spelled(w: Column, i: Column) -> list[Column]:
        return [w[i + k] for k in range(window)]

    def beside(ordered: Column, equal: Callable[[Column, Column], Column], number: Callable[[Column], Column]) -> Column:
        """The numbers of the members that equal the one before or after them."""
        last = F.size(ordered) - 2
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda j: equal(ordered[j], ordered[j + 1]))
        return F.array_distinct(F.flatten(F.transform(starts, lambda j: F.array(number(ordered[j]), number(ordered[j + 1])))))

    def hashed(w: Column) -> Column:
        starts = F.when(F.size(w) >= window, F.sequence(F.lit(0), F.size(w) - window)).otherwise(F.array().cast("array<int>"))
        mixed = lambda i: F.shiftleft(F.xxhash64(*spelled(w, i)), place_bits).bitwiseOR(i.cast("long"))
        return F.sort_array(F.transform(starts, mixed))

    def covered(w: Column) -> Column:
        low = F.lit((1 << place_bits) - 1)
        alike = lambda x, y: F.shiftright(x.bitwiseXOR(y), place_bits) == 0
        candidates = let(hashed(w), lambda h: beside(h, alike, lambda x: x.bitwiseAND(low).cast("int")))
        windows = F.transform(candidates, lambda i: F.struct(F.concat_ws(" ", *spelled(w, i)).alias("x"), i.alias("i")))
        found = let(F.sort_array(windows), lambda s: beside(s, lambda x, y: x["x"] == y["x"], lambda x: x["i"]))
        spread = F.transform(found, lambda i: F.sequence(i, i + window - 1))
        return F.size(F.array_distinct(F.flatten(spread)))

    return let(words, covered)


# Every measure from the text, its words, and its lines that hold a word.
MEASURES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "n_words": lambda text, words, lines: F.size(words),
    "word_chars": lambda text, words, lines: F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
    "n_symbols": lambda text, words, lines: F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
    "n_dup_lines": lambda text, words, lines: F.size(lines) - F.size(F.array_distinct(lines)),
    "n_repeat_words": lambda text, words, lines: repeated_window_words(words),
    "n_stop_words": lambda text, words, lines: _counted(words, lambda w: F.rtrim(w, F.lit(".,;:!?")).isin(_spelled(STOP_WORDS))),
    "n_lettered_words": lambda text, words, lines: _counted(words, lambda w: w.rlike(r"\p{L}")),
    "n_capital_words": lambda text, words, lines: _counted(words, lambda w: ~w.rlike(r"\p{Ll}") & w.rlike(r"\p{Lu}")),
    "n_lines": lambda text, words, lines: F.size(lines),
    "n_bullet_lines": lambda text, words, lines: _counted(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•]")),
    "n_cut_lines": lambda text, words, lines: _counted(lines, lambda x: _ends_cut(F.rtrim(x, F.lit(SPACES)))),
}


def _broken(rule: Rule, measures: Column) -> Column:
    value, unit = measures[rule.measure], F.lit(1).cast("long")
    if rule.per is not None:
        value, unit = value * 1000, measures[rule.per]
    bounds = []
    if rule.least is not None:
        bounds.append(value < unit * rule.least)
    if rule.most is not None:
        bounds.append(value > unit * rule.most)
    return reduce(Column.__or__, bounds)


def judged(text: Column, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE_RULES) -> Column:
    """A struct of all measures (long), ``base_failed``, ``kept`` (no rule broken) and
    ``failed``, the names of the broken rules in the table's order."""
    whole = F.coalesce(text, F.lit(""))
    cut = F.struct(
        whole.alias("text"),
        F.array_remove(F.split(whole, f"[{SPACES}]+", -1), "").alias("words"),
        F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )

    def measured(c: Column) -> Column:
        return F.struct(*(count(c["text"], c["words"], c["lines"]).cast("long").alias(name) for name, count in MEASURES.items()))

    def verdict(m: Column) -> Column:
        names = F.array_compact(F.array(*(F.when(_broken(rule, m), F.lit(rule.name)) for rule in rules)))
        return F.struct(
            *(m[name].alias(name) for name in MEASURES),
            reduce(Column.__or__, (_broken(rule, m) for rule in base)).alias("base_failed"),
            (F.size(names) == 0).alias("kept"),
            names.alias("failed"),
        )

    return let(let(cut, measured), verdict)
