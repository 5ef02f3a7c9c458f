"""Secret scan by character Markov models; built-in functions only.

Fixed patterns find the base spans. Beyond them, every long token is scored by two first-order
character models, one of random strings and one of ordinary identifiers: the sum over its
character pairs of log P_random(b | a) - log P_ordinary(b | a). A token is a secret if the sum
per character reaches ``PER_CHAR`` and it touches no base span.

Labelled samples: in at most about ``SAMPLE_DOCS`` documents (rows whose id and text hash lowest, repeated ones once),
what the patterns match is labelled random, and every token of the text without these matches
is labelled ordinary. Pair counts over the fixed alphabet, at most its size squared, are all
that reaches the driver; with one added to each count, a corpus without secrets gives a
uniform random model. Scanning covers every whole text.

Cases: a NULL text is empty and has no span; NULL ids and repeated rows are ordinary rows; an
empty table gives no rows. Places are code points, ends exclusive. Documents are never
shuffled, so a hot source or group of copies has no effect.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.llm.common import let, running

# The base patterns in their order of listing, and the alphabet of a token.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

KINDS = ("assign", "access", "hex", "random")
ASSIGNED_CHARS = 8
TOKEN_CHARS = 20
PER_CHAR = 0.8
SAMPLE_DOCS = 4000
_TOKEN = "[A-Za-z0-9+/_=-]"


def _span(start: Column, kind: str, stop: Column, value: Column) -> Column:
    rank = F.lit(KINDS.index(kind)).alias("rank")
    return F.struct(start.alias("start"), rank, stop.alias("stop"), F.lit(kind).alias("kind"), value.alias("value"))


def _none(kind: str) -> Column:
    return F.slice(F.array(_span(F.lit(0), kind, F.lit(0), F.lit(""))), 1, 0)


def spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Matches of the pattern as array<struct<start, rank, stop, kind, value>>.

    A regular expression cuts a text into the matches and the pieces between them, each once; a
    match starts after all that came before, so its place is a running total of lengths.
    ``keep`` filters by the second group.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    cut = [found.alias("found"), F.transform(F.split(text, pattern, -1), F.length).alias("between")]
    if keep is not None:
        cut.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("second"))

    def placed(c: Column) -> Column:
        lengths = F.zip_with(c["found"], F.slice(c["between"], F.lit(1), F.size(c["found"])), lambda f, gap: F.length(f) + gap)

        def made(stops: Column) -> Column:
            every = F.transform(c["found"], lambda value, i: _span(stops[i] - F.length(value), kind, stops[i], value))
            return every if keep is None else F.filter(every, lambda span, i: keep(c["second"][i]))

        return let(running(lengths, lambda x, y: x + y), made)

    return F.when(text.rlike(pattern), let(F.struct(*cut), placed)).otherwise(_none(kind))


def untouched(tokens: Column, base: Column) -> Column:
    """The tokens that share no place with a base span, both as ``spans`` gives them.

    Base spans are read in at their start, tokens at their end and before any span that starts
    there: a token is free if no span read in before reaches beyond the token's start.
    """
    nobody = F.lit(None)

    def merged(t: Column) -> Column:
        at = lambda place, last, reach, token: F.struct(place.alias("at"), F.lit(last).alias("last"), reach.alias("reach"), token.alias("token"))
        enter = F.transform(base, lambda b: at(b["start"], 1, b["stop"], F.when(nobody.cast("boolean"), t[0])))
        leave = F.transform(t, lambda x: at(x["stop"], 0, F.lit(0), x))

        def read(events: Column) -> Column:
            reach = running(F.transform(events, lambda e: e["reach"]), F.greatest)
            both = F.zip_with(events, reach, lambda e, r: F.struct(e["token"].alias("token"), r.alias("reach")))
            free = F.filter(both, lambda x: x["token"].isNotNull() & (x["reach"] <= x["token"]["start"]))
            return F.transform(free, lambda x: x["token"])

        return let(F.sort_array(F.concat(enter, leave)), read)

    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), let(tokens, merged)).otherwise(tokens)


def base_spans(text: Column) -> Column:
    long_enough = lambda value: F.length(value) >= ASSIGNED_CHARS
    return F.concat(spans(text, ASSIGN, "assign", long_enough), spans(text, ACCESS, "access"), spans(text, HEX, "hex"))


def _pairs(tokens: DataFrame, label: str) -> DataFrame:
    """(token) -> (label, pair, n): adjacent characters of the alphabet."""
    chars = F.split("token", "")
    pair = F.zip_with(chars, F.slice(chars, F.lit(2), F.greatest(F.length("token"), F.lit(1))), lambda a, b: F.concat(a, b))
    pairs = tokens.where(F.length("token") > 1).select(F.explode(pair).alias("pair"))
    inside = pairs.where(F.col("pair").rlike(f"^{_TOKEN}{{2}}$"))
    return inside.groupBy("pair").agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "pair", "n")


def train(documents: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratio of each character pair, row by row over the alphabet."""
    rows = documents.count()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if rows > sample_docs:  # by id and text, and repeated rows once, so that no row can fill the sample
        share = int(sample_docs / rows * (1 << 32))
        texts = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) < share).distinct()
    value = F.regexp_replace("s.value", r"""^.*?[:=]\x20*["']?""", "")
    marked = texts.select(F.explode(base_spans(F.col("text"))).alias("s"))
    random = marked.select(F.when(F.col("s.kind") == "assign", value).otherwise(F.col("s.value")).alias("token"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = texts.select(F.explode(F.regexp_extract_all(rest, F.lit(f"{_TOKEN}+"), F.lit(0))).alias("token"))
    counted = _pairs(random, "random").unionAll(_pairs(ordinary, "ordinary")).collect()
    counts = {label: Counter({r["pair"]: r["n"] for r in counted if r["label"] == label}) for label in ("random", "ordinary")}

    def log_share(label: str, a: str, b: str) -> float:
        return math.log((counts[label][a + b] + 1) / (sum(counts[label][a + c] for c in ALPHABET) + len(ALPHABET)))

    return [log_share("random", a, b) - log_share("ordinary", a, b) for a in ALPHABET for b in ALPHABET]


def ratio(token: Column, model: list[float]) -> Column:
    """Sum of the pairs' ratios over the token's length."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    chars = F.split(token, "")
    place = F.transform(chars, lambda c: F.call_function("locate", c, F.lit(ALPHABET)) - 1)
    pairs = F.zip_with(place, F.slice(place, F.lit(2), F.size(place)), lambda a, b: F.coalesce(F.get(table, a * len(ALPHABET) + b), F.lit(0.0)))
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x) / F.greatest(F.length(token), F.lit(1))


def scan(documents: DataFrame, model: list[float], token_chars: int = TOKEN_CHARS, per_char: float = PER_CHAR) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, base, found): spans in order of start, then kind.

    base: the patterns' spans; found: these and the tokens that the models call random.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    long_token = f"(?<!{_TOKEN}){_TOKEN}{{{token_chars},}}"
    marked = texts.select("doc_id", base_spans(text).alias("base"), spans(text, long_token, "random").alias("tokens"))
    added = F.filter(untouched(F.col("tokens"), F.col("base")), lambda t: ratio(t["value"], model) >= per_char)
    return marked.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", added)).alias("found"))


def listed(spans_column: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
