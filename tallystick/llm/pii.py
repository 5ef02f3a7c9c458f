"""Personal data: fixed patterns, and a semi-Markov conditional random field beside them.

Base spans come from four patterns with their checks. The field then reads the stretches of a
text that hold an "@" or at least ``ZONE_DIGITS`` digits. A stretch is cut into atoms (letter
runs, digit runs, single other characters); a segment is one atom outside any entity, or an
entity of at most ``MAX_ATOMS`` atoms and one of the four types. A segment's score is the
product of its type's weights with features of the whole span (digit count, parts, checksum,
ends, what surrounds it), and a dynamic programme over the atoms picks boundaries and types
together. An entity is added if it touches no base span and beats the same atoms outside any
entity by ``MARGIN``.

The weights are the maximum-likelihood ones for stretches labelled by the patterns: at most
``SAMPLE_ZONES`` of them, half with and half without an entity as far as there are, out of
about ``SAMPLE_DOCS`` rows (lowest hash of id and text, repeated ones once), together with the fixed ``EXAMPLES``, which
keep every type known on a corpus that lacks it. Finding covers every whole text.

Cases: a NULL text is empty and has no span (a redacted NULL stays NULL); NULL ids and
repeated rows are ordinary rows; empty tables give no rows. Places are code points, ends
exclusive. Documents are never shuffled. The patterns run in time linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.sources.workspace import staged

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 24
ZONE_DIGITS = 7
MARGIN = 3.0
SAMPLE_DOCS = 3000
SAMPLE_ZONES = 300
KEPT_CHARS = 400  # zones to learn from, and to keep the answers of
EPOCHS = 25

# Labelled stretches, entities in braces with the initial of their type.
EXAMPLES = (
    "{e:jane.doe@mail.example.com}", "write {e:sales@example.org}, or {p:+1 (202) 555-0143}", "{i:192.0.2.17}", "host {i:198.51.100.4}:8080",
    "{c:4111 1111 1111 1111}", "{c:5500-0000-0000-0004} 11/29", "{c:340000000000009}", "{p:+49 30 5550 1234}", "{p:+33155501234}",
    "2024-05-17 10:22:31", "1234567890123456", "300.1.2.3", "version 10.4.11.2024.7", "9f86d081884c7d659a2feaa0c55ad015", "user@localhost",
    "12,345,678.90", "@handle 2023", "4111 1111 1111 1112", "{e:info@shop.example.co.uk}", "{e:a_b-c%d@x1.example.net};", "({e:k9@mail.example})",
    "{i:10.0.0.1}", "{i:172.16.254.3}, {i:8.8.4.4}", "ip={i:203.0.113.77}", "1.2.3", "3.11.0.4.2", "{p:+81 3-5550-1234}.", "{p:+12025550143} {e:x@y.example.com}",
    "{c:6011-0009-9013-9424}", "6011-0009-9013-9425", "a@b @ 12345678", "+123", "00000001 00000002",
)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|.", re.DOTALL)
_MARK = re.compile(r"[0-9@]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")  # int() refuses more than 4300 characters, leading zeros counted
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """(start, stop, kind) of the four patterns, by start, then kind as listed."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:  # a local part cannot hold an "@", so a match belongs to just one of them
        match = _DOMAIN.match(text, at)
        start = at
        while match and start > done and text[start - 1] in _LOCAL:
            start -= 1
        if match and start < at:
            done = match.end()
            found.append((start, done, "email"))
        at = text.find("@", max(at + 1, done))
    if _MARK.search(text):
        for m in _IP.finditer(text):
            if all(map(_octet, m[0].split("."))):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple:
    return span[0], KINDS.index(span[2]), span[1]


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Runs of space-separated tokens that each hold a digit or "@"; those worth decoding."""
    start = stop = -1
    for mark in _MARK.finditer(text):
        if mark.start() < stop:
            continue
        a, b = mark.start(), mark.end()
        low = max(stop, 0)
        while a > low and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if stop >= 0 and text[stop:a] in ("", " ", "  "):
            stop = b
            continue
        if stop >= 0 and _worth(text[start:stop]):
            yield start, stop
        start, stop = a, b
    if stop >= 0 and _worth(text[start:stop]):
        yield start, stop


def _worth(zone: str) -> bool:
    return "@" in zone or sum(map(zone.count, "0123456789")) >= ZONE_DIGITS


class Zone:
    """The atoms of one stretch, with the running sums that span features are made of."""

    def __init__(self, zone: str):
        atoms = _ATOM.findall(zone)
        self.ends = np.concatenate(([0], np.cumsum([len(a) for a in atoms])))
        self.size = len(atoms)
        digit = np.array([a[0] in "0123456789" for a in atoms])
        letter = np.array([a[0].isalpha() for a in atoms])
        first = np.array([a[0] for a in atoms])
        self.starts_ok = np.concatenate((digit | letter | np.isin(first, ("+", "(")), [False]))
        self.stops_ok = np.concatenate(([False], digit | letter))
        lengths = np.diff(self.ends)
        octet = np.array([d and _octet(a) for d, a in zip(digit, atoms, strict=True)])
        digits = np.array([int(c) for d, a in zip(digit, atoms, strict=True) if d for c in a], int)
        place = np.arange(len(digits)) % 2
        doubled = np.where(digits > 4, 2 * digits - 9, 2 * digits)
        self.checks = [
            np.concatenate(([0], np.cumsum(np.where(place == side, digits, doubled)))) for side in (0, 1)
        ]  # by the parity of the last digit, which is not doubled
        columns = [
            digit, digit * lengths, letter, octet,
            *(first == c for c in "@.+-"), first == " ", np.isin(first, ("(", ")")),
            ~digit & ~letter & ~np.isin(first, list("@.+- ()_%")),
        ]
        self.sums = np.concatenate((np.zeros((1, len(columns)), int), np.cumsum(np.stack(columns, 1).astype(int), 0)))
        self.digit, self.letter, self.first = digit, letter, first

    def features(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """One row of 0/1 features per span of atoms start..stop-1."""
        s = self.sums[stop] - self.sums[start]
        parts, digits, letters, octets, at, dots, plus, dashes, blanks, round_, other = s.T
        before = np.where(start > 0, start - 1, 0)
        after = np.where(stop < self.size, stop, self.size - 1)
        joins = np.isin(self.first, list(".@+-_%"))
        plain_atom = np.append(self.digit | self.letter, False)
        cut_left = (start > 1) & joins[before] & plain_atom[np.maximum(start - 2, 0)]
        cut_right = (stop < self.size) & joins[after] & plain_atom[np.minimum(stop + 1, self.size)]
        clear_left = (start == 0) | ~(self.digit[before] | self.letter[before])
        clear_right = (stop == self.size) | ~(self.digit[after] | self.letter[after])
        first, last = self.sums[start, 1], self.sums[stop, 1]
        check = np.where((last - 1) % 2 == 0, self.checks[0][last] - self.checks[0][first], self.checks[1][last] - self.checks[1][first])
        valid = (check % 10 == 0) & (digits >= 14) & (digits <= 19)
        plain = (letters == 0) & (at == 0) & (other == 0)
        card = plain & (dots == 0) & (round_ == 0) & (plus == 0)
        four = plain & (parts == 4) & (dots == 3) & (blanks + dashes + round_ + plus == 0)
        dialled = plain & (plus == 1) & (self.first[start] == "+")
        return np.stack(
            [
                np.ones(len(start), bool), at == 1, at > 1, (at == 1) & (dots > 0) & self.letter[stop - 1], (at == 1) & (blanks > 0), letters > 0, plain,
                other > 0, clear_left, clear_right, clear_left & clear_right, self.digit[stop - 1], self.digit[start], digits < 7, (digits >= 7) & (digits < 10),
                (digits >= 10) & (digits <= 13), (digits >= 14) & (digits <= 15), (digits >= 16) & (digits <= 19), digits > 19, four, four & (octets == 4),
                card, card & valid, card & ~valid, dialled, dialled & (digits >= 10) & (digits <= 15), plain & (plus == 0) & (round_ > 0), (plus > 0) & ~dialled,
                cut_left, cut_right, (at == 1) & cut_right, four & (cut_left | cut_right), card & valid & clear_left & clear_right,
            ],
            1,
        ).astype(np.float64)

    def spans(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidate entities that end at an atom boundary in (low, high]."""
        stop = np.repeat(np.arange(low + 1, high + 1), MAX_ATOMS)
        start = stop - np.tile(np.arange(1, MAX_ATOMS + 1), high - low)
        fits = (start >= 0) & self.stops_ok[stop]
        fits[fits] &= self.starts_ok[start[fits]]
        return start[fits], stop[fits]


_WIDTH = 33
_BLOCK = 1024


def decode(zone: str, weights: np.ndarray) -> list[tuple[int, int, str, float]]:
    """The best segmentation's entities (start, stop, kind, lead over no entity)."""
    z = Zone(zone)
    best = np.zeros(z.size + 1)
    back: list[tuple | None] = [None] * (z.size + 1)
    for low in range(0, z.size, _BLOCK):
        high = min(low + _BLOCK, z.size)
        start, stop = z.spans(low, high)
        scores = z.features(start, stop) @ weights.T if len(start) else np.zeros((0, len(KINDS)))
        kind, lead = scores.argmax(1) if len(start) else start, scores.max(1, initial=-np.inf)
        promising: dict[int, list] = {}
        for a, b, k, x in zip(start.tolist(), stop.tolist(), kind.tolist(), lead.tolist(), strict=True):
            if x > 0:
                promising.setdefault(b, []).append((a, k, x))
        for b in range(low + 1, high + 1):
            best[b] = best[b - 1]
            for a, k, x in promising.get(b, ()):
                if best[a] + x > best[b]:
                    best[b], back[b] = best[a] + x, (a, k, x)
    found, at = [], z.size
    while at:
        if back[at] is None:
            at -= 1
        else:
            a, k, x = back[at]
            found.append((int(z.ends[a]), int(z.ends[at]), KINDS[k], x))
            at = a
    return found[::-1]


def fit(labelled: list[tuple[str, list[Span]]], epochs: int = EPOCHS, penalty: float = 0.002) -> np.ndarray:
    """Weights (kind x feature); atoms outside entities score zero. Gradient ascent with Adam."""
    cases = []
    for zone, gold in labelled:
        z = Zone(zone)
        bounds = {int(e): i for i, e in enumerate(z.ends)}
        if z.size > 200 or not all(a in bounds and b in bounds for a, b, _ in gold):
            continue
        start, stop = z.spans(0, z.size)
        truth = np.zeros((len(start), len(KINDS)))
        for a, b, kind in gold:
            truth[(start == bounds[a]) & (stop == bounds[b]), KINDS.index(kind)] = 1
        cases.append((z.size, start, stop, z.features(start, stop), truth))
    weights = np.zeros((len(KINDS), _WIDTH))
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    order = np.random.default_rng(9)
    for _ in range(epochs):
        for n in order.permutation(len(cases)):
            size, start, stop, features, truth = cases[n]
            slope = (truth - _marginals(size, start, stop, features @ weights.T)).T @ features - penalty * weights
            step += 1
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            weights = weights + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def _marginals(size: int, start: np.ndarray, stop: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Probability of each (span, kind): forward and backward sums over segmentations."""
    if not len(start):
        return scores
    any_kind = np.logaddexp.reduce(scores, axis=1)
    by_stop: list[list[int]] = [[] for _ in range(size + 1)]
    by_start: list[list[int]] = [[] for _ in range(size + 1)]
    for i, (a, b) in enumerate(zip(start.tolist(), stop.tolist(), strict=True)):
        by_stop[b].append(i)
        by_start[a].append(i)
    forward, backward = np.zeros(size + 1), np.zeros(size + 1)
    for b in range(1, size + 1):
        i = by_stop[b]
        forward[b] = np.logaddexp.reduce(np.append(forward[start[i]] + any_kind[i], forward[b - 1]))
    for a in range(size - 1, -1, -1):
        i = by_start[a]
        backward[a] = np.logaddexp.reduce(np.append(backward[stop[i]] + any_kind[i], backward[a + 1]))
    return np.exp(scores + (forward[start] + backward[stop] - forward[size])[:, None])


def _example(marked: str) -> tuple[str, list[Span]]:
    text, gold = "", []
    for plain, initial, entity in re.findall(r"([^{]*)(?:\{(\w):([^}]*)\})?", marked):
        text += plain
        if entity:
            gold.append((len(text), len(text) + len(entity), next(k for k in KINDS if k[0] == initial)))
            text += entity
    return text, gold


def train(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_zones: int = SAMPLE_ZONES) -> np.ndarray:
    rows = documents.count()
    texts = documents.select("doc_id", "text")
    if rows > sample_docs:  # by id and text, and repeated rows once, so that no row can fill the sample
        share = int(sample_docs / rows * (1 << 32))
        texts = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) < share).distinct()
    kind = "array<struct<zone:string,start:array<int>,stop:array<int>,kind:array<string>>>"

    @F.pandas_udf(kind)
    def label(column: pd.Series) -> pd.Series:
        return pd.Series([[_labelled(t, a, b, base) for a, b in zones(t) if b - a <= KEPT_CHARS] for t in column.fillna("") for base in [base_spans(t)]])

    cut = texts.select(F.explode(label(F.col("text"))).alias("z")).select("z.*").distinct()
    cut = staged(cut, "zones").orderBy(F.xxhash64("zone"), "zone")
    labelled = [_example(e) for e in EXAMPLES] * 2
    for part in (F.size("kind") > 0, F.size("kind") == 0):
        for row in cut.where(part).limit(sample_zones // 2).collect():
            labelled.append((row["zone"], list(zip(row["start"], row["stop"], row["kind"], strict=True))))
    return fit(labelled)


def _labelled(text: str, a: int, b: int, base: list[Span]) -> dict:
    """A stretch with the base spans inside it; of overlapping spans the longer one."""
    inside: list[Span] = []
    first, end = (bisect_left(base, (place,)) for place in (a, b))
    for span in sorted((s for s in base[first:end] if s[1] <= b), key=lambda s: s[0] - s[1]):
        if all(span[1] <= s[0] or s[1] <= span[0] for s in inside):
            inside.append(span)
    starts, stops, kinds = zip(*inside, strict=True) if inside else ((), (), ())
    return {"zone": text[a:b], "start": [s - a for s in starts], "stop": [s - a for s in stops], "kind": list(kinds)}


def find(text: str, weights: np.ndarray, margin: float = MARGIN) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, by start, then kind as listed."""
    base = base_spans(text)
    starts = [s[0] for s in base]
    reach = list(accumulate((s[1] for s in base), max))  # furthest end so far
    packed = weights.tobytes()
    added = []
    for a, b in zones(text):
        decoded = _kept if b - a <= KEPT_CHARS else _decoded
        for start, stop, kind, lead in decoded(text[a:b], packed):
            before = bisect_left(starts, stop + a)
            if lead >= margin and (not before or reach[before - 1] <= start + a):
                added.append((start + a, stop + a, kind))
    return base, sorted(base + added, key=_order)


def _decoded(zone: str, weights: bytes) -> tuple:
    return tuple(decode(zone, np.frombuffer(weights).reshape(len(KINDS), _WIDTH)))


# Copies repeat their stretches, so the latest answers are kept, those of short ones.
_kept = lru_cache(1024)(_decoded)


def spans(text: Column, weights: np.ndarray, margin: float = MARGIN) -> Column:
    """struct<base, found>, each array<struct<kind, start, stop>>."""
    one = "array<struct<kind:string,start:int,stop:int>>"

    @F.pandas_udf(f"base {one}, found {one}")
    def search(column: pd.Series) -> pd.DataFrame:
        both = [find(t, weights, margin) for t in column.fillna("")]
        shown = lambda found: [{"kind": k, "start": a, "stop": b} for a, b, k in found]
        return pd.DataFrame({"base": [shown(x) for x, _ in both], "found": [shown(x) for _, x in both]}, dtype=object)

    return search(text)


def redacted(text: Column, weights: np.ndarray, margin: float = MARGIN) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its kind in angle brackets."""

    @F.pandas_udf("string")
    def replace(column: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _replaced(t, find(t, weights, margin)[1]) for t in column], dtype=object)

    return replace(text)


def _replaced(text: str, found: list[Span]) -> str:
    out, done = [], 0
    for start, stop, kind in found:
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, stop)
    return "".join(out) + text[done:]
