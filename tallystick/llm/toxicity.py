"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is cut into words (runs of letters and digits, lower-cased) and scored in all windows of
``WINDOW`` words, one from every word on to the last that ends with the text. A word
enters as two parts: a word embedding (one shared row for all words in fewer than
``WORD_TEXTS`` texts of the sample), and the mean embedding of its character trigrams, from a
hashed table of fixed size. Two gated recurrent units read the words in both directions,
attention weighs a window's states, and a logistic output scores the window. A text's score is
that of its highest window, so one bad passage in a long text is not averaged away.

Neighbouring windows share states: the units read blocks of ``BLOCK`` windows once, and every
window of a block pools the states of its own words. In a text of at most ``WINDOW`` words and in
training a block is one window.

Training uses a bounded sample: at most about ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` clean
rows (lowest id hash), texts of more than ``SAMPLE_CHARS`` characters left out. First all
windows of a text learn its label, in each such round at most ``FIRST_WINDOWS`` windows drawn anew,
then only its highest windows do, round by round, which is how a text is scored; windows to learn
from start every ``STRIDE`` words. Only texts and the toxic mark are inputs. Scoring covers all
windows of every whole text, in groups of texts of bounded size.

Cases: a text that is NULL or has no word scores 0, as does every text if the sample lacks
either class; NULL marks are not learned from; equal texts are learned from once, by the last
of their marks (a clean one, where they contradict each other); NULL ids and repeated rows are
ordinary rows; an empty table gives no rows. Documents are never shuffled.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystick.sources.workspace import staged

WINDOW = 40
STRIDE = 20
BLOCK = 80
FIRST_WINDOWS = 12_000
SAMPLE_TOXIC = 700
SAMPLE_CLEAN = 900
SAMPLE_CHARS = 6000
WORD_BITS, WORD_ROWS, WORD_TEXTS = 20, 1 << 14, 6
CHAR_ROWS = 1 << 13
UNSEEN = 0.3
WORD_SIZE, CHAR_SIZE, HIDDEN, ATTEND = 8, 8, 8, 8
ROUNDS = (1, 8)
DECAY = 0.1
CHECK_SHARE = 4
_GROUP_CHARS = 400_000
_WINDOWS = 4096
_BLOCKS = 1024
_PLACES = 32
_LETTERS = 128


def _classes() -> np.ndarray:
    """Class of each 16-bit code unit: 0 outside words, a-z and digits apart, the rest hashed."""
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        if chr(code).isalnum() or 0xD800 <= code < 0xE000:
            table[code] = code - 96 if 97 <= code <= 122 else code - 20 if 48 <= code <= 57 else 38 + code % (_LETTERS - 38)
    return table


_CLASS = _classes()
_PLACED = np.random.default_rng(3).integers(0, 2**64, (_PLACES, _LETTERS), np.uint64)


class Words:
    """The words of some texts: table rows of word and trigrams, and each text's word range."""

    def __init__(self, texts: list[str]):
        parts = [np.frombuffer(t.lower().encode("utf-16-le", "replace"), "<u2") for t in texts]
        gap = np.zeros(1, "<u2")
        units = np.concatenate([gap, *(x for part in parts for x in (part, gap))])
        classes = _CLASS[units]
        inside = classes > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        place = np.flatnonzero(inside)
        self.starts = np.flatnonzero(first[place])
        self.lengths = np.diff(np.append(self.starts, len(place)))
        wide = classes.astype(np.uint32)
        code = (wide[place - 1] * _LETTERS + wide[place]) * _LETTERS + wide[place + 1]
        self.trigrams = ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int32)
        within = np.minimum(np.arange(len(place)) - np.repeat(self.starts, self.lengths), _PLACES - 1)
        if len(place):
            mixed = np.add.reduceat(_PLACED[within, classes[place]], self.starts) * np.uint64(0x9E3779B97F4A7C15)
        else:
            mixed = np.zeros(0, np.uint64)
        self.hashes = (mixed >> np.uint64(64 - WORD_BITS)).astype(np.int32)
        ends = np.cumsum([1, *(len(p) + 1 for p in parts)])
        self.bounds = np.searchsorted(place[self.starts], ends)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, number of words) of the windows to learn from; texts without words have none."""
        text, start, size = [], [], []
        for number, (a, b) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)):
            at = [*range(a, max(b - WINDOW, a), STRIDE), max(b - WINDOW, a)] if b > a else []
            start += at
            text += [number] * len(at)
            size += [min(WINDOW, b - a)] * len(at)
        return np.array(text, np.int64), np.array(start, np.int64), np.array(size, np.int64)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, number of words) of blocks; each window lies whole in exactly one."""
        words = np.diff(self.bounds)
        windows = np.where(words > 0, np.maximum(words - WINDOW, 0) + 1, 0)
        each = -(-windows // BLOCK)
        text = np.repeat(np.arange(len(words)), each)
        at = BLOCK * (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each))
        size = np.minimum(words[text], np.minimum(BLOCK, windows[text] - at) + WINDOW - 1)
        return text, self.bounds[text] + at, size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    def __init__(self, seed: int = 2):
        self.scale, self.offset = 1.0, 0.0
        self.known = np.zeros(1 << WORD_BITS, np.int32)
        draw = np.random.default_rng(seed)
        width = WORD_SIZE + CHAR_SIZE
        shape = {
            "word": (WORD_ROWS, WORD_SIZE), "char": (CHAR_ROWS, CHAR_SIZE),
            "in_f": (width, 3 * HIDDEN), "in_b": (width, 3 * HIDDEN), "bias_f": (3 * HIDDEN,), "bias_b": (3 * HIDDEN,),
            "loop_f": (HIDDEN, 3 * HIDDEN), "loop_b": (HIDDEN, 3 * HIDDEN),
            "attend": (2 * HIDDEN, ATTEND), "focus": (ATTEND,), "out": (2 * HIDDEN,), "shift": (1,),
        }
        scale = {"word": 0.3, "char": 0.5, "bias_f": 0.0, "bias_b": 0.0, "shift": 0.0}
        self.p = {k: (draw.standard_normal(s) * scale.get(k, 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shape.items()}

    def inputs(self, words: Words) -> np.ndarray:
        """One row per word: its embedding and the mean embedding of its trigrams."""
        if not len(words.hashes):
            return np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)
        chars = np.add.reduceat(self.p["char"][words.trigrams], words.starts) / words.lengths[:, None].astype(np.float32)
        return np.concatenate((self.p["word"][self.known[words.hashes]], chars), 1)

    def states(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, keep: dict | None = None) -> tuple[np.ndarray, ...]:
        """(states, attention's hidden layer and weights before normalising) at each step of some stretches of words."""
        steps = int(size.max())
        at = np.minimum(np.arange(steps), (size - 1)[:, None]) + start[:, None]
        real = (np.arange(steps) < size[:, None]).astype(np.float32)
        states = np.empty((steps, len(start), 2 * HIDDEN), np.float32)
        for side, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            ready = x @ self.p[f"in_{side}"] + self.p[f"bias_{side}"]
            h, trace = np.zeros((len(start), HIDDEN), np.float32), []
            for t in order:
                p, g = ready[at[:, t]], h @ self.p[f"loop_{side}"]
                gates = _sigmoid(p[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                n = np.tanh(p[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                if keep is not None:
                    trace.append((t, h, z, r, n, g[:, 2 * HIDDEN :]))
                h = h + real[:, t, None] * (1 - z) * (n - h)
                states[t, :, HIDDEN * (side == "b") : HIDDEN * (side == "b") + HIDDEN] = h
            if keep is not None:
                keep[side] = trace
        hidden = np.tanh(states @ self.p["attend"])
        weight = hidden @ self.p["focus"] + np.where(real.T > 0, 0, -1e9).astype(np.float32)
        weight = np.exp(weight - weight.max(0))
        if keep is not None:
            keep |= {"at": at, "real": real}
        return states, hidden, weight

    def run(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log-odds of each window; ``keep`` receives what the backward pass needs."""
        states, hidden, weight = self.states(x, start, size, keep)
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        if keep is not None:
            keep |= {"states": states, "hidden": hidden, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["shift"][0]

    def highest(self, x: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Log-odds of the highest window of each block."""
        states, _, weight = self.states(x, start, size)
        weight = weight.astype(np.float64)
        value = weight * (states @ self.p["out"])
        width = min(WINDOW, len(weight))
        weights, values = (np.lib.stride_tricks.sliding_window_view(v, width, axis=0).sum(-1) for v in (weight, value))
        # A block shorter than the longest one has fewer windows; one shorter than a window has one.
        inside = np.arange(len(weights))[:, None] <= np.maximum(size - width, 0)
        odds = np.where(inside, values / np.maximum(weights, 1e-300), -np.inf)
        return odds.max(0) + self.p["shift"][0]

    def slopes(self, x: np.ndarray, words: Words, keep: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the loss whose slope by the log-odds is ``error``."""
        p = self.p
        at, real, states, hidden, weight = keep["at"], keep["real"], keep["states"], keep["hidden"], keep["weight"]
        slope = {"out": keep["pooled"].T @ error, "shift": np.array([error.sum()], np.float32)}
        by_pool = error[:, None] * p["out"]
        by_weight = (states * by_pool).sum(2)
        by_weight = weight * (by_weight - (weight * by_weight).sum(0))
        slope["focus"] = np.tensordot(by_weight, hidden, ([0, 1], [0, 1]))
        by_hidden = by_weight[:, :, None] * p["focus"] * (1 - hidden**2)
        slope["attend"] = np.tensordot(states, by_hidden, ([0, 1], [0, 1]))
        by_state = weight[:, :, None] * by_pool + by_hidden @ p["attend"].T
        by_x = np.zeros_like(x)
        for side in "fb":
            loop, entry = p[f"loop_{side}"], p[f"in_{side}"]
            low = HIDDEN * (side == "b")
            by_h = np.zeros((len(error), HIDDEN), np.float32)
            for name in ("in", "loop", "bias"):
                slope[f"{name}_{side}"] = np.zeros_like(p[f"{name}_{side}"])
            for t, h, z, r, n, g in reversed(keep[side]):
                by_h = by_h + by_state[t, :, low : low + HIDDEN]
                live = by_h * real[:, t, None]
                by_n = live * (1 - z) * (1 - n**2)
                by_z = live * (h - n) * z * (1 - z)
                by_r = by_n * g * r * (1 - r)
                by_in = np.concatenate((by_z, by_r, by_n), 1)
                by_loop = np.concatenate((by_z, by_r, by_n * r), 1)
                slope[f"loop_{side}"] += h.T @ by_loop
                slope[f"bias_{side}"] += by_in.sum(0)
                slope[f"in_{side}"] += x[at[:, t]].T @ by_in
                np.add.at(by_x, at[:, t], by_in @ entry.T)
                by_h = by_loop @ loop.T + by_h - live * (1 - z)
        slope["word"] = np.zeros_like(p["word"])
        np.add.at(slope["word"], self.known[words.hashes], by_x[:, :WORD_SIZE])
        slope["char"] = np.zeros_like(p["char"])
        shared = by_x[:, WORD_SIZE:] / words.lengths[:, None].astype(np.float32)
        np.add.at(slope["char"], words.trigrams, np.repeat(shared, words.lengths, 0))
        return slope

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of each text: of its highest window, 0 without words."""
        odds = self.odds(texts)
        return np.where(np.isfinite(odds), _sigmoid(self.scale * odds + self.offset), 0.0)

    def odds(self, texts: list[str]) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        words = Words(texts)
        text, start, size = words.blocks()
        x = self.inputs(words)
        order = np.argsort(size, kind="stable")
        for low in range(0, len(order), _BLOCKS):
            part = order[low : low + _BLOCKS]
            np.maximum.at(best, text[part], self.highest(x, start[part], size[part]).astype(float))
        return best


def fit(texts: list[str], toxic: list[int], rounds: tuple[int, int] = ROUNDS, rate: float = 0.01, seed: int = 4, first_windows: int = FIRST_WINDOWS) -> Network | None:
    """None unless both classes are there. Adam; classes weigh the same in total.

    Every CHECK_SHARE-th text of a class is kept out of the learning; these choose the round to
    stop at, and slope and shift of the log-odds, so that scores are probabilities among them.
    """
    known = {t: int(y) for t, y in zip(texts, toxic, strict=True) if t and _CLASS[np.frombuffer(t.lower().encode("utf-16-le", "replace"), "<u2")].any()}
    if len(set(known.values())) < 2:
        return None
    learned, checked = [], []
    for mark in (0, 1):
        own = [(t, y) for t, y in known.items() if y == mark]
        checked += own[CHECK_SHARE - 1 :: CHECK_SHARE]
        learned += [x for i, x in enumerate(own) if i % CHECK_SHARE != CHECK_SHARE - 1]
    if {y for _, y in checked} != {0, 1}:
        checked = learned
    held, marks = [t for t, _ in checked], np.array([y for _, y in checked], float)
    best, network = np.inf, None
    for candidate in _learned(learned, rounds, rate, seed, first_windows):
        odds = np.clip(candidate.odds(held), -30, 30)
        scale, offset = _calibration(odds, marks)
        loss = np.logaddexp(0, -(2 * marks - 1) * (scale * odds + offset)).mean()
        if loss < best:
            best, network = loss, copy.deepcopy(candidate)
            network.scale, network.offset = scale, offset
    return network


def _calibration(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and shift of a logistic regression with a weak pull towards slope 1."""
    a, b = 1.0, 0.0
    for _ in range(200):
        error = np.clip(1 / (1 + np.exp(-np.clip(a * odds + b, -50, 50))), 1e-6, 1 - 1e-6)
        curve = error * (1 - error)
        slope = np.array([((error - labels) * odds).sum() + 0.5 * (a - 1), (error - labels).sum() + 0.05 * b])
        bend = np.array([[(curve * odds**2).sum() + 0.5, (curve * odds).sum()], [(curve * odds).sum(), curve.sum() + 0.05]])
        change = np.linalg.solve(bend, slope)
        a, b = max(a - 0.5 * change[0], 0.05), b - 0.5 * change[1]
    return float(a), float(b)


def _learned(known: list[tuple[str, int]], rounds: tuple[int, int], rate: float, seed: int, first_windows: int) -> Iterator[Network]:
    """The one network after each round of its training."""
    texts, labels = [t for t, _ in known], np.array([y for _, y in known], np.float32)
    importance = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
    words, network, order = Words(texts), Network(), np.random.default_rng(seed)
    text, start, size = words.windows()
    owner = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    seen, in_texts = np.unique(np.unique(np.stack((words.hashes, owner), 1), axis=0)[:, 0], return_counts=True)
    common = seen[np.argsort(-in_texts, kind="stable")][: min(WORD_ROWS - 1, int((in_texts >= WORD_TEXTS).sum()))]
    network.known[common] = np.arange(1, len(common) + 1)
    first, second = ({k: np.zeros_like(v) for k, v in network.p.items()} for _ in range(2))
    step, unseen = 0, int(np.flatnonzero(network.known == 0)[0])

    def learn(chosen: np.ndarray) -> None:
        nonlocal step
        order.shuffle(chosen)
        for low in range(0, len(chosen), 128):
            part = chosen[low : low + 128]
            # Only the words of these windows are looked at.
            picked = Words.__new__(Words)
            span = np.concatenate([np.arange(a, a + n) for a, n in zip(start[part], size[part], strict=True)])
            picked.hashes, picked.lengths = words.hashes[span], words.lengths[span]
            picked.hashes = np.where(order.random(len(span)) < UNSEEN, unseen, picked.hashes)
            picked.starts = np.concatenate(([0], np.cumsum(picked.lengths)[:-1]))
            picked.trigrams = words.trigrams[np.repeat(words.starts[span] - picked.starts, picked.lengths) + np.arange(picked.lengths.sum())]
            own = np.concatenate(([0], np.cumsum(size[part])[:-1]))
            x, keep = network.inputs(picked), {}
            odds = network.run(x, own, size[part], keep)
            error = _sigmoid(odds) - labels[text[part]]
            # Texts that contradict the network get less say, so that wrong marks are not learned by heart.
            error = (error * (1 - np.abs(error)) ** 0.7 * importance[text[part]] / len(part)).astype(np.float32)
            slope = network.slopes(x, picked, keep, error)
            step += 1
            for k, s in slope.items():
                first[k] += 0.1 * (s - first[k])
                second[k] += 0.001 * (s * s - second[k])
                network.p[k] -= rate * DECAY * network.p[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    for _ in range(rounds[0]):
        learn(order.permutation(len(start))[:first_windows])
    for _ in range(rounds[1]):
        x = network.inputs(words)
        odds = np.concatenate([network.run(x, start[i : i + _WINDOWS], size[i : i + _WINDOWS]) for i in range(0, len(start), _WINDOWS)])
        ranked = np.lexsort((-odds, text))
        place = np.arange(len(ranked)) - np.searchsorted(text[ranked], text[ranked])
        learn(ranked[place < 2])
        yield network


def train(documents: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Network | None:
    """documents: the rows that may be learned from; labels: (doc_id, toxic, ...)."""
    marked = labels.where(F.col("toxic").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 32)) / (1 << 32)
    # A third of the ids is held out and long texts are left out, hence twice the share.
    share = {k: min(1.0, 2 * n / max(counts.get(k, 0), 1)) for k, n in ((0, clean), (1, toxic))}
    few = marked.where(F.when(F.col("toxic") == 1, place < share[1]).when(F.col("toxic") == 0, place < share[0]))
    short = documents.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    # The sampled marks are few by the parameters; written first, their true size lets Spark broadcast them.
    joined = short.join(staged(few, "marks"), F.col("doc_id") == F.col("_id")).select("text", "toxic", place.alias("place"))
    rows = []
    for mark, most in ((1, toxic), (0, clean)):
        rows += joined.where(F.col("toxic") == mark).orderBy("place", "text").limit(most).collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    low, chars = 0, 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars > _GROUP_CHARS:
            yield low, i + 1
            low, chars = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def scored(text: Column, network: Network | None) -> Column:
    """Score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        texts, found = column.tolist(), np.zeros(len(column))
        if network is not None:
            for a, b in _groups(texts):
                found[a:b] = network.scores([t or "" for t in texts[a:b]])
        return pd.Series(found)

    return score(text)
