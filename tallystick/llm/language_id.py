"""Language ID with a blended-spectrum string kernel, Nyström landmarks and ridge regression.

A text's features are the character n-grams of lengths ``GRAMS`` that it holds, present or
not, over its lower-cased letters (other characters count as one separator sign). The kernel
of two texts is the number of grams they share over the root of the product of their own
numbers. ``train`` takes some texts of each language as landmarks, maps texts to kernel values
with the landmarks, whitened by the landmarks' own kernel matrix (Nyström), and fits one
ridge regression per language against the rest. Scoring a batch is two matrix products:
presence x landmark presence, normalised, then x weights.

Grams beyond two characters are hashed to 2^18 bins a length, so a text's presence map, the
landmark matrix and a batch have fixed sizes; long texts are read in pieces that overlap by a
gram. The fit uses a sample of labelled rows: at most ``MAX_LANGS`` languages (the most frequent
ones), at most ``SAMPLE_ROWS`` rows shared equally among them, lowest hash of id and text first,
texts of more than ``SAMPLE_CHARS`` characters left out. Scoring covers every whole text.

Cases: a text that is NULL or has no letter is ``und`` with score 0, as is every text if
nothing could be learned; rows without a language are not learned from; NULL ids are ordinary
rows, and so are repeated rows, but the sample takes rows equal in id, text and language once;
an empty table gives no rows. Documents are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
GRAMS = (2, 3, 4)
MAX_LANGS = 200
SAMPLE_ROWS = 1600
SAMPLE_CHARS = 50_000
LANDMARKS = 160
RIDGE = 0.01
_CLASSES = 128
_BITS = 18
_SIZES = {2: _CLASSES**2, 3: 1 << _BITS, 4: 1 << _BITS}
_PIECE = 1 << 16
_BATCH = 256


def _classes() -> np.ndarray:
    """Class of each 16-bit code unit: 0 for non-letters, 1-26 for a-z, the rest hashed."""
    table = np.zeros(1 << 16, np.uint32)
    for code in range(1 << 16):
        if chr(code).isalpha():
            table[code] = code - 96 if 97 <= code <= 122 else 27 + code % (_CLASSES - 27)
        elif 0xD800 <= code < 0xE000:
            table[code] = 27 + code % (_CLASSES - 27)
    return table


_CLASS = _classes()


class Presence:
    """Marks the grams of one text at a time in a map that is used again."""

    def __init__(self) -> None:
        self.map = np.zeros(sum(_SIZES[n] for n in GRAMS), bool)

    def of(self, text: str) -> np.ndarray:
        self.map[:] = False
        units = np.frombuffer(text.lower().encode("utf-16-le", "replace"), "<u2")
        for at in range(0, len(units), _PIECE):
            classes = _CLASS[units[at : at + _PIECE + max(GRAMS) - 1]]
            base = 0
            for n in GRAMS:
                if len(classes) >= n:
                    code = classes[: len(classes) - n + 1]
                    for i in range(1, n):
                        code = code * np.uint32(_CLASSES) + classes[i : len(classes) - n + 1 + i]
                    if n > 2:
                        code = (code * np.uint32(2654435761)) >> np.uint32(32 - _BITS)
                    self.map[base + code] = True
                base += _SIZES[n]
        return self.map


@dataclass
class Model:
    """langs; bins: grams that some landmark holds; landmarks: bins x landmarks, 0 or 1."""

    langs: list[str]
    bins: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def kernel(self, texts: list[str], presence: Presence) -> np.ndarray:
        held = np.zeros((len(texts), len(self.bins)), np.float32)
        own = np.ones(len(texts), np.float32)
        for i, text in enumerate(texts):
            grams = presence.of(text)
            held[i] = grams[self.bins]
            own[i] = max(np.count_nonzero(grams), 1)
        return (held @ self.landmarks) / np.sqrt(own[:, None] * self.sizes[None, :])

    def predict(self, texts: list[str], presence: Presence) -> tuple[list[str], np.ndarray]:
        scores = self.kernel(texts, presence) @ self.weights
        best = scores.argmax(1)
        return [self.langs[i] for i in best], np.clip((scores[np.arange(len(texts)), best].astype(float) + 1) / 2, 0, 1)


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """rows: (text, language); None if there are none. Landmarks are dealt to languages in turn."""
    rows = [(t, lang) for t, lang in rows if has_letter(t)]
    if not rows:
        return None
    langs = sorted({lang for _, lang in rows})
    turn: dict[str, int] = dict.fromkeys(langs, 0)
    ranked = []
    for text, lang in rows:
        ranked.append((turn[lang], lang, text))
        turn[lang] += 1
    chosen = [text for _, _, text in sorted(ranked)[: max(landmarks, len(langs))]]
    presence = Presence()
    maps = np.stack([presence.of(t).copy() for t in chosen])
    bins = np.flatnonzero(maps.any(0))
    matrix = maps[:, bins].T.astype(np.float32)
    model = Model(langs, bins, matrix, np.maximum(maps.sum(1), 1).astype(np.float32), np.zeros((0, 0), np.float32))
    values, vectors = np.linalg.eigh(model.kernel(chosen, presence).astype(float))
    kept = values > 1e-6 * values[-1]
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    texts = [t for t, _ in rows]
    mapped = np.concatenate([model.kernel(texts[i : i + _BATCH], presence) for i in range(0, len(texts), _BATCH)]) @ whiten
    number = {lang: i for i, lang in enumerate(langs)}
    truth = -np.ones((len(rows), len(langs)))
    truth[np.arange(len(rows)), [number[lang] for _, lang in rows]] = 1
    share = np.bincount([number[lang] for _, lang in rows])
    importance = np.array([len(rows) / len(langs) / share[number[lang]] for _, lang in rows])[:, None]
    square = mapped.T @ (importance * mapped) + ridge * len(rows) / max(len(chosen), 1) * np.eye(mapped.shape[1])
    model.weights = (whiten @ np.linalg.solve(square, mapped.T @ (importance * truth))).astype(np.float32)
    return model


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """labelled: (doc_id, text, lang, ...), the rows that may be learned from."""
    usable = labelled.where(F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    hashed = F.xxhash64("doc_id", "text")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(hashed).alias("distinct"))
    frequent = counts.orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()
    if not frequent:
        return None
    wanted = max(sample_rows // len(frequent), 1)
    # Twice the rows wanted and some more, so that chance leaves no language short; ranks then cut them.
    shares = {row["lang"]: min(1.0, (2 * wanted + 16) / row["distinct"]) for row in frequent}
    place = F.pmod(hashed, F.lit(1 << 32)) / (1 << 32)
    share = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col("lang"))
    sample = usable.where(place < share).select("text", "lang", place.alias("place")).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    rows = sample.withColumn("rank", rank).where(F.col("rank") <= wanted).orderBy("place", "lang", "text").collect()
    return fit([(r["text"], r["lang"]) for r in rows])


def lettered(text: Column) -> Column:
    """Whether a text column holds a letter."""

    @F.pandas_udf("boolean")
    def held(column: pd.Series) -> pd.Series:
        return pd.Series([has_letter(t) for t in column], dtype=bool)

    return held(text)


def predicted(text: Column, model: Model | None) -> Column:
    """struct<lang, score> of a text column."""

    @F.pandas_udf("lang string, score double")
    def score(column: pd.Series) -> pd.DataFrame:
        langs, scores = [UNKNOWN] * len(column), np.zeros(len(column))
        known = [i for i, t in enumerate(column) if model is not None and has_letter(t)]
        presence = Presence()
        texts = column.tolist()
        for at in range(0, len(known), _BATCH):
            part = known[at : at + _BATCH]
            found, scores[part] = model.predict([texts[i] for i in part], presence)
            for i, lang in zip(part, found, strict=True):
                langs[i] = lang
        return pd.DataFrame({"lang": langs, "score": scores})

    return score(text)
