"""Language identification in two steps: the language family, then one-versus-one linear SVMs within the family.

A text is a bag of hashed byte n-grams of orders 1 to 4 over letters (A-Z lower-cased, digits and punctuation as blanks),
with square roots of counts scaled to length 1. One-versus-one linear support vector machines, trained by averaged
stochastic subgradient steps on the hinge loss, first tell the families apart and then the languages of the family
chosen. Votes of a step are shares of logistic margins; the score is the product of the two steps' shares.

``families`` maps a language value to its family; a language that it does not name is a family of its own. Training
knows every language value. It takes up to ``per_language`` rows of each, chosen by the hash of their key, and fewer of
each (at least one) where there are so many values that the sample would exceed ``sample_rows``.

Defined results: a null text, or one without any letter, is ``und`` with score 0; if nothing can be learnt (no row with
text and language) every text is ``und``; with one language learnt every other text gets it; equal votes go to the
value first in order; repeated rows get equal results; an empty table gives an empty result. Only key, text and, for
training rows, the language are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.scan import add_results, ngram_counts, packs, table, texts_of
from starloom.llm.spans import settled

#: Families of language codes.
FAMILIES = {
    "de": "germanic", "en": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}
PER_LANGUAGE = 800
SAMPLE_ROWS = 48_000
BUCKETS = 4096
ORDERS = (1, 2, 3, 4)
LETTERS = table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LETTERS[LETTERS == 0] = 0x20
DOC_BLOCK = 128


def features(texts: list[bytes], buckets: int) -> np.ndarray:
    parts = []
    for i in range(0, len(texts), DOC_BLOCK):
        rows = np.sqrt(ngram_counts(texts[i : i + DOC_BLOCK], LETTERS, ORDERS, buckets)).astype(np.float32)
        parts.append(rows / np.maximum(np.sqrt((rows**2).sum(axis=1, keepdims=True)), 1e-9))
    return np.concatenate(parts) if parts else np.zeros((0, buckets), np.float32)


def train_svm(rows: np.ndarray, sign: np.ndarray, passes: int = 12, rate: float = 1e-3) -> np.ndarray:
    """Weights (the last one is the offset) of a linear SVM by averaged subgradient steps on batches of 32 rows."""
    rows = np.concatenate((rows, np.ones((len(rows), 1), np.float32)), axis=1)
    share = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1)) * len(sign)
    w, mean, t, shuffle = np.zeros(rows.shape[1]), np.zeros(rows.shape[1]), 0, np.random.default_rng(3)
    for _ in range(passes):
        order = shuffle.permutation(len(rows))
        for i in range(0, len(rows), 32):
            at = order[i : i + 32]
            t += 1
            step = 1 / (rate * (t + 100))
            bad = at[sign[at] * (rows[at] @ w) < 1]
            w = (1 - step * rate) * w + step / len(at) * ((sign[bad] * share[bad]) @ rows[bad])
            mean += (w - mean) / t
    return mean


class Votes:
    """One-versus-one machines between classes."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.classes = sorted(set(labels.tolist()))
        pairs = [(a, b) for a in range(len(self.classes)) for b in range(a)]
        self.pairs, weights = np.array(pairs, np.int64).reshape(-1, 2), []
        for a, b in pairs:
            at = np.flatnonzero((labels == self.classes[a]) | (labels == self.classes[b]))
            weights.append(train_svm(rows[at], np.where(labels[at] == self.classes[a], 1.0, -1.0)))
        self.weights = np.stack(weights, 1) if weights else np.zeros((rows.shape[1] + 1, 0))

    def choose(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the class with most votes in each row, and its share."""
        if len(self.classes) == 1:
            return np.zeros(len(rows), np.int64), np.ones(len(rows))
        sure = 1 / (1 + np.exp(-2 * np.clip(rows @ self.weights[:-1] + self.weights[-1], -30, 30)))
        votes = np.zeros((len(rows), len(self.classes)))
        for j, (a, b) in enumerate(self.pairs):
            votes[:, a] += sure[:, j]
            votes[:, b] += 1 - sure[:, j]
        best = votes.argmax(axis=1)
        return best, votes[np.arange(len(rows)), best] / (len(self.classes) - 1)


@dataclass
class Model:
    buckets: int
    family: Votes | None = None
    within: dict[str, Votes] = field(default_factory=dict)

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        at = [i for i, x in enumerate(texts) if has_letter(x)]
        if not at or self.family is None:
            return names, scores
        rows = features([texts[i] for i in at], self.buckets)
        family, sure = self.family.choose(rows)
        for number in set(family.tolist()):
            own = np.flatnonzero(family == number)
            machine = self.within[self.family.classes[number]]
            best, share = machine.choose(rows[own])
            for j, b, s in zip(own.tolist(), best.tolist(), (sure[own] * share).tolist()):
                names[at[j]], scores[at[j]] = machine.classes[b], min(1.0, s)
        return names, scores


def has_letter(text: bytes) -> bool:
    """Whether a text has a letter of any script."""
    return text.isalpha() or any(map(str.isalpha, text.decode("utf-8", "replace")))


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train: Column | None = None,
        families: dict[str, str] = FAMILIES, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS,
        buckets: int = BUCKETS) -> Model:
    """Learn from a bounded sample of rows with text and language."""
    ready = docs.where((F.lit(True) if train is None else train) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    ready = ready.select(F.col(id_col).cast("string").alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = settled(ready.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    values = counts.count()
    if not values:
        return Model(buckets)
    # A row's chance of being in the first rows by hash of its key shrinks with the language's rows: a filter on the hash
    # keeps about 4 times as many (and never few) before the exact choice, so no task sorts a whole language.
    each = max(1, min(per_language, sample_rows // values))
    spread, span = F.pmod(F.xxhash64("key", "lang"), F.lit(1 << 30)), 1 << 30
    near = ready.join(F.broadcast(counts), "lang").where(spread < F.least(F.lit(1.0), F.lit(4.0 * max(each, 20)) / F.col("n")) * span)
    order = Window.partitionBy("lang").orderBy("h", "key", "t")
    near = near.select("lang", "key", "text", spread.alias("h"), F.xxhash64("text").alias("t"))
    rows = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("lang", "key", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, packed = texts_of(batch.column(2)), []
            for part in packs(texts):
                packed += [x.tobytes() for x in features(texts[part], buckets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["lang", "key", "bag"])

    sampled = rows.mapInArrow(pack, "lang string, key string, bag binary").toPandas().sort_values(["lang", "key"], kind="stable", ignore_index=True)
    bag = np.stack([np.frombuffer(x, np.float32) for x in sampled["bag"]])
    lang = sampled["lang"].to_numpy(object)
    family = np.array([families.get(x, f"only {x}") for x in lang], object)
    model = Model(buckets, Votes(bag, family))
    for name in model.family.classes:
        model.within[name] = Votes(bag[family == name], lang[family == name])
    return model


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: key, lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        return lambda texts: list(sent.value.predict(texts))

    small = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return add_results(small, 1, start, "lang_pred string, score double").select(F.col("c0").alias(id_col), "lang_pred", "score")
