"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are words and their beginnings of 4, 5 and 6 bytes (so inflected and compounded forms meet); kept are those that
labelled toxic examples use more often than chance allows (likelihood ratio, bound by the number of terms tested). The
inverse document frequencies count every document. The index holds the examples in blocks with each term's largest
weight per block: a search visits blocks in the order of their upper bounds and ends when no bound can reach the k-th
best, so its result is exact. Neighbours vote with the inverse of their distance; a logistic curve fitted on
leave-one-out votes turns votes into probabilities. A text without any kept term has no neighbours and gets the
calibrated share of toxic examples among such examples.

Bounds: ``per_class`` labelled rows of each class are learnt from, ``max_terms`` terms are kept; both go to every task.

Defined results: null and empty texts score as texts without terms; without labels of both classes every score is the
smoothed share of the class seen (0.5 without labels); equal similarities go to the example with the smaller key hash
order; repeated rows get equal scores; an empty table gives an empty result. Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.examples import calibrated, class_weights, fit_logistic, labelled_sample
from starloom.llm.scan import ALNUM, Words, add_results, packs, texts_of

PER_CLASS = 2000
MAX_TERMS = 4000
BLOCK = 32
PREFIXES = (4, 5, 6)
_SEED = [np.uint64(0x51ED270B1A3F4C6D * (i + 1) % 2**64) for i in range(len(PREFIXES))]


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all terms of a pack, and the number of the text each is in."""
    codes, owners = [words.words()], [words.owner]
    for size, seed in zip(PREFIXES, _SEED):
        long = np.flatnonzero(words.end - words.start > size)
        start = words.start[long]
        codes.append(words.hashes(start, start + size) ^ seed)
        owners.append(words.owner[long])
    return np.concatenate(codes), np.concatenate(owners)


@dataclass
class Vocabulary:
    """Kept terms, sorted by code, with a small table that rules most other codes out."""

    codes: np.ndarray
    seen: np.ndarray = field(init=False)

    def __post_init__(self):
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.codes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, term numbers and counts of kept terms in a pack, ordered by text and term."""
        codes, owners = terms(Words(texts, ALNUM))
        near = np.flatnonzero(self.seen[(codes & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(self.codes) or not len(near):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, owners = codes[near], owners[near]
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        same = self.codes[place] == codes
        cells, count = np.unique(owners[same] * len(self.codes) + place[same], return_counts=True)
        return cells // len(self.codes), cells % len(self.codes), count


class BlockMaxIndex:
    """Examples as TF-IDF vectors of length 1 in an inverted index with block maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, keys: list, n_terms: int):
        heaviest = [int(t[np.argmax(w)]) if len(t) else n_terms for t, w in vectors]
        order = np.lexsort((np.arange(len(vectors)), heaviest))  # alike examples share blocks
        self.labels, self.keys, self.rank = labels[order], [keys[i] for i in order], order
        self.blocks = max(1, -(-len(vectors) // BLOCK))
        owner = np.concatenate([np.full(len(vectors[i][0]), j) for j, i in enumerate(order)] or [[]]).astype(np.int64)
        term = np.concatenate([vectors[i][0] for i in order] or [[]]).astype(np.int64)
        weight = np.concatenate([vectors[i][1] for i in order] or [[]]).astype(np.float64)
        by_term = np.lexsort((owner, term))
        self.owner, self.weight, term = owner[by_term], weight[by_term], term[by_term]
        cells = term * self.blocks + self.owner // BLOCK
        self.pointer = np.searchsorted(cells, np.arange(n_terms * self.blocks + 1))
        self.upper = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.upper, cells, self.weight)
        self.upper = self.upper.reshape(n_terms, self.blocks)

    def search(self, term: np.ndarray, weight: np.ndarray, k: int, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest positive cosine and their cosines; ``leave`` is an example left out."""
        bound = weight @ self.upper[term]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] < best[-1] - 1e-12:
                break
            scores = np.zeros(BLOCK)
            for t, w in zip(term.tolist(), weight.tolist()):
                cell = t * self.blocks + b
                own = slice(self.pointer[cell], self.pointer[cell + 1])
                scores[self.owner[own] - b * BLOCK] += w * self.weight[own]
            at = np.flatnonzero(scores > 0)
            at = at[at + b * BLOCK != leave]
            all_at, scores = np.concatenate((best_at, at + b * BLOCK)), np.concatenate((best, scores[at]))
            top = np.lexsort((self.rank[all_at], -scores))[:k]
            best_at, best = all_at[top], scores[top]
        return best_at, best


@dataclass
class Model:
    vocabulary: Vocabulary
    idf: np.ndarray
    index: BlockMaxIndex
    k: int
    base: float
    without: float = 0.5
    fit: tuple[float, float] = (1.0, 0.0)

    def vector(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(count)) * self.idf[term]
        return weight / np.sqrt((weight**2).sum()) if len(weight) else weight

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        if not len(at):
            return self.without
        weight = 1 / (1.05 - np.minimum(cosine, 1))
        return float((weight @ self.index.labels[at] + self.base) / (weight.sum() + 1))


def select_terms(sampled: pd.DataFrame, max_terms: int) -> np.ndarray:
    """Codes of the terms that toxic examples hold more often than chance allows."""
    sizes = np.bincount(sampled["label"], minlength=2)
    if not len(sampled) or not sizes.all():
        return np.zeros(0, np.uint64)
    codes = np.concatenate([np.frombuffer(x, np.uint64) for x in sampled["codes"]])
    label = np.repeat(sampled["label"].to_numpy(), [len(x) // 8 for x in sampled["codes"]])
    known, place = np.unique(codes, return_inverse=True)
    pos = np.bincount(place, label, len(known))
    neg = np.bincount(place, 1 - label, len(known))
    share = (pos + neg) / len(sampled)
    part = lambda seen, of: seen * np.log(np.maximum(seen, 1e-9) / (of * share)) + (of - seen) * np.log(
        np.maximum(of - seen, 1e-9) / np.maximum(of * (1 - share), 1e-9))
    ratio = 2 * (part(pos, sizes[1]) + part(neg, sizes[0]))
    tested = max(2, int((pos + neg >= 3).sum()))
    good = np.flatnonzero((pos >= 3) & (pos / sizes[1] > neg / sizes[0]) & (ratio > 2 * np.log(tested)))
    good = good[np.lexsort((known[good], -ratio[good]))][:max_terms]
    return np.sort(known[good])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train: Column | None = None, per_class: int = PER_CLASS, max_terms: int = MAX_TERMS, k: int = 15) -> Model:
    """Learn from a bounded sample of labelled rows; document frequencies come from all of docs."""
    rows, totals = labelled_sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col,
                                   train=F.lit(True) if train is None else train, per_class=per_class)

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in texts_of(batch.column(2)):
                codes, count = np.unique(terms(Words([text], ALNUM))[0], return_counts=True)
                found.append({"codes": codes.tobytes(), "counts": count.astype(np.int32).tobytes()})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array([x[c] for x in found], pa.binary()) for c in ("codes", "counts"))],
                names=["key", "label", "codes", "counts"])

    sampled = rows.select(F.col("key").cast("string"), "label", "text").mapInArrow(codes_of, "key string, label int, codes binary, counts binary").toPandas()
    sampled = sampled.sort_values("key", kind="stable", ignore_index=True)
    label = sampled["label"].to_numpy(np.int64)
    vocabulary = Vocabulary(select_terms(sampled.assign(label=label), max_terms))
    size = len(vocabulary.codes)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, np.int64), 0
        for batch in batches:
            texts = texts_of(batch.column(0))
            n += len(texts)
            for part in packs(texts):
                total += np.bincount(vocabulary.counts(texts[part])[1], minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size)), pa.array(np.append([n], total))], names=["term", "df"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in counted.collect()}  # one row for each kept term
    idf = np.array([np.log((df.get(-1, 0) + 1) / (df.get(t, 0) + 1)) + 1 for t in range(size)])
    model = Model(vocabulary, idf, None, k, base=(totals.get(1, 0) + 1) / (sum(totals.values()) + 2))
    vectors = []
    for codes, counts in zip(sampled["codes"], sampled["counts"]):
        codes, counts = np.frombuffer(codes, np.uint64), np.frombuffer(counts, np.int32)
        place = np.minimum(np.searchsorted(vocabulary.codes, codes), max(size - 1, 0))
        same = vocabulary.codes[place] == codes if size else np.zeros(len(codes), bool)
        vectors.append((place[same], model.vector(place[same], counts[same])))
    model.index = BlockMaxIndex(vectors, label, sampled["key"].tolist(), size)
    weights = class_weights(label, totals)
    bare = np.array([not len(t) for t, _ in vectors], bool)
    model.without = float((weights[bare] @ label[bare] + model.base) / (weights[bare].sum() + 1))
    found = {int(i): j for j, i in enumerate(model.index.rank)}
    votes = np.array([model.vote(*model.index.search(t, w, k, leave=found[i])) for i, (t, w) in enumerate(vectors)])
    model.fit = fit_logistic(votes, label, weights)
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: key, score, and as evidence its neighbours (key, label, cosine), nearest first."""
    return scored(docs.select(F.col(id_col), F.col(text_col).cast("string")), 1, model).select(
        F.col("c0").alias(id_col), "score", "evidence")


def scored(docs: DataFrame, text_at: int, model: Model) -> DataFrame:
    """docs, its columns renamed c0, c1 ... by place, with ``score`` and ``evidence``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own, known = sent.value, {}

        def result(term: np.ndarray, count: np.ndarray) -> tuple[float, list[dict]]:
            at, cosine = own.index.search(term, own.vector(term, count), own.k)
            near = [{"key": own.index.keys[i], "label": int(own.index.labels[i]), "cosine": c} for i, c in zip(at.tolist(), cosine.tolist())]
            return float(calibrated(np.array([own.vote(at, cosine)]), own.fit)[0]), near

        def rows_of(texts: list[bytes]) -> list[list]:
            owner, term, count = own.vocabulary.counts(texts)
            first = np.searchsorted(owner, np.arange(len(texts) + 1))
            rows = []
            for a, b in zip(first[:-1], first[1:]):
                key = (term[a:b].tobytes(), count[a:b].tobytes())
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                    known[key] = result(term[a:b], count[a:b])
                rows.append(known[key])
            return [[r[0] for r in rows], [r[1] for r in rows]]

        return rows_of

    return add_results(docs, text_at, start, "score double, evidence array<struct<key: string, label: int, cosine: double>>")


def keep_clean(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs without those that score ``threshold`` or more."""
    found = scored(docs, docs.columns.index(text_col), model).where(F.col("score") < threshold)
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
