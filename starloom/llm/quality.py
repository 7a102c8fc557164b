"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a bag of hashed byte n-grams of orders 1 to 3 (case and punctuation kept). Log counts times the inverse
document frequency, counted over every document, are projected onto the leading singular vectors of the labelled sample
(randomised SVD). The labelled vectors are broadcast; every document's vector is multiplied with all of them in blocks,
so cosines and neighbours are exact. The k nearest vote with their similarity above that of the (k+1)-th, and a logistic
curve fitted on leave-one-out votes calibrates the result.

Bounds: ``per_class`` labelled rows of each class are learnt from; the broadcast model holds at most
2 * per_class * dims + buckets * dims numbers.

Defined results: null and empty texts have no n-grams, hence no direction, and get the calibrated base rate; without
labels of both classes every score is the smoothed share of the class seen; equal similarities go to the earlier
example in key order; repeated rows get equal scores; an empty table gives an empty result. Only the key and the text
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.examples import calibrated, class_weights, fit_logistic, labelled_sample
from starloom.llm.scan import add_results, ngram_counts, packs, texts_of

PER_CLASS = 2000
BUCKETS = 2048
DIMS = 64
ORDERS = (1, 2, 3)
#: All bytes as they are, but for the 0 that parts the texts of a pack.
RAW = np.arange(256, dtype=np.uint8)
DOC_BLOCK = 256


def bags(texts: list[bytes], buckets: int) -> np.ndarray:
    parts = [ngram_counts(texts[i : i + DOC_BLOCK], RAW, ORDERS, buckets) for i in range(0, len(texts), DOC_BLOCK)]
    return np.concatenate(parts) if parts else np.zeros((0, buckets), np.int64)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int
    base: float
    fit: tuple[float, float] = (1.0, 0.0)

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(unit(np.log1p(counts) * self.idf) @ self.axes)

    def votes(self, vectors: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Similarity-weighted shares of label 1 among the k nearest examples; ``own`` are examples left out by row."""
        if not len(self.labels):
            return np.full(len(vectors), self.base)
        cosine = vectors @ self.vectors.T
        if own is not None:
            cosine[np.arange(len(own)), own] = -2
        k = min(self.k + 1, len(self.labels))
        at = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(cosine, at, 1)
        order = np.lexsort((at, -near), axis=1)
        at, near = np.take_along_axis(at, order, 1), np.take_along_axis(near, order, 1)
        weight = np.maximum(near[:, : self.k] - near[:, -1:], 0) + 1e-3
        votes = ((weight * self.labels[at[:, : self.k]]).sum(axis=1) + 1e-3 * self.base) / (weight.sum(axis=1) + 1e-3)
        return np.where((vectors != 0).any(axis=1), votes, self.base)


def singular_axes(rows: np.ndarray, dims: int) -> np.ndarray:
    """The leading right singular vectors by a randomised range finder with power steps."""
    dims = min(dims, *rows.shape)
    if not dims:
        return np.zeros((rows.shape[1], 1))
    basis = np.random.default_rng(7).standard_normal((rows.shape[1], min(dims + 16, rows.shape[1])))
    for _ in range(6):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    return basis @ np.linalg.svd(rows @ basis, full_matrices=False)[2].T[:, :dims]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        train: Column | None = None, per_class: int = PER_CLASS, buckets: int = BUCKETS, dims: int = DIMS, k: int = 15) -> Model:
    """Learn from a bounded sample of labelled rows; document frequencies come from all of docs."""
    rows, totals = labelled_sample(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col,
                                   train=F.lit(True) if train is None else train, per_class=per_class)

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, packed = texts_of(batch.column(2)), []
            for part in packs(texts):
                packed += [x.astype(np.float32).tobytes() for x in bags(texts[part], buckets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["key", "label", "bag"])

    sampled = rows.select(F.col("key").cast("string"), "label", "text").mapInArrow(counts_of, "key string, label int, bag binary").toPandas()
    sampled = sampled.sort_values("key", kind="stable", ignore_index=True)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for part in packs(texts):
                total[1:] += (bags(texts[part], buckets) > 0).sum(axis=0)
            total[0] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, buckets)), pa.array(total)], names=["bucket", "df"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(frequencies, "bucket bigint, df bigint").groupBy("bucket").agg(F.sum("df").alias("df"))
    df = {r["bucket"]: r["df"] for r in counted.collect()}  # one row for each bucket
    idf = np.array([np.log((df.get(-1, 0) + 1) / (df.get(b, 0) + 1)) + 0.1 for b in range(buckets)])
    label = sampled["label"].to_numpy(np.int64)
    bag = np.stack([np.frombuffer(x, np.float32) for x in sampled["bag"]]) if len(sampled) else np.zeros((0, buckets), np.float32)
    model = Model(idf, singular_axes(unit(np.log1p(bag) * idf), dims), np.zeros((0, 1)), label, k,
                  base=(totals.get(1, 0) + 1) / (sum(totals.values()) + 2))
    model.vectors = model.project(bag)
    own = np.arange(len(label))
    votes = np.concatenate([model.votes(model.vectors[i : i + DOC_BLOCK], own[i : i + DOC_BLOCK]) for i in range(0, len(label), DOC_BLOCK)] or [np.zeros(0)])
    model.fit = fit_logistic(votes, label, class_weights(label, totals)) if len(label) else (1.0, 0.0)
    return model


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: key and score (0 to 1, higher: label 1 likelier)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = sent.value

        def rows_of(texts: list[bytes]) -> list[list]:
            out = []
            for i in range(0, len(texts), DOC_BLOCK):
                out += calibrated(own.votes(own.project(bags(texts[i : i + DOC_BLOCK], len(own.idf)))), own.fit).tolist()
            return [out]

        return rows_of

    return add_results(docs.select(F.col(id_col), F.col(text_col).cast("string")), 1, start, "score double").select(F.col("c0").alias(id_col), "score")
