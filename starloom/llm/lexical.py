"""Ranked lexical search by the Best Position Algorithm over impact lists.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. N counts
the documents with a term, L their terms, n a document's terms, df the documents that hold a term, tf its occurrences in
one. A term weighs w = floor(1000 ln((2N + 2)/(2 df + 1))); a document's m is 75 + (25 n N) div L; its score is the sum over
the query's terms, repeats included, of w ((10^9 tf) div (1000 tf + 12 m)), in 64-bit integers.

1. Postings. One pass over the texts keeps, for each document, its number of terms and the query terms it holds. They
   are written once; df, N and L come from them, over all documents.
2. Shards. A task files the documents it meets in shards of bounded size. In a shard each term has a list of its
   documents by falling impact (the part of the score without w).
3. Search. The lists of a query are read from the top, in steps. A document met in one list is looked up in all others at
   once (direct access), which also marks its positions there as seen. A list's best position is the last one of the
   run of seen positions from its top; no unseen document can have more impact than stands there. The search of a shard
   stops once the sum of these impacts is strictly below the k-th best score, so equal scores are never lost.
4. The k best of each shard meet by query; the ranking keeps k of them on the map side of its shuffle.

A term is known by a 64-bit hash. A large query set is dealt into blocks of about ``BLOCK_TERMS`` terms, so what a task
holds of it is bounded; one query of more terms than that is a block of its own.

Defined results: null texts and texts without terms count nowhere and are never found; a query without terms, or whose terms
no document holds, has no rows; repeated rows are documents (or queries) of their own; a document without an id ranks behind
equal scores; fewer than k documents with a score above 0 are all returned; empty tables give empty results. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.scan import ALNUM, Words, packs, small_batches, texts_of
from starloom.llm.spans import settled

K = 20
BLOCK_TERMS = 1_000_000
#: Documents and postings that a shard holds at most (or one document with more postings).
SHARD_DOCUMENTS, SHARD_POSTINGS = 65_536, 4_000_000
#: Positions of each list read in the first step; every step reads twice as many as the one before.
STEP = 32


class Queries:
    """A block of queries: its different terms by hash, and each query's terms with their number of occurrences."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.row = np.array([r for r, _ in rows], np.int64)
        terms = [Words([text], ALNUM).words() for _, text in rows]
        self.terms = np.unique(np.concatenate([*terms, np.zeros(0, np.uint64)]))
        self.held = [np.unique(np.searchsorted(self.terms, t), return_counts=True) for t in terms]


def postings(docs: DataFrame, queries: Queries, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n, terms, tfs) of the documents that hold a term; terms and tfs are arrays of 32-bit numbers."""
    known = docs.sparkSession.sparkContext.broadcast(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value
        for batch in batches:
            texts, n, terms, tfs = texts_of(batch.column(2)), [], [], []
            for part in packs(texts):
                words = Words(texts[part], ALNUM)
                codes = words.words()
                place = np.minimum(np.searchsorted(wanted, codes), max(0, len(wanted) - 1))
                hit = np.flatnonzero(wanted[place] == codes) if len(wanted) else np.zeros(0, np.int64)
                key, tf = np.unique(words.owner[hit] * len(wanted) + place[hit], return_counts=True)
                cut = np.searchsorted(key, np.arange(len(words.first)) * len(wanted)) if len(wanted) else np.zeros(len(words.first), np.int64)
                term, tf = (key % max(1, len(wanted))).astype(np.int32), tf.astype(np.int32)
                n.append(np.diff(words.first))
                terms += [term[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                tfs += [tf[a:b].tobytes() for a, b in zip(cut, cut[1:])]
            n = np.concatenate([*n, np.zeros(0, np.int64)])
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                                             names=["row", "id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    small = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return settled(small.mapInArrow(run, "row long, id long, n long, terms binary, tfs binary"), "postings")


def weights(held: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each query term (0 where no document holds it)."""
    width = len(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(width, np.int64)
        for batch in batches:
            for x in batch.column(0):
                df[np.frombuffer(x.as_buffer(), np.int32)] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    n, total = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = held.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(width, np.int64)
    for r in found:
        out[r["term"]] = np.floor(1000 * np.log((2 * n + 2) / (2 * r["df"] + 1)))
    return n, total, out


class Shard:
    """Documents with their impact lists; documents are numbered by id, so that the smaller number wins a tie."""

    def __init__(self, row: np.ndarray, ids: list[int | None], n: np.ndarray, terms: list[bytes], tfs: list[bytes], count: int, total: int):
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, row[i]))
        self.ids, self.rows, n = [ids[i] for i in order], row[order], n[order]
        size = [len(terms[i]) // 4 for i in order]
        doc = np.repeat(np.arange(len(order)), size)
        term = np.frombuffer(b"".join(terms[i] for i in order), np.int32)
        tf = np.frombuffer(b"".join(tfs[i] for i in order), np.int32).astype(np.int64)
        m = 75 + (25 * n * count) // total
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.names, self.start = np.unique(term, return_index=True)
        self.end = np.append(self.start[1:], len(term))

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """The places of the lists of terms; -1 for a term that no document of the shard holds."""
        at = np.minimum(np.searchsorted(self.names, terms), len(self.names) - 1)
        return np.where(self.names[at] == terms, at, -1)


def best(shard: Shard, terms: np.ndarray, factor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents of a shard (numbers and scores) for terms with factors, and the number of documents scored."""
    at = shard.lists(terms) if len(shard.names) else np.full(len(terms), -1)
    use = (at >= 0) & (factor > 0)
    at, factor = at[use], factor[use]
    start, length = shard.start[at], (shard.end - shard.start)[at]
    base = np.concatenate(([0], np.cumsum(length)))
    place = np.full((len(at), len(shard.rows)), -1, np.int32)  # direct access: a document's position in each list
    for i, (a, size) in enumerate(zip(start, length)):
        place[i, shard.doc[a : a + size]] = np.arange(size)
    met, seen = np.zeros(len(shard.rows), bool), np.zeros(base[-1], bool)
    top, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    position, read, step, scored = np.zeros(len(at), np.int64), 0, STEP, 0
    while (position < length).any():
        new = np.unique(np.concatenate([shard.doc[a + min(read, size) : a + min(read + step, size)] for a, size in zip(start, length)]))
        new = new[~met[new]]
        met[new] = True
        where = place[:, new]
        held = where >= 0
        impact = np.where(held, shard.impact[np.where(held, start[:, None] + where, 0)], 0)
        seen[(base[:-1, None] + where)[held]] = True
        top, score = np.concatenate((top, new)), np.concatenate((score, (impact * factor[:, None]).sum(axis=0)))
        keep = np.lexsort((top, -score))[:k]
        top, score, scored = top[keep], score[keep], scored + len(new)
        for i in np.flatnonzero(position < length):
            ahead = seen[base[i] + position[i] : base[i + 1]]
            position[i] += len(ahead) if ahead.all() else int(ahead.argmin())
        open_ = position < length  # a list read to its end holds no unseen document
        bound = (shard.impact[(start + position - 1)[open_]] * factor[open_]).sum()
        if len(score) == k and bound < score[-1]:
            break
        read, step = read + step, 2 * step
    some = score > 0
    return top[some], score[some], scored


def shard_results(held: DataFrame, queries: Queries, n: int, total: int, weight: np.ndarray, k: int) -> DataFrame:
    """(query, row, id, score): the k best documents of every shard for every query."""
    known = held.sparkSession.sparkContext.broadcast((queries.row, [(t, c * weight[t]) for t, c in queries.held]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, asked = known.value

        def results(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            one = pa.Table.from_batches(parts)
            shard = Shard(one.column("row").to_numpy(), one.column("id").to_pylist(), one.column("n").to_numpy(),
                          one.column("terms").to_pylist(), one.column("tfs").to_pylist(), n, total)
            query, row, ids, scores = [], [], [], []
            for q, (terms, factor) in zip(rows.tolist(), asked):
                top, score, _ = best(shard, terms, factor, k)
                query += [q] * len(top)
                row += shard.rows[top].tolist()
                ids += [shard.ids[i] for i in top.tolist()]
                scores += score.tolist()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (query, row, ids, scores)], names=["query", "row", "id", "score"])

        parts, documents, entries = [], 0, 0
        for batch in batches:
            sizes = np.fromiter((len(x.as_buffer()) // 4 for x in batch.column("terms")), np.int64, batch.num_rows)
            at = 0
            for i, size in enumerate(sizes.tolist()):
                if documents and (documents >= SHARD_DOCUMENTS or entries + size > SHARD_POSTINGS):
                    yield results([*parts, batch.slice(at, i - at)])
                    parts, documents, entries, at = [], 0, 0, i
                documents, entries = documents + 1, entries + size
            parts.append(batch.slice(at))
        if documents:
            yield results(parts)

    return held.mapInArrow(run, "query long, row long, id long, score long")


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The k best documents for each item: item id, rank, document id, score."""
    small_batches(docs.sparkSession)
    asked = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    asked = settled(asked.select(F.monotonically_increasing_id().alias("query"), "item", "text"), "queries")
    # A term takes one character and terms are apart, so half the characters bound them.
    size = asked.agg(F.coalesce(F.sum(F.floor(F.length("text") / 2) + 1), F.lit(0))).first()[0]
    count, found = max(1, -(-size // block_terms)), None
    for b in range(count):
        block = asked.where(F.pmod(F.xxhash64("query"), F.lit(count)) == b)
        queries = Queries([(r["query"], r["text"].encode()) for r in block.select("query", "text").collect()])
        held = postings(docs, queries, id_col, text_col)
        part = shard_results(held, queries, *weights(held, queries), k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), F.asc("row"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "item"), "query").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
