"""Jaccard join of word n-gram sets with parity sketches, and the components of its links.

A document's set holds the distinct hashes of its word n-grams. Two documents link when 100 * |A and B| is at least
``percent`` * |A or B|, that is when their symmetric difference is at most (|A| + |B|)(100 - percent)/(100 + percent).

1. Sets. One pass over the texts writes, for each document, the set's size, a 128-bit digest and a parity sketch (n-grams
   XOR-hashed into 1 to 2 bits for each of them). Documents of equal digest are one set.
2. Bands. Sizes fall into overlapping groups such that linked sets share one. A group cuts the hash space into parts;
   the sum of a part's n-grams (64 bits, and their number) is a band: only parts of the same n-grams share one, so sets
   without common n-grams do not meet. Sets that differ in at most D n-grams agree in all but D bands, so a set publishes
   its richest bands, more than D of them: by the pigeonhole principle linked sets publish a common one. (Bands are in
   one order, by number of n-grams and key. If B's last band is not before A's, more than D bands of B are there or
   further up, one of them is untouched, and A publishes it too.) Bands are never written: a second pass over the
   texts deals them into binary packs, where they meet by key. A pack is part of a key's value, so 4 more bytes tell the
   keys of a pack apart, and the shuffle moves a few rows for each task and 10 bytes for each band.
3. Families. The members of a key's bucket, in order of size, are cut where a gap is too wide for a link, and each run
   meets under its smallest member, once for all their common keys. There the Hamming distance of the sketches, a lower
   bound of the symmetric difference, rules pairs out; what remains is reported as a spanning forest, never as pairs.
   Families are its components.
4. Verification. All pairs of a family's sets are compared exactly. Links are counted for each set, weighted by the
   documents that share a set; components of a spanning forest of the links are the result.

Groups larger than a block are compared in block pairs of bounded size, spread over tasks. This computes
all comparisons of a family but neither ships nor emits its pairs: each block pair gives a forest and partial sums of
links. No partner is dropped; nothing is sampled.

Defined results: null texts and texts without words have an empty set and link with nothing (component: their own id);
equal texts link; a repeated row or id is a row of its own, in one component with its equal texts; a null id is never a
component's id unless all members' ids are null; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.graph import Forest, components, each_group, in_blocks
from starloom.llm.scan import SPACED, Words, mix, packs, small_batches, texts_of
from starloom.llm.spans import settled

WORDS = 4
PERCENT = 85
SKETCH_BLOCK = 1024
SET_BLOCK = 256
#: N-grams whose sets are multiplied at once in an exact comparison.
GRAM_BLOCK = 4096
#: N-grams whose bands are a pack of the shuffle, and band keys that a map task gathers before it deals them out. Packs are
#: small, so that near copies meet in a pack about once for each common band at every size of the corpus.
PACK_GRAMS, GATHER_KEYS = 200_000, 500_000
#: A set's code has this many bytes; the low bits are its size on a logarithmic scale of so many steps.
CODE_BYTES, SIZE_BITS, SIZE_STEPS = 6, 12, 128


def shingles(texts: list[bytes], n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams; a text of fewer words is one n-gram of all."""
    words = Words(texts, SPACED)
    codes = words.words()
    windows, at = words.windows(codes, n)
    owner = words.owner[at]
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        own = np.unique(windows[first[i] : first[i + 1]])
        if not len(own) and words.first[i + 1] > words.first[i]:
            few = codes[words.first[i] : words.first[i + 1]]
            own = mix(np.bitwise_xor.reduce(mix(few + np.arange(1, len(few) + 1, dtype=np.uint64)), keepdims=True))
        out.append(own)
    return out


class Bands:
    """Size groups, parts and band keys for a threshold of ``percent``."""

    def __init__(self, percent: int, stride: float = 1.5, spread: float = 1.3):
        self.percent, self.reach = percent, log(100 / percent)
        self.stride, self.spread = stride * self.reach, spread

    def most(self, total: int) -> int:
        """The largest symmetric difference of linked sets of ``total`` n-grams together."""
        return total * (100 - self.percent) // (100 + self.percent)

    def groups(self, n: int) -> list[int]:
        """Groups of sizes that a set of n n-grams belongs to: its own, and the one below if a partner may be there."""
        x = log(n)
        own = int(x // self.stride)
        return [g for g in (own - 1, own) if g >= 0 and x <= (g + 1) * self.stride + self.reach + 1e-9]

    def keys(self, own: np.ndarray) -> np.ndarray:
        """The band keys that a set publishes; none if nothing but an equal set can link with it."""
        n = len(own)
        need = self.most(n + n * 100 // self.percent)
        out = [np.zeros(0, np.uint64)]
        for g in self.groups(n) if need else []:
            top = int(exp((g + 1) * self.stride + self.reach)) + 1
            parts = max(2, ceil(self.spread * (self.most(2 * top) + 1)))
            part = (((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
            size = np.bincount(part, minlength=parts)
            ends = np.concatenate(([0], np.cumsum(size)))  # own is sorted, so a part is a slice of it
            total = np.diff(np.concatenate((np.zeros(1, np.uint64), np.cumsum(own)))[ends])
            key = mix(mix(total + size.astype(np.uint64)) ^ mix((np.arange(parts) + (g << 40) + 1).astype(np.uint64)))
            out.append(key[np.lexsort((key, size))[-need - 1 :]])
        return np.concatenate(out)


def sketch(own: np.ndarray) -> bytes:
    """Parities of the n-grams in a power of two of cells, 1 to 2 for each; halves can be folded together."""
    cells = max(64, 1 << (len(own) - 1).bit_length()) if len(own) else 64
    odd = np.bincount((mix(own) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to the width of the shortest."""
    width, rows = min(map(len, sketches)) // 8, []
    for x in sketches:
        row = np.frombuffer(x, np.uint64)
        while len(row) > width:
            row = row[: len(row) // 2] ^ row[len(row) // 2 :]
        rows.append(row)
    return np.stack(rows)


def digest_of(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def code_of(digest: bytes, size: int) -> int:
    """36 bits of a set's digest and the place of its size on a logarithmic scale. Sets that share a code only meet more often."""
    place = min(int(log(max(size, 1)) * SIZE_STEPS), (1 << SIZE_BITS) - 1)
    return int.from_bytes(digest[:CODE_BYTES], "little") >> SIZE_BITS << SIZE_BITS | place


def read_sets(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """One written row per document: row, id, size, digest, code, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = texts_of(batch.column(2)), []
            for part in packs(texts):
                for own in shingles(texts[part], n):
                    digest = digest_of(own)
                    rows.append((len(own), digest.hex(), code_of(digest, len(own)), sketch(own)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))],
                                             names=["row", "id", "size", "digest", "code", "sketch"])

    small = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return settled(small.mapInArrow(run, "row long, id long, size long, digest string, code long, sketch binary"), "sets")


def led(texts: DataFrame, grams: int, percent: int, n: int) -> DataFrame:
    """(leader, code): sets that publish a common band key and are near in size, under the smallest such code.

    All members of a run meet under one leader, so every candidate pair does; the thousands of keys that near copies of
    long texts share are one row for each copy. ``texts`` is the column of texts, ``grams`` the sizes of their sets
    together. A task publishes the bands of equal sets once.
    """
    bands = Bands(percent)
    pack_count = max(1, grams // PACK_GRAMS)
    gap = ceil(bands.reach * SIZE_STEPS) + 1  # linked sets are at most so far apart

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, published = [], 0, set()

        def out() -> pa.RecordBatch:
            keys, codes = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
            pack = (keys % np.uint64(pack_count)).astype(np.int64)
            order = np.argsort(pack, kind="stable")
            keys, codes, ends = keys[order], codes[order], np.searchsorted(pack[order], np.arange(pack_count + 1))
            full = np.flatnonzero(np.diff(ends))
            cut = lambda x: pa.array([x[ends[p] : ends[p + 1]].tobytes() for p in full], pa.binary())
            high, narrow = (keys >> np.uint64(32)).astype(np.uint32), codes.view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES]
            return pa.RecordBatch.from_arrays([pa.array(full), cut(high), cut(narrow)], names=["pack", "keys", "codes"])

        for batch in batches:
            found = texts_of(batch.column(0))
            for part in packs(found):
                for own in shingles(found[part], n):
                    digest = digest_of(own)
                    if digest in published or not len(own):
                        continue
                    if len(published) > 500_000:
                        published.clear()
                    published.add(digest)
                    keys = bands.keys(own)
                    held.append((keys, np.full(len(keys), code_of(digest, len(own)))))
                    size += len(keys)
                    if size > GATHER_KEYS:
                        yield out()
                        held, size = [], 0
        if size:
            yield out()

    def meet(group: pa.Table) -> list[pa.Array]:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("keys")])
        wide = np.zeros((len(keys), 8), np.uint8)
        wide[:, :CODE_BYTES] = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in group.column("codes")]).reshape(-1, CODE_BYTES)
        codes = wide.view(np.int64).ravel()
        place = codes & ((1 << SIZE_BITS) - 1)
        order = np.lexsort((codes, place, keys))
        keys, codes, place = keys[order], codes[order], place[order]
        fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (codes[1:] != codes[:-1])))
        keys, codes, place = keys[fresh], codes[fresh], place[fresh]
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (np.diff(place) > gap))))
        length = np.diff(np.append(starts, len(keys)))
        leader = np.repeat(np.minimum.reduceat(codes, starts), length)
        shared = np.repeat(length > 1, length)
        leader, codes = leader[shared], codes[shared]
        order = np.lexsort((codes, leader))
        leader, codes = leader[order], codes[order]
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (leader[1:] != leader[:-1]) | (codes[1:] != codes[:-1])
        return [pa.array(leader[fresh]), pa.array(codes[fresh])]

    dealt = texts.mapInArrow(deal, "pack long, keys binary, codes binary")
    return each_group(dealt, ["pack"], meet, "leader long, code long").distinct()


def linked(percent: int):
    """Work on a block pair: edges of a spanning forest of the pairs that sketches let through."""

    def work(group: pa.Table) -> list[pa.Array]:
        group = group.sort_by([("size", "ascending"), ("row", "ascending")])
        rows, size, mine = (group.column(c).to_numpy() for c in ("row", "size", "mine"))
        crossing = group.column("i")[0] != group.column("j")[0]
        sketches = folded(group.column("sketch").to_pylist())
        reach = np.searchsorted(size, size * 100 // percent, side="right")
        forest, out = Forest(len(rows)), []
        for a in range(len(rows) - 1):
            other = np.arange(a + 1, reach[a])
            if crossing:
                other = other[mine[other] != mine[a]]
            apart = np.bitwise_count(sketches[other] ^ sketches[a]).sum(axis=1)
            for b in other[apart <= (size[other] + size[a]) * (100 - percent) // (100 + percent)].tolist():
                if forest.join(a, b):
                    out.append((rows[a], rows[b]))
        return [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())]

    return work


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets have in common."""
    size = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), size)
    _, gram, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    some = held[gram] > 1  # an n-gram of one set only is shared by no pair
    owner, gram = owner[some], gram[some]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], np.cumsum(np.diff(gram[order], prepend=gram[order][:1]) > 0)
    out = np.zeros((len(sets), len(sets)), np.int64)
    bounds = np.searchsorted(gram, np.arange(0, (gram[-1] if len(gram) else -1) + GRAM_BLOCK + 1, GRAM_BLOCK))
    for a, b in zip(bounds, bounds[1:]):
        part = np.zeros((len(sets), GRAM_BLOCK), np.float32)
        part[owner[a:b], gram[a:b] % GRAM_BLOCK] = 1
        out += (part @ part.T).astype(np.int64)  # exact: far below 2^24
    return out


def verified(percent: int):
    """Work on a block pair: edges (a, b) of a spanning forest of its links, and (a, a, documents linked with a by them)."""

    def work(group: pa.Table) -> list[pa.Array]:
        rows, size, mine, copies = (group.column(c).to_numpy() for c in ("row", "size", "mine", "copies"))
        both = shared([np.frombuffer(x, np.uint64) for x in group.column("own").to_pylist()])
        link = 100 * both >= percent * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(link, False)
        if group.column("i")[0] != group.column("j")[0]:
            link &= mine[:, None] != mine[None, :]
        n_links, left, edges = link @ copies, np.ones(len(rows), bool), []
        for start in range(len(rows)):
            waiting = [start] if left[start] else []
            left[start] = False
            while waiting:
                a = waiting.pop()
                new = np.flatnonzero(link[a] & left)
                left[new] = False
                edges.append(np.stack((np.full(len(new), rows[a]), rows[new])))
                waiting += new.tolist()
        a, b = np.concatenate(edges, axis=1)
        some = np.flatnonzero(n_links)
        return [pa.array(np.concatenate((a, rows[some]))), pa.array(np.concatenate((b, rows[some]))), pa.array(np.concatenate((np.zeros(len(a), np.int64), n_links[some])))]

    return work


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, n: int = WORDS, links: bool = False) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links).

    With ``links`` also n_links, the number of other documents (rows) that it links with directly, equal texts included.
    """
    small_batches(docs.sparkSession)
    sets = read_sets(docs, id_col, text_col, n)
    # One row for each set: its first row stands for it.
    one = settled(sets.groupBy("digest").agg(F.min_by(F.struct("row", "id", "size", "code", "sketch"), "row").alias("s"), F.count("*").alias("copies")).select("digest", "s.*", "copies"), "distinct-sets")
    grams = sets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    candidates = settled(led(docs.select(F.col(text_col).cast("string").alias("text")), grams, percent, n), "candidates")
    met = in_blocks(candidates, "leader", "code", SKETCH_BLOCK).join(one.select("code", "row", "size", "sketch"), "code")
    # Written before its components, so that a stage runs one Arrow step and an executor no more Python workers than cores.
    near = settled(each_group(met, ["leader", "i", "j"], linked(percent), "a long, b long"), "near")
    family = components(near)
    members = settled(family.join(one.select(F.col("row").alias("id"), F.col("id").alias("doc"), "digest", "size", "copies"), "id")
                      .select("label", F.col("id").alias("row"), "doc", "digest", "size", "copies"), "families")

    def exact_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, packed = texts_of(batch.column(1)), []
            for part in packs(texts):
                packed += [x.tobytes() for x in shingles(texts[part], n)]
            digest = pa.array([hashlib.blake2b(x, digest_size=16).hexdigest() for x in packed], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), digest, pa.array(packed, pa.binary())], names=["doc", "digest", "own"])

    # Texts are fetched by id; a null id is looked up as -1, and the digest tells rows of one id apart.
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-1))
    wanted = members.select(F.coalesce("doc", F.lit(-1)).alias("doc")).distinct()
    texts = docs.select(key.alias("doc"), F.col(text_col).cast("string").alias("text")).join(wanted, "doc", "left_semi")
    own = texts.mapInArrow(exact_set, "doc long, digest string, own binary").groupBy("digest").agg(F.first("own").alias("own"))
    full = in_blocks(members.select("label", "row", "digest", "size", "copies"), "label", "row", SET_BLOCK).join(own, "digest")
    found = settled(each_group(full, ["label", "i", "j"], verified(percent), "a long, b long, n long"), "links")
    label = components(found)
    direct = found.where("a = b").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n"))
    placed = one.select("digest", "row", "size", "copies").join(label.withColumnRenamed("id", "row"), "row", "left").join(direct, "row", "left")
    placed = placed.select("digest", F.when(F.col("size") > 0, F.coalesce("label", "row")).alias("component"),
                           F.when(F.col("size") > 0, F.col("copies") - 1 + F.coalesce("n", F.lit(0))).otherwise(0).alias("n_links"))
    rows = sets.select("row", "id", "size", "digest").join(placed, "digest").select("id", "size", "n_links", F.coalesce("component", -F.col("row") - 1).alias("component"))
    least = rows.groupBy("component").agg(F.min("id").alias("component_id"))
    return rows.join(least, "component").select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id", *(["n_links"] if links else []))


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, n: int = WORDS) -> DataFrame:
    """docs with one row of each component: that of the smallest id, of equal ids the one with the smallest text hash.

    Rows are told apart by id and text, so a different text under a removed row's id stays unless its own component has a
    better row, and of repeated rows one stays. A row without an id stays only where its component has no other. Rows
    without words link with nothing and stay.
    """
    names = docs.columns
    key = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    found = join(keyed, id_col="key", text_col="text", percent=percent, n=n)
    label = found.where("n_shingles > 0").select("key", "component_id").distinct()
    # Columns by place, so that no name clashes; a row number of 1 is reduced on the map side of its shuffle.
    frame = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumn("key", F.xxhash64(
        F.col(f"c{names.index(id_col)}").cast("long"), F.col(f"c{names.index(text_col)}").cast("string")))
    placed = frame.join(label, "key", "left")
    best = Window.partitionBy("component_id").orderBy(F.asc_nulls_last(F.col(f"c{names.index(id_col)}").cast("long")), "key")
    linked = placed.where(F.col("component_id").isNotNull()).withColumn("rank", F.row_number().over(best)).where("rank = 1")
    alone = placed.where(F.col("component_id").isNull())
    both = linked.select(*frame.columns).unionByName(alone.select(*frame.columns))
    return both.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(names)))
