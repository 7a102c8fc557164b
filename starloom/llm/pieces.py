"""SentencePiece encoding by sampled segmentations, and decoding.

A text is cut before each run of blanks into chunks; pieces of the vocabulary do not cross chunks, so the lattice of a text is
the product of its chunks' lattices, and a pack of texts needs each different chunk's lattice once. A segmentation's
probability is proportional to the product of its pieces' weights, 1 / (rank + ``shift``) to the power ``sharpness``,
where the rank is the piece's place in the vocabulary. Characters that are no piece are spelt in byte pieces; a literal
block character (U+2581) is spelt too, since it stands for a blank in pieces. Decoding gives back every text exactly.

Samples are drawn without replacement by Gumbel top-k: each segmentation's log probability is perturbed with Gumbel
noise, and the k largest are found by best-first (A-star) search. Backward sums over the lattice are an exact bound for
what a partial segmentation can reach, so the perturbed maximum of all its completions can be drawn at once: a node of
the search is a prefix of chunks, one chunk that must differ from the segmentations already taken there, and a free rest.
Taking the best node fixes a new sample and splits the rest of it by the first chunk that differs, each part with a
Gumbel maximum truncated at the node's. The (k+1)-th maximum gives the inclusion score of each sample: the probability
that a segmentation of its log probability exceeds that threshold.

All noise comes from counters hashed with the row's key and the seed, so results depend neither on partitions nor on
other rows.

Defined results: null and empty texts have one segmentation without pieces (log probability 0, inclusion 1); a text with
fewer than k segmentations gets them all, with inclusion 1; repeated rows get equal samples; null keys are a key of their
own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import os
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.scan import mix, packs, small_batches, texts_of

BLOCK_CHARACTER = "▁"
#: Bytes of text for which lattices are built together.
LATTICE_BYTES = 2 << 20
#: Bytes of chunks whose edges are found together; a block holds this many chunks at least, as its steps follow its longest.
BLOCK_BYTES, BLOCK_CHUNKS = 1 << 16, 256
#: Bytes of the character that each byte leads.
WIDTH = np.repeat(np.array([1, 2, 3, 4]), [0x80, 0x60, 0x10, 0x10])


def default_model() -> str:
    """The vocabulary file of the machine's public tokenizers; STARLOOM_PIECES names another one."""
    return os.environ.get("STARLOOM_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


class Vocabulary:
    """Pieces as bytes, their log weights, and a trie of them: its steps (node, byte) in a hashed table, node 0 the root.

    The nodes of the first byte and of the first two bytes, which all positions of a text ask for, have tables of their own.
    """

    def __init__(self, pieces: list[bytes | None], byte_ids: list[int], shift: float, sharpness: float):
        self.pieces, self.byte_ids, self.spellings = pieces, np.array(byte_ids), pa.array(pieces, pa.large_binary())
        self.weight = -sharpness * np.log(np.arange(len(pieces)) + shift)
        self.byte_weight = float(self.weight.min())
        spelt = set(byte_ids)
        steps: dict[int, int] = {}
        piece_at: dict[int, int] = {}
        for i, p in enumerate(pieces):
            if p and i not in spelt:
                node = 0
                for b in p:
                    node = steps.setdefault(node << 8 | b, len(steps) + 1)
                piece_at.setdefault(node, i)
        self.piece_at = np.full(len(steps) + 1, -1)
        self.piece_at[list(piece_at)] = list(piece_at.values())
        keys, following = (np.fromiter(x, np.int64, len(steps)) for x in (steps, steps.values()))
        self.one, self.two, lead = np.full(1 << 8, -1), np.full(1 << 16, -1), np.full(len(steps) + 1, -1)
        top = keys < 1 << 8
        self.one[keys[top]], lead[following[top]] = following[top], keys[top]
        second = lead[keys >> 8] >= 0
        self.two[lead[keys[second] >> 8] << 8 | keys[second] & 0xFF] = following[second]
        self.shift = np.uint64(64 - max(8, (4 * len(steps)).bit_length()))
        slot = self.slots(keys)
        order = np.argsort(slot, kind="stable")
        # Where the steps of each slot begin; few slots have more than one.
        self.keys, self.following = keys[order], following[order]
        self.begins = np.searchsorted(slot[order], np.arange((1 << 64 - int(self.shift)) + 1)).astype(np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that bytes lead to, -1 where no piece goes on."""
        keys = node << 8 | byte
        slot = self.slots(keys)
        place, stop, out = self.begins[slot], self.begins[slot + 1], np.full(len(node), -1)
        near = np.flatnonzero(place < stop)
        place, stop, keys = place[near], stop[near], keys[near]
        while len(near):
            same = self.keys[place] == keys
            out[near[same]] = self.following[place[same]]
            more = np.flatnonzero(~same & (place + 1 < stop))
            near, place, stop, keys = near[more], place[more] + 1, stop[more], keys[more]
        return out

    @classmethod
    def load(cls, model_file: str, shift: float, sharpness: float) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces, byte_ids = [], [0] * 256
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                byte_ids[value] = i
                pieces.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                pieces.append(None)
            else:
                pieces.append(model.id_to_piece(i).replace(BLOCK_CHARACTER, " ").encode())
        return cls(pieces, byte_ids, shift, sharpness)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def decode_all(self, ids: np.ndarray, cut: np.ndarray) -> Iterator[bytes]:
        """What the ids between neighbouring cuts spell."""
        if not len(ids):
            yield from [b""] * (len(cut) - 1)
            return
        spelt = self.spellings.take(pa.array(ids))
        _, places, data = spelt.buffers()
        ends, data = np.frombuffer(places, np.int64)[cut].tolist(), memoryview(data or b"")
        for a, b in zip(ends, ends[1:]):
            yield data[a:b].tobytes()


class Lattices:
    """The lattices of different chunks, laid out one after another: nodes are byte positions, one more for each end.

    Edges are found in blocks of chunks, so that only what walks need is held for all. Chunks come by descending length.
    """

    def __init__(self, chunks: list[bytes], vocabulary: Vocabulary):
        size = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
        self.end = np.cumsum(size) - 1
        self.start = self.end - size + 1
        begins, targets, pieces, logs, shares, paths, a, edges = [], [], [], [], [], [], 0, 0
        while a < len(chunks):
            limit = max(BLOCK_BYTES, BLOCK_CHUNKS * int(size[a]))
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + limit)))
            begin, target, piece, log, share, ways = self.block(chunks[a:b], size[a:b], vocabulary)
            begins.append(begin[:-1] + edges)
            targets.append((target + self.start[a]).astype(np.int32))
            pieces.append(piece.astype(np.int32))
            logs.append(log)
            shares.append(share)
            paths.append(ways)
            edges += len(log)
            a = b
        self.begin = np.append(np.concatenate(begins), edges)
        self.target, self.piece, self.log, self.share, self.paths = (np.concatenate(x) for x in (targets, pieces, logs, shares, paths))

    @staticmethod
    def block(chunks: list[bytes], size: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
        """Of some chunks: where each node's edges begin, the edges' targets, pieces, log probabilities and shares, each node's paths."""
        data = np.frombuffer(b"\0".join(chunks) + b"\0", np.uint8)
        left = np.repeat(np.cumsum(size) - 1, size) - np.arange(len(data))  # bytes to the chunk's end
        source, target, piece = [], [], []
        lead = (data & 0xC0) != 0x80
        width = WIDTH[data]
        known = ~lead | (left == 0)
        at, n = np.flatnonzero(lead & (left > 0)), 0
        while len(at):  # all bytes that go on along the trie
            if n > 1:
                node = vocabulary.step(node, data[at + n])
            else:
                node = vocabulary.two[data[at].astype(np.int64) << 8 | data[at + 1]] if n else vocabulary.one[data[at]]
            n += 1
            on = np.flatnonzero(node >= 0)
            at, node = at[on], node[on]
            ids = vocabulary.piece_at[node]
            some = np.flatnonzero(ids >= 0)
            here = at[some]
            source.append(here)
            target.append(here + n)
            piece.append(ids[some])
            if n <= 4:
                known[here[width[here] == n]] = True
            on = np.flatnonzero(left[at] > n)
            at, node = at[on], node[on]
        spelt = np.flatnonzero(~known)
        spelt = np.concatenate([spelt[width[spelt] > i] + i for i in range(4)])
        source, target, piece = (np.concatenate((*x, y)) for x, y in zip((source, target, piece), (spelt, spelt + 1, vocabulary.byte_ids[data[spelt]])))
        weight = vocabulary.weight[piece]
        weight[len(weight) - len(spelt) :] = vocabulary.byte_weight
        order = np.argsort(source.astype(np.uint16) if len(data) <= 1 << 16 else source, kind="stable")
        source, target, piece, weight = (x[order] for x in (source, target, piece, weight))
        beta, paths = np.where(left == 0, 0.0, -np.inf), (left == 0).astype(np.float64)
        distance = left[source]
        order = np.argsort(distance.astype(np.uint16) if len(source) and distance.max() < 1 << 16 else distance, kind="stable")
        steps = np.flatnonzero(np.concatenate(([True], np.diff(distance[order]) != 0))) if len(source) else np.zeros(0, np.int64)
        with np.errstate(invalid="ignore"):
            for a, b in zip(steps, np.append(steps[1:], len(source))):  # from the ends of chunks backwards
                own = order[a:b]
                nodes, following = source[own], target[own]
                first = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
                nodes = nodes[first]
                beta[nodes] = np.logaddexp.reduceat(weight[own] + beta[following], first)
                paths[nodes] = np.add.reduceat(paths[following], first)
            log = weight + beta[target] - beta[source]
            likely = np.where(np.isfinite(log), np.exp(log), 0.0)
        order = np.argsort(source + (1 - np.minimum(likely, 1.0)) / 2, kind="stable")  # the likely edges of a node come first
        source, target, piece, log = (x[order] for x in (source, target, piece, log))
        begin = np.concatenate(([0], np.cumsum(np.bincount(source, minlength=len(data)))))
        total = np.cumsum(likely[order])
        share = total - np.concatenate(([0.0], total))[begin[source]]
        share[begin[1:][np.diff(begin) > 0] - 1] = 2.0  # above every draw
        return begin, target, piece, log, share, paths

    def walk(self, chunk: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One sampled path for each entry of ``chunk``: log probabilities, the edges of all paths, and how many each has."""
        now, end = self.start[chunk], self.end[chunk]
        log, active, count, steps = np.zeros(len(chunk)), np.arange(len(chunk)), np.zeros(len(chunk), np.int64), []
        while len(active):
            u = uniform(noise[active] + np.uint64((len(steps) + 1) * 0x9E3779B97F4A7C15 % 2**64))
            edge = self.begin[now[active]]
            later = np.flatnonzero(self.share[edge] <= u)
            while len(later):
                edge[later] += 1
                later = later[self.share[edge[later]] <= u[later]]
            steps.append((active, edge.astype(np.int32)))
            log[active] += self.log[edge]
            target = self.target[edge]
            now[active] = target
            count[active] += 1
            active = active[target != end[active]]
        edges, first = np.zeros(count.sum(), np.int32), np.cumsum(count) - count
        for number, (active, edge) in enumerate(steps):
            edges[first[active] + number] = edge
        return np.where(self.paths[self.start[chunk]] > 1, log, 0.0), edges, count

    def other(self, chunk: int, taken: list[tuple[int, ...]], noise: np.uint64) -> tuple[list[int], float]:
        """A path of a chunk that is none of ``taken``, with its log probability: each step weighs what is left beyond it."""
        node, end, path, log = int(self.start[chunk]), int(self.end[chunk]), [], 0.0
        draws = uniform(noise + np.arange(end - node, dtype=np.uint64))  # a path has no more steps than the chunk has bytes
        held = [(t, self.log[list(t)].tolist()) for t in taken]
        while node != end:
            depth, first, stop = len(path), int(self.begin[node]), int(self.begin[node + 1])
            gone, beyond = [0.0] * (stop - first), [0] * (stop - first)
            for t, logs in held:
                gone[t[depth] - first] += math.exp(sum(logs[depth + 1 :]))
                beyond[t[depth] - first] += 1
            edges = zip(self.log[first:stop].tolist(), gone, self.paths[self.target[first:stop]].tolist(), beyond)
            mass = [math.exp(x) * max(1 - g, 1e-15) if n > m else 0.0 for x, g, n, m in edges]
            steps = list(accumulate(mass))
            pick = bisect_right(steps, float(draws[depth]) * sum(mass))
            if pick == len(mass):
                pick = max(i for i, x in enumerate(mass) if x > 0)
            edge = first + pick
            held = [(t, logs) for t, logs in held if len(t) > depth + 1 and t[depth] == edge]
            path.append(edge)
            log += self.log[edge]
            node = int(self.target[edge])
        return path, float(log)


def uniform(counters: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from counters."""
    with np.errstate(over="ignore"):
        return ((mix(counters) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def below(log_mass: np.ndarray, top: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """Gumbel maxima of subsets with a log mass, truncated at ``top``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        drawn = -np.logaddexp(-top, np.log(-np.log(uniform(noise))) - log_mass)
    return np.where(np.isneginf(log_mass), -np.inf, drawn)


@dataclass
class Sample:
    log: float
    value: float
    ids: np.ndarray


def sample(texts: list[bytes], keys: np.ndarray, vocabulary: Vocabulary, k: int, seed: int) -> list[tuple[list[Sample], float]]:
    """For each text up to k different segmentations by descending perturbed value, and the value that the next one has."""
    first, chunk, different = chunks_of(texts)
    lattices = Lattices(different, vocabulary) if different else None
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    base = mix(keys.astype(np.uint64) + np.uint64(seed * 0xD1342543DE82EF95 % 2**64))
    place = np.arange(len(chunk)) - first[owner] + 1
    noise = lambda leaf, use, at: mix(base[owner[at]] ^ (place[at].astype(np.uint64) << np.uint64(16)) ^ np.uint64(leaf << 4 | use))
    alone = lambda leaf, use: mix(base ^ np.uint64(leaf << 4 | use))
    out: list[list[Sample]] = [[] for _ in texts]
    top = -np.log(-np.log(uniform(alone(0, 1))))  # the largest perturbed value of all segmentations
    leaves: list[dict] = []
    live = np.diff(first) > 0
    ways = lattices.paths[lattices.start[chunk]] if lattices else np.zeros(0)
    for leaf in range(k + 1):
        if leaf == 0:
            value, parent, turn = top, np.full(len(texts), -1), np.zeros(len(texts), np.int64)
        else:  # the best open node of each text: which sample it splits from, and at which chunk
            best = np.stack([maxima(x["open"], first) for x in leaves])
            parent = best.argmax(axis=0)
            value = best[parent, np.arange(len(texts))]
            live = live & np.isfinite(value)
            turn = np.zeros(len(texts), np.int64)
            for number, x in enumerate(leaves):
                for i in np.flatnonzero(live & (parent == number)).tolist():
                    turn[i] = first[i] + int(np.argmax(x["open"][first[i] : first[i + 1]]))
        if leaf == k or not len(chunk):
            break
        free = np.flatnonzero(live[owner] & ((np.arange(len(chunk)) > turn[owner]) | (leaf == 0)))
        log = np.zeros(len(chunk))
        log[free], edges, count = lattices.walk(chunk[free], noise(leaf, 2, free))
        cut = np.zeros(len(chunk) + 1, np.int64)
        cut[free + 1] = count
        np.cumsum(cut, out=cut)
        paths = [edges, cut, {}]  # changed paths by chunk place
        open_ = np.full(len(chunk), -np.inf)
        taken: dict[int, list[tuple[int, ...]]] = {}
        fixed = np.zeros(len(chunk), bool)
        changed_mass: dict[int, float] = {}
        turn_noise = alone(leaf, 3)
        for i in np.flatnonzero(live & (parent >= 0)).tolist() if leaf else []:
            old, at = leaves[parent[i]], int(turn[i])
            before = old["taken"].get(at) or [path_of(old, at)]
            new, new_log = lattices.other(int(chunk[at]), before, turn_noise[i])
            paths[2][at], taken[at] = new, [*before, tuple(new)]
            log[at] = new_log
            log[first[i] : at] = old["log"][first[i] : at]
            fixed[first[i] : at] = True
            rest = 1 - sum(np.exp(sum(lattices.log[e] for e in t)) for t in taken[at])
            left = lattices.paths[lattices.start[chunk[at]]] > len(taken[at])
            changed_mass[at] = float(np.log(max(rest, 1e-15))) if left else -np.inf
            old["open"][at] = -np.inf
        with np.errstate(divide="ignore"):
            mass = np.where(ways > 1, np.log(-np.expm1(np.minimum(log, -1e-16))), -np.inf)
        for at, m in changed_mass.items():
            mass[at] = m
        prefix = np.cumsum(log) - log
        prefix -= np.concatenate((prefix, [0.0]))[first[owner]] if len(chunk) else 0
        ready = np.flatnonzero(live[owner] & ~fixed)
        open_[ready] = below((mass + prefix)[ready], value[owner[ready]], noise(leaf, 4, ready))
        leaves.append({"log": log, "paths": paths, "open": open_, "taken": taken, "parent": parent, "turn": turn})
        total = np.bincount(owner, log, len(texts))
        for i in np.flatnonzero(live).tolist():
            out[i].append(Sample(float(total[i]), float(value[i]), ids_of(leaves, leaf, i, first, lattices)))
    for i in range(len(texts)):
        if first[i] == first[i + 1]:
            out[i] = [Sample(0.0, float(top[i]), np.zeros(0, np.int32))]
    limit = np.where(live & (np.diff(first) > 0), value if len(chunk) else -np.inf, -np.inf)
    return list(zip(out, limit.tolist()))


def chunks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Each text's first chunk (one more: the end), each chunk's number, and the different chunks by descending length."""
    data = b"".join(texts)
    begin = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    blank = np.frombuffer(data, np.uint8) == 0x20
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    cut[begin[:-1][np.diff(begin) > 0]] = True
    at = np.flatnonzero(cut)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)]).dictionary_encode()
    different = words.dictionary
    order = np.argsort(-pc.binary_length(different).to_numpy(), kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return np.searchsorted(at, begin), number[words.indices.to_numpy()], different.take(pa.array(order)).to_numpy(zero_copy_only=False).tolist()


def maxima(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest value of each text; minus infinity for a text without chunks."""
    out = np.full(len(first) - 1, -np.inf)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        out[some] = np.maximum.reduceat(values, first[some])
    return out


def path_of(leaf: dict, at: int) -> tuple[int, ...]:
    """The edges of a sample's path through the chunk at a place."""
    edges, cut, changed = leaf["paths"]
    return tuple(changed[at]) if at in changed else tuple(edges[cut[at] : cut[at + 1]].tolist())


def ids_of(leaves: list[dict], leaf: int, i: int, first: np.ndarray, lattices: Lattices) -> np.ndarray:
    """Piece ids of a sample: its own chunks from where it turned, and its parent's before."""
    parts, stop = [], int(first[i + 1])
    while True:
        own = leaves[leaf]
        edges, cut, changed = own["paths"]
        begin = int(first[i]) if own["parent"][i] < 0 else int(own["turn"][i])
        inner = begin
        part = []
        if begin in changed and begin < stop:
            part.append(lattices.piece[changed[begin]])
            inner = begin + 1
        if inner < stop:
            part.append(lattices.piece[edges[cut[inner] : cut[stop]]])
        parts = part + parts
        if own["parent"][i] < 0:
            return np.concatenate(parts).astype(np.int32)
        stop, leaf = begin, int(own["parent"][i])


def inclusion(log: float, limit: float) -> float:
    """The probability that a segmentation's perturbed value exceeds the limit."""
    return 1.0 if limit == -np.inf else float(-np.expm1(-np.exp(min(log - limit, 50.0))))


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None, k: int = 2, seed: int = 1,
           shift: float = 10.0, sharpness: float = 1.0, with_ids: bool = True) -> DataFrame:
    """Up to k rows per document: key, sample (from 1), n_pieces, log_prob, inclusion, ids, ids_sha256, exact.

    ``exact`` says whether decoding gives the text back; ``ids`` is left out on request, its hash (of the ids as 32-bit
    little-endian numbers) stays.
    """
    small_batches(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file or default_model(), shift, sharpness))
    kinds = [("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()), ("inclusion", pa.float64()), ("ids_sha256", pa.string()), ("exact", pa.bool_())]
    if with_ids:
        kinds.append(("ids", pa.list_(pa.int32())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = texts_of(batch.column(2)), batch.column(1).to_numpy()
            for part in packs(texts, LATTICE_BYTES):
                at, rows, ids = [], [], []
                for i, (found, limit) in enumerate(sample(texts[part], keys[part], known.value, k, seed), part.start):
                    for number, s in enumerate(found, 1):
                        at.append(i)
                        ids.append(s.ids)
                        rows.append((number, len(s.ids), s.log, inclusion(s.log, limit), hashlib.sha256(s.ids.tobytes()).hexdigest()))
                cut, ids = np.cumsum([0, *map(len, ids)]), np.concatenate([np.zeros(0, np.int32), *ids])
                columns = [*([r[c] for r in rows] for c in range(5)), [spelt == texts[i] for i, spelt in zip(at, known.value.decode_all(ids, cut))]]
                columns = [pa.array(x, kind) for x, (_, kind) in zip(columns, kinds)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=["key", *(name for name, _ in kinds)])

    key = F.col(id_col)
    small = docs.select(key.alias("key"), F.xxhash64(key).alias("hash"), F.col(text_col).cast("string").alias("text"))
    ddl = "sample int, n_pieces long, log_prob double, inclusion double, ids_sha256 string, exact boolean" + (", ids array<int>" if with_ids else "")
    return small.mapInArrow(run, f"key {docs.schema[id_col].dataType.simpleString()}, {ddl}").withColumnRenamed("key", id_col)


def decode(rows: DataFrame, *, ids_col: str = "ids", into: str = "text", model_file: str | None = None) -> DataFrame:
    """rows with the text that piece ids spell (null for null ids); an existing column of that name is replaced."""
    known = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file or default_model(), 10.0, 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else known.value.decode(x).decode("utf-8", "replace") for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*batch.schema.names[1:], "spelt"])

    kept = [c for c in rows.columns if c != into]
    plain = rows.select(F.col(ids_col), *kept).toDF("ids", *(f"c{i}" for i in range(len(kept))))
    schema = T.StructType([*plain.schema.fields[1:], T.StructField("spelt", T.StringType())])
    return plain.mapInArrow(run, schema).toDF(*kept, into)
