"""Sampled segmentations: forward filtering, backward sampling over the lattice.

Forward: the weight of all segmentations that end at a position, for every
position of every distinct unit; kept for units seen before. Backward: from the
end of a unit an incoming piece is drawn in proportion to its share of that
weight, until the start is reached. All occurrences of a batch are drawn together,
step by step. The draws are hashes of the row's key, the unit's place in its text
and the step, so a text's segmentation depends on nothing else and any task that
repeats the row repeats it.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.llm.common import Batches, mix, per_process, slices, utf8
from docindex.llm.pieces import Pieces, default_path

SEED = 1
REMEMBERED = 300_000  # units


class Lattices:
    """The lattices of units, as one table of states and incoming edges."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.reset()

    def reset(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.states = 0
        # Of each state its first edge, with an end; edges of a state lie together.
        self.edge = np.zeros(1, np.int64)
        # Of each edge: cumulative share in its state, characters, first id, number of ids.
        self.share, self.chars = np.zeros(0), np.zeros(0, np.int8)
        self.first, self.many = np.zeros(0, np.int32), np.zeros(0, np.int8)
        self.fallback: dict[int, list[int]] = {}

    def learn(self) -> None:
        """Add the units numbered since the last call: all of their pieces, found
        by walking the vocabulary's trie from every character at once, and the
        forward weights, position by position."""
        new = list(itertools.islice(self.number, len(self.start), None))
        if not new:
            return
        codes = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.array([len(u) for u in new], np.int64)
        first_char = np.cumsum(length) - length
        unit = np.repeat(np.arange(len(new)), length)
        end, chars, ids, weight = self._edges(codes, (first_char + length)[unit])

        # A unit's states are its positions, 0 included.
        state = end + unit[end - 1]
        position = end - first_char[unit[end - 1]]
        order = np.lexsort((chars, state, position))
        end, chars, ids, weight, state, position = (x[order] for x in (end, chars, ids, weight, state, position))
        alpha = np.zeros(len(codes) + len(new))
        cumulative = np.empty(len(end))
        bounds = np.flatnonzero(np.concatenate([[True], np.diff(position) != 0, [True]]))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            value = alpha[state[lo:hi] - chars[lo:hi]] + weight[lo:hi]
            heads = np.flatnonzero(np.concatenate([[True], np.diff(state[lo:hi]) != 0]))
            many = np.diff(np.append(heads, hi - lo))
            top = np.maximum.reduceat(value, heads)
            share = np.exp(value - np.repeat(top, many))
            # Each state sums its own edges, so its shares depend on nothing else.
            row = np.repeat(np.arange(len(heads)), many)
            nth = np.arange(hi - lo) - heads[row]
            sums = np.zeros((len(heads), int(many.max())))
            sums[row, nth] = share
            sums = np.cumsum(sums, axis=1)
            alpha[state[lo + heads]] = top + np.log(sums[:, -1])
            cumulative[lo:hi] = (sums / sums[:, -1:])[row, nth]

        order = np.lexsort((chars, state))
        ids, many = ids[order], np.ones(len(ids), np.int8)
        for k in np.flatnonzero(ids < 0).tolist():  # bytes of a character without a piece
            own = [self.pieces.byte_ids[x] for x in chr(codes[end[order[k]] - 1]).encode()]
            self.fallback[len(self.share) + k] = own
            ids[k], many[k] = own[0], len(own)
        self.start = np.concatenate([self.start, self.states + first_char + np.arange(len(new))])
        self.length = np.concatenate([self.length, length])
        edges = np.bincount(state, minlength=len(codes) + len(new))
        self.edge = np.concatenate([self.edge, len(self.share) + np.cumsum(edges)])
        self.share = np.concatenate([self.share, cumulative[order]])
        self.chars = np.concatenate([self.chars, chars[order].astype(np.int8)])
        self.first = np.concatenate([self.first, ids.astype(np.int32)])
        self.many = np.concatenate([self.many, many])
        self.states += len(codes) + len(new)

    def _edges(self, codes: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(end, characters, id or -1 for bytes, log-weight)`` of every piece at
        every place; ``limit``: where the unit of a character ends."""
        trie = self.pieces.trie
        active, node, depth = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
        alone = np.zeros(len(codes), bool)
        found = []
        while len(active):
            inside = active + depth < limit[active]
            active, node = active[inside], node[inside]
            key = (node << 21) | codes[active + depth]
            i = np.minimum(np.searchsorted(trie.keys, key), len(trie.keys) - 1)
            known = trie.keys[i] == key
            active, node = active[known], trie.next[i[known]]
            depth += 1
            piece = trie.piece[node]
            hit = piece >= 0
            if depth == 1:
                alone[active[hit]] = True
            found.append((active[hit] + depth, np.full(hit.sum(), depth), piece[hit], trie.weight[node[hit]]))
        rest = np.flatnonzero(~alone)
        size = 1 + (codes[rest] >= 0x80) + (codes[rest] >= 0x800) + (codes[rest] >= 0x10000)
        found.append((rest + 1, np.ones(len(rest), np.int64), np.full(len(rest), -1), size * self.pieces.byte_weight))
        return tuple(np.concatenate(x) for x in zip(*found))

    def sample(self, units: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn for each occurrence, in text order, and how many each has."""
        base, left = self.start[units], self.length[units].copy()
        active = np.arange(len(units))
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        counts = np.zeros(len(units), np.int64)
        seed = mix(keys ^ mix(places.astype(np.uint64) + np.uint64(1)))
        step = 0
        while len(active):
            u = (mix(seed[active] + np.uint64(step)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            edge = self._drawn(base[active] + left[active], u)
            drawn.append((active, edge))
            counts[active] += 1
            left[active] -= self.chars[edge]
            active = active[left[active] > 0]
            step += 1
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for step, (who, edge) in enumerate(drawn):
            out[ends[who] - 1 - step] = edge
        return out, counts

    def _drawn(self, states: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The first edge of each state whose cumulative share is above ``u``; the
        last, should rounding leave none."""
        low, high = self.edge[states], self.edge[states + 1] - 1
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            above = self.share[middle] > u[open_]
            high[open_[above]] = middle[above]
            low[open_[~above]] = middle[~above] + 1

    def ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of edges, and how many each edge has."""
        many = self.many[edges].astype(np.int64)
        ids = np.repeat(self.first[edges], many)
        ends = np.cumsum(many)
        for k in np.flatnonzero(many > 1).tolist():
            ids[ends[k] - many[k] : ends[k]] = self.fallback[int(edges[k])]
        return ids, many


class Sample:
    """Texts to sampled ids and what they decode to."""

    def __init__(self, path: str, seed: int) -> None:
        self.path, self.seed = path, seed

    def __call__(self, batches: Batches) -> Batches:
        lattices = per_process(f"lattices {self.path}", lambda: Lattices(Pieces(self.path)))
        for batch in (part for whole in batches for part in slices(whole, 2 << 20)):
            if len(lattices.number) > REMEMBERED:
                lattices.reset()
            number = lattices.number.__getitem__
            texts = [t.decode() if t else "" for t in utf8(batch.column("text"))]
            docs = [np.array(list(map(number, lattices.pieces.units(t))), np.int64) for t in texts]
            lattices.learn()
            sizes = np.array([len(d) for d in docs], np.int64)
            keys = [xxhash.xxh64_intdigest(str(k.as_py()), seed=self.seed) for k in batch.column("doc")]
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            units = np.concatenate([np.zeros(0, np.int64), *docs])
            edges, counts = lattices.sample(units, np.repeat(np.array(keys, np.uint64), sizes), places)
            ids, many = lattices.ids(edges)
            # From ids per edge and edges per unit to ids per text.
            bound = np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]]
            every = ids.tolist()
            del units, edges, places, docs
            decode = lattices.pieces.decode
            decoded = [decode(every[i:j]) for i, j in zip(bound[:-1].tolist(), bound[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text"),
                    pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(decoded, pa.binary()).cast(pa.string()),
                ],
                ["doc", "text", "ids", "decoded"],
            )


def sample_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, seed: int = SEED
) -> DataFrame:
    """``(doc, text, ids, decoded)`` per row of ``docs``: a sampled segmentation and
    the text that it decodes to, which always is the text.

    The row key is the id, so a row gets the same ids in any run, at any place; rows that repeat an
    id and a text get equal ids, and NULL ids share one key. A NULL or empty text
    has no ids and decodes to the empty text. Extra columns are ignored; an empty
    table gives an empty one.
    """
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    sample = Sample(path or default_path(), seed)
    return texts.mapInArrow(sample, f"doc {kind}, text string, ids array<int>, decoded string")
