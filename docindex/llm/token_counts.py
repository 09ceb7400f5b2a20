"""Token counts of texts by dynamic programming shared along a trie.

The distinct pre-tokens of a slice of rows are put in order and walked as a trie:
the best segmentation of every prefix (unigram forward scores) is computed once
and shared by all pre-tokens that begin with it; a pre-token's end stores its
count. Texts then add up the counts of their pre-tokens. Nothing is exchanged.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.llm.common import Batches, per_process, slices, utf8
from docindex.llm.pieces import Pieces, default_path

REMEMBERED = 800_000  # pre-tokens


class Trie:
    """Counts of pre-tokens; new ones are counted together."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.counts = np.zeros(0, np.int64)

    def trim(self) -> None:
        if len(self.counts) > REMEMBERED:
            self.__init__(self.pieces)

    def learn(self) -> None:
        new = list(itertools.islice(self.number, len(self.counts), None))
        counted = self._walk(sorted(new))
        self.counts = np.concatenate([self.counts, np.array([counted[t] for t in new], np.int64)])

    def _walk(self, ordered: list[str]) -> dict[str, int]:
        """Of each pre-token the pieces of its heaviest segmentation, the fewest if
        several weigh the same. ``ordered``: neighbours share their prefixes."""
        ids, longest, byte = self.pieces.ids, self.pieces.longest, self.pieces.byte_weight
        # One entry per prefix of the branch: (weight, -pieces).
        branch: list[tuple[float, int]] = [(0.0, 0)]
        before, out = "", {}
        for token in ordered:
            shared, most = 0, min(len(before), len(token))
            while shared < most and before[shared] == token[shared]:
                shared += 1
            del branch[shared + 1 :]
            for j in range(shared + 1, len(token) + 1):
                best = None
                for i in range(max(0, j - longest), j):
                    found = ids.get(token[i:j])
                    if found:
                        weight, pieces = branch[i]
                        here = (weight + found[1], pieces - 1)
                        if best is None or here > best:
                            best = here
                if token[j - 1] not in ids:  # this character as bytes
                    n = len(token[j - 1].encode())
                    weight, pieces = branch[j - 1]
                    here = (weight + n * byte, pieces - n)
                    if best is None or here > best:
                        best = here
                branch.append(best)
            out[token] = -branch[-1][1]
            before = token
        return out


class Count:
    """Texts to their numbers of pre-tokens and tokens."""

    def __init__(self, path: str) -> None:
        self.path = path

    def __call__(self, batches: Batches) -> Batches:
        trie = per_process(f"trie {self.path}", lambda: Trie(Pieces(self.path)))
        for batch in (part for whole in batches for part in slices(whole)):
            trie.trim()
            number, units = trie.number.__getitem__, trie.pieces.units
            docs = [np.array(list(map(number, units(t.decode() if t else ""))), np.int64) for t in utf8(batch.column("text"))]
            trie.learn()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array([len(d) for d in docs], pa.int64()),
                    pa.array([int(trie.counts[d].sum()) for d in docs], pa.int64()),
                ],
                ["doc", "pre_tokens", "tokens"],
            )


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``(doc, pre_tokens, tokens)`` per row of ``docs``.

    A NULL or empty text has no tokens; NULL ids stay NULL; repeated rows get
    equal rows. Extra columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    return texts.mapInArrow(Count(path or default_path()), f"doc {kind}, pre_tokens bigint, tokens bigint")
