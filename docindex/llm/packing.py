"""Concatenate and cut: documents as one stream of token ids, cut into sequences.

Pass one tokenises; a task notes where each of its documents starts among its own
tokens. Prefix sums over the tasks' totals (one row each) then give every document
its place in the whole stream. Pass two cuts the stored ids at multiples of the
capacity: each document becomes one piece per sequence it touches, and the pieces
note whether the document began before or goes on after. Nothing but the totals
is exchanged, and only the last sequence of all is padded.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docindex.llm.common import Batches, bounded, frequent, one_thread, parts, per_process, runs, slices, staged, utf8

VOCABULARY_FILE = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 2048

# Pieces of text whose ids a Python worker remembers at a time.
REMEMBERED = 500_000
TOGETHER = 1 << 12  # pieces encoded by one call
# Between a letter or digit and one of these the tokenizer always cuts; with a
# space there, fewer different pieces remain.
_CUT = re.compile(r"[.,;:!?#*$%&|](?<=[^\W_].)")

# Texts with these are cut at white space only: "<|" may begin a special token,
# whose case counts, and the lower case of the dotted I ends in a non-letter.
_DOTTED_I = "\u0130".encode()


class PieceIds:
    """Ids of pieces of text. The tokenizer lower-cases and never joins characters
    across white space, so a text's ids are those of its pieces."""

    def __init__(self, path: str) -> None:
        self.tokenizer = one_thread(path)
        # Whether an id ends a word; nowhere, if the vocabulary does not mark that.
        self._last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if mark:
            self._last[[i for entry, i in self.tokenizer.get_vocab(False).items() if entry.endswith(mark)]] = True
        self._forget()

    def _forget(self) -> None:
        self._number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        # The ids of all pieces; of each piece, where its own begin, how many they are
        # and how often it was met.
        self._ids = np.zeros(0, "<u4")
        self._begin, self._size, self._met = (np.zeros(0, np.int64) for _ in range(3))

    def _forget_rare(self) -> None:
        kept, pieces = frequent(self._met), list(self._number)
        size = self._size[kept]
        ids = runs(self._ids, self._begin[kept], size)
        self._forget()
        for i in kept.tolist():
            self._number[pieces[i]]
        self._ids, self._begin, self._size, self._met = ids, np.cumsum(size) - size, size, np.zeros(len(size), np.int64)

    @staticmethod
    def cut(text: bytes | None) -> str:
        """The text with white space between its pieces."""
        if not text:
            return ""
        if b"<|" in text or _DOTTED_I in text:
            return text.decode()
        return _CUT.sub(r" \g<0>", text.lower().decode())

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return parts(*self.laid_out(texts)).to_pylist()

    def laid_out(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if len(self._size) > REMEMBERED:
            self._forget_rare()
        # White space at the ends of a text gives an empty piece, which has no ids.
        docs = pc.ascii_split_whitespace(pa.array(map(self.cut, texts), pa.large_string()))
        found = docs.flatten().dictionary_encode()
        own = found.dictionary.to_pylist()
        number = np.fromiter(map(self._number.__getitem__, own), np.int64, len(own))
        self._learn()
        pieces = number[found.indices.to_numpy()]
        self._met += np.bincount(pieces, minlength=len(self._met))
        sizes = self._size[pieces]
        ends = np.concatenate([[0], np.cumsum(sizes)])[docs.offsets.to_numpy()]
        return runs(self._ids, self._begin[pieces], sizes), np.diff(ends)

    def _learn(self) -> None:
        """Encode the pieces numbered since the last call."""
        texts = list(itertools.islice(self._number, len(self._size), None))
        # Letters alone are one word each.
        plain = np.array([t.lower().isalpha() for t in texts], bool)
        found, at = [self._ids], len(self._ids)
        begin, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for where, encode in ((np.flatnonzero(plain), self._words), (np.flatnonzero(~plain), self._apart)):
            for some in (where[i : i + TOGETHER] for i in range(0, len(where), TOGETHER)):
                ids, counts = encode([texts[i] for i in some.tolist()])
                begin[some], size[some] = at + np.cumsum(counts) - counts, counts
                found.append(ids)
                at += len(ids)
        self._ids = np.concatenate(found)
        self._begin, self._size = np.concatenate([self._begin, begin]), np.concatenate([self._size, size])
        self._met = np.concatenate([self._met, np.zeros(len(texts), np.int64)])

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has: encoded as one
        text, where the ids show the ends of all words."""
        encoded = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(encoded[0].ids, "<u4")
        ends = np.flatnonzero(self._last[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            return ids, np.diff(ends, prepend=0)
        return self._apart(words)

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array(list(itertools.chain.from_iterable(lists)), "<u4"), np.array(list(map(len, lists)), np.int64)


class Tokenise:
    """Texts to ids, little-endian 32 bit, with the end id; and their places within
    the task."""

    def __init__(self, path: str, end_id: int) -> None:
        self.path, self.end = path, end_id

    def __call__(self, batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        pieces = per_process(f"piece ids {self.path}", lambda: PieceIds(self.path))
        at = 0
        for batch in (part for whole in batches for part in slices(whole)):
            ids, lengths = pieces.laid_out(list(utf8(batch.column("text"))))
            ids, lengths = np.insert(ids, np.cumsum(lengths), self.end), lengths + 1
            ends = at + np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array([part] * len(lengths), pa.int32()),
                    pa.array(ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    parts(ids, lengths),
                ],
                ["doc", "part", "start", "tokens", "ids"],
            )
            at = int(ends[-1])


def tokenised(docs: DataFrame, doc_id: str, text: str, path: str, end_id: int) -> DataFrame:
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, part int, start bigint, tokens bigint, ids binary"
    return staged(texts.mapInArrow(Tokenise(path, end_id), schema), "tokens")


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: ``(doc, start, length, ids, doc_tokens, sequence_id,
    offset, begins, ends)``; ``ids`` are little-endian 32-bit integers.

    Every row of ``docs`` is packed, in the order in which tasks read them; NULL
    and empty texts consist of the end id, repeated rows are packed as often as
    they occur, NULL ids stay NULL. Extra columns are ignored; an empty table
    gives an empty one. A run that repeats a task reads the same stored ids, so
    places never shift between the passes.
    """
    stored = tokenised(docs, doc_id, text, path or public_tokenizers.path(VOCABULARY_FILE), end_id)
    totals = stored.groupBy("part").agg(F.sum("tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of pass one.
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    bases = staged(bases, "bases")
    placed = stored.join(bounded(bases, bases.count()), "part")
    placed = placed.withColumn("at", F.col("base") + F.col("start"))
    size = F.lit(capacity).cast("bigint")
    first, last = F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("tokens") - 1) / size)
    pieces = placed.select(
        "doc", "at", "tokens", "ids", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("sequence_id")
    )
    low = F.greatest(F.lit(0), F.col("sequence_id") * size - F.col("at"))
    high = F.least(F.col("tokens"), (F.col("sequence_id") + 1) * size - F.col("at"))
    return pieces.select(
        "doc",
        low.alias("start"),
        (high - low).alias("length"),
        F.substring("ids", (low * 4 + 1).cast("int"), ((high - low) * 4).cast("int")).alias("ids"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        (F.col("at") + low - F.col("sequence_id") * size).alias("offset"),
        (low == 0).alias("begins"),
        (high == F.col("tokens")).alias("ends"),
    )
