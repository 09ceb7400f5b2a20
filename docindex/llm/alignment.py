"""Tokens of two tokenizers aligned by lockstep vectorised merging.

Both tokenizers are read as cuts of the same bytes (a space and the text). One NumPy
state vector holds a pointer pair (A, B) for every document of a slice; each step
compares the ends of all pairs at once, emits a link and a cut where they are equal,
moves the pointer that is behind (both where equal) and drops the finished ones.
Long documents enter as several *lanes* that start at fixed byte offsets, since equal
ends in one range of bytes do not depend on any other range; so the number of steps
is bounded by the tokens of a lane, not of the longest document.

1. Texts are tokenised and aligned where they lie; ids and cuts are written. Both
   tokenizers see each unit between two safe cuts once; a worker remembers the units
   it meets most often, a bounded number, and drops them before the later stages.
2. How often each id pair is linked is counted over the whole corpus, combined in the
   tasks first; the highest count of each B id is taken from that table.
3. The written rows look their links up. Pairs with a share of all links above
   ``1 / COMMON`` (at most ``COMMON`` pairs) are broadcast; where there are more, the
   rest is joined by a shuffle, so neither size nor a frequent pair gets in the way.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docindex.llm.common import Batches, frequent, one_thread, parts, per_process, release, runs, slices, staged, text_key, utf8

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"
LANE = 256  # bytes
REMEMBERED = 200_000  # units
TOGETHER = 1 << 12  # units encoded by one call
JOINED = 64  # units in one text of such a call
SLICE = 1 << 20  # bytes of texts or ids handled at once
COMMON = 1_000_000
COUNTED = 1_000_000  # pairs a task counts before it hands them on

# Both tokenizers cut before a space that stands between two other characters:
# A binds such a space to what follows, B has no piece with a space inside.
_UNIT = re.compile(r"(?<=\S)(?= \S)")

# A also cuts between these letters or digits and these marks, and so does B with
# those marks that no piece has behind one. A unit that begins with a mark is
# encoded behind JOINT, whose ids are dropped.
_LETTER, _MARKS = "A-Za-z0-9À-ÖØ-öø-ÿ", ".,;:!?"
JOINT = " a"


def _byte_values() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: visible bytes stand for
    themselves, the others follow from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers; the ids of units of text, remembered."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a = one_thread(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        values = _byte_values()
        self.a_size = self.a.get_vocab_size()
        self.a_bytes = [b""] * self.a_size
        for entry, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(map(values.__getitem__, entry)) if all(c in values for c in entry) else b""
        self.b_size = self.b.get_piece_size()
        self.b_bytes = []
        for i in range(self.b_size):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(
                bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()
            )
            if self.b.is_control(i) or self.b.is_unknown(i):
                continue
            if re.search(rf"[^{SPACE_MARK}]{SPACE_MARK}", piece):
                raise ValueError(f"{b_path}: the piece {piece!r} reaches across a word")
        self._entries = pa.array(self.a_bytes, pa.binary()), pa.array(self.b_bytes, pa.binary())
        self.a_lengths, self.b_lengths = (pc.binary_length(x).to_numpy().astype(np.int64) for x in self._entries)
        pieces = "\n".join(map(self.b.id_to_piece, range(self.b_size)))
        marks = "".join(sorted(set(_MARKS) - set(re.findall(rf"(?<=[{_LETTER}])[{_MARKS}]", pieces))))
        self._cut = re.compile(rf"[{marks}](?<=[{_LETTER}].)") if marks else None
        self._joint = [len(self._lists(side, [JOINT])[0]) for side in (0, 1)]
        self._forget()

    def _forget(self) -> None:
        # A unit's key: its text after NUL, or just the word if it is a space and a word.
        self._number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        # Of A and of B: the ids of all units, and where each unit's begin and how many
        # they are.
        self._ids = [np.zeros(0, np.uint32) for _ in "ab"]
        self._begin = [np.zeros(0, np.int64) for _ in "ab"]
        self._size = [np.zeros(0, np.int64) for _ in "ab"]
        # Whether the bytes of a unit's ids are the unit's; whether white space at its
        # ends forbids to cut there; how often it was met.
        self._same, self._odd = np.zeros(0, bool), np.zeros(0, bool)
        self._met = np.zeros(0, np.int64)

    def _forget_rare(self) -> None:
        kept = frequent(self._met)
        keys = list(self._number)
        ids, sizes = zip(*(self._of_units(side, kept) for side in (0, 1)))
        same, odd = self._same[kept], self._odd[kept]
        self._forget()
        for i in kept.tolist():
            self._number[keys[i]]
        self._ids, self._size = [x.astype(np.uint32) for x in ids], list(sizes)
        self._begin = [np.cumsum(n) - n for n in sizes]
        self._same, self._odd, self._met = same, odd, np.zeros(len(kept), np.int64)

    def _learn(self) -> None:
        """Encode the units numbered since the last call."""
        keys = list(itertools.islice(self._number, len(self._same), None))
        if not keys:
            return
        texts, odd, jointed = [], np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for i, key in enumerate(keys):
            if key[:2] == "\0 ":
                texts.append(key[1:])
            elif not key or key != key.strip():
                texts.append("")
                odd[i] = True
            elif key[0] == "\0":
                texts.append(JOINT + key[1:])
                jointed[i] = True
            else:
                texts.append(" " + key)
        self._odd = np.concatenate([self._odd, odd])
        self._met = np.concatenate([self._met, np.zeros(len(keys), np.int64)])
        for at in range(0, len(texts), TOGETHER):
            part, skipped = texts[at : at + TOGETHER], jointed[at : at + TOGETHER]
            raw = [t.encode() for t in part]
            same = np.ones(len(part), bool)
            for side in (0, 1):
                ids, begin, own = self._encoded(side, part, raw)
                same &= own
                skip = np.where(skipped, self._joint[side], 0)
                self._begin[side] = np.concatenate([self._begin[side], len(self._ids[side]) + begin[:-1] + skip])
                self._size[side] = np.concatenate([self._size[side], np.diff(begin) - skip])
                self._ids[side] = np.concatenate([self._ids[side], ids])
            self._same = np.concatenate([self._same, same])

    def _lists(self, side: int, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space, which B adds itself."""
        if side == 0:
            return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return self.b.encode([t[1:] for t in texts], num_threads=1)

    def _encoded(self, side: int, texts: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of texts one after another, where each one's begin, with the end of
        the last, and whether their bytes are the text's."""
        stops = np.cumsum([0, *map(len, raw)])
        if not any(t[-1:].isspace() for t in texts):
            # Both cut between such texts, so they are encoded joined.
            groups = ["".join(texts[at : at + JOINED]) for at in range(0, len(texts), JOINED)]
            lists = self._lists(side, [g for g in groups if g])
            ids = np.fromiter(itertools.chain.from_iterable(lists), np.uint32)
            ends = np.cumsum([0, *(self.a_lengths, self.b_lengths)[side][ids]])
            begin = np.searchsorted(ends, stops)
            if ends[-1] == stops[-1] and (ends[begin] == stops).all():
                joined = self._entries[side].take(pa.array(ids)).buffers()[2]
                if joined is not None and joined.to_pybytes()[: ends[-1]] == b"".join(raw):
                    return ids, begin, np.ones(len(raw), bool)
        lists = iter(self._lists(side, [t for t in texts if t]))
        lists = [next(lists) if t else [] for t in texts]
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.uint32)
        begin = np.cumsum([0, *map(len, lists)])
        return ids, begin, self._comes_back(side, raw, ids, begin)

    def _comes_back(self, side: int, raw: list[bytes], ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Whether the bytes of each unit's ids are the unit's."""
        entries = self._entries[side]
        sizes = np.array(list(map(len, raw)))
        ends = np.concatenate([[0], np.cumsum((self.a_lengths, self.b_lengths)[side][ids])])[begin]
        if (np.diff(ends) == sizes).all():
            joined = entries.take(pa.array(ids)).buffers()[2]
            if joined is not None and joined.to_pybytes()[: ends[-1]] == b"".join(raw):
                return np.ones(len(raw), bool)
        plain = (self.a_bytes, self.b_bytes)[side].__getitem__
        listed = ids.tolist()
        return np.array([b"".join(map(plain, listed[i:j])) == r for r, i, j in zip(raw, begin[:-1], begin[1:])], bool)

    def _of_units(self, side: int, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units one after another, and how many each has."""
        begin, sizes = self._begin[side][units], self._size[side][units]
        return runs(self._ids[side], begin, sizes).astype(np.int64), sizes

    def _keys(self, text: str) -> list[str]:
        """Keys of the units of a text; white space beside white space or at an end of
        the text shows in a key."""
        if "\0" in text:
            return self._plain_keys(text)
        return (self._cut.sub(r" \0\g<0>", text) if self._cut else text).split(" ")

    @staticmethod
    def _plain_keys(text: str) -> list[str]:
        return ["\0" + unit for unit in _UNIT.split(" " + text)]

    @staticmethod
    def _laid_out(docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        units = np.fromiter(itertools.chain.from_iterable(docs), np.int64)
        return units, np.repeat(np.arange(len(docs)), [len(d) for d in docs])

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all texts, one after another, and both numbers of ids
        of each. NULL and empty texts, and those whose bytes do not come back, have
        none."""
        if len(self._same) > REMEMBERED:
            self._forget_rare()
        number = self._number.__getitem__
        docs = [list(map(number, self._keys(raw.decode()))) if raw else [] for raw in texts]
        self._learn()
        units, owner = self._laid_out(docs)
        odd = np.unique(owner[self._odd[units]]).tolist()
        if odd:
            for i in odd:
                docs[i] = list(map(number, self._plain_keys(texts[i].decode())))
            self._learn()
            units, owner = self._laid_out(docs)
        self._met += np.bincount(units, minlength=len(self._met))
        # A unit that does not come back leaves its whole document without tokens.
        good = np.bincount(owner[~self._same[units]], minlength=len(docs)) == 0
        units, owner = units[good[owner]], owner[good[owner]]
        (a, in_a), (b, in_b) = (self._of_units(side, units) for side in (0, 1))
        n_a, n_b = (np.bincount(owner, sizes, len(docs)).astype(np.int64) for sizes in (in_a, in_b))
        return a, b, n_a, n_b


def merge(a_ends: np.ndarray, b_ends: np.ndarray, starts: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of A and of B where both end at the same byte.

    ``a_ends`` and ``b_ends`` are the rising ends of the tokens of all documents laid
    one after another, ``starts`` the documents' first bytes, with the end of the last.
    """
    sizes = np.diff(starts)
    lanes = -(-sizes // lane)
    first = np.repeat(np.cumsum(lanes) - lanes, lanes)
    low = np.repeat(starts[:-1], lanes) + lane * (np.arange(len(first)) - first)
    high = np.minimum(low + lane, np.repeat(starts[1:], lanes))
    i, j = np.searchsorted(a_ends, low, "right"), np.searchsorted(b_ends, low, "right")
    i_stop, j_stop = np.searchsorted(a_ends, high, "right"), np.searchsorted(b_ends, high, "right")
    a_links, b_links = [], []
    while True:
        going = (i < i_stop) & (j < j_stop)
        if not going.all():
            i, j, i_stop, j_stop = i[going], j[going], i_stop[going], j_stop[going]
        if not len(i):
            break
        x, y = a_ends[i], b_ends[j]
        equal = x == y
        a_links.append(i[equal])
        b_links.append(j[equal])
        i, j = i + (x <= y), j + (y <= x)
    if not a_links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Links rise in both tokenizers alike.
    return np.sort(np.concatenate(a_links)), np.sort(np.concatenate(b_links))


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def _cuts(n: int, links: np.ndarray) -> np.ndarray:
    flags = np.zeros(n, bool)
    flags[links] = True
    return flags


class Align:
    """Texts to ids and cut flags, one byte-packed value of each per row."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.paths = a_path, b_path

    def __call__(self, batches: Batches) -> Batches:
        pair = per_process(f"pair {self.paths}", lambda: Pair(*self.paths))
        part, seen = TaskContext.get().partitionId(), 0
        for batch in (part for whole in batches for part in slices(whole, SLICE)):
            a, b, n_a, n_b = pair.encode(list(utf8(batch.column("text"))))
            a_ends, b_ends = np.cumsum(pair.a_lengths[a]), np.cumsum(pair.b_lengths[b])
            ends = np.concatenate([[0], a_ends])[np.concatenate([[0], np.cumsum(n_a)])]
            i, j = merge(a_ends, b_ends, ends)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text_key"),
                    pa.array((part << 33) + seen + np.arange(batch.num_rows)),
                    parts(a.astype(_kind(pair.a_size)), n_a),
                    parts(b.astype(_kind(pair.b_size)), n_b),
                    parts(_cuts(len(a), i), n_a),
                    parts(_cuts(len(b), j), n_b),
                ],
                ["doc", "text_key", "row", "a", "b", "a_cuts", "b_cuts"],
            )
            seen += batch.num_rows


class Stored:
    """A batch of written rows as vectors again."""

    def __init__(self, batch: pa.RecordBatch, a_size: int, b_size: int) -> None:
        def joined(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind)

        def sizes(name: str) -> np.ndarray:
            return pc.binary_length(batch.column(name)).to_numpy(zero_copy_only=False).astype(np.int64)

        self.a, self.b = joined("a", _kind(a_size)).astype(np.int64), joined("b", _kind(b_size)).astype(np.int64)
        self.n_a, self.n_b = sizes("a_cuts"), sizes("b_cuts")
        self.a_cuts, self.b_cuts = joined("a_cuts", "?"), joined("b_cuts", "?")
        self.links = np.flatnonzero(self.a_cuts), np.flatnonzero(self.b_cuts)
        self.pairs = self.a[self.links[0]] * b_size + self.b[self.links[1]]
        docs = len(self.n_a)
        self.owner = np.repeat(np.arange(docs), self.n_a)[self.links[0]]
        self.n_links = np.bincount(self.owner, minlength=docs)


class CountPairs:
    """``(pair, n)``: how often each id pair is linked, combined within the task."""

    def __init__(self, a_size: int, b_size: int) -> None:
        self.sizes = a_size, b_size

    def __call__(self, batches: Batches) -> Batches:
        release("pair ")
        pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in (part for whole in batches for part in _limited(whole)):
            new, counts = np.unique(Stored(batch, *self.sizes).pairs, return_counts=True)
            both, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, counts]), len(both)).astype(np.int64)
            pairs = both
            if len(pairs) > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])
                pairs, n = pairs[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])


def _limited(batch: pa.RecordBatch, limit: int = SLICE):
    """A batch in parts of about ``limit`` bytes of ids, or one row."""
    sizes = np.cumsum(pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


class Digest:
    """Rows with their groups in words and the counts of their links. Links whose
    pair is not in the broadcast table come out as ``rare``, to be joined."""

    def __init__(self, a_size: int, b_size: int, counts) -> None:
        self.sizes, self.counts = (a_size, b_size), counts

    def _numbers(self) -> pa.Array:
        """Every id with each of the three marks that may follow, and alone."""
        top = max(self.sizes)
        return pa.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(top)])

    def groups(self, at: Stored) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of each row."""
        top, docs = max(self.sizes), len(at.n_a)
        group_a = np.cumsum(at.a_cuts) - at.a_cuts
        group_b = np.cumsum(at.b_cuts) - at.b_cuts
        in_a, in_b = (np.bincount(g, minlength=len(at.pairs)) for g in (group_a, group_b))
        before_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
        marks_a = np.where(at.a_cuts, 1, 0)
        marks_b = np.where(at.b_cuts, 2, 0)
        totals = at.n_a + at.n_b
        ends = np.cumsum(totals)
        marks_b[np.cumsum(at.n_b)[at.n_b > 0] - 1] = 3
        order = np.empty(len(at.a) + len(at.b), np.int64)
        order[np.arange(len(at.a)) + before_b[group_a]] = marks_a * top + at.a
        order[np.arange(len(at.b)) + before_a[group_b]] = marks_b * top + at.b
        numbers = per_process(f"numbers {top}", self._numbers)
        words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), numbers.take(pa.array(order)))
        return pc.fill_null(pc.binary_join(words, ""), "") if docs else pa.array([], pa.string())

    def __call__(self, batches: Batches) -> Batches:
        release("pair ")
        known, n, best = self.counts.value
        for batch in (part for whole in batches for part in _limited(whole)):
            at = Stored(batch, *self.sizes)
            docs = batch.num_rows
            place = np.minimum(np.searchsorted(known, at.pairs), max(len(known) - 1, 0))
            found = known[place] == at.pairs if len(known) else np.zeros(len(at.pairs), bool)
            owner, place = at.owner[found], place[found]
            sums = np.zeros(docs, np.int64)
            np.add.at(sums, owner, n[place])
            lost = np.flatnonzero(~found)
            offsets = np.searchsorted(at.owner[lost], np.arange(docs + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("text_key"),
                    batch.column("row"),
                    pa.array(at.n_a),
                    pa.array(at.n_b),
                    pa.array(at.n_links),
                    pa.array(np.bincount(owner[best[place]], minlength=docs)),
                    pa.array(sums),
                    self.groups(at),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(at.pairs[lost])),
                ],
                ["doc", "text_key", "row", "n_a", "n_b", "n_links", "n_best", "count_sum", "groups", "rare"],
            )


def link_counts(links: DataFrame, a_size: int, b_size: int) -> DataFrame:
    """``(pair, n, best)``: how often each pair of ids is linked in the corpus, and
    whether no other A id is linked more often with its B id."""
    found = links.select("a", "b", "a_cuts", "b_cuts").mapInArrow(CountPairs(a_size, b_size), "pair bigint, n bigint")
    counts = staged(found.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair") % b_size
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # at most one row per B id
    counts = counts.withColumn("b", b).join(F.broadcast(highest) if b_size <= COMMON else highest, "b")
    return staged(counts.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    common: int = COMMON,
) -> DataFrame:
    """``(doc, text_key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``, one
    row per row of ``docs``.

    ``groups`` lists the ids between cuts, ``a1,a2|b1;a3|b2,b3``. No token is empty,
    so each cut has one link and ``n_links`` equals ``n_groups``. ``count_sum`` adds,
    over the row's links, how often their pair of ids is linked in all of ``docs``;
    ``n_best`` counts the links whose pair is the most frequent of its B id, ties
    included. NULL and empty texts, and texts that either tokenizer does not give
    back byte by byte, have no tokens: zeros and an empty string. Repeated rows count
    as often as they occur, NULL ids stay NULL, extra columns are ignored, an empty
    table gives an empty one.
    """
    a_path = a_path or public_tokenizers.path(A_FILE)
    b_path = b_path or public_tokenizers.path(B_FILE)
    a_size = Tokenizer.from_file(a_path).get_vocab_size()
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    texts = docs.select(
        F.col(doc_id).alias("doc"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text")
    )
    kind = texts.schema["doc"].dataType.simpleString()
    keys = f"doc {kind}, text_key bigint, row bigint"
    links = staged(
        texts.mapInArrow(Align(a_path, b_path), f"{keys}, a binary, b binary, a_cuts binary, b_cuts binary"), "links"
    )
    counts = link_counts(links, a_size, b_size)
    size = counts.agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("n"), F.lit(0)).alias("links")).first()
    # A share of 1 / common of all links is held by at most ``common`` pairs.
    often = F.col("n") > size.links // common if size.pairs > common else F.lit(True)
    held = counts.filter(often).toPandas().sort_values("pair")
    table = tuple(held[c].to_numpy() for c in ("pair", "n", "best"))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    measures = "n_a bigint, n_b bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    rows = links.mapInArrow(Digest(a_size, b_size, shared), f"{keys}, {measures}, rare array<bigint>")
    if size.pairs > common:
        rows = _with_rare(staged(rows, "digest"), counts.filter(~often))
    columns = ["n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups"]
    return rows.select("doc", "text_key", *columns)


def _with_rare(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add the counts of the links that the broadcast table does not hold."""
    rare = rows.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
    sums = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    rows = rows.drop("rare").join(sums, "row", "left")
    return rows.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn(
        "count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))
    )
