"""The row-wise operators, sharding, packing and search against plain versions."""

import math
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docindex.llm import neighbours, packing, pii, quality, rules, sampling, sharding, token_counts
from docindex.llm.near_dups import near_duplicates
from docindex.llm.neighbours import nearest
from docindex.llm.packing import PieceIds, pack
from docindex.llm.pieces import Pieces, default_path
from docindex.llm.pii import base_spans, emails, find_personal_data, joined, masked
from docindex.llm.quality import quality_scores
from docindex.llm.rules import quality_rules
from docindex.llm.sampling import Lattices, sample_pieces
from docindex.llm.sharding import shard_by_bytes
from docindex.llm.substrings import remove_repeats
from docindex.llm.token_counts import token_counts as count_tokens
from tests.llm import cases

WORDS_FILE = public_tokenizers.path("word_bpe_49k.json")

# -- quality rules ------------------------------------------------------------


def plain_figures(text):
    own = cases.words(text)
    lines = [x for x in (text or "").split("\n") if cases.words(x)]
    at = defaultdict(list)
    for i in range(len(own) - 7):
        at[tuple(own[i : i + 8])].append(i)
    repeated = {j for starts in at.values() if len(starts) > 1 for i in starts for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_figures_match_a_plain_count(spark):
    texts = cases.make_texts(seed=3) + ["a b c d e f g h a b c d e f g h", "x " * 30, "# <|> \n\n é\n é"]
    rows = quality_rules(cases.frame(spark, texts)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r.doc: tuple(r[n] for n in names) for r in rows} == {i: plain_figures(t) for i, t in enumerate(texts)}
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_a_refused_host_loses_only_documents_that_fail_a_rule(spark):
    good = [" ".join(f"g{i}x{j}" for j in range(30)) for i in range(10)]
    junk = [" ".join(f"j{i}###x{j}" for j in range(30)) for i in range(10)]
    docs = cases.frame(spark, good + junk[:1], source="fine").unionByName(
        cases.frame(spark, junk[1:] + good[:1], list(range(20, 30)), source="bad")
    )
    rows = {r.doc: r for r in quality_rules(docs).collect()}
    assert [rows[i].kept for i in range(20, 30)] == [False] * 9 + [True]
    assert all(rows[i].kept for i in range(11))
    assert rows[20].host_refused and not rows[0].host_refused


def test_many_refused_hosts_join_by_salt(spark, monkeypatch):
    docs = cases.frame(spark, ["### " * 30] * 8, source="bad")
    few = quality_rules(docs).orderBy("doc").collect()
    monkeypatch.setattr(rules, "BROADCAST_KEYS", 0)
    assert quality_rules(docs).orderBy("doc").collect() == few


def test_hard_cases_of_quality_rules(spark):
    docs = cases.hard(spark).withColumn("source", F.lit(None).cast("string"))
    rows = quality_rules(docs).collect()
    assert len(rows) == 10 and not any(r.kept for r in rows if r.n_words < 20)
    assert quality_rules(cases.empty(spark)).count() == 0


# -- classifier ---------------------------------------------------------------


def test_scores_separate_held_out_rows(spark):
    texts = cases.make_texts(seed=5, n=120)
    texts = [t if i % 2 else " ".join(w + "$$$" for w in t.split()) for i, t in enumerate(texts)]
    docs = cases.frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 80)], "doc_id bigint, quality int")
    rows = quality_scores(docs, labels).collect()
    held = [r for r in rows if r.doc >= 80]
    assert np.mean([(r.score >= 0.5) == (r.doc % 2 == 1) for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_blocked_scores_are_the_plain_vote():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.05, (90, quality.BUCKETS)).astype(np.float32)
    model = quality.fit(counts[:60], rng.integers(0, 2, 60).astype(np.float32))
    scores = model.scores(counts[60:])
    latent = model.latent(counts[60:])
    for row, score in zip(latent, scores):
        cosine = model.vectors @ row
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** quality.SHARPNESS
        mean = model.labels.mean()
        assert score == pytest.approx(
            (weight @ model.labels[near] + quality.PRIOR * mean) / (weight.sum() + quality.PRIOR), abs=1e-4
        )


def test_scores_do_not_depend_on_order_or_repeated_ids(spark):
    texts = cases.make_texts(seed=8, n=40)
    ids = [*range(40), *[3] * 60]
    docs = cases.frame(spark, texts + [f"{texts[i % 40]} again" for i in range(60)], ids)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    forth = sorted((r.doc, r.score) for r in quality_scores(docs.coalesce(1), labels).collect())
    back = sorted((r.doc, r.score) for r in quality_scores(docs.orderBy(F.rand(1)).repartition(3), labels).collect())
    assert [d for d, _ in forth] == [d for d, _ in back]
    assert [x for _, x in forth] == pytest.approx([x for _, x in back], abs=1e-3)


def test_hard_cases_of_scores(spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (6, 1), (None, 1), (9, None)], "doc_id bigint, quality int")
    rows = quality_scores(cases.hard(spark), labels).collect()
    blank = {r.score for r in rows if r.doc in (1, 2)}
    assert len(rows) == 10 and len(blank) == 1
    assert {r.score for r in quality_scores(cases.hard(spark), labels.limit(0)).collect()} == {0.5}
    assert quality_scores(cases.empty(spark), labels).count() == 0


# -- sharding -----------------------------------------------------------------


@pytest.mark.parametrize("hot", [False, True])
def test_shards_hold_near_equal_bytes(spark, small_batches, monkeypatch, hot):
    texts = cases.make_texts(seed=6, n=400)
    if hot:  # a third of all rows are copies
        texts[:200] = ["the same text in very many rows " * 10] * 200
    rows = shard_by_bytes(cases.frame(spark, texts).repartition(4), shards=8).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(r.doc for r in rows) == list(range(400))
    assert all(r.size == len(texts[r.doc].encode()) + 16 for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("ids", [None, 5])
def test_rows_of_one_key_are_parted(spark, ids):
    texts = cases.make_texts(seed=2, n=300) + ["a text without an id " * 6] * 200
    rows = shard_by_bytes(cases.frame(spark, texts, [*range(300), *[ids] * 200]).repartition(3), shards=20).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.shard] += r.size
    assert len(rows) == 500 and len(sizes) == 20
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)


def test_many_boundaries_are_found_quickly(monkeypatch):
    rng = np.random.default_rng(1)
    keys = np.sort(sharding.encode(*rng.integers(-(2**62), 2**62, (3, 200_000))))
    numbers = [sharding.as_number(bytes(k)) for k in keys]
    sizes = np.cumsum(rng.integers(1, 100, len(keys)))

    def histogram(_, probes):
        edges = [0, *np.searchsorted(keys, np.array(probes, sharding._KEY)).tolist(), len(keys)]
        below = np.concatenate([[0], sizes])
        return [
            (int(below[j] - below[i]), j - i, numbers[i], numbers[j - 1]) if j > i else (0, 0, 0, 0)
            for i, j in zip(edges[:-1], edges[1:])
        ]

    monkeypatch.setattr(sharding, "histogram", histogram)
    started = time.time()
    total, parts = int(sizes[-1]), 1 << 15
    bounds = np.array([sharding.as_key(b) for b in sharding.splitters(None, total, parts, 60)], sharding._KEY)
    assert time.time() - started < 60
    below = np.concatenate([[0], sizes])[np.searchsorted(keys, bounds)]
    goals = np.array([total * i // parts for i in range(1, parts)])
    assert np.abs(below - goals).max() <= 100


def test_several_intervals_make_up_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "INTERVAL_BYTES", 1000)
    rows = shard_by_bytes(cases.frame(spark, cases.make_texts(n=90)), shards=3).collect()
    for shard in range(3):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))


def test_hard_cases_of_sharding(spark):
    rows = shard_by_bytes(cases.hard(spark), shards=4).collect()
    assert len(rows) == 10 and {r.size for r in rows if r.doc in (1, 2)} == {16}
    assert shard_by_bytes(cases.empty(spark), shards=4).count() == 0


# -- packing ------------------------------------------------------------------


def test_ids_are_the_tokenizers():
    tokenizer = Tokenizer.from_file(WORDS_FILE)
    odd = ["don't 'S it'S. A<|endoftext|>. <|STARTOFTEXT|>", "x y ÅÅ é. ﬁ​..", "١٢3. İ. Σς. ́. á.,", "1.5,6;", ""]
    texts = cases.make_texts(seed=8) + odd
    ids = PieceIds(WORDS_FILE).encode([t.encode() for t in texts])
    for text, own in zip(texts, ids):
        assert np.frombuffer(own, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


class Asked:
    """A tokenizer that notes the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode(self, text, **options):
        self.texts.append(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_frequent_pieces_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    plain, pieces = Tokenizer.from_file(WORDS_FILE), PieceIds(WORDS_FILE)
    pieces.tokenizer = Asked(plain)
    for i in range(20):
        rare = ["rare" + chr(97 + i) + chr(97 + j) for j in range(26)]
        text = " ".join(["often,", "1of", *rare, "often.", "1of"])
        (own,) = pieces.encode([text.encode()])
        assert np.frombuffer(own, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(pieces._number) <= 50 + 30
    asked = " ".join(pieces.tokenizer.texts).split()
    assert asked.count("often") == asked.count("1of") == 1
    assert max(asked.count(word) for word in asked) == 1


def test_letters_that_are_no_letters_to_the_tokenizer():
    tokenizer, pieces = Tokenizer.from_file(WORDS_FILE), PieceIds(WORDS_FILE)
    texts = ["plain \ua7cb\u1c8aword newꟋ ﬁ\x1cx\x85y\xa0z İi. a<|b,c |>", "  ", "\n", " lead trail \t", "x\x00.y\x0b\x0cz", None, ""]
    ids = pieces.encode([t if t is None else t.encode() for t in texts])
    for text, own in zip(texts, ids):
        assert np.frombuffer(own, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_pieces_cover_the_stream_exactly(spark, small_batches):
    texts = cases.make_texts(seed=2, n=50)
    pieces = pack(cases.frame(spark, texts).repartition(4), capacity=64).collect()
    own = defaultdict(list)
    for p in pieces:
        own[p.doc].append(p)
    tokenizer = Tokenizer.from_file(WORDS_FILE)
    for doc, parts in own.items():
        parts.sort(key=lambda p: p.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist()
        assert ids == [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 1]
        assert parts[0].begins and parts[-1].ends and {p.doc_tokens for p in parts} == {len(ids)}
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 64 + offset == at and offset + length <= 64
        at += length


def test_hard_cases_of_packing(spark):
    rows = pack(cases.hard(spark)).collect()
    assert sum(r.length for r in rows if r.doc in (1, 2, 3)) == 3
    assert sum(r.begins for r in rows) == 10
    assert pack(cases.empty(spark)).count() == 0


# -- personal data ------------------------------------------------------------


def test_base_spans():
    text = "a.b@c.de x@y z@@q.r t@u.v@w.x 1.2.3.4.5 300.1.1.1 4111 1111 1111 1111 4111111111111112 +1 (555) 010-9999 +12"
    found = {k: [text[s:e] for kind, s, e in base_spans(text) if kind == k] for k in range(4)}
    assert found == {
        pii.EMAIL: ["a.b@c.de", "t@u.v"],
        pii.IP: ["1.2.3.4"],
        pii.CARD: [],
        pii.PHONE: ["+1 (555) 010-9999"],
    }
    assert [text for text in ["4111-1111-1111-1111"] if base_spans(text) == [(pii.CARD, 0, 19)]]


def test_emails_match_the_pattern():
    import random
    import re

    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("ab.@- %") for _ in range(rng.randrange(30)))
        assert emails(text) == [m.span() for m in pattern.finditer(text)]


def test_the_model_adds_announced_spans_and_keeps_base_ones(spark):
    rng = np.random.default_rng(1)
    number = lambda: f"{rng.integers(200, 999)}-{rng.integers(200, 999)}-{rng.integers(1000, 9999)}"
    texts = [f"words then call {number()} now" for _ in range(60)]
    texts += [f"mail someone{i}@example.com or +1 555 010 {1000 + i} today" for i in range(60)]
    texts += [f"the sum $ {rng.integers(10, 99)} {rng.integers(10, 99)} {rng.integers(10, 99)} {rng.integers(10, 99)}x rose" for _ in range(60)]
    rows = find_personal_data(cases.frame(spark, texts)).collect()
    for r in rows:
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}
    added = sum(len(r.spans) > len(r.base) for r in rows if r.doc < 60)
    assert added > 50 and all(len(r.spans) == len(r.base) for r in rows if r.doc >= 120)
    hidden = {r.doc: r.masked for r in masked(cases.frame(spark, texts)).collect()}
    assert hidden[60] == "mail <EMAIL> or <PHONE> today"


@pytest.mark.parametrize("size", [32, 40, 64])
def test_secrets_of_either_case_are_candidates(size):
    token = ("9233a8ecf7" * 7)[:size]
    for own, found in ((token, True), (token.upper(), True), (token[:-1] + "F", False)):
        text = f'TOKEN = "{own}"'
        spans = [s for s in pii.loose_spans(text) if s[0] == pii.SECRET]
        assert spans == ([(pii.SECRET, 9, 9 + size)] if found else [])
        assert [pii.votes_of(text, *s)[0] for s in spans] == [1] * len(spans)


def test_reliabilities_find_the_useless_labeler():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.5
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in (0.95, 0.9, 0.85, 0.5)], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    table, probable = pii.reliabilities(patterns, counts.astype(float))
    assert table[0, 2, 1] > 0.9 and abs(table[3, 2, 1] - 0.5) < 0.05
    where = {tuple(p): q for p, q in zip(patterns, probable)}
    assert np.mean([(where[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.94


def test_hard_cases_of_personal_data(spark):
    rows = find_personal_data(cases.hard(spark)).select("doc", joined(F.col("spans")).alias("s")).collect()
    assert len(rows) == 10 and {r.s for r in rows} == {""}
    assert find_personal_data(cases.empty(spark)).count() == 0


# -- pieces -------------------------------------------------------------------


def test_sampled_ids_are_pieces_of_the_text_and_do_not_depend_on_partitions(spark, small_batches):
    texts = cases.make_texts(seed=7) + ["▁ mark  two   spaces ", "\n\n", " lead", "\U0001f600 é"]
    docs = cases.frame(spark, texts)
    one = {r.doc: r for r in sample_pieces(docs.coalesce(1)).collect()}
    many = {r.doc: r for r in sample_pieces(docs.repartition(5)).collect()}
    assert one == many and all(r.decoded == texts[i] for i, r in one.items())
    model = sentencepiece.SentencePieceProcessor(model_file=default_path())
    for i, r in one.items():
        if "▁" not in texts[i]:
            assert model.decode(r.ids) == texts[i]
    other = sample_pieces(docs, seed=2).collect()
    assert any(r.ids != one[r.doc].ids for r in other)


def test_draws_follow_the_lattice():
    pieces = Pieces(default_path())
    lattices = Lattices(pieces)
    unit = " the"
    n = lattices.number[unit]
    lattices.learn()

    def weights(at):
        if at == len(unit):
            return {(): 1.0}
        out = {}
        for end in range(at + 1, len(unit) + 1):
            if unit[at:end] in pieces.ids:
                i, w = pieces.ids[unit[at:end]]
                out |= {(i, *rest): np.exp(w) * p for rest, p in weights(end).items()}
        return out

    expected = weights(0)
    total = sum(expected.values())
    draws = 20_000
    edges, counts = lattices.sample(np.full(draws, n), np.arange(draws, dtype=np.uint64), np.zeros(draws, np.int64))
    ids, _ = lattices.ids(edges)
    seen = defaultdict(int)
    for part in np.split(ids, np.cumsum(counts)[:-1]):
        seen[tuple(part.tolist())] += 1
    for path, p in expected.items():
        assert seen[path] / draws == pytest.approx(p / total, abs=0.015)


def test_the_largest_draw_stays_in_its_unit(monkeypatch):
    lattices = Lattices(Pieces(default_path()))
    for i in range(20_000):  # many units before it
        lattices.number[f" before{i}"]
    lattices.learn()
    unit = " nzgozanwzdn"
    n = lattices.number[unit]
    lattices.learn()
    monkeypatch.setattr(sampling, "mix", lambda x: np.full(np.shape(x), (1 << 64) - 1, np.uint64))
    edges, _ = lattices.sample(np.array([n]), np.zeros(1, np.uint64), np.zeros(1, np.int64))
    assert lattices.pieces.decode([*lattices.ids(edges)[0].tolist()]) == unit[1:].encode()


def test_draws_do_not_depend_on_what_was_learnt_before():
    pieces, rng = Pieces(default_path()), np.random.default_rng(4)
    fresh, full = Lattices(pieces), Lattices(pieces)
    units = [" the", " nation", "日本語日本", " x" * 3, "\n", " reading.", " unbelievably"]
    for word in ("".join(rng.choice(list("abcdefgh "), 9)) for _ in range(3000)):
        full.number[word]
    full.learn()
    for lattices in (fresh, full):
        for unit in units:
            lattices.number[unit]
            lattices.learn()
    drawn = []
    for lattices in (fresh, full):
        numbers = np.repeat([lattices.number[u] for u in units], 500)
        edges, counts = lattices.sample(numbers, np.arange(len(numbers), dtype=np.uint64), np.zeros(len(numbers), np.int64))
        drawn.append((lattices.ids(edges)[0].tolist(), counts.tolist(), lattices.share[edges].tolist()))
    assert drawn[0] == drawn[1]


def test_token_counts_match_a_plain_search(spark, small_batches):
    texts = cases.make_texts(seed=11) + ["▁x", "\n a\n", "日本語日本"]
    pieces = Pieces(default_path())

    def plain(unit):
        best = [(0.0, 0)] + [None] * len(unit)
        for j in range(1, len(unit) + 1):
            options = []
            for i in range(j):
                if unit[i:j] in pieces.ids:
                    options.append((best[i][0] + pieces.ids[unit[i:j]][1], best[i][1] - 1))
                elif i == j - 1:
                    size = len(unit[i].encode())
                    options.append((best[i][0] + size * pieces.byte_weight, best[i][1] - size))
            best[j] = max(options)
        return -best[-1][1]

    rows = count_tokens(cases.frame(spark, texts)).collect()
    assert {r.doc: r.tokens for r in rows} == {i: sum(map(plain, pieces.units(t))) for i, t in enumerate(texts)}


def test_hard_cases_of_pieces(spark, monkeypatch):
    rows = sample_pieces(cases.hard(spark)).collect()
    assert [(r.ids, r.decoded) for r in rows if r.doc in (1, 2)] == [([], ""), ([], "")]
    assert len({tuple(r.ids) for r in rows if r.doc == 6}) == 1
    assert sample_pieces(cases.empty(spark)).count() == 0
    counted = count_tokens(cases.hard(spark)).collect()
    assert [r.tokens for r in counted if r.doc in (1, 2)] == [0, 0] and len(counted) == 10
    assert count_tokens(cases.empty(spark)).count() == 0
    assert token_counts.REMEMBERED > 0


def test_a_very_long_word(spark):
    docs = cases.frame(spark, ["w" * 300_000, "one " + "xy" * 100_000])
    assert all(r.decoded == r.text for r in sample_pieces(docs).collect())
    assert all(r.tokens > 1000 for r in count_tokens(docs).collect())
    assert {r.kept for r in remove_repeats(docs).collect()} == {r.text for r in docs.collect()}
    assert {r.component_id for r in near_duplicates(docs).collect()} == {0, 1}
    assert pack(docs).agg(F.sum("length")).first()[0] > 1000


# -- search -------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, node int, vector string, cosine string"


def vectors(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [float(a) for a in v], 1, "v", "c") for i, v in zip(ids, x)], VECTORS)


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[100:500] = x[100]  # a group of equal vectors
    rows = nearest(vectors(spark, x), F.col("vec_id") % 25 == 0).collect()
    own = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        own[r.query_id].append((r.vec_id, r.score))
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 25):
        score = unit @ unit[q]
        score[q] = -2
        if 100 <= q < 500:
            assert [i for i, _ in own[q]] == [i for i in range(100, 106) if i != q][:5]
        truth = set(np.lexsort((np.arange(1500), -np.round(score, 9)))[:5].tolist())
        hits += len(truth & {i for i, _ in own[q]})
        for i, s in own[q]:
            assert s == pytest.approx(unit[q] @ unit[i], abs=1e-9)
    assert hits / (60 * 5) >= 0.9


def test_recall_inside_a_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(64)
    group = centre + 0.001 * rng.standard_normal((3000, 64))
    x = np.concatenate([rng.standard_normal((500, 64)), group]).astype(np.float32)
    rows = nearest(vectors(spark, x), F.col("vec_id") % 50 == 0).collect()
    own = defaultdict(set)
    for r in rows:
        own[r.query_id].add(r.vec_id)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hits, queries = 0, range(500, 3500, 50)
    for q in queries:
        score = unit @ unit[q]
        score[q] = -2
        hits += len(own[q] & set(np.argsort(-score)[:5].tolist()))
    assert hits / (5 * len(queries)) >= 0.9


def test_the_graph_is_exchanged_by_lists_not_edges(spark, monkeypatch):
    rows, whole = defaultdict(list), neighbours.staged

    def counted(df, name):
        out = whole(df, name)
        rows[name].append(out.count())
        return out

    monkeypatch.setattr(neighbours, "staged", counted)
    monkeypatch.setattr(neighbours, "BUCKET", 64, raising=False)
    x = np.random.default_rng(3).standard_normal((300, 8))
    found = nearest(vectors(spark, x), F.col("vec_id") % 50 == 0).collect()
    assert set(rows["graph"]) == {300} and "met" not in rows and "meetings" not in rows
    unit = x.astype(np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for q in range(0, 300, 50):
        score = unit @ unit[q]
        score[q] = -2
        own = [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q]
        assert own == np.argsort(-score)[:5].tolist()


@pytest.mark.parametrize("items", ["float", "double"])
def test_scores_are_those_of_a_plain_sum(spark, items):
    x = (np.random.default_rng(4).standard_normal((60, 33)) * 3).astype(np.float32 if items == "float" else np.float64)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id bigint, embedding array<{items}>")
    found = nearest(rows, F.col("vec_id") % 20 == 0).collect()

    def dot(a, b):
        total = 0.0
        for p, q in zip(a.tolist(), b.tolist()):
            total += p * q
        return total

    assert len(found) == 15
    for r in found:
        a, b = x[r.query_id], x[r.vec_id]
        assert r.score == dot(a, b) / (math.sqrt(dot(a, a)) * math.sqrt(dot(b, b)))


def test_vectors_of_another_length_take_no_part(spark):
    x = [[1.0, 0.0], [0.9, 0.1], [0.0, 1.0], [1.0, 0.0, 0.0, 0.0, 1.0, 1.0]]
    found = nearest(vectors(spark, x), F.col("vec_id") >= 0, k=5).collect()
    assert {(r.query_id, r.vec_id) for r in found} == {(a, b) for a in range(3) for b in range(3) if a != b}


def test_hard_cases_of_search(spark):
    nan, inf = float("nan"), float("inf")
    x = [[1, 0], [1, 0], [0, 1], None, [], [0, 0], [nan, 1], [inf, 1], [2, 0], [1, 1], [5, 5]]
    ids = [0, 1, 2, 3, 4, 50, 100, 150, 8, None, 0]
    rows = nearest(vectors(spark, x, ids), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in rows] == [(0, 1, 1), (0, 2, 8), (0, 3, 2)]
    assert nearest(vectors(spark, []), F.col("vec_id") >= 0).count() == 0
    assert nearest(vectors(spark, [[1, 2]]), F.col("vec_id") >= 0).count() == 0
    assert neighbours.BEAM > 6


def test_crc_of_an_empty_text_is_zero():
    assert zlib.crc32(b"") == 0
