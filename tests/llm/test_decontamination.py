"""Benchmark passages against a plain comparison of windows."""

import random
import re

import pytest

from docindex.llm.decontamination import WINDOW, benchmark_hits, decontaminate, longest_matches, n_hit, suffix_array
from tests.llm import cases


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(items):
    found = {}
    for name, text in items:
        own = words(text)
        size = min(WINDOW, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            found.setdefault(tuple(own[i : i + size]), set()).add("" if name is None else str(name))
    return found


def plain(texts, items):
    known = windows(items)
    sizes, out = {len(w) for w in known}, []
    for text in texts:
        own, hit, names = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                got = known.get(tuple(own[i : i + size]))
                if got:
                    hit |= set(range(i, i + size))
                    names |= got
        out.append((len(own), sorted(hit), sorted(names)))
    return out


def tables(seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(40)] + ["Ünï", "x_y", "B2b"]
    prose = lambda k: rng.choice([" ", ", "]).join(rng.choice(pool) for _ in range(k))
    items = [(i, prose(rng.randrange(10, 60))) for i in range(12)]
    items += [(20, prose(3)), (21, "single"), (22, None), (23, "..."), (None, prose(12)), (24, items[0][1]), (20, prose(14))]
    items += [(25, " ".join(["again"] * 30))]
    texts = [None, "", "!!", "single", "a single word", "again " * 200]
    for _ in range(60):
        _, text = items[rng.randrange(len(items))]
        cut = words(text)
        at = rng.randrange(max(1, len(cut) - 8))
        part = " - ".join(cut[at : at + rng.randrange(5, 40)]).upper()
        texts.append(f"{prose(rng.randrange(0, 30))} {part} {prose(rng.randrange(0, 30))}")
    return texts, items


def bench_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id bigint, text string, item string, doc int")


@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_hits_equal_plain_windows(spark, small_batches, block_bytes):
    texts, items = tables(5)
    got = benchmark_hits(cases.frame(spark, texts), bench_frame(spark, items), block_bytes=block_bytes)
    got = {r.doc: r for r in got.select("*", n_hit("spans").alias("n_hit")).collect()}
    for i, (n, hit, names) in enumerate(plain(texts, items)):
        spans = [(s.start, s.end) for s in got[i].spans]
        assert (got[i].n_words, got[i]["items"], got[i].n_hit) == (n, names, len(hit))
        assert [p for a, b in spans for p in range(a, b)] == hit
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("block_bytes", [1 << 20, 500])
def test_decontaminate_keeps_other_rows_whole(spark, block_bytes):
    texts, items = tables(6)
    docs = cases.frame(spark, texts)
    left = decontaminate(docs, bench_frame(spark, items), block_bytes=block_bytes)
    clean = [i for i, (_, hit, _) in enumerate(plain(texts, items)) if not hit]
    assert left.columns == docs.columns
    assert sorted(left.collect(), key=repr) == sorted((r for r in docs.collect() if r.doc_id in clean), key=repr)


def test_longest_matches(spark, small_batches):
    texts, items = tables(7)
    items = [(i, t) for i, t in items if i is not None and i != 20]
    own = [words(t) for t in texts]
    got = longest_matches(cases.frame(spark, texts), bench_frame(spark, items), block_bytes=600).collect()
    found = {(r["item"], r.item_start): r.length for r in got}
    want = {}
    for name, text in items:
        item = words(text)
        for s in range(len(item)):
            longest = 0
            for doc in own:
                for i in range(len(doc)):
                    k = 0
                    while s + k < len(item) and i + k < len(doc) and item[s + k] == doc[i + k]:
                        k += 1
                    longest = max(longest, k)
            if longest >= (min(WINDOW, len(item)) if s == 0 else min(WINDOW, max(1, len(item) - s) if len(item) - s >= WINDOW else 1)):
                want[str(name), s] = longest
    whole = {k: v for k, v in want.items() if v >= WINDOW}
    assert {k: v for k, v in found.items() if v >= WINDOW} == whole
    for r in got:
        item = words(dict((str(i), t) for i, t in items)[r["item"]])
        assert own[r.doc][r.doc_start : r.doc_start + r.length] == item[r.item_start : r.item_start + r.length]


def test_suffix_array_is_sorted():
    import numpy as np

    rng = np.random.default_rng(3)
    for depth in (1, 3, 10, 40):
        sequence = np.append(rng.integers(0, 3, 400), np.zeros(depth + 2, np.int64))
        order = suffix_array(sequence, depth)
        assert sorted(order) == np.flatnonzero(sequence).tolist()

        def upto(p):
            run = sequence[p : p + depth].tolist()
            return run[: run.index(0)] if 0 in run else run

        keys = [upto(p) for p in order]
        assert keys == sorted(keys)


def test_hard_and_empty_tables(spark):
    long = "n" * 1_000_000
    bench = bench_frame(spark, [(1, "same text same text same text same text same text"), (2, "two"), (3, long)])
    got = benchmark_hits(cases.hard(spark), bench).collect()
    assert len(got) == 10
    assert {tuple(r["items"]) for r in got if r.doc == 6} == {("1",)}
    assert benchmark_hits(cases.empty(spark), bench).count() == 0
    assert {len(r.spans) for r in benchmark_hits(cases.hard(spark), bench_frame(spark, [])).collect()} == {0}
    assert benchmark_hits(cases.frame(spark, [long, f"{long} two"]), bench).filter("size(spans) > 0").count() == 2
    assert decontaminate(cases.empty(spark), bench).count() == 0
