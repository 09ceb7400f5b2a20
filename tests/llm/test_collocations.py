"""Phrase counts and scores against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from docindex.llm import collocations as module
from docindex.llm.collocations import collocations, top_collocations
from tests.llm import cases


def plain(rows, shortest, longest, least, inside=50):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(own[i : i + size]) for i in range(len(own) - size + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if shortest <= len(p) and a >= least}
        for p, a in candidates.items():
            inner = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(len(q) > len(p) and inner(q) and 100 * b >= inside * a for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            out.add((lang, " ".join(p), a, k, f[p[:k]], f[p[k:]], n[lang], score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, l, t, "x", 1, 2) for i, (l, t) in enumerate(rows)], "doc_id int, lang string, text string, phrase string, n int, a int")


def rows_of(found):
    return {tuple(r[c] for c in ("lang", "phrase", "a", "k", "l", "r", "n", "score")) for r in found.collect()}


def tables(seed):
    rng = random.Random(seed)
    pool = [*"abcdefg"] * 3 + [f"w{i}" for i in range(30)] + ["ÉTÉ", "É", "日本", "it's", "-", "x\x0by", "\x00"]
    rows = [(None, None), ("en", ""), ("en", " \t "), (None, "null lang words " * 9), ("und", "null lang words " * 9)]
    for _ in range(150):
        text = "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "en", "de", ""]), text))
    return rows + [("en", "All rights reserved here. Go")] * 40


@pytest.mark.parametrize(("budget", "longest", "chunk"), [(module.BUDGET, 3, module.CHUNK), (400, 3, 64), (400, 4, 500), (100, 3, 9)])
def test_collocations_equal_plain_counting(spark, small_batches, monkeypatch, budget, longest, chunk):
    monkeypatch.setattr(module, "CHUNK", chunk)
    rows = tables(budget)
    got = rows_of(collocations(frame(spark, rows), least=5, longest=longest, budget=budget))
    assert got == plain(rows, 2, longest, 5)


def test_parts_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(module, "OFTEN", 20)
    rows = tables(1)
    assert rows_of(collocations(frame(spark, rows), least=5)) == plain(rows, 2, 3, 5)


def test_top_is_ordered(spark):
    rows = tables(2)
    found = plain(rows, 2, 3, 3)
    got = top_collocations(collocations(frame(spark, rows), least=3), top=7).collect()
    for lang in {r[0] for r in found}:
        mine = sorted((-r[7], -r[2], r[1].encode()) for r in found if r[0] == lang)[:7]
        assert [(-r.score, -r.a, r.phrase.encode()) for r in sorted(got, key=lambda r: r["rank"]) if r.lang == lang] == mine


def test_words_are_forgotten(monkeypatch):
    words = module.Words()
    first = words.numbers([b"\n", b"", b"x"]).tolist()
    monkeypatch.setattr(module, "VOCABULARY", 2)
    words.trim()
    assert words.numbers([b"\n", b"", b"y"]).tolist() == first == [0, 1, 2]
    assert words.listed().to_pylist() == [b"", b"", b"y"]


def test_hard_and_empty_tables(spark):
    assert collocations(cases.hard(spark)).count() > 0
    assert collocations(cases.empty(spark)).count() == 0
    one = "z" * 1_000_000
    got = collocations(frame(spark, [("en", f"{one} {one} " * 6)]), least=5).collect()
    assert {(r.phrase.count(" "), r.a) for r in got} == {(2, 10)} or len(got) == 1
