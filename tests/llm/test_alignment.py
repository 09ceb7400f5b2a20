"""Two tokenizers' alignment against a plain walk over whole texts."""

import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docindex.llm import alignment
from docindex.llm.alignment import A_FILE, B_FILE, Pair, align, merge
from tests.llm import cases

ODD = [
    "It's we've a b   c　 d e", "  two  spaces \n\n\nlines \n x\t\ty ", "mark ▁ inside", "<|endoftext|> <s> </s> <0x0A> <unk>",
    "x\x00y \x1c z\x1f \x85q", "日本語 テキスト😀 👩‍👩‍👧", "'s 't o'clock ''re", "1234567 3.14159 ½ ² Ⅷ", "éä ﬁ", " ", "\n", "a", " lead", "trail ",
    "͸Ᲊ . newꟋ letters", "​ ​", "﻿bom", "<|endof text|>\n<|endoftext|>", "=" * 700, "w" * 5000,
]


def plain(texts):
    """n_a, n_b, links and groups of each text, and counts over all."""
    a_side = Tokenizer.from_file(public_tokenizers.path(A_FILE))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B_FILE))
    pair = Pair(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    found, counts = [], Counter()
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        sides = b"".join(pair.a_bytes[i] for i in a), b"".join(pair.b_bytes[i] for i in b)
        if not text or sides != (whole, whole):
            a, b = [], []
        ends_a, ends_b = np.cumsum([len(pair.a_bytes[i]) for i in a]), np.cumsum([len(pair.b_bytes[i]) for i in b])
        links = [(i, j) for j, e in enumerate(ends_b) for i in np.flatnonzero(ends_a == e)]
        groups, i, j = [], 0, 0
        for x, y in links:
            groups.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
            i, j = x + 1, y + 1
        linked = [(a[x], b[y]) for x, y in links]
        counts.update(linked)
        found.append((len(a), len(b), linked, ";".join(groups)))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (n_a, n_b, len(ls), len(ls), sum(counts[p] == most[p[1]] for p in ls), sum(counts[p] for p in ls), groups)
        for n_a, n_b, ls, groups in found
    ]


def texts_of(seed, n=40):
    rng = random.Random(seed)
    chars = "aeiounrst  ..,'\n\t-1é日 😀<>|A"
    fuzz = ["".join(rng.choice(chars) for _ in range(rng.randrange(1, 300))) for _ in range(n)]
    return [*ODD, *fuzz, *cases.make_texts(seed, 20)]


def rows(found):
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return {r.doc: tuple(r[c] for c in columns) for r in found.collect()}


@pytest.mark.parametrize("common", [alignment.COMMON, 40])
def test_align_equals_plain_walk(spark, small_batches, common):
    texts = [None, "", *texts_of(3), "same again"] + ["same again"] * 5
    got = rows(align(cases.frame(spark, texts), common=common))
    assert got == dict(enumerate(plain(texts)))


def test_units_do_not_change_ids():
    pair = Pair(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    a_side, b_side = pair.a, pair.b
    for text in texts_of(7, 400):
        a, b, n_a, _ = pair.encode([text.encode()])
        if n_a[0]:
            assert a.tolist() == a_side.encode(" " + text, add_special_tokens=False).ids, text
            assert b.tolist() == b_side.encode(text), text


def test_lanes_do_not_change_links():
    rng = np.random.default_rng(1)
    for lane in (1, 7, 64, 10_000):
        starts = np.cumsum([0, 500, 1, 30, 900])
        ends = [np.unique(np.concatenate([rng.choice(np.arange(1, starts[-1]), 300, replace=False), starts[1:]])) for _ in "ab"]
        i, j = merge(*ends, starts, lane)
        common = np.intersect1d(*ends)
        assert ends[0][i].tolist() == ends[1][j].tolist() == common.tolist()


def test_remembered_units_are_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    pair = Pair(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    first = [x.tolist() for x in pair.encode([b"one two three four five"])]
    pair.encode([b"six seven eight nine ten"])
    assert [x.tolist() for x in pair.encode([b"one two three four five"])] == first


def test_frequent_units_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    pair = Pair(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    asked = Counter()
    lists = pair._lists
    monkeypatch.setattr(pair, "_lists", lambda side, texts: asked.update("".join(texts).split()) or lists(side, texts))
    for i in range(20):
        pair.encode([" ".join(["often", *(f"rare{i}x{j}" for j in range(40)), "often"]).encode()])
        assert len(pair._number) <= 50 + 41
    assert asked["often"] == 2  # by A and by B


def test_words_before_marks_are_encoded_once():
    pair = Pair(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
    pair.encode([b"word word. word, word; word: word! word?", b"other other. other, other; other: other! other?"])
    assert len(pair._number) == 8
    for text in ["a.b,c?!d.. e.\n\nf\x00.g a\x00 . b", "1.5,2 x².y é.́z :a ;b", "a. \n.b . c .", "s's. t're, don't; we'll? :"]:
        a, b, _, _ = pair.encode([text.encode()])
        assert a.tolist() == pair.a.encode(" " + text, add_special_tokens=False).ids, text
        assert b.tolist() == pair.b.encode(text), text


def test_encoding_starts_no_threads():
    """Each thread keeps memory of its own, in every worker of an executor."""
    code = """if True:
        import os, public_tokenizers
        from docindex.llm.alignment import A_FILE, B_FILE, Pair
        pair = Pair(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))
        before = len(os.listdir("/proc/self/task"))
        pair.encode([" ".join(f"word{i}" for i in range(20_000)).encode()])
        assert len(os.listdir("/proc/self/task")) == before
    """
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, cwd=Path(__file__).parents[2])


def test_hard_and_empty_tables(spark):
    got = align(cases.hard(spark)).collect()
    assert len(got) == 10 and {r.n_a for r in got if r.doc in (1, 2)} == {0}
    assert len({r.groups for r in got if r.doc == 6}) == 1
    assert align(cases.empty(spark)).count() == 0
