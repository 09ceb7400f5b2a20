"""The pipeline's stages against plain versions, each on its own input."""

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from docindex.llm.pii import KINDS, base_spans
from tests.llm import cases
from tests.llm.test_operators import plain_figures


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_match_plain_versions(spark, small_batches):
    texts = cases.make_texts(seed=21, n=80)
    texts[5] += " write to some.one@example.org or 10.0.0.1 now"
    docs = cases.frame(spark, texts)

    kept = pipeline.quality(spark, docs, "")
    figures = {i: plain_figures(t) for i, t in enumerate(texts)}
    good = {i for i, f in figures.items() if f[0] >= 20 and 100 * f[4] <= 30 * f[0]}
    assert texts_of(kept) == {i: texts[i] for i in good}
    assert kept.columns == docs.columns

    single = pipeline.near_dedup(spark, kept, "")
    order = sorted(good)
    _, roots = cases.jaccard_components([texts[i] for i in order], 5, 80, 100)
    left = [i for n, i in enumerate(order) if roots[n] == n]
    assert texts_of(single) == {i: texts[i] for i in left}

    cut = pipeline.substring_dedup(spark, single, "")
    plain = dict(zip(left, cases.cut_repeats([texts[i] for i in left], 20)))
    found = texts_of(cut)
    assert {i: cases.words(t) for i, t in found.items()} == plain
    assert all(found[i] == texts[i] for i in left if cases.words(texts[i]) == plain[i])
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    hidden = texts_of(pipeline.pii(spark, cut, ""))
    for i, t in found.items():
        for kind, start, end in sorted(base_spans(t), key=lambda s: -s[1]):
            t = f"{t[:start]}<{KINDS[kind].upper()}>{t[end:]}"
        assert hidden[i] == t

    pieces = pipeline.packing(spark, pipeline.pii(spark, cut, ""), "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in hidden.items():
        own = b"".join(bytes(p.ids) for p in sorted(pieces, key=lambda p: p.start) if p.doc_id == i)
        assert np.frombuffer(own, "<u4").tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 1]


def test_stages_take_hard_and_empty_tables(spark):
    for docs, twins in ((cases.hard(spark), True), (cases.empty(spark), False)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, docs, "")
            if name != "packing":
                assert out.columns == docs.columns
                assert out.schema.simpleString() == docs.schema.simpleString()
            rows = out.collect()
            if twins and name == "near_dedup":  # rows that repeat an id and a text, once
                assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [
                    *((False, i) for i in (1, 2, 3, 4, 5, 6, 9)), (True, 0),
                ]


def test_every_operator_and_the_pipeline_is_registered():
    names = contract.queries()
    found = {int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m}
    assert found == set(range(1, 14)) and names["pipeline"] is pipeline.run
