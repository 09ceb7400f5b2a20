import pytest
from pyspark.sql import functions as F

from docindex.llm import common, near_dups, substrings
from docindex.llm.components import components
from docindex.llm.near_dups import least_matches, near_duplicates
from docindex.llm.substrings import remove_repeats
from tests.llm import cases


@pytest.mark.parametrize("size, num", [(3, 85), (5, 80)])
def test_near_duplicates_match_all_pairs(spark, small_batches, size, num):
    texts = cases.make_texts(seed=size)
    sets, roots = cases.jaccard_components(texts, size, num, 100)
    found = near_duplicates(cases.frame(spark, texts), shingle=size, num=num, den=100).collect()
    assert {r.doc: (r.n_shingles, r.component_id) for r in found} == {
        i: (len(s), roots[i]) for i, s in enumerate(sets)
    }


def test_a_family_around_a_source_is_joined_across_its_leader(spark, monkeypatch):
    """Chains of edits whose ends are linked only through the middle, in blocks of two."""
    monkeypatch.setattr(near_dups, "BLOCK", 2)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(24):
        own = list(base)
        for j in range(i):
            own[(j * 5) % 120] = f"e{j}"
        texts.append(" ".join(own))
    sets, roots = cases.jaccard_components(texts, 3, 85, 100)
    found = near_duplicates(cases.frame(spark, texts), shingle=3, num=85, den=100).collect()
    assert {r.doc: r.component_id for r in found} == roots


@pytest.mark.parametrize("keys", [1_000_000, 0])
def test_full_sets_are_read_and_sent_once(spark, monkeypatch, keys):
    """With few pairs sets go to their leaders alone, else they are dealt by node first;
    nodes are sent as numbers."""
    plans, schemas = {}, {}
    staged = near_dups.staged

    def seen(df, name):
        plans[name], schemas[name] = df._jdf.queryExecution().executedPlan().toString(), dict(df.dtypes)
        return staged(df, name)

    monkeypatch.setattr(near_dups, "staged", seen)
    monkeypatch.setattr(common, "BROADCAST_KEYS", keys)
    texts = cases.make_texts(seed=3)
    sets, roots = cases.jaccard_components(texts, 3, 85, 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = near_duplicates(cases.frame(spark, texts), shingle=3, num=85, den=100).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.doc: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), roots[i]) for i, s in enumerate(sets)}
    for name in ("near-pairs", "root-pairs"):
        assert plans[name].count("shingles:array<bigint>") == 1
        assert plans[name].count("SortMergeJoin") == (0 if keys else 1)
    assert {schemas[name]["node"] for name in ("postings", "met", "placed")} == {"bigint"}


def test_hard_cases_of_near_duplicates(spark):
    rows = near_duplicates(cases.hard(spark), shingle=3, num=85, den=100).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc, []).append(r)
    assert [(r.n_shingles, r.component, r.component_id) for i in (1, 2, 3) for r in by_id[i]] == [
        (0, None, 1), (0, None, 2), (0, None, 3),
    ]
    assert [r.n_shingles for i in (4, 5) for r in by_id[i]] == [1, 1]
    assert len(by_id[6]) == 2 and {r.component_id for r in by_id[6]} == {6}
    assert len(by_id[None]) == 2 and {r.component_id for r in by_id[None]} == {None}
    assert near_duplicates(cases.empty(spark)).count() == 0


def test_least_matches_grows_with_similarity():
    assert least_matches(0.8) < least_matches(0.85) < least_matches(0.95) <= near_dups.COORDINATES


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 99)], "a bigint, b bigint")
    assert {r.node: r.root for r in components(links).collect()} == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99}


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_match_a_plain_scan(spark, small_batches, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "REPORTED", 1)
    monkeypatch.setattr(substrings, "HOT_SHARE", 50_000 if hot > 1 else 10_000_000)
    monkeypatch.setattr(substrings, "BUCKET_WORDS", 500)
    texts = cases.make_texts(seed=9)
    left = remove_repeats(cases.frame(spark, texts).repartition(5), size=20).collect()
    expected = cases.cut_repeats(texts, 20)
    assert {r.doc: r.kept for r in left} == {i: " ".join(w) for i, w in enumerate(expected)}
    assert all(cases.words(r.cut_text) == expected[r.doc] for r in left)
    assert all(r.n_removed == r.n_words - len(expected[r.doc]) for r in left)


def test_cut_text_keeps_line_feeds(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [f"first\n{passage}\nlast", f"  new line\nhere {passage}\nand after"]
    rows = remove_repeats(cases.frame(spark, texts)).orderBy("doc").collect()
    assert [r.cut_text for r in rows] == [texts[0], "new line\nhere\nand after"]


def test_hard_cases_of_repeats(spark):
    rows = remove_repeats(cases.hard(spark)).collect()
    first = {r.doc: r for r in rows}
    assert len(rows) == 10
    assert (first[1].n_words, first[1].kept, first[1].cut_text) == (0, "", None)
    assert (first[3].n_words, first[3].kept) == (0, "")
    # A row repeated with its id is one document: its first windows stay.
    assert {r.kept for r in rows if r.doc == 6} == {" ".join(cases.cut_repeats(["same text " * 12], 20)[0])}
    assert first[9].n_words == 60_000 and first[9].n_removed > 0
    assert remove_repeats(cases.empty(spark)).count() == 0


def test_equal_hashes_do_not_make_equal_windows(spark, small_batches, monkeypatch):
    """All windows of one hash: the words decide."""
    import numpy as np

    monkeypatch.setattr(substrings, "sequence_hashes", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    texts = cases.make_texts(seed=4, n=12)
    left = remove_repeats(cases.frame(spark, texts), size=20).collect()
    assert {r.doc: r.kept for r in left} == {i: " ".join(w) for i, w in enumerate(cases.cut_repeats(texts, 20))}


def test_frequent_values_keep_their_counts_within_the_bound():
    import numpy as np

    rng = np.random.default_rng(2)
    frequent, true = substrings.Frequent(50), np.zeros(5000, np.int64)
    for _ in range(200):
        values = np.concatenate([rng.integers(0, 5000, 60), [7] * 3, [9]])
        true += np.bincount(values, minlength=5000)
        frequent.add(*(x.astype(t) for x, t in zip(np.unique(values, return_counts=True), (np.uint64, np.int64))))
    held = dict(zip(frequent.values.tolist(), frequent.counts.tolist()))
    assert len(held) <= 50
    assert all(n <= true[v] for v, n in held.items())
    assert true[7] - held.get(7, 0) <= 2 * true.sum() / 50


def test_words_are_those_of_split_and_hashed_alike():
    texts = [None, b"", b" a\tb\x0b\x0cc\r\n", b"eight888 nine99999 a", "é\x00 \x85x\u2003y".encode(), b"w" * 64, b"w" * 65 + b" " + b"w" * 200]
    texts += [b"", b"a " + b"w" * 65, b"sixteen161616161 sixteen16161616x a" + bytes(3)]
    words = substrings.Words(texts)
    plain = [t.split() if t else [] for t in texts]
    flat = [w for row in plain for w in row]
    assert words.counts(texts).tolist() == [len(row) for row in plain]
    assert [words.data[i:j] for i, j in zip(words.begin, words.end)] == flat
    hashes = words.hashes().tolist()
    assert len({*zip(flat, hashes)}) == len({*flat}) == len({*hashes})
    for none in ([], [None], [b"", None, b" \n"]):
        assert substrings.Words(none).counts(none).tolist() == [0] * len(none)
        assert len(substrings.Words(none).hashes()) == 0


def test_only_words_of_compared_windows_are_numbered(monkeypatch):
    import pyarrow as pa

    numbered = []
    numbers = substrings.Vocabulary.numbers
    monkeypatch.setattr(substrings.Vocabulary, "numbers", lambda self, words: (numbered.extend(words), numbers(self, words))[1])
    passage = " ".join(f"p{i}" for i in range(22))
    texts = [" ".join(f"own{i}x{j}" for j in range(200)) for i in range(30)]
    for repeats, most in (([], 0), ([passage, passage], 2 * 44)):
        numbered.clear()
        rows = [f"{t} {passage}" if repeats and i < 2 else t for i, t in enumerate(texts)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int64()), pa.array(range(len(rows)), pa.int64()), pa.array(rows)],
            ["doc", "text_key", "text"],
        )
        list(substrings.AnchorCounts(20)([batch]))
        out = pa.Table.from_batches(list(substrings.Ship(20, 1, substrings.np.zeros(0, substrings.np.uint64))([batch])))
        found = substrings.Count(20)(out).to_pylist()
        assert [(r["doc"], r["start"], r["words"]) for r in found] == ([(1, 200, 22)] if repeats else [])
        assert len(numbered) <= most


def shipped_windows(texts, hot_share, monkeypatch, slice_rows):
    """What a task ships of each slice, with every minimiser hot."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(substrings, "slices", lambda b: (b.slice(i, slice_rows) for i in range(0, b.num_rows, slice_rows)))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)],
        ["doc", "text_key", "text"],
    )
    whole = substrings._Windows(batch, 20, substrings.Vocabulary())
    ship = substrings.Ship(20, 4, np.unique(whole.anchors))
    for out in ship([batch]):
        for known, blob in zip(out.column("known").to_pylist(), out.column("blob").to_pylist()):
            if not known:
                yield from substrings._unpack(blob)[0].tolist()


def test_a_passage_in_every_slice_is_shipped_once_per_task(monkeypatch):
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [f"a{i} b{i} {passage}" for i in range(40)]
    sent = [(d, s) for d, _, s, w in shipped_windows(texts, 1, monkeypatch, 3) for s in range(s, s + w - 19) if s == 2]
    assert sent == [(0, 2)]
    # Backwards, every slice's first is earlier than what was shipped before.
    texts = texts[::-1]
    assert len([1 for d, _, s, w in shipped_windows(texts, 1, monkeypatch, 3) if s <= 2 < s + w - 19]) == 1


def test_templates_below_the_threshold_are_not_compared_in_full(spark, monkeypatch):
    """Texts of one template, none of them similar enough: few full sets are sent."""
    sent = []
    across = near_dups.Join.across

    def counted(self, lists, sizes):
        sent.append(sizes.agg(F.sum("n")).first()[0] or 0)
        return across(self, lists, sizes)

    monkeypatch.setattr(near_dups.Join, "across", counted)
    monkeypatch.setattr(near_dups, "BLOCK", 4)
    for n in (100, 200):
        texts = [" ".join(f"t{j}" if j % 12 else f"own{i}x{j}" for j in range(96)) for i in range(n)]
        found = near_duplicates(cases.frame(spark, texts), shingle=3, num=85, den=100).collect()
        assert {r.component_id for r in found} == set(range(n))
    # Of each size: leaders' lists with few strangers, then lists of rare shingles.
    assert sent[1] == sent[3] == 0 and sent[2] <= 2.5 * sent[0] + 100


@pytest.mark.parametrize("parts", [1, 4])
def test_different_texts_of_one_id_are_different_documents(spark, parts):
    """A passage at word 0 of texts without an id, of texts under one id, and of equal rows."""
    line, other, third = (" ".join(f"{c}{i}" for i in range(25)) for c in "xyz")
    texts = [f"{line} a", f"{line} b", f"{other} a", f"{other} b", f"{third} a", f"{third} a"]
    docs = cases.frame(spark, texts, [None, None, 6, 6, 7, 7]).repartition(parts)
    removed = {}
    for r in remove_repeats(docs, size=20).collect():
        removed.setdefault(r.doc, []).append(r.n_removed)
    assert {d: sorted(n) for d, n in removed.items()} == {None: [0, 25], 6: [0, 25], 7: [0, 0]}
