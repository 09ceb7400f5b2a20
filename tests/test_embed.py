import io
import json
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from docindex.embedders import HashEmbedder, HttpEmbedder, decode_response, encode_request
from docindex.operators.embed import (
    backlog,
    backlog_by_keys,
    embed_chunks,
    errors_of,
    is_valid_vector,
    of_version,
    vectors_of,
)
from docindex.operators.index import retrieval_index
from docindex.plans.scenario import stub_vector
from docindex.schemas import ATTEMPTS, EMBEDDINGS, RETRIEVAL_INDEX

WORK = "chunkId string, docId string, chunkContentHash string, chunkText string"


def work(spark, texts):
    rows = [(f"c{i}", f"d{i % 2}", f"h{i}", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, WORK)


def run(spark, texts, embedder, **options):
    return embed_chunks(work(spark, texts), embedder, "m", "1", **options)


class Failing:
    """Refuses texts that contain 'bad', returns odd vectors for others."""

    def __call__(self, texts, model):
        if any("bad" in t for t in texts):
            raise TimeoutError("slow")
        return [
            {"none": None, "empty": [], "short": [1.0], "words": ["x", "y"]}.get(t, [1.0, 2.0])
            for t in texts
        ]


def test_one_vector_per_text_with_its_row(spark):
    texts = [f"text {i}" for i in range(200)]
    got = run(spark, texts, HashEmbedder(4), batch=7, partitions=3, dimension=4)
    assert got.schema == ATTEMPTS
    rows = {r.chunkId: r for r in got.collect()}
    vectors = HashEmbedder(4)(texts, "m")
    assert len(rows) == 200
    for i, vector in enumerate(vectors):
        row = rows[f"c{i}"]
        assert (row.docId, row.chunkContentHash) == (f"d{i % 2}", f"h{i}")
        assert row.embedding == vector and row.error is None
        assert (row.embedder, row.embedderVersion) == ("m", "1")
    assert len({tuple(v) for v in vectors}) == 200


def test_a_failure_concerns_its_own_text_only(spark):
    texts = ["ok", "bad" + "x" * 100, "none", "empty", "short", "words", "fine"]
    got = run(spark, texts, Failing(), batch=64, dimension=2)
    assert {r.chunkId for r in vectors_of(got).collect()} == {"c0", "c6"}
    errors = {r.chunkId: r for r in errors_of(got).collect()}
    assert errors["c1"].error == "TimeoutError: slow"
    assert errors["c1"].textPrefix == "bad" + "x" * 47
    assert errors["c2"].error == errors["c3"].error == "empty vector"
    assert errors["c4"].error == "dimension 1, expected 2"
    assert errors["c5"].error.startswith("ValueError")
    assert set(vectors_of(got).columns) == set(EMBEDDINGS.fieldNames())


def test_a_wrong_number_of_vectors_is_a_failure(spark):
    got = run(spark, ["a", "b"], lambda texts, model: [[1.0]] * 3)
    assert errors_of(got).count() == 2


def test_no_chunks(spark):
    assert run(spark, ["x"], Failing()).filter("false").count() == 0
    assert embed_chunks(work(spark, ["x"]).filter("1 = 0"), Failing(), "m", "1").count() == 0


def test_the_expression_and_the_embedder_agree(spark):
    texts = ["", "a", "é", "\U0001f600" * 30]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = [r[0] for r in df.select(stub_vector(F.sha2("t", 256))).collect()]
    assert got == HashEmbedder(8)(texts, "m")


def vectors(spark, rows):
    return spark.createDataFrame(
        [(c, "d", [1.0], m, v, h) for c, m, v, h in rows], EMBEDDINGS
    )


def test_backlog(spark):
    chunks = spark.createDataFrame([("c1", "new"), ("c2", "same"), ("c3", "x")], "chunkId string, chunkContentHash string")
    stored = vectors(spark, [("c1", "m", "1", "old"), ("c2", "m", "1", "same"), ("c3", "m", "0", "x")])
    by = lambda *a: sorted(r.chunkId for r in backlog(chunks, stored, *a).collect())
    assert by("m", "1") == ["c1", "c3"]
    assert by("m", "1", "by_id") == ["c3"]
    assert by("m", "2") == ["c1", "c2", "c3"]
    assert of_version(stored, "m", "0").count() == 1


@pytest.mark.parametrize("address_bytes", [None, 10], ids=["keys-first", "broadcast"])
def test_retrieval_index(spark, address_bytes):
    docs = spark.createDataFrame([("d1", "u1", "t"), ("d2", "u2", "t")], "docId string, uri string, text string")
    chunks = spark.createDataFrame(
        [("d1", "c1", "one", 0, 3, "h1"), ("d1", "c2", "two", 2, 5, "h2"), ("dx", "c3", "no", 0, 2, "h3")],
        "docId string, chunkId string, chunkText string, startOffset int, endOffset int, chunkContentHash string",
    )
    stored = vectors(
        spark, [("c1", "m", "1", "h1"), ("c1", "m", "0", "h1"), ("c2", "m", "1", "old"), ("c3", "m", "1", "h3")]
    )
    def ids(*args):
        got = retrieval_index(docs, chunks, stored, *args, address_bytes=address_bytes)
        assert got.columns == RETRIEVAL_INDEX.fieldNames()
        return sorted((r.uri, r.chunkId) for r in got.collect())

    assert ids("m", "1") == [("u1", "c1")]
    assert ids("m", "1", "by_id") == [("u1", "c1"), ("u1", "c2")]
    assert ids("m", "2") == []


def test_vector_check(spark):
    bad = [[], None, [1.0], [1.0, float("nan")], [float("inf"), 1.0], [None, 1.0]]
    df = spark.createDataFrame([([1.0, 2.0],), *((v,) for v in bad)], "v array<double>")
    assert [r[0] for r in df.coalesce(1).select(is_valid_vector(F.col("v"), 2)).collect()] == [True] + [False] * 6


def test_a_vector_that_is_not_finite_is_a_failure(spark):
    vectors = {"a": [1.0, float("nan")], "b": [1.0, 2.0]}
    got = run(spark, ["a", "b"], lambda texts, model: [vectors[t] for t in texts])
    assert [r.error for r in errors_of(got).collect()] == ["vector with a component that is not finite"]
    assert vectors_of(got).count() == 1


def test_request_and_response():
    assert json.loads(encode_request("five words", "some-model")) == {"model": "some-model", "prompt": "five words"}
    assert decode_response(b'{"embedding":[-4, 2.5]}') == [-4.0, 2.5]
    for malformed in (b'{"vector":[7]}', b"[1]", b"<html>", b'{"embedding":1}'):
        with pytest.raises(ValueError):
            decode_response(malformed)


def test_http_embedder(monkeypatch):
    seen = []

    def answer(request, timeout):
        seen.append((request.full_url, json.loads(request.data)["prompt"], timeout))
        if "bad" in request.data.decode():
            raise urllib.error.URLError("refused")
        return io.BytesIO(b'{"embedding":[1, 2]}')

    monkeypatch.setattr(urllib.request, "urlopen", answer)
    embedder = HttpEmbedder("http://host:1/")
    assert embedder(["a", "b"], "m") == [[1.0, 2.0], [1.0, 2.0]]
    assert seen == [("http://host:1/api/embeddings", t, 30.0) for t in "ab"]
    assert embedder(["good", "bad", "fine"], "m") == [[1.0, 2.0], None, [1.0, 2.0]]


def test_hash_embedder_dimension():
    with pytest.raises(ValueError):
        HashEmbedder(17)


@pytest.mark.parametrize("limit", [0, 100])
def test_backlog_by_keys_equals_the_join_of_rows(spark, limit):
    chunks = spark.createDataFrame(
        [("c1", "d", "h1", "one"), ("c2", "d", "h2", "two"), ("c3", "d", "h3", "three"), ("c4", "d", None, "four")],
        "chunkId string, docId string, chunkContentHash string, chunkText string",
    )
    vectors = spark.createDataFrame(
        [("c1", "m", "1", "h1"), ("c2", "m", "1", "old"), ("c3", "m", "2", "h3")],
        "chunkId string, embedder string, embedderVersion string, chunkContentHash string",
    )
    got = backlog_by_keys(chunks, vectors, "m", "1", limit=limit)
    assert sorted(got.collect()) == sorted(backlog(chunks, vectors, "m", "1").collect())
    assert {r.chunkId for r in got.collect()} == {"c2", "c3", "c4"}
