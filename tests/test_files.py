import pyarrow as pa
import pytest

from docindex.extractors import utf8_text
from docindex.operators.documents import extract_html, extract_with
from docindex.sources.files import scan_binary
from docindex.sources.scratch import scratch_path


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one")
    (tmp_path / "b.pdf").write_bytes(b"\xff\xfe")
    (tmp_path / "C.PDF").write_bytes(b"three")
    (tmp_path / "d.txt").write_bytes(b"four")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.pdf").write_bytes(b"five")
    return str(tmp_path)


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.collect())


def test_glob_is_case_sensitive_and_not_recursive(spark, corpus):
    files = scan_binary(spark, corpus)
    assert files.columns == ["path", "content"]
    assert names(files) == ["a.pdf", "b.pdf"]
    assert names(scan_binary(spark, corpus, "*.{pdf,PDF}")) == ["C.PDF", "a.pdf", "b.pdf"]
    assert names(scan_binary(spark, corpus, recursive=True)) == ["a.pdf", "b.pdf", "e.pdf"]


def test_content_is_not_read_unless_asked_for(spark, corpus):
    plan = scan_binary(spark, corpus, columns=("path", "length"))._jdf.queryExecution()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan.executedPlan().toString()


def test_an_unreadable_file_has_no_text(spark, corpus):
    raw = extract_with(scan_binary(spark, corpus), utf8_text, uri="path")
    assert sorted((r.uri[-5:], r.rawText) for r in raw.collect()) == [("a.pdf", "one"), ("b.pdf", None)]


def test_an_extractor_that_returns_no_string(spark, corpus):
    raw = extract_with(scan_binary(spark, corpus), lambda content: None, uri="path")
    assert {r.rawText for r in raw.collect()} == {None}


def test_html_extraction(spark):
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    assert [tuple(r) for r in extract_html(pages, uri="url").collect()] == [("u", " x ")]


def test_scratch_lies_in_the_checkpoint_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_extracted_texts_are_handed_on_in_parts(spark):
    """A task gathers few texts, however many rows a batch has."""

    class Files:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            values = [b"x" * 1000 if i % 7 else None for i in range(5000)]
            return list(run(iter([pa.RecordBatch.from_pydict({"uri": [f"u{i}" for i in range(5000)], "content": values})])))

    parts = extract_with(Files(), utf8_text, reasons=True)
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["uri"] for r in rows] == [f"u{i}" for i in range(5000)]
    assert all((r["error"] is None) == bool(i % 7) == (r["rawText"] == "x" * 1000) for i, r in enumerate(rows))
    assert len(parts) > 3 and max(p.nbytes for p in parts) < 2_000_000
