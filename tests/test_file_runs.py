"""Runs over files: what is opened, recorded and cut again."""

import os

import pytest
from pyspark.sql import functions as F

from docindex import IndexConfig, IndexStore, index_directory
from docindex.embedders import HashEmbedder
from docindex.plans.increment import EmbeddingOutageError
from docindex.sources.files import FileCorpus
from docindex.sources.folder import WriteConflictError


class Corpus:
    """Files in a folder, an index of them, and a count of what is opened."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder, self.path = spark, tmp_path / "files [1]{x}", str(tmp_path / "index")
        self.folder.mkdir()
        self.opened = spark.sparkContext.accumulator(0)
        self.clock = 1_700_000_000

    @property
    def store(self):
        return IndexStore(self.spark, self.path)

    def put(self, **texts):
        for name, text in texts.items():
            path = self.folder / f"{name}.txt"
            path.write_bytes(text if isinstance(text, bytes) else text.encode())
            self.clock += 10
            os.utime(path, (self.clock, self.clock))

    def run(self, embedder=None, **settings):
        settings = {"chunk_size": 10, "chunk_overlap": 3, "buckets": 4, **settings}
        cfg = IndexConfig(self.path, str(self.folder).replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}"), "*.txt", model="m", version="1", **settings)
        opened = self.opened

        def extract(content):
            opened.add(1)
            return content.decode("utf-8")

        before = self.opened.value
        report = index_directory(self.spark, cfg, embedder or HashEmbedder(4), extract)
        return report, self.opened.value - before

    def texts(self):
        return {os.path.basename(r.uri): r.text for r in self.store.docs().collect()}

    def served(self):
        rows = self.store.retrieval_index().collect()
        return {(os.path.basename(r.uri), r.startOffset): r.chunkText for r in rows}


@pytest.fixture
def corpus(spark, tmp_path):
    return Corpus(spark, tmp_path)


def test_unchanged_files_are_not_opened(corpus):
    corpus.put(a="alpha text", b="beta text", c="gamma text")
    report, opened = corpus.run()
    assert (report.new_docs, report.files_read, opened) == (3, 3, 3)
    report, opened = corpus.run()
    assert (report.committed, report.files_read, opened) == (False, 0, 0)
    corpus.put(b="beta changed", d="delta")
    (corpus.folder / "c.txt").unlink()
    report, opened = corpus.run()
    assert (report.new_docs, report.changed_docs, report.deleted_docs, report.total_docs, opened) == (1, 1, 1, 3, 2)
    assert corpus.texts() == {"a.txt": "alpha text", "b.txt": "beta changed", "d.txt": "delta"}
    # Written again with the same text: read once more, then known again.
    corpus.put(a="alpha text")
    report, opened = corpus.run()
    assert (report.changed_docs, report.committed, opened) == (0, True, 1)
    assert corpus.run()[1] == 0
    corpus.store.compact()
    assert corpus.run()[1] == 0 and corpus.run(reader="2")[1] == 3


def test_failures_are_recorded_and_tried_again(corpus):
    corpus.put(a="alpha text", b=b"\xff\xfe", c=" \n")
    report, _ = corpus.run()
    assert (report.new_docs, report.failed_docs) == (1, 2)
    failed = corpus.store.failures().collect()
    assert [(os.path.basename(r.uri), r.error.split(":")[0]) for r in failed] == [("b.txt", "UnicodeDecodeError")]
    assert corpus.run()[1] == 2  # the two without a text, not the good one
    corpus.put(b="readable now")
    assert corpus.run()[0].new_docs == 1 and corpus.store.failures().count() == 0


def test_a_new_window_cuts_unopened_and_unreadable_documents(corpus):
    corpus.put(a="alpha text of some length", b="beta text of some length")
    corpus.run()
    corpus.put(b=b"\xff")
    report, opened = corpus.run(chunk_size=8, chunk_overlap=0)
    assert opened == 1 and report.changed_docs == 1 and report.failed_docs == 1 and report.total_docs == 1
    assert {start % 8 for _, start in corpus.served()} == {0}
    assert corpus.served()["b.txt", 8] == "t of som"
    assert corpus.texts()["b.txt"] == "beta text of some length"
    assert not corpus.run(chunk_size=8, chunk_overlap=0)[0].committed


def test_a_first_run_without_vectors_is_an_outage(corpus):
    def dead(texts, model):
        raise TimeoutError

    corpus.put(a="alpha text")
    with pytest.raises(EmbeddingOutageError):
        corpus.run(dead)
    assert corpus.store.last_run() is None
    corpus.run()
    assert corpus.served() != {}


def test_many_wanted_files_are_narrowed_by_their_time(spark, corpus):
    corpus.put(**{f"f{i}": f"text {i}" for i in range(6)})
    files = FileCorpus(spark, str(corpus.folder).replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}"), "*.txt", listed_files=2)
    wanted = files.listing().filter(F.col("uri").rlike("f[234]"))
    found = files.read(wanted)
    assert sorted(bytes(r.content) for r in found.collect()) == [b"text 2", b"text 3", b"text 4"]
    assert "modificationTime" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_added_columns_reach_readers_and_outlive_a_fold(spark, corpus):
    corpus.put(a="alpha text", b="beta text")
    corpus.run()
    store = corpus.store
    row = store.last_run()
    docs = store.docs().filter("text = 'beta text'").withColumn("lang", F.lit("en"))
    store.write("docs", docs, 2)
    store.write("changes", docs.select("docId", "uri", F.lit("changed").alias("status")), 2)
    store.commit({**row.asDict(), "run": 2, "touchedSinceBase": 1})
    found = {r.text: r.lang for r in corpus.store.docs().collect()}
    assert found == {"alpha text": None, "beta text": "en"}
    with pytest.raises(ValueError, match="'lang' of docs is string"):
        corpus.store.write("docs", docs.withColumn("lang", F.lit(1)), 3)
    corpus.store.compact()
    assert {r.text: r.lang for r in corpus.store.docs().collect()} == found


def test_of_two_runs_from_one_base_one_is_refused(spark, corpus, monkeypatch):
    corpus.put(a="alpha text", b="beta text")
    corpus.run()
    commit, seen = IndexStore.commit, []

    def late(self, row):
        if not seen:
            seen.append(True)
            (corpus.folder / "a.txt").unlink()
            corpus.run()
        commit(self, row)

    corpus.put(b="beta edited")
    monkeypatch.setattr(IndexStore, "commit", late)
    with pytest.raises(WriteConflictError):
        corpus.run()
    assert corpus.texts() == {"b.txt": "beta edited"}
    assert set(corpus.served().values()) == {"beta edite", "ited"}
    attempts = corpus.store.folder.names("docs/run=2")
    assert len(attempts) == 2 and corpus.store.expire(keep=2, min_age_seconds=0) > 0
    assert len(corpus.store.folder.names("docs/run=2")) == 1 and corpus.texts() == {"b.txt": "beta edited"}


def test_expire_removes_what_a_fold_replaced(corpus):
    corpus.put(a="alpha text", b="beta text")
    corpus.run()
    corpus.put(a="alpha edited")
    corpus.run()
    before = corpus.texts(), corpus.served()
    corpus.store.compact()
    assert corpus.store.expire() == 0  # all too young
    assert corpus.store.expire(min_age_seconds=0) > 0
    assert corpus.store.folder.names("docs/run=1") == []
    assert (corpus.texts(), corpus.served()) == before


def test_hashes_of_touched_documents_replace_a_shuffle(spark, corpus):
    corpus.put(**{f"f{i}": f"text number {i}" for i in range(8)})
    corpus.run()
    corpus.put(f1="edited", f2="edited too")
    corpus.run()
    store = IndexStore(spark, corpus.path, broadcast_rows=1)
    live = store.docs()
    assert {r.text for r in live.collect()} == {*(f"text number {i}" for i in range(8) if i not in (1, 2)), "edited", "edited too"}
    plan = live._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert not any("text" in line for line in shuffled)


def test_one_changed_document_reads_one_bucket_of_vectors(corpus, monkeypatch):
    corpus.put(**{f"f{i}": f"text number {i}" for i in range(12)})
    corpus.run()
    asked, read = [], IndexStore.embeddings

    def seen(self, as_of=None, buckets=None):
        asked.append(buckets)
        return read(self, as_of, buckets)

    monkeypatch.setattr(IndexStore, "embeddings", seen)
    corpus.put(f3="text number three")
    report, _ = corpus.run()
    assert [len(b) for b in asked if b is not None] == [1] and report.chunks_reused == 1


def test_a_run_stores_the_seconds_of_its_steps(corpus):
    corpus.put(a="alpha text")
    report, _ = corpus.run()
    row = corpus.store.last_run()
    assert set(row.stepSeconds) == {"documents", "chunk", "embed", "publish", "total"} == set(report.seconds)
    assert 0 < row.stepSeconds["embed"] <= row.totalSeconds and row.filesRead == 1
    assert corpus.store.runs().collect()[0].stepSeconds == row.stepSeconds
