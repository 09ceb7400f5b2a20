"""Merges, deletes, evolution, writers and retention of a stored table."""

import pytest
from pyspark.sql import functions as F

from docindex.sources import bucket_table
from docindex.sources.bucket_table import BucketTable
from docindex.sources.folder import WriteConflictError


@pytest.fixture
def table(spark, tmp_path):
    return BucketTable(spark, str(tmp_path / "table"), "id", buckets=4)


def rows(spark, values, columns="id int, name string"):
    return spark.createDataFrame(values, columns)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_reads_back_and_leaves_other_buckets_alone(spark, table):
    table.overwrite(rows(spark, [(i, f"n{i}") for i in range(40)]))
    before = table.files()
    touched = table.touched_buckets(rows(spark, [(7, "")]))
    table.merge(rows(spark, [(7, "seven")]), ["id"])
    after = table.files()
    assert len(touched) == 1 and len(before) == 4
    assert {b for b in before if before[b] != after[b]} == set(touched)
    assert content(table.read()) == content(rows(spark, [(i, "seven" if i == 7 else f"n{i}") for i in range(40)]))


def test_conditional_merge_inserts_and_updates(spark, table):
    table.overwrite(rows(spark, [(1, "a"), (2, "b"), (3, None)]))
    source = rows(spark, [(1, "a"), (2, "changed"), (3, "x"), (4, "new")])
    differs = F.col("target.name") != F.col("source.name")
    table.merge(source, ["id"], update_when=differs)
    assert content(table.read()) == [(1, "a"), (2, "changed"), (3, None), (4, "new")]
    with pytest.raises(Exception, match="more than one source row"):
        table.merge(rows(spark, [(1, "p"), (1, "q")]), ["id"])
    assert table.versions() == [1, 2]


def test_merge_needs_the_bucket_key(spark, table):
    table.overwrite(rows(spark, [(1, "a")]))
    with pytest.raises(ValueError, match="must include 'id'"):
        table.merge(rows(spark, [(1, "a")]), ["name"])


def test_delete_by_bucket_key_and_by_another(spark, table):
    table.overwrite(rows(spark, [(i, "even" if i % 2 == 0 else f"odd{i}") for i in range(20)]))
    table.delete(rows(spark, [(0, None), (1, None), (99, None)]), ["id"])
    assert {r.id for r in table.read().collect()} == set(range(2, 20))
    files = table.files()
    touched = table.touched_buckets(rows(spark, [(3, "")]))
    table.delete(rows(spark, [(0, "odd3")]), ["name"])
    assert {b for b in files if files.get(b) != table.files().get(b)} == set(touched)
    table.delete(rows(spark, [(0, "even"), *((0, f"odd{i}") for i in range(20))]), ["name"])
    assert content(table.read()) == [] and table.files() == {}
    table.merge(rows(spark, [(5, "again")]), ["id"])
    assert content(table.read()) == [(5, "again")]


def test_added_columns_are_null_before(spark, table):
    table.overwrite(rows(spark, [(i, f"n{i}") for i in range(10)]))
    table.merge(rows(spark, [(1, "one", 1.5), (77, "new", 2.5)], "id int, name string, weight double"), ["id"])
    found = {r.id: (r.name, r.weight) for r in table.read().collect()}
    assert found[1] == ("one", 1.5) and found[77] == ("new", 2.5) and found[2] == ("n2", None)
    # Rows written without the column keep what others have.
    table.merge(rows(spark, [(2, "two")]), ["id"], update={"name": F.col("source.name")})
    assert table.read().columns == ["id", "name", "weight"]
    assert {r.id: r.weight for r in table.read().collect()}[1] == 1.5
    # The version before still reads as it was.
    assert table.read(1).columns == ["id", "name"]
    table.merge(rows(spark, [(3, "x", "y")], "id int, name string, ignored string"), ["id"], evolve=False)
    assert "ignored" not in table.read().columns
    with pytest.raises(ValueError, match="column 'weight' is double"):
        table.merge(rows(spark, [(3, "x", "y")], "id int, name string, weight string"), ["id"])


def test_of_two_writers_one_is_refused(spark, table, monkeypatch):
    table.overwrite(rows(spark, [(1, "a"), (2, "b")]))
    other = BucketTable(spark, table.root, "id")
    write = BucketTable._write

    def slow(self, *args):
        done = write(self, *args)
        if self is other:
            table.merge(rows(spark, [(1, "first")]), ["id"])
        return done

    monkeypatch.setattr(BucketTable, "_write", slow)
    with pytest.raises(WriteConflictError):
        other.merge(rows(spark, [(2, "second")]), ["id"])
    assert content(table.read()) == [(1, "first"), (2, "b")]
    with pytest.raises(WriteConflictError):
        table.folder.create_json("versions/000000002.json", {})


def test_an_unfinished_version_is_passed_over(spark, table):
    table.overwrite(rows(spark, [(1, "a")]))
    path = table.folder._path("versions/000000002.json")
    table.folder._files.create(path, False).close()
    assert table.versions() == [1]
    assert table.merge(rows(spark, [(1, "b")]), ["id"]) == 3
    assert content(table.read()) == [(1, "b")]


def test_expire_keeps_what_kept_versions_need(spark, table):
    table.overwrite(rows(spark, [(i, "a") for i in range(20)]))
    for name in "bcd":
        table.merge(rows(spark, [(1, name)]), ["id"])
    kept = content(table.read(3)), content(table.read(4))
    assert table.expire(keep=2) == 0  # all too young
    assert table.expire(keep=2, min_age_seconds=0) == 1
    assert (content(table.read(3)), content(table.read(4))) == kept
    assert table.versions() == [3, 4]
    with pytest.raises(ValueError, match="no version 1"):
        table.read(1)


def test_null_keys_and_empty_tables(spark, table):
    table.overwrite(rows(spark, []))
    assert content(table.read()) == [] and table.exists()
    table.merge(rows(spark, [(None, "nobody"), (1, "a")]), ["id"])
    table.merge(rows(spark, [(None, "nobody else")]), ["id"])
    assert content(table.read()) == [(1, "a"), (None, "nobody else"), (None, "nobody")]


def test_a_merge_by_keys_leaves_unchanged_buckets_and_rows_alone(spark, table, monkeypatch):
    monkeypatch.setattr(bucket_table, "LARGE_FILE", 0, raising=False)
    table.overwrite(rows(spark, [(i, f"n{i}") for i in range(40)] + [(None, "nobody")]))
    before = table.files()
    source = rows(spark, [(i, "seven" if i == 7 else f"n{i}") for i in range(40)] + [(99, "new"), (None, "nobody else")])
    written, write = [], BucketTable._write

    def seen(self, moved, schema, n, stay=None):
        written.append((moved and moved.count(), stay and stay.count()))
        return write(self, moved, schema, n, stay)

    monkeypatch.setattr(BucketTable, "_write", seen)
    differs = F.col("target.name") != F.col("source.name")
    table.merge(source, ["id"], update_when=differs, compare=["name"])
    acting = [(7, "seven"), (99, "new"), (None, "nobody else")]
    touched = table.touched_buckets(rows(spark, acting))
    assert {b for b in before if before[b] != table.files()[b]} == set(touched)
    kept = [(i, f"n{i}") for i in range(40) if i != 7] + [(None, "nobody")]
    assert content(table.read()) == content(rows(spark, kept + acting))
    assert written[0][0] == 3 and 0 < written[0][1] <= len(kept)
    table.delete(rows(spark, [(7, ""), (8, "")]), ["id"])
    assert written[1][0] is None
    assert content(table.read()) == content(rows(spark, [r for r in kept + acting if r[0] not in (7, 8)]))
    with pytest.raises(ValueError, match="whole rows"):
        table.merge(source, ["id"], compare=["name"])
