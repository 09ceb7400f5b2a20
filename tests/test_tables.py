import random

import pytest
from pyspark.sql import functions as F

from docindex.operators.changes import classify_changes, deleted, new_or_changed
from docindex.operators.tables import (
    cascade_delete,
    delete_keys,
    keep_keys,
    merge_upsert,
    replace_groups,
)

DOC = "docId string, contentHash string"


def differs():
    return F.col("target.contentHash") != F.col("source.contentHash")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=[None, 100], ids=["outer-join", "parted"])
def size(request):
    return request.param


def merged(spark, target, source, size, **options):
    t = spark.createDataFrame(target, DOC)
    s = spark.createDataFrame(source, DOC)
    return rows(merge_upsert(t, s, ["docId"], source_rows=size, **options))


def test_a_changed_hash_is_updated(spark, size):
    assert merged(spark, [("paris", "v7")], [("paris", "v8")], size, update_when=differs()) == [
        ("paris", "v8")
    ]


def test_a_new_document_is_inserted(spark, size):
    got = merged(
        spark, [("paris", "v7")], [("paris", "v7"), ("quito", "v0")], size, update_when=differs()
    )
    assert got == [("paris", "v7"), ("quito", "v0")]


def test_a_null_condition_does_not_update(spark, size):
    assert merged(spark, [("a", None)], [("a", "h")], size, update_when=differs()) == [("a", None)]


def test_null_keys_match_nothing(spark, size):
    got = merged(spark, [(None, "t")], [(None, "s"), (None, "s2")], size, update_when=differs())
    assert got == rows_of([(None, "t"), (None, "s"), (None, "s2")])
    assert merged(spark, [(None, "t")], [(None, "s")], size) == rows_of([(None, "t"), (None, "s")])


def rows_of(values):
    return sorted(values, key=repr)


def test_empty_sides(spark, size):
    assert merged(spark, [], [("a", "h")], size, update_when=differs()) == [("a", "h")]
    assert merged(spark, [("a", "h")], [], size, update_when=differs()) == [("a", "h")]


@pytest.mark.parametrize("whole_row", [True, False])
def test_two_source_rows_for_one_key_are_an_error(spark, size, whole_row):
    options = {} if whole_row else {"update_when": differs()}
    with pytest.raises(Exception, match="more than one source row"):
        merged(spark, [("a", "1")], [("a", "2"), ("a", "3")], size, **options)


def test_column_subset_and_insert_map(spark, size):
    t = spark.createDataFrame([("c1", "m", "v0", "keep"), ("c1", "n", "v0", "keep")], "c string, m string, v string, x string")
    s = spark.createDataFrame([("c1", "m", "v1", "lost"), ("c2", "m", "v2", "lost")], t.schema)
    got = merge_upsert(
        t,
        s,
        ["c", "m"],
        update={"v": F.col("source.v")},
        insert={k: F.col(f"source.{k}") for k in ("c", "m", "v")},
        source_rows=size,
    )
    assert rows(got) == rows_of(
        [("c1", "m", "v1", "keep"), ("c1", "n", "v0", "keep"), ("c2", "m", "v2", None)]
    )


def test_unknown_column(spark):
    t = spark.createDataFrame([("a", "h")], DOC)
    with pytest.raises(ValueError):
        merge_upsert(t, t, ["docId"], update={"nope": F.col("source.docId")})


@pytest.mark.parametrize("seed", range(3))
def test_random_merges_like_brute_force(spark, size, seed):
    rng = random.Random(seed)
    hashes = ["h1", "h2", None]
    target = {f"k{i}": rng.choice(hashes) for i in rng.sample(range(40), 25)}
    source = {f"k{i}": rng.choice(hashes) for i in rng.sample(range(40), 25)}
    expected = dict(target)
    for key, new in source.items():
        old = target.get(key)
        if key not in target or (old is not None and new is not None and old != new):
            expected[key] = new
    got = merged(spark, list(target.items()), list(source.items()), size, update_when=differs())
    assert got == rows_of(expected.items())
    assert merged(spark, list(target.items()), list(source.items()), size) == rows_of(
        {**target, **source}.items()
    )


def test_a_known_small_source_never_shuffles_the_other_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id AS v").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    s = spark.range(5).selectExpr("id", "-id AS v")
    on = "id"
    plan = merge_upsert(t, s, [on], source_rows=5, unique_source=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert plan.filter("v <= 0").count() == 5 and plan.count() == 1000


def test_deletes(spark, size):
    t = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], DOC)
    keys = spark.createDataFrame([("a",), ("zz",), ("a",)], "docId string")
    assert rows(delete_keys(t, keys, ["docId"], size)) == rows_of([("b", "2"), (None, "3")])
    assert rows(keep_keys(t, keys, ["docId"], size)) == [("a", "1")]
    left = cascade_delete(keys, {"docs": t}, ["docId"], size)
    assert set(left) == {"docs"} and left["docs"].count() == 2


def test_replaced_groups_may_shrink_to_nothing(spark, size):
    t = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], DOC)
    s = spark.createDataFrame([("b", "4"), ("b", "5")], DOC)
    groups = spark.createDataFrame([("a",), ("b",)], "docId string")
    assert rows(replace_groups(t, s, groups, ["docId"], size)) == [("b", "4"), ("b", "5")]


def test_change_detection(spark):
    schema = "docId string, uri string, contentHash string"
    now = [("n", "u/n", "1"), ("c", "u/c", "2"), ("s", "u/s", "3"), ("f", "u/f", None), ("k", "u/k", None)]
    old = [("c", "u/c", "1"), ("s", "u/s", "3"), ("d", "u/d", "4"), ("k", "u/k", "5")]
    current = spark.createDataFrame(now, schema).withColumn("readable", F.col("contentHash").isNotNull())
    stored = spark.createDataFrame(old, schema)
    got = {r.docId: r.status for r in classify_changes(current, stored).collect()}
    assert got == {
        "n": "new", "c": "changed", "s": "unchanged", "d": "deleted", "f": "failed", "k": "kept"
    }
    readable = current.filter("readable")
    assert {r.docId for r in new_or_changed(readable, stored).collect()} == {"n", "c"}
    assert {r.docId for r in deleted(readable, stored).collect()} == {"d", "k"}


def test_a_merge_by_keys_equals_the_full_join(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z"), (None, "n", "t")], "id int, hash string, text string")
    source = spark.createDataFrame(
        [(1, "a", "same"), (2, "c", "edited"), (3, "d", "unknown"), (4, "e", "new"), (None, "n", "s"), (None, "n", "s2")],
        "id int, hash string, text string",
    )
    differs = F.col("target.hash") != F.col("source.hash")
    want = sorted(merge_upsert(target, source, ["id"], update_when=differs).collect(), key=repr)
    for limit in (0, 100):
        merged = merge_upsert(target, source, ["id"], update_when=differs, compare=["hash"], limit=limit)
        assert sorted(merged.collect(), key=repr) == want
    plan = merge_upsert(target, source, ["id"], update_when=differs, compare=["hash"])._jdf.queryExecution()
    assert not any("text" in x for x in plan.executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x)
    twice = source.unionByName(source.filter("id = 2"))
    with pytest.raises(Exception, match="more than one source row"):
        merge_upsert(target, twice, ["id"], update_when=differs, compare=["hash"]).collect()
    with pytest.raises(ValueError, match="compare goes with"):
        merge_upsert(target, source, ["id"], compare=["hash"])
