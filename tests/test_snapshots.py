"""Snapshots: what readers see while, after and instead of a publish."""

import pytest
from pyspark.sql import functions as F

from stockflow.sources.snapshots import SnapshotConflict, Store, partition_of

SCHEMA = "id bigint, place string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def writer(df):
    return lambda path: df.write.partitionBy("place").parquet(path)


def seen(store, **choice):
    return sorted(map(tuple, store.read("t", SCHEMA, ["place"], **choice).collect()))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def published(store, rows, as_of=None):
    draft = store.draft()
    draft.replace("t", writer(table(store.spark, rows)))
    return draft.commit(as_of)


def test_readers_see_whole_snapshots_only(store, spark):
    with pytest.raises(LookupError):
        store.latest()
    published(store, [(1, "a"), (2, "b")], "2026-08-01")
    draft = store.draft()
    draft.replace("t", writer(table(spark, [(3, "c")])))
    assert seen(store) == [(1, "a"), (2, "b")]
    draft.commit("2026-08-02")
    assert seen(store) == [(3, "c")]
    assert seen(store, snapshot=store.latest("2026-08-01")) == [(1, "a"), (2, "b")]
    with pytest.raises(LookupError):
        store.latest("2026-08-03")


def test_a_publish_that_dies_halfway_changes_nothing(store, spark):
    published(store, [(1, "a")])
    draft = store.draft()
    draft.replace("t", writer(table(spark, [(2, "a")])))

    def dies(path):
        broken = table(spark, [(k, "abc"[k % 3]) for k in range(100)]).repartition(5)
        check = F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
        writer(broken.withColumn("id", check.cast("bigint")))(path)

    with pytest.raises(Exception, match="lost"):
        draft.replace("u", dies)
    assert seen(store) == [(1, "a")] and len(store.history()) == 1
    assert published(store, [(5, "z")]).number == 2
    assert seen(store) == [(5, "z")]


def test_replaced_partitions_share_the_others(store, spark):
    published(store, [(1, "a"), (2, "b"), (3, "c d/e")])
    first = store.latest()
    draft = store.draft(first)
    draft.replace_where("t", writer(table(spark, [(7, "b"), (8, "new")])))
    second = draft.commit()
    assert seen(store) == [(1, "a"), (3, "c d/e"), (7, "b"), (8, "new")]
    kept = [f for f in second.tables["t"] if f.startswith(first.tables["t"][0])]
    assert sorted(partition_of(f)["place"] for f in kept) == ["a", "c d/e"]
    assert seen(store, snapshot=first) == [(1, "a"), (2, "b"), (3, "c d/e")]


def test_scope_leaves_no_stale_partition(store, spark):
    published(store, [(1, "a"), (2, "b")])
    draft = store.draft(store.latest())
    draft.replace_where("t", writer(table(spark, [])), lambda p: p["place"] == "b")
    draft.commit()
    assert seen(store) == [(1, "a")]
    draft = store.draft(store.latest())
    draft.replace_where("t", writer(table(spark, [])), lambda p: True)
    draft.commit()
    assert seen(store) == []
    with pytest.raises(ValueError, match="outside"):
        store.draft(store.latest()).replace_where("t", writer(table(spark, [(4, "a")])), lambda p: p["place"] == "b")


def test_folders_are_left_out_by_partition(store, spark):
    published(store, [(k, "abcd"[k % 4]) for k in range(20)])
    rows = store.read("t", SCHEMA, ["place"], where=lambda p: p["place"] in "bd")
    assert {partition_of(f)["place"] for f in rows.inputFiles()} == {"b", "d"}
    assert sorted(r.id for r in rows.collect()) == [k for k in range(20) if k % 2]
    assert store.read("t", SCHEMA, ["place"], where=lambda p: False).collect() == []


def test_appended_rows(store, spark):
    published(store, [(1, "a")])
    draft = store.draft(store.latest())
    draft.append("t", writer(table(spark, [(2, "a")])))
    draft.append("t", writer(table(spark, [])))
    draft.commit()
    assert seen(store) == [(1, "a"), (2, "a")]


def test_of_two_that_follow_the_same_snapshot_one_wins(store, spark):
    published(store, [(1, "a")])
    parent = store.latest()
    drafts = [store.draft(parent) for _ in range(2)]
    for k, draft in enumerate(drafts):
        draft.replace_where("t", writer(table(spark, [(10 + k, "a")])))
    drafts[1].commit()
    with pytest.raises(SnapshotConflict):
        drafts[0].commit()
    assert seen(store) == [(11, "a")]
    whole = [store.draft() for _ in range(2)]
    for k, draft in enumerate(whole):
        draft.replace("t", writer(table(spark, [(20 + k, "a")])))
    assert [d.commit().number for d in whole] == [3, 4]


def test_expired_snapshots_take_only_their_own_folders(store, spark):
    published(store, [(1, "a"), (2, "b")])
    first = store.latest()
    draft = store.draft(first)
    draft.replace_where("t", writer(table(spark, [(3, "b")])))
    second = draft.commit()
    with pytest.raises(ValueError):
        store.expire(0)
    gone = store.expire(1)
    assert [partition_of(f) for f in gone] == [{"place": "b"}] and gone[0].startswith(first.tables["t"][0])
    assert [s.number for s in store.history()] == [second.number]
    assert seen(store) == [(1, "a"), (3, "b")]
    assert store.expire(1) == []
    published(store, [(9, "z")])
    store.expire(1)
    assert seen(store) == [(9, "z")]
