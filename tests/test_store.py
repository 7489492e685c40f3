"""The crosswalk store: deltas, compaction, versions that outlive a writer's death, replays."""

import os

import pytest
from pyspark.sql import functions as F

from relink.sinks import store

PAIRS = "entity string, scope string, source_key string, target_key string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), PAIRS)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_small_upsert_of_a_large_slice(spark, tmp_path):
    path = str(tmp_path / "cw")
    big = spark.range(1_000_000).select(F.lit("case").alias("entity"), F.lit("P").alias("scope"), F.col("id").cast("string").alias("source_key"),
                                        (F.col("id") + 5).cast("string").alias("target_key"))
    store.save(big, path)
    before = files(f"{path}/data")
    some = spark.range(999_500, 1_000_500).select(F.lit("case").alias("entity"), F.lit("P").alias("scope"), F.col("id").cast("string").alias("source_key"),
                                                  F.lit("new").alias("target_key"))
    store.upsert(some, path)
    assert len(before) == 1 and before < files(f"{path}/data") and len(files(f"{path}/data") - before) == 1
    got = store.read(spark, path)
    assert got.count() == 1_000_500 and got.where("target_key = 'new'").count() == 1_000 == got.where("cast(source_key as int) >= 999500").count()


def test_files_follow_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "ROWS", 100)
    path = str(tmp_path / "cw")
    df = spark.range(1_000).select(F.lit("e").alias("entity"), F.when(F.col("id") < 950, "big").otherwise("small").alias("scope"),
                                   F.col("id").cast("string").alias("source_key"), F.lit("t").alias("target_key"))
    store.save(df, path)
    made = files(f"{path}/data")
    assert sum("scope=small" in f for f in made) == 1 and 10 <= sum("scope=big" in f for f in made) <= 20
    assert content(store.read(spark, path)) == content(df.select("entity", "scope", "source_key", "target_key"))


def test_first_write_of_every_kind(spark, tmp_path):
    a = rows(spark, ("e", "P", "1", "x"), ("e", None, "1", "y"), ("e", "", "2", "z"), ("e", "P", None, "no"), ("e", "P", "3", None))
    want = [("e", None, "1", "y"), ("e", None, "2", "z"), ("e", "P", "1", "x")]
    for name, write in (("s", lambda p: store.save(a, p)), ("u", lambda p: store.upsert(a, p))):
        path = str(tmp_path / name)
        assert store.read(spark, path).count() == 0
        write(path)
        assert content(store.read(spark, path)) == sorted(want, key=str)
    store.replace_scope(a, str(tmp_path / "r"), "P")
    assert content(store.read(spark, str(tmp_path / "r"))) == [("e", "P", "1", "x")]
    store.save(a.limit(0), str(tmp_path / "none"))
    assert store.read(spark, str(tmp_path / "none")).count() == 0
    store.upsert(a, str(tmp_path / "none"))
    assert content(store.read(spark, str(tmp_path / "none"))) == sorted(want, key=str)


def test_slices_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "cw")
    store.save(rows(spark, ("case", "P", "1", "a"), ("case", "Q", "1", "b"), ("plan", "P", "1", "c"), ("case", None, "1", "d")), path)
    store.save(rows(spark, ("case", "P", "2", "e")), path)
    assert content(store.read(spark, path)) == sorted([("case", "P", "2", "e"), ("case", "Q", "1", "b"), ("plan", "P", "1", "c"), ("case", None, "1", "d")], key=str)
    store.replace_scope(rows(spark, ("run", "P", "7", "f"), ("run", "Q", "7", "no")), path, "P")
    assert content(store.read(spark, path)) == sorted([("run", "P", "7", "f"), ("case", "Q", "1", "b"), ("case", None, "1", "d")], key=str)
    store.replace_scope(rows(spark), path, "P")
    assert content(store.read(spark, path)) == sorted([("case", "Q", "1", "b"), ("case", None, "1", "d")], key=str)
    store.save(rows(spark, ("x", "X", "1", "g")), path, whole=True)
    assert content(store.read(spark, path)) == [("x", "X", "1", "g")]


def test_a_dead_writer_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cw")
    store.save(rows(spark, ("e", "P", "1", "old")), path)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(store, "_publish", dies)
        for write in (lambda: store.upsert(rows(spark, ("e", "P", "1", "new")), path), lambda: store.save(rows(spark, ("e", "P", "1", "new")), path)):
            with pytest.raises(RuntimeError):
                write()
    assert content(store.read(spark, path)) == [("e", "P", "1", "old")]
    os.makedirs(f"{path}/manifest/00000009")  # begun, never completed
    assert content(store.read(spark, path)) == [("e", "P", "1", "old")] and store.versions(spark, path) == [1]
    store.upsert(rows(spark, ("e", "P", "2", "next")), path)
    assert content(store.read(spark, path)) == [("e", "P", "1", "old"), ("e", "P", "2", "next")]
    gone = store.vacuum(spark, path, keep=1)
    assert 2 in gone and 3 in gone and content(store.read(spark, path)) == [("e", "P", "1", "old"), ("e", "P", "2", "next")]


def test_stored_order_settles_late_pairs(spark, tmp_path):
    path = str(tmp_path / "cw")
    kind = PAIRS + ", at long"
    store.upsert(spark.createDataFrame([("e", "P", "1", "b", 5), ("e", "P", "1", "a", 3)], kind), path, ["at"])
    store.upsert(spark.createDataFrame([("e", "P", "1", "late", 4), ("e", "P", "2", "c", 1)], kind), path, ["at"], tag=("s", 7))
    store.upsert(spark.createDataFrame([("e", "P", "1", "again", 9)], kind), path, ["at"], tag=("s", 7))  # replayed: its number was there
    assert content(store.read(spark, path)) == [("e", "P", "1", "b"), ("e", "P", "2", "c")]
    store.upsert(spark.createDataFrame([("e", "P", "1", "later", 6)], kind), path, ["at"], tag=("s", 8))
    store.upsert(rows(spark, ("e", "P", "1", "without order"), ("e", "P", "3", "d")), path)
    assert content(store.read(spark, path, keep=True)) == [("e", "P", "1", "later", 6), ("e", "P", "2", "c", 1), ("e", "P", "3", "d", None)]


def test_only_grown_slices_are_rewritten(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "DELTAS", 3)
    path = str(tmp_path / "cw")
    store.save(rows(spark, *[("e", s, str(i), "0") for s in "PQ" for i in range(100)]), path)
    base = {f for f in files(f"{path}/data") if "scope=Q" in f}
    for n in range(1, 6):
        store.upsert(rows(spark, *[("e", "P", str(i), str(n)) for i in range(n, n + 3)]), path)
    live = store.manifest(spark, path).where("kind = 'delta'")
    assert {(r.entity, r.scope) for r in live.collect()} == {("e", "P")} and live.count() == 2  # three were folded, two came later
    now = {r.source_key: r.target_key for r in store.read(spark, path).where("scope = 'P'").collect()}
    assert len(now) == 100 and [now[str(i)] for i in range(1, 8)] == ["1", "2", "3", "4", "5", "5", "5"]
    store.upsert(rows(spark, *[("e", "P", str(i), "half") for i in range(60)]), path)  # more than half of the base: rewritten
    assert store.manifest(spark, path).where("kind = 'delta'").isEmpty()
    assert base <= files(f"{path}/data")
    store.vacuum(spark, path, keep=1)
    assert base <= files(f"{path}/data") and len({f.split("v=")[1].split("/")[0] for f in files(f"{path}/data")}) == 2
    assert store.read(spark, path).where("target_key = 'half'").count() == 60 and store.read(spark, path).count() == 200
