"""Versioned tables: crashes at every step, conflicts, old layouts; copies; fingerprints."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from portolan.sources import CommitConflict, VersionedTable, fingerprint, read_table, refreshed_copy, versions
from portolan.sources.folders import partition_folders

MONTHS = "y int, m int, v string"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def put(table, df, mode="replace", by=(), **facts):
    staged = table.stage()
    df.write.partitionBy(*by).parquet(staged) if by else df.write.parquet(staged)
    return table.commit(staged, mode, **facts)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "deep" / "t"))


def test_replace_append_and_partitions(spark, table):
    assert table.manifest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    put(table, spark.range(3), note="x")
    assert table.manifest().facts == {"note": "x"} and table.read().count() == 3
    put(table, spark.range(5), "append")
    assert table.read().count() == 8
    put(table, spark.range(2))
    assert table.read().count() == 2 and table.read(at_most=2).count() == 8


def test_partitions_are_replaced_together(spark, table):
    months = [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]
    put(table, spark.createDataFrame(months, MONTHS), by=("y", "m"))
    put(table, spark.createDataFrame([(1, 2, "B"), (3, 1, "d")], MONTHS), "replace_present", ("y", "m"))
    assert rows(table.read(), "y", "m", "v") == [(1, 1, "a"), (1, 2, "B"), (2, 1, "c"), (3, 1, "d")]
    assert rows(table.read(only=["y=1/m=2"]), "v") == [("B",)]
    filtered = table.read().filter("y = 1 AND m = 2")
    assert rows(filtered, "v") == [("B",)]
    put(table, spark.createDataFrame([(9, 9, "z")], MONTHS), "replace", ("y", "m"))
    assert rows(table.read(), "v") == [("z",)]


STEPS = ("partition_folders", "create_text", "names", "read_text", "remove_folder")


@pytest.mark.parametrize("mode", ["replace", "replace_present", "append"])
def test_killed_at_every_step(spark, tmp_path, monkeypatch, mode):
    """Whatever call to the store a commit dies at, readers have the old rows or the new
    ones, and the next commit goes through and clears what was left."""
    by, old, late = ("y", "m"), [(1, 1, "old"), (1, 2, "old")], [(1, 2, "late")]
    new = {"replace": late, "replace_present": [old[0], *late], "append": [*old, *late]}[mode]
    outcomes, step, killed = [], 0, True
    while killed and step < 60:
        table = VersionedTable(spark, str(tmp_path / f"t{step}"))
        for _ in range(3):
            put(table, spark.createDataFrame(old, MONTHS).coalesce(1), by=by)
        staged, calls, killed = table.stage(), 0, False
        spark.createDataFrame(late, MONTHS).coalesce(1).write.partitionBy(*by).parquet(staged)
        for name in STEPS:
            real = getattr(versions.folders, name)

            def call(*a, real=real, name=name):
                nonlocal calls, killed
                calls += 1
                if calls > step:
                    killed = True
                    if name == "create_text":  # cut short in the middle of the file
                        real(a[0], a[1], a[2][: len(a[2]) // 2])
                    raise KeyboardInterrupt(f"killed at {name}")
                return real(*a)

            monkeypatch.setattr(versions.folders, name, call)
        try:
            table.commit(staged, mode)
        except KeyboardInterrupt:
            pass
        monkeypatch.undo()
        after = rows(VersionedTable(spark, table.path).read(), *by, "v")
        assert after in (old, sorted(new, key=repr))
        outcomes.append(after == old)
        step += 1
    assert not killed and step > 6 and outcomes == sorted(outcomes, reverse=True) and len(set(outcomes)) == 2
    # The last table was not killed; of one that was, two commits later nothing is left over.
    table = VersionedTable(spark, str(tmp_path / f"t{outcomes.index(False)}"))
    for _ in range(2):
        put(table, spark.createDataFrame(old, MONTHS), by=by)
    assert rows(table.read(), *by, "v") == old
    kept = {v for n in (None, table.manifest().number - 1) for _, v in table.manifest(n).parts}
    assert {n for n in os.listdir(table.path) if n.startswith("v")} == kept
    assert len([n for n in os.listdir(f"{table.path}/_manifests") if n.endswith(".json")]) == 2


def test_of_two_writers_one_fails(spark, table):
    put(table, spark.range(1))
    first, second = table.stage(), table.stage()
    spark.range(2).write.parquet(first)
    spark.range(3).write.parquet(second)
    table.commit(second)
    with pytest.raises(CommitConflict):
        table.commit(first)
    assert table.read().count() == 3
    with pytest.raises(ValueError):
        table.commit(first, "merge")


def test_plain_folders_are_read_and_taken_over(spark, tmp_path):
    plain = str(tmp_path / "plain")
    spark.range(4).write.parquet(plain)
    assert read_table(spark, plain).count() == 4
    put(VersionedTable(spark, plain), spark.range(6), "append")
    assert read_table(spark, plain).count() == 10
    put(VersionedTable(spark, plain), spark.range(7))
    put(VersionedTable(spark, plain), spark.range(8))
    assert read_table(spark, plain).count() == 8
    assert not [n for n in os.listdir(plain) if n.startswith("part-")]

    months = str(tmp_path / "months")
    spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], MONTHS).write.partitionBy("y", "m").parquet(months)
    assert partition_folders(spark, months) == ["y=1/m=1", "y=1/m=2"]
    put(VersionedTable(spark, months), spark.createDataFrame([(1, 2, "B")], MONTHS), "replace_present", ("y", "m"))
    assert rows(read_table(spark, months), "y", "m", "v") == [(1, 1, "a"), (1, 2, "B")]


def test_manifests_say_what_is_there(spark, table):
    put(table, spark.range(1), made_by="me")
    with open(f"{table.path}/_manifests/000000000001.json") as f:
        held = json.load(f)
    assert held["facts"] == {"made_by": "me"} and held["parts"] == [["", os.path.basename(next(iter(dict(held["parts"]).values())))]]


def test_copies_follow_their_source(spark, tmp_path):
    source, copy = str(tmp_path / "s.csv"), str(tmp_path / "copy")
    (tmp_path / "s.csv").write_text("a,b\n1,x\n2,y\n")

    def read():
        return spark.read.csv(source, header=True)

    def number():
        return VersionedTable(spark, copy).manifest().number

    def typed(df):
        return df.withColumn("a", F.col("a").cast("int"))

    assert rows(refreshed_copy(spark, copy, read(), typed)) == [(1, "x"), (2, "y")]
    assert number() == 1
    assert rows(refreshed_copy(spark, copy, read(), typed)) == [(1, "x"), (2, "y")] and number() == 1
    (tmp_path / "s.csv").write_text("a,b\n1,x\n2,y\n3,z\n")
    assert rows(refreshed_copy(spark, copy, read(), typed)) == [(1, "x"), (2, "y"), (3, "z")] and number() == 2
    os.utime(source, ns=(1, 1))
    refreshed_copy(spark, copy, read(), typed)
    assert number() == 3
    assert dict(refreshed_copy(spark, copy, read()).dtypes)["a"] == "string" and number() == 4


def test_fingerprints(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    once = fingerprint([df], ("x", 1))
    assert once == fingerprint([spark.read.parquet(path)], ("x", 1))
    assert once != fingerprint([df], ("x", 2)) and once != fingerprint([df.filter("id > 1")], ("x", 1))
    memory = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    same = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    other = spark.createDataFrame([(2, "b"), (1, "c")], "k int, v string")
    assert fingerprint([memory]) == fingerprint([same]) != fingerprint([other])
