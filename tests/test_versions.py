"""Versioned upserts: re-runs, refusals, writers that die or collide, compaction beside a load."""

import pytest

from decisionkit.sources.versions import Conflict, VersionedTable

SCHEMA = "id long, day string, label int"


@pytest.fixture()
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "labels"), "id", ["day", "label"])


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upserts_reruns_and_compaction(spark, table):
    first = spark.createDataFrame([(1, "a", 0), (2, "a", 1), (None, "b", 1)], SCHEMA)
    second = spark.createDataFrame([(2, "a", None), (3, "c", 1), (3, "c", 0)], SCHEMA)
    assert table.read() is None and table.compact() == 0
    assert table.upsert(first, "one") == 1
    assert table.upsert(second, "two") == 2
    assert table.upsert(first.repartition(3), "one") == 2  # the same rows again: nothing new
    with pytest.raises(PermissionError):
        table.upsert(second, "one")
    new = {(1, "a", 0), (2, "a", None), (3, "c", 1), (None, "b", 1)}
    assert set(map(tuple, table.read().collect())) == new
    assert table.compact() == 3 and table.compact() == 3
    assert set(map(tuple, table.read().collect())) == new and len(table.manifest(3)[0]) == 1
    assert set(map(tuple, table.read(1).collect())) == {(1, "a", 0), (2, "a", 1), (None, "b", 1)}
    assert table.upsert(second, "two") == 3  # known after compaction too
    assert table.upsert(spark.createDataFrame([], SCHEMA), "none") == 4
    assert set(map(tuple, table.read().collect())) == new
    assert table.expire(2) == [1, 2] and table.versions() == [3, 4]
    assert set(map(tuple, table.read().collect())) == new


def test_a_writer_that_dies_leaves_the_old_version(spark, table, monkeypatch):
    table.upsert(spark.createDataFrame([(1, "a", 0)], SCHEMA), "one")
    with monkeypatch.context() as m:
        m.setattr(table, "_switch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), "two")
    assert table.latest() == 1 and rows_of(table.read()) == [(1, "a", 0)]
    assert table.upsert(spark.createDataFrame([(1, "a", 1)], SCHEMA), "two") == 2
    assert rows_of(table.read()) == [(1, "a", 1)]


def test_colliding_writers_both_get_in(spark, table, monkeypatch):
    other = VersionedTable(spark, table.root, "id", ["day", "label"])
    switch, met = table._switch, []

    def late(version, parts, loads):
        if not met:
            met.append(other.upsert(spark.createDataFrame([(2, "b", 1)], SCHEMA), "other"))
        return switch(version, parts, loads)

    monkeypatch.setattr(table, "_switch", late)
    assert table.upsert(spark.createDataFrame([(1, "a", 0)], SCHEMA), "mine") == 2
    assert rows_of(table.read()) == [(1, "a", 0), (2, "b", 1)]
    with pytest.raises(Conflict):
        switch(2, [], [])
    met.clear()

    def during(version, parts, loads):
        if not met:
            met.append(other.upsert(spark.createDataFrame([(1, "z", 5)], SCHEMA), "third"))
        return switch(version, parts, loads)

    monkeypatch.setattr(table, "_switch", during)
    assert table.compact() == 4  # the load that came meanwhile stays newest
    assert rows_of(table.read()) == [(1, "z", 5), (2, "b", 1)]
