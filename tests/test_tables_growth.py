"""Tables that grow by new keys: what a load writes."""

import os

from tributary.sinks import tables
from tributary.spec import TableSpec

SPEC = TableSpec("t", ("id",), True)


def _load(spark, path, *rows):
    df = spark.createDataFrame(rows, "id string, v int")
    return tables.write_upsert(df, path, SPEC, parts=2, order=())


def _seen(spark, path):
    return sorted((tuple(r) for r in tables.read_table(spark, path).collect()), key=str)


def test_new_keys_leave_the_base_as_it_is(spark, tmp_path):
    path = str(tmp_path / "t")
    first = _load(spark, path, ("a", 1), ("b", 1), (None, 1))
    second = _load(spark, path, ("c", 2), ("d", 2), ("e", 2))
    assert second["deltas"] == [] and second["base_rows"] == 6
    before = {f for p in first["parts"] for f in tables._part_folders(first["parts"], p)}
    after = {f for p in second["parts"] for f in tables._part_folders(second["parts"], p)}
    assert before < after
    written = sum(spark.read.parquet(f"{path}/{f}").count() for f in after - before)
    assert written == 3
    assert _seen(spark, path) == [("a", 1), ("b", 1), ("c", 2), ("d", 2), ("e", 2), (None, 1)]


def test_known_and_null_keys_still_replace_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    _load(spark, path, ("a", 1), (None, 1))
    _load(spark, path, ("b", 2))
    _load(spark, path, (None, 3), ("c", 3))
    third = _load(spark, path, ("b", 4), ("d", 4))
    assert _seen(spark, path) == [("a", 1), ("b", 4), ("c", 3), ("d", 4), (None, 3)]
    assert sum(tables.read_table(spark, path, [p]).count() for p in (0, 1)) == 5
    assert third["base_rows"] == 5 or third["deltas"]
    assert tables.expire_versions(spark, path, keep=1) is not None
    assert _seen(spark, path) == [("a", 1), ("b", 4), ("c", 3), ("d", 4), (None, 3)] and os.path.isdir(path)


def test_a_new_column_writes_the_base_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    _load(spark, path, ("a", 1))
    wider = spark.createDataFrame([("b", 2, "x")], "id string, v int, w string")
    done = tables.write_upsert(wider, path, SPEC, parts=2, order=())
    assert all(isinstance(f, str) for f in done["parts"].values())
    assert _seen(spark, path) == [("a", 1, None), ("b", 2, "x")]
