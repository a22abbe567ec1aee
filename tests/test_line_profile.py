"""Profiles of lines: cheap tests of what a value is, and ordinals no wider than they need be."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.functions.jsontext import is_array, is_sublist
from tributary.operators.infer import collect_profile, profile
from tributary.operators.shape import child_documents, narrow_ordinals, sublist_items

VALUES = {
    '{"items":[]}': True, '{"items":[1,"a",null,{}]}': True, '{"items":{}}': False, '{"items":null}': False, "{}": False,
    '[{"a":1},{}]': True, '[{"a":1},null]': False, '[{"a":1},2]': False, "[[1]]": False, "[]": False, "[null]": False,
    '"[{}]"': False, "1": False, "null": False, "true": False,
}


def test_values_are_told_apart(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES] + [(None,)], "raw string").withColumn("doc", F.parse_json("raw"))
    found = {r[0]: (r[1], r[2]) for r in rows.select("raw", is_sublist(F.col("doc")), is_array(F.col("doc"))).collect()}
    assert {v: found[v][0] for v in VALUES} == VALUES
    assert {v for v, (_, array) in found.items() if array} == {v for v in VALUES if v.startswith("[")}
    assert found[None] == (False, False)


def documents(spark, ordinals):
    raw = [(o, json.dumps({"id": str(o), "a": {"items": [{"x": 1, "y": k} for k in range(3)]}, "b": [{"z": True}]})) for o in ordinals]
    return spark.createDataFrame(raw, "ordinal bigint, raw string").withColumn("doc", F.parse_json("raw"))


@pytest.mark.parametrize(("top", "kind"), [(7, "bigint"), ((1 << 31) - 1, "bigint"), (1 << 31, "decimal(38,0)"), ((1 << 62) + 1, "decimal(38,0)")])
def test_ordinals_of_lines_are_as_wide_as_needed(spark, top, kind):
    items = sublist_items(documents(spark, [3, top]), ["a", "b"])
    wide = child_documents(items, 0)
    narrow = narrow_ordinals(items, wide)
    assert dict(narrow.dtypes)["ordinal"] == kind and dict(wide.dtypes)["ordinal"] == "decimal(38,0)"
    assert sorted(int(r[0]) for r in narrow.select("ordinal").collect()) == sorted(int(r[0]) for r in wide.select("ordinal").collect())
    assert collect_profile(profile(narrow)) == collect_profile(profile(wide))


def test_no_rows_and_null_ordinals(spark):
    for rows in ([], [(None, '{"a":{"items":[{"x":1}]}}')]):
        docs = spark.createDataFrame(rows, "ordinal bigint, raw string").withColumn("doc", F.parse_json("raw"))
        items = sublist_items(docs, ["a"])
        assert narrow_ordinals(items, child_documents(items, 0)).count() == len(rows)


def test_containers_are_not_asked_for_their_schema(spark):
    plan = profile(documents(spark, [1]))._jdf.queryExecution().optimizedPlan().toString()
    assert "forall" not in plan and "ELSE static_invoke(SchemaOfVariant" in plan
