import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tributary.errors import ExtractError
from tributary.operators import infer, keys, resolve, shape
from tributary.plans import extract


def profiled(df, **options):
    return infer.collect_profile(infer.profile(df, **options))


# ---- inference ------------------------------------------------------------------------------------------


def test_columns_in_order_of_first_appearance(docs):
    assert profiled(docs({"z": 1, "a": 2}, {"m": 1, "z": 3, "b": 2}, {}, {"c": None})).names == ["z", "a", "m", "b", "c"]


def test_column_union_frame(docs, rows):
    stations = docs({"lat": 48.1, "lon": 11.5}, {}, {"height": 519, "lon": 7.0, "lat": 50.7}, {"closed": None, "height": 60})
    got = rows(infer.column_union(infer.profile(stations)), "position")
    assert [(r["position"], r["column"]) for r in got] == list(enumerate(["lat", "lon", "height", "closed"]))


def test_keys_of_wide_rows_keep_their_order(docs):
    wide = {f"k{(7 * i) % 5003}": i for i in range(5003)}
    assert profiled(docs(wide)).names == list(wide)


def test_rows_are_counted_with_empty_documents(docs):
    assert profiled(docs({}, {"a": 1}, {"b": 1, "a": 1})).n_rows == 3
    assert profiled(docs()).n_rows == 0


@pytest.mark.parametrize(
    "values,first,widen",
    [
        ([True], "boolean", "boolean"), ([1], "integer", "integer"), ([0.0], "numeric", "numeric"), (["1"], "string", "string"),
        ([1, 2.5], "integer", "numeric"), ([2.5, 1], "numeric", "numeric"), ([True, 1], "boolean", "string"),
        ([None, 5], "integer", "integer"), ([None], "string", "string"), ([[], {"a": 1}], "string", "string"),
        ([{"a": 1}, 7], "integer", "string"), (["x", 1], "string", "string"), ([12345678901234567890], "numeric", "numeric"),
        ([1e300], "numeric", "numeric"), ([1, 2.5, "x"], "integer", "string"), ([False, None], "boolean", "boolean"),
    ],
)
def test_types(docs, rows, values, first, widen):
    df = docs(*[{"v": v} for v in values])
    info = profiled(df)["v"]
    assert (info.type("first"), info.type("widen")) == (first, widen)
    for mode, expected in (("first", first), ("widen", widen)):
        assert rows(infer.column_types(infer.profile(df), mode)) == [{"column": "v", "type": expected}]


def test_type_mode_is_checked(docs):
    with pytest.raises(ExtractError):
        profiled(docs({"v": 1}))["v"].type("guess")
    with pytest.raises(ExtractError):
        infer.column_types(infer.profile(docs({"v": 1})), "guess")


def test_late_columns_are_not_lost_and_a_sample_only_bounds_the_schema(docs):
    df = docs(*[{"id": i} for i in range(5)], {"id": 5, "late": "x"})
    assert profiled(df).names == ["id", "late"]
    assert profiled(df, sample=5).names == ["id"]
    table = extract.extract_pages(df, table_name="t", sample=5)["t"].df
    assert table.columns == ["id"] and table.count() == 6


def test_sample_counts_rows_not_ordinals(docs):
    df = docs({"a": 1}, {"b": 1}, {"c": 1}).withColumn("ordinal", F.col("ordinal") * 1_000_000)
    assert profiled(df, sample=2).names == ["a", "b"]


def test_repeated_keys_last_wins(docs):
    df = docs('{"a":1,"b":2,"a":"x"}')
    assert profiled(df).types() == {"a": "string", "b": "integer"}


def test_align(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2)], "b string, c int")
    assert infer.align([left, right]).columns == ["a", "b", "c"]
    assert infer.align([left, right]).count() == 2


def test_profile_is_a_hash_aggregate_of_fixed_width_counters(docs):
    text = infer.profile(docs({"a": 1}))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


# ---- records --------------------------------------------------------------------------------------------


def records(df, **options):
    return extract.extract_records(df, record_type="receipt", **options)


def test_flatten_writes_items_only_and_strips_links(docs, rows):
    df = docs(
        {"id": "1", "links": [{"rel": "self"}], "item": {"links": [], "items": [{"line": 1, "links": [1]}, {"line": 2}], "totalResults": 2}},
        {"id": "2", "item": {"items": []}, "owner": {"id": "4", "refName": "A", "links": []}, "tags": [1, 2], "empty": []},
    )
    table = records(df)["receipt"]
    assert table.df.columns == ["id", "item", "owner", "tags", "empty"]
    first, second = rows(table.df, "id")
    assert json.loads(first["item"]) == [{"line": 1}, {"line": 2}] and first["owner"] is None
    assert second["item"] == "[]" and json.loads(second["owner"]) == {"id": "4", "refName": "A"}
    assert second["tags"] == "[1,2]" and second["empty"] == "[]"


def test_nulls_inside_a_sublist_survive(docs):
    row = records(docs({"id": "1", "item": [{"a": None, "b": 0.0}]}))["receipt"].df.first()
    assert json.loads(row.item) == [{"a": None, "b": 0}]


def test_flatten_types(docs):
    table = records(docs({"mm": 0.25, "snow": True}, {"mm": 3, "gauge": 17, "snow": None}, {"gauge": None, "note": "dry", "mm": 1}))["receipt"]
    assert table.df.dtypes == [("mm", "double"), ("snow", "boolean"), ("gauge", "bigint"), ("note", "string")]
    assert [table.spec.types[c] for c in table.df.columns] == ["numeric", "boolean", "integer", "string"]


def test_first_mode_declares_but_does_not_truncate(docs, rows):
    table = records(docs({"v": 1}, {"v": 2.5}), types="first")["receipt"]
    assert table.spec.types == {"v": "integer"}
    assert [r["v"] for r in rows(table.df, "v")] == ["1", "2.5"]


def test_sublist_counts_as_text_for_the_first_type(docs):
    df = docs({"v": [{"a": 1}]}, {"v": 5})
    assert records(df, types="first")["receipt"].spec.types == {"v": "string"}


def test_fields_keep_selection_order_and_the_key(docs, rows):
    table = records(docs({"id": "1", "b": 2, "a": 1, "c": 3}), fields=["a", "b", "nope"], primary_key=["id"])["receipt"]
    assert table.df.columns == ["a", "b", "id"]


def test_fields_absent_in_the_first_row_come_later(docs):
    assert records(docs({"b": 1}, {"a": 1, "b": 2}), fields=["a", "b"])["receipt"].df.columns == ["b", "a"]


def test_project_on_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.project(df, ["c"], ["a"]).columns == ["c", "a"]
    assert shape.project(df).columns == ["a", "b", "c"]


def test_missing_key_column_is_named(docs):
    with pytest.raises(ExtractError, match="station.*lat.*lon"):
        records(docs({"lat": 1, "lon": 2}), primary_key=["station"])


def test_child_tables(docs, rows):
    df = docs(
        {"id": "10", "number": "A", "item": {"items": [{"line": 1, "qty": 1}, {"line": 2, "memo": "m"}]}, "side notes": [{"key": "k"}]},
        {"id": "11", "number": "B", "item": {"items": []}},
        {"id": "12", "item": {"items": [{"line": 1, "links": [], "qty": 2.5}]}},
    )
    found = records(df, child_tables=True, primary_key=["id"], incremental=True)
    assert set(found) == {"receipt", "receipt_item", "receipt_side_notes"}
    assert found["receipt"].df.columns == ["id", "number"] and found["receipt"].df.count() == 3
    item = found["receipt_item"]
    assert item.df.columns == ["_parent_id", "line", "qty", "memo"]
    assert item.spec.primary_key == ("_parent_id", "line") and item.spec.incremental
    got = rows(item.df, "_parent_id", "line")
    assert [(r["_parent_id"], r["line"], r["qty"], r["memo"]) for r in got] == [("10", 1, 1.0, None), ("10", 2, None, "m"), ("12", 1, 2.5, None)]
    assert found["receipt_side_notes"].spec.primary_key == ("_parent_id", "key")


def test_same_key_may_be_split_or_inline(docs, rows):
    df = docs({"id": "1", "x": [{"line": 1}]}, {"id": "2", "x": {"id": "r"}}, {"id": "3", "x": []}, {"id": "4", "x": "t"})
    found = records(df, child_tables=True)
    assert [r["x"] for r in rows(found["receipt"].df, "id")] == [None, '{"id":"r"}', "[]", "t"]
    assert rows(found["receipt_x"].df) == [{"_parent_id": "1", "line": 1}]


def test_parent_columns_count_inline_sightings_only(docs):
    df = docs({"x": [{"line": 1}], "id": "1"}, {"id": "2", "y": 1, "x": 5})
    assert records(df, child_tables=True)["receipt"].df.columns == ["id", "y", "x"]


def test_fields_split_only_selected_sublists(docs):
    df = docs({"moons": [{"seq": 1}, {"seq": 2}], "rings": {"items": [{"seq": 9}]}, "mass": 5.7, "probes": [{"seq": 3}]})
    found = records(df, child_tables=True, fields=["rings", "mass", "moons"])
    assert {n: (t.df.columns, t.df.count()) for n, t in found.items()} == {
        "receipt": (["mass"], 1), "receipt_rings": (["_parent_id", "seq"], 1), "receipt_moons": (["_parent_id", "seq"], 2),
    }


def test_empty_sublists_give_no_table_and_no_column(docs):
    found = records(docs({"id": "1", "item": {"items": []}}), child_tables=True)
    assert set(found) == {"receipt"} and found["receipt"].df.columns == ["id"]


def test_own_parent_id_wins(docs, rows):
    found = records(docs({"id": "1", "item": [{"_parent_id": "own", "line": 1}, {"line": 2}]}), child_tables=True)
    assert [r["_parent_id"] for r in rows(found["receipt_item"].df, "line")] == ["own", "1"]


def test_parent_ids_have_the_type_of_the_ids(docs, rows):
    found = records(docs({"id": 7, "item": [{"line": 1}]}, {"id": 8, "item": [{"line": 2, "_parent_id": 9}]}), child_tables=True)
    assert dict(found["receipt_item"].df.dtypes)["_parent_id"] == "bigint" and found["receipt_item"].spec.types["_parent_id"] == "integer"
    assert [r["_parent_id"] for r in rows(found["receipt_item"].df, "line")] == [7, 9]
    mixed = records(docs({"id": 7, "item": [{"line": 1, "_parent_id": "x"}]}), child_tables=True)["receipt_item"]
    assert mixed.df.first()["_parent_id"] == "x"


def test_line_order_past_any_number_of_lines(docs):
    lines = [{"line": i % 5100, "seen": i} for i in range(5300)]
    found = records(docs({"id": "1", "item": lines}).withColumn("ordinal", F.lit(1 << 61)), child_tables=True, keep_order=True)["receipt_item"].df
    assert found.select("ordinal").distinct().count() == 5300
    assert found.orderBy(F.desc("ordinal")).first().seen == 5299


def test_typed_texts(spark):
    df = spark.createDataFrame([("1", "01", "1.5", "true", None, "x"), ("-20", "2", "3", "false", None, "1")], "a string, b string, c string, d string, e string, f string")
    assert infer.typed_texts(df).dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "boolean"), ("e", "string"), ("f", "string")]


def test_known_columns_need_no_second_look(docs):
    table = extract.extract_pages(docs({"a": 1, "b": "x"}, {"a": 2, "c": 3}), table_name="t", columns={"a": "integer", "z": "string"})["t"]
    assert table.df.columns == ["a", "z"] and [r.a for r in table.df.orderBy("a").collect()] == [1, 2]


def test_lines_that_are_not_objects_fail(docs):
    found = records(docs({"id": "1", "item": {"items": [{"line": 1}, 2]}}), child_tables=True)
    with pytest.raises(PySparkException, match="not an object"):
        found["receipt_item"].df.collect()


@pytest.mark.parametrize(
    "lines,key",
    [
        ([{"seq": k, "key": f"p{k}", "depth": 3 * k} for k in range(4)], "key"),
        ([{"lineuniquekey": 8, "seq": 0}, {"seq": 1, "lineuniquekey": None}, {"seq": 2}], "seq"),
        ([{"depth": 1.5}, {"depth": 2.5}], None), ([{"id": 1}, {"sequence": 2}, {"id": 3}], None), ([], None),
        ([{"sequence": 4, "line": False}, {"line": 0, "sequence": 4}], "line"),
    ],
)
def test_line_key(docs, lines, key):
    df = docs(*lines)
    assert keys.line_key(profiled(df)) == key
    assert keys.line_key_frame(infer.profile(df)).first().line_key == key


def test_incremental_children_need_a_line_key(docs):
    df = docs({"id": "1", "item": [{"amount": 5.0}]})
    with pytest.raises(ExtractError, match="per-line key"):
        records(df, child_tables=True, primary_key=["id"], incremental=True)
    assert records(df, child_tables=True)["receipt_item"].spec.primary_key == ()


def test_colliding_child_tables(docs):
    with pytest.raises(ExtractError, match="share the table name"):
        records(docs({"a/b": [{"line": 1}], "a_b": [{"line": 1}]}), child_tables=True)


def test_no_records(docs):
    table = records(docs(), primary_key=["id"])["receipt"]
    assert table.df.columns == ["id"] and table.df.count() == 0
    assert records(docs())["receipt"].df.columns == []


def test_preview(spark):
    df = spark.createDataFrame([("x" * 5000,)], "a string")
    sample = shape.preview(df).first().sample
    assert len(sample) == 2000 and sample.startswith('{"a":"xxx')
    with pytest.raises(ExtractError):
        shape.preview(df, 0)


# ---- collection and details -----------------------------------------------------------------------------


@pytest.fixture
def details(spark):
    def build(*pairs):
        df = spark.createDataFrame(list(pairs), "id string, raw string")
        return df.withColumn("landed_at", F.timestamp_seconds(F.monotonically_increasing_id()))

    return build


def test_resolve_details(docs, details, rows):
    collection = docs({"id": "2"}, {"own": 1}, {"id": "1"}).withColumn("id", F.get_json_object("raw", "$.id"))
    got = rows(resolve.resolve_details(collection, details(("1", '{"n":1}'), ("2", '{"n":2}'), ("9", "{}"))), "ordinal")
    assert [r["raw"] for r in got] == ['{"n":2}', '{"own": 1}', '{"n":1}']


def test_missing_detail(docs, details, rows):
    collection = docs({"id": "7"}).withColumn("id", F.get_json_object("raw", "$.id"))
    with pytest.raises(PySparkException, match="no document for record 7"):
        resolve.resolve_details(collection, details(("1", "{}"))).collect()
    (row,) = rows(resolve.resolve_details(collection, details(("1", "{}")), strict=False))
    assert row["raw"] is None and row["error"] == "no document for record 7"


def test_latest_copy_of_a_document_wins(spark, docs, rows):
    collection = docs({"id": "1"}).withColumn("id", F.get_json_object("raw", "$.id"))
    copies = spark.createDataFrame([("1", '{"v":2}', 5), ("1", '{"v":9}', 3)], "id string, raw string, t int")
    copies = copies.withColumn("landed_at", F.timestamp_seconds("t"))
    assert [r["raw"] for r in rows(resolve.resolve_details(collection, copies))] == ['{"v":2}']


def test_rows_without_id_are_spread(spark):
    """A third of the rows without an id must not meet in one partition."""
    collection = spark.range(3000).select(
        F.lit(0).cast("long").alias("page_no"), F.col("id").alias("ordinal"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("id"), F.lit("{}").alias("raw"),
    )
    found = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.lit("{}").alias("raw"), F.current_timestamp().alias("landed_at"))
    previous = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = resolve.resolve_details(collection, found).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in previous.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in sizes) == 3000 and max(r["count"] for r in sizes) < 1000


def test_awkward_sublist_names(docs, rows):
    df = docs({"id": "1", "ordinal": [{"line": 1}], "we`ird.key": {"items": [{"key": "k"}]}, "two words": [{"id": 5}]})
    found = records(df, child_tables=True)
    assert set(found) == {"receipt", "receipt_ordinal", "receipt_we_ird.key", "receipt_two_words"}
    assert rows(found["receipt_we_ird.key"].df) == [{"_parent_id": "1", "key": "k"}]


def test_columns_told_apart_by_case_only(docs):
    with pytest.raises(ExtractError, match="by case only"):
        records(docs({"Id": 1, "id": 2}))


def test_kept_order_columns_may_not_clash(docs):
    with pytest.raises(ExtractError, match="or not at all"):
        records(docs({"id": 1, "ordinal": 2}), keep_order=True)
