from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from tributary.errors import ExtractError
from tributary.operators import pagesets, predicates
from tributary.plans import extract, sqlmode

# ---- page sets ------------------------------------------------------------------------------------------

PAGES = "page_set string, page_offset long, page_count long, has_more boolean, total long, next_href string, items array<string>"


@pytest.fixture
def page_set(spark):
    def build(*offsets, size=2, total=8, name="p"):
        data = []
        for o in offsets:
            more = o + size < total
            items = [str(i) for i in range(o, min(o + size, total))]
            data.append((name, o, len(items), more, total, f"https://h/x?limit={size}&offset={o + size}" if more else None, items))
        return spark.createDataFrame(data, PAGES)

    return build


def problems(df):
    return {(r.page_offset, r.problem) for r in df.collect()}


def test_whole_page_set_has_no_gaps(page_set):
    df = page_set(0, 2, 4, 6)
    assert problems(pagesets.link_gaps(df)) == set() == problems(pagesets.offset_gaps(df, 2))


def test_gaps_repeats_and_the_missing_end(page_set):
    df = page_set(0, 4, 4)
    expected = {(0, "missing_next"), (4, "unreferenced"), (4, "repeated"), (4, "missing_next")}
    assert problems(pagesets.link_gaps(df)) == expected == problems(pagesets.offset_gaps(df, 2))


def test_missing_first_page(page_set):
    assert problems(pagesets.link_gaps(page_set(2, 4, 6))) == {(2, "unreferenced")}


def test_offsets_step_by_the_capped_page_size(page_set):
    df = page_set(0, 1000, size=1000, total=2000)
    assert problems(pagesets.offset_gaps(df, 5000)) == set()


def test_completeness(page_set):
    row = pagesets.page_completeness(page_set(0, 4, 4), 2).first()
    assert row.asDict() == {
        "page_set": "p", "rows_expected": 8, "rows_seen": 4, "pages_seen": 2, "pages_repeated": 1, "rows_missing": 4, "pages_expected": 4,
    }


def test_completeness_shuffles_counts_not_items(page_set):
    text = pagesets.page_completeness(page_set(0))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(size(items" in text


@pytest.mark.parametrize("total,limit,pages", [(14, 2, 7), (0, 10, 0), (2500, 5000, 3), (1000, 1000, 1)])
def test_expected_pages(spark, total, limit, pages):
    assert spark.createDataFrame([(total,)], "t long").select(pagesets.expected_pages("t", limit)).first()[0] == pages


def test_search_completeness(spark):
    info = spark.createDataFrame([("a", 1, 3), ("a", 3, 3), ("a", 3, 3), (None, 1, 5)], "search_id string, page_index long, total_pages long")
    got = {r.search_id: (r.pages_expected, r.pages_seen, r.pages_missing) for r in pagesets.search_completeness(info).collect()}
    assert got == {"a": (3, 2, 1), None: (1, 1, 0)}


def test_sublist_completeness(docs):
    df = docs(
        {"id": "1", "item": {"items": [{}], "totalResults": 1}}, {"id": "2", "item": {"items": [{}], "totalResults": 3}},
        {"id": "3", "item": {"items": [{}], "hasMore": True}}, {"id": "4"},
    )
    got = {r.id: (r.items_seen, r.items_expected, r.complete) for r in pagesets.sublist_completeness(df, "item").collect()}
    assert got == {"1": (1, 1, True), "2": (1, 3, False), "3": (1, None, False), "4": (0, None, True)}


def test_cursor_chain(spark):
    data = [
        (0, None, '{"meta":{"next":"c1"}}'), (1, "c1", '{"meta":{"next":"c2"}}'), (2, "c2", '{"meta":{"next":"c1"}}'),
        (3, "x", '{"meta":{"next":"lost"}}'), (4, "y", '{"meta":{"next":""}}'), (5, "z", "{}"),
    ]
    df = spark.createDataFrame(data, "page_no long, cursor_in string, body string").withColumn("doc", F.parse_json("body"))
    got = {r.page_no: (r.next_page, r.status) for r in pagesets.cursor_chain(pagesets.with_cursor(df, "meta.next")).collect()}
    assert got == {0: (1, "followed"), 1: (2, "followed"), 2: (1, "repeat"), 3: (None, "missing"), 4: (None, "last"), 5: (None, "last")}


# ---- predicates -----------------------------------------------------------------------------------------


@pytest.fixture
def people(spark):
    data = [
        (1, "Birch Inc", 10, 1.5, "100", date(2024, 5, 15), datetime(2024, 5, 15, 23, 0), True, ["a", "b"]),
        (2, "cedar", 20, 2.5, "x", date(2024, 5, 16), datetime(2024, 5, 16, 0, 0), False, ["c"]),
        (3, "", 30, 3.5, "7.5", date(2024, 4, 1), datetime(2024, 4, 1, 1, 0), None, []),
        (4, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(
        data, "id int, name string, n long, d double, t string, day date, at timestamp_ntz, flag boolean, tags array<string>"
    )


def ids(df):
    return {r.id for r in df.collect()}


@pytest.mark.parametrize(
    "field,op,value,value2,expected",
    [
        ("name", "is", "Birch inc", None, {1}), ("name", "isNot", "birch inc", None, {2, 3}), ("name", "contains", "RC", None, {1}),
        ("name", "doesNotContain", "rc", None, {2, 3}), ("name", "startsWith", "CED", None, {2}), ("name", "doesNotStartWith", "ced", None, {1, 3}),
        ("name", "empty", None, None, {3, 4}), ("name", "notEmpty", None, None, {1, 2}), ("name", "hasKeywords", "inc birch", None, {1}),
        ("name", "hasKeywords", "inc cedar", None, set()), ("n", "equalTo", 10, None, {1}), ("n", "notEqualTo", 10, None, {2, 3}),
        ("n", "lessThan", 20, None, {1}), ("n", "notLessThan", 20, None, {2, 3}), ("n", "greaterThan", 20, None, {3}),
        ("n", "notGreaterThan", 20, None, {1, 2}), ("n", "lessThanOrEqualTo", 20, None, {1, 2}), ("n", "greaterThanOrEqualTo", 20, None, {2, 3}),
        ("n", "notLessThanOrEqualTo", 20, None, {3}), ("n", "notGreaterThanOrEqualTo", 20, None, {1}), ("n", "between", 10, 20, {1, 2}),
        ("n", "BETWEEN", [10, 20], None, {1, 2}), ("n", "notBetween", 10, 20, {3}), ("n", "empty", None, None, {4}), ("n", "notEmpty", None, None, {1, 2, 3}),
        ("n", "greaterThan", 19.5, None, {2, 3}), ("d", "between", 1.5, 2.5, {1, 2}), ("d", "greaterThan", 2, None, {2, 3}),
        ("day", "on", "2024-05-15", None, {1}), ("at", "on", date(2024, 5, 15), None, {1}), ("at", "notOn", "2024-05-15", None, {2, 3}),
        ("at", "before", "2024-05-15", None, {3}), ("at", "after", "2024-05-15", None, {2}), ("at", "onOrBefore", "2024-05-15", None, {1, 3}),
        ("at", "ON_OR_AFTER", "2024-05-15", None, {1, 2}), ("at", "within", "2024-05-15", "2024-05-16", {1, 2}), ("at", "notWithin", "2024-05-15", "2024-05-16", {3}),
        ("at", "notBefore", "2024-05-16", None, {2}), ("at", "notAfter", "2024-05-15", None, {1, 3}), ("at", "empty", None, None, {4}),
        ("flag", "is", True, None, {1}), ("flag", "is", False, None, {2}), ("tags", "anyOf", ["b", "z"], None, {1}),
        ("tags", "noneOf", ["b"], None, {2, 3}), ("n", "anyOf", [10, 30], None, {1, 3}), ("n", "noneOf", [10], None, {2, 3}),
    ],
)
def test_operators(people, field, op, value, value2, expected):
    assert ids(predicates.search_filter(people, field, op, value, value2)) == expected


def test_text_numbers(people):
    assert ids(predicates.search_filter(people, "t", "greaterThan", 7, kind="text_number")) == {1, 3}
    assert ids(predicates.search_filter(people, "t", "notBetween", 50, 200, kind="text_number")) == {3}


def test_relative_periods(people):
    options = {"as_of": date(2024, 5, 16)}
    assert ids(predicates.search_filter(people, "at", "on", "yesterday", **options)) == {1}
    assert ids(predicates.search_filter(people, "day", "within", "lastMonth", **options)) == {3}
    assert ids(predicates.search_filter(people, "at", "onOrAfter", "thisMonth", **options)) == {1, 2}


def test_wrong_operators(people):
    for field, op, value in (("name", "greaterThan", 1), ("n", "contains", "x"), ("at", "on", "someday"), ("n", "equalTo", None), ("name", "hasKeywords", " ")):
        with pytest.raises(ExtractError):
            predicates.search_filter(people, field, op, value)
    with pytest.raises(ExtractError):
        predicates.search_filter(people, "n", "between", 1)
    with pytest.raises(ExtractError, match="unknown field kind"):
        predicates.search_filter(people, "n", "equalTo", 1, kind="other")


def test_every_named_operator_is_built(people):
    fields = {"string": "name", "long": "n", "double": "d", "text_number": "t", "date": "at", "select": "tags", "boolean": "flag"}
    values = {"string": "a", "date": "2024-05-15", "select": ["a"], "boolean": True}
    for kind, operators in predicates.OPERATORS.items():
        for op in operators:
            predicates.search_filter(people, fields[kind], op, values.get(kind, 1), values.get(kind, 1), kind=kind).collect()


def test_date_and_number_filters_reach_the_scan(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    for field, op, value in (("at", "on", "2024-05-15"), ("day", "before", "2024-05-15"), ("n", "greaterThan", 5), ("d", "notLessThan", 2)):
        text = predicates.search_filter(df, field, op, value)._jdf.queryExecution().executedPlan().toString()
        pushed = text[text.index("PushedFilters") :]
        assert any(f in pushed for f in (f"GreaterThan({field}", f"GreaterThanOrEqual({field}", f"LessThan({field}")), (field, text)


# ---- SQL mode -------------------------------------------------------------------------------------------


@pytest.fixture
def events(spark):
    data = [(1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 2, 1), ":date_from"), (3, datetime(2024, 3, 1), "c")]
    spark.createDataFrame(data, "id int, at timestamp_ntz, note string").createOrReplaceTempView("sql_events")


RANGED = "SELECT id FROM sql_events WHERE at BETWEEN :date_from AND :date_to"


def test_run_query_binds_the_range(spark, events):
    assert {r.id for r in sqlmode.run_query(spark, RANGED, "2024-01-15", "2024-02-15").collect()} == {2}
    got = sqlmode.run_query(spark, RANGED, "2 months ago", as_of=datetime(2024, 3, 1))
    assert {r.id for r in got.collect()} == {1, 2, 3}
    only = "SELECT id FROM sql_events WHERE at >= :date_from AND note <> :other"
    assert {r.id for r in sqlmode.run_query(spark, only, "2024-02-01", args={"other": "c"}).collect()} == {2}


def test_literals_are_left_alone(spark, events):
    assert {r.id for r in sqlmode.run_query(spark, "SELECT id FROM sql_events WHERE note = ':date_from'").collect()} == {2}
    assert sqlmode.markers_in("SELECT ':date_from' -- :date_to\n, :date_from_x") == set()


def test_range_guards(spark):
    with pytest.raises(ExtractError, match="no :date_from"):
        sqlmode.run_query(spark, "SELECT 1", "2024-01-01")
    with pytest.raises(ExtractError, match="no start date"):
        sqlmode.run_query(spark, RANGED)
    with pytest.raises(ExtractError, match="needs a query"):
        sqlmode.run_query(spark, "")


def test_probe_and_validate(spark, events):
    assert sqlmode.probe_columns(spark, "SELECT id, note AS n FROM sql_events WHERE at > :date_from AND false") == ["id", "n"]
    sqlmode.validate_query(spark, RANGED)
    with pytest.raises(ParseException):
        sqlmode.validate_query(spark, "SELEC 1")
    with pytest.raises(AnalysisException):
        sqlmode.validate_query(spark, "SELECT nope FROM sql_events")


def test_range_filter_is_pushed(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    spark.read.parquet(str(tmp_path / "p")).createOrReplaceTempView("sql_people")
    df = sqlmode.run_query(spark, "SELECT id FROM sql_people WHERE at BETWEEN :date_from AND :date_to", "2024-05-01", "2024-06-01")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in text[text.index("PushedFilters") :]
    assert "ReadSchema: struct<id:int,at:timestamp_ntz>" in text


def test_page_of(spark):
    df = sqlmode.page_of(spark.range(10), [F.desc("id")], 3, 2)
    assert [r.id for r in df.collect()] == [7, 6, 5]


def test_extract_sql(spark, events):
    table = extract.extract_sql(spark, RANGED, "2024-01-01", "2024-03-01", primary_key=["id"], incremental=True)["sql_result"]
    assert table.spec.types == {"id": "integer"} and table.df.count() == 3
    with pytest.raises(ExtractError, match="or not at all"):
        extract.extract_sql(spark, "SELECT 1 AS a, 2 AS a")
    with pytest.raises(ExtractError, match="not a table name"):
        extract.extract_sql(spark, "SELECT 1 AS a", table_name="../x")


def test_extract_pages_and_search(spark, docs):
    table = extract.extract_pages(docs({"links": [], "id": "1", "balance": 0.5}), table_name="t", primary_key=["id"])["t"]
    assert table.df.columns == ["links", "id", "balance"] and table.spec.types["balance"] == "numeric"
    assert table.df.first().links == "[]"
    with pytest.raises(ExtractError, match="missing"):
        extract.extract_pages(docs({"id": "1"}), table_name="t", primary_key=["x"])


def test_numbers_are_compared_as_they_are(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(10, 2)) AS d, CAST(v AS INT) AS i FROM VALUES (10.01), (10.02), (-3.00) t(v)")

    def found(field, op, *values):
        return sorted(float(r[field]) for r in predicates.search_filter(df, field, op, *values).collect())

    assert found("d", "equalTo", 10.014) == [] and found("d", "greaterThan", 10.016) == [10.02] and found("d", "equalTo", 10.01) == [10.01]
    assert found("i", "lessThan", 3_000_000_000) == [-3, 10, 10] and found("i", "greaterThan", -1e12) == [-3, 10, 10] and found("i", "greaterThan", 9.5) == [10, 10]
    assert found("d", "between", -1e20, 1e20) == [-3.0, 10.01, 10.02]


def test_text_dates_need_their_format(spark):
    df = spark.createDataFrame([("01/12/2024",), ("31/12/2023",), ("soon",), (None,)], "t string")
    got = predicates.search_filter(df, "t", "onOrAfter", "2024-01-01", kind="date", date_format="dd/MM/yyyy").collect()
    assert [r.t for r in got] == ["01/12/2024"]
    with pytest.raises(ExtractError, match="date_format"):
        predicates.search_filter(df, "t", "on", "2024-01-01", kind="date")


def test_selections_compare_without_case(spark):
    df = spark.createDataFrame([("a", ["X", "y"]), ("B", ["z"])], "t string, l array<string>")
    assert [r.t for r in predicates.search_filter(df, "t", "anyOf", ["A"]).collect()] == ["a"]
    assert [r.t for r in predicates.search_filter(df, "l", "noneOf", ["x", "Y"]).collect()] == ["B"]
