import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tributary.errors import ExtractError
from tributary.sources import catalog, pages, remote, search_xml


def envelope(items, offset=0, more=False, total=None, following=None):
    links = [{"rel": "next", "href": following}] if following else []
    return json.dumps({"links": links, "count": len(items), "hasMore": more, "items": items, "offset": offset, "totalResults": total})


@pytest.fixture
def landed(tmp_path):
    def write(*texts, name="pages.jsonl"):
        (tmp_path / name).write_text("\n".join(texts) + "\n")
        return str(tmp_path)

    return write


def test_collection_rows_come_in_offset_order(spark, landed, rows):
    path = landed(envelope([{"id": "3"}, {"name": "no id"}], 2), "", envelope([{"links": [], "id": "1"}, {"id": 2}], 0, True))
    got = rows(pages.read_collection(spark, path).select("ordinal", "id", "raw"), "ordinal")
    assert [(r["ordinal"], r["id"]) for r in got] == [(0, "1"), (1, "2"), (2, "3"), (3, None)]
    assert got[0]["raw"] == '{"links":[],"id":"1"}'


def test_sql_rows_keep_links_and_key_order(spark, landed):
    row = pages.read_sql_result(spark, landed(envelope([{"links": [], "zeta": "1", "alpha": 0.0}]))).first()
    assert list(json.loads(row.raw)) == ["links", "zeta", "alpha"]


def test_pages_may_be_whole_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"page-{i:03}.json").write_text(json.dumps(json.loads(envelope([{"id": str(i)}], i)), indent=1))
    got = pages.read_collection(spark, str(tmp_path), layout="files").orderBy("ordinal").collect()
    assert [r.id for r in got] == ["0", "1", "2"]
    numbered = pages.read_landed(spark, str(tmp_path), "files").select(pages.file_number().alias("n")).orderBy("n").collect()
    assert [r.n for r in numbered] == [0, 1, 2]


def test_empty_and_absent_items_give_no_rows(spark, landed):
    assert pages.read_collection(spark, landed(envelope([]), '{"offset":0}')).count() == 0


def test_malformed_page_fails_or_is_marked(spark, landed):
    path = landed(envelope([{"id": "1"}]), "<html>busy</html>")
    with pytest.raises(PySparkException, match="record collection returned a response that is not a JSON page"):
        pages.read_collection(spark, path).collect()
    assert pages.read_collection(spark, path, strict=False).count() == 1
    assert pages.read_envelopes(spark, path).where(F.col("malformed").isNotNull()).count() == 1


def test_quarantine(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{",), ("",), ("<html>",)], "raw string")
    good, bad = pages.split_malformed(df, "page")
    assert (good.count(), bad.count()) == (1, 3)
    strict, none = pages.split_malformed(df, "the query", strict=True)
    assert none.count() == 0
    with pytest.raises(PySparkException, match="the query returned a response that is not JSON"):
        strict.collect()


@pytest.fixture
def endpoint(spark):
    def build(*bodies):
        return spark.createDataFrame([(i, json.dumps(b) if not isinstance(b, str) else b) for i, b in enumerate(bodies)], "page_no long, raw string")

    return build


def test_rows_at_path_shapes(endpoint):
    df = endpoint({"data": {"results": [{"b": 1, "a": 2}, {"b": 3}]}}, {"data": {"results": {"b": 9}}}, {"data": {"results": None}}, {"data": 3}, {})
    got = pages.rows_at_path(df, "data.results").orderBy("ordinal").collect()
    assert [json.loads(r.raw) for r in got] == [{"b": 1, "a": 2}, {"b": 3}, {"b": 9}]
    assert got[0].raw == '{"b":1,"a":2}'
    assert [r.page_no for r in got] == [0, 0, 1]


def test_rows_at_top_level(endpoint):
    assert pages.rows_at_path(endpoint([{"id": 1}, {"id": 2}], {"id": 3}, [])).count() == 3


@pytest.mark.parametrize("value,found", [("x", "string"), (5, "bigint"), ([1, 2], "array"), ([{"a": 1}, 2], "array")])
def test_rows_at_path_rejects_other_shapes(endpoint, value, found):
    with pytest.raises(PySparkException, match=rf"path 'rows' holds neither a record nor a list of records \(found {found}"):
        pages.rows_at_path(endpoint({"rows": value}), "rows").collect()


def test_rows_at_path_rejects_text_that_is_not_json(endpoint):
    with pytest.raises(PySparkException, match="not JSON"):
        pages.rows_at_path(endpoint("<html>"), "rows").collect()


# ---- XML ------------------------------------------------------------------------------------------------

PAGE = """<?xml version="1.0" encoding="UTF-8"?>
<s:Envelope xmlns:s="urn:s" xmlns:m="urn:m" xmlns:c="urn:c" xmlns:l="urn:l" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
 <s:Body><m:searchResponse><m:searchResult>
  <c:status isSuccess="{ok}"/><c:totalRecords>3</c:totalRecords><c:totalPages>{pages}</c:totalPages><c:pageIndex>{index}</c:pageIndex>
  <c:searchId>S1</c:searchId>{body}
 </m:searchResult></m:searchResponse></s:Body></s:Envelope>"""
RECORD = '<c:record xsi:type="l:Customer" internalId="{0}"><l:entityId>{1}</l:entityId></c:record>'
ROW = '<c:searchRow><l:entityId>{0}</l:entityId><l:extra>e</l:extra></c:searchRow>'


@pytest.fixture
def xml(tmp_path):
    def write(index, body, ok="true", pages=2):
        (tmp_path / f"p{index}.xml").write_text(PAGE.format(ok=ok, pages=pages, index=index, body=body))
        return str(tmp_path)

    return write


def test_search_rows_of_both_lists(spark, xml, rows):
    xml(1, "<c:recordList>" + RECORD.format("101", "Birch") + RECORD.format("102", "Cedar") + "</c:recordList>")
    path = xml(2, "<c:searchRowList>" + ROW.format("Third") + "</c:searchRowList>")
    got = rows(search_xml.search_rows(search_xml.read_search_pages(spark, path)), "ordinal")
    assert [(r["internalId"], r["entityId"], r["extra"]) for r in got] == [("101", "Birch", None), ("102", "Cedar", None), (None, "Third", "e")]
    info = rows(search_xml.search_page_info(search_xml.read_search_pages(spark, path)), "page_index")
    assert [(i["search_id"], i["page_index"], i["total_pages"], i["total_records"]) for i in info] == [("S1", 1, 2, 3), ("S1", 2, 2, 3)]


def test_failed_search_is_an_error(spark, xml):
    path = xml(1, "<c:recordList>" + RECORD.format("1", "A") + "</c:recordList>", ok="false")
    with pytest.raises(PySparkException, match="saved search failed"):
        search_xml.search_rows(search_xml.read_search_pages(spark, path)).collect()


def test_plain_text_records_become_value(spark, xml):
    path = xml(1, "<c:recordList><c:record>one</c:record><c:record>two</c:record></c:recordList>")
    got = search_xml.search_rows(search_xml.read_search_pages(spark, path)).orderBy("ordinal").collect()
    assert [r.value for r in got] == ["one", "two"]


def test_pages_without_lists_are_an_error(spark, xml):
    with pytest.raises(ExtractError, match="no record list"):
        search_xml.search_rows(search_xml.read_search_pages(spark, xml(1, "")))


# ---- catalogs -------------------------------------------------------------------------------------------


def test_record_types(spark):
    body = {"items": [{"name": "customer"}, {"name": "", "links": [{"href": ""}, {"href": "https://h/catalog/receipt/"}]}, {"links": []}, {}]}
    got = catalog.record_types(spark.createDataFrame([(json.dumps(body),)], "raw string")).orderBy("position").collect()
    assert [(r.value, r.label) for r in got] == [("customer", "customer"), ("receipt", "receipt")]


def test_record_fields_in_document_order(spark):
    df = spark.createDataFrame([('{"properties":{"z":{},"a":{"properties":{"x":1}},"m":1}}',), ("{}",)], "raw string")
    assert [r.value for r in catalog.record_fields(df).orderBy("position").collect()] == ["z", "a", "m"]
    assert catalog.suggest_columns("record", type_schema=df) == ["z", "a", "m"]
    assert catalog.suggest_columns("sql", query_columns=["a"]) == ["a"]
    assert catalog.suggest_columns("endpoint") == []


def test_saved_searches(spark):
    data = [("s1", "1", "n1"), ("", "2", "n2"), (None, None, "n3"), ("s4", None, None), (None, "", "")]
    df = spark.createDataFrame(data, "scriptId string, internalId string, name string")
    assert {(r.value, r.label) for r in catalog.saved_searches(df).collect()} == {("s1", "n1"), ("2", "n2"), ("n3", "n3"), ("s4", "s4")}
    assert catalog.saved_searches(df.select("name")).count() == 3


# ---- parallel reads -------------------------------------------------------------------------------------


def test_paged_source_reads_every_page_once(spark):
    def fetch(offset, limit):
        return json.dumps({"offset": offset, "items": [{"id": str(i)} for i in range(offset, min(offset + limit, 2345))]})

    df = remote.paged_source(spark, fetch, 2345, limit=5000, pages_per_task=2)
    assert df.rdd.getNumPartitions() == 2
    ids = [int(r.id) for r in pages.explode_items(pages.envelopes(df.select("raw"))).orderBy("ordinal").collect()]
    assert ids == list(range(2345))
    assert remote.paged_source(spark, fetch, 0).count() == 0
    assert remote.page_total('{"totalResults": 7}') == 7 and remote.page_total("{}") == 0


def test_fetch_details_keeps_rows_without_id(spark, docs, rows):
    collection = docs({"id": "a"}, {"x": 1}, {"id": "b"}).withColumn("id", F.get_json_object("raw", "$.id"))
    got = rows(remote.fetch_details(collection, lambda i: json.dumps({"id": i, "full": True}), tasks=2).drop("doc"), "ordinal")
    assert [json.loads(r["raw"]) for r in got] == [{"id": "a", "full": True}, {"x": 1}, {"id": "b", "full": True}]


def test_failed_page_without_rows_is_noticed(spark, xml):
    xml(1, "<c:recordList>" + RECORD.format("1", "A") + RECORD.format("2", "B") + "</c:recordList>")
    path = xml(2, "", ok="false")
    with pytest.raises(PySparkException, match="saved search failed"):
        search_xml.search_rows(search_xml.read_search_pages(spark, path)).collect()


def test_pages_of_two_values_are_malformed(spark):
    page = '{"offset":0,"items":[{"id":"1"}]}'
    landed = spark.createDataFrame([(page,), (page + page,), (page + " oops",)], "raw string")
    found = pages.envelopes(landed)
    assert [r.malformed is None for r in found.collect()] == [True, False, False]
    good, bad = pages.split_malformed(landed, "x")
    assert (good.count(), bad.count()) == (1, 2)
    with pytest.raises(Exception, match="not a JSON page"):
        pages.explode_items(found).collect()


def test_pages_without_an_offset_go_by_their_file(spark):
    body = '{"items":[{"id":"%s"},{"id":"%s"}],"hasMore":true}'
    rows = [(body % ("c", "d"), "/x/page-2.json"), (body % ("a", "b"), "/x/page-1.json")]
    found = pages.explode_items(pages.envelopes(spark.createDataFrame(rows, "raw string, file string")))
    assert [r.id for r in found.orderBy("ordinal").collect()] == ["a", "b", "c", "d"]
    with pytest.raises(Exception, match="without an offset"):
        pages.explode_items(pages.envelopes(spark.createDataFrame([(r[0],) for r in rows], "raw string"))).collect()
