"""Records whose lines come in several documents."""

from tributary.plans import extract, queries


def test_a_long_record_comes_in_documents_of_bounded_size(spark, tmp_path, monkeypatch):
    # Two records: one of 13 lines, one of 2.
    rows = [(k, 1, 50 if k < 13 else 51) for k in range(15)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    landed, extracted = [], extract.extract_records

    def keep(collection, *args, **options):
        landed.extend(collection.collect())
        return extracted(collection, *args, **options)

    monkeypatch.setattr(queries, "LONG_DOCUMENT", 5)
    monkeypatch.setattr(extract, "extract_records", keep)
    found = queries.QUERIES["child_upsert_long"](spark, str(tmp_path)).collect()
    assert sorted(r.raw.count('"line"') for r in landed) == [2, 3, 5, 5]
    assert len({r.ordinal for r in landed}) == 4
    assert sorted(map(tuple, found)) == [("0", n, n) for n in range(13)] + [("1", n, n) for n in range(2)]


def test_the_last_document_of_a_record_wins(spark):
    texts = [(0, 51, '{"id":"1","item":{"items":[{"line":0,"seen":9}]}}'), (0, 1, '{"id":"1","item":{"items":[{"line":0,"seen":1},{"line":1,"seen":2}]}}')]
    landed = spark.createDataFrame(texts, "page_no long, ordinal long, raw string")
    found = extract.extract_records(landed, record_type="long", primary_key=["id"], child_tables=True, incremental=True, keep_order=True)
    latest = queries.merge.latest_rows(found["long_item"].df, ["_parent_id", "line"], ["ordinal"])
    assert sorted((r.line, r.seen) for r in latest.collect()) == [(0, 9), (1, 2)]
