"""Chains of pointers, profiles that are merged batch by batch, and pages deep in a sorted result."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import infer, pagesets
from tributary.operators.ranking import places
from tributary.errors import ExtractError
from tributary.operators.resolve import latest_details
from tributary.plans.sqlmode import SortedPages
from tributary.sinks import tables
from tributary.spec import TableSpec
from tributary.streaming.incremental import landed_stream, stream_documents


def plain_places(before: dict) -> dict:
    out = {}
    for node in before:
        way, at = [], node
        while at is not None and at not in way:
            way.append(at)
            at = before[at]
        if at is None:
            out[node] = (way[-1], len(way) - 1, "chain")
        else:
            ring = way[way.index(at) :]
            out[node] = (min(ring), None, "ring" if node in ring else "behind")
    return out


@pytest.mark.parametrize(("seed", "n", "roots"), [(1, 40, 6), (2, 60, 0), (3, 33, 1)])
def test_places(spark, seed, n, roots):
    rnd = random.Random(seed)
    names = rnd.sample(range(1000), n)
    before = {v: None if k < roots else rnd.choice(names[: max(k, 1)] if rnd.random() < 0.8 else names) for k, v in enumerate(names)}
    found = places(spark.createDataFrame(list(before.items()), "node long, before long")).collect()
    assert {r.node: (r.first, r.place, r.kind) for r in found} == plain_places(before) and len(found) == n


def test_places_of_long_chains_and_nothing(spark):
    chain = spark.range(3000).select(F.concat(F.lit("n"), F.col("id")).alias("node"), F.when(F.col("id") > 0, F.concat(F.lit("n"), F.col("id") - 1)).alias("before"))
    assert places(chain).where("kind <> 'chain' OR first <> 'n0' OR node <> concat('n', place)").count() == 0
    assert places(chain.limit(0)).count() == 0


def test_cursor_order(spark):
    rows = [(9, None, "a"), (4, "a", "b"), (4, "a", "b"), (7, "b", None), (1, "x", "y"), (2, "y", None), (5, "q", "p"), (6, "p", "q"), (8, "q", "z"), (3, "me", "me"), (None, "a", "b"), (10, "a", "c")]
    found = {r.page_no: (r.first_page, r.place, r.segment) for r in pagesets.cursor_order(spark.createDataFrame(rows, "page_no long, cursor_in string, cursor_out string")).collect()}
    chain = {9: (9, 0, "chain"), 4: (9, 1, "chain"), 7: (9, 2, "chain"), 10: (9, 1, "chain")}
    assert found == chain | {1: (1, 0, "loose"), 2: (1, 1, "loose"), 5: (5, None, "ring"), 6: (5, None, "ring"), 8: (5, None, "behind_ring"), 3: (3, None, "ring")}


def test_unreached_pages(spark):
    def page(page_set, at, to):
        return page_set, at, None if to is None else f"https://h/x?limit=1&offset={to}"

    rows = [page("a", 0, 100), page("a", 100, 0), page("a", 300, 400), page("a", 400, None), page("a", 700, 800), page("a", 800, 700), page("b", 0, 100), page("b", 100, 200), page("b", 100, 200), page("b", 200, None), page("c", 5, None), page("b", None, 7)]
    found = pagesets.unreached_pages(spark.createDataFrame(rows, "page_set string, page_offset long, next_href string")).collect()
    assert {tuple(r) for r in found} == {("a", 300, "loose", 300), ("a", 400, "loose", 300), ("a", 700, "ring", 700), ("a", 800, "ring", 700), ("c", 5, "loose", 5)}


# ---- profiles ---------------------------------------------------------------------------------------------

RAGGED = [
    {"id": "a", "n": 1, "lines": {"items": []}}, {"id": "b", "x": None, "flag": True}, {"n": 2.5, "id": "c", "lines": [{"k": 1}]}, {},
    {"late": 1, "id": "d", "n": 3, "flag": "no"}, {"id": "e", "lines": "text", "x": {"y": 1}}, {"id": "f", "x": 7, "zero": None},
]


@pytest.mark.parametrize("cuts", [(3,), (1, 2, 5), (0, 7), (2, 4)])
def test_merged_profiles_are_that_of_all(spark, docs, cuts):
    whole = docs(*RAGGED)
    parts = [whole.where(F.col("ordinal").between(a, z - 1)) for a, z in zip((0, *cuts), (*cuts, len(RAGGED)))]
    profiles = [infer.profile_of_text(spark, infer.profile_text(infer.profile(p))) for p in parts]
    random.Random(len(cuts)).shuffle(profiles)
    merged, wanted = infer.collect_profile(infer.merge_profiles(*profiles)), infer.collect_profile(infer.profile(whole))
    assert merged == wanted and merged.names == ["id", "n", "lines", "x", "flag", "late", "zero"]


def test_documents_in_batches(spark, tmp_path):
    landed, path, spec = tmp_path / "landed", str(tmp_path / "t"), TableSpec("t", ("id",), True)
    landed.mkdir()

    def documents(batch):
        rows = batch.select(F.lit(0).cast("long").alias("page_no"), F.from_json("raw", "o long").o.alias("ordinal"), F.from_json("raw", "d string").d.alias("raw"))
        return rows.withColumn("doc", F.parse_json("raw"))

    def run():
        stream_documents(landed_stream(spark, str(landed), files_per_batch=1), documents, path, spec, str(tmp_path / "c"), parts=2).awaitTermination()
        return infer.collect_profile(tables.table_profile(spark, path))

    for k, d in enumerate(x for x in RAGGED if "id" in x):
        (landed / f"{k}.jsonl").write_text(json.dumps({"o": k, "d": json.dumps(d)}) + "\n")
        found = run()
    assert found.types() == {"id": "string", "n": "numeric", "lines": "string", "x": "string", "flag": "string", "late": "integer", "zero": "string"}
    assert found.n_rows == 6 and run() == found
    rows = {r.id: r for r in tables.read_table(spark, path).collect()}
    assert len(rows) == 6 and rows["a"].n == 1.0 and rows["c"].n == 2.5 and rows["b"].flag == "true" and rows["d"].late == 1
    tables.compact(spark, path)
    assert run() == found


# ---- pages deep in a result, and the document that counts -----------------------------------------------------


def test_any_page_of_a_result(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 1, 1, 2, 3, 9]), rnd.randrange(40)) for _ in range(157)]
    pages = SortedPages(spark.createDataFrame(rows, "a int, b int").repartition(5), [F.desc_nulls_last("a"), "b"], ranges=6)
    wanted = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert pages.n_rows == 157 and len(pages.counts) > 2
    for limit, offset in ((10, 0), (7, 50), (40, 117), (40, 140), (5, 157), (0, 3), (5, 900), (157, 0), (1, 156)):
        assert [tuple(r) for r in pages.page(limit, offset).collect()] == wanted[offset : offset + limit]
    with pytest.raises(ExtractError):
        pages.page(1, -1)
    assert SortedPages(spark.createDataFrame([], "a int"), ["a"]).page(5, 0).collect() == []


def test_latest_details(spark):
    rows = [("a", 1, "f", "x"), ("a", 2, "e", "y"), ("a", 2, "d", "z"), ("b", 1, "f", "p"), ("b", 1, "f", "q"), ("b", None, "z", "s"), ("c", None, None, "u"), (None, 5, "f", "v"), ("d", 3, None, "w"), ("d", 3, "a", "k")]
    found = latest_details(spark.createDataFrame(rows, "id string, landed_at int, file string, raw string")).collect()
    assert {tuple(r) for r in found} == {("a", "y"), ("b", "q"), ("c", "u"), ("d", "k")}
    plain = latest_details(spark.createDataFrame(rows, "id string, landed_at int, f string, raw string").select("id", "raw")).collect()
    assert {tuple(r) for r in plain} == {("a", "z"), ("b", "s"), ("c", "u"), ("d", "w")}
