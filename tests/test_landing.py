"""Landed documents: how they are put together, dealt out and written."""

import gzip
import json
from pathlib import Path

import pytest

from tributary.plans import landing

from .conftest import plan


@pytest.fixture
def tables(spark, tmp_path):
    """Seven orders, one of them twice and one without a key, with up to three lines in no order."""
    orders = [(k, k + 10, "O", 1.5, "5-LOW" if k == 2 else "1-URGENT") for k in (1, 2, 3, 401, 402, 403, 403)] + [(None, 1, "F", 2.0, "2-HIGH")]
    lines = [(k, n, float(n), "N") for k in (1, 401, 403) for n in (3, 1, 2)] + [(2, 1, None, None), (None, 1, 1.0, "A"), (9, 1, 1.0, "A")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _texts(files):
    assert files and all(f.name.endswith(".gz") for f in files)
    return [json.loads(line) for f in files for line in gzip.open(f, "rt")]


def test_documents_land_compressed_and_whole(spark, tables):
    found = _texts(list(Path(landing.land(spark, tables, "documents")).glob("part-*")))
    lines = {d.get("id"): [x["line"] for x in d["item"]["items"]] for d in found}
    assert lines == {"1": [1, 2, 3], "2": [1], "3": [], "401": [1, 2, 3], "402": [], "403": [1, 2, 3], None: []}
    assert sorted(d.get("id") or "" for d in found) == ["", "1", "2", "3", "401", "402", "403", "403"]
    assert all(d["item"]["totalResults"] == len(d["item"]["items"]) for d in found)


def test_a_block_is_one_compressed_file(spark, tables):
    folder = Path(landing.land(spark, tables, "document_blocks"))
    blocks = {p.name: [d["id"] for d in _texts(list(p.glob("part-*")))] for p in folder.glob("block=*[0-9]")}
    assert {k: sorted(v) for k, v in blocks.items()} == {"block=0": ["1", "2", "3"], "block=2": ["401", "402", "403", "403"]}


def test_tasks_follow_the_number_of_lines(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_TASK", 1)
    cores = spark.sparkContext.defaultParallelism
    documents = landing.order_documents(spark, tables)
    assert documents.rdd.getNumPartitions() == cores * -(-12 // cores)
    # Lines are dealt out as they are; nothing is collected before.
    text = plan(documents)
    assert text.count("hashpartitioning(l_orderkey") == text.count("REPARTITION_BY_NUM") - text.count("hashpartitioning(o_orderkey")
