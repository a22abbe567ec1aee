import json
import os

import pytest
from pyspark.sql import functions as F

from tributary.errors import ExtractError
from tributary.operators import keys, merge
from tributary.plans import landing
from tributary.session import shared_folder, stage, staging_scope
from tributary.sinks import csvfiles, tables
from tributary.spec import Table, TableSpec
from tributary.streaming.incremental import landed_stream, stream_upsert

# ---- guards ---------------------------------------------------------------------------------------------


def test_argument_guards():
    keys.require_key_for_incremental(True, ["id"])
    keys.require_key_for_incremental(False, [])
    with pytest.raises(ExtractError, match="needs a primary key"):
        keys.require_key_for_incremental(True, [])
    for name in ("", "a-b_c.1"):
        keys.require_table_name(name)
    for name in ("a/b", "..", "a..b", "x\n", "a b"):
        with pytest.raises(ExtractError):
            keys.require_table_name(name)


@pytest.mark.parametrize(
    "mode,good",
    [("record", {"record_type": "c"}), ("sql", {"query": "q"}), ("saved_search", {"saved_search_id": "1", "search_record_type": "T"}),
     ("endpoint", {"script_id": "1", "deploy_id": "2"})],
)
def test_required_arguments(mode, good):
    keys.require_arguments(mode, **good)
    for name in good:
        with pytest.raises(ExtractError, match=name):
            keys.require_arguments(mode, **(good | {name: ""}))
    with pytest.raises(ExtractError, match="unknown mode"):
        keys.require_arguments("other")


def test_parse_json_argument():
    assert keys.parse_json_argument("p", " ", require_object=True) == {}
    assert keys.parse_json_argument("p", None) is None
    assert keys.parse_json_argument("p", "[1]") == [1]
    with pytest.raises(ExtractError, match="'p' is not valid JSON"):
        keys.parse_json_argument("p", "{")
    with pytest.raises(ExtractError, match="must be a JSON object"):
        keys.parse_json_argument("p", "[1]", require_object=True)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, l string")
    assert {tuple(r) for r in keys.duplicate_keys(df, ["k", "l"]).collect()} == {(1, "a", 2), (None, "c", 2)}


# ---- merge ----------------------------------------------------------------------------------------------

BATCH = "id string, v int, page_no long, ordinal long"


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, 0, 0), ("a", 2, 1, 0), ("a", 3, 0, 9), ("b", 4, 0, 1), (None, 5, 0, 1), (None, 6, 0, 2)], BATCH)
    assert {tuple(r) for r in merge.latest_rows(df, ["id"]).collect()} == {("a", 2), ("b", 4), (None, 6)}


def test_latest_rows_reduces_before_the_shuffle(spark):
    text = merge.latest_rows(spark.createDataFrame([("a", 1, 0, 0)], BATCH), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")
    assert "Partial" in text[text.index("Exchange") :]


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "id string, v int, extra string")
    batch = spark.createDataFrame([("a", 9, 0, 0), ("a", 10, 0, 1), ("c", 4, 0, 2), (None, 7, 0, 3)], BATCH)
    assert {tuple(r) for r in merge.upsert(base, batch, ["id"]).collect()} == {("a", 10, None), ("b", 2, "y"), ("c", 4, None), (None, 7, None)}


def test_upsert_widens_types_and_adds_columns(spark):
    base = spark.createDataFrame([("a", 1, True)], "id string, v long, f boolean")
    batch = spark.createDataFrame([("b", 2.5, "t", "n", 0, 0)], "id string, v double, f string, n string, page_no long, ordinal long")
    got = merge.upsert(base, batch, ["id"])
    assert dict(got.dtypes) == {"id": "string", "v": "double", "f": "string", "n": "string"}
    assert {tuple(r) for r in got.collect()} == {("a", 1.0, "true", None), ("b", 2.5, "t", "n")}


def test_anti_join_is_hash_based(spark):
    base = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"))
    batch = spark.createDataFrame([("a", 1, 0, 0)], BATCH)
    text = merge.upsert(base, batch, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text


# ---- tables ---------------------------------------------------------------------------------------------

SPEC = TableSpec("t", ("id",))


def contents(spark, path):
    return {tuple(r) for r in tables.read_table(spark, path).collect()}


def test_full_load_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(spark.createDataFrame([("a", 1)], "id string, v int"), path, SPEC)
    before = tables.read_table(spark, path)
    tables.write_full(spark.createDataFrame([("b", 2)], "id string, v int"), path, SPEC, parts=3)
    assert contents(spark, path) == {("b", 2)}
    # Readers of the version before keep their files.
    assert [tuple(r) for r in before.collect()] == [("a", 1)]
    with pytest.raises(ExtractError, match="no table"):
        tables.read_table(spark, str(tmp_path / "none"))


def test_upsert_writes_its_rows_only(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v"))
    first = tables.write_full(base, path, SPEC, parts=16)
    second = tables.write_upsert(spark.createDataFrame([("7", 1, 0, 0), ("7", 2, 0, 1)], BATCH), path, SPEC)
    assert second["parts"] == first["parts"] and len(first["parts"]) == 16
    assert [d["rows"] for d in second["deltas"]] == [1]
    got = dict(contents(spark, path))
    assert len(got) == 200 and got["7"] == 2 and got["8"] == 0


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_of_a_thousand_keys_rewrites_no_file_of_a_default_load(spark, tmp_path):
    base = spark.range(100_000).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v"))
    tables.write_tables({"t": Table(base, SPEC)}, str(tmp_path))
    before = files(tmp_path)
    batch = spark.range(1000).select((F.col("id") * 97).cast("string").alias("id"), F.lit(1).alias("v"), F.lit(0).alias("page_no"), F.col("id").alias("ordinal"))
    for _ in range(2):
        tables.write_upsert(batch, str(tmp_path / "t"), SPEC)
    after = files(tmp_path)
    assert before.items() <= after.items()
    assert sum(after.values()) - sum(before.values()) < 0.1 * sum(before.values())
    read = tables.read_table(spark, str(tmp_path / "t"))
    assert (read.count(), read.where("v = 1").count(), read.select("id").distinct().count()) == (100_000, 1000, 100_000)


def test_deltas_are_merged_when_they_grow(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v")), path, SPEC)
    sizes = []
    for load in range(4):
        batch = spark.range(10).select((F.col("id") + 10 * load).cast("string").alias("id"), F.lit(load + 1).alias("v"), F.lit(0).alias("page_no"), F.col("id").alias("ordinal"))
        sizes.append(len(tables.write_upsert(batch, path, SPEC)["deltas"]))
    assert sizes == [1, 2, 0, 1]
    assert tables.compact(spark, path)["deltas"] == [] and tables.compact(spark, path)["version"] == 6
    got = {r.id: r.v for r in tables.read_table(spark, path).collect()}
    assert got == {str(k): (k // 10 + 1 if k < 40 else 0) for k in range(100)}


def test_null_keys_are_replaced_wherever_they_are(spark):
    base = spark.createDataFrame([(None, k) for k in range(50)] + [("a", 1)], "id string, v int")
    batch = spark.createDataFrame([(None, -1, 0, 0)], BATCH)
    assert sorted(merge.upsert(base, batch, ["id"]).collect(), key=str) == sorted([(None, -1), ("a", 1)], key=str)


def test_upsert_creates_then_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", 1, 0, 0), ("a", 2, 0, 1), ("b", 3, 0, 2)], BATCH)
    tables.write_upsert(batch, path, SPEC, load_id="x")
    tables.write_upsert(batch, path, SPEC, load_id="y")
    again = tables.write_upsert(batch, path, SPEC, load_id="y")
    assert again["version"] == 2 and contents(spark, path) == {("a", 2), ("b", 3)}


def test_upsert_with_changed_types(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(spark.createDataFrame([(1, 1), (2, 2)], "id long, v long"), path, SPEC, parts=4)
    batch = spark.createDataFrame([(1.0, 1.5, "n", 0, 0)], "id double, v double, n string, page_no long, ordinal long")
    tables.write_upsert(batch, path, SPEC)
    assert contents(spark, path) == {(1.0, 1.5, "n"), (2.0, 2.0, None)}


def test_upsert_guards(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    with pytest.raises(ExtractError, match="needs a primary key"):
        tables.write_upsert(df, path, TableSpec("t"))
    tables.write_full(df, path, SPEC)
    with pytest.raises(ExtractError, match="is keyed by"):
        tables.write_upsert(df, path, TableSpec("t", ("v",)))
    with pytest.raises(ExtractError, match="missing"):
        tables.write_full(df, path, TableSpec("t", ("nope",)))


def test_a_half_written_load_is_invisible(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_full(spark.createDataFrame([("a", 1)], "id string, v int"), str(path), SPEC)
    (path / "v00000002-dead" / "_part=0").mkdir(parents=True)
    (path / "_commits" / ".00000002.json.draft").write_text("{")
    assert contents(spark, str(path)) == {("a", 1)}
    tables.write_full(spark.createDataFrame([("b", 1)], "id string, v int"), str(path), SPEC)
    assert contents(spark, str(path)) == {("b", 1)}


def test_write_tables_needs_one_mode(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    both = {"a": Table(df, TableSpec("a", ("id",), True)), "b": Table(df, TableSpec("b"))}
    with pytest.raises(ExtractError, match="same mode"):
        tables.write_tables(both, str(tmp_path))
    done = tables.write_tables({"a": both["a"], "c": Table(df, TableSpec("c", ("id",), True))}, str(tmp_path))
    assert set(done) == {"a", "c"} and contents(spark, str(tmp_path / "c")) == {("a", 1)}


# ---- CSV and manifest -----------------------------------------------------------------------------------


def test_csv_text(spark, tmp_path):
    df = spark.sql("SELECT 'a,\"b\"' AS t, true AS f, cast(null AS string) AS n, struct(1 AS x) AS s, array('é') AS l, 2.5D AS d, '' AS e")
    path = csvfiles.write_csv(Table(df, TableSpec("t", ("t",), True, {"s": "weird"})), str(tmp_path), compat=True)
    (part,) = [p for p in os.listdir(path) if p.startswith("part-")]
    header, line = open(os.path.join(path, part), encoding="utf-8").read().splitlines()
    assert header == "t,f,n,s,l,d,e"
    assert line == '"a,""b""",True,,"{""x"":1}","[""é""]",2.5,'
    manifest = json.load(open(path + ".manifest"))
    assert {k: manifest[k] for k in manifest if k != "schema"} == {
        "incremental": True, "write_always": False, "delimiter": ",", "enclosure": '"', "manifest_type": "out", "has_header": True,
    }
    assert manifest["schema"][0] == {"name": "t", "data_type": {"base": {"type": "STRING"}}, "nullable": True, "primary_key": True}
    assert [c["data_type"]["base"]["type"] for c in manifest["schema"]] == ["STRING", "BOOLEAN", "STRING", "STRING", "STRING", "NUMERIC", "STRING"]


def test_composite_key_is_marked(spark):
    df = spark.createDataFrame([("1", "k2", 10)], "branch string, ledger string, amount long")
    marked = {r[1] for r in csvfiles.manifest_rows(df, TableSpec("b", ("branch", "ledger"))) if r[4]}
    assert marked == {"branch", "ledger"}


def test_plain_booleans(spark, tmp_path):
    path = csvfiles.write_csv(Table(spark.sql("SELECT true AS f"), TableSpec("t")), str(tmp_path))
    assert spark.read.csv(path, header=True).first().f == "true"


def test_zero_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "")
    path = csvfiles.write_csv(Table(empty, TableSpec("t", ("id",))), str(tmp_path))
    texts = [open(os.path.join(path, p)).read() for p in os.listdir(path) if p.startswith("part-")]
    assert texts == ["id\n"] and os.path.exists(path + ".manifest")
    assert csvfiles.write_csv(Table(empty, TableSpec("none")), str(tmp_path)) is None
    assert not os.path.exists(tmp_path / "none.csv")
    assert tables.zero_row_table(spark, TableSpec("t")) is None


# ---- streaming ------------------------------------------------------------------------------------------


def test_stream_upsert_picks_up_what_lands(spark, tmp_path):
    landed, path, checkpoint = tmp_path / "landed", str(tmp_path / "t"), str(tmp_path / "cp")
    landed.mkdir()

    def shape(batch):
        return batch.select(
            F.get_json_object("raw", "$.id").alias("id"), F.get_json_object("raw", "$.v").cast("int").alias("v"),
            F.lit(0).alias("page_no"), F.get_json_object("raw", "$.n").cast("long").alias("ordinal"),
        )

    def run():
        stream_upsert(landed_stream(spark, str(landed), files_per_batch=1), shape, path, SPEC, checkpoint, parts=2).awaitTermination()

    (landed / "1.jsonl").write_text('{"id":"a","v":1,"n":0}\n{"id":"a","v":2,"n":1}\n')
    run()
    assert contents(spark, path) == {("a", 2)}
    (landed / "2.jsonl").write_text('{"id":"a","v":3,"n":0}\n{"id":"b","v":4,"n":1}\n')
    run()
    assert contents(spark, path) == {("a", 3), ("b", 4)}
    version = tables.current_commit(spark, path)["version"]
    run()
    assert tables.current_commit(spark, path)["version"] == version


# ---- staging and skew -----------------------------------------------------------------------------------


def test_stage_uses_the_shared_folder(spark):
    df = stage(spark.range(5), "x")
    assert df.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(shared_folder(spark).replace("file:", "").lstrip("/"))
    assert df.count() == 5



def test_expire_versions_keeps_what_is_in_use(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(50).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v"))
    tables.write_full(base, path, SPEC, parts=4)
    for v in (1, 2, 3):
        tables.write_upsert(spark.createDataFrame([("7", v, 0, 0)], BATCH), path, SPEC)
    assert tables.expire_versions(spark, path, keep=1) == []  # the last version needs the base and all deltas
    tables.compact(spark, path)
    dropped = tables.expire_versions(spark, path, keep=1)
    assert len(dropped) == 4 + 3 and len(contents(spark, path)) == 50 and dict(contents(spark, path))["7"] == 3
    assert tables.expire_versions(spark, path, keep=1) == []
    with pytest.raises(ExtractError):
        tables.expire_versions(spark, path, keep=0)


def test_staging_scope_cleans_up(spark):
    kept = stage(spark.range(3), "kept")
    with staging_scope(spark):
        inner = stage(spark.range(4), "inner")
        path = inner.inputFiles()[0].removeprefix("file://")
        with staging_scope(spark):
            nested = stage(spark.range(5), "nested").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and not os.path.exists(nested)
    assert not os.path.exists(path) and kept.count() == 3


def test_upsert_leaves_nothing_staged(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_full(spark.createDataFrame([("a", 1)], "id string, v int"), path, SPEC)
    staged = f"{shared_folder(spark)}/tributary".replace("file:", "")
    before = set(os.listdir(staged)) if os.path.isdir(staged) else set()
    tables.write_upsert(spark.createDataFrame([("a", 2, 0, 0)], BATCH), path, SPEC)
    assert set(os.listdir(staged)) - before == set()


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_upsert(spark.createDataFrame([], BATCH), path, SPEC)
    assert contents(spark, path) == set()
    tables.write_upsert(spark.createDataFrame([("a", 2, 0, 0)], BATCH), path, SPEC)
    tables.write_upsert(spark.createDataFrame([], BATCH), path, SPEC)
    assert contents(spark, path) == {("a", 2)}


# ---- loads of several tables, and loads that come again -------------------------------------------------


def _failing(df):
    return df.withColumn("v", F.raise_error(F.lit("the writer died")).cast("int"))


@pytest.mark.parametrize("incremental", [False, True])
def test_tables_are_committed_together(spark, tmp_path, incremental):
    folder = str(tmp_path / "tables")

    def both(v, child=lambda df: df):
        df = spark.createDataFrame([("a", v), ("b", v)], "id string, v int")
        return {n: Table(d, TableSpec(n, ("id",), incremental)) for n, d in (("p", df), ("p_lines", child(df)))}

    def state():
        return {n: {r.v for r in d.collect()} for n, d in tables.read_tables(spark, folder).items()}

    with pytest.raises(Exception, match="the writer died"):
        tables.write_tables(both(0, _failing), folder)
    assert state() == {} and tables.current_commit(spark, f"{folder}/p") is None
    with pytest.raises(ExtractError):
        tables.read_table(spark, f"{folder}/p")
    tables.write_tables(both(1), folder)
    assert state() == {"p": {1}, "p_lines": {1}}
    with pytest.raises(Exception, match="the writer died"):
        tables.write_tables(both(2, _failing), folder)
    assert state() == {"p": {1}, "p_lines": {1}} and contents(spark, f"{folder}/p") == {("a", 1), ("b", 1)}
    tables.write_tables(both(3), folder, load_id="run#1")
    tables.write_tables(both(4), folder, load_id="run#1")
    assert state() == {"p": {3}, "p_lines": {3}}
    # on its own, a table moves its own entry
    tables.write_table(Table(spark.createDataFrame([("a", 5)], "id string, v int"), TableSpec("p", ("id",), True)), f"{folder}/p")
    assert state() == {"p": {3, 5}, "p_lines": {3}}
    tables.compact(spark, f"{folder}/p")
    tables.expire_versions(spark, f"{folder}/p", keep=1)
    assert state() == {"p": {3, 5}, "p_lines": {3}}


def test_a_folder_takes_in_tables_that_were_there(spark, tmp_path):
    folder, df = str(tmp_path), spark.createDataFrame([("a", 1)], "id string, v int")
    tables.write_full(df, f"{folder}/old", TableSpec("old", ("id",)))
    tables.write_tables({"new": Table(df, TableSpec("new", ("id",)))}, folder)
    assert set(tables.read_tables(spark, folder)) == {"old", "new"} and contents(spark, f"{folder}/old") == {("a", 1)}
    assert tables.write_tables({}, folder) == {}


def test_a_load_meanwhile_stops_the_commit_of_the_folder(spark, tmp_path, monkeypatch):
    folder, df = str(tmp_path / "t"), spark.createDataFrame([("a", 1)], "id string, v int")
    two = {n: Table(df, TableSpec(n, ("id",))) for n in ("a", "b")}
    tables.write_tables(two, folder)
    write = tables.write_table

    def meddling(table, path, **options):
        if path.endswith("/b"):
            monkeypatch.setattr(tables, "write_table", write)
            write(Table(df.withColumn("v", F.lit(9)), TableSpec("a", ("id",), True)), f"{folder}/b")
        return write(table, path, **options)

    monkeypatch.setattr(tables, "write_table", meddling)
    with pytest.raises(ExtractError, match="first"):
        tables.write_tables(two, folder)
    assert contents(spark, f"{folder}/a") == {("a", 1)} and contents(spark, f"{folder}/b") == {("a", 9)}


def test_a_batch_that_comes_again_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(v, load_id):
        tables.write_upsert(spark.createDataFrame([("a", v, 0, 0)], BATCH), path, SPEC, load_id=load_id)
        return dict(contents(spark, path))["a"]

    assert [load(1, "A#0"), load(2, "B#0"), load(3, "A#0")] == [1, 2, 2]
    assert [load(4, "A#1"), load(5, "A#0"), load(6, "B#0"), load(7, "B#12"), load(8, "B#9")] == [4, 4, 4, 7, 7]
    tables.compact(spark, path)
    assert [load(9, "A#1"), load(10, "odd"), load(11, "odd"), load(12, None)] == [7, 10, 10, 12]
    assert tables.current_commit(spark, path)["loads"] == {"A": 1, "B": 12, "odd": 0}
    tables.write_full(spark.createDataFrame([("a", 0)], "id string, v int"), path, SPEC)
    assert load(13, "A#1") == 0
