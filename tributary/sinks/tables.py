"""Typed Parquet tables: full load, primary-key upsert, and loads of several tables.

A load never touches files readers may be using. It writes a new version folder, then records the commit
as one small file naming the folders that hold the table. An upsert writes its own rows only, as a delta that
readers merge over the base: its cost follows the batch, not the table. When the deltas hold more than a share of
the base, or are many, the load that finds them so writes the merged table anew; so on the whole every
row is rewritten a bounded number of times, however many loads there are. Deltas that bring new keys only are put beside the
files of the base, which stay as they are.

Tables that ``write_tables`` loads belong together: a commit of their folder names the version of each, and is written
when all of them are. Readers and later loads go by it, so a load that dies between two tables is as if it had not begun.
A table loaded on its own in such a folder moves its own entry only.

A commit also carries the loads applied so far, per source the highest number, so that a batch that is run again adds
nothing, whatever other sources have loaded since.

A commit is made by renaming its file into place if none is there. On stores without such a rename (most object
stores), let one writer at a time load a table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ExtractError
from tributary.operators.infer import merge_profiles, profile_of_text, profile_text
from tributary.operators.keys import require_key_columns, require_key_for_incremental, require_table_name
from tributary.operators.merge import BATCH_ORDER, common_types, conform, latest_rows, without_keys
from tributary.session import staging_scope
from tributary.sinks.files import delete, list_names, read_text, write_text
from tributary.spec import SPARK_TYPE, Table, TableSpec

PART = "_part"

# Deltas are merged into the base when they have more rows than this share of it, or are more than so many.
DELTA_SHARE = 0.25
MOST_DELTAS = 32


def _commit_names(spark: SparkSession, path: str) -> list[str]:
    return sorted(n for n in list_names(spark, f"{path}/_commits") if n.endswith(".json") and not n.startswith("."))


def _latest(spark: SparkSession, path: str) -> dict | None:
    names = _commit_names(spark, path)
    return json.loads(read_text(spark, f"{path}/_commits/{names[-1]}")) if names else None


def _version(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(read_text(spark, f"{path}/_commits/{version:08d}.json"))


def _next_version(spark: SparkSession, path: str) -> int:
    names = _commit_names(spark, path)
    return int(names[-1].split(".")[0]) + 1 if names else 1


def _place(path: str) -> tuple[str, str]:
    """Folder and name of a table."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return folder, name


def current_commit(spark: SparkSession, path: str) -> dict | None:
    """The commit of a table that counts, or None before the first load: the one its folder names, else the latest."""
    folder, name = _place(path)
    together = _latest(spark, folder) if folder else None
    if together is None:
        return _latest(spark, path)
    return _version(spark, path, together["tables"][name]) if name in together["tables"] else None


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables that were loaded together, as of one commit of their folder."""
    together = _latest(spark, folder)
    if together is None:
        raise ExtractError(f"no tables at {folder}")
    return {n: _read_commit(spark, f"{folder}/{n}", _version(spark, f"{folder}/{n}", v)) for n, v in together["tables"].items()}


# A load id of the form ``source#number``: numbers of a source only grow.
_NUMBERED = re.compile(r"(?s)(.*)#(\d+)")


def _load_of(load_id: str) -> tuple[str, int]:
    numbered = _NUMBERED.fullmatch(load_id)
    return (numbered[1], int(numbered[2])) if numbered else (load_id, 0)


def _loads(commit: dict | None) -> dict[str, int]:
    """Highest load number of each source in a commit; commits from before the ledger have their own load only."""
    if commit is None:
        return {}
    if "loads" in commit:
        return commit["loads"]
    return dict([_load_of(commit["load_id"])]) if commit.get("load_id") else {}


def _applied(commit: dict | None, load_id: str | None) -> bool:
    if commit is None or load_id is None:
        return False
    source, number = _load_of(load_id)
    return _loads(commit).get(source, -1) >= number


def _loads_with(commit: dict | None, load_id: str | None) -> dict[str, int]:
    return _loads(commit) | (dict([_load_of(load_id)]) if load_id is not None else {})


def read_table(spark: SparkSession, path: str, parts: Sequence[int] | None = None) -> DataFrame:
    """The table as of its latest commit; ``parts`` restricts the read to some of its parts."""
    commit = current_commit(spark, path)
    if commit is None:
        raise ExtractError(f"no table at {path}")
    return _read_commit(spark, path, commit, parts)


def _read_commit(spark: SparkSession, path: str, commit: dict, parts: Sequence[int] | None = None) -> DataFrame:
    base, changed = _base_and_changes(spark, path, commit, parts)
    return base if changed is None else without_keys(base, changed, commit["primary_key"]).unionByName(changed)


def _base_and_changes(spark: SparkSession, path: str, commit: dict, parts: Sequence[int] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the base, and the last row of each key in the deltas, both with the columns of the commit."""
    schema = T.StructType.fromJson(commit["schema"])
    types = {f.name: f.dataType for f in schema.fields}
    own = T.StructType.fromJson(commit.get("base_schema", commit["schema"]))
    folders = [f for p in commit["parts"] if parts is None or int(p) in parts for f in _part_folders(commit["parts"], p)]
    base = spark.read.schema(own).parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], own)
    base = conform(base, types)
    if not commit.get("deltas"):
        return base, None
    key = commit["primary_key"]
    rows = [
        conform(spark.read.schema(T.StructType.fromJson(d["schema"])).parquet(f"{path}/{d['folder']}"), types).withColumn(PART, F.lit(k))
        for k, d in enumerate(commit["deltas"])
    ]
    changed = rows[0] if len(rows) == 1 else reduce(DataFrame.unionByName, rows)
    changed = changed.drop(PART) if len(rows) == 1 else latest_rows(changed, key, (PART,))
    if parts is not None:
        changed = changed.where(_part_column(key, commit["n_parts"]).isin(list(parts)))
    return base, changed


def _part_folders(parts: Mapping[str, str | list[str]], part: str) -> list[str]:
    """Folders of a part: one, or several when deltas were put beside it."""
    found = parts.get(part, [])
    return [found] if isinstance(found, str) else found


def _part_column(primary_key: Sequence[str], parts: int) -> Column:
    # Hash of the text form, so that a key keeps its part when a column changes from integer to numeric.
    if parts == 1 or not primary_key:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[_key_text(k) for k in primary_key]), F.lit(parts)).cast("int")


def _key_text(name: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("\u0000")), r"\.0$", "")


def _commit(df: DataFrame, path: str, kept: Mapping[str, str | list[str]], info: dict, base: dict | None, publish: bool) -> dict:
    """Write the parts of ``df`` as files of a new version, beside the parts that are ``kept``, and record the commit."""
    spark = df.sparkSession
    version = _next_version(spark, path)
    # The folder name carries a random part: a load that died half way never mixes with its rerun.
    folder = f"v{version:08d}-{uuid.uuid4().hex[:8]}"
    # Rebalance brings the rows of a part together for few, large files and splits a part that is hot.
    rows = df.hint("rebalance", PART) if info["n_parts"] > 1 else df
    rows.write.partitionBy(PART).parquet(f"{path}/{folder}")
    written = [n for n in list_names(spark, f"{path}/{folder}") if n.startswith(f"{PART}=")]
    parts = dict(kept)
    for name in written:
        part = name.split("=", 1)[1]
        beside = _part_folders(kept, part)
        parts[part] = [*beside, f"{folder}/{name}"] if beside else f"{folder}/{name}"
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name != PART])
    n_rows = spark.read.parquet(*[f"{path}/{f}" for p in parts for f in _part_folders(parts, p)]).count() if parts else 0
    commit = {"version": version, "schema": schema.jsonValue(), "parts": parts, "base_rows": n_rows, "deltas": [], **info}
    return _record(spark, path, commit, base, publish)


def _record(spark: SparkSession, path: str, commit: dict, base: dict | None, publish: bool) -> dict:
    version = commit["version"]
    if not write_text(spark, f"{path}/_commits/{version:08d}.json", json.dumps(commit)):
        raise ExtractError(f"another load committed version {version} of {path} first")
    if publish:
        _publish(spark, path, commit, base)
    return commit


def _publish(spark: SparkSession, path: str, commit: dict, base: dict | None) -> None:
    """Name a version in the commit of the table's folder, if it has one and nothing else was loaded on ``base``."""
    folder, name = _place(path)
    while True:
        together = _latest(spark, folder) if folder else None
        if together is None:
            return
        if together["tables"].get(name) != (base["version"] if base else None):
            raise ExtractError(f"another load of {path} was committed first")
        if _record_folder(spark, folder, together, {name: commit["version"]}):
            return


def _record_folder(spark: SparkSession, folder: str, together: dict, versions: Mapping[str, int]) -> bool:
    """The next commit of a folder; False when another one came first."""
    following = {"version": together["version"] + 1, "tables": together["tables"] | dict(versions)}
    return write_text(spark, f"{folder}/_commits/{following['version']:08d}.json", json.dumps(following))


def _open_folder(spark: SparkSession, folder: str) -> dict:
    """The commit of a folder; its first one names the tables that are there already."""
    while True:
        together = _latest(spark, folder)
        if together is not None:
            return together
        there = {n: _latest(spark, f"{folder}/{n}") for n in list_names(spark, folder) if not n.startswith((".", "_"))}
        _record_folder(spark, folder, {"version": 0, "tables": {}}, {n: c["version"] for n, c in there.items() if c is not None})


def write_full(df: DataFrame, path: str, spec: TableSpec, *, parts: int = 1, load_id: str | None = None, publish: bool = True, profile: DataFrame | None = None) -> dict:
    """Replace the whole table, unless this load is in it already. ``publish=False`` leaves naming the version to the caller."""
    require_table_name(spec.name)
    require_key_columns(df.columns, spec.primary_key, spec.name)
    previous = current_commit(df.sparkSession, path)
    if _applied(previous, load_id):
        return previous
    info = {"n_parts": parts if spec.primary_key else 1, "primary_key": list(spec.primary_key), "load_id": load_id, "loads": _loads_with(previous, load_id)}
    info["profile"] = None if profile is None else profile_text(profile)
    rows = df.withColumn(PART, _part_column(spec.primary_key, info["n_parts"]))
    return _commit(rows, path, {}, info, previous, publish)


def write_upsert(
    batch: DataFrame,
    path: str,
    spec: TableSpec,
    *,
    parts: int = 16,
    order: Sequence[str] = BATCH_ORDER,
    load_id: str | None = None,
    publish: bool = True,
    profile: DataFrame | None = None,
) -> dict:
    """Upsert a batch by primary key; in-batch copies of a key are settled by ``order``, last wins.

    A ``load_id`` that the table already holds is not loaded again: the same one, or of ``source#number`` a number
    up to the highest of that source. ``parts`` counts for the first load. The ``profile`` of the documents behind the
    batch is merged into the table's with the same commit, see ``table_profile``.
    """
    spark = batch.sparkSession
    require_key_for_incremental(True, spec.primary_key)
    require_key_columns(batch.columns, spec.primary_key, spec.name)
    order = [c for c in order if c in batch.columns]
    latest = latest_rows(batch, spec.primary_key, order) if order else batch.dropDuplicates(list(spec.primary_key))
    commit = current_commit(spark, path)
    if commit is None:
        return write_full(latest, path, spec, parts=parts, load_id=load_id, publish=publish, profile=profile)
    if _applied(commit, load_id):
        return commit
    if list(spec.primary_key) != commit["primary_key"]:
        raise ExtractError(f"table '{spec.name}' is keyed by {commit['primary_key']}, not by {list(spec.primary_key)}")
    base_schema = T.StructType.fromJson(commit["schema"])
    types = common_types(base_schema, latest.schema)
    schema = T.StructType([T.StructField(n, t, True) for n, t in types.items()])
    with staging_scope(spark):
        version, known = _next_version(spark, path), commit.get("profile")
        if profile is not None:
            known = profile_text(profile if known is None else merge_profiles(profile_of_text(spark, known), profile))
        folder = f"v{version:08d}-{uuid.uuid4().hex[:8]}"
        conform(latest, types).write.parquet(f"{path}/{folder}")
        n_rows = spark.read.schema(schema).parquet(f"{path}/{folder}").count()
        deltas = [*commit.get("deltas", []), {"folder": folder, "schema": schema.jsonValue(), "rows": n_rows}]
        merged = commit | {
            "version": version, "schema": schema.jsonValue(), "load_id": load_id, "loads": _loads_with(commit, load_id), "deltas": deltas,
            "base_schema": commit.get("base_schema", commit["schema"]), "profile": known,
        }
        if sum(d["rows"] for d in deltas) <= DELTA_SHARE * commit.get("base_rows", 0) and len(deltas) <= MOST_DELTAS:
            return _record(spark, path, merged, commit, publish)
        base, changed = _base_and_changes(spark, path, merged)
        keys = [F.col(f"`{k}`") for k in spec.primary_key]
        # Only keys travel here; where all of them are new, the base need not be written again.
        added = merged["base_schema"] == merged["schema"] and base.select(*keys).intersect(changed.select(*keys)).isEmpty()
        rows = changed if added else without_keys(base, changed, spec.primary_key).unionByName(changed)
        rows = rows.withColumn(PART, _part_column(spec.primary_key, commit["n_parts"]))
        done = _commit(rows, path, commit["parts"] if added else {}, {k: merged[k] for k in ("n_parts", "primary_key", "load_id", "loads", "profile")}, commit, publish)
        delete(spark, f"{path}/{folder}")
        return done


def table_profile(spark: SparkSession, path: str) -> DataFrame | None:
    """The profile of all documents loaded into a table with one, or None."""
    commit = current_commit(spark, path)
    kept = commit.get("profile") if commit else None
    return None if kept is None else profile_of_text(spark, kept)


def compact(spark: SparkSession, path: str) -> dict:
    """Merge the deltas of a table into its base now, so that readers need not."""
    commit = current_commit(spark, path)
    if commit is None:
        raise ExtractError(f"no table at {path}")
    if not commit.get("deltas"):
        return commit
    rows = _read_commit(spark, path, commit).withColumn(PART, _part_column(commit["primary_key"], commit["n_parts"]))
    info = {k: commit[k] for k in ("n_parts", "primary_key", "load_id")} | {"loads": _loads(commit), "profile": commit.get("profile")}
    return _commit(rows, path, {}, info, commit, True)


def _folders(commit: dict) -> set[str]:
    return {*(f for p in commit["parts"] for f in _part_folders(commit["parts"], p)), *(d["folder"] for d in commit.get("deltas", []))}


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop all but the last ``keep`` commits and the one that counts, and the folders only the dropped ones name.

    Not for use while a load of the same table is running.
    """
    if keep < 1:
        raise ExtractError("at least the latest version is kept")
    names = _commit_names(spark, path)
    counts = current_commit(spark, path)
    kept = set(names[-keep:]) | ({f"{counts['version']:08d}.json"} if counts else set())
    used = {f for n in kept for f in _folders(json.loads(read_text(spark, f"{path}/_commits/{n}")))}
    dropped = []
    for name in sorted(set(names) - kept):
        old = _folders(json.loads(read_text(spark, f"{path}/_commits/{name}")))
        for folder in old - used - set(dropped):
            delete(spark, f"{path}/{folder}")
            dropped.append(folder)
        delete(spark, f"{path}/_commits/{name}")
    return sorted(dropped)


def write_table(table: Table, path: str, **options) -> dict:
    """Full load or upsert, as the spec says."""
    if table.spec.incremental:
        return write_upsert(table.df, path, table.spec, **options)
    options.pop("order", None)
    return write_full(table.df, path, table.spec, **options)


def write_tables(tables: Mapping[str, Table], folder: str, **options) -> dict[str, dict]:
    """Load a parent and its children, all in the same mode, each under its own name, with one commit of the folder.

    Until that commit, readers and later loads see all tables as they were. It fails when anything else was committed
    in the folder meanwhile.
    """
    modes = {t.spec.incremental for t in tables.values()}
    if len(modes) > 1:
        raise ExtractError("all tables of one extraction are loaded in the same mode")
    for table in tables.values():
        require_key_for_incremental(table.spec.incremental, table.spec.primary_key)
        require_key_columns(table.df.columns, table.spec.primary_key, table.spec.name)
    if not tables:
        return {}
    spark, folder = next(iter(tables.values())).df.sparkSession, folder.rstrip("/")
    together = _open_folder(spark, folder)
    done = {name: write_table(table, f"{folder}/{name}", publish=False, **options) for name, table in tables.items()}
    versions = {name: commit["version"] for name, commit in done.items()}
    if together["tables"] | versions != together["tables"] and not _record_folder(spark, folder, together, versions):
        raise ExtractError(f"another load was committed in {folder} first")
    return done


def zero_row_table(spark: SparkSession, spec: TableSpec) -> DataFrame | None:
    """The table of an extraction that returned nothing: its key columns, or None when it has none."""
    if not spec.primary_key:
        return None
    fields = [f"`{k}` {SPARK_TYPE[spec.types.get(k, 'string')]}" for k in spec.primary_key]
    return spark.createDataFrame([], ", ".join(fields))
