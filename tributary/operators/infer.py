"""Columns and types of ragged documents.

``profile`` is the one aggregation behind column order, column types, sublist detection and line-key
derivation. It keeps only counters and minimum positions, all fixed-width, so the partial aggregate is
a hash aggregate and what is shuffled is one small row per key and task, whatever the number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ExtractError
from tributary.functions.jsontext import get, is_array, is_object, is_sublist, path_of
from tributary.spec import SPARK_TYPE

# Fixed value: rows looked at when a bounded sample is asked for.
SCHEMA_SAMPLE_SIZE = 1000

# More distinct keys than this are data, not columns; callers may set another bound.
MAX_COLUMNS = 20_000

_SCALARS = ("boolean", "integer", "numeric", "string")


def value_type(value: Column) -> Column:
    """Base type of one VARIANT value: a scalar type, ``container`` or ``null``."""
    return kind_type(F.schema_of_variant(value))


def kind_type(kind: Column) -> Column:
    """The same from the schema text of the value."""
    number = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    return (
        F.when(kind.isNull() | (kind == "VOID"), "null")
        .when(kind == "STRING", "string")
        .when(kind == "BIGINT", "integer")
        .when(kind == "BOOLEAN", "boolean")
        .when(number, "numeric")
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), "container")
        .otherwise("string")
    )


def profile(documents: DataFrame, *, sample: int | None = None) -> DataFrame:
    """One row per top-level key of ``ordinal, raw, doc`` rows.

    ``sample`` restricts the profile (never the data) to the first rows by ordinal.
    """
    if sample is not None:
        # The ordinal of the last sampled row; what is sorted per task and sent is at most ``sample`` numbers.
        head = documents.select("ordinal").orderBy("ordinal").limit(sample)
        documents = documents.where(F.col("ordinal") <= F.lit(head.agg(F.max("ordinal")).first()[0]))
    base = documents.select("ordinal", "doc", F.json_object_keys("raw").alias("keys"))
    exploded = base.lateralJoin(base.sparkSession.tvf.variant_explode_outer(F.col("doc").outer()).alias("member"))
    described = exploded.select(
        F.col("member.key").alias("column"),
        (F.col("member.pos") == 0).alias("leads"),
        F.col("ordinal").alias("seen"),
        F.array_position("keys", F.col("member.key")).alias("position"),
        F.col("member.value").alias("value"),
        (is_object(F.col("member.value")) | is_array(F.col("member.value"))).alias("container"),
    )
    # Only containers are looked into, and only scalars are asked for their schema: that of a container is put together
    # from all that is in it.
    kind = F.when(F.col("container"), "OBJECT").otherwise(F.schema_of_variant("value"))
    members = described.select(
        "column",
        "leads",
        "seen",
        "position",
        F.when(F.col("container"), is_sublist(F.col("value"))).otherwise(F.lit(False)).alias("sublist"),
        kind.alias("kind"),
    ).withColumn("type", kind_type(F.col("kind")))
    seen, kind, sublist = F.col("seen"), F.col("type"), F.col("sublist")
    firsts = [F.min(F.when(kind == t, seen)).alias(f"first_{t}") for t in _SCALARS]
    return members.groupBy("column").agg(
        F.min(seen).alias("first_seen"),
        F.min_by("position", seen).alias("first_position"),
        F.min(F.when(~sublist, seen)).alias("first_inline"),
        F.min_by("position", F.when(~sublist, seen)).alias("inline_position"),
        F.min(F.when(sublist, seen)).alias("first_sublist"),
        *firsts,
        F.count_if(kind != "null").alias("n_values"),
        F.count_if(kind == "container").alias("n_containers"),
        F.count_if(sublist).alias("n_sublists"),
        F.count_if(F.coalesce("leads", F.lit(True))).alias("n_leads"),
    )


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all documents from those of parts of them, in any order.

    Ordinals must go on from part to part. A document that is in two parts is counted twice, but leads to the same
    columns and types.
    """
    first = {"first_position": "first_seen", "inline_position": "first_inline"}
    stacked = reduce(DataFrame.unionByName, profiles)

    def merged(name: str) -> Column:
        if name in first:
            at = F.min_by(name, F.when(F.col(first[name]).isNotNull(), F.struct(first[name], name)))
        elif name.startswith("n_"):
            at = F.sum(name).cast("bigint")
        else:
            at = F.min(name)
        return at.alias(name)

    return stacked.groupBy("column").agg(*[merged(n) for n in stacked.columns if n != "column"])


def profile_text(profiled: DataFrame, max_columns: int = MAX_COLUMNS) -> str:
    """A profile as text to keep: one row per column, with the same bound as ``collect_profile``."""
    rows = profiled.select(F.to_json(F.struct("*"))).limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ExtractError(f"more than {max_columns} distinct keys: the keys of these documents are data")
    return json.dumps({"schema": profiled.schema.jsonValue(), "rows": [r[0] for r in rows]})


def profile_of_text(spark: SparkSession, text: str) -> DataFrame:
    """A profile that was kept as text."""
    kept = json.loads(text)
    rows = spark.createDataFrame([(r,) for r in kept["rows"]], "value string")
    return rows.select(F.from_json("value", T.StructType.fromJson(kept["schema"])).alias("row")).select("row.*")


@dataclass(frozen=True)
class ColumnInfo:
    """What the documents say about one key. Rows are ordinals, positions are those of the key inside the row."""

    name: str
    first_seen: tuple[int, int]
    first_inline: tuple[int, int] | None
    first_sublist: int | None
    firsts: tuple[tuple[str, int], ...]
    n_values: int
    n_sublists: int
    n_containers: int

    def type(self, mode: str = "widen", *, sublist_text: bool = False) -> str:
        """Base type. ``first``: that of the first scalar. ``widen``: one that holds every scalar.

        With ``sublist_text`` a sublist counts as the text it is written as. Columns of containers and
        nulls only are text.
        """
        firsts = dict(self.firsts)
        if sublist_text and self.first_sublist is not None:
            firsts["string"] = min(firsts.get("string", self.first_sublist), self.first_sublist)
        if not firsts:
            return "string"
        if mode == "first":
            return min(firsts, key=firsts.__getitem__)
        if mode != "widen":
            raise ExtractError("type mode must be 'first' or 'widen'")
        if self.n_containers:
            # Scalars beside containers: only text holds both.
            return "string"
        if len(firsts) == 1:
            return next(iter(firsts))
        return "numeric" if set(firsts) == {"integer", "numeric"} else "string"


@dataclass(frozen=True)
class Profile:
    """Column infos in first-seen order, and the number of documents."""

    columns: tuple[ColumnInfo, ...]
    n_rows: int

    def __getitem__(self, name: str) -> ColumnInfo:
        return next(c for c in self.columns if c.name == name)

    def __contains__(self, name: str) -> bool:
        return any(c.name == name for c in self.columns)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def types(self, mode: str = "widen") -> dict[str, str]:
        return {c.name: c.type(mode) for c in self.columns}


def collect_profile(profiled: DataFrame, max_columns: int = MAX_COLUMNS) -> Profile:
    """Bring a profile to the driver: one row per column. More than ``max_columns`` of them are an error."""
    rows = profiled.limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ExtractError(f"more than {max_columns} distinct keys: the keys of these documents are data")
    infos = []
    for row in rows:
        if row["column"] is None:
            continue
        firsts = tuple((t, row[f"first_{t}"]) for t in _SCALARS if row[f"first_{t}"] is not None)
        infos.append(
            ColumnInfo(
                row["column"], (row["first_seen"], row["first_position"]),
                None if row["first_inline"] is None else (row["first_inline"], row["inline_position"]), row["first_sublist"], firsts,
                row["n_values"], row["n_sublists"], row["n_containers"],
            )
        )
    infos.sort(key=lambda c: (c.first_seen, c.name))
    return Profile(tuple(infos), sum(row["n_leads"] for row in rows))


def column_union(profiled: DataFrame) -> DataFrame:
    """``column, position``: every key, in order of first appearance (row order, then key order)."""
    names = collect_profile(profiled).names
    return profiled.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], "column string, position int")


def column_types(profiled: DataFrame, mode: str = "widen") -> DataFrame:
    """``column, type`` for every key, as a DataFrame; the rules of ``ColumnInfo.type``."""
    firsts = [F.struct(F.col(f"first_{t}").alias("seen"), F.lit(t).alias("type")) for t in _SCALARS]
    present = F.filter(F.array(*firsts), lambda f: f["seen"].isNotNull())
    if mode == "first":
        chosen = F.array_min(present)["type"]
    elif mode == "widen":
        kinds = F.transform(present, lambda f: f["type"])
        chosen = (
            F.when(F.col("n_containers") > 0, "string")
            .when(F.size(kinds) == 1, F.element_at(kinds, 1))
            .when((F.size(kinds) == 2) & ~F.array_contains(kinds, "boolean") & ~F.array_contains(kinds, "string"), "numeric")
            .otherwise("string")
        )
        chosen = F.when(F.size(kinds) > 0, chosen)
    else:
        raise ExtractError("type mode must be 'first' or 'widen'")
    known = profiled.where(F.col("column").isNotNull())
    return known.select("column", F.coalesce(chosen, F.lit("string")).alias("type"))


def typed(doc: str, name: str, base_type: str) -> Column:
    """Member ``name`` of a document as a column of the given base type; containers become JSON text."""
    return get(doc, path_of(name), SPARK_TYPE[base_type]).alias(name)


def to_columns(documents: DataFrame, columns: Sequence[str], types: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One column per name, in that order; a row without the key gets NULL."""
    return documents.select(*keep, *[typed("doc", c, types.get(c, "string")) for c in columns])


# Texts that say a value of another type, so that writing it gives the text again.
_SAYS = {"boolean": "^(true|false)$", "integer": "^(0|-?[1-9][0-9]{0,17})$", "numeric": r"^-?(0|[1-9][0-9]{0,14})(\.[0-9]{1,15})?$"}


def typed_texts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Text columns with the type that all their values are written in; ids with leading zeros stay text.

    One aggregation of counters over all rows, one row to the driver.
    """
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name not in keep]
    if not texts:
        return df
    counts = [F.count(F.col(f"`{n}`")).alias(f"{i} n") for i, n in enumerate(texts)]
    counts += [F.count_if(F.col(f"`{n}`").rlike(says)).alias(f"{i} {kind}") for i, n in enumerate(texts) for kind, says in _SAYS.items()]
    seen = df.agg(*counts).first().asDict()

    def column(name: str) -> Column:
        if name not in texts:
            return F.col(f"`{name}`")
        i = texts.index(name)
        kind = next((k for k in _SAYS if seen[f"{i} n"] and seen[f"{i} {k}"] == seen[f"{i} n"]), "string")
        return F.col(f"`{name}`").cast(SPARK_TYPE[kind]).alias(name)

    return df.select(*[column(n) for n in df.columns])


def align(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames with different columns; every row gets every column."""
    frames = iter(frames)
    result = next(frames)
    for frame in frames:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
