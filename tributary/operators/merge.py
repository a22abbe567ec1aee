"""Primary-key upsert as plain DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.keys import require_key_columns
from tributary.session import stage
from tributary.spec import base_type

BATCH_ORDER = ("page_no", "ordinal")
NULL_SALTS = 64


def latest_rows(batch: DataFrame, primary_key: Sequence[str], order: Sequence[str] = BATCH_ORDER) -> DataFrame:
    """One row per key: the last by ``order``. The order columns are dropped.

    The rank filter is also applied before the shuffle (window group limit), so of a key that fills a
    third of the batch each task sends one row.
    """
    require_key_columns(batch.columns, primary_key)
    window = Window.partitionBy(*primary_key).orderBy(*[F.desc(c) for c in order])
    ranked = batch.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1)
    return ranked.drop("_rank", *[c for c in order if c not in primary_key])


def common_types(left: T.StructType, right: T.StructType) -> dict[str, T.DataType]:
    """Type per column that holds both sides: numbers widen to double, other conflicts become text."""
    types = {f.name: f.dataType for f in left.fields}
    for field in right.fields:
        known = types.get(field.name, field.dataType)
        if known == field.dataType:
            types[field.name] = known
        elif {base_type(known), base_type(field.dataType)} <= {"integer", "numeric"}:
            both = base_type(known) == base_type(field.dataType) == "integer"
            types[field.name] = T.LongType() if both else T.DoubleType()
        else:
            types[field.name] = T.StringType()
    return types


def conform(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """``df`` with exactly these columns; absent ones are NULL."""
    known = df.schema

    def column(name: str, data_type: T.DataType) -> Column:
        if name not in known.names:
            return F.lit(None).cast(data_type).alias(name)
        same = known[name].dataType == data_type
        return F.col(f"`{name}`") if same else F.col(f"`{name}`").cast(data_type).alias(name)

    return df.select(*[column(n, t) for n, t in types.items()])


def without_keys(base: DataFrame, batch: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``batch``; NULL equals NULL. Only keys of the batch travel.

    Base rows with a NULL in their key are spread over ``NULL_SALTS`` keys, each of which such a key of the batch meets.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in primary_key])
    salts = F.when(any_null, F.sequence(F.lit(0), F.lit(NULL_SALTS - 1))).otherwise(F.array(F.lit(0)))
    keys = batch.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(primary_key)], F.explode(salts).alias("_salt"))
    salt = F.when(any_null, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in base.dtypes if t != "variant"]), F.lit(NULL_SALTS)).cast("int")).otherwise(0)
    salted = base.withColumn("_base_salt", salt)
    same = [salted[f"`{k}`"].eqNullSafe(keys[f"_key_{i}"]) for i, k in enumerate(primary_key)]
    same.append(salted["_base_salt"] == keys["_salt"])
    return salted.join(keys, reduce(lambda a, b: a & b, same), "left_anti").drop("_base_salt")


def upsert(base: DataFrame, batch: DataFrame, primary_key: Sequence[str], order: Sequence[str] = BATCH_ORDER) -> DataFrame:
    """Rows of the batch replace rows with the same key, the other rows of ``base`` stay.

    The batch is used twice, so it is reduced once and staged.
    """
    require_key_columns(base.columns, primary_key)
    latest = stage(latest_rows(batch, primary_key, order), "batch")
    types = common_types(base.schema, latest.schema)
    kept = without_keys(conform(base, types), latest, primary_key)
    return kept.unionByName(conform(latest, types))
