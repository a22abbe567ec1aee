"""Structured search filters.

``search_filter(df, "amount", "greaterThan", 10)`` keeps the rows an operator matches. Rules that hold for
every operator:

* three-valued logic as in SQL: NULL matches nothing but ``empty``, also under the negated operators;
* text is compared without regard to case;
* dates are whole days, weeks start on Monday, and a value may be the name of a period (``lastMonth``).

Values become literals of the column's own type, so number and date filters reach the file scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ExtractError
from tributary.functions.dates import Period, relative_range, utc_now

# The operators of each kind of field.
NUMBER_OPERATORS = (
    "between", "empty", "equalTo", "greaterThan", "greaterThanOrEqualTo", "lessThan", "lessThanOrEqualTo",
    "notBetween", "notEmpty", "notEqualTo", "notGreaterThan", "notGreaterThanOrEqualTo", "notLessThan",
    "notLessThanOrEqualTo",
)
OPERATORS = {
    "string": (
        "contains", "doesNotContain", "doesNotStartWith", "empty", "hasKeywords", "is", "isNot", "notEmpty",
        "startsWith",
    ),
    "long": NUMBER_OPERATORS,
    "double": NUMBER_OPERATORS,
    "text_number": NUMBER_OPERATORS,
    "date": (
        "after", "before", "empty", "notAfter", "notBefore", "notEmpty", "notOn", "notOnOrAfter",
        "notOnOrBefore", "notWithin", "on", "onOrAfter", "onOrBefore", "within",
    ),
    "select": ("anyOf", "noneOf"),
    "boolean": ("is",),
}


def field_kind(data_type: T.DataType) -> str:
    """Kind of field a column is searched as, unless the caller says otherwise."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "long"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "double"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if isinstance(data_type, T.ArrayType):
        return "select"
    return "string"


def _operator(kind: str, name: str) -> str:
    """``ON_OR_AFTER`` and ``onOrAfter`` are the same operator."""
    wanted = name.replace("_", "").lower()
    for known in OPERATORS[kind]:
        if known.lower() == wanted:
            return known
    raise ExtractError(f"operator '{name}' does not apply to a {kind} field; it takes {', '.join(OPERATORS[kind])}")


def condition(
    df: DataFrame,
    field: str,
    op: str,
    value: Any = None,
    value2: Any = None,
    *,
    kind: str | None = None,
    as_of: date | None = None,
    fiscal_start_month: int = 1,
    date_format: str | None = None,
) -> Column:
    """The filter as a boolean column of ``df``. Dates kept as text need their ``date_format``; what doesn't fit it is NULL."""
    data_type = df.schema[field].dataType
    column = F.col(f"`{field}`")
    if kind is None:
        kind = "select" if op.replace("_", "").lower() in ("anyof", "noneof") else field_kind(data_type)
    if kind not in OPERATORS:
        raise ExtractError(f"unknown field kind '{kind}'")
    name = _operator(kind, op)
    if isinstance(value, (list, tuple)) and kind != "select" and value2 is None and len(value) == 2:
        value, value2 = value
    if name in ("empty", "notEmpty"):
        blank = column.isNull() | (column == "") if isinstance(data_type, T.StringType) else column.isNull()
        return blank if name == "empty" else ~blank
    if value is None:
        raise ExtractError(f"operator '{name}' needs a value")
    if kind == "string":
        return _text(column, name, str(value))
    if kind == "boolean":
        return column == F.lit(bool(value))
    if kind == "select":
        return _select(column, data_type, name, value)
    if kind == "date":
        period = _period(value, value2, as_of or utc_now(), fiscal_start_month)
        if isinstance(data_type, T.StringType):
            if date_format is None:
                raise ExtractError(f"field '{field}' holds text; date_format says how its dates are written")
            column, data_type = F.try_to_date(column, date_format), T.DateType()
        return _date(column, data_type, name, period)
    if kind == "text_number":
        column, data_type = column.try_cast("decimal(38,10)"), T.DecimalType(38, 10)
    return _number(column, data_type, name, value, value2)


def search_filter(df: DataFrame, field: str, op: str, value: Any = None, value2: Any = None, **options: Any) -> DataFrame:
    """Rows of ``df`` that match; see ``condition`` for the options."""
    return df.where(condition(df, field, op, value, value2, **options))


def _text(column: Column, name: str, value: str) -> Column:
    text, wanted = F.lower(column), value.lower()
    if name in ("is", "isNot"):
        return text == wanted if name == "is" else text != wanted
    if name in ("contains", "doesNotContain"):
        return text.contains(wanted) if name == "contains" else ~text.contains(wanted)
    if name in ("startsWith", "doesNotStartWith"):
        return text.startswith(wanted) if name == "startsWith" else ~text.startswith(wanted)
    # hasKeywords: every word of the value occurs somewhere.
    words = wanted.split()
    if not words:
        raise ExtractError("hasKeywords needs at least one word")
    match = text.contains(words[0])
    for word in words[1:]:
        match = match & text.contains(word)
    return match


def _number(column: Column, data_type: T.DataType, name: str, value: Any, value2: Any) -> Column:
    def literal(v: Any) -> Column:
        # Of the column's own type where that holds the value exactly (so it reaches the scan), else a wider decimal.
        if not isinstance(data_type, (T.IntegralType, T.DecimalType)):
            return F.lit(v).cast(data_type)
        exact = Decimal(str(v))
        if not exact.is_finite():
            return F.lit(float(v))
        fits = _fits(exact, data_type)
        return F.lit(exact).cast(data_type) if fits else F.lit(exact)

    negated = name.startswith("not")
    core = name[3:4].lower() + name[4:] if negated else name
    if core == "between":
        if value2 is None:
            raise ExtractError(f"operator '{name}' needs two values")
        match = column.between(literal(value), literal(value2))
    else:
        compare: dict[str, Callable[[Column, Column], Column]] = {
            "equalTo": lambda a, b: a == b,
            "lessThan": lambda a, b: a < b,
            "greaterThan": lambda a, b: a > b,
            "lessThanOrEqualTo": lambda a, b: a <= b,
            "greaterThanOrEqualTo": lambda a, b: a >= b,
        }
        match = compare[core](column, literal(value))
    return ~match if negated else match


_WHOLE_BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _fits(value: Decimal, data_type: T.DataType) -> bool:
    """Whether the type holds the value exactly."""
    if isinstance(data_type, T.DecimalType):
        step = Decimal(1).scaleb(-data_type.scale)
        return value % step == 0 and abs(value) < Decimal(10) ** (data_type.precision - data_type.scale)
    most = 1 << _WHOLE_BITS[type(data_type)]
    return value == value.to_integral_value() and -most <= value < most


def _period(value: Any, value2: Any, as_of: date, fiscal_start_month: int) -> Period:
    def one(v: Any) -> Period:
        if isinstance(v, str):
            try:
                v = date.fromisoformat(v[:10])
            except ValueError:
                return relative_range(v, as_of, fiscal_start_month)
        day = v.date() if isinstance(v, datetime) else v
        return day, day + timedelta(days=1)

    start, end = one(value)
    return (start, one(value2)[1]) if value2 is not None else (start, end)


def _date(column: Column, data_type: T.DataType, name: str, period: Period) -> Column:
    start, end = (F.lit(day.isoformat()).cast(data_type) for day in period)
    negated = name.startswith("not")
    core = name[3:4].lower() + name[4:] if negated else name
    if core in ("on", "within"):
        match = (column >= start) & (column < end)
    elif core == "before":
        match = column < start
    elif core == "after":
        match = column >= end
    elif core == "onOrBefore":
        match = column < end
    else:
        match = column >= start
    return ~match if negated else match


def _select(column: Column, data_type: T.DataType, name: str, value: Any) -> Column:
    values: Sequence[Any] = value if isinstance(value, (list, tuple, set)) else [value]
    values = list(values)
    kind = data_type.elementType if isinstance(data_type, T.ArrayType) else data_type
    if isinstance(kind, T.StringType):
        values = [str(v).lower() for v in values]
        column = F.transform(column, F.lower) if isinstance(data_type, T.ArrayType) else F.lower(column)
    if isinstance(data_type, T.ArrayType):
        match = F.arrays_overlap(column, F.array(*[F.lit(v).cast(kind) for v in values]))
    else:
        match = column.isin(values)
    return match if name == "anyOf" else ~match
