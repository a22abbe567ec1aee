"""JSON text and VARIANT column helpers, all evaluated inside the JVM.

Two representations are used side by side. Key order and number spelling live only in the text, so
removing or masking a key is done on the text with one left-to-right regular expression pass. Typed
access goes through VARIANT.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A complete JSON string. Possessive quantifiers keep matching linear and free of recursion.
_STRING = r'"(?:[^"\\]++|\\.)*+"'

# How many brackets deep the *value* of a removed or masked key may nest. What nests deeper ends in an error.
_VALUE_DEPTH = 100

# A member that stands behind a whole text, so that text after its first value shows.
_END = "end of the text"


def _value_pattern() -> str:
    container = r"(?!)"
    for _ in range(_VALUE_DEPTH):
        container = r'[\[{](?:[^"\[\]{}]++|' + _STRING + "|" + container + r")*+[\]}]"
    return "(?:" + _STRING + "|" + container + r'|[^\s,\]}"\[{]++)'


_VALUE = _value_pattern()


def _escaped(key: str) -> str:
    """A key as it is spelled inside JSON, as a literal pattern."""
    return re.escape(json.dumps(key, ensure_ascii=False)[1:-1])


def _spelled(key: str) -> str:
    """A key in any of its spellings: JSON lets every character be written as an escape."""

    def unit(code: int) -> str:
        return r"\\u" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in f"{code:04x}")

    out = []
    for c in key:
        data = c.encode("utf-16-be")
        escape = "".join(unit(int.from_bytes(data[k : k + 2], "big")) for k in range(0, len(data), 2))
        out.append(f"(?:{_escaped(c)}|{escape}" + (r"|\\/" if c == "/" else "") + ")")
    return "".join(out)


def _key_token(keys: Iterable[str], spell: Callable[[str], str] = _escaped) -> str:
    """A member name and its colon.

    Inside a string every quote is escaped, so a quote without a backslash before it that is followed by
    the name, a quote and a colon can only be a member name.
    """
    names = "|".join(spell(k) for k in keys)
    return rf'(?<!\\)"(?:{names})"\s*+:\s*+'


def _has_escapes(text: Column) -> Column:
    return text.contains("\\u") | text.contains("\\/")


def _unless_left(text: Column, wrong: str, what: str) -> Column:
    """``text``, or an error where the pattern is still in it: a value that nests too deep is not passed over."""
    message = F.lit(f"a member to be {what} has a value nested over {_VALUE_DEPTH} brackets deep")
    return F.when(text.rlike("(?s)" + wrong), F.raise_error(message).cast("string")).otherwise(text)


def drop_keys(text: Column | str, keys: Iterable[str] = ("links",)) -> Column:
    """Remove every member named in ``keys`` at any depth; all other text stays as it was."""
    keys = tuple(keys)
    return drop_last_members(drop_followed_members(text, keys), keys)


def drop_followed_members(text: Column | str, keys: Iterable[str] = ("links",)) -> Column:
    """Remove the named members that another member follows, with the comma between.

    The patterns start with a literal, which the regex engine finds by skipping ahead. Navigation keys
    usually come first in their object, so this pass alone mostly does all the work.
    """
    text = F.col(text) if isinstance(text, str) else text
    for key in keys:
        name = f'"{_escaped(key)}"'
        text = F.regexp_replace(text, rf"(?s){name}(?<!\\{name})\s*+:\s*+{_VALUE}\s*+,\s*+", "")
    return text


def drop_last_members(text: Column | str, keys: Iterable[str] = ("links",)) -> Column:
    """Remove the named members wherever they are, with the comma before (or, for the first, after) them.

    Texts that do not hold the names any more are passed over.
    """
    text = F.col(text) if isinstance(text, str) else text
    keys = tuple(keys)

    def dropped(spell: Callable[[str], str]) -> Column:
        token = _key_token(keys, spell)
        member = token + _VALUE
        return _unless_left(F.regexp_replace(text, r"(?s),\s*+" + member + "|" + member + r"\s*+,?+", ""), token, "removed")

    left = F.lit(False)
    for key in keys:
        left = left | text.contains(f'"{json.dumps(key, ensure_ascii=False)[1:-1]}"')
    return F.when(_has_escapes(text), dropped(_spelled)).when(left, dropped(_escaped)).otherwise(text)


def mask_keys(text: Column | str, keys: Iterable[str], replacement: str = "REDACTED") -> Column:
    """Replace the value of every member named in ``keys``, at any depth, by a fixed JSON string."""
    text = F.col(text) if isinstance(text, str) else text
    keys = tuple(keys)

    def masked(spell: Callable[[str], str]) -> Column:
        token = _key_token(keys, spell)
        done = F.regexp_replace(text, "(?s)(" + token + ")" + _VALUE, '$1"' + replacement + '"')
        return _unless_left(done, token + '(?!"' + re.escape(replacement) + '")', "masked")

    return F.when(_has_escapes(text), masked(_spelled)).otherwise(masked(_escaped))


def framed(text: Column | str) -> Column:
    """A text as the first of two members, ``v`` and a mark of its end."""
    return F.concat(F.lit('{"v":'), F.col(text) if isinstance(text, str) else text, F.lit(f',"{_END}":true}}'))


def parse_whole(text: Column | str) -> Column:
    """The text as VARIANT; NULL unless it is one JSON value with nothing but blanks around it."""
    doc = F.try_parse_json(framed(text))
    whole = (F.size(get(doc, "$", "map<string,variant>")) == 2) & get(doc, path_of(_END), "boolean")
    return F.when(whole, get(doc, "$.v"))


def path_of(*keys: str) -> str:
    """Variant path of nested object keys, quoted so that any character is allowed in a key."""
    steps = []
    for key in keys:
        quote = "'" if '"' in key else '"'
        if quote in key or "\\" in key:
            raise ValueError(f"key {key!r} cannot be addressed by a variant path")
        steps.append(f"[{quote}{key}{quote}]")
    return "$" + "".join(steps)


def dotted_path(path: str) -> str:
    """``a.b.c`` as a variant path; the empty path is the document itself."""
    return path_of(*path.split(".")) if path else "$"


def get(value: Column | str, path: str, as_type: str = "variant") -> Column:
    """Value at ``path``; a missing key, a non-object step or a failed cast gives NULL."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, as_type)


def is_object(value: Column, path: str = "$") -> Column:
    return get(value, path, "struct<>").isNotNull()


def is_array(value: Column, path: str = "$") -> Column:
    # Elements without members: nothing of them is copied.
    return get(value, path, "array<struct<>>").isNotNull()


def all_objects(array: Column) -> Column:
    """True when every element of an ``array<variant>`` is an object (so true for an empty one)."""
    return F.forall(array, lambda item: is_object(item))


def is_object_list(value: Column) -> Column:
    """A non-empty array of objects only."""
    # What is not an object is NULL among the elements and sorts first. No lambda, which would end code generation.
    return F.get(F.sort_array(get(value, "$", "array<struct<>>")), F.lit(0)).isNotNull()


def is_sublist(value: Column) -> Column:
    """An object whose ``items`` is an array, or a non-empty array of objects only."""
    return is_array(value, path_of("items")) | is_object_list(value)


def is_falsy(value: Column) -> Column:
    """NULL, JSON null, false, 0, the empty string and empty containers."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    text = get(value, "$", "string")
    return (
        (kind == "VOID")
        | ((kind == "BOOLEAN") & (text == "false"))
        | ((kind == "STRING") & (text == ""))
        | (kind.rlike("^(BIGINT|DECIMAL|DOUBLE)") & (get(value, "$", "double") == 0))
        | (kind.rlike("^(OBJECT|ARRAY)") & text.isin("{}", "[]"))
    )
