import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import jsontext, redact


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("r")).first()[0]


def without(value, keys):
    if isinstance(value, dict):
        return {k: without(v, keys) for k, v in value.items() if k not in keys}
    return [without(v, keys) for v in value] if isinstance(value, list) else value


def masked(value, keys):
    if isinstance(value, dict):
        return {k: "REDACTED" if k in keys else masked(v, keys) for k, v in value.items()}
    return [masked(v, keys) for v in value] if isinstance(value, list) else value


@pytest.mark.parametrize(
    "text,expected",
    [
        ('{"links":[],"id":1}', '{"id":1}'),
        ('{"id":1,"links":[{"rel":"self","href":"a]}"}]}', '{"id":1}'),
        ('{"a":{"links" : {"x":[1,{"y":2}]}, "b":0.0}}', '{"a":{"b":0.0}}'),
        ('{"a":1,"links":[],"b":2, "links":{}}', '{"a":1,"b":2}'),
        ('{"note":"\\"links\\":[1]","z":["links"]}', '{"note":"\\"links\\":[1]","z":["links"]}'),
        ('{"items":[{"links":3},{"links":null,"line":2}]}', '{"items":[{},{"line":2}]}'),
        ('{"links":1,"links":2}', "{}"),
        ('{"mylinks":[1],"links2":[2]}', '{"mylinks":[1],"links2":[2]}'),
    ],
)
def test_drop_keys(spark, text, expected):
    assert one(spark, text, jsontext.drop_keys("t")) == expected


keys = st.sampled_from(["links", "id", "items", "a,b", 'q"uote', "nonce"])
values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8)
    | st.sampled_from(['"links":[1]', "links", "\\", '{"links":1}']),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(keys, inner, max_size=4),
    max_leaves=20,
)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.dictionaries(keys, values, max_size=5), min_size=20, max_size=40), st.integers(0, 1))
def test_drop_and_mask_agree_with_a_tree_walk(spark, documents, compact):
    separators = (",", ":") if compact else (", ", " : ")
    texts = [json.dumps(d, separators=separators, ensure_ascii=False) for d in documents]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.select("i", jsontext.drop_keys("t").alias("d"), jsontext.mask_keys("t", ["nonce", "id"]).alias("m")).orderBy("i").collect()
    for document, row in zip(documents, found, strict=True):
        assert json.loads(row.d) == without(document, {"links"})
        assert json.loads(row.m) == masked(document, {"nonce", "id"})


def test_long_strings_and_many_members_do_not_overflow(spark):
    rng = random.Random(1)
    document = {"text": "x\\\" " * 50_000, "items": [{"links": [{"href": "h" * 50}], "n": rng.random()} for _ in range(20_000)]}
    assert json.loads(one(spark, json.dumps(document), jsontext.drop_keys("t"))) == without(document, {"links"})


def test_key_order_and_number_text_survive(spark):
    assert one(spark, '{"z":1.50,"links":[],"a":null}', jsontext.drop_keys("t")) == '{"z":1.50,"a":null}'


@pytest.mark.parametrize(
    "text,expected",
    [
        ('{"items":[]}', True), ('{"items":[1]}', True), ("[]", False), ('[{"a":1}]', True), ('[{"a":1},2]', False),
        ('[{},null]', False), ('{"items":{}}', False), ("3", False), ('"x"', False), ("null", False), ("{}", False),
    ],
)
def test_is_sublist(spark, text, expected):
    assert one(spark, text, F.coalesce(jsontext.is_sublist(F.parse_json("t")), F.lit(False))) is expected


@pytest.mark.parametrize(
    "text,expected",
    [("null", True), ("false", True), ("0", True), ("0.0", True), ('""', True), ("[]", True), ("{}", True), ('"0"', False),
     ('"false"', False), ("true", False), ("7", False), ('"{}"', False), ("[0]", False)],
)
def test_is_falsy(spark, text, expected):
    assert one(spark, text, jsontext.is_falsy(F.parse_json("t"))) is expected


def test_dotted_path_stops_at_non_objects(spark):
    text = '{"a":{"b":{"c":5}},"l":[{"c":1}],"s":"x","odd.key":{"q":1}}'
    get = lambda path: one(spark, text, jsontext.get(F.parse_json("t"), jsontext.dotted_path(path), "string"))
    assert get("a.b.c") == "5"
    assert get("l.c") is None and get("s.c") is None and get("a.x.c") is None


def test_path_quotes_keys(spark):
    for key in ("a.b", "with space", "it's", 'say "x"'):
        assert one(spark, json.dumps({key: 1}), jsontext.get(F.parse_json("t"), jsontext.path_of(key), "int")) == 1
    with pytest.raises(ValueError):
        jsontext.path_of("both ' and \"")


def test_redact_email(spark):
    text = "mail a.b+c@x-y.co.uk or @none, x@y"
    assert one(spark, text, redact.redact_email("t")) == "mail REDACTED@example.com or @none, x@y"


def test_redact_host(spark):
    text = "https://acct-1.rest.api.example.com/a //acct.soap.api.example.com //acct.other.api.example.com"
    got = one(spark, text, redact.redact_host("t", ["rest", "soap"], "api.example.com"))
    assert got == "https://account.rest.api.example.com/a //account.soap.api.example.com //acct.other.api.example.com"


def test_redact_xml_keeps_tags_and_spans_lines(spark):
    text = '<p:token a="1">x\ny</p:token><account>1</account><name>n</name><tokenId>t</tokenId>'
    assert one(spark, text, redact.redact_xml("t")) == (
        '<p:token a="1">REDACTED</p:token><account>REDACTED</account><name>n</name><tokenId>t</tokenId>'
    )


def test_redact_keys(spark):
    text = '{"nonce":{"a":[1]},"x":[{"token_id":null}],"y":"\\"nonce\\":1"}'
    assert json.loads(one(spark, text, redact.redact_keys("t"))) == {"nonce": "REDACTED", "x": [{"token_id": "REDACTED"}], "y": '"nonce":1'}


def test_values_nest_deep_and_names_may_be_escaped(spark):
    deep = "[" * 60 + '{"a":"]"}' + "]" * 60
    secret = f'{{"token_secret":{deep},"x":{{"tok\\u0065n_id":{deep},"signature\\u0020":1}}}}'
    assert one(spark, secret, redact.redact_keys("t")) == '{"token_secret":"REDACTED","x":{"tok\\u0065n_id":"REDACTED","signature\\u0020":1}}'
    links = f'{{"\\u006Cinks":{deep},"a":[{{"b":1,"links":{deep}}}]}}'
    assert one(spark, links, jsontext.drop_keys("t")) == '{"a":[{"b":1}]}'


def test_what_nests_too_deep_is_an_error(spark):
    deep = "[" * 200 + "]" * 200
    with pytest.raises(Exception, match="nested over"):
        one(spark, f'{{"nonce":{deep}}}', redact.redact_keys("t"))
    with pytest.raises(Exception, match="nested over"):
        one(spark, f'{{"links":{deep}}}', jsontext.drop_keys("t"))


@pytest.mark.parametrize(
    "text,whole",
    [('{"a":1}', True), (" [1] \n", True), ("3", True), ("null", True), ('{"a":1}\n{"a":2}', False), ('{"a":1} <html>', False), ('{"a":1},{"b":2}', False), ('1,"x":2', False), ("", False), ('{"a":1', False)],
)
def test_only_whole_texts_parse(spark, text, whole):
    assert one(spark, text, jsontext.parse_whole("t").isNotNull()) == whole
