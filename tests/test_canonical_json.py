import json
import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seedloom.functions import canonical_json as c


@pytest.mark.parametrize(
    ("value", "text"),
    [
        ({"b": [2, {"d": 1, "c": None}], "a": True}, '{"a":true,"b":[2,{"c":null,"d":1}]}'),
        ([1.0, -0.0, 1e21, 1e20, 1e-6, 1e-7, 0.1, 123456789.125, -2.5e-9], "[1,0,1e+21,100000000000000000000,0.000001,1e-7,0.1,123456789.125,-2.5e-9]"),
        (12345678901234567890, "12345678901234567000"),
        ({"\U0001f600": 1, "＀": 2}, '{"\U0001f600":1,"＀":2}'),
        ('\u0001\n"\\/', '"\\u0001\\n\\"\\\\/"'),
        ("", '""'),
    ],
)
def test_text(value, text):
    assert c.canonical(value) == text


@pytest.mark.parametrize(
    ("value", "path"),
    [({"rules": [object()]}, "/rules/0"), ({"a": math.nan}, "/a"), ([math.inf], "/0"), ({"x/y": {"~": "\ud800"}}, "/x~1y/~0"), ({"\ud800": 1}, "/\ud800"), ({1: 2}, "")],
)
def test_refused(value, path):
    with pytest.raises(c.CanonicalJsonError) as error:
        c.canonical(value)
    assert (error.value.code, error.value.path) == (c.UNSUPPORTED_VALUE, path)


def test_cycle_is_refused_but_sharing_is_not():
    shared = [1]
    assert c.canonical([shared, shared]) == "[[1],[1]]"
    shared.append(shared)
    with pytest.raises(c.CanonicalJsonError):
        c.canonical(shared)


@pytest.mark.parametrize(("text", "path"), [('{"a":1,"a":2}', "/a"), ('{"a":1,"\\u0061":2}', "/a"), ('[{"x":{"k":1,"k":1}}]', "/0/x/k"), ('{"o":{"z":1,"z":2},"o":1}', "/o/z")])
def test_repeated_members(text, path):
    with pytest.raises(c.CanonicalJsonError) as error:
        c.parse_strict(text)
    assert (error.value.code, error.value.path) == (c.DUPLICATE_KEY, path)


@pytest.mark.parametrize("text", ["", " ", "{} x", "01", "NaN", "{a:1}", b"\xff", "[1,]", "'a'", "[" * 100_000])
def test_not_json(text):
    with pytest.raises(c.CanonicalJsonError) as error:
        c.parse_strict(text)
    assert error.value.code == c.INVALID_JSON


_json = st.recursive(st.none() | st.booleans() | st.integers(-(2**53) + 1, 2**53 - 1) | st.floats(allow_nan=False, allow_infinity=False) | st.text(st.characters(exclude_categories=["Cs"])), lambda x: st.lists(x) | st.dictionaries(st.text(st.characters(exclude_categories=["Cs"])), x), max_leaves=10)


@given(_json)
def test_round_trip(value):
    text = c.canonical(value)
    assert c.canonical(c.parse_strict(text)) == text
    assert json.loads(text, parse_int=float) == json.loads(json.dumps(value), parse_int=float)


def test_columns(spark):
    df = spark.createDataFrame([('{"b":1,"a":1.0}',), ('{"a":1,"a":2}',), ("{",), (None,), ("",), ('"\\ud800"',)], "t string")
    rows = [r.p for r in df.select(c.checked_json("t").alias("p")).collect()]
    assert [r and (r.text, r.code, r.path) for r in rows] == [('{"a":1,"b":1}', None, None), (None, c.DUPLICATE_KEY, "/a"), (None, c.INVALID_JSON, ""), None, (None, c.INVALID_JSON, ""), (None, c.UNSUPPORTED_VALUE, "")]
    assert df.limit(0).select(c.canonical_json("t")).collect() == []


def test_both_ways_agree(spark):
    import random

    r = random.Random(2)

    def value(depth):
        kind = r.randrange(6 if depth else 4)
        if kind < 4:
            return [r.randrange(-(10**r.randrange(1, 15)), 10**r.randrange(1, 15)), "".join(r.choice("aZ ~!/<&'-_09:{}[],.é\\\"") for _ in range(6)), None, r.random() < 0.5][kind]
        return [value(depth - 1) for _ in range(3)] if kind == 4 else {"".join(r.choice("abAB_ $09é") for _ in range(3)): value(depth - 1) for _ in range(4)}

    texts = [json.dumps(value(4), ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) for _ in range(600)]
    texts += ["", " ", "{", "01", "-0", "[1 2]", "{} {}", '{"a":1,"a":2}', "1.50", "1e2", "12345678901234567", "tru", "'a'", '"\x7f"', '"/"', "  7  ", "[,]", "0.5", "-0.25", "212.4", "0.000001", "0.0000012", "1.10", "[1.5,2.50]", "123456789.123456", "1.", ".5", "-1.5", "9.99999", "1.0", "100.001", '{"a":1,}', "NaN", "-", "[-0, 0]"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    found = {x.n: (x.c and x.c.text, x.c and x.c.code) for x in df.select("n", c.checked_json("t").alias("c")).collect()}
    binary = {x.n: (x.c and x.c.text, x.c and x.c.code) for x in df.select("n", c.checked_json(F.col("t").cast("binary")).alias("c")).collect()}
    plain = {x.n: x.t for x in df.select("n", c.canonical_json("t").alias("t")).collect()}
    for n, t in enumerate(texts):
        want = c._checked(t)
        assert plain[n] == want["text"], t
        assert found[n] == binary[n] == (want["text"], want["code"]), t
