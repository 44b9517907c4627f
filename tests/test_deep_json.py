"""Objects in arrays of JSON that the JVM's parser refuses for its depth or length."""

import json
import random

import pytest

from seedloom.operators.nested_tables import _parsed, _text, nested_objects


def test_deep_and_long_values(spark):
    deep = lambda n: '[{"a":' * n + "1" + "}]" * n
    path = lambda n: "value[0]" + ".a[0]" * n
    texts = {"deep": deep(700), "deeper": deep(3000), "inside": json.dumps([{"b": deep(600)}]), "long": '[{"a":"' + "x" * 21_000_000 + '"},{}]', "twice": '[{"c":1,"c":2},' + "[" * 1200 + "]" * 1200 + "]", "broken": "[{}," * 1500, "plain": '[{"a":[{}]}]'}
    df = spark.createDataFrame(list(texts.items()), "id string, value string")
    got = {}
    for r in nested_objects(df, objects=False).select("id", "path").collect():
        got.setdefault(r.id, []).append(r.path)
    want = {"deep": [path(n) for n in range(700)], "deeper": [path(n) for n in range(3000)], "inside": ["value[0]"] + ["value[0].b[0]" + ".a[0]" * n for n in range(600)], "long": ["value[0]", "value[1]"], "plain": ["value[0]", "value[0].a[0]"]}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_parsing_without_recursion():
    for text in ("[]", "{}", ' { "b" : [1, -2.5e3, true, null, "\\u0041\\n"], "a": {"c": [] , "d": {}} } ', '"x"', "0", "[[],[{}]]"):
        assert _parsed(text) == json.loads(text)
        assert _text(_parsed(text)) == json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    for text in ("", "[", "[1,]", '{"a":1,"a":2}', '{"a"}', "{1:2}", "[1]]", "1 2", "01", "NaN", "[1}", '{"a":1]', "tru", '"a'):
        try:
            _parsed(text)
        except ValueError:
            continue
        raise AssertionError(text)
    assert _text(_parsed("[" * 50_000 + "]" * 50_000)) == "[" * 50_000 + "]" * 50_000


def plain_walk(text):
    """Paths of objects in arrays, by the plainest recursion."""

    def value(t):
        def members(pairs):
            if len({k for k, _ in pairs}) < len(pairs):
                raise ValueError
            return dict(pairs)

        return json.loads(t, object_pairs_hook=members)

    def below(v, path, element):
        if isinstance(v, str):
            try:
                return below(value(v), path, element)
            except ValueError:
                return []
        if isinstance(v, list):
            return [p for i, x in enumerate(v) for p in below(x, f"{path}[{i}]", True)]
        if isinstance(v, dict):
            return [path] * element + [p for k, x in v.items() for p in below(x, f"{path}.{k}", False)]
        return []

    try:
        return sorted(below(value(text), "value", False))
    except ValueError:
        return []


def escaped(text, random):
    """The same JSON string with some of its characters as escapes."""
    out, inside = [], False
    for k, ch in enumerate(text):
        inside ^= ch == '"' and (k == 0 or text[k - 1] != "\\")
        out.append(f"\\u{ord(ch):04x}" if inside and ch in "[]{}" and random.random() < 0.7 else ch)
    return "".join(out)


def wrapped(random, depth):
    """JSON of some depth, with strings of JSON between its levels."""
    v = random.choice([{}, [{}], {"z": 1}, "[{", 5])
    for _ in range(depth):
        kind = random.randrange(4)
        v = [v] if kind == 0 else {"a": v} if kind == 1 else [{"b": v}, {}] if kind == 2 else json.dumps(v)
        if isinstance(v, str) and len(v) > 100_000:
            break
    return json.dumps(v)


@pytest.mark.parametrize("wrappers", [10, 11, 12, 15])
def test_strings_in_strings(spark, wrappers):
    text = "[{}]"
    for _ in range(wrappers):
        text = json.dumps([text])
    brackets = json.dumps("[[{}]]").replace("[", "\\u005b").replace("{", "\\u007b")
    for _ in range(24):
        brackets = json.dumps(["x"]).replace('"x"', brackets)
    chain = '"' + "\\u005c" * 1 + "u005c" * 30 + 'u0022[{}]' + '"'  # a quote that becomes one after many readings
    repeated = "[" * 30 + '[{}, {"a":1,"a":2}]' + "]" * 30
    texts = {"w": text, "b": brackets, "c": chain, "r": repeated}
    df = spark.createDataFrame(list(texts.items()), "id string, value string")
    got = {k: [] for k in texts}
    for r in nested_objects(df, objects=False).collect():
        got[r.id].append(r.path)
    assert {k: sorted(v) for k, v in got.items()} == {k: plain_walk(t) for k, t in texts.items()}
    assert len(got["w"]) == 1 and got["b"] and not got["r"]


def test_any_nesting_as_plain_walk(spark):
    r = random.Random(5)
    texts = [wrapped(r, r.randrange(1, 45)) for _ in range(400)]
    texts += [escaped(t, r) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    got = {}
    for row in nested_objects(df, objects=False).select("id", "path").collect():
        got.setdefault(int(row.id), []).append(row.path)
    assert {k: sorted(v) for k, v in got.items()} == {k: p for k, t in enumerate(texts) if (p := plain_walk(t))}
