"""Strict decoding against Python's own JSON reader on mutated texts."""

import json
import random

from tallyline.functions import json_text as J
from tallyline.functions.json_text import with_strict_json

SEEDS = [
    '{"a":1,"b":[1,2,{"c":null}],"d":"x\\"y","e":-1.5e3}', '[]', '{}', '"text"', "null", "true", "12", "-0.5",
    ' {"payload" : {"op":"c"}} ', '{"u":"\\u00e9\\ud83d\\ude00 é"}', "[1,2],[3]",
    '{"x":"\\ud83d\\\\\\ude00"}', '"\\\\\\u0000"',
    '{"a":1}{"b":2}', '{"a":1}],[',
]
ALPHABET = '{}[]",:0123456789.eE+-truefalsn \t\n\\u/\x00\x07﻿'


def mutations(rng, count):
    for _ in range(count):
        text = list(rng.choice(SEEDS))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            kind = rng.random()
            if kind < 0.4:
                text.insert(at, rng.choice(ALPHABET))
            elif text and kind < 0.7:
                del text[min(at, len(text) - 1)]
            elif text:
                text[min(at, len(text) - 1)] = rng.choice(ALPHABET)
        yield "".join(text)


def python_accepts(text):
    def refuse(_):
        raise ValueError("not JSON")

    try:
        plain = json.dumps(json.loads(text, parse_constant=refuse), ensure_ascii=False)
        plain.encode()  # half a surrogate pair has no encoding
        return "\\u0000" not in plain.replace("\\\\", "")
    except ValueError:
        return False


def test_agrees_with_python_on_mutated_texts(spark):
    texts = sorted(set(mutations(random.Random(7), 4000)))
    df = spark.createDataFrame(list(enumerate(texts)), "n int, line string")
    rows = with_strict_json(df, "line", "doc").selectExpr("n", "to_json(doc) as doc").collect()
    found = {r["n"]: r["doc"] for r in rows}
    wrong = [t for n, t in enumerate(texts) if (found[n] is not None) != python_accepts(t)]
    assert not wrong, wrong[:10]
    assert sum(v is not None for v in found.values()) > 200
    for n, text in enumerate(texts):
        if found[n] is not None:
            expected = json.loads(text)
            assert json.loads(found[n]) == expected, text


def test_merged_text_makes_each_map_once(spark):
    """Not once for each key of the base."""
    text = J.merged_text("a", "b")
    assert text.count("try_variant_get(b,") == 1 and text.count("try_variant_get(a,") == 1
    rows = spark.sql("""select parse_json(a) as a, parse_json(b) as b from values
        ('{"x":1,"y":2}', '{"y":null}'), ('[1]', '{"z":"t"}'), (null, null), ('{"k":1}', '7') as t(a, b)""")
    assert [r[0] for r in rows.selectExpr(text).collect()] == ['{"x":1,"y":null}', '{"z":"t"}', "{}", '{"k":1}']


def test_whole_numbers_and_others_become_decimals(spark):
    values = ["7", "-1", "1.5", "1e3", '"7"', "null", "true", "1000000000000000", "999999999999999", "92233720368547758070"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string").selectExpr("i", "parse_json(t) as v")
    got = [r[1] and str(r[1]) for r in rows.selectExpr("i", f"{J.number_of('v')} as n").orderBy("i").collect()]
    assert got == ["7.000", "-1.000", "1.500", "1000.000", None, None, None, None, "999999999999999.000", None]
