import re

import pytest
from pyspark.sql import functions as F

from sparkcurate.functions import jsontext, text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "value",
    ["What's the TIME?", "  perché,  NO! ", "x²_y-z", "", "a\u00a0b\u2003c", "Straße № 5"],
)
def test_loose_key_is_pythons(spark, value):
    expected = " ".join(re.sub(r"[^\w\s]", " ", value.lower()).split())
    assert one(spark, text.loose_key, value) == expected
    assert one(spark, text.loose_key, expected) == expected


NORMAL = [
    ("what's the time", "what is the time"),
    ("quick, what time is it?", "quick what time is it"),
    ("hello", "hello"),
    ("WORLD", "world"),
    ("stop!", "stop"),
    ("how much is fifteen percent of two hundred", "how much is 15 percent of 200"),
    ("twenty-one", "21"),
    ("three thousand four hundred twenty five apples", "3425 apples"),
    ("one two", "1 2"),
    ("", ""),
]


@pytest.mark.parametrize("value, expected", NORMAL)
def test_normalize(spark, value, expected):
    once = one(spark, text.normalize, value)
    assert once == expected
    assert one(spark, text.normalize, once) == once


def test_number_words_are_english_only(spark):
    t = "quanto fa il quindici percento di duecento"
    assert one(spark, lambda c: text.normalize(c, "it"), t) == t


def test_substitute_is_one_pass(spark):
    df = spark.sql("SELECT 'go {A} to {B} and {A} {C}' AS t, map('A', '{B}', 'B', 'x') AS m")
    assert df.select(text.substitute(F.col("t"), F.col("m"))).first()[0] == "go {B} to x and {B} {C}"


def test_placeholders_in_order(spark):
    df = spark.sql("SELECT '{B} {A} {B}' AS t, map('k', 'z{C}{A}') AS m")
    assert df.select(text.placeholders(F.col("t"), F.col("m"))).first()[0] == ["B", "A", "C"]


OFFENDERS = [
    ("in che giorno è nato Napoleone", True),
    ("dove si trova la Torre Eiffel", True),
    ("quanto tempo dura un anno su Marte", True),
    ("che cos'è la musica medievale", True),
    ("chi ha inventato la lancia", True),
    ("dammi 3 esempi", True),
    ("qual è la capitale della Francia", False),
]


@pytest.mark.parametrize("value, expected", OFFENDERS)
def test_trigger_offenders(spark, value, expected):
    column = lambda c: text.trigger_offender(c, ["giorno", "trova", "tempo", "lancia"], ["eval"])
    assert one(spark, column, value) is expected


def test_keyword_hit(spark):
    column = lambda c: text.keyword_hit(c, all_of=[["turn", "on"]], anywhere=["alarm"], patterns=["set (a )?timer"])
    assert [one(spark, column, v) for v in ("On, turn it", "turn it off", "Alarms!", "set a timer now", "set a timers")] == [True, False, True, True, False]


def test_small_functions(spark):
    assert one(spark, text.strip_fences, "```json\n{}\n```") == "{}"
    assert one(spark, text.unquote, '"ab"') == "ab"
    assert one(spark, text.csv_list, " a, ,b,") == ["a", "b"]
    assert tuple(one(spark, text.key_value, "a=b=c")) == ("a", "b=c")
    assert tuple(one(spark, text.key_value, "dir")) == (None, "dir")
    assert one(spark, text.first_call, "<start_function_call>call:open{a:1}") == "open"
    assert one(spark, text.first_call, "no") is None
    assert one(spark, lambda c: text.declares_id(c, "a.b"), "x:\n  id:  a.b\n") is True
    assert spark.range(1).select(text.percent(F.lit(0.825))).first()[0] == "82%"


RENDERED = [
    ('{"a": "x", "b": [true, null, 2]}', "{a:<escape>X<escape>,b:[true,<escape>NULL<escape>,2]}"),
    ('{"k": "a\\"b, {c}: [d]", "e": {}, "f": []}', '{k:<escape>A"B, {C}: [D]<escape>,e:{},f:[]}'),
    ('{"\\u00e9": "\\u00e9", "n": [1.50, -2, 1e2, false]}', "{é:<escape>É<escape>,n:[1.5,-2,100.0,false]}"),
    ('"text"', "<escape>TEXT<escape>"),
    ("null", "<escape>NULL<escape>"),
    ('{"a": ', None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("value, expected", RENDERED)
def test_rendered_schema(spark, value, expected):
    assert one(spark, jsontext.render_schema, value) == expected


def test_render_schema_cuts_tokens_once(spark):
    """Of a long text the tokens aren't cut anew for each of them; escapes, empty strings and keys with marks come out as before."""
    df = spark.createDataFrame([(r'{"a\"b": ["", "x\u00e9\n", "\\", 1e5, -0.50, false, null], "é:,": {"": "ß"}}',)], "t string").select(jsontext.render_schema(F.col("t")).alias("r"))
    assert df.first().r == '{a"b:[<escape><escape>,<escape>XÉ\n<escape>,<escape>\\<escape>,100000.0,-0.5,false,<escape>NULL<escape>],é:,:{:<escape>SS<escape>}}'
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    long = spark.range(1).select(F.to_json(F.struct(F.sequence(F.lit(0), F.lit(20_000)).alias("n"))).alias("t"))
    assert long.select(jsontext.render_schema(F.col("t")).alias("r")).first().r == "{n:[" + ",".join(map(str, range(20_001))) + "]}"


def test_json_texts(spark):
    assert one(spark, jsontext.canonical_json, '{"b":1,"a":{"d":"é","c":2}}') == '{"a": {"c": 2, "d": "é"}, "b": 1}'
    assert one(spark, jsontext.canonical_json, "{") is None
    assert one(spark, jsontext.json_string, 'a"é\n') == '"a\\"é\\n"'
    skills = spark.createDataFrame([("b", "B", "{}", 2), ("a", "A", '{"x": null}', 1)], "alias string, description string, parameters string, ord long")
    told = jsontext.declarations(skills).first()
    assert told.tools == 2 and told.declarations.startswith("<start_function_declaration>declaration:a{description:<escape>A<escape>,parameters:{x:<escape>NULL<escape>}}<end_function_declaration>")
