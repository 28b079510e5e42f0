from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from goldthread.functions.extract import extract_paths, with_json_value
from goldthread.functions.paths import last_segment, split_path, split_path_column, strict_path

CASES = [
    (None, []),
    ("", []),
    ("solo", ["solo"]),
    ("shop.open", ["shop", "open"]),
    ('shop["open"].from', ["shop", "open", "from"]),
    ("shop[open]", ["shop", "open"]),
    ("['shop'][open]", ["shop", "open"]),
    ("shop['open']['from']", ["shop", "open", "from"]),
    (" shop . open ", ["shop", "open"]),
    ("..a..b.", ["a", "b"]),
    ("a['b.c']", ["a", "b", "c"]),
    ("a[ b ]", ["a", "b"]),
    ("a[b", ["a[b"]),
    ("[]", ["[]"]),
]


@pytest.mark.parametrize("path, steps", CASES)
def test_split_path(path, steps):
    assert split_path(path) == steps


def test_split_path_column_agrees(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES)], "i int, path string")
    rows = df.select("i", split_path_column(F.col("path")).alias("steps")).orderBy("i").collect()
    assert [r.steps for r in rows] == [steps for _, steps in CASES]


def test_strict_path_and_last_segment(spark):
    assert strict_path("a['b'].c") == ["a['b']", "c"]
    df = spark.createDataFrame([("profiles.memberId",), ("x",)], "p string")
    assert [r[0] for r in df.select(last_segment(F.col("p"))).collect()] == ["memberId", "x"]


def one(df):
    return df.first().asDict()


def test_extract_from_structs_maps_and_text(spark):
    df = spark.sql("""
        SELECT named_struct('roof', named_struct('tile', 'slate')) AS house,
               map('k', '{"deep": {"x": 1}}') AS tags,
               '{"street": "Elm 4", "inner": "{\\\\"a\\\\": {\\\\"b\\\\": [1, 2]}}"}' AS profiles""")
    got = one(extract_paths(df, {
        "v": ["house", "roof", "tile"], "street": ["profiles", "street"], "b": ["profiles", "inner", "a", "b"],
        "into_list": ["profiles", "inner", "a", "b", "0"], "x": ["tags", "k", "deep", "x"],
        "missing": ["missing", "path"], "missing_key": ["tags", "z"], "case": ["PROFILES", "street"]}))
    assert got == {"v": "slate", "street": "Elm 4", "b": "[1,2]", "into_list": None, "x": "1",
                   "missing": None, "missing_key": None, "case": None}


def test_keys_that_differ_by_case_or_are_leaf_and_inner(spark):
    df = spark.createDataFrame([('{"a": 1, "A": 2, "b": {"c": 3}}',)], "doc string")
    targets = {"lower": ["doc", "a"], "upper": ["doc", "A"], "whole": ["doc", "b"], "part": ["doc", "b", "c"]}
    wanted = {"lower": "1", "upper": "2", "whole": '{"c":3}', "part": "3"}
    assert one(extract_paths(df, targets)) == wanted
    assert one(extract_paths(df, targets, parse_embedded=False)) == wanted


def test_embedded_text_is_parsed_only_on_request(spark):
    df = spark.createDataFrame([(r'{"a": "{\"b\": 1}"}',)], "doc string")
    assert one(extract_paths(df, {"b": ["doc", "a", "b"]})) == {"b": "1"}
    assert one(extract_paths(df, {"b": ["doc", "a", "b"]}, parse_embedded=False)) == {"b": None}


@pytest.mark.parametrize("doc, text", [
    ('{"a": "x"}', "x"), ('{"a": ""}', ""), ('{"a": true}', "true"), ('{"a": null}', None), ('{"a": 5}', "5"),
    ('{"a": 1.50}', "1.5"), ('{"a": 1.0}', "1.0"), ('{"a": 12345678.9}', "12345678.9"), ('{"a": 1e20}', "1e+20"),
    ('{"a": 0.00001}', "1e-05"), ('{"a": 0.00012}', "0.00012"), ('{"a": 1e5}', "100000.0"), ('{"a": -2.5e-7}', "-2.5e-07"),
    ('{"a": 123456789012345678}', "123456789012345678"), ('{"a": "1.50"}', "1.50"), ('{"a": {"b": [1]}}', '{"b":[1]}'),
    ("{'a': 1}", None), ('{"a": 1', None), ('[{"a": 1}]', None), ("5", None), ("", None), (None, None),
    ('{"a": 1, "a": 2}', "2"), ('{"a": 1} junk', None), (' \n{"a": 1}\t\n', "1"), ('x{"a": 1}', None),
])
def test_leaf_text(spark, doc, text):
    df = spark.createDataFrame([(doc,)], "doc string")
    assert one(extract_paths(df, {"a": ["doc", "a"]})) == {"a": text}


def test_json_value_is_scalar_only(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "c": [1], "d": "x"}',)], "doc string")
    for path, value in ((["a"], None), (["c"], None), (["d"], "x"), (["a", "b"], "1"), (["d", "x"], None)):
        assert with_json_value(df, "v", F.col("doc"), path).first().v == value


def test_variant_columns_are_documents_too(spark):
    df = spark.sql("""SELECT parse_json('{"a": {"b": "x"}, "t": "{\\\\"u\\\\": 7}"}') AS doc""")
    assert one(extract_paths(df, {"b": ["doc", "a", "b"], "u": ["doc", "t", "u"]})) == {"b": "x", "u": "7"}


def test_sample_message_shape(spark):
    doc = """{"load": {"crew": {"Pilot": {"badge": {"string": "P-3"}, "onDuty": {"boolean": true}}},
              "stops": {"map": {"OSL": {"arrived": 1700000000123, "gate": null}}}, "delays": null}}"""
    df = spark.createDataFrame([(doc,)], "m string")
    base = ["m", "load"]
    got = one(extract_paths(df, {
        "badge": [*base, "crew", "Pilot", "badge", "string"], "duty": [*base, "crew", "Pilot", "onDuty", "boolean"],
        "time": [*base, "stops", "map", "OSL", "arrived"], "gate": [*base, "stops", "map", "OSL", "gate", "string"],
        "delays": [*base, "delays"]}, parse_embedded=False))
    assert got == {"badge": "P-3", "duty": "true", "time": "1700000000123", "gate": None, "delays": None}
