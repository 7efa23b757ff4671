import fnmatch
import json
import math
import random
import struct
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidelog.functions import instants as I
from tidelog.functions import render as R
from tidelog.functions.csvtext import csv_field
from tidelog.functions.patterns import filter_changes, like_pattern, split_patterns, wildcard_match
from tidelog.schema import CELL


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


# Wildcards


@pytest.mark.parametrize(
    "pattern, text, expected",
    [
        ("north", "north", True), ("north", "northern", False),
        ("eu_*", "eu_", True), ("eu_*", "euXsales", False), ("*_eu", "sales_eu", True), ("s*s_*u", "sales_eu", True),
        ("*", "", True), ("**", "x y", True), ("*ale*", "sales", True), ("*ale*", "aleph", True),
        ("v??", "v42", True), ("v??", "v4", False), ("?*", "", False), ("?*?", "ab", True),
        ("a%b", "a%b", True), ("a%b", "axb", False), ("[ab]", "a", False), ("[ab]", "[ab]", True),
        ("a\\b", "a\\b", True), ("*\\", "x\\", True), ("FOO", "foo", False), ("?", "😀", True), ("a*b", "a\nb", True), ("", "", True),
    ],
)
def test_wildcard(spark, pattern, text, expected):
    assert one(spark, wildcard_match(F.col("t"), pattern), t=text) is expected


def matches(pattern, text):
    """The standard library's matcher, whose brackets are no wildcards here."""
    return fnmatch.fnmatchcase(text, pattern.replace("[", "[[]"))


def test_wildcard_against_plain_matcher(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choices("ab_%\\", k=rng.randint(0, 5))) for _ in range(60)]
    patterns = ["".join(rng.choices("ab_%\\*?", k=rng.randint(0, 4))) for _ in range(40)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", *[wildcard_match(F.col("t"), p).alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    for row in rows:
        for i, pattern in enumerate(patterns):
            assert row[f"p{i}"] is matches(pattern, row["t"]), (pattern, row["t"])


def test_pattern_lists(spark):
    assert split_patterns(" a, ,b*,, ") == ["a", "b*"]
    assert like_pattern("a_%\\*?") == "a\\_\\%\\\\%_"
    feed = spark.createDataFrame(
        [("eu_north", "trips"), ("archive", "trips"), ("us", "fares"), ("us", "fare_log"), ("us", "zone7"), ("us", "zone12")],
        "db_name string, table_name string",
    )

    def kept(**lists):
        return [tuple(r) for r in filter_changes(feed, **lists).collect()]

    assert len(kept()) == 6
    assert kept(databases="archive,eu_*") == [("eu_north", "trips"), ("archive", "trips")]
    assert kept(tables="zone?,fare_*") == [("us", "fare_log"), ("us", "zone7")]
    assert kept(databases="u?", tables="fare*") == [("us", "fares"), ("us", "fare_log")]


def test_wildcard_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("app_1", "x")], "db_name string, table_name string").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    plan = plan_of(filter_changes(table, "app_*", "x"))
    assert "StringStartsWith(db_name,app_)" in plan and "EqualTo(table_name,x)" in plan
    plan = plan_of(filter_changes(table, "a_?b*", "*x"))
    assert "StringStartsWith(db_name,a_)" in plan and "StringEndsWith(table_name,x)" in plan


# Instants and positions


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("2026-04-17T10:00:00Z", 1776420000), ("2026-04-17T10:00:00+08:00", 1776391200),
        ("2026-04-17T10:00:00", 1776420000), ("2026-04-17 10:00:00", 1776420000),
        ("2026-04-17T10:00:00.999999999Z", 1776420000), ("2026-04-17T10:00:00-00:30", 1776421800),
        ("2026-03-08T02:30:00", 1772937000), ("1969-12-31T23:59:59.5Z", -1), ("2026-4-7 1:2:3", 1775523723),
        ("2016-12-31T23:59:60Z", 1483228799),
        ("2026-04-17", None), ("2026-04-17 10:00", None), ("x", None), ("", None), ("2026-13-01 00:00:00", None),
        ("2026-02-30 00:00:00", None), ("2026-04-17 10:00:00.5", None), ("2026-04-17T10:00:00+0800", None),
        ("2026-04-17T10:00:00+24:00", None), (" 2026-04-17T10:00:00Z", None), ("2026-04-17T25:00:00Z", None),
    ],
)
def test_parse_instant(spark, text, seconds):
    assert one(spark, I.parse_instant(F.col("t")), t=text) == seconds


def test_format_times(spark):
    assert one(spark, I.format_event_time(F.lit(1776420000))) == "2026-04-17T10:00:00+00:00"
    assert one(spark, I.format_event_time(F.lit(0))) == "1970-01-01T00:00:00+00:00"
    assert one(spark, I.format_utc_z(F.lit(4294967295))) == "2106-02-07T06:28:15Z"
    assert one(spark, I.format_utc_z(F.lit(None).cast("bigint"))) is None
    assert one(spark, I.now_text("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$"))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("end", ("end", None, None)), ("start", ("start", None, None)),
        ("feed.000917:52", ("at", "feed.000917", 52)), ("feed.000917:9007199254740993", ("at", "feed.000917", 9007199254740993)),
        ("a:b:12", ("at", "a:b", 12)), (":7", ("at", "", 7)), ("f:18446744073709551615", ("at", "f", 18446744073709551615)),
        ("f:+5", ("at", "f", 5)), ("f:0000000000000000000000042", ("at", "f", 42)), ("f:0", ("at", "f", 0)),
        ("feed.000917", (None, None, None)), ("f:12x", (None, None, None)), ("f:", (None, None, None)),
        ("f:-1", (None, None, None)), ("f:18446744073709551616", (None, None, None)), ("END", (None, None, None)),
    ],
)
def test_parse_start_spec(spark, text, expected):
    spec = one(spark, I.parse_start_spec(F.col("t")), t=text)
    assert tuple(spec) == expected


def test_file_number_and_label(spark):
    assert one(spark, I.file_number(F.lit("log.1000000"))) == 1000000
    assert one(spark, I.file_number(F.lit("log"))) is None
    assert one(spark, I.position_label(F.lit("log.000003"), F.lit(125638))) == "log.000003:125638"


# Rendering


def cells(spark, *values):
    """One row with an array of cells; a value is (kind, {field: value})."""
    rows = [None if v is None else tuple(v[1].get(f, v[0] if f == "kind" else None) for f in CELL.names) for v in values]
    from pyspark.sql import types as T

    return spark.createDataFrame([(rows,)], T.StructType([T.StructField("cells", T.ArrayType(CELL))]))


def rendered(spark, *values):
    return cells(spark, *values).select(R.fragments(F.col("cells")).alias("x")).first()["x"]


def date(y=2026, mo=4, d=17, h=0, mi=0, s=0, us=0):
    return ("date", {"dt": (y, mo, d, h, mi, s, us)})


def clock(neg=False, days=0, h=0, mi=0, s=0, us=0):
    return ("time", {"tm": (neg, days, h, mi, s, us)})


def test_render_every_kind(spark):
    text = 'say "hi" \\ \n\t é 😀 / \x01\x0b\x1f\x7f \\u000B'
    cases = [
        (None, "null"), (("null", {}), "null"), (("int", {}), "null"),
        (("bytes", {"b": text.encode()}), None), (("bytes", {"b": b""}), '""'),
        (("bytes", {"b": b"[]"}), '"[]"'), (("bytes", {"b": b"\xffA"}), '"0xff41"'), (("bytes", {"b": b"\xed\xa0\x80"}), '"0xeda080"'),
        (("int", {"i": -(2**63)}), "-9223372036854775808"), (("int", {"i": 2**63 - 1}), "9223372036854775807"),
        (("uint", {"u": Decimal(2**64 - 1)}), "18446744073709551615"),
        (("float", {"f": 0.1}), "0.10000000149011612"), (("double", {"d": 12345678.9}), "12345678.9"),
        (("double", {"d": 0.0}), "0.0"), (("double", {"d": -0.0}), "-0.0"), (("double", {"d": 1e16}), "1e16"),
        (("double", {"d": 1e-7}), "1e-7"), (("double", {"d": -1.5e-7}), "-1.5e-7"), (("double", {"d": 1e-5}), "0.00001"),
        (("double", {"d": float("nan")}), "null"), (("double", {"d": float("-inf")}), "null"), (("double", {"d": 99.0}), "99.0"),
        (("double", {"d": 123456789012345.0}), "123456789012345.0"), (("double", {"d": 1.25e300}), "1.25e300"),
        (date(0, 0, 0), '"0000-00-00"'), (date(), '"2026-04-17"'), (date(us=1), '"2026-04-17T00:00:00.000001"'),
        (date(h=9, mi=8, s=7, us=120000), '"2026-04-17T09:08:07.120000"'), (date(y=12345, mo=1, d=2), '"12345-01-02"'),
        (clock(True, 34, 22, 59, 59), '"-838:59:59.000000"'), (clock(h=1, mi=2, s=3, us=45), '"01:02:03.000045"'),
        (clock(days=4, h=3), '"99:00:00.000000"'), (clock(days=4, h=4), '"100:00:00.000000"'),
        (("json", {"raw": '{"a": [1]}'}), '{"a": [1]}'),
    ]
    found = rendered(spark, *[value for value, _ in cases])
    for (value, expected), got in zip(cases, found):
        if expected is not None:
            assert got == expected, value
    quoted = found[3]
    assert json.loads(quoted) == text
    # Control characters in lower-case hex, everything else but quotes and backslashes as it is.
    assert quoted == '"say \\"hi\\" \\\\ \\n\\t é 😀 / \\u0001\\u000b\\u001f\x7f \\\\u000B"'


def test_numbers_read_back_as_the_same_double(spark):
    rng = random.Random(3)
    values = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 18) for _ in range(3000)]
    values += [round(rng.uniform(0, 1e6), 2) for _ in range(1000)] + [2e23, 1e23, 8.41e21, 2.2250738585072014e-308, 5e-324]
    frame = spark.createDataFrame([(v,) for v in values], "d double").select("d", R.json_number(F.col("d")).alias("t"))
    for d, text in frame.collect():
        if not math.isfinite(d):
            assert text == "null"
            continue
        assert float(text) == d
        digits = text.lower().lstrip("-").split("e")[0].replace(".", "").strip("0")
        shortest = repr(d).lower().lstrip("-").split("e")[0].replace(".", "").strip("0")
        # The very smallest doubles may keep one digit more on older Java runtimes.
        assert len(digits) <= len(shortest) or abs(d) < 1e-300, (d, text)
        size = abs(d)
        assert ("e" in text) == (size != 0 and not 1e-5 <= size < 1e16), text


def image(spark, names, pk=None, values=None):
    values = values or [("int", {"i": n}) for n in range(4)]
    keys = R.cell_keys(F.col("cells"), R.keys_of(F.lit(names).cast("array<string>")))
    columns = [R.row_image_json(F.col("cells"), F.lit(names).cast("array<string>")).alias("row")]
    columns.append(R.primary_key_json(keys, R.fragments(F.col("cells")), R.keys_of(F.lit(pk or []).cast("array<string>"))).alias("pk"))
    return tuple(cells(spark, *values).select(*columns).first())


def test_names_of_cells(spark):
    assert image(spark, ["a", "b", "c", "d"])[0] == '{"a":0,"b":1,"c":2,"d":3}'
    assert image(spark, ["a", ""])[0] == '{"a":0,"col_1":1,"col_2":2,"col_3":3}'
    assert image(spark, ["a", "b", "c", "d", "e"])[0] == '{"a":0,"b":1,"c":2,"d":3}'
    assert image(spark, ["a", "b", "a", "c"])[0] == '{"a":2,"b":1,"c":3}'
    assert image(spark, ["col_1"])[0] == '{"col_1":1,"col_2":2,"col_3":3}'
    assert image(spark, ['q"\n', "b", "c", "d"])[0].startswith('{"q\\"\\n":0,')
    names = cells(spark, None, None, None).select(R.name_cells(F.col("cells"), F.lit(["x", ""])).alias("n")).first()["n"]
    assert names == ["x", "col_1", "col_2"]


def test_primary_keys(spark):
    names = ["a", "b", "c", "d"]
    assert image(spark, names, ["b"])[1] == "1"
    assert image(spark, names, ["gone"])[1] == "null"
    assert image(spark, names, ["d", "a", "gone"])[1] == '{"d":3,"a":0,"gone":null}'
    assert image(spark, ["a", "b", "a", "c"], ["a"])[1] == "2"
    assert image(spark, ["Id", "ID", "x", "y"])[1] == "1"
    assert image(spark, ["Id", "ID", "id", "y"])[1] == "2"
    assert image(spark, names)[1] == "null"
    present_null = [("null", {}), ("int", {"i": 5}), ("int", {"i": 6}), ("int", {"i": 7})]
    assert image(spark, ["id", "ID", "x", "y"], values=present_null)[1] == "null"
    text_key = [("bytes", {"b": b"42"})] + [("int", {"i": 1})] * 3
    assert image(spark, names, ["a"], text_key)[1] == '"42"'


def test_operations(spark):
    kinds = ["WRITE", "WRITE_V1", "UPDATE", "UPDATE_V1", "PARTIAL_UPDATE", "DELETE", "DELETE_V1", "TABLE_MAP", "other"]
    frame = spark.createDataFrame([(k,) for k in kinds], "k string").select(R.classify_operation(F.col("k")).alias("o"))
    assert [r["o"] for r in frame.collect()] == ["INSERT"] * 2 + ["UPDATE"] * 3 + ["DELETE"] * 2 + [None] * 2


def test_csv_field(spark):
    cases = {"a": "a", "a,b": '"a,b"', 'a"b': '"a""b"', "a\nb": '"a\nb"', "a\rb": '"a\rb"', " a ": " a ", "#": "#", "\\": "\\", "": "", None: ""}
    for text, expected in cases.items():
        assert one(spark, csv_field(F.lit(text))) == expected
