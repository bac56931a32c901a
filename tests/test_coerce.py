import datetime as dt
import json
import math
import random
import struct
import sys

import pytest

from tablesnap import RemoteColumn
from tablesnap.functions.coerce import rows_to_table


def coerced(spark, json_type, cells):
    lines = spark.createDataFrame([(i, f"[{i},{c}]") for i, c in enumerate(cells)], "i int, value string")
    df = rows_to_table(lines, [RemoteColumn("i", "int"), RemoteColumn("x", json_type)])
    return [r.x for r in sorted(df.collect())]


def check(spark, json_type, expected):
    found = dict(zip(expected, coerced(spark, json_type, list(expected)), strict=True))
    assert found == expected


def test_int(spark):
    check(
        spark,
        "int",
        {
            "1": 1, "-7": -7, '"1"': 1, '"+5"': 5, '"007"': 7, "9223372036854775807": 2**63 - 1,
            "1.0": None, "1.5": None, "1e2": None, "true": None, '" 1"': None, '"1 "': None, '"1\\n"': None,
            '"1.0"': None, '""': None, '"+"': None, "9223372036854775808": None, '"9223372036854775808"': None,
            "null": None, "[1]": None, '{"a":1}': None,
        },
    )


def test_float(spark):
    check(
        spark,
        "float",
        {
            "1": 1.0, "1.5": 1.5, "1e2": 100.0, '"1e3"': 1000.0, '".5"': 0.5, '"1."': 1.0, '"-2.5E-1"': -0.25,
            '"inf"': math.inf, '"-Infinity"': -math.inf, '"+INF"': math.inf, "123456789.25": 123456789.25,
            "18446744073709551616": 18446744073709551616.0, '"."': None, '"e5"': None, "true": None,
            '" 1"': None, '"1 "': None, '"1d"': None, '"0x1p3"': None, '"1_0"': None, "null": None, "[1.5]": None,
        },
    )
    assert all(math.isnan(x) for x in coerced(spark, "float", ['"nan"', '"NaN"', '"-nan"', '"+NAN"']))


def test_boolean(spark):
    words = {f'"{w}"': True for w in ("true", "T", "1", "yes", "Y", " Yes ")}
    words |= {f'"{w}"': False for w in ("false", "F", "0", "no", "N", "\\tNo")}
    numbers = {"true": True, "false": False, "0": False, "1": True, "5": True, "-1": True}
    nothing = {"1.0": None, "0.0": None, '"5"': None, '"-1"': None, '"on"': None, '""': None, "null": None, "[true]": None, "[1]": None}
    check(spark, "boolean", words | numbers | nothing)


INSTANTS = {
    "2019-11-23T21:04:07.000Z": dt.datetime(2019, 11, 23, 21, 4, 7),
    "2019-11-23T21:04:07Z": dt.datetime(2019, 11, 23, 21, 4, 7),
    "2019-11-23 21:04:07.000": dt.datetime(2019, 11, 23, 21, 4, 7),
    "2019-11-23T21:04:07": dt.datetime(2019, 11, 23, 21, 4, 7),
    "2019-11-23T21:04:07.123": dt.datetime(2019, 11, 23, 21, 4, 7, 123000),
    "2019-11-23T21:04:07.123456Z": dt.datetime(2019, 11, 23, 21, 4, 7, 123456),
    "2019-11-23T21:04:07.123456789": dt.datetime(2019, 11, 23, 21, 4, 7, 123456),
    "2017-3-9 4:5:6": dt.datetime(2017, 3, 9, 4, 5, 6),
    "2019-11-23": dt.datetime(2019, 11, 23),
    "2019-11-23Z": dt.datetime(2019, 11, 23),
    "11/23/2019": dt.datetime(2019, 11, 23),
    "04/07/2018": dt.datetime(2018, 4, 7),
    "3/9/2017": dt.datetime(2017, 3, 9),
    "2016-02-29 00:00:00.000": dt.datetime(2016, 2, 29),
    "1970-01-01": dt.datetime(1970, 1, 1),
    "1969-12-31": dt.datetime(1969, 12, 31),
    " 2019-11-23": dt.datetime(2019, 11, 23),
    "2019-11-23T 9: 3: 1": dt.datetime(2019, 11, 23, 9, 3, 1),
    "11/23/19": dt.datetime(19, 11, 23),
    "2024-06-30T23:59:60": dt.datetime(2024, 7, 1),
    "2024-06-30 23:59:60.25Z": dt.datetime(2024, 7, 1, 0, 0, 0, 250000),
}
NO_INSTANTS = [
    "yesterday", "", "2019-13-40", "2019-02-29", "2024", "2024-01", "2019-11-23T21:04", "2019-11-23T21:04:07+00:00",
    "2019-11-23T21:04:07.", "2019-11-23 ", "2019-11-23ZZ", "2019-11-23T24:00:00", "12019-11-23", "23/11/2019",
    "2019-11-23\\n", "20240115",
]


def test_datetime(spark):
    expected = {f'"{t}"': v for t, v in INSTANTS.items()} | {f'"{t}"': None for t in NO_INSTANTS}
    check(spark, "dateTime", expected | {"20240115": None, "1.5": None, "true": None, "null": None})


def test_date(spark):
    expected = {f'"{t}"': v.date() for t, v in INSTANTS.items()} | {f'"{t}"': None for t in NO_INSTANTS}
    leap = {f'"{t}"': dt.date(2024, 6, 30) for t in INSTANTS if ":60" in t}
    check(spark, "date", expected | leap | {"20240115": None, "null": None})


def test_text(spark):
    same = {c: c for c in ("1", "-7", "true", "false", "[1,2]", "[]", "{}", "9223372036854775808", "18446744073709551615")}
    check(
        spark,
        "string",
        same
        | {
            '"x"': "x", '""': "", '" a "': " a ", '"1.50"': "1.50", '"[1, 2]"': "[1, 2]", '"{"': "{", '"1e5"': "1e5",
            '"12345678901234567890"': "12345678901234567890",
            "1.0": "1.0", "1.50": "1.5", "1e2": "100.0", "123456789.25": "123456789.25", "1.5e10": "15000000000.0",
            "1e15": "1000000000000000.0", "1e16": "1e16", "1.33e22": "1.33e22", "1.5e-7": "1.5e-7", "1e-5": "0.00001",
            "-0.5": "-0.5", "18446744073709551616": "1.8446744073709552e19",
            '{"b": 1, "a": [true, "q"]}': '{"a":[true,"q"],"b":1}',
            '{"b": 1.0, "a": [1.50, null, 1e-7]}': '{"a":[1.5,null,1e-7],"b":1.0}',
            "null": None,
        },
    )
    assert coerced(spark, "time", ['"21:04:07"']) == ["21:04:07"]
    assert coerced(spark, None, ["1.0"]) == ["1.0"]


def shortest(x: float) -> str:
    """The same layout from Python's shortest digits."""
    sign = "-" if math.copysign(1, x) < 0 else ""
    mantissa, _, exponent = repr(abs(x)).partition("e")
    whole, _, fraction = mantissa.partition(".")
    digits = (whole + fraction).lstrip("0")
    point = len(whole.lstrip("0")) or -(len(fraction) - len(fraction.lstrip("0")))
    point += int(exponent or 0)
    digits = digits.rstrip("0") or "0"
    if 0 < point <= 16:
        return sign + (digits.ljust(point, "0") + ".0" if len(digits) <= point else f"{digits[:point]}.{digits[point:]}")
    if -5 < point <= 0:
        return f"{sign}0.{'0' * -point}{digits}"
    return f"{sign}{digits[0]}{'.' + digits[1:] if len(digits) > 1 else ''}e{point - 1}"


def test_number_text_is_the_shortest(spark):
    rng = random.Random(7)
    numbers = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(1500)]
    numbers += [rng.choice([1, -1]) * rng.randrange(1, 10**6) * 10.0 ** rng.randrange(-12, 25) for _ in range(1500)]
    numbers = [x for x in numbers if math.isfinite(x) and abs(x) >= sys.float_info.min]
    # A number beyond 2**63 without a fraction may be an integer on the wire, so write an exponent.
    shown = coerced(spark, "string", [repr(x) if "e" in repr(x) else f"{x!r}e0" for x in numbers])
    assert [float(s) for s in shown] == numbers
    wrong = [(x, s, shortest(x)) for x, s in zip(numbers, shown, strict=True) if s != shortest(x)]
    assert wrong == []


def test_positions(spark):
    lines = spark.createDataFrame(
        [('["weir",12,"no",[1]]',), ('["mill",null,1]',), ('["lock"]',), (" ",), ('["dam",-3,null,"more",5]',)], "value string"
    )
    columns = [RemoteColumn("site", "string"), RemoteColumn("depth", "int"), RemoteColumn("open", "boolean")]
    df = rows_to_table(lines, columns)
    assert sorted(map(tuple, df.collect())) == [
        ("dam", -3, None), ("lock", None, None), ("mill", None, True), ("weir", 12, False)
    ]
    picked = rows_to_table(lines, columns[2:], ["site", "depth", "open"])
    assert picked.columns == ["open"]
    assert sorted(map(str, (r[0] for r in picked.collect()))) == ["False", "None", "None", "True"]


def test_nested_values_are_whole_at_any_depth(spark):
    deep = '[[[[[1.0,1e3,"1.0, [2.50]","q\\"1.0\\\\"]]]],{"z":{"y":{"x":{"w":{"v":2.50,"a":-0}}}}}]'
    check(
        spark,
        "string",
        {
            deep: '[[[[[1.0,1000.0,"1.0, [2.50]","q\\"1.0\\\\"]]]],{"z":{"y":{"x":{"w":{"a":-0.0,"v":2.5}}}}}]',
            '{"k":18446744073709551616,"j":18446744073709551615}': '{"j":18446744073709551615,"k":1.8446744073709552e19}',
            '{"a":1,"a":2}': '{"a":2}',
            '{"1.0":"\\u0001"}': '{"1.0":"\\u0001"}',
            "-0": "-0.0", "-0.0": "-0.0", '"-0"': "-0",
        },
    )
    check(spark, "int", {"-0": None, '"-0"': 0, "-0.0": None})


def test_no_cell_decides_another(spark):
    huge = '["' + "x" * 19_000_000 + '",1.0]'
    lines = spark.createDataFrame([(1, '[5,{"a":1,"a":2},1.50]'), (2, f"[7,{huge},2.50]"), (3, '["7",[1.0],"2.50"]')], "i int, value string")
    columns = [RemoteColumn("b", "boolean"), RemoteColumn("o", "string"), RemoteColumn("t", "string")]
    found = rows_to_table(lines.orderBy("i").coalesce(1), columns).collect()
    assert [(r.b, r.t) for r in found] == [(True, "1.5"), (True, "2.5"), (None, "2.50")]
    assert found[0].o == '{"a":2}' and len(found[1].o) >= len(huge) and found[2].o == "[1.0]"


@pytest.mark.parametrize("line", ["[1,2", '{"a":1}', "null", "hello"])
def test_a_broken_line_fails_the_job(spark, line):
    lines = spark.createDataFrame([("[1]",), (line,)], "value string")
    with pytest.raises(Exception, match="(?s)MALFORMED|malformed"):
        rows_to_table(lines, [RemoteColumn("id", "int")]).collect()


def test_awkward_strings_survive(spark):
    texts = ['say "hi"', "back\\slash", "tab\there", "line\nbreak", "ünï ☃ 😀", " ", "'quoted'", "null", "true"]
    assert coerced(spark, "string", [json.dumps(t) for t in texts]) == texts
