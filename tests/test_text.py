import json
import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.redact import (
    CASE_PARTNERS, MASK, redact_json, redact_json_native, redact_map, redact_nested, redact_text,
)
from tidemark.functions.text import cap_payload, payload_size
from tidemark.functions.timestamps import parse_iso, parse_since, uptime_text
from tidemark.operators.logs import log_rows

UTC = timezone.utc


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-04-01T10:00:00Z", datetime(2026, 4, 1, 10)),
        ("2026-04-01T10:00:00+07:00", datetime(2026, 4, 1, 3)),
        ("2026-04-01T10:00:00-0330", datetime(2026, 4, 1, 13, 30)),
        ("2026-04-01 10:00:00.123456", datetime(2026, 4, 1, 10, 0, 0, 123456)),
        ("2026-04-01T10:00:00,5Z", datetime(2026, 4, 1, 10, 0, 0, 500000)),
        ("2026-04-01T10:00", datetime(2026, 4, 1, 10)),
        ("2026-04-01 10:00+07:00", datetime(2026, 4, 1, 3)),
        ("2026-04-01T10", datetime(2026, 4, 1, 10)),
        ("2026-04-01", datetime(2026, 4, 1)),
        ("20260401T100000Z", datetime(2026, 4, 1, 10)),
        ("20260401T100000", datetime(2026, 4, 1, 10)),
        ("20260401T100000.25+0700", datetime(2026, 4, 1, 3, 0, 0, 250000)),
        ("2026", None), ("2026-04", None), ("10:00:00", None), ("", None), ("yesterday", None), (None, None),
        ("2026-13-01T00:00:00Z", None), ("2026-W14-1", None),
    ],
)
def test_parse_iso(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string").select(parse_iso("t").cast("timestamp_ntz").alias("v"))
    assert frame.first().v == expected


def test_parse_since():
    assert parse_since("1h") == timedelta(hours=1) and parse_since("30m") == timedelta(minutes=30)
    assert parse_since("1.5d") == timedelta(days=1.5)
    assert all(parse_since(x) is None for x in ("", "h", "10", "1w", "x1h", "infh", "nanm"))


@pytest.mark.parametrize("seconds, text", [(0, "0m"), (3599, "59m"), (3600, "1h 0m"), (86399, "23h 59m"), (90000, "1d 1h")])
def test_uptime(spark, seconds, text):
    assert spark.range(1).select(uptime_text(F.lit(seconds)).alias("t")).first().t == text


TEXTS = [
    "token: abcdefgh1234", "TOKEN=abcdefgh", 'password" : "hunter2hunter2"', "api_key='0123456789abc'", "bearer: short12",
    "secret=aaaabbbb&token=ccccdddd", "no secrets: here", "x token  = abcdefgh9", "toKen=abcdefgh12",
    "ſecret=abcdefgh12", "access_token=éèêëàâäîïôö", "", None, "token:\nabcdefghij, next", "token = 1234567",
]


def expected_redaction(text):
    pattern = r"""(?i)(token|password|secret|api_key|bearer)["']?\s*[:=]\s*["']?([^\s"',&]{8,})"""
    return None if text is None else re.sub(pattern, lambda m: f"{m[1]}=***{m[2][-4:]}", text)


def test_redact_text(spark):
    got = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", redact_text("t").alias("r")).collect()
    assert [r.r for r in got] == [expected_redaction(r.t) for r in got]


def test_redact_map_and_nested(spark):
    schema = T.StructType().add("a", T.StructType().add("Api_Key", "string").add("n", T.IntegerType())).add(
        "m", T.MapType(T.StringType(), T.StringType())
    ).add("l", T.ArrayType(T.StringType()))
    rows = spark.createDataFrame([(("k", 1), {"X-Token": "t", "b": "token=abcdefgh"}, ["secret=abcdefgh"]), (None, None, None)], schema)
    value = F.struct(*rows.columns)
    got = rows.select(redact_nested(value, schema).alias("v")).collect()
    assert got[0].v.asDict(True) == {
        "a": {"Api_Key": MASK, "n": 1}, "m": {"X-Token": MASK, "b": "token=***efgh"}, "l": ["secret=***efgh"]
    }
    assert got[1].v.asDict(True) == {"a": None, "m": None, "l": None}
    assert rows.select(redact_map(F.col("m")).alias("m")).first().m["X-Token"] == MASK


def test_redact_json(spark):
    node = {"a": [{"password": {"x": 1}, "note": "token=abcdefgh"}], "n": 1.5, "t": None, "é": "é"}
    rows = spark.createDataFrame([(json.dumps(node),), ("token=abcdefgh {",), (None,)], "j string")
    got = [r.r for r in rows.select(redact_json("j").alias("r")).collect()]
    assert json.loads(got[0]) == {"a": [{"password": MASK, "note": "token=***efgh"}], "n": 1.5, "t": None, "é": "é"}
    assert got[1] == "token=***efgh {" and got[2] is None


def json_texts():
    """Texts of JSON values, and texts that are nearly JSON."""
    rng = random.Random(5)
    words = [
        "", "a", "note", "token", "my_PASSWORD_x", "é€", "\U0001f600", 'q"\\/', "x\n\r\t\f\b\x01\x1f\x7f", "token=abcdefgh",
        'secret: "abcdefghij"', "[{,:}]", "api_key", *(f"to{sign}en=12345678" for sign in CASE_PARTNERS), "\u2028",
    ]

    def node(depth):
        kind = rng.randrange(8 if depth else 6)
        if kind == 6:
            return [node(depth - 1) for _ in range(rng.randrange(4))]
        if kind == 7:
            return {rng.choice(words): node(depth - 1) for _ in range(rng.randrange(5))}
        return [rng.choice(words), rng.choice(words), True, None, rng.randrange(-5, 10**20), rng.choice([1.5, -1e-9, 0.0])][kind]

    whole = [
        json.dumps([node(5), {w: node(3) for w in rng.sample(words, 3)}][:rng.randrange(3)], ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), allow_nan=True)
        for _ in range(150)
    ]
    broken = []
    for text in whole:
        at = rng.randrange(len(text) + 1)
        broken += [text[:at], text[:at] + rng.choice('{}[]:,"\\ 0x') + text[at:], text[:at] + text[at + 1:]]
    return whole + broken + [
        "", " ", "{}", "[]", "[ ]", "{ }", "[1,]", '{"a":1,}', '{"a"}', '{"a":}', '{1:2}', "1 2", "-", "01", "1.", ".5", "1e5",
        "-0", "NaN", "[-Infinity]", "+1", "tru", "nul", '"a" "b"', "'a'", '"\\x"', '"\\u12"', '"\n"', "\ufeff{}", "\x0c[]", "]", "}{",
        '{"token": {"a": [1, {"token": 2}], "b": "]}"}, "password": [], "x": "token=abcdefgh"}', '{"a": 1, "a": 2}',
        '{"to\\u006ben": 1, "n": "\\/ \\u00e9 \\ud83d\\ude00"}', '[{"secret": null}, {"secret": 1.50}]', "[[[[]]], 1.10, 1E2]",
        '{"a": "' + "\\n" * 20_000 + '", "token": "' + "x" * 100_000 + '"}', "[" * 300 + "]" * 300, '"' * 2001,
    ]


def test_redact_json_native(spark):
    texts = json_texts()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, j string")
    native = rows.select("i", "j", redact_json_native("j").alias("r"))
    assert not any(python in native._jdf.queryExecution().toString() for python in ("Python", "Arrow"))
    expected = {r.i: r.r for r in rows.select("i", redact_json("j").alias("r")).collect()}
    for row in native.collect():
        assert row.r == expected[row.i], row.j[:300]
    assert sum(MASK in (r or "") for r in expected.values()) > 50


PAYLOADS = [{}, {"a": "x"}, {"a": "x\n\"\\\t", "b": "é€"}, {"a": "\U0001f600\x7f", "é": "1"}, {"a": "x" * 10_229}, {"a": "x" * 10_232}]


@pytest.mark.parametrize("payload", PAYLOADS)
def test_payload_cap(spark, payload):
    frame = spark.createDataFrame([(payload,)], "m map<string,string>")
    row = frame.select(payload_size(F.col("m")).alias("n"), cap_payload(F.col("m")).alias("p")).first()
    size = len(json.dumps(payload))
    assert row.n == size
    expected = {"_truncated": True, "original_size": size} if size > 10_240 else payload
    assert json.loads(row.p) == expected


def test_log_rows(spark):
    events = [
        {"level": "debug", "event": "hidden"},
        {"event": "no level", "timestamp": "2026-04-01T10:00:00Z", "token": "t", "_x": "1", "master_key": "m", "n": "1"},
        {"level": "error", "event": "boom", "exc_info": "at token=abcdefgh12", "pipeline": "p"},
        {"level": "strange", "event": "unknown level"},
    ]
    rows = spark.createDataFrame([(e,) for e in events], "fields map<string,string>")
    got = {r.event: r for r in log_rows(rows).collect()}
    assert set(got) == {"no level", "boom"}
    assert json.loads(got["no level"].payload) == {"token": MASK, "master_key": MASK, "n": "1"}
    assert got["no level"].level == "INFO" and got["no level"].message == "no level"
    assert got["boom"].exc_info == "at token=***gh12" and got["boom"].payload == "{}"
    assert log_rows(rows, min_level="DEBUG").count() == 4
