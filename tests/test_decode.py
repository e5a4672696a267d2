"""Message bytes to rows."""

import pytest
from pyspark.sql import functions as F

from feedloom.operators.decode import decodable, decode
from feedloom.operators.validity import split_valid
from feedloom.schemas import CREATED_USER, strings

SCHEMA = strings(["id", "post_code", "email"])

# value -> (id, post_code, email), and whether the text is seen as corrupt
GOLDEN = [
    ('{"id":"a","post_code":"x","email":"e"}', ("a", "x", "e"), False),
    ('{"id":"a","postcode":123,"email":"e"}', ("a", None, "e"), False),
    ('{"post_code":123,"email":1.50,"id":true}', ("true", "123", "1.5"), False),
    ('{"post_code":1e3,"email":12345678901234567890}', (None, "1000.0", "12345678901234567890"), False),
    ('{"id":{"n":1},"post_code":[1,2],"email":null}', ('{"n":1}', "[1,2]", None), False),
    ('{"ID":"upper"}', (None, None, None), False),
    ('{"id":"a","id":"b"}', ("b", None, None), False),
    ('{"id":"a"} trailing', ("a", None, None), False),
    ("{'id':'single'}", ("single", None, None), False),
    ('{"id":"ok","email":NaN}', ("ok", None, '"NaN"'), False),
    ("{}", (None, None, None), False),
    ('{"post_code":01234}', (None, None, None), True),
    ('{"id":"tr', (None, None, None), True),
    ("not json", (None, None, None), True),
    ('"str"', (None, None, None), True),
    ("5", (None, None, None), True),
    ("[]", (None, None, None), True),
    ("", (None, None, None), False),
    (None, (None, None, None), False),
]


@pytest.fixture
def messages(spark):
    rows = [(i, None if v is None else bytearray(v, "utf-8")) for i, (v, _, _) in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, "offset long, value binary")


def test_golden(messages):
    rows = decode(messages, SCHEMA, keep=["offset"], corrupt_col="corrupt").orderBy("offset").collect()
    assert len(rows) == len(GOLDEN)
    for row, (value, fields, corrupt) in zip(rows, GOLDEN):
        assert (row.id, row.post_code, row.email) == fields, value
        assert row.corrupt == (value if corrupt else None), value


def test_undecodable_messages_are_kept_apart(messages):
    rows = decode(messages, SCHEMA, keep=["offset"], corrupt_col="corrupt")
    good, bad = split_valid(rows, {"undecodable": decodable(SCHEMA, "corrupt")})
    expected = {i for i, (_, fields, _) in enumerate(GOLDEN) if fields == (None, None, None)}
    assert {r.offset for r in bad.collect()} == expected
    assert {r.offset for r in good.collect()} == set(range(len(GOLDEN))) - expected


def test_drift_is_bridged_only_on_request(spark):
    message = spark.createDataFrame([(bytearray(b'{"postcode": 7, "email": "e"}'),)], "value binary")
    plain = decode(message, CREATED_USER).first()
    assert plain.id is None and plain.post_code is None and plain.email == "e"
    bridged = decode(message, CREATED_USER, field_aliases={"postcode": "post_code"},
                     key_expr={"id": F.md5("email")}).first()
    assert bridged.post_code == "7" and len(bridged.id) == 32
    assert list(bridged.asDict()) == CREATED_USER.fieldNames()
