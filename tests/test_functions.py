"""Scalar edge cases."""

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.functions import dates, hashing, money, text, urls


def values(spark, column, rows, ddl="v string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ddl)
    return [r[0] for r in df.select(column).collect()]


def test_missing_values_are_null(spark):
    v = F.col("v")
    assert values(spark, text.clean_text(v), [None, "    ", " a \n\t b "]) == [None, None, "a b"]
    assert values(spark, text.parse_int(v), ["abc", "12 000 items 5", None]) == [None, 12000, None]
    assert values(spark, text.parse_decimal(v), ["abc", "-1 250,5 x", "3.5"]) == [None, Decimal("-1250.5"), Decimal("3.5")]
    assert values(spark, urls.project_id(v), ["https://m.example.org/projects/nope", "/projects/1000000000000/a.html"]) == [None, 10**12]
    assert values(spark, urls.username(v), ["https://m.example.org/nope", "/users/a-b/?x=1"]) == [None, "a-b"]


def test_money(spark):
    got = values(spark, money.parse_money(F.col("v")), [
        "10 000 руб. Срок: 2 дня, ответов: 7", "по договоренности", "", "2 3", "100 000 ₽ – 180 000 ₽", "5 eur or 6 $ or руб",
    ])
    assert (got[0]["amount_min"], got[0]["amount_max"], got[0]["currency"]) == (10_000, 10_000, "RUB")
    assert got[1]["negotiable"] and got[1]["amount_min"] is None
    assert got[2] is None
    assert got[3]["amount_min"] == 23 and got[3]["currency"] is None
    assert (got[4]["amount_min"], got[4]["amount_max"]) == (100_000, 180_000)
    assert got[5]["currency"] == "RUB"


NOW = "2026-07-25 09:00:00"  # noon in Moscow


@pytest.mark.parametrize(
    ("words", "now", "expected"),
    [
        ("сегодня 10:30", NOW, datetime(2026, 7, 25, 7, 30)),
        ("вчера 09:00", NOW, datetime(2026, 7, 24, 6, 0)),
        ("2 часа назад", NOW, datetime(2026, 7, 25, 7, 0)),
        ("3 дня назад", NOW, datetime(2026, 7, 22, 9, 0)),
        ("1 месяц назад", NOW, datetime(2026, 6, 25, 9, 0)),
        ("31 февраля 2026", NOW, None),
        ("25 июля", NOW, datetime(2026, 7, 24, 21, 0)),
        ("5 штук назад", NOW, None),
        ("сегодня 00:15", "2026-01-01 21:30:00", datetime(2026, 1, 1, 21, 15)),
        ("вчера 23:59", "2026-01-01 21:30:00", datetime(2026, 1, 1, 20, 59)),
        ("31 декабря", "2026-01-02 00:00:00", datetime(2025, 12, 30, 21, 0)),
        ("12000000000 минут назад", NOW, None),
    ],
)
def test_russian_dates(spark, words, now, expected):
    column = dates.parse_ru_datetime(F.col("v"), F.lit(now).cast("timestamp"))
    assert values(spark, F.date_format(column, "yyyy-MM-dd HH:mm"), [words]) == [
        expected and expected.strftime("%Y-%m-%d %H:%M")
    ]


def test_headers(spark):
    v, now = F.col("v"), F.lit("2026-07-25 12:00:00").cast("timestamp")
    assert values(spark, dates.parse_retry_after(v, now), ["5", "-3", "Sat, 25 Jul 2026 12:01:00 GMT", "Sat, 25 Jul 2020 12:01:00 GMT", "soon"]) == [
        5.0, 0.0, 60.0, 0.0, None,
    ]


@pytest.mark.parametrize(
    ("base", "value", "expected"),
    [
        ("https://e.org/a/b?q=1", "c", "https://e.org/a/c"),
        ("https://e.org/a/b?q=1", "../c", "https://e.org/c"),
        ("https://e.org/a/b/", "../../../c", "https://e.org/c"),
        ("https://e.org/a/b?q=1", "?z=2", "https://e.org/a/b?z=2"),
        ("https://e.org/a/b?q=1", "#f", "https://e.org/a/b?q=1#f"),
        ("https://e.org/a/b", "//o.org/x", "https://o.org/x"),
        ("https://e.org", "x", "https://e.org/x"),
        ("https://e.org/a", "", None),
        ("https://e.org/a", "javascript:void(0)", "javascript:void(0)"),
        ("https://e.org/a", "/b/./c/..", "https://e.org/b/"),
        ("https://e.org/a", " /b\n", "https://e.org/b"),
    ],
)
def test_url_resolution(spark, base, value, expected):
    assert values(spark, urls.absolute_url(F.lit(base), F.col("v")), [value]) == [expected]


def test_with_page_keeps_other_values(spark):
    got = values(spark, urls.with_page(F.col("v"), F.lit(3)), ["https://e.org/p?a=1&page=2&b=&a=2", "https://e.org/p?q=%D0%B0+b"])
    assert got == ["https://e.org/p?a=1&a=2&page=3&b=", "https://e.org/p?q=%D0%B0+b&page=3"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(secret=st.text("abcXYZ0189", min_size=6, max_size=12), key=st.sampled_from(["token", "api_key", "PASSWORD", "signature"]))
def test_no_credential_leaks(spark, secret, key):
    url = f"https://{secret}:{secret}@Host.example.org:8443/p?{key}={secret}&x=1"
    [safe] = values(spark, urls.redact_url(F.col("v")), [url])
    assert secret not in safe and "x=1" in safe and "host.example.org:8443" in safe


def test_record_hash_sees_every_field(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "x"), (1, "a", None)], "id long, t string, n string")
    a, b, c = [r[0] for r in df.select(hashing.record_hash(["id", "t", "n"])).collect()]
    assert a == c != b


def test_jaccard(spark):
    df = spark.createDataFrame([([], []), (["a"], ["a", "b"])], "l array<string>, r array<string>")
    assert [r[0] for r in df.select(hashing.jaccard(F.col("l"), F.col("r"))).collect()] == [1.0, 0.5]
