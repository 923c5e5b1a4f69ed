"""Column functions on the cases that matter: blanks, bad input, signs, ties."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.functions import classify, dates, geo, ids, jsonmap, numbers, text, urls


@pytest.fixture(scope="module")
def value(spark):
    """value(expression): the single result of an expression of literals."""

    def run(*columns):
        row = spark.range(1).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return run


@pytest.mark.parametrize(("raw", "want"), [("  a  \n b ", "a b"), ("", None), ("   ", None), (None, None), ("0", "0")])
def test_clean(value, raw, want):
    assert value(text.clean(F.lit(raw).cast("string"))) == want


def test_address(value):
    assert value(text.normalize_address(F.lit("101 North Franklin Street, #5"))) == "101 N FRANKLIN ST 5"
    assert value(text.normalize_address(F.lit("101 north way"), directions=False)) == "101 NORTH WAY"
    assert tuple(value(text.address_parts(F.lit("123 N BAY ST, CITY FL 33602")))) == ("123", "N BAY ST", "33602")


@pytest.mark.parametrize(
    ("raw", "want"),
    [("1744934400000", dt.date(2025, 4, 18)), ("1744934400", dt.date(2025, 4, 18)), ("-2208988800000", None), ("08/13/2026", dt.date(2026, 8, 13)), ("8/3/26", dt.date(2026, 8, 3)), ("2026-08-13T23:00:00Z", dt.date(2026, 8, 13)), ("2026-02-30", None), ("nonsense", None), ("", None)],
)
def test_dates(value, raw, want):
    assert value(dates.parse_date(F.lit(raw), 2000, 2100)) == want


def test_local_day_and_months(value):
    ts = dates.parse_timestamp(F.lit("2026-10-01T01:16:00Z"))
    assert value(dates.local_date(ts, "America/New_York")) == dt.date(2026, 9, 30)
    a, b = F.to_date(F.lit("2026-09-30")), F.to_date(F.lit("2026-10-31"))
    assert value(dates.is_month_end(a), dates.adjacent_months(a, b), dates.interval_kind(a, b, "2026-08-23", "2026-09-30")) == (True, True, "month_end_to_month_end")
    assert value(dates.interval_kind(F.to_date(F.lit("2026-08-23")), a, "2026-08-23", "2026-09-30")) == "baseline_followup"


@pytest.mark.parametrize(("raw", "want"), [("$1,234.50", 1234.5), ("(12.00)", -12.0), ("n/a", None), ("", None), ("0", 0.0)])
def test_money(value, raw, want):
    got = value(numbers.money(F.lit(raw)))
    assert (None if got is None else float(got)) == want


def test_rates_and_intervals(value):
    assert value(numbers.rate(F.lit(1), F.lit(0))) is None
    w = value(numbers.wilson(F.lit(94), F.lit(100)))
    assert (round(w.estimate, 4), round(w.lower, 4), round(w.upper, 4)) == (0.94, 0.8752, 0.9722)
    assert value(numbers.wilson(F.lit(0), F.lit(0))) is None
    assert value(numbers.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(111194.93, abs=0.1)


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="=+-@'12.e \tab", max_size=8))
def test_csv_cells_come_back(value, raw):
    safe = text.neutralize_csv_cell(F.lit(raw))
    assert value(text.restore_csv_cell(safe)) == raw


def test_csv_cells(value):
    for raw, want in (("=1+1", "'=1+1"), ("-5.2", "-5.2"), ("+a", "'+a"), ("  @x", "'  @x"), ("plain", "plain"), ("'-5", "''-5")):
        assert value(text.neutralize_csv_cell(F.lit(raw))) == want


def test_maps(value):
    m = jsonmap.json_map(F.lit('{"Status": "Open", "status": " Shut ", "n": 100.0, "x": null}'))
    low = jsonmap.lower_keys(m)
    assert value(jsonmap.lookup(low, "missing", "STATUS")) == "Shut"
    assert value(jsonmap.json_map(F.lit("[1]"), strict=True)) is None and value(F.size(jsonmap.json_map(F.lit("nonsense")))) == 0
    old, new = F.create_map(F.lit("a"), F.lit("1"), F.lit("OBJECTID"), F.lit("1")), F.create_map(F.lit("a"), F.lit(" 1"), F.lit("b"), F.lit("2"), F.lit("OBJECTID"), F.lit("2"))
    assert value(jsonmap.changed_keys(old, new, ["objectid"])) == ["b"]
    assert value(jsonmap.field_value(F.lit('{"Cost": "5"}'), "cost"), jsonmap.field_value(F.lit("raw"), "cost")) == ("5", "raw")


def test_ids(value):
    import hashlib

    assert value(ids.short_id("chg", F.lit("a"), F.lit(None).cast("string"), F.lit(3))) == "chg-" + hashlib.sha1(b"a||3").hexdigest()[:16]
    assert value(ids.map_hash(F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2")))) == hashlib.sha256(b'{"a":"2","b":"1"}').hexdigest()


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i long, s string")
    b = spark.createDataFrame([(None, 2), ("x", 1)], "s string, i long")
    assert ids.fingerprint(a).first() == ids.fingerprint(b).first() != ids.fingerprint(a.union(a)).first()


def test_geometry(value):
    square = '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}'
    rings = F.from_json(F.lit(square), "struct<coordinates:array<array<array<double>>>>")["coordinates"]
    for x, y, want in ((3.0, 3.0, True), (1.5, 1.5, False), (5.0, 1.0, False)):
        assert value(geo.in_polygon(F.lit(x), F.lit(y), rings)) is want
    assert value(F.size(geo.vertices(F.lit(square)))) == 10
    assert tuple(value(geo.centroid(geo.vertices(F.lit('{"type":"Point","coordinates":[1.5,2.5]}'))))) == (1.5, 2.5)


def test_urls(value):
    tiers = {"example.gov": 1, "example.org": 2}
    for url, want in (
        ("https://data.example.gov/x", (1, "allowed")), ("http://example.gov/", (None, "not_https")), ("https://u@example.gov/", (None, "user_info")),
        ("https://example.gov:8443/", (None, "port")), ("https://badexample.gov/", (None, "host_not_listed")), ("nonsense", (None, "invalid_url")),
    ):
        assert tuple(value(urls.source_tier(F.lit(url), tiers))) == want


def test_classes(value):
    assert value(classify.stage(F.lit("Final Inspection"), F.lit(False))).stage == "completed_or_closeout"
    assert value(classify.activity_class(F.lit("Demo and rebuild"), F.lit("Demo and rebuild"), F.lit(None).cast("double"))) == "building_construction"
    n = F.lit(None).cast("date")
    assert value(classify.date_movement(F.lit("x"), F.lit("y"), n, n)) == "unparseable"
    assert value(classify.date_movement(F.lit(""), F.lit("y"), n, n)) == "value_added"
