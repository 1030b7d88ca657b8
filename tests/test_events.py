"""Folds and record functions keep keys and columns as they are."""

from datetime import date
from decimal import Decimal

from concord.operators import events, hooks

BIG = 1 << 60


def test_capped_tells_large_and_missing_keys_apart(spark):
    rows = [(BIG + 1, 1, "a", None), (BIG + 3, 2, "b", 7), (None, 3, "c", BIG + 1), (None, 4, "d", 1), (None, 5, "e", 2), (BIG + 1, 6, "f", 3)]
    found = events.capped(spark.createDataFrame(rows, "k long, us long, id string, other long").coalesce(1), "k", "us", "id", 1).collect()
    assert sorted((r.id, r.k, r.other, r.admitted) for r in found) == [
        ("a", BIG + 1, None, True), ("b", BIG + 3, 7, True), ("c", None, BIG + 1, True), ("d", None, 1, False), ("e", None, 2, False), ("f", BIG + 1, 3, False)]


def test_breaker_folds_decimal_and_nan_keys(spark):
    rows = [(Decimal("1.1"), 0, True), (Decimal("1.1"), 1, True), (Decimal("1.2"), 0, True), (None, 0, True), (None, 1, True), (None, 2, True)]
    found = events.breaker(spark.createDataFrame(rows, "k decimal(20,1), us long, bad boolean"), "k", "us", "bad", "bad", threshold=2).collect()
    assert sorted((str(r.k), r.us, r.breaker) for r in found) == [("1.1", 0, "closed"), ("1.1", 1, "closed"), ("1.2", 0, "closed"), ("None", 0, "closed"), ("None", 1, "closed"), ("None", 2, "open")]
    nan = float("nan")
    found = events.breaker(spark.createDataFrame([(nan, k, True) for k in range(4)], "k double, us long, bad boolean"), "k", "us", "bad", "bad", threshold=2).collect()
    assert [r.breaker for r in sorted(found, key=lambda r: r.us)] == ["closed", "closed", "open", "open"]


def test_record_hook_leaves_columns_alone(spark):
    rows = [(BIG + 1, '{"a":1}', date(2024, 1, 1), [1, None]), (None, "no json", None, None), (BIG + 3, None, None, [])]
    table = spark.createDataFrame(rows, "id long, raw string, day date, list array<int>").coalesce(1)
    found = hooks.record_hook(table, "raw", lambda r: {**r, "seen": True} if "_raw" not in r else None).collect()
    assert [tuple(r) for r in found] == [
        (BIG + 1, '{"a":1}', date(2024, 1, 1), [1, None], '{"a":1,"seen":true}', "upserted"), (None, "no json", None, None, None, "dropped"), (BIG + 3, None, None, [], '{"seen":true}', "upserted")]
