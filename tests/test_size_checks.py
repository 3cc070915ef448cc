"""The size checks behind every explicit broadcast and single-task path."""

from stellate.functions.sizes import measured_bytes, parse_bytes
from stellate.operators.merge import choose_strategy


def test_measured_bytes_counts_values(spark):
    df = spark.createDataFrame([("abc", 1, None), ("", 2, "xy")], "s string, n long, t string")
    # strings: bytes + 8 each (NULL counts 0 + 8); long: 8
    assert measured_bytes(df) == (3 + 8 + 8 + 0 + 8) + (0 + 8 + 8 + 2 + 8)


def test_parse_bytes():
    assert parse_bytes("64m") == 64 << 20
    assert parse_bytes("1g") == 1 << 30
    assert parse_bytes("512kb") == 512 << 10
    assert parse_bytes(1234) == 1234


def test_choose_strategy_respects_the_bound(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert choose_strategy(df, max_bytes=10_000) == "broadcast"
    assert choose_strategy(df, max_bytes=100) == "shuffle"
    assert choose_strategy(df, strategy="shuffle") == "shuffle"
