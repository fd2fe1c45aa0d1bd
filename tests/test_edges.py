"""Edge cases of parsing, sampling, classification and the p-value."""

from __future__ import annotations

import math

import pytest

from candleframe.functions.stats import student_t_two_sided_p
from candleframe.operators import classify, sampling
from candleframe.sources import catalog as cat


def test_pair_names_with_extra_dashes_take_the_second_field(spark):
    df = spark.createDataFrame([("BTC-UP-USDT.parquet",), ("1INCH-BUSD.parquet",), ("NODASH.parquet",), ("-EUR.parquet",)], "file_name string")
    got = sorted((r.base_currency, r.quote_currency) for r in cat.pair_catalog(df).collect())
    assert got == [("1INCH", "BUSD"), ("BTC", "UP")]


def test_sample_larger_than_key_set_returns_all_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    assert sorted(r.k for r in sampling.seeded_key_sample(df, "k", k=5).collect()) == ["a", "b"]


def test_sample_depends_on_seed_only(spark):
    df = spark.createDataFrame([(f"K{i}",) for i in range(50)], "k string")
    a = [r.k for r in sampling.seeded_key_sample(df, "k", k=3, seed=42).collect()]
    b = [r.k for r in sampling.seeded_key_sample(df.repartition(7), "k", k=3, seed=42).collect()]
    c = [r.k for r in sampling.seeded_key_sample(df, "k", k=3, seed=7).collect()]
    assert a == b and a != c


def test_empty_class_map_gives_default(spark):
    df = spark.createDataFrame([("EUR",)], "quote_currency string")
    assert classify.classify_by_quote(df, {}).first().classification == "cryptocurrency"


@pytest.mark.parametrize("r,n", [(0.01, 40002), (0.002, 1_000_002), (-0.05, 5001)])
def test_p_value_large_n_matches_normal_limit(spark, r, n):
    t = abs(r) * math.sqrt((n - 2) / (1 - r * r))
    normal_p = math.erfc(t / math.sqrt(2))
    df = spark.createDataFrame([(r, n)], "r double, n bigint")
    got = df.select(student_t_two_sided_p("r", "n").alias("p")).first().p
    assert got == pytest.approx(normal_p, abs=2e-4)
