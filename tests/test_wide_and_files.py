"""Wide correlation matrices, panels, footer checks and files of a given size."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candleframe.operators import correlation, profile
from candleframe.sources import candles as candle_src
from candleframe.sources import sinks
from candleframe.sources.catalog import list_parquet_files

RETURN_DDL = "base_currency string, quote_currency string, year bigint, open_time timestamp_ntz, `return` double"


def returns(spark, keys, days, *, seed=1, groups=("Q",)):
    rng = np.random.default_rng(seed)
    rows = []
    for g in groups:
        for d in range(days):
            for k in keys:
                if rng.random() < 0.8:
                    rows.append((k, g, 2021 + d % 2, dt.datetime(2021 + d % 2, 1, 1) + dt.timedelta(days=d), None if rng.random() < 0.1 else float(rng.standard_normal())))
    rows += rows[:7]  # duplicates are averaged
    return rows, spark.createDataFrame(rows, RETURN_DDL)


def plain_matrix(rows, keys):
    cells = defaultdict(list)
    for k, g, y, t, v in rows:
        if v is not None:
            cells[g, y, t, k].append(v)
    series = defaultdict(dict)
    for (g, y, t, k), vs in cells.items():
        series[g, y, k][t] = sum(vs) / len(vs)
    out = {}
    for g, y in {(r[1], r[2]) for r in rows}:
        for a in keys:
            for b in keys:
                x, z = series[g, y, a], series[g, y, b]
                both = sorted(x.keys() & z.keys())
                u, w = (np.array([s[t] for t in both]) for s in (x, z))
                c = None if len(both) < 2 or u.std() == 0 or w.std() == 0 else float(((u - u.mean()) * (w - w.mean())).mean() / (u.std() * w.std()))
                out[g, y, a, b] = (len(both), c)
    return out


@pytest.mark.parametrize("n", [1, 3, 4, 10])
def test_matrix_of_any_width(spark, n):
    keys = [f"k{i:02d}" for i in range(n)]
    rows, df = returns(spark, keys, 30, groups=("Q", "R"))
    got = correlation.corr_across_bases(df, quotes=["Q", "R"], bases=keys, years=[2021, 2022]).collect()
    want = plain_matrix(rows, keys)
    assert len(got) == len(want) == 4 * n * n
    for r in got:
        m, c = want[r.quote_currency, r.year, r.base_a, r.base_b]
        assert r.n_obs == m and r.corr == (pytest.approx(c, abs=1e-9) if c is not None else None)


def test_seventy_five_keys_have_a_plan_of_the_size_of_ten(spark):
    def plan(n):
        keys = [f"k{i:02d}" for i in range(n)]
        _, df = returns(spark, keys[:10], 4)
        out = correlation.corr_across_bases(df, quotes=["Q"], bases=keys, years=[2021, 2022])
        text = out._jdf.queryExecution().optimizedPlan().toString()
        return out, text.count("covar_pop") + text.count("central_moment") + text.count("corr")

    small, a = plan(10)
    wide, b = plan(75)
    assert a == b
    rows = wide.collect()
    assert len(rows) == 2 * 75 * 75
    of = {(r.year, r.base_a, r.base_b): (r.n_obs, r.corr) for r in rows}
    assert all(of[r.year, r.base_a, r.base_b] == (r.n_obs, r.corr) for r in small.collect())
    assert of[2021, "k70", "k71"] == (0, None)


def test_no_years_and_no_keys(spark):
    _, df = returns(spark, ["a", "b"], 4)
    assert correlation.corr_across_bases(df.limit(0), quotes=["Q"], bases=["a"], years=None).collect() == []
    assert correlation.corr_across_bases(df, quotes=["Q"], bases=[], years=[2021]).collect() == []


def test_first_panels(spark):
    rows = [(b, y, q) for b in "cabdx" for y in (2022, 2017, 2019, 2018) for q in ("Q", "R")] + [(None, 2017, "Q"), ("a", None, "Q")]
    df = spark.createDataFrame(rows, "base_currency string, year long, quote_currency string")
    got = Counter(map(tuple, profile.first_panels(df, bases=3, years=2).collect()))
    assert got == Counter((b, y, q) for b in "abc" for y in (2017, 2018) for q in ("Q", "R"))
    assert profile.first_panels(df).count() == 40


def pair_file(directory, name, drop=None):
    kinds = {f.name: pa.float64() for f in candle_src.CANDLE_SCHEMA if f.name not in ("number_of_trades", "open_time")}
    cols = {k: pa.array([1.0], t) for k, t in kinds.items()}
    cols |= {"number_of_trades": pa.array([1], pa.int64()), "open_time": pa.array([dt.datetime(2021, 1, 1)], pa.timestamp("us"))}
    cols.pop(drop, None)
    pq.write_table(pa.table(cols), os.path.join(directory, name))


def test_footers_are_read_in_one_job(spark, tmp_path):
    for i in range(60):
        pair_file(str(tmp_path), f"B{i:02d}-Q {i % 3}.parquet", drop={7: "close", 8: "volume"}.get(i))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        with pytest.raises(candle_src.SchemaMismatch, match=r"2 of 60 pair files lack columns \(.*B07-Q 1.*close; .*B08-Q 2.*volume\)"):
            candle_src.check_columns(list_parquet_files(spark, str(tmp_path)))
        assert len(tracker.getJobIdsForGroup("footers")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(candle_src.SchemaMismatch, match="1 of 2"):
        candle_src.load_pair_files(spark, [f"file:{tmp_path}/B07-Q 1.parquet", f"{tmp_path}/B09-Q 0.parquet"])


def test_files_of_a_given_size_on_skewed_bases(spark, tmp_path):
    df = spark.range(10_000).select(
        F.when(F.col("id") < 7_000, "HOT").when(F.col("id") < 7_900, F.concat(F.lit("B"), F.col("id") % 5)).otherwise(None).alias("base_currency"),
        F.col("id").alias("v")).repartition(16)
    path = str(tmp_path / "out")
    sinks.write_by_size(df, path, file_rows=500)
    files = {f: pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*/*.parquet")}
    by = defaultdict(list)
    for f, n in files.items():
        by[os.path.basename(os.path.dirname(f)).split("=")[1]].append(n)
    assert {k: len(v) for k, v in by.items()} == {"HOT": 14, "__HIVE_DEFAULT_PARTITION__": 5} | {f"B{i}": 1 for i in range(5)}
    assert all(250 <= n <= 1_000 for k in ("HOT", "__HIVE_DEFAULT_PARTITION__") for n in by[k])
    assert {r.v for r in spark.read.parquet(path).collect()} == set(range(10_000))
    # The hot base is many tasks' work.
    spread = sinks.deal_by_size(df, file_rows=500).where("base_currency = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 14
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_by_size(df, path)


def test_write_by_size_of_no_rows(spark, tmp_path):
    sinks.write_by_size(spark.createDataFrame([], "base_currency string, v long"), str(tmp_path / "none"))
    assert os.path.exists(tmp_path / "none" / "_SUCCESS")
