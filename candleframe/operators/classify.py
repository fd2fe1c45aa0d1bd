"""Currency classification: by quote (notebook rule) and by base (extract rule)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleframe.schema import (
    BASE,
    BASE_FIATS,
    BASE_STABLECOINS,
    DEFAULT_CLASS,
    QUOTE,
    QUOTE_CLASSES,
)


def classify_by_quote(
    df: DataFrame,
    classes: Mapping[str, Sequence[str]] = QUOTE_CLASSES,
    *,
    default: str = DEFAULT_CLASS,
    column: str = "classification",
) -> DataFrame:
    """``classification`` from the quote currency: first class whose list holds it, else default.

    A ``CASE WHEN quote IN (...)`` chain: a per-row expression inside codegen, no join.
    """
    expr = None
    for name, quotes in classes.items():
        cond = F.col(QUOTE).isin(list(quotes))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(column, expr)


BASE_CLASS_SCHEMA = T.StructType(
    [T.StructField(BASE, T.StringType(), False), T.StructField("classification", T.StringType(), False)]
)


def base_class_dimension(
    spark,
    stablecoins: Sequence[str] = BASE_STABLECOINS,
    fiats: Sequence[str] = BASE_FIATS,
    cryptos: Sequence[str] = (),
) -> DataFrame:
    """(base_currency, classification) rows built from the lists; first listing wins.

    Precedence follows the extract rule: crypto, then stablecoin, then fiat-backed. Its size
    is the total length of the lists, so it is safe to broadcast.
    """
    rows: dict[str, str] = {}
    for name, bases in (
        ("cryptocurrency", cryptos),
        ("stablecoin", stablecoins),
        ("fiat_backed", fiats),
    ):
        for b in bases:
            rows.setdefault(b, name)
    return spark.createDataFrame(sorted(rows.items()), BASE_CLASS_SCHEMA)


def classify_by_base(
    df: DataFrame,
    stablecoins: Sequence[str] = BASE_STABLECOINS,
    fiats: Sequence[str] = BASE_FIATS,
    cryptos: Sequence[str] = (),
    *,
    default: str = DEFAULT_CLASS,
) -> DataFrame:
    """``classification`` of each row's base via a broadcast left join to the class dimension."""
    dim = base_class_dimension(df.sparkSession, stablecoins, fiats, cryptos)
    if "classification" in df.columns:
        df = df.drop("classification")
    return df.join(F.broadcast(dim), on=BASE, how="left").withColumn(
        "classification", F.coalesce(F.col("classification"), F.lit(default))
    )
