"""URL filters: rule list first, then an empirical-Bayes host reputation (native only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleframe.llm.common import ascii_lower, checked_broadcast, free_name, stage

#: (verdict, rule): a rule is a host and a path prefix; it fits the host's subdomains too.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: A host is blocked when the lower bound of its bad-page rate is above the limit.
MAX_BAD_RATE = 0.5
Z = 1.645
#: Bounds of a level's prior strength, in pages.
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0
#: From the widest level to the host itself.
LEVELS = ["suffix", "domain", "host"]


def with_url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """``host`` and ``path`` of a URL; both '' for NULL or where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumns({
        "host": ascii_lower(F.regexp_extract(u, pattern, 1)),
        "path": F.regexp_extract(u, pattern, 2),
    })


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict), or NULL; ties to the later string."""
    found = []
    for verdict, rule in rules:
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        found.append(F.when(fits, F.struct(
            F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def host_levels(host: Column) -> dict[str, Column]:
    """A host's own registered domain (last two labels) and suffix (last label)."""
    return {
        "suffix": F.substring_index(host, ".", -1),
        "domain": F.substring_index(host, ".", -2),
    }


def reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """Posterior of the bad-page rate of every row of ``hosts`` (distinct host): mean and lower bound.

    ``outcomes`` (host, n, bad) are the labelled pages. Each level's rate is shrunk towards
    the one above it: all pages, suffix, registered domain, host. A level's strength is that
    of the beta prior whose variance matches the rates seen at that level, less what
    sampling explains. A host without labels keeps its domain's rate with the prior's
    uncertainty; with no labels at all every bound is 0.
    """
    seen = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    seen = seen.withColumns(host_levels(F.col("host")))
    top = seen.agg(F.coalesce(F.sum("bad") / F.sum("n"), F.lit(0.0)).alias("rate"))
    post = hosts.select("host").withColumns(host_levels(F.col("host")))
    post = post.withColumn("rate", top.scalar())
    for level in LEVELS:
        here = seen.groupBy(level).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        spread = F.col("m") * (1 - F.col("m"))
        between = F.col("v") - spread * F.col("inv_n")
        strength = here.agg(
            F.avg(F.col("bad") / F.col("n")).alias("m"), F.var_pop(F.col("bad") / F.col("n")).alias("v"),
            F.avg(1 / F.col("n")).alias("inv_n"),
        ).select(
            F.when(between > 0, F.greatest(F.lit(PRIOR_MIN), F.least(F.lit(PRIOR_MAX), spread / between - 1)))
            .otherwise(F.lit(PRIOR_MAX)).alias("k")
        )
        n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
        post = post.drop("n", "bad", "k").join(here, level, "left").withColumn("k", strength.scalar()).withColumns({
            "rate": (F.col("k") * F.col("rate") + bad) / (F.col("k") + n),
            "weight": F.col("k") + n,
        })
    bound = F.col("rate") - Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return post.select("host", F.col("rate").alias("bad_rate"), F.greatest(bound, F.lit(0.0)).alias("bad_bound"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, bad) of the labelled pages: a page's document is the number that ends its path.

    ``pages`` has host and path. A page is bad if its document's label says low quality or
    toxic. Several labels of one document count as one, bad if any is. Pages whose number
    has no label, or without a number, are not labelled.
    """
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    ).where(F.col("bad").isNotNull()).select(F.col("doc_id").alias("_doc"), "bad")
    doc = F.expr(r"try_cast(regexp_extract(path, '/([0-9]+)(?:[.][A-Za-z]+)?/?$', 1) as bigint)")
    numbered = pages.select("host", doc.alias("_doc")).where("_doc IS NOT NULL")
    return numbered.join(marked, "_doc").groupBy("host").agg(
        F.count("*").alias("n"), F.sum("bad").cast("long").alias("bad")
    )


def url_filter(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, url: str = "url"
) -> DataFrame:
    """Every page with host, path, rule, verdict, bad_bound; rules decide first, else the host's bound.

    A page whose longest fitting rule says allow or block gets that; any other is blocked
    iff the lower posterior bound of its host's bad-page rate is above MAX_BAD_RATE. NULL
    and malformed URLs share the host '' and are judged like any host. Repeated rows are
    all kept. Columns named like a new one are replaced; others pass through.
    """
    new = ["host", "path", "rule", "verdict", "bad_bound"]
    parts = with_url_parts(pages.drop(*[c for c in new if c != url]), url)
    outcomes = page_outcomes(parts.select("host", "path"), labels)
    rated = reputation(stage(outcomes, "outcomes"), parts.select("host").distinct())
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_bound") > MAX_BAD_RATE, F.lit("block")).otherwise(F.lit("allow"))
    at = free_name(parts.columns, "_hit")
    return (
        parts.withColumn(at, hit)
        .join(checked_broadcast(stage(rated.select("host", "bad_bound"), "hosts")), "host")
        .withColumn("rule", F.col(f"{at}.rule"))
        .withColumn("verdict", F.coalesce(F.col(f"{at}.verdict"), own))
        .drop(at)
    )
