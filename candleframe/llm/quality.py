"""Quality rules with host-level verdicts (native Spark expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleframe.llm.common import WS_CHARS, WS_CLASS, checked_broadcast, free_name, free_prefix, stage, words_of

#: Characters that count as symbols, and the word windows that count as repeats.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: A document fails with fewer words, or with a greater share of repeated words.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A host fails when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the prior's strength, in documents.
PRIOR_MIN, PRIOR_MAX = 2.0, 1000.0


def _window_hashes(hashes: Column, n: Column) -> Column:
    """One hash for every run of ``WINDOW`` words."""
    return F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    NULL and empty texts have no words. Repeated words: positions covered by 8-word
    windows that occur twice or more in the text. Windows are compared by a 64-bit hash;
    only texts where two hashes agree sort them (hash, position), the rest stop there.
    Any extra columns pass through unless they carry one of the new names, in any case, which win.
    """
    pre = free_prefix(docs.columns, "_q_")
    t = F.coalesce(F.col(text), F.lit(""))
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    keep = [c for c in docs.columns if c.lower() not in new]
    worded = F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{WS_CLASS[1:-1]}]"))
    one = docs.select(
        *keep,
        F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias(f"{pre}hashes"),
        F.char_length(F.translate(t, WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        worded.alias(f"{pre}lines"),
    )
    two = one.select(
        *keep, "word_chars", "n_symbols",
        F.size(f"{pre}hashes").cast("long").alias("n_words"),
        (F.size(f"{pre}lines") - F.size(F.array_distinct(f"{pre}lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col(f"{pre}hashes"), F.size(f"{pre}hashes")).alias(f"{pre}win"),
    )
    three = two.select(
        *keep, "word_chars", "n_symbols", "n_words", "n_dup_lines",
        F.when(
            F.size(F.array_distinct(f"{pre}win")) < F.size(f"{pre}win"),
            F.array_sort(F.transform(f"{pre}win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias(f"{pre}sorted"),
    )
    s = F.col(f"{pre}sorted")
    twice = F.filter(
        s,
        lambda x, k: F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(s, F.greatest(k - 1, F.lit(0)))["h"], F.lit(False)) & (k > 0),
    )
    four = three.select(
        *keep, "word_chars", "n_symbols", "n_words", "n_dup_lines",
        F.array_sort(F.transform(twice, lambda x: x["i"])).alias(f"{pre}pos"),
    )
    p = F.col(f"{pre}pos")
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda acc, x: acc + x,
    )
    return four.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def host_rates(features: DataFrame, host: str, failed: str) -> DataFrame:
    """Per host: n, failures, and the failure rate shrunk by an empirical beta prior.

    The prior's mean is the mean of the host rates; its strength comes from their variance
    less the part that sampling explains (method of moments), kept within
    [PRIOR_MIN, PRIOR_MAX]. Hosts may be many: the prior is one aggregated row.
    """
    hosts = features.groupBy(host).agg(
        F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("failures")
    ).withColumn("rate", F.col("failures") / F.col("n"))
    prior = hosts.agg(
        F.avg("rate").alias("m"), F.var_pop("rate").alias("v"), F.avg(1 / F.col("n")).alias("inv_n")
    )
    spread = F.col("m") * (1 - F.col("m"))
    between = F.col("v") - spread * F.col("inv_n")
    prior = prior.select(
        "m",
        F.when(between > 0, F.greatest(F.lit(PRIOR_MIN), F.least(F.lit(PRIOR_MAX), spread / between - 1)))
        .otherwise(F.lit(PRIOR_MAX)).alias("strength"),
    )
    known = hosts.withColumn("m", prior.select("m").scalar()).withColumn("strength", prior.select("strength").scalar())
    return known.select(
        host, "n", "failures",
        ((F.col("m") * F.col("strength") + F.col("failures")) / (F.col("strength") + F.col("n"))).alias("shrunk_rate"),
    )


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = False) -> DataFrame:
    """Rule features of every document, its own verdict and the verdict after its host's.

    ``base_failed``: too few words or too many repeated ones. ``kept``: not base_failed and
    the host's shrunk failure rate is at most MAX_HOST_RATE. A NULL host counts as the host
    '' (unknown). Repeated rows and tied ids each get a row. Other columns pass through
    (``text`` only with ``keep_text``), except those named like a new column, in any case.
    An empty table gives no rows.

    One scan of the texts: rows with their features are staged, aggregated by host (partial
    sums before the shuffle) and joined with the host verdicts, one row per host, by
    broadcast where the hosts are few, so that a hot host's rows stay where they are.
    """
    new = ["base_failed", "kept", "host_rate"]
    cols = docs.select(*[c for c in docs.columns if c.lower() not in new])
    own = free_name(docs.columns, "_host")
    feats = text_features(cols.withColumn(own, F.coalesce(F.col(host), F.lit(""))), text)
    feats = feats.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )
    feats = stage(feats if keep_text else feats.drop(text), "quality")
    rates = stage(
        host_rates(feats, own, "base_failed").select(own, F.col("shrunk_rate").alias("host_rate")), "hosts")
    return feats.join(checked_broadcast(rates), own).withColumn(
        "kept", ~F.col("base_failed") & (F.col("host_rate") <= MAX_HOST_RATE)
    ).drop(own)
