"""Quality rules with risk-controlled thresholds.

Base counts are row-wise expressions. Each rule is a rate computed from them; a
document is rejected when a rate exceeds the cutoff of its stratum. Cutoffs come
from labelled holdout documents: a cutoff is *certified* when the exact binomial
test rejects "more than ``alpha / rules`` of the good documents of this stratum
exceed it" at level ``delta / (strata * rules * cutoffs)`` (Bonferroni). That is
the same as an upper Clopper-Pearson bound at or below ``alpha / rules``. With
probability ``1 - delta`` the rules together reject at most ``alpha`` of the good
documents in every stratum. Among certified cutoffs the one with the most bad
holdout documents rejected, less GOOD_WEIGHT for every good one, is taken, the
mildest on ties, if that is above zero; a stratum without enough
labels certifies nothing and rejects nothing.

Everything is DataFrame functions: one narrow pass for the counts, one
aggregation with map-side partial sums for the calibration (a stratum with a
third of all rows sends one partial row a task).

Edge cases: null, empty or blank text has zero counts and fails the base check
(fewer than 20 words); a null stratum is the stratum ``und``; null labels and
labels of unknown documents are ignored, repeated labels of one document count
once with the lowest value; repeated document rows are judged one by one; an
empty table gives an empty result; other columns of the input are never read,
whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import ascii_words, col, fresh, let, small_side
from plexus.session import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# The rules and the cutoffs tried for each.
RULES = ("symbol_rate", "dup_line_rate", "repeat_rate", "shout_rate", "caps_rate")
CUTOFFS = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75)
ALPHA = 0.05
DELTA = 0.05
GOOD_WEIGHT = 10  # a good document lost weighs as much as so many bad ones caught

#: Terms of the binomial tail that are summed; see ``binomial_cdf``.
TAIL_TERMS = 20_000


def repeat_words(hashes: Column) -> Column:
    """Words that lie in an 8-word window found at least twice in the document.

    ``hashes`` has a 64-bit hash for each word. Window hashes are sorted with their
    positions; equal neighbours mark repeated windows, whose union is counted."""
    def count(win: Column) -> Column:
        pairs = F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def marked(s: Column) -> Column:
            n = F.size(s)
            hit = F.filter(
                F.transform(s, lambda x, i: F.when(
                    ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                    | ((i < n - 1) & (F.get(s, i + 1)["h"] == x["h"])), x["p"])),
                lambda p: p.isNotNull())
            return let(F.array_sort(hit), lambda d: F.aggregate(
                d, F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last")),
                lambda a, p: F.struct(
                    (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total"), p.alias("last")),
                lambda a: a["total"]))

        return (F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0))
                .otherwise(let(pairs, marked)))

    def windows(h: Column) -> Column:
        return F.when(F.size(h) <= WINDOW, F.lit(0)).otherwise(let(
            F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
                        lambda i: F.xxhash64(F.slice(h, i, WINDOW))), count))

    return let(hashes, windows).cast("long")


def measures(text: Column) -> Column:
    """Struct of all counts of one text."""
    t = F.coalesce(text, F.lit(""))
    n_sym = F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    line_counts = let(lines, lambda a: F.struct(
        F.size(a).cast("long").alias("n_lines"),
        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines")))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words"))

    return F.struct(
        let(ascii_words(text), of_words).alias("w"),
        F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        n_sym.cast("long").alias("n_symbols"),
        line_counts.alias("l"),
        (F.length(t) - F.length(F.regexp_replace(t, "!+", ""))).cast("long").alias("n_shouts"),
        (F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))).cast("long").alias("n_caps"))


def rates(m: Column) -> dict[str, Column]:
    chars = F.greatest(m["word_chars"], F.lit(1))
    return {
        "symbol_rate": m["n_symbols"] / chars,
        "dup_line_rate": m["l"]["n_dup_lines"] / F.greatest(m["l"]["n_lines"], F.lit(1)),
        "repeat_rate": m["w"]["n_repeat_words"] / F.greatest(m["w"]["n_words"], F.lit(1)),
        "shout_rate": m["n_shouts"] / chars,
        "caps_rate": m["n_caps"] / chars,
    }


def base_failed(m: Column) -> Column:
    w = m["w"]
    return (w["n_words"] < MIN_WORDS) | (100 * w["n_repeat_words"] > MAX_REPEAT_PERCENT * w["n_words"])


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1: Stirling's series at x + 8, carried back by the recurrence."""
    y = x + 8.0
    product = x
    for i in range(1, 8):
        product = product * (x + float(i))
    series = 1.0 / (12.0 * y) - 1.0 / (360.0 * y * y * y) + 1.0 / (1260.0 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), k < n p, summed downwards from the term of k.

    Below the mean the terms fall faster than geometrically; after TAIL_TERMS of them
    what is left is below double precision unless k is so near the mean that the
    sum is far above any useful test level. At or above the mean, 1 is returned."""
    k, n = k.cast("double"), n.cast("double")
    top = (_log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0)
           + k * math.log(p) + (n - k) * math.log1p(-p))
    ratio = (1 - p) / p
    steps = F.sequence(F.lit(0), F.least(k, F.lit(float(TAIL_TERMS))).cast("int"))
    total = F.aggregate(
        steps, F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t")),
        lambda a, j: F.struct(
            (a["s"] + a["t"]).alias("s"),
            (a["t"] * (k - j) * F.lit(ratio) / (n - k + j + 1.0)).alias("t")),
        lambda a: a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * total)


def calibrate(rated: DataFrame, labels: DataFrame, label_col: str = "quality", good: int = 1,
              alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Certified cutoffs: one row a stratum with a nullable cutoff column a rule.

    ``rated``: doc_id, stratum, failed and a column a rule. ``labels``: doc_id and the label."""
    lab = (labels.where(col(labels, label_col).isNotNull() & labels["doc_id"].isNotNull())
           .groupBy("doc_id").agg(F.min(label_col).alias("label")))
    # documents that the base check rejects never reach the rules
    held = rated.where(~F.col("failed")).join(lab, "doc_id")
    # copies of a text are one trial, as the bound is on independent ones; labels that differ make it a bad one
    held = held.groupBy("stratum", "text_hash").agg(
        F.min(F.when(F.col("label") == good, 1).otherwise(0)).alias("good"), *[F.first(r).alias(r) for r in RULES])
    is_good = F.col("good") == 1
    sums = [F.sum(F.when(is_good, 1).otherwise(0)).alias("n_good")]
    for r in RULES:
        for i, c in enumerate(CUTOFFS):
            over = F.col(r) > c
            sums += [F.sum(F.when(is_good & over, 1).otherwise(0)).alias(f"g_{r}_{i}"),
                     F.sum(F.when(~is_good & over, 1).otherwise(0)).alias(f"b_{r}_{i}")]
    counts = held.groupBy("stratum").agg(*sums)
    tests = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"),
                 F.col(f"g_{r}_{i}").alias("k"), F.col(f"b_{r}_{i}").alias("caught"))
        for r in RULES for i, c in enumerate(CUTOFFS)]))
    strata = F.lit(rated.select("stratum").distinct().count() or 1)
    level = F.lit(delta) / (strata * len(RULES) * len(CUTOFFS))
    certified = (counts.select("stratum", "n_good", tests.alias("t"))
                 .select("stratum", "n_good", "t.*")
                 .where((F.col("caught") > GOOD_WEIGHT * F.col("k")) & (F.col("n_good") > 0))
                 .where(binomial_cdf(F.col("k"), F.col("n_good"), alpha / len(RULES)) <= level))
    best = certified.groupBy("stratum", "rule").agg(
        F.max_by("cutoff", F.struct(F.col("caught") - GOOD_WEIGHT * F.col("k"), F.col("cutoff"))).alias("cutoff"))
    return best.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])


def rate_documents(docs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum, text_hash, counts, base verdict and rates of every document; one narrow pass."""
    m = F.col("m")
    out = docs.select(docs["doc_id"], F.coalesce(col(docs, stratum_col).cast("string"), F.lit("und")).alias("stratum"),
                      F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text_hash"), measures(docs["text"]).alias("m"))
    return out.select(
        "doc_id", "stratum", "text_hash", m["w"]["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"), m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"), base_failed(m).alias("failed"),
        *[c.alias(r) for r, c in rates(m).items()])


def _passes(cut_prefix: str = "cut_", rate=F.col) -> Column:
    ok = F.lit(True)
    for r in RULES:
        ok = ok & (F.col(cut_prefix + r).isNull() | (rate(r) <= F.col(cut_prefix + r)))
    return ok


def judge(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts and verdict of every document (one row per input row)."""
    rated = materialize(rate_documents(docs, stratum_col), "quality-rates")
    cuts = small_side(calibrate(rated, labels, alpha=alpha, delta=delta), "quality-cuts")
    return (rated.join(cuts, "stratum", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    F.col("failed").alias("base_failed"), (~F.col("failed") & _passes()).alias("kept"),
                    *RULES))


def keep_good(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang",
              alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they came.

    The counts are taken twice, once to calibrate and once in the filter: that
    costs less than a shuffle of all texts to join the verdicts back."""
    rated = materialize(rate_documents(docs, stratum_col), "quality-rates")
    cuts = small_side(calibrate(rated, labels, alpha=alpha, delta=delta), "quality-cuts")
    m, s = fresh(docs, "_measures"), fresh(docs, "_stratum")
    cuts = cuts.select(F.col("stratum").alias(s), F.struct(*[f"cut_{r}" for r in RULES]).alias(fresh(docs, "_cuts")))
    c = fresh(docs, "_cuts")
    tagged = docs.withColumns({
        m: measures(docs["text"]),
        s: F.coalesce(col(docs, stratum_col).cast("string"), F.lit("und"))})
    ok = ~base_failed(F.col(m))
    for r, rate in rates(F.col(m)).items():
        cut = F.col(c)[f"cut_{r}"]
        ok = ok & (cut.isNull() | (rate <= cut))
    joined = tagged.join(cuts, s, "left").where(F.coalesce(ok, F.lit(False)))
    return joined.select(*[col(joined, x) for x in docs.columns])
