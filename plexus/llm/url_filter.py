"""URL filter: host rules first, then a character language-model ratio.

Two variable-order Markov models, one of accepted and one of rejected URLs, give
each URL a length-normalised log-likelihood difference. Contexts of 0 to ORDER
characters are interpolated by Witten-Bell smoothing: a context counts as much as
it has been seen, and an unseen one leaves the decision to the next shorter. The
labelled URLs are those that a rule decides; hosts are split into a training
fold and a calibration fold, and the cut on the difference is the one with the
best balanced accuracy on the calibration fold.

Scale: counts are taken over all labelled URLs with map-side partial sums, so a
host or gram with a third of all rows is one row per task. The model is a table
of grams over a 33-letter alphabet; it is broadcast only while its written files are
small, beyond that the join shuffles (and AQE splits a frequent gram).

Edge cases: a null URL or one without ``://`` has empty host and path, no rule
and no score, and is blocked; repeated rows are judged one by one; an empty host
cannot match a rule; without labelled URLs of both kinds every URL scores 0 and
is allowed; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import ascii_lower, small_side
from plexus.session import materialize

ORDER = 4
ALPHABET = 33  # a-z, one digit class, . / - _, anything else, the end mark
FOLDS = 5  # one host fold of this many calibrates
BINS = 100  # score bins a nat


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_index(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Number of the rule that decides, null if none fits. Longest rule first; of
    equally long ones a block goes first, then the order of the text."""
    out = F.lit(None).cast("int")
    ranked = sorted(enumerate(rules), key=lambda x: (-len(x[1].text), x[1].verdict != "block", x[1].text))
    for i, r in reversed(ranked):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def model_text(host: Column, path: Column) -> Column:
    """What the models read: start marks, host and path in small letters with digits
    as one class and rare characters as one, an end mark."""
    s = F.regexp_replace(ascii_lower(F.concat(host, path)), "[0-9]", "0")
    s = F.regexp_replace(s, r"[^a-z0./\-_]", "~")
    return F.concat(F.lit("^" * ORDER), s, F.lit("$"))


def grams(df: DataFrame, text: str = "s") -> DataFrame:
    """One row a position with the character and the ORDER before it."""
    at = F.explode(F.sequence(F.lit(1), F.length(text) - ORDER))
    return df.withColumn("_at", at).withColumn("g", F.substring(F.col(text), F.col("_at"), F.lit(ORDER + 1)))


def gram_scores(counts: DataFrame) -> DataFrame:
    """Log-probability ratio of the last character of each gram, accepted to rejected.

    ``counts``: g, acc, rej for every gram that any URL has (0 where it was not in
    the training fold)."""
    lower = None
    for order in range(ORDER + 1):
        x = F.substring(F.col("g"), ORDER + 1 - order, order + 1)
        c = counts.groupBy(x.alias("x")).agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej"))
        ctx = F.substring(F.col("x"), 1, order).alias("ctx")
        seen = c.groupBy(ctx).agg(
            *[F.sum(k).alias(f"n_{k}") for k in ("acc", "rej")],
            *[F.sum(F.when(F.col(k) > 0, 1).otherwise(0)).alias(f"t_{k}") for k in ("acc", "rej")])
        c = c.withColumn("ctx", ctx).join(seen, "ctx")
        if lower is None:
            c = c.withColumns({"q_acc": F.lit(1.0 / ALPHABET), "q_rej": F.lit(1.0 / ALPHABET)})
        else:
            c = c.withColumn("y", F.substring(F.col("x"), 2, order)).join(lower, "y")
        p = {k: F.when(F.col(f"n_{k}") > 0, (F.col(k) + F.col(f"t_{k}") * F.col(f"q_{k}"))
                       / (F.col(f"n_{k}") + F.col(f"t_{k}"))).otherwise(F.col(f"q_{k}")) for k in ("acc", "rej")}
        lower = c.select(F.col("x").alias("y"), p["acc"].alias("q_acc"), p["rej"].alias("q_rej"))
    return lower.select(F.col("y").alias("g"), (F.log("q_acc") - F.log("q_rej")).alias("llr"))


def calibrated_cut(scored: DataFrame) -> float:
    """The cut with the best balanced accuracy over labelled rows (score, accepted).

    Scores are binned, so the table that is ranked has a fixed number of rows."""
    b = F.floor(F.least(F.greatest(F.col("score"), F.lit(-20.0)), F.lit(20.0)) * BINS)
    bins = scored.groupBy(b.alias("b")).agg(
        F.sum(F.when(F.col("accepted"), 1).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(1)).alias("r"))
    rows = sorted(bins.collect())  # at most 40 * BINS + 1 rows
    n_a, n_r = sum(x["a"] for x in rows), sum(x["r"] for x in rows)
    if not n_a or not n_r:
        return 0.0
    cut, below_a, below_r = None, 0, 0
    best = 1.0  # everything allowed: all accepted right, no rejected right
    for x in rows:
        below_a, below_r = below_a + x["a"], below_r + x["r"]
        right = (n_a - below_a) / n_a + below_r / n_r
        if right > best:
            best, cut = right, (x["b"] + 1) / BINS
    return cut if cut is not None else -20.0


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row."""
    url = pages[url_col]
    base = pages.select(pages[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                        (F.instr(url, "://") > 0).alias("ok"))
    base = base.select(
        F.monotonically_increasing_id().alias("row"), "page_id",
        F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce("ok", F.lit(False)).alias("ok"))
    hit = rule_index(F.col("host"), F.col("path"), rules)
    texts = F.array(*[F.lit(r.text) for r in rules])
    verdicts = F.array(*[F.lit(r.verdict) for r in rules])
    base = materialize(base.withColumn("hit", F.when(F.col("ok"), hit)).select(
        "row", "page_id", "host", "path", "ok",
        F.get(texts, F.col("hit")).alias("rule"), F.get(verdicts, F.col("hit")).alias("ruled"),
        F.when(F.col("ok"), model_text(F.col("host"), F.col("path"))).alias("s"),
        (F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 8), 16, 10).cast("long") % FOLDS == 0).alias("calibrates")), "url-rows")
    train = F.col("ruled").isNotNull() & ~F.col("calibrates")
    # URLs of one shape are one row from here on
    shapes = base.where("ok").groupBy("s").agg(
        F.sum(F.when(train & (F.col("ruled") == "allow"), 1).otherwise(0)).alias("acc"),
        F.sum(F.when(train & (F.col("ruled") == "block"), 1).otherwise(0)).alias("rej"))
    counts = grams(shapes).groupBy("g").agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej"))
    counts = materialize(counts, "url-grams")
    model = small_side(gram_scores(counts), "url-model")
    rows = grams(base.where("ok").select("row", "s"))
    score = rows.join(model, "g").groupBy("row").agg(
        (F.sum("llr") / F.count("llr")).alias("score"))
    scored = materialize(
        base.join(score, "row", "left").select(
            "page_id", "host", "path", "rule", "ruled", "calibrates", "score"), "url-scores")
    cut = calibrated_cut(scored.where(F.col("ruled").isNotNull() & F.col("calibrates") & F.col("score").isNotNull())
                         .select("score", (F.col("ruled") == "allow").alias("accepted")))
    method = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", method).alias("verdict"), "score")
