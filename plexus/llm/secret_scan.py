"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is the whole value, of any characters and length, that is assigned to a
name ending in a key word (up to the closing quote, or to white space); a private key
in PEM; a JWT; a run of at least MIN_LENGTH letters, digits and ``_ + / -`` with a
digit in it; and one of at least LONG_LENGTH without a digit whose letters mix cases or
have no vowels for long. The forest sees the candidate's length, its character transitions
(changes between small letters, capitals, digits and signs, and the share of each),
how much of it dictionary words cover, the path (the document's source) and the
neighbouring words. It is trained from labelled findings; ``rule_labels`` labels
those that a strict format decides (provider keys and assigned values are secrets,
card and phone numbers and words are not), and the forest judges every candidate by
its features, labelled or not; only a provider's format is a secret whatever its score.
Each labelled finding teaches the forest twice, once without the features that the
rules look at (HIDDEN), so that it also knows secrets by their characters alone. The
dictionary is the corpus's own: whole words of at least DICTIONARY_LETTERS letters
outside the candidates that a share of DICTIONARY_SHARE of all distinct texts
have, and DICTIONARY_DOCS of them at least.

Everything is DataFrame functions and Spark ML; the forest is fitted to every
distinct labelled value and has a fixed size. Each text is looked through once for candidates
and once for words; texts with a candidate are cut at their candidates once
more and kept in pieces, from which the masked text is put together again. Offsets and
neighbouring words come from a window over the pieces of a text, so the work grows
with the text's length whatever the number of its candidates. Only ends of pieces
(CONTEXT characters of up to three candidates before and after) are shuffled, and the
dictionary's texts where the list of distinct ones is too large to broadcast.

Edge cases: null and empty texts have no candidates; repeated rows are scanned one by
one; texts are read whole; a null path counts as empty; without labelled findings of
both kinds each finding keeps its rule label and unlabelled ones are no secrets; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import col, fresh, let, small_side
from plexus.session import materialize, scratch_path

MIN_LENGTH = 8
LONG_LENGTH = 16  # of runs without a digit
_CHARS = r"A-Za-z0-9_+/\-"
_PEM = (r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z0-9 ]*-----"
        r"(?:(?:[^\-]++|-(?!----))*+-----END [A-Z0-9 ]*-----|(?:[\x20\x09-\x0D]++[A-Za-z0-9+/=]{16,}+)*+)")
_JWT = r"(?<![%s])eyJ[A-Za-z0-9_\-]{5,}+(?:\.[A-Za-z0-9_\-]*+){2,4}+" % _CHARS
# the length is looked at first, as most words are short
_DIGIT = r"(?<![%s])(?=[%s]{%d})(?=[A-Za-z_+/\-]*+[0-9])[%s]++" % (_CHARS, _CHARS, MIN_LENGTH, _CHARS)
# four changes from small letters to capitals, or six consonants on end
_MIXED = (r"(?<![%s])(?=[A-Za-z_+/\-]{%d})(?:(?=(?:[A-Z_+/\-]*+[a-z][a-z_+/\-]*+(?=[A-Z])){4})"
          r"|(?=[A-Za-z_+/\-]*?(?:[b-df-hj-np-tv-xz]{6}|[B-DF-HJ-NP-TV-XZ]{6})))[A-Za-z_+/\-]++" % (_CHARS, LONG_LENGTH))
RUN = "|".join([_PEM, _JWT, _DIGIT, _MIXED])
SPACE = r"[\x20\x09-\x0D]"
SPACES = SPACE + "+"
KEY_WORDS = r"pass(word|wd)?|pwd|secret|token|api.?key|access.?key|auth|credential|private|bearer"
# what stands before an assigned value: a name that ends in a key word, perhaps with a number or
# with more parts behind it, and the sign. A name is looked at from its first character only, so
# long names cost no more than their length
_NAME = r"[A-Za-z0-9_.\-]"
_KEY = (r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|(?:api|access|private|secret)[^\x20\x09-\x0D]?key|auth(?:orization)?|credential|bearer)s?"
        r"(?:[_.\-]|[0-9]++(?!%s)|(?!%s))" % (_NAME, _NAME))
ASSIGNED = (r"(?i)((?<!%s)(?:(?=%s*?%s)%s++|(?:api|access|private|secret) key)[\"'`\])]{0,2}[\x20\x09-\x0D]*+(?::=|=>|=(?!=)|:(?![:/]))[\x20\x09-\x0D]*+"
            r"(?:(?:bearer|basic)[\x20\x09-\x0D]++)?+[\"'`]?+)(?=[^\x20\x09-\x0D])" % (_NAME, _NAME, _KEY, _NAME))
# marks of the scan; the same characters of a text are read as MARK_OTHER
MARK_HIT, MARK_VALUE, MARK_OTHER = "\x01", "\x02", "\x03"
VALUE = MARK_VALUE + "(?:" + "|".join(
    [r"(?<=%s\x02)(?:[^%s\\\r\n]*+\\.)*+[^%s\\\r\n]++(?=%s)" % (q, q, q, q) for q in "\"'`"]
    + [_PEM, r"[^\x20\x09-\x0D]*[^\x20\x09-\x0D\"'`,;)\]}>.]"]) + ")"
HIT = VALUE + "|" + RUN
PROVIDER = (r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_\-]{20,}|"
            r"xox[abeprs]-[A-Za-z0-9\-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35}|npm_[A-Za-z0-9]{36}|"
            r"eyJ[A-Za-z0-9_\-]{5,}(?:\.[A-Za-z0-9_\-]*){2,4}$|-----BEGIN [A-Z0-9 ]*PRIVATE KEY)")
TEST_PATHS = r"test|example|sample|fixture|mock|doc"
CONTEXT = 200
AROUND = 6  # pieces of a text before and after a candidate, its neighbours among them
DICTIONARY_LETTERS = 3
DICTIONARY_DOCS = 5
DICTIONARY_SHARE = 1e-4
TREES, DEPTH = 20, 6
SECRET = 0.5
MASK = "[SECRET]"

FEATURES = ["size", "changes", "digits", "capitals", "smalls", "signs", "distinct", "covered",
            "path_depth", "path_test", "key_word", "assigned", "quoted", "strict", "glued", "next_number", "prev_number"]
HIDDEN = ["covered", "key_word", "assigned", "quoted", "strict"]


def with_candidates(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(RUN)) | F.regexp_like(text, F.lit(ASSIGNED)), F.lit(False))


def marked(text: Column) -> Column:
    """A text as long as before but for a MARK_VALUE before each assigned value."""
    plain = F.translate(text, MARK_HIT + MARK_VALUE, MARK_OTHER * 2)
    return F.regexp_replace(plain, F.lit(ASSIGNED), F.lit("$1" + MARK_VALUE))


def pieces(text: Column) -> Column:
    """A text cut at its candidates: they are at the odd places (from 0), those that a key word
    assigns after a MARK_VALUE; null texts give null."""
    return F.split(F.regexp_replace(marked(text), F.lit(HIT), F.lit(MARK_HIT + "$0" + MARK_HIT)), MARK_HIT)


def candidates(docs: DataFrame, path_col: str = "source") -> DataFrame:
    """One row a candidate: row, doc_id, n (its number in the text), start, end, value, what stands
    before it in its word (left), the two words before that (prev) and the word after, whatever blanks and
    line ends lie between, path, strict (a key word assigns it).

    ``docs`` has a column ``row`` that names its rows, and ``text`` or its ``pieces``."""
    cut = F.col("pieces") if "pieces" in docs.columns else pieces(F.col("text"))
    each = docs.select("row", "doc_id", F.coalesce(col(docs, path_col).cast("string"), F.lit("")).alias("path"),
                       F.posexplode(cut).alias("k", "piece"))
    hit = F.col("k") % 2 == 1
    plain = F.translate("piece", MARK_VALUE, "")
    long = F.length("plain") > CONTEXT
    # of what lies between two candidates only the ends are needed; a blank stands for the rest
    ends = each.select(
        "row", "doc_id", "path", "k", plain.alias("plain"), (hit & F.startswith("piece", F.lit(MARK_VALUE))).alias("strict")).select(
        "row", "doc_id", "path", "k", "strict", F.length("plain").alias("size"), F.when(hit, F.col("plain")).alias("value"),
        F.when(long, F.concat(F.substring("plain", 1, CONTEXT), F.lit(" "))).otherwise(F.col("plain")).alias("head"),
        F.when(long, F.concat(F.lit(" "), F.substring("plain", -CONTEXT, CONTEXT))).otherwise(F.col("plain")).alias("tail"))
    order = Window.partitionBy("row").orderBy("k")
    start = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = F.concat(*[F.coalesce(F.lag("tail", i).over(order), F.lit("")) for i in range(AROUND, 0, -1)])
    after = F.concat(*[F.coalesce(F.lead("head", i).over(order), F.lit("")) for i in range(1, AROUND)])
    spots = ends.select("*", start.cast("long").alias("start"), F.split(before, SPACES).alias("words"),
                        F.split(after, SPACES, 3).alias("follows")).where(hit)
    n = F.size("words")
    return spots.select(
        "row", "doc_id", "path", F.floor(F.col("k") / 2).cast("int").alias("n"), "start", (F.col("start") + F.col("size")).alias("end"),
        "value", F.element_at("words", -1).alias("left"),
        F.array_join(F.slice("words", F.greatest(n - 2, F.lit(1)), F.least(n - 1, F.lit(2))), " ").alias("prev"),
        F.coalesce(F.get("follows", F.lit(1)), F.lit("")).alias("after"), "strict")


def dictionary(docs: DataFrame) -> DataFrame:
    """Words of all distinct texts, in small letters. ``docs`` has ``row`` and ``text``, and perhaps ``hot``,
    whether a text has candidates; the others need not be searched for them."""
    docs = docs.where(F.col("text").isNotNull())
    firsts = small_side(docs.groupBy(F.xxhash64("text")).agg(F.min("row").alias("row")).select("row"), "distinct-texts")
    least = max(DICTIONARY_DOCS, math.ceil(firsts.count() * DICTIONARY_SHARE))
    once = docs.join(firsts, "row", "left_semi")
    text = F.regexp_replace(marked(F.col("text")), F.lit(HIT), F.lit("0"))  # without the candidates
    if "hot" in docs.columns:
        text = F.when(F.col("hot"), text).otherwise(F.col("text"))
    edge = r"[A-Za-z0-9_+/=\-]"
    words = F.array_distinct(F.transform(F.regexp_extract_all(
        text, F.lit(f"(?<!{edge})[A-Za-z]{{{DICTIONARY_LETTERS},}}+(?!{edge})"), F.lit(0)), F.lower))
    return (once.select(F.explode(words).alias("dict_word")).groupBy("dict_word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least).select("dict_word"))


def coverage(cands: DataFrame, words: DataFrame) -> DataFrame:
    """value, covered: share of the characters of each distinct value that lies in
    letter runs that are dictionary words."""
    parts = cands.select("value").distinct().select("value", F.explode_outer(
        F.regexp_extract_all("value", F.lit(r"[A-Za-z]{%d,}" % DICTIONARY_LETTERS), F.lit(0))).alias("part"))
    hit = parts.join(words, F.lower("part") == F.col("dict_word"), "left")
    return hit.groupBy("value").agg((F.sum(F.when(F.col("dict_word").isNotNull(), F.length("part")).otherwise(0))
                                     / F.length("value")).alias("covered"))


def features(cands: DataFrame) -> DataFrame:
    """The feature columns beside the candidates; needs ``covered``."""
    v, n = F.col("value"), F.length("value").cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        v, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[^A-Za-z0-9]+", "-")
    context = F.lower(F.concat_ws(" ", "prev", "left"))

    def share(pattern: str) -> Column:
        return (n - F.length(F.regexp_replace(v, pattern, ""))) / n

    def flag(c: Column) -> Column:
        return F.when(c, 1.0).otherwise(0.0)

    return cands.select(
        *[c for c in cands.columns if c != "strict"], n.alias("size"), ((F.length(kinds) - 1) / n).alias("changes"), share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"), share("[a-z]").alias("smalls"), share("[^A-Za-z0-9]").alias("signs"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct"),
        F.length(F.regexp_replace("path", "[^/]", "")).cast("double").alias("path_depth"),
        flag(F.regexp_like(F.lower("path"), F.lit(TEST_PATHS))).alias("path_test"),
        flag(F.regexp_like(context, F.lit(KEY_WORDS))).alias("key_word"),
        flag(F.regexp_like(context, F.lit(r"[=:]>?\s*(?:(?:bearer|basic)\s+)?[\"'`]?$"))).alias("assigned"),
        flag(F.regexp_like("left", F.lit(r"[\"'`]$"))).alias("quoted"),
        F.col("strict").cast("double").alias("strict"),
        flag(F.length("left") > 0).alias("glued"),
        flag(F.regexp_like("after", F.lit("[0-9]"))).alias("next_number"),
        flag(F.regexp_like("prev", F.lit("[0-9]"))).alias("prev_number"))


def rule_labels(found_: DataFrame) -> Column:
    """1 for findings that a strict format makes secrets, 0 for those that it makes
    harmless, null for the rest."""
    v = found_["value"]
    both = F.regexp_like(v, F.lit("[A-Za-z]")) & F.regexp_like(v, F.lit("[0-9]"))
    number = F.regexp_like(v, F.lit(r"^[0-9+/\-]+$"))
    named = (found_["key_word"] > 0) & (found_["assigned"] > 0)
    quoted = (found_["quoted"] > 0) & ~F.regexp_like(v, F.lit(SPACE))
    return (F.when(F.regexp_like(v, F.lit(PROVIDER)), 1)
            .when(named & (found_["size"] >= 12) & both, 1)
            .when(named & (found_["size"] >= 12) & quoted & (found_["covered"] < 0.5), 1)
            # a quoted number after a key word and a sign is no card or phone number
            .when((found_["strict"] > 0) & (found_["size"] >= 6) & quoted & number, 1)
            .when(number, 0)
            .when(found_["covered"] >= 0.5, 0)
            # words with numbers or signs between them: nearly all letters lie in dictionary words
            .when((found_["covered"] > 0) & (found_["covered"] >= 0.8 * (found_["capitals"] + found_["smalls"])), 0))


def train(labelled: DataFrame) -> RandomForestClassificationModel | None:
    """A forest from findings with their feature columns and ``label`` (1 secret, 0 not): each distinct value
    once as it is and once without the HIDDEN features."""
    values = labelled.groupBy("value", "label").agg(F.min(F.struct(*FEATURES)).alias("x"))
    rows = values.select(F.col("label").cast("double").alias("label"), "x.*")
    blind = rows.select("label", *[F.lit(0.0).alias(c) if c in HIDDEN else F.col(c) for c in FEATURES])
    rows = materialize(rows.select("label", *FEATURES).union(blind), "labelled-findings")
    if rows.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("label", "features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, minInstancesPerNode=2).fit(vectors)
    return forest.copy()  # without the training summary, which holds on to the session


def judge(found_: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """row, doc_id, n, start, end, label, score, secret (by the score, or by a provider's format)."""
    if model is None:
        scored = found_.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.0)))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found_))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.select("row", "doc_id", "n", "start", "end", "label", "score",
                         ((F.col("score") >= SECRET) | F.regexp_like("value", F.lit(PROVIDER))).alias("secret"))


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    return docs.withColumn(row, F.monotonically_increasing_id())


def _written(docs: DataFrame, row: str, hot: str) -> DataFrame:
    """All rows, numbered in ``row``, written apart by whether they have candidates (``hot``): one pass over the texts."""
    path = scratch_path(docs.sparkSession, "texts")
    flagged = _numbered(docs, row).withColumn(hot, with_candidates(docs["text"]))
    flagged.write.partitionBy(hot).parquet(path)
    return docs.sparkSession.read.schema(flagged.schema).parquet(path)


def _findings(both: DataFrame, flag: str, hot: DataFrame, row: str, path_col: str, cut: str | None = None) -> DataFrame:
    """Judged candidates of the written rows with candidates (``hot``, named by ``row``, in pieces in ``cut``);
    the dictionary comes from all rows (``both``, those with candidates by ``flag``)."""
    rows = hot.select(col(hot, row).alias("row"), hot["doc_id"].cast("long").alias("doc_id"), hot["text"].alias("text"),
                      col(hot, path_col).alias("path"), *([col(hot, cut).alias("pieces")] if cut else []))
    cands = materialize(candidates(rows, "path"), "candidates")
    texts = both.select(col(both, row).alias("row"), both["text"].alias("text"), col(both, flag).alias("hot"))
    # written, so that a value in many findings does not meet them in one task
    covered = small_side(coverage(cands, small_side(dictionary(texts), "dictionary")), "coverage")
    found_ = features(cands.join(covered, "value"))
    found_ = materialize(found_.withColumn("label", rule_labels(found_)), "findings")
    return judge(found_, train(found_.where(F.col("label").isNotNull())))


def scan(docs: DataFrame, path_col: str = "source") -> DataFrame:
    """doc_id, start, end, label, score, secret of every candidate."""
    row, flag = fresh(docs, "row"), fresh(docs, "has_candidates")
    # only what is looked at is written
    both = _written(docs.select(*[col(docs, c) for c in dict.fromkeys(["doc_id", "text", path_col])]), row, flag)
    return _findings(both, flag, both.where(col(both, flag)), row, path_col).drop("row", "n")


def redact(docs: DataFrame, path_col: str = "source") -> DataFrame:
    """All rows and columns of ``docs``; confirmed secrets in ``text`` become MASK, and
    ``n_chars``, where there is one, the new length."""
    row, hot_flag = fresh(docs, "row"), fresh(docs, "has_candidates")
    both = _written(docs, row, hot_flag)
    rest = both.where(~col(both, hot_flag))
    hot = both.where(col(both, hot_flag)).drop(hot_flag)
    cut = fresh(hot, "pieces")
    hot = materialize(hot.withColumn(cut, pieces(F.col("text"))), "pieces")
    spans = (_findings(both, hot_flag, hot, row, path_col, cut).groupBy("row")
             .agg(F.array_sort(F.collect_list(F.struct("n", "start", "end", "secret"))).alias("spans"))
             .where(F.exists("spans", lambda x: x["secret"]))
             .select(F.col("row").alias(row), F.col("spans").alias(fresh(hot, "spans"))))
    s = fresh(hot, "spans")
    joined = hot.join(spans, row, "left")
    text = col(joined, "text")
    # pieces whose number is odd are candidates, in the order of the spans
    verdict = F.transform(col(joined, s), lambda x: x["secret"])
    masked = let(verdict, lambda v: F.array_join(F.transform(col(joined, cut), lambda p, k: F.when(
        (k % 2 == 1) & F.get(v, F.floor(k / 2).cast("int")), F.lit(MASK)).otherwise(F.translate(p, MARK_VALUE, ""))), ""))
    # a text with the marks' own characters is cut from the text itself, as its pieces do not have them
    own = F.aggregate(
        F.filter(col(joined, s), lambda x: x["secret"]), F.struct(F.lit(0).cast("long").alias("to"), F.lit("").alias("out")),
        lambda a, x: F.struct(x["end"].alias("to"), F.concat(
            a["out"], F.substring(text, (a["to"] + 1).cast("int"), (x["start"] - a["to"]).cast("int")), F.lit(MASK)).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, (a["to"] + 1).cast("int"), F.length(text))))
    has_marks = F.regexp_like(text, F.lit(f"[{MARK_HIT}{MARK_VALUE}]"))
    changed = joined.withColumn("text", F.when(col(joined, s).isNull(), text).when(has_marks, own).otherwise(masked))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(col(changed, s).isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
                                     .otherwise(changed["n_chars"]))
    return rest.select(*[col(rest, c) for c in docs.columns]).union(changed.select(*[col(changed, c) for c in docs.columns]))
