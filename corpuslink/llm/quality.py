"""Quality rules whose cutoffs are chosen on labelled documents with a risk guarantee.

Each rule is a number per document, higher for worse text. A *level* is a share of good
documents that a rule may cut on average: at level v the ``len(RULES)`` rules share
v * len(RULES) by weight, and a rule of weight w rejects values above the
(1 - v * len(RULES) * w) quantile (shares rounded down to a grid; below its first the rule
is off) of the stratum's good documents in one half of the labelled documents. A rule
weighs by the bad documents of that half that are credited to it (plus one): each that
exceeds a cutoff of the mildest share is credited to the rule that catches the most of
them. The other half is the holdout: with k of its n good documents rejected by any rule,
P(X <= k) for X binomial in n and ``risk`` (summed exactly) is the p-value of "this level
rejects more than ``risk`` of the good documents". Levels are tested from the mildest on
and testing stops at the first that is not below ``delta`` over the number of strata
(fixed sequence within a stratum, Bonferroni over the strata).

Strata with so few good holdouts that one rejected among them already fails the test are
pooled into one shared stratum with its own cutoffs and test; n alone decides, so the test
stays exact. With probability 1 - ``delta`` no stratum, the shared one counting as one,
loses more than ``risk`` of its good documents to the rules; within the shared stratum
nothing is promised of a single member.

Everything is DataFrame expressions; one row per stratum is all that leaves the corpus.

Nulls, empties: a null or empty text has 0 words and fails the base rules. A null stratum
is a stratum of its own. A stratum without cutoffs (no good holdout of its own, or too few
even in the shared stratum) loses nothing to the rules. Repeated labels of an id count once (good if any says so); a label that is null,
or has no document, teaches nothing. Repeated rows are judged alike. Extra columns pass
through ``keep_good``; ``judge`` does not read them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.scratch import written

BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT = 50                     # per cent of the words
LEVELS = (0.0005, 0.001, 0.002, 0.005, 0.01, 0.02)
RISK = 0.02
DELTA = 0.05
ACCURACY = 10_000                   # of the quantile sketch: rank error 1 / ACCURACY
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds ``out``: words of the array ``words`` that lie in a 3-word window found twice
    or more in it. Windows are compared by hash, sorted with their places; a text without
    an equal pair is done after the hashing."""
    hashes = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words), F.lit(3)) - 3),
        lambda i: F.xxhash64(F.get(F.col(words), i), F.get(F.col(words), i + 1),
                             F.get(F.col(words), i + 2))))
    df = df.withColumn("_h", hashes)
    some = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_s", F.when(some, F.sort_array(F.transform(
        "_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    equal = lambda e, j: F.coalesce(
        (F.get("_s", j - 1)["h"] == e["h"]), F.lit(False)) | F.coalesce(
        (F.get("_s", j + 1)["h"] == e["h"]), F.lit(False))
    places = F.transform(F.filter("_s", equal), lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))
    number = F.when(F.col("_s").isNotNull(), F.size(F.array_distinct(F.flatten(places))))
    return df.withColumn(out, F.coalesce(number, F.lit(0)).cast("long")).drop("_h", "_s")


def features(docs: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """(doc_id, _hash, stratum, base numbers, rule values) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_hash"),
        F.col(stratum_col).cast("string").alias("stratum"), text.alias("_t"), words.alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("_l"))
    without = lambda pattern: F.length("_t") - F.length(
        F.regexp_replace("_t", pattern, ""))
    rows = repeat_words(rows, "_w", "n_repeat_words").select(
        "doc_id", "_hash", "stratum", "n_repeat_words",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        without("[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").alias("_n_lines"), without(r"\p{Lu}").alias("_upper"),
        without("[!?]").alias("_marks"), F.size(F.array_distinct("_w")).alias("_distinct"))
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return rows.select(
        "doc_id", "_hash", "stratum", *BASE,
        ((F.col("n_words") < MIN_WORDS)
         | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))).alias("base_failed"),
        F.struct((F.col("n_symbols") / chars).alias("symbols"),
                 (F.col("_upper") / chars).alias("capitals"),
                 (F.col("_marks") / chars).alias("marks"),
                 (F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1))).alias("dup_lines"),
                 (F.col("n_repeat_words") / n).alias("repeats"),
                 (1 - F.col("_distinct") / n).alias("sameness"),
                 (chars / n).alias("long_words"),
                 (-(chars / n)).alias("short_words")).alias("rules"))


RULES = ("symbols", "capitals", "marks", "dup_lines", "repeats", "sameness", "long_words",
         "short_words")


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1 (shifted Stirling series, about 1e-13)."""
    y = x + 8
    below = reduce(lambda a, b: a * b, [x + i for i in range(8)])
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - F.log(below)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), summed from k downwards; 1 where k >= n p, which no
    test needs. Terms fall at least geometrically; beyond 40 standard deviations they are
    below the smallest double."""
    k, n = k.cast("double"), n.cast("double")
    log_top = (log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)
               + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    terms = F.least(k, 40 * F.sqrt(n * p) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("total"), F.lit(1.0).alias("term"))

    def add(acc, i):
        term = acc["term"] * (k - i) * (1 - p) / ((n - k + i + 1) * p)
        return F.struct((acc["total"] + term).alias("total"), term.alias("term"))

    steps = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(
        F.array().cast("array<int>"))
    total = F.aggregate(steps, start, add)["total"]
    return F.when((n <= 0) | (k >= n * p), F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.exp(log_top) * total))


def _above(cutoffs: str, level: int | Column) -> Column:
    """Does any rule exceed its cutoff at this level?"""
    return reduce(lambda a, b: a | b, [
        F.coalesce(F.col("rules")[r] > F.get(F.col(cutoffs)[r], level if isinstance(level, Column)
                                             else F.lit(level)), F.lit(False)) for r in RULES])


def rule_weights(bad: DataFrame, quantiles: DataFrame) -> DataFrame:
    """(_g, weights in the order of RULES): each bad document that exceeds a first quantile
    of its group counts for the rule that catches the most of them, each rule once more. The
    documents are counted by the set of rules they exceed, at most 2 ** len(RULES) a group."""
    caught = F.array(*[F.coalesce(F.col("rules")[r] > F.col("quantiles")[r][0], F.lit(False))
                       for r in RULES])
    sets = bad.join(quantiles.withColumnRenamed("group", "_g"), F.col("group") == F.col("_g")
                    ).groupBy("_g", caught.alias("caught")).agg(F.count(F.lit(1)).alias("n"))
    sets = sets.groupBy("_g").agg(F.collect_list(F.struct("caught", "n")).alias("sets"), F.array(*[
        F.sum(F.when(F.col("caught")[i], F.col("n")).otherwise(0)) for i in range(len(RULES))
    ]).alias("totals"))

    def first(s: Column) -> Column:
        own = F.zip_with(s["caught"], F.col("totals"), lambda c, n: F.when(c, n).otherwise(0))
        return F.when(F.array_max(own) > 0, F.array_position(own, F.array_max(own)) - 1)

    sets = written(sets.select("_g", F.explode("sets").alias("s"), "totals").select(
        "_g", first(F.col("s")).alias("rule"), F.col("s")["n"].alias("n")), "credits")
    credits = sets.groupBy("_g").agg(F.coalesce(F.sum(F.when(
        F.col("rule").isNotNull(), F.col("n"))), F.lit(0)).alias("all"), *[
        F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("n"))), F.lit(0)).alias(r)
        for i, r in enumerate(RULES)])
    return credits.select("_g", F.array(*[
        (F.col(r) + 1) / (F.col("all") + len(RULES)) for r in RULES]).alias("weights"))


def choose_cutoffs(rows: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
                   label_col: str = "quality", levels: tuple[float, ...] = LEVELS,
                   risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cutoffs, level, tests): for each stratum the rules' cutoffs at all levels,
    the number of levels that hold (0: none) and each level's (k, n, p)."""
    given = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_good"))
    known = written(rows.join(given, F.col("doc_id") == F.col("_id")).where(
        ~F.col("base_failed")).select("doc_id", "stratum", "rules", "_good"), "labelled")
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("half")), F.lit(2))
    sizes = known.where((half == 1) & (F.col("_good") == 1)).groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"))
    small = binomial_tail(F.lit(1), F.col("n"), risk) > F.lit(delta) / sizes.agg(
        F.count(F.lit(1))).scalar()
    groups = written(sizes.select(F.col("stratum").alias("_s"), small.alias("shared")).select(
        "_s", F.struct("shared", F.when(~F.col("shared"), F.col("_s")).alias("stratum")).alias(
            "group")), "strata")
    known = known.join(groups, F.col("stratum").eqNullSafe(F.col("_s")))
    grid = sorted({v * m for v in levels for m in (1, 2, 4, 8)})
    quantiles = written(known.where((half == 0) & (F.col("_good") == 1)).groupBy("group").agg(
        F.struct(*[F.percentile_approx(F.col("rules")[r], F.array(*[
            F.lit(max(1 - v, 0.0)) for v in grid]), ACCURACY).alias(r) for r in RULES
        ]).alias("quantiles")), "quantiles")
    weights = written(rule_weights(known.where((half == 0) & (F.col("_good") == 0)), quantiles),
                      "weights")

    def at_levels(i: int, r: str) -> Column:
        share = F.lit(len(RULES) * (1 + 1e-9)) * F.coalesce(
            F.get("weights", F.lit(i)), F.lit(1 / len(RULES)))
        return F.transform(F.array(*[F.lit(v) for v in levels]), lambda v: F.get(
            F.col("quantiles")[r], F.size(F.filter(F.array(*[F.lit(g) for g in grid]),
                                                   lambda g: g <= v * share)) - 1))

    cutoffs = written(quantiles.join(weights, F.col("group") == F.col("_g"), "left").select(
        F.col("group").alias("_g"), F.struct(*[
            at_levels(i, r).alias(r) for i, r in enumerate(RULES)]).alias("cutoffs")), "cutoffs")
    tested = known.where((half == 1) & (F.col("_good") == 1)).join(
        cutoffs, F.col("group") == F.col("_g")).groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), *[
            F.sum(_above("cutoffs", i).cast("long")).alias(f"k{i}") for i in range(len(levels))])
    strata = tested.agg(F.count(F.lit(1))).scalar()
    tests = F.array(*[F.struct(F.col(f"k{i}").alias("k"), F.col("n"), binomial_tail(
        F.col(f"k{i}"), F.col("n"), risk).alias("p")) for i in range(len(levels))])
    held = F.aggregate("tests", F.struct(F.lit(0).alias("level"), F.lit(True).alias("on")),
                       lambda a, t: F.struct(
                           (a["level"] + (a["on"] & (t["p"] <= F.col("limit"))).cast("int"))
                           .alias("level"), (a["on"] & (t["p"] <= F.col("limit"))).alias("on")))
    held = tested.select("group", tests.alias("tests"), (F.lit(delta) / strata).alias("limit")
                         ).withColumn("level", held["level"])
    return held.join(cutoffs, F.col("group") == F.col("_g")).drop("_g").join(
        groups.select(F.col("_s").alias("stratum"), F.col("group").alias("_g")),
        F.col("group") == F.col("_g")).select("stratum", "cutoffs", "level", "tests")


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", **options) -> DataFrame:
    """(doc_id, _hash, stratum, base numbers, base_failed, kept, rules) of every row."""
    rows = written(features(docs, id_col, text_col, stratum_col), "features")
    chosen = choose_cutoffs(rows, labels, id_col=id_col, **options).where("level > 0").select(
        F.col("stratum").alias("_s"), "cutoffs", "level")
    return rows.join(chosen, F.col("stratum").eqNullSafe(F.col("_s")), "left").withColumn(
        "kept", ~F.col("base_failed") & ~(F.col("level").isNotNull()
                                          & _above("cutoffs", F.col("level") - 1))).select(
        "doc_id", "_hash", "stratum", *BASE, "base_failed", "kept", "rules")


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    good = judge(docs, labels, id_col=id_col, text_col=text_col, **options).where("kept").select(
        F.col("doc_id").alias("__llm_id"), F.col("_hash").alias("__llm_hash"))
    return docs.join(good, F.col(id_col).eqNullSafe(F.col("__llm_id"))
                     & (F.xxhash64(text_col) == F.col("__llm_hash")), "left_semi")
