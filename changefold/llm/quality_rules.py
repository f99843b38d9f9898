"""Quality rules whose cutoffs are chosen under a risk bound.  DataFrame functions only.

Rules compare integer metrics of a text (per mille of symbols, repeated lines, repeated words, capitals and marks, and
the mean word length on either side) with a cutoff.  Labelled good documents are halved by a hash of their id:

* the tuning half gives nested families of cutoffs, one for each level: at level j no rule alone rejects more than
  the share LEVELS[j] of a stratum's good tuning documents;
* the holdout half certifies levels, from the most lenient on: with x of n good documents rejected by any rule, level
  j is safe if P(Binomial(n, ALPHA) <= x) <= DELTA / strata (exact binomial bound, Bonferroni over strata; the fixed
  order of levels needs no further correction).  The first level that fails ends the row.

Of the certified levels of a stratum the one with the best margin on the tuning half (share of bad documents
rejected less share of good ones) is used; without a certified level or labels the rules reject nothing there.

Null text has no words.  A null stratum is a stratum of its own.  Labels with a null id or quality are not used,
repeated labels and documents count each time, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"
MARKS = "!?;:~^_=+"
RULES = ("symbols", "dup_lines", "repeat_words", "capitals", "marks", "long_words", "short_words")
#: Share of good tuning documents beyond a single rule's cutoff, by level.
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.005, 0.01)
ALPHA = 0.02
DELTA = 0.05


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def features(df: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Counts and metrics of every whole text.  All of it is row-local: one narrow stage."""
    t = F.col("text")
    rows = df.select(doc_id, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    split = rows.withColumns(
        {
            "words": F.array_remove(F.split(F.translate(t, SPACE, " " * len(SPACE)), " "), ""),
            "lines": F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACE, "") != ""),
            "word_chars": (F.length(t) - _without(t, SPACE)).cast("long"),
            "n_symbols": _without(t, SYMBOLS).cast("long"),
            "n_capitals": _without(t, CAPITALS).cast("long"),
            "n_marks": _without(t, MARKS).cast("long"),
        }
    ).drop("text")
    # One hash for each window of three words; the last two have no window.
    counted = split.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "windows": F.when(F.size("words") >= 3, F.slice(F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))), F.lit(1), F.size("words") - 2)).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("words", "lines")
    # Only texts that repeat a window sort theirs: equal neighbours are the repeats.
    ordered = counted.withColumn("pairs", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    same = lambda p, k: F.coalesce(F.get("pairs", k)["h"] == p["h"], F.lit(False))
    starts = ordered.withColumn("starts", F.filter(F.transform("pairs", lambda p, k: F.when(same(p, k - 1) | same(p, k + 1), p["i"])), lambda i: i.isNotNull())).drop("pairs")
    covered = F.size(F.array_distinct(F.flatten(F.transform("starts", lambda i: F.array(i, i + 1, i + 2)))))
    done = starts.withColumn("n_repeat_words", F.when(F.col("starts").isNull(), 0).otherwise(covered).cast("long")).drop("starts")
    return done.select(
        doc_id, "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        F.array(
            _per_mille("n_symbols", "word_chars"), _per_mille("n_dup_lines", "n_lines"), _per_mille("n_repeat_words", "n_words"), _per_mille("n_capitals", "word_chars"), _per_mille("n_marks", "word_chars"),
            F.expr("least(1000, 10 * word_chars div greatest(n_words, 1))"), F.expr("1000 - least(1000, 10 * word_chars div greatest(n_words, 1))"),
        ).alias("metrics"),
    )


def _per_mille(part: str, whole: str) -> Column:
    return F.expr(f"least(1000, 1000 * {part} div greatest({whole}, 1))")


def cutoffs(tune: DataFrame) -> DataFrame:
    """stratum, cuts: for each rule its cutoff at each level, from good tuning documents.  The histogram has at most
    1001 rows a rule and stratum, whatever the number of documents."""
    histogram = tune.select("stratum", F.posexplode("metrics").alias("rule", "v")).groupBy("stratum", "rule", "v").agg(F.count("*").alias("n"))
    key = Window.partitionBy("stratum", "rule")
    above = histogram.withColumn("above", F.sum("n").over(key.orderBy(F.desc("v"))) - F.col("n")).withColumn("all", F.sum("n").over(key))
    by_rule = above.groupBy("stratum", "rule").agg(F.array(*[F.min(F.when(F.col("above") <= share * F.col("all"), F.col("v"))) for share in LEVELS]).alias("cut"))
    return by_rule.groupBy("stratum").agg(F.transform(F.array_sort(F.collect_list(F.struct("rule", "cut"))), lambda x: x["cut"]).alias("cuts"))


def with_level(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """The first level at which a rule rejects the document; len(LEVELS) if none does, also without cutoffs."""
    level = F.array_min(F.zip_with("cuts", "metrics", lambda c, m: F.size(F.filter(c, lambda x: m <= x))))
    return df.join(cuts, "stratum", "left").withColumn("level", F.coalesce(level, F.lit(len(LEVELS)))).drop("cuts")


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= x) by the recurrence of its terms; 1 beyond the mean, where no bound is sought."""
    first = n * F.log(F.lit(1 - p))
    term = lambda a, j: a["term"] + F.log((n - j + 1) / j) + F.log(F.lit(p / (1 - p)))
    steps = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(first.alias("term"), F.exp(first).alias("total")), lambda a, j: F.struct(term(a, j).alias("term"), (a["total"] + F.exp(term(a, j))).alias("total")))["total"]
    return F.when(x > n * p, F.lit(1.0)).otherwise(total)


def certified(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum, chosen: the level to use, from labelled documents with `level`, `good` and `holdout`."""
    counts = labelled.groupBy("stratum", "level").agg(
        F.count_if(F.col("good") & F.col("holdout")).alias("good_held"), F.count_if(F.col("good") & ~F.col("holdout")).alias("good_tune"), F.count_if(~F.col("good") & ~F.col("holdout")).alias("bad_tune"))
    levels = counts.select("stratum").distinct().select("stratum", F.explode(F.array(*[F.lit(j) for j in range(len(LEVELS))])).alias("j"))
    upto = lambda c: F.sum(F.when(F.col("level") <= F.col("j"), F.col(c)).otherwise(0))
    tested = levels.join(counts, "stratum").groupBy("stratum", "j").agg(
        upto("good_held").alias("x"), F.sum("good_held").alias("n"),
        (upto("bad_tune") / F.greatest(F.sum("bad_tune"), F.lit(1)) - upto("good_tune") / F.greatest(F.sum("good_tune"), F.lit(1))).alias("margin"))
    strata = tested.withColumn("strata", F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(0)))))
    safe = strata.withColumn("safe", (F.col("n") > 0) & (binomial_cdf(F.col("x"), F.col("n"), alpha) <= delta / F.col("strata")))
    run = safe.withColumn("run", F.min(F.col("safe").cast("int")).over(Window.partitionBy("stratum").orderBy("j"))).filter("run = 1")
    return run.groupBy("stratum").agg(F.max_by("j", F.struct(F.col("margin"), -F.col("j"))).alias("chosen"))


def judged(scored: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """`scored` (from features) with level and kept.  Labels are joined on the id; quality 1 is good."""
    marked = labels.filter(F.col(doc_id).isNotNull() & F.col("quality").isNotNull()).select(doc_id, (F.col("quality") == 1).alias("good"))
    labelled = scored.filter(~F.col("base_failed")).join(marked, doc_id).withColumn("holdout", F.substring(F.md5(F.col(doc_id).cast("string")), 1, 1) >= "8")
    cuts = cutoffs(labelled.filter("good AND NOT holdout"))
    chosen = certified(with_level(labelled, cuts))
    out = with_level(scored, cuts).join(chosen, "stratum", "left")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("level") > F.coalesce("chosen", F.lit(-1))))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The counts are needed for calibration and for the verdicts; written once, they are a few dozen bytes a document.
    scored = common.saved(features(common.table(spark, sf_dir, "documents")), "quality-features")
    out = judged(scored, common.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum", "level")
