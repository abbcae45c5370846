"""Terms of texts: counts, TF-IDF weights, and scores learned from labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named

#: A run of ASCII letters and characters beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Steps that the range of scores is cut into where a threshold is sought.
STEPS = 1000


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term, n)``: how often each text has each term; A to Z count as a to z.

    Rows of one key are one text. NULL texts and texts without terms have no row.
    The texts themselves are dealt by key, as wide as the session shuffles, and
    their terms counted where they lie: a text is a fraction of its counted terms.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(named(key).alias("key"), named(text).alias("text")).repartition(width, "key")
    folded = F.translate("text", UPPER, LOWER)
    terms = F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))
    return texts.select("key", terms.alias("term")).groupBy("key", "term").agg(F.count("*").alias("n"))


def term_weights(counts: DataFrame, *, least_docs: int = 1) -> DataFrame:
    """``(key, term, n, docs, weight)`` of the terms that ``least_docs`` texts or more have.

    The weight is n * ln(all texts / texts with the term), all texts being those
    with any term: 0 for a term that every text has. The vocabulary is joined, whatever its size: no task holds
    it, and a term that all texts have is split over tasks like any skewed key.
    """
    docs = counts.groupBy("term").agg(F.count("*").alias("docs"))
    if least_docs > 1:
        docs = docs.filter(F.col("docs") >= least_docs)
    size = counts.agg(F.count_distinct("key")).scalar()
    weight = F.col("n") * F.log(size.cast("double") / F.col("docs"))
    return counts.join(docs, "term").select("key", "term", "n", "docs", weight.alias("weight"))


def top_terms(weights: DataFrame, k: int) -> DataFrame:
    """The ``k`` heaviest terms of each text, with ``rank``; ties by name."""
    order = Window.partitionBy("key").orderBy(F.desc("weight"), "term")
    return weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def term_vectors(weights: DataFrame) -> DataFrame:
    """``(key, terms, norm)``: each text's weights as a sparse vector of length 1, and its length before.

    ``terms`` is an array of ``(term, weight)`` in order of term; a text whose weights are all 0 has norm 0 and
    weights 0. A text's terms meet in one task, as its own text did.
    """
    entry = F.struct("term", "weight")
    grouped = weights.groupBy("key").agg(
        F.array_sort(F.collect_list(entry)).alias("terms"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )
    scaled = F.transform(
        "terms",
        lambda t: F.struct(
            t["term"].alias("term"), F.when(F.col("norm") > 0, t["weight"] / F.col("norm")).otherwise(0.0).alias("weight")
        ),
    )
    return grouped.select("key", scaled.alias("terms"), "norm")


def term_log_odds(counts: DataFrame, labels: DataFrame, *, smoothing: float = 1.0) -> DataFrame:
    """``(term, log_odds)`` from the texts whose ``(key, label)`` row in ``labels`` says 0 or 1.

    A term's share of the occurrences in texts labelled 1 against that in texts
    labelled 0, both smoothed, as a logarithm. Every term of a labelled text counts.
    """
    labelled = counts.join(labels.select("key", "label").filter("label IN (0, 1)"), "key")
    yes = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("yes")
    no = F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("no")
    by_term = labelled.groupBy("term").agg(yes, no)
    totals = by_term.agg(F.sum("yes").alias("y"), F.sum("no").alias("n"), F.count("*").alias("v"))
    whole = {c: totals.select(F.col(c).cast("double")).scalar() for c in ("y", "n", "v")}

    def share(count: str, total: str) -> Column:
        return (F.col(count) + smoothing) / (whole[total] + smoothing * whole["v"])

    return by_term.select("term", F.log(share("yes", "y") / share("no", "n")).alias("log_odds"))


def text_scores(counts: DataFrame, log_odds: DataFrame) -> DataFrame:
    """``(key, n_terms, n_known, score)``: the mean log odds of a text's known terms; 0 without one.

    Every term of every text counts; terms join their odds, combined per text before the last shuffle.
    """
    joined = counts.join(log_odds, "term", "left")
    known = F.when(F.col("log_odds").isNotNull(), F.col("n")).otherwise(0)
    summed = joined.groupBy("key").agg(
        F.sum("n").alias("n_terms"), F.sum(known).alias("n_known"), F.sum(F.col("n") * F.col("log_odds")).alias("total")
    )
    score = F.when(F.col("n_known") > 0, F.col("total") / F.col("n_known")).otherwise(0.0)
    return summed.select("key", "n_terms", "n_known", score.alias("score"))


def best_threshold(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """``(threshold, accuracy)``: the score from which on a text counts as 1, by the mean of both labels' accuracies.

    The range of the scores is cut into 1000 steps and the texts counted per step
    and label, so only a thousand rows are sorted, whatever the texts; of steps
    equally good the lowest. One row; NULL without a labelled text.
    """
    rows = scores.join(labels.select("key", "label").filter("label IN (0, 1)"), "key").select("score", "label")
    ends = rows.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    step = F.when(high > low, F.least(F.floor((F.col("score") - low) / (high - low) * STEPS), F.lit(STEPS - 1))).otherwise(0)
    counted = rows.groupBy(step.cast("int").alias("step")).agg(
        F.count_if(F.col("label") == 1).alias("yes"), F.count_if(F.col("label") == 0).alias("no")
    )
    order = Window.orderBy("step")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = order.rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(below), F.lit(0))

    def part(column: Column, whole: str) -> Column:
        total = F.sum(whole).over(every)
        return F.when(total > 0, column / total).otherwise(0.0)

    accuracy = (part(F.sum("yes").over(every) - before("yes"), "yes") + part(before("no"), "no")) / 2
    scored = counted.withColumn("accuracy", accuracy)
    best = scored.agg(F.max(F.struct("accuracy", (-F.col("step")).alias("s"))).alias("b"))
    threshold = low + (high - low) * (-F.col("b.s")) / STEPS
    return best.select(threshold.alias("threshold"), F.col("b.accuracy").alias("accuracy"))
