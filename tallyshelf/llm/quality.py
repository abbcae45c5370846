"""Quality rules: text statistics and robust multivariate outliers per language and source."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named
from tallyshelf.llm.common import WORD, stored, text_or_empty

WINDOW_WORDS, LEAST_WORDS, MOST_REPEATED_PERCENT = 5, 10, 20
#: Fixed values for five dimensions: the half-set's share and what makes its covariance that of
#: the whole of a normal distribution (share / chi2_7(q), q the share's quantile of chi2_5), and
#: the 1 - 10^-6 quantile of chi2_5.
SHARE, CONSISTENCY, CUTOFF = 0.75, 1.413, 35.89
STEPS, REWEIGHTED = 4, 2
#: A group of so many documents is mixed half and half with its language, and a language with the
#: pool; the odds of a group's own estimate grow with the square of its documents.
PRIOR = 20.0
#: Words of the average kind that every text's ratios are mixed with: short texts vary more.
PSEUDO_WORDS, PSEUDO_LENGTH = 50.0, 5.5
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]
VERDICT = ["base_failed", "distance", "kept"]
VECTOR = ["v_length", "v_symbols", "v_repeats", "v_lines", "v_capitals"]
#: The least standard deviation of a component, far below that of ordinary groups: it only keeps
#: the covariance of a constant component invertible.
GUARD = 0.002
PAIRS = list(combinations_with_replacement(range(len(VECTOR)), 2))
POOLED = "*"
CENTRE = [f"c_{i}" for i in range(len(VECTOR))]
COVARIANCE = [f"v_{i}_{j}" for i, j in PAIRS]
BINS_PER_OCTAVE, BIN_RANGE = 16, 1024
#: Parts that each group's rows are dealt into where shapes are joined.
SALTS = 64


def text_statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals``.

    All are bigint, computed over the whole text; a NULL text counts as empty.
    Other columns stay, also the text; those with the names added are replaced.
    """
    body = df.withColumn("_text", text_or_empty(text))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    body = body.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    body = body.withColumn("_lines", lines).withColumn("n_words", F.size("_words").cast("bigint"))
    windows = F.sequence(F.lit(0), F.size("_words") - WINDOW_WORDS)
    # Five single elements: a slice would copy the whole array for each window.
    hashes = F.transform(
        windows, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW_WORDS)])
    )
    body = body.withColumn(
        "_hashes", F.when(F.size("_words") >= WINDOW_WORDS, hashes).otherwise(F.array().cast("array<bigint>"))
    )
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    length = F.char_length("_text")
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    body = body.select(
        *[named(c) for c in body.columns if c not in ("_lines", "_words", "_hashes")],
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        (length - F.char_length(F.translate("_text", capitals, ""))).cast("bigint").alias("n_capitals"),
        F.when(repeated, F.col("_hashes")).alias("_hashes"),
    )
    numbered = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    body = body.withColumn("_sorted", F.sort_array(numbered)).drop("_hashes", "_text")
    # A window's equals are its neighbours in the sorted array.
    twins = F.filter(
        "_sorted",
        lambda x, k: (F.get("_sorted", k - 1)["h"] == x["h"]) | (F.get("_sorted", k + 1)["h"] == x["h"]),
    )
    begins = F.sort_array(F.transform(F.coalesce(twins, F.array()), lambda x: x["i"]))
    body = body.withColumn("_begins", begins).drop("_sorted")
    covered = F.transform(
        "_begins",
        lambda i, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("_begins", k + 1), i + WINDOW_WORDS) - i),
    )
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("bigint")
    added = [c for c in STATISTICS if c != "n_repeat_words"]
    own = [c for c in body.columns if c not in (*added, "_begins")]
    # A generator of one row: a filter on the statistics would else be pushed below the
    # projections above, with their array functions inlined into one another.
    found = F.array(F.struct(*[F.col(c) for c in added], total.alias("n_repeat_words")))
    return body.select(*map(named, own), F.inline(found))


def vector() -> dict[str, Column]:
    """The transformed statistics whose outliers are rejected."""
    words = F.col("n_words") + PSEUDO_WORDS
    return {
        "v_length": F.log((F.col("word_chars") + PSEUDO_WORDS * PSEUDO_LENGTH) / words),
        "v_symbols": F.log1p(20 * F.col("n_symbols") / words),
        "v_repeats": F.sqrt(F.col("n_repeat_words") / words),
        "v_lines": F.sqrt(F.col("n_dup_lines") / words),
        "v_capitals": F.log1p(F.col("n_capitals") / words),
    }


def chance() -> dict[str, Column]:
    """What chance moves each component in a text of so many words, as a standard deviation.

    Half an event, in a text without any: one symbol, one duplicate line, one repeated
    window (ten words), one acronym (five capitals); for the mean length, half the deviation
    that words of a relative spread of one half give it.
    """
    words = F.col("n_words") + PSEUDO_WORDS
    return {
        "v_length": 0.25 * F.sqrt(F.col("n_words")) / words,
        "v_symbols": F.log1p(20 * 0.5 / words),
        "v_repeats": 0.25 * F.sqrt(10 / words),
        "v_lines": 0.25 * F.sqrt(1 / words),
        "v_capitals": F.log1p(2.5 / words),
    }


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def _cholesky(cov: dict[tuple[int, int], Column]) -> Iterator[tuple[str, Column]]:
    """Columns of the lower triangle, one after the other, each over those before."""
    for j in range(len(VECTOR)):
        for i in range(j, len(VECTOR)):
            rest = cov[j, i]
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            yield f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}")


def _with_shape(moments: DataFrame, scale: float) -> DataFrame:
    """``group, n, c_i, v_i_j, l_i_j``: centre, covariance and its factor from sums ``n, s_i, p_i_j``."""
    centred = moments.select(
        "group",
        "n",
        *[(F.col(f"s_{i}") / F.col("n")).alias(f"c_{i}") for i in range(len(VECTOR))],
        *[F.col(f"p_{i}_{j}") for i, j in PAIRS],
    )
    cov = {}
    for i, j in PAIRS:
        cov[i, j] = scale * (F.col(f"p_{i}_{j}") / F.col("n") - F.col(f"c_{i}") * F.col(f"c_{j}"))
        if i == j:
            cov[i, j] = F.greatest(cov[i, j], F.lit(GUARD**2)) + 1e-9
    return _factored(centred.select("*", *[c.alias(f"v_{i}_{j}") for (i, j), c in cov.items()]))


def _factored(shaped: DataFrame) -> DataFrame:
    for name, column in _cholesky({p: F.col(f"v_{p[0]}_{p[1]}") for p in PAIRS}):
        shaped = shaped.withColumn(name, column)
    factors = [f"l_{i}_{j}" for j in range(len(VECTOR)) for i in range(j, len(VECTOR))]
    return shaped.select("group", "n", *CENTRE, *COVARIANCE, *factors)


def distance(noise: dict[str, Column] | None = None) -> Column:
    """Squared Mahalanobis distance, by forward substitution in the joined Cholesky factor.

    With ``noise``, each variance is the joined one and the row's own noise, under the
    joined correlations.
    """
    parts: list[Column] = []
    for i, name in enumerate(VECTOR):
        rest = F.col(name) - F.col(f"c_{i}")
        if noise:
            own = F.col(f"v_{i}_{i}")
            rest = rest * F.sqrt(own / (own + noise[name] * noise[name]))
        for k, part in enumerate(parts):
            rest = rest - F.col(f"l_{i}_{k}") * part
        parts.append(rest / F.col(f"l_{i}_{i}"))
    total = parts[0] * parts[0]
    for part in parts[1:]:
        total = total + part * part
    return total


def _moments(rows: DataFrame, *by: str) -> DataFrame:
    sums = [F.sum(name).alias(f"s_{i}") for i, name in enumerate(VECTOR)]
    sums += [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"p_{i}_{j}") for i, j in PAIRS]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *sums)


def _beside(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """``rows`` with the shape of their group; rows of a group without one fall away.

    Every group is dealt into salts and its shape repeated for each, so the pool and
    a hot source are no single task when the sums that follow are taken where the
    join has put the rows.
    """
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    return salted.join(shapes.select("*", salts), ["group", "_salt"]).drop("_salt")


def _nearest(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """Moments of the ``SHARE`` of each group's rows nearest by ``shapes``, one C-step.

    The rows are summed by group and bin of distance; the nearest bins that hold
    the share make the new half-set, so no group is sorted or gathered.
    """
    far = distance()
    octave = F.floor(F.log2(F.greatest(far, F.lit(1e-9))) * BINS_PER_OCTAVE)
    binned = _beside(rows, shapes.drop("n", *COVARIANCE)).withColumn(
        "bin", F.least(octave, F.lit(BIN_RANGE)).cast("int")
    )
    sums = _moments(binned, "group", "bin")
    whole = Window.partitionBy("group")
    nearer = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    held = sums.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
    held = held.withColumn("all", F.sum("n").over(whole))
    names = [f"s_{i}" for i in range(len(VECTOR))] + [f"p_{i}_{j}" for i, j in PAIRS]
    inside = held.filter(F.col("before") < SHARE * F.col("all"))
    return inside.groupBy("group").agg(*[F.sum(c).alias(c) for c in ["n", *names]])


def robust_shapes(rows: DataFrame, steps: int = STEPS, also: Sequence[str] = ()) -> DataFrame:
    """``group, n, c_i, v_i_j, l_i_j``: the minimum-covariance-determinant estimate of each group.

    ``rows`` has ``group`` and the vector. Starts from each component's median and
    spread, then takes ``steps`` concentration steps: distances, the nearest three
    quarters, their mean and covariance. Every step is one pass that sums per
    group and bin before it shuffles. Group ``*`` is the estimate over all rows;
    the columns ``also`` name further groups that a row belongs to.
    """
    every = rows.select(F.explode(F.array("group", *also, F.lit(POOLED))).alias("group"), *VECTOR)
    middles = [F.percentile_approx(v, 0.5, 1000).alias(f"c_{i}") for i, v in enumerate(VECTOR)]
    start = stored(every.groupBy("group").agg(F.count("*").alias("n"), *middles), "medians")
    off = [F.abs(F.col(v) - F.col(f"c_{i}")).alias(f"d_{i}") for i, v in enumerate(VECTOR)]
    spread = _beside(every, start).select("group", *off).groupBy("group").agg(
        *[F.percentile_approx(f"d_{i}", 0.5, 1000).alias(f"m_{i}") for i in range(len(VECTOR))]
    )
    sums = [(F.col("n") * F.col(f"c_{i}")).alias(f"s_{i}") for i in range(len(VECTOR))]
    square = lambda i: F.col(f"c_{i}") * F.col(f"c_{i}") + F.pow(1.4826 * F.col(f"m_{i}"), 2)
    products = [
        (F.col("n") * (square(i) if i == j else F.col(f"c_{i}") * F.col(f"c_{j}"))).alias(f"p_{i}_{j}")
        for i, j in PAIRS
    ]
    shapes = stored(_with_shape(start.join(spread, "group").select("group", "n", *sums, *products), 1.0), "start")
    for _ in range(steps):
        shapes = stored(_with_shape(_nearest(every, shapes), CONSISTENCY), "shapes")
    return shapes


def group_of(language: str, source: str) -> Column:
    return F.to_json(F.struct(named(language).alias("l"), named(source).alias("s")))


def language_of(language: str) -> Column:
    """The name of a language's own group: no group of a language and a source is called so."""
    return F.concat(F.lit("l"), F.to_json(F.struct(named(language).alias("l"))))


def _mixed(own: DataFrame, above: DataFrame) -> DataFrame:
    """``own`` shapes of ``n`` documents, each mixed with its ``parent``'s shape.

    Centre and covariance are those of the mixture, so the gap between the two centres widens it.
    """
    odds = F.pow(F.col("n") / PRIOR, 2)
    share = odds / (odds + 1)
    lifted = above.select(F.col("group").alias("parent"), *[F.col(c).alias(f"a{c}") for c in [*CENTRE, *COVARIANCE]])
    gap = [F.col(c) - F.col(f"a{c}") for c in CENTRE]
    centre = [(share * F.col(c) + (1 - share) * F.col(f"a{c}")).alias(c) for c in CENTRE]
    cov = [
        (share * F.col(c) + (1 - share) * F.col(f"a{c}") + share * (1 - share) * gap[i] * gap[j]).alias(c)
        for c, (i, j) in zip(COVARIANCE, PAIRS, strict=True)
    ]
    return stored(_factored(own.join(lifted, "parent").select("group", "n", *centre, *cov)), "mixed")


def group_shapes(sound: DataFrame) -> DataFrame:
    """``group, c_i, v_i_j, l_i_j``: each group's estimate mixed with its language's, and that with the pool's.

    ``sound`` has ``group, language, n_words`` and the vector. The estimates by the inner
    three quarters are taken again over all documents that they do not reject: counts that
    are mostly 0 have their spread outside the inner part. The weight of a group's own
    estimate grows steadily with its documents.
    """
    shapes = robust_shapes(sound, also=["language"])
    every = sound.withColumn("group", F.explode(F.array("group", "language", F.lit(POOLED))))
    for _ in range(REWEIGHTED):
        within = _beside(every, shapes.drop("n")).filter(distance(chance()) <= CUTOFF)
        shapes = stored(_with_shape(_moments(within, "group"), 1.0), "reweighted")
    shapes = shapes.select("group", *CENTRE, *COVARIANCE)
    sizes = stored(sound.groupBy("group", "language").agg(F.count("*").alias("n")), "sizes")
    languages = sizes.groupBy(F.col("language").alias("group")).agg(F.sum("n").alias("n"))
    pool = shapes.filter(F.col("group") == POOLED)
    languages = _mixed(languages.withColumn("parent", F.lit(POOLED)).join(shapes, "group"), pool)
    return _mixed(sizes.withColumnRenamed("language", "parent").join(shapes, "group"), languages).drop("n")


def quality_verdicts(
    df: DataFrame, text: str, language: str, source: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` columns of ``df`` (all by default), its statistics, ``base_failed``, ``distance``, ``kept``.

    A document is kept unless it fails the base rules (under 10 words, or over a
    fifth of its words in repeated 5-word windows) or its vector of transformed
    statistics is an outlier: its squared Mahalanobis distance under the
    minimum-covariance-determinant estimate of its language and source exceeds
    the 1 - 10^-6 quantile. Each group's estimate is mixed with its language's, and
    that with the pool's, the less the more documents it has (half at 20), and every
    text's variances are widened by what chance moves in so many words. Documents that fail the base rules do not
    take part in the estimates.

    The texts are read once: the kept columns are written beside the statistics,
    and all estimates read those. NULL languages and sources form groups of their
    own; a NULL text is empty and fails the base rules. Repeated rows stay. Kept
    columns with the names added are replaced; an empty table gives an empty table.
    """
    own = [c for c in (df.columns if keep is None else keep) if c not in (*STATISTICS, *VERDICT)]
    body = df.select(
        F.struct(*map(named, own)).alias("own"),
        named(text).alias("text"),
        group_of(language, source).alias("group"),
        language_of(language).alias("language"),
    )
    rows = text_statistics(body, "text").drop("text").withColumn("base_failed", base_failed())
    rows = stored(rows.select("*", *[column.alias(name) for name, column in vector().items()]), "statistics")
    sound = rows.filter("NOT base_failed").select("group", "language", "n_words", *VECTOR)
    judged = _judged(rows, group_shapes(sound))
    return judged.select(*[F.col("own")[c].alias(c) for c in own], *STATISTICS, *VERDICT)


def _judged(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """``rows`` with ``distance`` and ``kept``, by the shape of the group."""
    # A group without a shape has no document that passed the base rules.
    joined = rows.join(shapes, "group", "left")
    judged = joined.withColumn("distance", F.when(~F.col("base_failed"), distance(chance())))
    near = F.coalesce("distance", F.lit(0.0)) <= CUTOFF
    return judged.withColumn("kept", ~F.col("base_failed") & near)
