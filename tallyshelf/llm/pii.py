"""Personal data: base patterns, and identifiers found through bootstrapped contexts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm.common import stored, text_or_empty

#: Kinds in the order of their spans; ``id`` is what the contexts find.
BASE, FOUND = ("email", "ip", "card", "phone"), "id"
#: The base patterns. Guards and possessive repeats change no match; they keep
#: long runs from being tried again at each place, and the stack from growing.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A run of identifier characters with a digit in it.
RUN = r"(?<![A-Za-z0-9._@/+-])[A-Za-z._@/+-]*+[0-9][A-Za-z0-9._@/+-]*+"
#: Runs that are taken for seeds besides the base spans: long hexadecimal secrets.
SECRET = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,128}$"
#: What an unseen identifier has at least.
LEAST_LENGTH, LEAST_DIGITS = 6, 3
#: A context token: a word, or one mark that parts words.
TOKEN = r"[^\x20\x09-\x0D\x22'`,;!?]+|[,;!?]"
#: What stands for a neighbouring run, and for the two edges of a text.
NUMBER, BEGIN, END = "0", "^", "$"
ROUNDS, CONFIDENT, SUPPORT = 3, 0.8, 5

SPANS = "array<struct<start:bigint,end:bigint,hit:string>>"


def with_located(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """``df`` with a column per pattern: its matches, with hit and code points before it.

    The texts between the matches come from splitting by the same pattern, so
    that running lengths give the places. Splits are columns of their own, called
    ``_split_`` and the pattern's name, NULL without a match: inside the transform's
    function they would be computed for every match.
    """
    body = df.select(
        "*",
        *[F.when(named(text).rlike(p), F.split(named(text), p, -1)).alias(f"_split_{n}") for n, p in patterns.items()],
    )

    def around(name, pattern):
        split = f"_split_{name}"
        hits = F.when(F.col(split).isNotNull(), F.regexp_extract_all(named(text), F.lit(pattern), F.lit(0)))
        return F.transform(
            hits, lambda hit, i: F.struct(hit.alias("hit"), F.char_length(F.get(split, i)).alias("gap"))
        )

    return body.select("*", *[around(n, p).alias(n) for n, p in patterns.items()])


def placed(around: Column) -> Column:
    """``start, end, hit`` of each of the ``located`` matches."""
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPANS).alias("out"))

    def step(done, x):
        start = done["at"] + x["gap"]
        end = start + F.char_length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    spans = F.aggregate(around, begin, step, lambda done: done["out"])
    return F.coalesce(spans, F.array().cast(SPANS))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    number = F.reverse(digits(hit))
    places = F.sequence(F.lit(1), F.char_length(number))

    def value(i):
        doubled = F.substring(number, i, F.lit(1)).cast("int") * (2 - F.pmod(i, F.lit(2)))
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.pmod(F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b), F.lit(10)) == 0


def valid(kind: str, hit: Column) -> Column:
    """Whether a match of the base pattern counts."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        few = F.char_length(digits(hit)).between(13, 19)
        return F.when(few, luhn(hit)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits(hit)).between(9, 15)
    return F.lit(True)


def base_spans(kind: str) -> Column:
    spans = F.filter(placed(F.col(kind)), lambda x: valid(kind, x["hit"]))
    return F.transform(spans, lambda x: F.struct(x["start"], x["end"], x["hit"])).cast(SPANS)


def edge_tokens(pieces: Column) -> Column:
    """Of each piece of text the number of its tokens, the first two, the last but one and the last.

    Tokens are words, in lower case and with digits as 0, and single marks between
    words; quotes are left out.
    """

    def edges(piece):
        plain = F.regexp_replace(F.lower(piece), "[0-9]+", NUMBER)
        tokens = F.regexp_extract_all(plain, F.lit(TOKEN), F.lit(0))
        # The array as an array of one, so that it is made once.
        return F.transform(
            F.array(tokens),
            lambda t: F.struct(
                F.size(t).alias("n"),
                F.get(t, F.lit(0)).alias("first"),
                F.get(t, F.lit(1)).alias("then"),
                F.get(t, F.size(t) - 2).alias("second"),
                F.get(t, F.size(t) - 1).alias("last"),
            ),
        )

    return F.flatten(F.transform(pieces, edges))


def lexical_patterns(edges: Column, i: Column) -> Column:
    """The contexts of run ``i``: the two tokens before it, and its neighbours on both sides.

    ``edges`` has the pieces of the whole text between runs. A run in the way
    counts as the token 0, and the text's edges as tokens of their own, so a run
    between numbers, in a line of a table or alone in a text has contexts too. A
    context of marks and numbers alone says little: it takes one token more.
    """
    before, after, earlier = F.get(edges, i), F.get(edges, i + 1), F.get(edges, i - 1)
    behind = F.when(i > 0, NUMBER).otherwise(BEGIN)
    last = F.when(before["n"] > 0, before["last"]).otherwise(behind)
    further = F.when(i == 0, BEGIN).when(earlier["n"] > 0, earlier["last"]).when(i > 1, NUMBER).otherwise(BEGIN)
    second = F.when(before["n"] > 1, before["second"]).when(before["n"] == 1, behind).otherwise(further)
    ahead = F.when(after["n"] > 0, after["first"]).when(i + 2 < F.size(edges), NUMBER).otherwise(END)
    beyond = F.get(edges, i + 2)
    far = F.when(i + 3 < F.size(edges), NUMBER).otherwise(END)
    behind_ahead = F.when(i + 2 >= F.size(edges), END).when(beyond["n"] > 0, beyond["first"]).otherwise(far)
    edge = F.when(i + 2 < F.size(edges), NUMBER).otherwise(END)
    after_next = F.when(after["n"] > 1, after["then"]).when(after["n"] == 1, edge).otherwise(behind_ahead)

    def joined(kind: str, *tokens: Column) -> Column:
        return F.concat(F.lit(kind), F.concat_ws(" ", *tokens))

    gap = F.lit("_")
    two = F.when(_wordy(second, last), joined("2:", second, last)).otherwise(joined("2:", second, last, gap, ahead))
    both = F.when(_wordy(last, ahead), joined("b:", last, gap, ahead)).otherwise(
        joined("b:", last, gap, ahead, after_next)
    )
    return F.array(two, both)


def _wordy(*tokens: Column) -> Column:
    """Whether one of the tokens has a letter."""
    return F.concat(*tokens).rlike(r"[a-z]|[^\x00-\x7F]")


def with_candidates(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns, ``_row``, the base spans by kind, and ``candidates``: the identifier runs.

    A candidate has ``start, end, run, patterns, base, secret``: it overlaps a base
    span, looks like a long hexadecimal secret, or else must look like an identifier.
    """
    body = df.select(
        *map(named, keep), F.monotonically_increasing_id().alias("_row"), text_or_empty(text).alias("_text")
    )
    body = with_located(body, "_text", {**PATTERNS, "_around": RUN}).select(
        *map(named, keep),
        "_row",
        *[base_spans(kind).alias(kind) for kind in BASE],
        placed(F.col("_around")).alias("_runs"),
        edge_tokens(F.col("_split__around")).alias("_edges"),
    )
    body = body.withColumn("_base", F.concat(*BASE))
    runs = F.transform(
        "_runs",
        lambda x, i: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.lower(x["hit"]).alias("run"),
            lexical_patterns(F.col("_edges"), i).alias("patterns"),
            F.exists("_base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])).alias("base"),
            F.lower(x["hit"]).rlike(SECRET).alias("secret"),
        ),
    )
    shaped = F.filter(
        runs,
        lambda x: x["base"]
        | x["secret"]
        | ((F.char_length(x["run"]) >= LEAST_LENGTH) & (F.char_length(digits(x["run"])) >= LEAST_DIGITS)),
    )
    return body.withColumn("candidates", shaped).drop("_runs", "_base", "_edges")


def trusted() -> Column:
    """Whether a pattern's runs are taken for identifiers."""
    return (F.col("confidence") >= CONFIDENT) & (F.col("support") + F.col("reached") >= SUPPORT)


def pattern_scores(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(pattern, confidence, support, reached)`` from a graph of ``(pattern, run, seed)`` edges.

    Seeds score 1. In each round a pattern's confidence is the sum of its runs'
    scores over their number and one more, and a run's score is the chance that
    not all its patterns err, counting those of confidence one half and over.
    ``support`` counts a pattern's seeds, ``reached`` its other runs that a pattern
    trusted in an earlier round has. After ``rounds`` rounds it goes on until a
    round trusts no further pattern; scores only rise, so each round adds some.
    """
    scored = edges.withColumn("score", F.col("seed").cast("double")).withColumn("reached", F.lit(False))
    before = None
    for done in count(1):
        confident = scored.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("confidence"),
            F.sum(F.col("seed").cast("bigint")).alias("support"),
            F.sum((F.col("reached") & ~F.col("seed")).cast("bigint")).alias("reached"),
        )
        confident = stored(confident, "confidence")
        now = confident.filter(trusted()).count()
        if done >= rounds and now == before:
            return confident
        before = now
        near = edges.join(confident.withColumn("sure", trusted()).drop("support", "reached"), "pattern")
        err = F.when(F.col("confidence") >= 0.5, F.log(1 - F.col("confidence"))).otherwise(0.0)
        runs = near.groupBy("run").agg((1 - F.exp(F.sum(err))).alias("score"), F.max("sure").alias("reached"))
        # Written, so that the join below deals out both sides itself and can split a run of many contexts.
        both = edges.join(stored(runs, "runs"), "run")
        own = F.when(F.col("seed"), 1.0).otherwise(F.col("score"))
        scored = stored(both.select("pattern", "run", "seed", own.alias("score"), "reached"), "scores")


def find_pii(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``_row``, the base kinds' spans, and ``id``: the spans found by context.

    All spans are arrays of ``(start, end, hit)``. Base spans and long hexadecimal
    secrets seed a graph of lexical patterns and identifier runs, whose scores Spark
    computes in rounds of joins and sums; the secrets, and runs beside a pattern of
    high confidence and support that no base span meets, are found. Found runs support
    further patterns in the next round, until none is added. The texts are read once; what is written is the
    spans and the runs' contexts, and the graph is pre-summed.

    NULL texts are empty and have no spans. Rows are told apart by ``_row``, so
    repeated keys and rows stay. Very long texts are read whole. An empty table
    gives an empty table. ``keep`` may name no column that begins with ``_`` or is called
    like a kind or ``candidates``: that is an error.
    """
    taken = [c for c in keep if c.startswith("_") or c in (*BASE, FOUND, "candidates")]
    if taken:
        raise ValueError(f"columns {taken} cannot be kept beside the spans: rename them")
    rows = stored(with_candidates(df, text, keep), "spans")
    runs = rows.select("_row", F.explode("candidates").alias("c")).select("_row", "c.*")
    linked = runs.withColumn("pattern", F.explode("patterns"))
    seed = F.max(F.col("base") | F.col("secret")).alias("seed")
    edges = stored(linked.groupBy("pattern", "run").agg(seed), "graph")
    sure = pattern_scores(edges).filter(trusted())
    span = ["_row", "start", "end", "run"]
    unseen = linked.filter("NOT base AND NOT secret").join(sure.select("pattern"), "pattern", "left_semi")
    added = unseen.select(*span).unionByName(runs.filter("NOT base AND secret").select(*span))
    span = F.struct("start", "end", F.col("run").alias("hit"))
    found = added.groupBy("_row").agg(F.sort_array(F.collect_set(span)).alias(FOUND))
    joined = rows.drop("candidates").join(found, "_row", "left")
    return joined.withColumn(FOUND, F.coalesce(FOUND, F.array().cast(SPANS)))


def span_list(kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of all spans, by kind, then start, joined by commas."""

    def listed(kind):
        def written(x):
            return F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string"))

        return F.transform(kind, written)

    return F.array_join(F.concat(*map(listed, kinds)), ",")


def mask_pii(df: DataFrame, text: str) -> DataFrame:
    """``df`` with every span of personal data in ``text`` replaced by its kind in angle brackets.

    Where spans overlap, the first one's kind stands for all of them. Texts
    without spans, NULL included, stay as they are. The rows are numbered and
    written first, whatever their columns are called, and only the numbers, the
    spans and the texts meet again.
    """
    whole = F.struct(*map(named, df.columns)).alias("doc")
    rows = df.select(whole, named(text).alias("text"), F.monotonically_increasing_id().alias("place"))
    numbered = stored(rows, "numbered")
    spans = find_pii(numbered.select("place", "text"), "text", ["place"])

    def marked(kind):
        return F.transform(kind, lambda x: F.struct(x["start"], x["end"], F.lit(kind).alias("kind")))

    every = F.sort_array(F.concat(*map(marked, [*BASE, FOUND])))
    hits = spans.select("place", every.alias("spans")).filter(F.size("spans") > 0)
    body = numbered.join(hits, "place", "left")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done, x):
        fresh = x["start"] >= done["at"]
        gap = F.substring("text", (done["at"] + 1).cast("int"), (x["start"] - done["at"]).cast("int"))
        part = F.array(gap, F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))
        return F.struct(
            F.greatest(done["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], part)).otherwise(done["out"]).alias("out"),
        )

    def finish(done):
        rest = F.substring("text", (done["at"] + 1).cast("int"), F.char_length("text"))
        return F.concat(F.array_join(done["out"], ""), rest)

    masked = F.when(F.col("spans").isNotNull(), F.aggregate("spans", begin, step, finish))
    changed = F.coalesce(masked, F.col("text")).alias(text)
    return body.select(*[changed if c == text else F.col("doc")[c].alias(c) for c in df.columns])
