"""Byte-level language model by context-tree weighting, and word-frequency scores beside it.

A byte is eight binary decisions, each with a context tree of its own: the bits
of the byte so far choose the tree, the bytes before choose the node at each
depth. A node mixes its own Krichevsky-Trofimov estimate with what its children
say, weighted by how well each has coded the training bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm.common import stored, text_or_empty

#: Bytes of context, 2 to 5; a gram is the context and the byte it predicts, oldest byte highest.
DEPTH = 4
#: As many zero bytes as the context has stand before each text, and one ends it.
END = b"\0"
#: Bits of a gram's code; the ones above number a text among a few.
GRAM_BITS = 48
#: The most frequent words, which every worker holds if they have at most so many bytes each; the
#: counts of all others are joined.
FREQUENT, HELD_BYTES = 1 << 18, 64
#: Up to so many grams (16 bytes each) the model goes to every worker; beyond, it is joined.
HELD_GRAMS = 4_000_000
#: Rows a task gathers before it hands its counts on.
GATHERED = 1_000_000
SMOOTHING = 0.1
HALF = np.log(0.5)


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts one after the other, and how many each text has."""
    before = bytes(depth)
    joined = np.frombuffer(b"".join(p for t in texts for p in (before, t, END)), np.uint8)
    codes = np.zeros(max(len(joined) - depth, 0), np.int64)
    for k in range(depth + 1):
        codes = codes << 8 | joined[k : len(joined) - depth + k]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    keep = np.ones(len(codes), bool)
    # What predicts a byte of the zeros before the next text is no gram.
    between = np.cumsum(sizes)[:-1] + depth * np.arange(len(sizes) - 1)
    for k in range(depth):
        keep[between + k] = False
    return codes[keep], sizes


def split_words(text: bytes) -> list[bytes]:
    """Words with A-Z lowered; bytes.lower and bytes.split know ASCII alone."""
    return text.lower().split()


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0


def counts(df: DataFrame, text: str, train: Column, depth: int = DEPTH) -> DataFrame:
    """``(word, gram, n)``: training counts of words (``gram`` NULL) and grams (``word`` NULL).

    Grams of other texts are listed with a count of 0, as scores are needed for
    them too. A task's counts are summed before they shuffle.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def word_rows():
            size = len(found)
            columns = [pa.array(list(found), pa.binary()).cast(pa.string()), pa.nulls(size, pa.int64())]
            columns.append(pa.array(list(found.values()), pa.int64()))
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "gram", "n"])

        def gram_rows():
            columns = [pa.nulls(len(codes), pa.string()), pa.array(codes), pa.array(sums)]
            return pa.RecordBatch.from_arrays(columns, ["word", "gram", "n"])

        for batch in batches:
            trained = batch.column(1).to_pylist()
            for at in range(0, batch.num_rows, 1000):
                texts = [t.as_py().encode() for t in batch.column(0)[at : at + 1000]]
                use = trained[at : at + 1000]
                for one, yes in zip(texts, use, strict=True):
                    if yes:
                        found.update(split_words(one))
                codes_now, sizes = grams(texts, depth)
                seen = np.repeat(use, sizes)
                for part, weight in ((codes_now[seen], 1), (codes_now[~seen], 0)):
                    new, n = np.unique(part, return_counts=True)
                    codes, place = np.unique(np.r_[codes, new], return_inverse=True)
                    sums = np.bincount(place, np.r_[sums, n * weight], len(codes)).astype(np.int64)
            if len(found) >= GATHERED:
                yield word_rows()
            if len(codes) >= GATHERED:
                yield gram_rows()
                codes, sums = codes[:0], sums[:0]
        yield word_rows()
        yield gram_rows()

    narrow = df.select(text_or_empty(text).alias("text"), train.alias("train"))
    partial = narrow.mapInArrow(count, "word string, gram bigint, n bigint")
    return partial.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function of positive numbers (Stirling's series from 8 on)."""
    x = np.asarray(x, np.float64)
    low = np.where(x < 8, x, 8.0)
    product = np.ones_like(low)
    for k in range(8):
        product *= np.where(x < 8, low + k, 1.0)
    y = np.where(x < 8, x + 8, x)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Nodes:
    """The nodes of one depth: counts, block probabilities and each gram-bit's node."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray, n: np.ndarray):
        self.keys, self.of = np.unique(keys, return_inverse=True)
        size = len(self.keys)
        self.ones = np.bincount(self.of, n * bits, size)
        self.zeros = np.bincount(self.of, n * (1 - bits), size)
        self.own = log_kt(self.zeros, self.ones)
        self.weighted = self.own

    def weigh(self, below: np.ndarray) -> None:
        """``below``: the sum of the children's log weighted probabilities."""
        self.below = below
        self.weighted = HALF + np.logaddexp(self.own, below)

    def predict(self, bits: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of each gram-bit: the node's own estimate mixed with the deeper one."""
        count = np.where(bits, self.ones[self.of], self.zeros[self.of])
        own = (count + 0.5) / (self.ones + self.zeros + 1.0)[self.of]
        if deeper is None:
            return own
        share = np.exp(HALF + self.own - self.weighted)[self.of]
        return share * own + (1 - share) * deeper


def decisions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(prefix, bit)``, each ``(n, 8)``: the tree of each binary decision and its outcome."""
    byte = (codes & 255)[:, None]
    level = np.arange(8)
    return (1 << level) | (byte >> (8 - level)), byte >> (7 - level) & 1


def lower_tree(codes: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> tuple[Nodes, np.ndarray]:
    """The nodes of depth 2 and the probability of each gram-bit by all depths from 2 on.

    ``codes`` must hold all grams of each two latest context bytes it has.
    """
    prefix, bit = decisions(codes)
    context = (codes >> 8)[:, None]
    flat, count = bit.ravel(), np.repeat(n, 8).astype(np.float64)
    levels: list[Nodes] = []
    for size in range(depth, 1, -1):
        nodes = Nodes(((context & ((1 << 8 * size) - 1)) << 8 | prefix).ravel(), flat, count)
        if levels:
            parent = np.searchsorted(nodes.keys, levels[-1].keys & ((1 << 8 * (size + 1)) - 1))
            nodes.weigh(np.bincount(parent, levels[-1].weighted, len(nodes.keys)))
        levels.append(nodes)
    probability = None
    for nodes in levels:
        probability = nodes.predict(flat, probability)
    return levels[-1], probability


class UpperTree:
    """Depths 1 and 0, from sums per latest context byte and tree: at most 256 * 255 rows."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        own = log_kt(zeros, ones)
        weighted = HALF + np.logaddexp(own, below)
        self.share, self.one = np.ones(1 << 16), np.full(1 << 16, 0.5)
        self.share[keys] = np.exp(HALF + own - weighted)
        self.one[keys] = (ones + 0.5) / (zeros + ones + 1.0)
        root = keys & 255
        zeros, ones, below = (np.bincount(root, c, 256) for c in (zeros, ones, weighted))
        own = log_kt(zeros, ones)
        self.root_share = np.exp(own - np.logaddexp(own, below))
        self.root_one = (ones + 0.5) / (zeros + ones + 1.0)

    def log10(self, codes: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's byte from the lower tree's gram-bit probabilities."""
        prefix, bit = decisions(codes)
        key = (codes >> 8 & 255)[:, None] << 8 | prefix
        own = np.where(bit, self.one[key], 1 - self.one[key])
        mixed = self.share[key] * own + (1 - self.share[key]) * deeper.reshape(-1, 8)
        own = np.where(bit, self.root_one[prefix], 1 - self.root_one[prefix])
        share = self.root_share[prefix]
        return np.log10(share * own + (1 - share) * mixed).sum(axis=1)


def gram_scores(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(gram, score)``: the model's log10 probability of each gram's byte in its context.

    ``counted`` has ``(gram, n)``. The lower depths are computed where all grams of
    the two latest context bytes meet, the upper two on the driver from sums per
    context byte and tree, whose number the alphabet bounds.
    """
    dealt = counted.repartition(F.col("gram").bitwiseAND(0xFFFF00)).select("gram", "n")

    def arrays(batches):
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        return np.concatenate([g for g, _ in got]), np.concatenate([n for _, n in got])

    def nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if batches:
            middle, _ = lower_tree(*arrays(batches), depth)
            columns = [middle.keys & 0xFFFF, middle.zeros, middle.ones, middle.weighted]
            names = ["node", "zeros", "ones", "below"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    summed = dealt.mapInArrow(nodes, "node bigint, zeros double, ones double, below double")
    upper = summed.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
    rows = upper.toArrow().sort_by("node")
    tree = UpperTree(*(rows.column(c).to_numpy() for c in ("node", "zeros", "ones", "below")))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if batches:
            codes, n = arrays(batches)
            _, deeper = lower_tree(codes, n, depth)
            columns = [pa.array(codes), pa.array(tree.log10(codes, deeper))]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "score"])

    return dealt.mapInArrow(score, "gram bigint, score double")


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the rows of ``(word, n)``, those with the largest counts, of 64 bytes at most each.

    All such words down to a count are taken, found from the numbers of words per
    sixteenth of a power of two: a few hundred numbers on the driver, and no sort.
    """
    words = words.filter(F.octet_length("word") <= HELD_BYTES)
    step = F.floor(F.log2("n") * 16)
    sizes = dict(words.groupBy(step.alias("step")).count().collect())
    lowest, room = None, most
    for at in sorted(sizes, reverse=True):
        room -= sizes[at]
        if room < 0:
            break
        lowest = at
    return words.filter(F.lit(False) if lowest is None else step >= lowest)


def score_texts(
    df: DataFrame,
    key: str,
    text: str,
    *,
    depth: int = DEPTH,
    frequent: int = FREQUENT,
    held_grams: int = HELD_GRAMS,
) -> DataFrame:
    """``(key, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Learns from the rows whose key is not held out (a tenth by hash): byte grams
    and ``depth`` bytes of context for the context-tree model, words for the smoothed word frequencies. ``score``
    is the model's log10 probability of the text and its end, ``base_score`` that
    of its words by frequency. All texts are counted and scored whole.

    The gram table goes to every worker up to ``held_grams`` rows and is joined
    beyond. The ``frequent`` most frequent words go to every worker; the
    counts of the others are joined word by word, each text's occurrences summed before.

    NULL texts are empty: one end. NULL keys are keyed by the empty string. Rows
    are told apart by their place in ``df``, which should be a table that was
    read, so that a rerun finds the same places; repeated rows stay. Without any
    training text all counts are 0. An empty table gives an empty table.
    """
    if not 2 <= depth <= 5:
        raise ValueError("depth must be 2 to 5")
    spark = df.sparkSession
    train = ~held_out(named(key))
    table = stored(counts(df, text, train, depth), "counts")
    words = table.filter("word IS NOT NULL").select("word", "n")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = df.select(train.alias("t")).filter("t").count()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)
    floor = total + SMOOTHING * (distinct + 1)
    top = frequent_words(words, frequent).toArrow()
    shares = np.log10((top.column("n").to_numpy() + SMOOTHING) / (floor or 1.0))
    known = spark.sparkContext.broadcast(
        dict(zip((w.encode() for w in top.column("word").to_pylist()), shares.tolist(), strict=True))
    )
    end = float(np.log10((ends + SMOOTHING) / floor)) if floor else 0.0
    model = stored(gram_scores(table.filter("gram IS NOT NULL"), depth), "model")
    held = None
    if model.count() <= held_grams:
        local = model.toArrow().sort_by("gram")
        codes = local.column("gram").to_numpy()
        held = spark.sparkContext.broadcast((codes, local.column("score").to_numpy()))

    names = ["row", "key", "item", "gram", "n", "n_bytes", "n_tokens", "n_known", "base", "score"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.column(0)[at : at + 500].to_numpy()
                texts = [t.as_py().encode() for t in batch.column(1)[at : at + 500]]
                yield from scores(rows, texts, batch.column(2)[at : at + 500])

    def scores(rows, texts, keys):
        codes, sizes = grams(texts, depth)
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        if held is not None:
            place = np.searchsorted(held.value[0], codes)
            by_text = np.add.reduceat(held.value[1][place], begins)
        else:
            by_text = np.zeros(len(texts))
            number = np.repeat(np.arange(len(texts)), sizes)
            pair, n = np.unique(number << GRAM_BITS | codes, return_counts=True)
            yield rest(rows[pair >> GRAM_BITS], n, keys.type, gram=pair & ((1 << GRAM_BITS) - 1))
        tokens, sure, base, rare_row, rare_word, rare_n = [], [], [], [], [], []
        get = known.value.get
        for row, one in zip(rows, texts, strict=True):
            found = split_words(one)
            values = [get(w) for w in found]
            missing = values.count(None)
            if missing:
                rare = Counter(w for w, v in zip(found, values, strict=True) if v is None)
                rare_row += [row] * len(rare)
                rare_word += rare
                rare_n += rare.values()
                values = [v for v in values if v is not None]
            tokens.append(len(found) + 1)
            sure.append(len(values) + (ends > 0))
            base.append(sum(values) + end)
        yield rest(np.array(rare_row, np.int64), np.array(rare_n, np.int64), keys.type, words=rare_word)
        # A text's own row: its item has a space and the row's number, so it meets no word.
        item = pa.array([f" {r}" for r in rows.tolist()])
        none = pa.nulls(len(rows), pa.int64())
        columns = [pa.array(rows), keys, item, none, none]
        columns += [pa.array(sizes - 1), pa.array(tokens, pa.int64()), pa.array(sure, pa.int64())]
        columns += [pa.array(base, pa.float64()), pa.array(by_text)]
        yield pa.RecordBatch.from_arrays(columns, names)

    def rest(rows, n, kind, *, words=None, gram=None):
        size = len(rows)
        item = pa.array(words, pa.binary()).cast(pa.string()) if words is not None else pa.nulls(size, pa.string())
        code = pa.array(gram) if gram is not None else pa.nulls(size, pa.int64())
        columns = [pa.array(rows, pa.int64()), pa.nulls(size, kind), item, code, pa.array(n, pa.int64())]
        columns += [pa.nulls(size, pa.int64())] * 3 + [pa.nulls(size, pa.float64())] * 2
        return pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[key].dataType.simpleString()
    numbered = df.select(
        F.monotonically_increasing_id().alias("row"), text_or_empty(text).alias("text"), named(key).alias("key")
    )
    scanned = numbered.select("row", "text", "key").mapInArrow(
        scan,
        f"row bigint, key {kind}, item string, gram bigint, n bigint, n_bytes bigint,"
        " n_tokens bigint, n_known bigint, base double, score double",
    )
    return _gathered(scanned, words, model if held is None else None, floor, total)


def _gathered(scanned, words, model, floor, total):
    by_word = scanned.filter("gram IS NULL").join(
        words.select(F.col("word").alias("item"), F.col("n").alias("c")), "item", "left"
    )
    rare = F.log10((F.coalesce("c", F.lit(0)) + SMOOTHING) / F.lit(float(floor or 1)))
    parts = by_word.select(
        "row",
        "key",
        "n_bytes",
        "n_tokens",
        F.coalesce("n_known", F.when(F.col("c") > 0, F.col("n"))).alias("n_known"),
        F.coalesce("base", F.col("n") * rare).alias("base"),
        "score",
    )
    if model is not None:
        by_gram = scanned.filter("gram IS NOT NULL").join(model.withColumnRenamed("score", "each"), "gram")
        none = [F.lit(None).cast("bigint").alias(c) for c in ("n_bytes", "n_tokens", "n_known")]
        parts = parts.unionByName(
            by_gram.select(
                "row", "key", *none, F.lit(None).cast("double").alias("base"), (F.col("n") * F.col("each")).alias("score")
            )
        )
    sums = parts.groupBy("row").agg(
        F.max("key").alias("key"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("n_tokens").alias("n_tokens"),
        F.coalesce(F.sum("n_known"), F.lit(0)).alias("n_known"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    )
    return sums.select(
        "key",
        held_out(F.col("key")).alias("held_out"),
        "n_bytes",
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )

