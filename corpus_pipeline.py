"""Documents to packed training sequences, one operator a stage.

Quality rules, SimHash near-dedup, masked personal data, a mix of sources to
target weights, packing. Each stage works on all rows its predecessor kept; all
but the last return the columns of documents, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm.common import WORD, WRITTEN, discard, stored, text_or_empty
from tallyshelf.llm.mixing import mix_sources
from tallyshelf.llm.packing import pack_documents
from tallyshelf.llm.pii import mask_pii
from tallyshelf.llm.quality import quality_verdicts
from tallyshelf.llm.queries import TOKENIZER, WEIGHTS
from tallyshelf.llm.simhash import near_duplicates
from tallyshelf.sources.scratch import scratch_folder


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What the stages of a chain have written for themselves, with the stage's place: a chain is
#: one thread's stages over one folder of tables.
_left: dict[tuple[int, str], list[tuple[int, str]]] = {}


def _stage(work: Stage) -> Stage:
    """The stage, which first deletes what earlier stages of its chain wrote for themselves.

    A stage's result is written before a later stage begins, so nothing reads those
    folders then; kept, each would hold the documents once more. A result that was
    not written but handed on as it is still reads them: they stay. A stage that is
    called again deletes nothing, so two results of one stage stand side by side.
    """

    @wraps(work)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        place = [name for name, _ in STAGES].index(begin.stage)
        mine = _left.setdefault((get_ident(), sf_dir), [])
        earlier = [folder for at, folder in mine if at < place]
        read = docs.inputFiles() if earlier else []
        gone = [f for f in earlier if not any(_name(f) in file for file in read)]
        discard(spark, gone)
        mine[:] = [(at, folder) for at, folder in mine if folder not in gone]
        before = len(WRITTEN)
        result = work(spark, docs, sf_dir)
        mine += [(place, folder) for folder in WRITTEN[before:]]
        return result

    return begin


def _name(folder: str) -> str:
    return folder.rstrip("/").rpartition("/")[2]


def _whole(docs: DataFrame, *columns: str) -> DataFrame:
    """All columns as one struct ``doc``, beside copies of some: no name of a stage can clash."""
    return docs.select(F.struct(*map(named, docs.columns)).alias("doc"), *map(named, columns))


def _numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """``_whole`` with a ``row`` that tells repeated rows apart, written so that it stays."""
    return stored(_whole(docs, *columns).withColumn("row", F.monotonically_increasing_id()), "numbered")


@_stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    judged = quality_verdicts(_whole(docs, "text", "lang", "source"), "text", "lang", "source", ["doc"])
    return judged.filter("kept").select("doc.*")


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each near-duplicate group, in the order the rows are stored."""
    numbered = _numbered(docs, "text")
    groups = near_duplicates(numbered, "row", "text")
    first = groups.filter(F.col("key") == F.col("component")).select(F.col("key").alias("row"))
    return numbered.join(first, "row", "left_semi").select("doc.*")


@_stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind; ``n_chars`` follows the text."""
    masked = mask_pii(_whole(docs, "text"), "text")
    text, size = F.col("text"), F.char_length("text").cast("bigint")
    new = {"text": text, "n_chars": F.coalesce(size, F.col("doc.n_chars"))}
    return masked.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


@_stage
def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole time.

    They come in the mix's order, from file to file and within each: any first part
    of them is close to the weights. Only where a source's target ends within a
    document is a share rounded. Documents without words stay once, at the end:
    they take nothing from any target.
    """
    numbered = _numbered(docs, "text", "source")
    words = F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("bigint")
    mixed, _ = mix_sources(numbered.select("row", "source", words.alias("size")), "row", "source", "size", WEIGHTS)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    counted = mixed.select(F.col("key").alias("row"), times.alias("times"), "positions").filter("times > 0")
    repeated = numbered.select("doc", "row").join(counted, "row")
    # The times beyond the passes that reach a document (its share was rounded up) go last.
    late = F.lit((1 << 63) - 1)
    rows = repeated.withColumn("time", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    rows = rows.select("doc", F.coalesce(F.get("positions", F.col("time")), late).alias("position"))
    return rows.repartitionByRange("position").sortWithinPartitions("position").select("doc.*")


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 4096 tokens."""
    import public_tokenizers

    return pack_documents(docs.select("doc_id", "text"), "text", public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mix", mix_to_weights),
    ("pack", pack),
]
for _stage_name, _function in STAGES:
    _function.stage = _stage_name

#: The fits, fingerprints and token ids of the stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over the written rows of the one before."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = scratch_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        discard(spark, before)
        docs, before = spark.read.parquet(path), [path]
    return docs
