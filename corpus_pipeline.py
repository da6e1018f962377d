"""The training-corpus pipeline: quality, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``, of the rows that they keep. Rows with null text are kept by every
filter that has no ground to reject them, and packed as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import decontam, minhash, packing, pii, quality
from voxloom.llm.common import TEXT_ROWS, compact, discard, materialise, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled rows among them, doesn't reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return compact(quality.keep_good(docs, model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of near duplicates."""
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return compact(decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark")), docs.count(), TEXT_ROWS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every found span replaced by its kind; n_chars follows the text."""
    done = pii.redact_pii(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return compact(done.select(*[F.col(f"`{c}`") for c in docs.columns]))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most 2048 ids."""
    return packing.tokenise_and_pack(docs, packing.default_tokenizer(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    written: list[DataFrame] = []
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*written)
        written = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None
