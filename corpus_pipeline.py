"""From raw documents to token files, in five stages.

Documents of low quality go; of similar documents one stays; documents with
passages of the benchmark go; sources are mixed to target weights, which repeats
some documents; the ids of all that is left are written and read back.

Every stage takes a table with the columns of ``documents``, and any others,
whatever their names, and all but the last return the same columns. Null and
empty texts go through every stage; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import quality_crf
from orderloom.llm.decontamination import contamination
from orderloom.llm.jaccard_join import one_of_each
from orderloom.llm.mixing import mix
from orderloom.llm.queries import END_ID, TOKENIZER, held_out, table
from orderloom.llm.token_codes import token_table
from orderloom.scratch import new_scratch, written

_OWN = ("doc_id", "text", "source")

#: Rows that go to Python at once. Whole texts of a batch are in the memory of the JVM and
#: of a worker at the same time; 10,000 rows, as is usual for numbers, are tens of megabytes.
_BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def _apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``work`` while other columns have names that no operator uses."""
    docs.sparkSession.conf.set(*_BATCH_ROWS)
    names = docs.columns
    safe = [c if c in _OWN else f"_column_{i}" for i, c in enumerate(names)]
    return work(docs.toDF(*safe)).select(*safe).toDF(*names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    spark.conf.set(*_BATCH_ROWS)
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"), ~held_out(4))
    return _apart(docs, lambda d: quality_crf.rate(d, model, d.columns).where("predicted = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return _apart(docs, one_of_each)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _apart(docs, lambda d: contamination(d, benchmark, keep=d.columns).where(~F.col("contaminated")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""

    def taken(d: DataFrame) -> DataFrame:
        mixed = mix(d, keep=d.columns)
        return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))

    return _apart(docs, taken)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, as the files hold them."""
    spark.conf.set(*_BATCH_ROWS)
    return token_table(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_ids", token_ids),
]

#: Trained models and a tokenizer are beyond SQL; tests compare the stages with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = new_scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(spark, docs, f"{scratch}/{name}")
    return docs
