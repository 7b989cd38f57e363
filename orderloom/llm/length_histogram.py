"""Token counts of a corpus for every context limit, from one exact length histogram.

Documents are counted by encoded length. The sums of longer documents then tell,
for every limit, how many tokens are kept, cut off and padded: between two
lengths that occur all of these are linear, so a row per length answers all.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.batches import Texts, map_texts
from orderloom.llm.words_bpe import lengths
from orderloom.scratch import new_scratch, written

#: Lengths that are summed in one window partition.
_BLOCK = 4096


def document_lengths(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and n_tokens of every row; null or empty text has 0 tokens."""
    return map_texts(
        documents, lambda batch: [pa.array(lengths(Texts.of(batch.column("text")), tokenizer))], "n_tokens bigint"
    )


def length_histogram(documents: DataFrame, tokenizer: str) -> DataFrame:
    """A row per encoded length that occurs, with the totals of a context limit of that length.

    length, n_documents; longer_documents and longer_tokens (strictly longer);
    total_tokens (of all documents); kept_tokens (sum of min(tokens, length)):
    cut_tokens (what the limit cuts off); quantile (share of documents of at
    most this length). An empty table has an empty result.
    """
    histogram = (
        document_lengths(documents, tokenizer)
        .groupBy(F.col("n_tokens").alias("length"))
        .agg(F.count(F.lit(1)).alias("n_documents"))
    )
    # A row per length, needed several times: the texts are encoded once.
    return with_suffix_sums(written(documents.sparkSession, histogram, new_scratch(documents.sparkSession, "lengths")))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """Totals for every length of a histogram (length, n_documents), block by block."""
    rows = histogram.select(
        "*", F.expr(f"length div {_BLOCK}").alias("block"), (F.col("length") * F.col("n_documents")).alias("tokens")
    )
    blocks = rows.groupBy("block").agg(F.sum("n_documents").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later_blocks = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later_blocks), zero).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later_blocks), zero).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("total_tokens"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.select(
        "*",
        F.coalesce(F.sum("n_documents").over(longer), zero).alias("docs_in_block"),
        F.coalesce(F.sum("tokens").over(longer), zero).alias("tokens_in_block"),
    ).join(blocks, "block")
    longer_docs = F.col("later_docs") + F.col("docs_in_block")
    longer_tokens = F.col("later_tokens") + F.col("tokens_in_block")
    cut = longer_tokens - longer_docs * F.col("length")
    return summed.select(
        "length",
        "n_documents",
        longer_docs.alias("longer_documents"),
        longer_tokens.alias("longer_tokens"),
        "total_tokens",
        (F.col("total_tokens") - cut).alias("kept_tokens"),
        cut.alias("cut_tokens"),
        (1 - longer_docs / F.col("all_docs")).alias("quantile"),
    )


def totals_at(histogram: DataFrame, limit: int) -> DataFrame:
    """kept_tokens, cut_tokens and cut_documents of any limit, from the rows of ``length_histogram``."""
    tokens = F.col("length") * F.col("n_documents")
    over = F.greatest(F.col("length") - limit, F.lit(0)) * F.col("n_documents")
    return histogram.agg(
        F.coalesce(F.sum(tokens - over), F.lit(0)).alias("kept_tokens"),
        F.coalesce(F.sum(over), F.lit(0)).alias("cut_tokens"),
        F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_documents"))), F.lit(0)).alias("cut_documents"),
    )
