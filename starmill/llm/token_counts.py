"""Exact token counts by the histogram of encoded lengths.

Tasks encode whole texts with a public tokenizer and hand on one row per distinct length; every
answer about totals, quantiles and context limits then comes from suffix sums over the histogram.
The histogram has one row per distinct length, whatever the number of documents. Suffix sums are
taken in two steps, within blocks of ``BLOCK`` lengths and over blocks.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starmill.llm.tables import staged

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_BYTES = 64 << 20  # a larger vocabulary file is refused, as every worker gets it
BLOCK = 1024



@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: bytes, pattern: str):
    """The tokenizer of one worker process, built once."""
    import tiktoken

    pairs = (line.split() for line in vocabulary.splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _lengths(vocabulary, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value, pattern)
        for batch in batches:
            texts = batch.column(0)
            sizes = [len(encoder.encode_ordinary(text.as_py() or "")) for text in texts]
            values, docs = np.unique(np.array(sizes, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(docs.astype(np.int64))], names=["n_tokens", "docs"])

    return run


def histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(n_tokens, docs): how many texts encode to each number of tokens.

    Texts are encoded whole, as ordinary text, without special tokens; null and empty texts have
    length 0; repeated rows count each. The vocabulary is read where the driver runs and sent to
    the workers.
    """
    with open(vocabulary, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"the vocabulary exceeds {MOST_BYTES} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(data)
    counted = docs.select(F.col(f"`{text}`")).mapInArrow(_lengths(shared, pattern), "n_tokens long, docs long")
    return counted.groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def with_suffix_sums(lengths: DataFrame) -> DataFrame:
    """For every length of a histogram:

    ``docs_from`` and ``tokens_from``: texts of at least that length and their tokens; ``truncated``:
    tokens that remain when every text is cut to that length; ``docs_upto``: texts up to that length.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    # both uses of the histogram below read it from a table, so no text is encoded twice
    rows = staged(lengths, "histogram").withColumn("block", block).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    totals = rows.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)  # one row per block
    everything = Window.partitionBy()
    above = totals.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("tokens_above"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    own = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(0, Window.unboundedFollowing)
    docs_from = F.sum("docs").over(own) + F.col("docs_above")
    tokens_from = F.sum("tokens").over(own) + F.col("tokens_above")
    out = rows.join(above, "block").withColumn("docs_from", docs_from).withColumn("tokens_from", tokens_from)
    below = F.col("all_tokens") - F.col("tokens_from")
    return out.select(
        "n_tokens",
        "docs",
        "tokens",
        "docs_from",
        "tokens_from",
        (below + F.col("docs_from") * F.col("n_tokens")).alias("truncated"),
        (F.col("all_docs") - F.col("docs_from") + F.col("docs")).alias("docs_upto"),
        "all_docs",
        "all_tokens",
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Truncated totals for any context limits: (context_limit, docs_over, truncated).

    Between two lengths of the histogram the total grows by one token per longer text, so the first
    length from the limit on answers it; beyond the longest text nothing is cut.
    """
    wanted = sums.sparkSession.createDataFrame([(n,) for n in limits], "context_limit long")
    found = wanted.join(sums, F.col("n_tokens") >= F.col("context_limit"), "left").groupBy("context_limit").agg(
        F.min_by(F.struct("n_tokens", "docs_from", "truncated"), "n_tokens").alias("next")
    )
    total = sums.agg(F.max("all_tokens").alias("all_tokens"))
    cut = F.col("next.truncated") - (F.col("next.n_tokens") - F.col("context_limit")) * F.col("next.docs_from")
    exact = sums.select(F.col("n_tokens").alias("context_limit"), "docs")
    over = F.coalesce(F.col("next.docs_from"), F.lit(0)) - F.coalesce(F.when(F.col("next.n_tokens") == F.col("context_limit"), F.col("docs")), F.lit(0))
    every = found.join(exact, "context_limit", "left").withColumn("one", F.lit(1)).join(total.withColumn("one", F.lit(1)), "one")
    return every.select("context_limit", over.alias("docs_over"), F.coalesce(cut, "all_tokens", F.lit(0)).alias("truncated"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least that share of all texts does not exceed."""
    wanted = sums.sparkSession.createDataFrame([(float(s),) for s in shares], "share double")
    reached = F.col("docs_upto") >= F.col("share") * F.col("all_docs")
    return wanted.join(sums, reached, "left").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
