"""Token counts from an exact length histogram.

Documents are aggregated by encoded length; suffix sums over the distinct lengths then answer
totals, quantiles and truncated totals for every context limit without another look at the
documents. The histogram has one row per distinct length, however many documents there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize
from .tokens import token_lengths, tokenizer_path

BLOCK = 1024


def length_histogram(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text") -> DataFrame:
    """(length, docs): number of documents of each encoded length; null and empty texts have length 0."""
    counted = token_lengths(docs, tokenizer or tokenizer_path("byte_bpe_50k.json"), text_col, "length")
    return counted.groupBy("length").agg(F.count("*").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Each distinct length with the documents and tokens at or above it, and what it means as a limit.

    Columns: length, docs, docs_from (documents at least this long), tokens_from (their tokens),
    total_docs, total_tokens, kept_tokens (tokens left if every document is cut to this length),
    docs_upto (documents at most this long). Sums run over blocks of BLOCK lengths and then over
    the blocks, so no window holds more than BLOCK rows or one row a block.
    """
    rows = histogram.select("length", "docs", F.expr(f"length div {BLOCK}").alias("block"))
    per = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(F.col("length") * F.col("docs")).alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    per = per.select(
        "block",
        F.coalesce(F.sum("d").over(later), zero).alias("later_docs"),
        F.coalesce(F.sum("t").over(later), zero).alias("later_tokens"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("t").over(whole).alias("total_tokens"),
    )
    here = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(per, "block").select(
        "length",
        "docs",
        (F.col("later_docs") + F.sum("docs").over(here)).alias("docs_from"),
        (F.col("later_tokens") + F.sum(F.col("length") * F.col("docs")).over(here)).alias("tokens_from"),
        "total_docs",
        "total_tokens",
    )
    return out.withColumns(
        {
            "kept_tokens": F.col("total_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from"),
            "docs_upto": F.col("total_docs") - F.col("docs_from") + F.col("docs"),
        }
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """One row per context limit: docs_cut, kept_tokens and lost_tokens if documents are cut to it.

    Between two distinct lengths the answers are linear in the limit, so the next length above
    answers for it; beyond the longest document nothing is cut.
    """
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in sorted(set(limits))], "context_limit bigint")
    above = sums.where("docs > 0").join(F.broadcast(asked), F.col("length") > F.col("context_limit"))
    next_up = above.groupBy("context_limit").agg(F.min_by(F.struct("docs_from", "tokens_from"), "length").alias("x"))
    total = sums.agg(F.coalesce(F.max("total_docs"), F.lit(0)).alias("total_docs"), F.coalesce(F.max("total_tokens"), F.lit(0)).alias("total_tokens"))
    none = F.lit(0).cast("bigint")
    cut, beyond = F.coalesce("x.docs_from", none), F.coalesce("x.tokens_from", none)
    return asked.join(F.broadcast(next_up), "context_limit", "left").join(F.broadcast(total)).select(
        "context_limit",
        cut.alias("docs_cut"),
        (F.col("total_tokens") - beyond + F.col("context_limit") * cut).alias("kept_tokens"),
        (beyond - F.col("context_limit") * cut).alias("lost_tokens"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least this share of all documents does not exceed."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(float(x),) for x in sorted(set(shares))], "share double")
    return sums.join(F.broadcast(asked), F.col("docs_upto") >= F.col("share") * F.col("total_docs")).groupBy("share").agg(F.min("length").alias("length"))


def token_report(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text") -> DataFrame:
    """suffix_sums of docs with the share of documents up to each length and lost_tokens at that limit.

    Null, empty and repeated texts all count as documents (of length 0 where there is no text);
    any length of text is encoded whole. An empty table gives no rows. Only the text column is
    read. The histogram is written once, since the sums read it twice and the texts are to be
    encoded once.
    """
    sums = suffix_sums(materialize(length_histogram(docs, tokenizer, text_col), "lengths"))
    return sums.withColumns(
        {"share_upto": F.round(F.col("docs_upto") / F.col("total_docs"), 9), "lost_tokens": F.col("total_tokens") - F.col("kept_tokens")}
    )
