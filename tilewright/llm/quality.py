"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised and hashed; for each host the distinct texts that hold a line are counted;
lines above the host's limit are removed, and documents that this depletes are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: The options of line_rules that keep it right on hosts of any size: its defaults.
BOUNDED = {"max_docs": 200, "by_group": True}


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def base_measures(docs: DataFrame, text: str) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all bigint) of the column text.

    Windows of five words are compared by 64-bit hashes within one document. All work on a
    document stays in its row, so the text is neither exploded nor shuffled.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("__t", whole).withColumn("__w", _words(F.col("__t"))).withColumn("__l", F.split("__t", "\n"))
    df = df.withColumn("n_words", F.size("__w").cast("bigint")).withColumn("__l", F.filter("__l", lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    windows = F.expr("transform(sequence(1, size(__w) - 4), i -> xxhash64(slice(__w, i, 5)))")
    df = df.withColumn("__h", F.when(F.size("__w") > 5, windows).otherwise(F.array().cast("array<bigint>")))
    twice = F.size(F.array_distinct("__h")) < F.size("__h")
    placed = F.expr("array_sort(transform(__h, (h, i) -> struct(h as h, i as i)))")
    df = df.withColumn("__s", F.when(twice, placed).otherwise(F.expr("array_sort(array(struct(0L as h, 0 as i)))")))
    again = "filter(__s, (x, k) -> (k > 0 and x.h = __s[k - 1].h) or (k < size(__s) - 1 and x.h = __s[k + 1].h))"
    df = df.withColumn("__p", F.expr(f"array_sort(transform({again}, x -> x.i))"))
    covered = F.expr("aggregate(transform(__p, (x, j) -> if(j = 0, 5, least(5, x - __p[j - 1]))), 0L, (a, x) -> a + x)")
    return df.select(
        *docs.columns,
        "n_words",
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _line_hash(line: Column) -> Column:
    """60 bits of the MD5 of a line in lower case with single spaces, trimmed; the same number in any engine."""
    digest = F.md5(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _holders(measured: DataFrame, inside: DataFrame, min_left: float) -> DataFrame:
    """(host, h, docs, n) of the lines in inside, where depleted texts with the same longest line in it are one holder."""
    longest = F.max(F.struct("line_words", "h"))["h"]
    each = inside.groupBy("copy").agg(F.sum("n").alias("gone"), longest.alias("longest"), F.collect_set(F.struct("h", "line_words")).alias("over"))
    depleted = F.col("n_words") - F.col("gone") < min_left * F.col("n_words")
    holder = F.struct(depleted.alias("depleted"), F.when(depleted, F.col("longest")).otherwise(F.col("text_hash")).alias("by"))
    each = measured.select("host", "copy", "text_hash", "n_words").join(each, "copy").select("host", holder.alias("holder"), F.explode("over").alias("line"))
    each = each.select("host", "line.h", "line.line_words", "holder").distinct()
    return each.groupBy("host", "h").agg(F.count("*").alias("docs"), F.max("line_words").alias("n"))


def line_rules(
    docs: DataFrame,
    min_docs: int = 20,
    host_share: float = 0.01,
    min_left: float = 0.3,
    min_words: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int | None = 200,
    max_words: int = 4,
    by_group: bool = True,
) -> DataFrame:
    """One row per row of docs: id, text_hash, the base measures, base_failed, removed_words, removed (line hashes), kept.

    A line is over the limit if more than min_docs distinct texts of its host hold it, and more
    than host_share of the host's distinct texts: exact copies count once, so a group of copies
    does not condemn its own lines. A document is rejected if the base rules fail, or if what
    is left without such lines is under min_words words or under min_left of its words.

    host_share alone loosens as a host grows. With max_docs, a line of max_words words or more
    is over the limit beyond so many texts on a host of any size; shorter lines, which are
    common by themselves, keep the share. None leaves the share alone.

    With by_group, texts that the lines over the limit would leave under min_left of their words
    count once for each longest such line (of those with most words the one whose hash is
    largest), which near copies share. Lines that only copies of one text hold so stay, and
    near-duplicates are left to the operator that keeps one of them. Without it near copies
    count each.

    A null text is empty, has no words and fails. A null host is the host of all rows without
    one. Rows with null ids and repeated rows are judged each; extra columns are ignored; an
    empty table stays empty. Counts per (host, line) are summed before they are shuffled, and
    the texts themselves are read once and never shuffled.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(host_col), F.lit("")).alias("host"),
        F.xxhash64(text_col).alias("text_hash"),
        F.monotonically_increasing_id().alias("copy"),
        F.col(text_col).alias("text"),
    )
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = F.transform(lines, lambda x: F.struct(_line_hash(x).alias("h"), F.size(_words(x)).alias("n")))
    measured = base_measures(rows.withColumn("lines", counted), "text").drop("text")
    measured = materialize(measured, "measured")

    line = measured.select("host", "text_hash", F.explode(F.array_distinct("lines")).alias("line")).select("host", "text_hash", "line.h", "line.n")
    hosts = measured.where("size(lines) > 0").select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))

    def limited(spread: DataFrame) -> DataFrame:
        beyond = F.col("docs") > host_share * F.col("host_docs")
        if max_docs is not None:
            beyond = beyond | ((F.col("docs") > max_docs) & (F.col("n") >= max_words))
        return spread.where(F.col("docs") > min_docs).join(hosts, "host").where(beyond).select("host", "h", F.col("n").alias("line_words"))

    spread = line.distinct().groupBy("host", "h").agg(F.count("*").alias("docs"), F.max("n").alias("n"))
    over = materialize(limited(spread), "over")

    held = measured.select("host", "copy", F.explode("lines").alias("line")).select("host", "copy", F.col("line.h").alias("h"), F.col("line.n").alias("n"))
    held = held.groupBy("host", "copy", "h").agg(F.sum("n").alias("n"))
    inside = held.join(over, ["host", "h"])
    if by_group:
        inside = materialize(inside, "inside")
        over = materialize(limited(_holders(measured, inside, min_left)), "over")
        inside = inside.drop("line_words").join(over, ["host", "h"])
    lost = inside.groupBy("copy").agg(F.sum("n").alias("removed_words"), F.collect_set("h").alias("removed"))
    left = F.col("n_words") - F.col("removed_words")
    judged = measured.join(lost, "copy", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
    return judged.select(
        "id",
        "text_hash",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        "removed_words",
        F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
        (~base_failed() & (left >= min_words) & (left >= min_left * F.col("n_words"))).alias("kept"),
    )


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that line_rules keeps, without the lines over the limit; all other columns as they were.

    Repeated rows stay repeated.
    """
    judged = line_rules(docs, id_col=id_col, text_col=text_col, **options).where("kept")
    judged = materialize(judged.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__removed")).distinct(), "judged")
    found = docs.withColumn("__own", F.xxhash64(text_col)).join(judged, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")))
    stay = F.filter(F.split(text_col, "\n"), lambda x: ~F.array_contains("__removed", _line_hash(x)))
    return found.withColumn(text_col, F.when(F.size("__removed") > 0, F.array_join(stay, "\n")).otherwise(F.col(text_col))).select(*docs.columns)
