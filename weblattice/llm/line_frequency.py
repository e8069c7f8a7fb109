"""Quality rules with line frequencies across documents.

A line that stands in too many distinct documents of one host is boilerplate. Lines are compared by the hash of their normal form
(lower case, runs of white space as one space, trimmed). Copies of one text count as one document, so that a page captured a
thousand times does not outlaw its own lines. Boilerplate is removed, and a document of which little is left is rejected.

A null text has no words and fails the base rule; a null host is a host of its own (the empty name). Rows that repeat a ``doc_id``
are judged one by one, by their own text and host. Ties cannot arise: limits compare counts. Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblattice.llm import common

#: Characters that count as symbols, and the length of a window of repeated words.
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    max_repeat_percent: int = 30
    #: A line may stand in so many distinct documents of its host, and in so many percent of them.
    line_documents: int = 20
    line_percent: int = 5
    #: A document keeps its place if so many percent of its words are left.
    left_percent: int = 30


LIMITS = Limits()


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, source, text_key`` and the five counts of every row.

    Repeated windows: hashes of 1, 2, 4, then 8 words are built by doubling. Only where two of the last kind are equal are the
    positions sorted; the words covered are then the sum of the gaps between repeated starts, cut at the window's length.
    """
    text = common.whole_text()
    df = docs.select(
        F.col("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.xxhash64(text).alias("text_key"),
        F.length(F.translate(text, common.WHITE_CHARS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, common.WHITE), lambda x: x != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, common.WHITE_CHARS, "")) > 0).alias("lines"))
    df = df.select(
        "doc_id", "source", "text_key", "word_chars", "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("h"))
    reach = 1
    while reach < WINDOW:
        rest = F.greatest(F.size("h") - reach, F.lit(0))
        df = df.withColumn("h", F.zip_with(F.slice("h", 1, rest), F.slice("h", F.lit(1 + reach), rest), lambda a, b: F.xxhash64(a, b)))
        reach *= 2
    df = df.withColumn("sorted", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    df = df.withColumn("starts", F.expr(
        "sort_array(array_compact(transform(sorted, (x, i) -> if("
        "(i > 0 and get(sorted, i - 1).h = x.h) or get(sorted, i + 1).h = x.h, x.p, null))))"))
    covered = F.expr(
        f"aggregate(transform(starts, (p, i) -> least({WINDOW}L, coalesce(get(starts, i + 1), p + {WINDOW}) - p)),"
        " 0L, (a, x) -> a + x)")
    return df.select("doc_id", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def base_failed(limits: Limits = LIMITS) -> Column:
    return (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))


def lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, text_key, pos, line_key, words)``: every line with a word."""
    text = common.whole_text()
    exploded = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.xxhash64(text).alias("text_key"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    plain = F.trim(F.regexp_replace(F.lower("line"), common.WHITE, " "))
    exploded = exploded.withColumn("line", plain).where("line <> ''")
    return exploded.select(
        "doc_id", "source", "text_key", "pos", F.xxhash64("line").alias("line_key"),
        (F.length("line") - F.length(F.translate("line", " ", "")) + 1).alias("words"))


def boilerplate(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """``(source, line_key)`` of the lines above the limits of their host.

    Lines are made distinct per document text before they are counted, in map tasks first: a line of all documents is then one row
    for each text, spread over all tasks, and its count is summed in map tasks again.
    """
    per_text = lines(docs).groupBy("source", "line_key", "text_key").agg(F.lit(1).alias("one"))
    counted = per_text.groupBy("source", "line_key").agg(F.count("*").alias("documents"))
    texts = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.xxhash64(common.whole_text()).alias("text_key"))
    hosts = texts.groupBy("source", "text_key").agg(F.lit(1).alias("one")).groupBy("source").agg(F.count("*").alias("texts"))
    frequent = counted.where(F.col("documents") > limits.line_documents)
    return frequent.join(hosts, "source").where(
        100 * F.col("documents") > limits.line_percent * F.col("texts")).select("source", "line_key")


def judged(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Every row of ``docs`` with its counts, ``n_removed_words``, ``base_failed`` and ``kept``."""
    frequent = common.written(boilerplate(docs, limits), "line-frequency")
    # By position first: rows that repeat an id and a text are then one.
    removed = (
        lines(docs).join(frequent, ["source", "line_key"])
        .groupBy("doc_id", "source", "text_key", "pos").agg(F.first("words").alias("words"))
        .groupBy("doc_id", "source", "text_key").agg(F.sum("words").alias("n_removed_words")))
    joined = base_counts(docs).alias("b").join(
        removed.alias("r"),
        F.col("b.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("b.source") == F.col("r.source")) & (F.col("b.text_key") == F.col("r.text_key")),
        "left").select("b.*", F.coalesce("r.n_removed_words", F.lit(0)).cast("bigint").alias("n_removed_words"))
    left = 100 * (F.col("n_words") - F.col("n_removed_words")) < limits.left_percent * F.col("n_words")
    return joined.withColumn("base_failed", base_failed(limits)).withColumn("kept", ~F.col("base_failed") & ~left)


def without_boilerplate(docs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The kept documents with their boilerplate lines taken out of ``text``; all columns stay.

    A row is known by id, host and text: rows without an id stay, and of rows that repeat one each has its own verdict and lines.
    """
    frequent = common.written(boilerplate(docs, limits), "line-frequency")
    row = ("doc_id", "source", "text_key")
    hits = lines(docs).join(frequent, ["source", "line_key"]).groupBy(*row).agg(F.collect_set("line_key").alias("__lines"))
    text = common.whole_text()
    keyed = docs.withColumn("__source", F.coalesce(F.col("source").cast("string"), F.lit(""))).withColumn("__key", F.xxhash64(text))

    def same(right: DataFrame) -> Column:
        return keyed["doc_id"].eqNullSafe(right["__id"]) & (keyed["__source"] == right["__host"]) & (keyed["__key"] == right["__text"])

    names = {"doc_id": "__id", "source": "__host", "text_key": "__text"}
    kept = judged(docs, limits).where("kept").select(*row).distinct().withColumnsRenamed(names)
    hits = hits.withColumnsRenamed(names)
    plain = lambda x: F.xxhash64(F.trim(F.regexp_replace(F.lower(x), common.WHITE, " ")))
    cut = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("__lines"), plain(x))), "\n")
    return keyed.join(kept, same(kept), "left_semi").join(hits, same(hits), "left").withColumn(
        "text", F.when(F.col("__lines").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)
