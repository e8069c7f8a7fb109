"""Line dedup by winnowing: later repeats of runs of lines go.

A line is compared by the hash of its text, trimmed and with runs of white space as one space; lines without a word are skipped
and always stay. Hashes of ``gram`` lines are fingerprinted: of each ``window`` neighbouring grams the smallest is selected (all that tie),
so any run of ``gram + window - 1`` lines that stands in two places has a selected gram in both, at the same place of the run. Selected
grams that occur once are dropped. The others are extended both ways to all runs of that length around them, and a run that occurs at an
earlier place (by ``doc_id``, then by line) is deleted line by line; longer repeats are unions of such runs.

Shorter runs count if they have ``LONG_WORDS`` words or more, as a passage may be a single line; they are few and compared without a selection. A text with
fewer lines than a run is compared as a whole with other such texts, whatever its length.

A null text counts as empty. Rows that repeat ``doc_id`` and text are one place: none is later than the other. A null ``doc_id``
comes first in the order. Other columns play no part and stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblattice import runtime
from weblattice.llm import common

GRAM, WINDOW = 2, 2
#: A run with fewer lines counts from so many words.
LONG_WORDS = 50


def solid_lines(text: Column) -> Column:
    """The lines with a word, in normal form."""
    # Most texts hold single spaces only; the pattern is run over the others.
    odd = text.contains("  ")
    for sign in "\t\x0b\x0c\r":
        odd = odd | text.contains(sign)
    plain = F.when(odd, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(text)
    return F.filter(F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def line_hashes(text: Column) -> Column:
    """The hashes of the lines with a word, in normal form."""
    return F.transform(solid_lines(text), lambda x: F.xxhash64(x))


def run_hashes(hashes: Column, length: int) -> Column:
    """The hash of each run of so many neighbours."""
    count = F.greatest(F.size(hashes) - (length - 1), F.lit(0))
    out = F.slice(hashes, F.lit(1), count)
    for ahead in range(1, length):
        out = F.zip_with(out, F.slice(hashes, F.lit(1 + ahead), count), lambda a, b: F.xxhash64(a, b))
    return out


def selected_runs(docs: DataFrame, gram: int, window: int) -> DataFrame:
    """``(doc_id, text_key, gram, at, runs)`` of the selected grams; ``runs`` are the hashes of the runs around it, with their starts."""
    run = gram + window - 1
    df = docs.select("doc_id", F.xxhash64(common.whole_text()).alias("text_key"), line_hashes(common.whole_text()).alias("h"))
    df = df.where(F.size("h") >= run).withColumn("grams", run_hashes(F.col("h"), gram)).withColumn("runs", run_hashes(F.col("h"), run))
    least = F.transform("runs", lambda _, i: F.array_min(F.slice("grams", i + 1, F.lit(window))))
    df = df.withColumn("least", least)
    near = lambda i: F.slice("least", F.greatest(i - (window - 1), F.lit(0)) + 1, F.least(i, F.lit(window - 1)) + 1)
    chosen = F.filter(
        F.transform("grams", lambda g, i: F.struct(g.alias("gram"), i.alias("at"), F.array_contains(near(i), g).alias("chosen"))),
        lambda x: x["chosen"])
    df = df.select("doc_id", "text_key", "runs", F.explode(chosen).alias("c"))
    first = F.greatest(F.col("c.at") - (window - 1), F.lit(0))
    around = F.slice("runs", first + 1, F.least(F.lit(window), F.col("c.at") - first + 1))
    return df.select("doc_id", "text_key", F.col("c.gram").alias("gram"), F.transform(
        around, lambda h, i: F.struct(h.alias("run"), (first + i).alias("start"))).alias("around"))


def short_runs(docs: DataFrame, run: int) -> DataFrame:
    """``(doc_id, text_key, run, start, length)`` of runs below ``run`` lines that count: those of many words, and whole texts."""
    words = lambda x: F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    df = docs.select("doc_id", F.xxhash64(common.whole_text()).alias("text_key"), F.transform(
        solid_lines(common.whole_text()), lambda x: F.struct(F.xxhash64(x).alias("h"), words(x).alias("words"))).alias("lines"))
    df = df.where(F.size("lines") > 0).select(
        "doc_id", "text_key", F.col("lines.h").alias("h"), F.col("lines.words").alias("words"))
    # Hashes start with the kind, so runs of different kinds are never equal.
    unit = lambda kind, h, start, length: F.struct(
        F.xxhash64(F.lit(kind), h).alias("run"), start.cast("int").alias("start"), length.cast("int").alias("length"))
    units = [F.when(F.size("h") < run, F.array(unit("text", F.col("h"), F.lit(0), F.size("h")))).otherwise(F.array())]
    for length in range(1, run):
        count = F.greatest(F.size("h") - (length - 1), F.lit(0))
        sums = F.slice("words", F.lit(1), count)
        for ahead in range(1, length):
            sums = F.zip_with(sums, F.slice("words", F.lit(1 + ahead), count), lambda a, b: a + b)
        pairs = F.zip_with(run_hashes(F.col("h"), length), sums, lambda h, n: F.struct(h.alias("h"), n.alias("words")))
        at = F.filter(F.transform(pairs, lambda x, i: F.struct(x["h"].alias("h"), x["words"].alias("words"), i.alias("i"))), lambda x: x["words"] >= LONG_WORDS)
        units.append(F.transform(at, lambda x: unit(f"lines {length}", x["h"], x["i"], F.lit(length))))  # noqa: B023 - called at once
    return df.select("doc_id", "text_key", F.explode(F.concat(*units)).alias("u")).select("doc_id", "text_key", "u.run", "u.start", "u.length")


def later_runs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``(doc_id, text_key, runs)``: start and length of the runs that an earlier place has, counted in lines with a word."""
    fingerprints = common.written(selected_runs(docs, gram, window), "winnowed")
    # Counts are summed in map tasks first, and the joins back are plain: adaptive execution can split a hot fingerprint.
    repeated = common.written(fingerprints.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1").select("gram"), "winnowed-repeats")
    candidates = fingerprints.join(repeated, "gram").select("doc_id", "text_key", F.explode("around").alias("a")).select(
        "doc_id", "text_key", F.col("a.run").alias("run"), F.col("a.start").cast("int").alias("start"), F.lit(gram + window - 1).alias("length"))
    candidates = common.written(candidates.unionByName(short_runs(docs, gram + window - 1)), "winnowed-runs")
    place = F.struct("doc_id", "text_key", "start")
    first = common.written(
        candidates.groupBy("run").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("run", "first"),
        "winnowed-firsts")
    later = candidates.join(first, "run").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("runs"))


def deduplicated(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` without the later repeats in ``text``, and with ``n_lines`` and ``n_removed`` (clashing columns are replaced)."""
    # The texts are shuffled, but not sorted: the marks of a partition's documents are the table to look up.
    marks = later_runs(docs, gram, window).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("runs").alias("__runs")).hint("shuffle_hash")
    df = docs.drop("n_lines", "n_removed").withColumn("__text_key", F.xxhash64(common.whole_text()))
    df = df.join(marks, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left").drop("__id", "__key", "__text_key")
    kept = df.drop("__runs")
    schema = kept.withColumn("n_lines", F.lit(0).cast("bigint")).withColumn("n_removed", F.lit(0).cast("bigint")).schema

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("__runs"), strict=True):
                text = text.as_py()
                sizes.append((text or "").count("\n") + 1)
                gone: set[int] = set()
                if runs.is_valid:
                    lines = text.split("\n")
                    solid = [i for i, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
                    for run in runs.as_py():
                        gone.update(solid[run["start"]:run["start"] + run["length"]])
                    text = "\n".join([line for i, line in enumerate(lines) if i not in gone])
                texts.append(text)
                removed.append(len(gone))
            columns = [pa.array(texts, f.type) if f.name == "text" else batch.column(f.name) for f in batch.schema if f.name != "__runs"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())],
                names=[*(f.name for f in batch.schema if f.name != "__runs"), "n_lines", "n_removed"])

    return df.mapInArrow(cut, schema)


runtime.ship_by_value(__name__)
