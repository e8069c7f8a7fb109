"""Full-text index of pages: positions, frequencies, document lengths, vocabulary.

A stored index grows by segments. Whoever writes a segment also merges: runs of segments are kept at least twice as long as the next, like the
digits of a binary counter, so after n segments at most log2(n) + 1 runs are live, and a row is rewritten log2(n) times at most. A run keeps the range of its
urls; only runs whose ranges overlap can replace each other's pages.

Beside its postings a segment keeps what it changes in the document frequency of each term: its own documents less those it replaces. These
numbers add up, so a merge sums them and a reader does too, and neither looks at postings.

Postings are many times their pages, so they are not shuffled where it can be helped: a segment deals its pages to tasks, and a task sorts the
postings of its share into a file; a merge takes the rows of long runs over in the order they lie in.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from weblattice import schemas
from weblattice.functions.porter import with_stem
from weblattice.functions.text import text_tokens
from weblattice.functions.words import repeat_runs, run_length, run_token
from weblattice.operators.visited import latest_pages
from weblattice.runtime import materialize, new_folder
from weblattice.sources.manifest import Manifest, Part, commit, newest
from weblattice.sources.snapshots import folders, remove, versions, write_once

_FREQUENCIES = "term string, url string, n_tokens int, frequency int"
_VOCABULARY = "term string, stem string"
_SIZES = "n_docs bigint, avg_tokens double, n_tokens bigint"
_RANGE = "lo string, hi string"
_COUNTS = "term string, n_docs bigint"

# Tokens whose postings a task sorts in memory.
TOKENS_A_TASK = 2_000_000
# A smaller share than this is not worth a file of its own.
TOKENS_A_FILE = 200_000
# Replaced urls up to this number are broadcast to the rows of a run; beyond it both sides are shuffled.
MOST_REPLACED = 1_000_000


@dataclass(frozen=True)
class TextIndex:
    """One entry per page row, error pages with empty text included.

    ``postings (term, url, field, pos, n_tokens)`` and ``frequencies (term, url, n_tokens, frequency)``
    hold folded, unstemmed terms and carry the document length, so ranking needs no join on documents.
    ``vocabulary (term, stem)`` is present in a stemmed index: stems are matched by looking up the terms
    that share one, so the token stream itself is never joined with the vocabulary.
    """

    documents: DataFrame  # (url, origin_url, depth, n_tokens)
    postings: DataFrame
    frequencies: DataFrame
    vocabulary: DataFrame | None = None
    replaced: DataFrame | None = None  # (url, _last): urls of later segments of a stored index
    sizes: DataFrame | None = None  # (n_docs, avg_tokens) as stored
    counts: DataFrame | None = None  # (term, n_docs) of each stored run, to be summed
    pages: DataFrame | None = None  # what the index was built from

    def live(self, table: DataFrame) -> DataFrame:
        """A table of the index, or hits taken from one, without what a later segment replaced."""
        if self.replaced is None:
            return table.drop("segment")
        later = self.replaced.withColumnRenamed("url", "_url")
        return table.join(later, (F.col("url") == F.col("_url")) & (F.col("segment") < F.col("_last")), "left_anti").drop("segment")


def build_text_index(pages: DataFrame, stem: bool = True) -> TextIndex:
    """Index ``pages (url, origin_url, depth, title, content)``; all but the vocabulary is map-only."""
    title, content = (text_tokens(F.coalesce(name, F.lit(""))) for name in ("title", "content"))
    # Projections stay apart, so each text is tokenised once per table.
    split = pages.select("url", "origin_url", "depth", title.alias("_title"), content.alias("_content"))
    tokens = split.select(
        "url", "origin_url", "depth", F.size("_title").alias("_n_title"), F.concat("_title", "_content").alias("_tokens")
    )
    sized = tokens.select("*", F.size("_tokens").alias("n_tokens"))
    documents = sized.select("url", "origin_url", "depth", "n_tokens")
    in_title = F.col("_at") < F.col("_n_title")
    postings = sized.select("url", "n_tokens", "_n_title", F.posexplode("_tokens").alias("_at", "term")).select(
        "term", "url",
        F.when(in_title, "title").otherwise("content").alias("field"),
        F.when(in_title, F.col("_at")).otherwise(F.col("_at") - F.col("_n_title")).alias("pos"),
        "n_tokens",
    )
    frequencies = (
        sized.select("url", "n_tokens", F.explode(repeat_runs(F.col("_tokens"))).alias("_run"))
        .withColumn("term", run_token(F.col("_run")))
        .select("term", "url", "n_tokens", run_length(F.col("_run"), F.col("term")).alias("frequency"))
    )
    vocabulary = with_stem(frequencies.select("term").distinct()) if stem else None
    return TextIndex(documents, postings, frequencies, vocabulary, pages=pages)


def save_text_index(index: TextIndex, root: str, segment: int = 0) -> TextIndex:
    """Write the index as a segment of ``root``, merge runs that are due, and return the stored form.

    Tables are sorted by term so that a term filter skips row groups. The postings of a stemmed index carry their stem and are
    sorted by it, so a stem or the prefix of one is a filter that reaches the scan.

    Of an index built from pages the pages are shuffled, in shares whose postings a task can sort; each file is sorted by itself. Other tables and
    postings with stems are shuffled by term; there the rebalance hint has adaptive execution cut the partition of a term that is in most
    documents into files of normal size. The size of the corpus is the last table; then the manifest names the segment, and with that it counts. A segment that is complete is left as it is, so a replayed batch takes no file from a reader.
    """
    spark, stem = index.documents.sparkSession, index.vocabulary is not None
    if segment not in versions(spark, f"{root}/sizes"):
        before = load_text_index(spark, root, stem, below=segment)
        part = f"segment={segment}"
        _write_tables(index, root, part)
        new = _table(spark, root, "documents", schemas.TEXT_DOCUMENTS, [part]).drop("segment")
        added = _counted(_table(spark, root, "frequencies", _FREQUENCIES, [part]))
        folder = new_folder(spark, "replaced-urls")
        _write_counts(added.unionByName(_gone(before, new, folder)), root, part)
        remove(spark, folder)
        write_once(_measured(new) if before.sizes is None else _grown(before, new), f"{root}/sizes/version={segment}")
    part = Part(segment, segment, _part((segment, segment)))
    commit(spark, root, lambda m: m.with_part(part), lambda: _found(spark, root))
    merge_segments(spark, root, stem)
    return load_text_index(spark, root, stem)


def _measured(documents: DataFrame) -> DataFrame:
    return documents.agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("n_tokens").alias("avg_tokens"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))


def _grown(before: TextIndex, new: DataFrame) -> DataFrame:
    """The size of the whole index: what it had, less the pages that are replaced, and the new ones. Of the old index, only documents of new urls are looked at."""
    gone = _measured(before.live(before.documents.join(new.select("url"), "url", "left_semi")))
    sizes = before.sizes.select("n_docs", "n_tokens").unionByName(_measured(new).select("n_docs", "n_tokens")).unionByName(
        gone.select((-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
    total = sizes.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return total.select("n_docs", F.try_divide("n_tokens", "n_docs").alias("avg_tokens"), "n_tokens")


def _counted(frequencies: DataFrame) -> DataFrame:
    return frequencies.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))


def _gone(before: TextIndex, new: DataFrame, folder: str) -> DataFrame:
    """What the documents that are replaced no longer count for. Frequencies of old runs are read only if there are such documents."""
    spark = new.sparkSession
    replaced = before.live(before.documents.join(new.select("url"), "url", "left_semi")).select("url").distinct()
    replaced, n = _written(replaced, folder)
    if not n:
        return spark.createDataFrame([], _COUNTS)
    old = before.live(before.frequencies.join(replaced, "url", "left_semi"))
    return _counted(old).select("term", (-F.col("n_docs")).alias("n_docs"))


def _written(urls: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """Urls written out, for a join with the rows of a run, and their number. Up to ``MOST_REPLACED`` they are broadcast, so that the run is not shuffled."""
    urls = materialize(urls, folder)
    n = urls.count()
    return (F.broadcast(urls) if n <= MOST_REPLACED else urls), n


def _write_counts(changes: DataFrame, root: str, part: str) -> None:
    summed = changes.groupBy("term").agg(F.sum("n_docs").alias("n_docs")).filter("n_docs <> 0")
    summed.sortWithinPartitions("term").write.mode("overwrite").parquet(f"{root}/counts/{part}")


def _write_tables(index: TextIndex, root: str, part: str) -> None:
    spark = index.documents.sparkSession

    def write(table: DataFrame, name: str) -> None:
        table.write.mode("overwrite").parquet(f"{root}/{name}/{part}")

    def by_term(table: DataFrame, key: str) -> DataFrame:
        return table.hint("rebalance", key).sortWithinPartitions(key, "url")

    write(index.documents, "documents")
    documents = spark.read.schema(schemas.TEXT_DOCUMENTS).parquet(f"{root}/documents/{part}")
    if index.vocabulary is not None:
        write(index.vocabulary.sortWithinPartitions("stem"), "vocabulary")
    dealt = None if index.pages is None else build_text_index(_dealt(index.pages, documents), stem=False)
    if index.vocabulary is not None:
        vocabulary = spark.read.schema(_VOCABULARY).parquet(f"{root}/vocabulary/{part}")
        postings = index.postings.drop("stem")
        write(by_term(postings.join(vocabulary, "term").select(*postings.columns, "stem"), "stem"), "postings")
    else:
        write(by_term(index.postings, "term") if dealt is None else dealt.postings.sortWithinPartitions("term", "url"), "postings")
    write(by_term(index.frequencies, "term") if dealt is None else dealt.frequencies.sortWithinPartitions("term", "url"), "frequencies")
    _write_range(documents, root, part)


def _write_range(documents: DataFrame, root: str, part: str) -> None:
    documents.agg(F.min("url").alias("lo"), F.max("url").alias("hi")).write.mode("overwrite").parquet(f"{root}/ranges/{part}")


def _dealt(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """The pages in even shares of ``TOKENS_A_TASK`` tokens at most; a short corpus is dealt to all cores, in shares worth a file."""
    tokens, cores = _tokens(documents), pages.sparkSession.sparkContext.defaultParallelism
    return pages.repartition(max(1, -(-tokens // TOKENS_A_TASK), min(cores, -(-tokens // TOKENS_A_FILE))))


def _tokens(documents: DataFrame) -> int:
    return documents.agg(F.sum("n_tokens")).first()[0] or 0


def _table(spark: SparkSession, root: str, name: str, schema: str, parts: list[str], segment: int = 0) -> DataFrame:
    """Parts of a table with the ``segment`` that they end with."""
    if not parts:
        return spark.createDataFrame([], f"{schema}, segment int")
    return spark.read.schema(schema).parquet(*[f"{root}/{name}/{part}" for part in parts]).withColumn("segment", F.lit(segment))


def live_runs(spark: SparkSession, root: str, below: int | None = None) -> list[tuple[int, int]]:
    """``(first, last)`` segments of the runs that a reader takes, oldest first, as the newest manifest names them."""
    parts = (newest(spark, root) or _found(spark, root)).parts()
    return [(part.first, part.last) for part in parts if below is None or part.last < below]


def _found(spark: SparkSession, root: str) -> Manifest:
    """What an index without a manifest holds: of the runs that end at a segment, the longest."""
    done = versions(spark, f"{root}/sizes")
    runs: dict[int, int] = {}
    for name in folders(spark, f"{root}/runs/*/_SUCCESS"):
        first, last = map(int, name.split("-"))
        runs[last] = min(first, runs.get(last, first))
    live = []
    while done:
        run = runs.get(done[-1], done[-1]), done[-1]
        live.append(Part(*run, _part(run)))
        done = [n for n in done if n < run[0]]
    return Manifest().with_parts("", tuple(live))


def _part(run: tuple[int, int]) -> str:
    first, last = run
    return f"segment={last}" if first == last else f"run-{first}-{last}/segment={last}"


def load_text_index(spark: SparkSession, root: str, stem: bool = True, below: int | None = None) -> TextIndex:
    """The stored index as of its last complete segment.

    Nothing of the old runs is rewritten when a page is replaced: a hit is dropped if a later run holds its url (``TextIndex.live``).
    """
    return _load(spark, root, stem, live_runs(spark, root, below))


def load_parts(spark: SparkSession, root: str, parts: tuple[Part, ...], stem: bool = True) -> TextIndex:
    """The stored index as a manifest names it, whatever was added or merged since."""
    return _load(spark, root, stem, [(part.first, part.last) for part in parts])


def _load(spark: SparkSession, root: str, stem: bool, runs: list[tuple[int, int]]) -> TextIndex:
    def table(name: str, schema: str) -> DataFrame:
        parts = [(last, _table(spark, root, name, schema, [_part((first, last))], last)) for first, last in runs]
        return reduce(DataFrame.unionByName, [part for _, part in parts]) if parts else _table(spark, root, name, schema, [])

    documents = table("documents", schemas.TEXT_DOCUMENTS)
    vocabulary = table("vocabulary", _VOCABULARY).drop("segment") if stem else None
    return TextIndex(
        documents, table("postings", schemas.TEXT_POSTINGS + (", stem string" if stem else "")), table("frequencies", _FREQUENCIES),
        vocabulary.distinct() if stem and len(runs) > 1 else vocabulary, _replaced(documents, table("ranges", _RANGE)) if len(runs) > 1 else None,
        spark.read.schema(_SIZES).parquet(f"{root}/sizes/version={runs[-1][1]}") if runs else None, table("counts", _COUNTS).drop("segment"),
    )


def _replaced(documents: DataFrame, ranges: DataFrame) -> DataFrame | None:
    """``(url, _last)``: the last run that holds a url, of urls that lie in the range of an earlier run; None if no ranges overlap."""
    rows = sorted((r["segment"], r["lo"], r["hi"]) for r in ranges.collect() if r["lo"] is not None)  # a row for each live run
    wanted = []
    for i, (segment, lo, hi) in enumerate(rows):
        earlier = [(max(lo, a), min(hi, b)) for _, a, b in rows[:i] if a <= hi and lo <= b]
        if earlier:
            wanted.append((F.col("segment") == segment) & F.col("url").between(min(a for a, _ in earlier), max(b for _, b in earlier)))
    if not wanted:
        return None
    return documents.filter(reduce(or_, wanted)).groupBy("url").agg(F.max("segment").alias("_last"))


def merge_segments(spark: SparkSession, root: str, stem: bool = True) -> None:
    """Merge the newest runs, as many as are due, into one, beside running readers: each run is to be at least twice as long as the next.

    Called by each writer. A merge that was lost does not count, and the next writer makes up for it.
    """
    runs, done = live_runs(spark, root), versions(spark, f"{root}/sizes")
    lengths = [sum(first <= n <= last for n in done) for first, last in runs]
    due = 1
    while due < len(runs) and lengths[-due - 1] < 2 * sum(lengths[-due:]):
        due += 1
    if due > 1:
        _merge(spark, root, stem, runs[-due:])


def _merge(spark: SparkSession, root: str, stem: bool, runs: list[tuple[int, int]]) -> None:
    index, first, last = _load(spark, root, stem, runs), runs[0][0], runs[-1][1]
    part, folder = _part((first, last)), new_folder(spark, "replaced-urls")
    in_order = _tokens(index.documents) > TOKENS_A_TASK
    if index.replaced is not None:
        replaced, n = _written(index.replaced, folder)
        index, in_order = replace(index, replaced=replaced), in_order and n <= MOST_REPLACED  # a shuffled join loses the order

    def live(table: DataFrame) -> DataFrame:
        """Nothing replaces the newest run, so it takes no part in the join."""
        newest_run = F.col("segment") == last
        return index.live(table.filter(~newest_run)).unionByName(table.filter(newest_run).drop("segment"))

    if in_order:
        tables = {name: live(getattr(index, name)) for name in ("documents", "postings", "frequencies")}
        if index.vocabulary is not None:
            tables["vocabulary"] = index.vocabulary.sortWithinPartitions("stem")
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{root}/{name}/{part}")
        _write_range(spark.read.schema(schemas.TEXT_DOCUMENTS).parquet(f"{root}/documents/{part}"), root, part)
    else:
        _write_tables(TextIndex(live(index.documents), live(index.postings.drop("stem")), live(index.frequencies), index.vocabulary), root, part)
    remove(spark, folder)
    _write_counts(index.counts, root, part)
    write_once(spark.createDataFrame([(first, last)], "first int, last int"), f"{root}/runs/{first}-{last}")
    old = tuple(Part(*run, _part(run)) for run in runs)
    commit(spark, root, lambda m: m.merged(old, Part(first, last, part)), lambda: _found(spark, root))


def add_to_text_index(spark: SparkSession, root: str, pages: DataFrame, stem: bool = True, segment: int | None = None) -> TextIndex:
    """Store the entries of the pages as the next segment of the index at ``root`` (or a given one, as a stream batch does).

    A page replaces an older entry of its url; of a url that the pages repeat, the latest counts, as in ``replace_pages``.
    """
    if segment is None:
        segment = max(versions(spark, f"{root}/sizes"), default=-1) + 1
    folder = new_folder(spark, "latest-pages")
    latest = materialize(_one_per_url(pages).select("url", "origin_url", "depth", "title", "content"), folder)  # read once for each table
    index = save_text_index(build_text_index(latest, stem), root, segment)
    remove(spark, folder)
    return index


def compact_text_index(spark: SparkSession, root: str, stem: bool = True) -> int | None:
    """Merge all runs into one, beside running readers, and return the number of its last segment; None if there is but one."""
    runs = live_runs(spark, root)
    if len(runs) < 2:
        return None
    _merge(spark, root, stem, runs)
    return runs[-1][1]


def drop_covered(spark: SparkSession, root: str) -> int:
    """Delete what merged runs have replaced, once no reader from before the last merge is left; returns how many runs and segments went."""
    live = {_part(run) for run in live_runs(spark, root)}
    done = [(n, n) for n in versions(spark, f"{root}/sizes")]
    runs = [tuple(map(int, name.split("-"))) for name in folders(spark, f"{root}/runs/*/_SUCCESS")]
    old = [run for run in done + runs if _part(run) not in live]
    for run in old:
        if run[0] < run[1]:
            remove(spark, f"{root}/runs/{run[0]}-{run[1]}")  # first, so that no reader takes the run
        for name in ("documents", "postings", "frequencies", "vocabulary", "ranges", "counts"):
            remove(spark, f"{root}/{name}/{_part(run).split('/')[0]}")
    return len(old)


def _one_per_url(pages: DataFrame) -> DataFrame:
    # Without a time, nothing tells repeats of a url apart but their content.
    return latest_pages(pages) if "fetched_at" in pages.columns else latest_pages(pages.withColumn("fetched_at", F.lit(0))).drop("fetched_at")


def replace_pages(index: TextIndex, pages: DataFrame) -> TextIndex:
    """The index with the entries of the given pages replaced: one entry per url, of the latest ``fetched_at`` if pages repeat a url."""
    pages = _one_per_url(pages)
    changed = pages.select("url").distinct()
    fresh = build_text_index(pages, stem=index.vocabulary is not None)

    def swap(old: DataFrame, new: DataFrame) -> DataFrame:
        return index.live(old).join(changed, "url", "left_anti").unionByName(new)

    vocabulary = None
    if index.vocabulary is not None:
        # Terms that only replaced pages had may stay: without postings they match nothing.
        vocabulary = index.vocabulary.unionByName(fresh.vocabulary).distinct()
    return TextIndex(
        swap(index.documents, fresh.documents), swap(index.postings.drop("stem"), fresh.postings),
        swap(index.frequencies, fresh.frequencies), vocabulary,
    )


def stemmed_postings(index: TextIndex) -> DataFrame:
    """Positional postings with stems in place of terms, as a table of its own."""
    return index.live(index.postings).drop("stem").join(index.vocabulary, "term").withColumn("term", F.col("stem")).drop("stem")


def corpus_stats(index: TextIndex) -> DataFrame:
    """One row ``(n_docs, avg_tokens)``; every row counts, error pages too. A stored index has it written down."""
    return (index.sizes if index.sizes is not None else _measured(index.live(index.documents))).select("n_docs", "avg_tokens")


def document_frequency(index: TextIndex) -> DataFrame:
    """``(term, n_docs)``; frequencies hold a term once per document. A stored index has them written down by run."""
    if index.counts is None:
        return _counted(index.live(index.frequencies))
    return index.counts.groupBy("term").agg(F.sum("n_docs").alias("n_docs")).filter("n_docs > 0")
