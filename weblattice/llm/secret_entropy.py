"""Secret scans: fixed patterns, and the entropy of windows that slide over long strings.

Patterns (``assign``, ``access``, ``hex``) are matched leftmost and without overlap, each kind for itself; matches that are too short
are dropped. A place is found from the pieces between the matches: the lengths of all pieces and matches before it add up to it.

The method adds spans of kind ``entropy``: a candidate is a run of ``[A-Za-z0-9+/_=-]`` that holds a letter and a digit. A window slides over it with an
array of counts, one for each character of that class, and the sum of ``c log2 c`` over the counts: a step takes one from the count of the character that
leaves, adds one to that of the one that enters, and changes the sum by these two. The candidate is reported if the entropy of some window reaches the limit of its class
(hexadecimal, letters and digits, or mixed with signs), unless the allow list knows it: UUIDs, strings in words that mark an example, and candidates that lie
inside one span of a pattern. A candidate that such a span covers in part is reported whole.

Time is linear in the text: long candidates are cut into pieces that overlap by a window, and places and overlaps are running sums and maxima over chunks of
matches (an array that grows by one element is copied each time, so it must not grow far).

A null or empty text has no spans. Rows that repeat a ``doc_id`` are scanned one by one. Places count code points; a tie of starts is
ordered by kind. Other columns play no part.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblattice.llm import common

#: The patterns and the least lengths of what they match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates of the entropy scan, its window, and the least entropy of a window by class of characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Counts that one number holds, and their bits: a count is WINDOW at most.
PACKED, COUNT_BITS = 12, 5
SIGNS = string.ascii_letters + string.digits + "+/_=-"
ENTROPY_HEX, ENTROPY_ALNUM, ENTROPY_MIXED = 3.0, 3.7, 3.9
#: Candidates that are let pass.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|placeholder|xxxxxxxx|changeme",
)


#: Elements of a chunk, places of a candidate's piece, and code points of a text's piece.
CHUNK, PIECE, TEXT_PIECE = 128, 256, 4096
LONGS = "array<bigint>"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, value: Callable[[Column], Column], add: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each item, the values of all items before it, added up: first over whole chunks, then in each chunk."""
    none = F.array().cast(LONGS)
    grow = lambda acc, x: F.struct(add(acc["at"], x).cast("bigint").alias("at"), F.array_append(acc["found"], acc["at"]).alias("found"))
    start = lambda at: F.struct(at.cast("bigint").alias("at"), none.alias("found"))

    def over(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(zero).cast("bigint"), lambda a, x: add(a, value(x)).cast("bigint")))
        before = F.aggregate(totals, start(F.lit(zero)), grow)["found"]
        return F.flatten(F.zip_with(chunks, before, lambda c, at: F.aggregate(c, start(at), lambda acc, x: grow(acc, value(x)))["found"]))

    return bound(items, lambda all_: bound(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")), lambda k: F.slice(all_, k * CHUNK + 1, F.lit(CHUNK))), over))


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """``array<struct<start, end, kind, hit>>`` of all leftmost matches, in order."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:int,hit:string>>")

    def placed(hits: Column) -> Column:
        pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits, lambda p, h: F.struct(
            F.length(p).cast("bigint").alias("gap"), F.length(h).cast("bigint").alias("size"), h.alias("hit")))
        spans = bound(pairs, lambda all_: F.zip_with(
            all_, running(all_, lambda x: x["gap"] + x["size"], lambda a, x: a + x, 0), lambda x, at: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("end"), F.lit(KINDS.index(kind)).alias("kind"), x["hit"].alias("hit"))))
        return F.when(F.size(hits) > 0, spans).otherwise(empty)

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def count_of(counts: Column, x: Column) -> Column:
    """The count of a character, out of numbers that hold ``PACKED`` counts of ``COUNT_BITS`` bits each."""
    return (F.call_function("div", F.element_at(counts, x["slot"]), x["one"]) % (1 << COUNT_BITS)).cast("double")


def piece_entropy(piece: Column) -> Column:
    """The smallest sum of ``c log2 c`` over the counts of a window of the piece, which has a window at least."""
    none = F.lit(0).cast("bigint")

    def slid(codes: Column) -> Column:
        first = F.slice(codes, F.lit(1), F.lit(WINDOW))
        counts = F.transform(F.sequence(F.lit(1), F.lit(-(-len(SIGNS) // PACKED))), lambda slot: F.aggregate(
            first, none, lambda n, x: n + F.when(x["slot"] == slot, x["one"]).otherwise(none)))

        def step(acc: Column, x: Column) -> Column:
            gone, come = count_of(acc["counts"], x["out"]), count_of(acc["counts"], x["in"])
            total = F.when((x["out"]["slot"] == x["in"]["slot"]) & (x["out"]["one"] == x["in"]["one"]), acc["total"]).otherwise(
                acc["total"] - weight(gone) + weight(gone - 1) - weight(come) + weight(come + 1))
            changed = F.transform(acc["counts"], lambda n, i: n - F.when(i + 1 == x["out"]["slot"], x["out"]["one"]).otherwise(none)
                                  + F.when(i + 1 == x["in"]["slot"], x["in"]["one"]).otherwise(none))
            return bound(total, lambda t: F.struct(changed.alias("counts"), t.alias("total"), F.least(acc["best"], t).alias("best")))

        steps = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - WINDOW), F.slice(codes, F.lit(WINDOW + 1), F.size(codes) - WINDOW), lambda a, b: F.struct(
            a.alias("out"), b.alias("in")))
        # Each of c equal characters adds log2(c), which makes c log2(c).
        start = bound(counts, lambda n: bound(F.aggregate(first, F.lit(0.0), lambda a, x: a + F.log2(count_of(n, x))), lambda t: F.struct(
            n.alias("counts"), t.alias("total"), t.alias("best"))))
        return F.aggregate(steps, start, step)["best"]

    place = lambda c: F.instr(F.lit(SIGNS), c) - 1
    letters = F.transform(F.filter(F.split(piece, ""), lambda c: c != ""), place)
    return bound(F.transform(letters, lambda c: F.struct(
        (F.floor(c / PACKED) + 1).cast("int").alias("slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), c % PACKED * COUNT_BITS).alias("one"))), slid)


def best_entropy(candidate: Column) -> Column:
    """The largest entropy of a window of the string, in bits for each character."""

    def over(pieces: Column) -> Column:
        whole = F.transform(pieces, lambda p, i: F.concat(p, F.substring(F.coalesce(F.get(pieces, i + 1), F.lit("")), F.lit(1), F.lit(WINDOW - 1))))
        return F.array_min(F.transform(F.filter(whole, lambda p: F.length(p) >= WINDOW), piece_entropy))

    least = bound(F.regexp_extract_all(candidate, F.lit(f".{{1,{PIECE}}}"), F.lit(0)), over)
    return F.log2(F.lit(float(WINDOW))) - least / WINDOW


def suspicious(candidate: Column) -> Column:
    mixed = candidate.rlike(r"[+/_=-]")
    hexadecimal = candidate.rlike(r"^[0-9a-fA-F]+$")
    limit = F.when(hexadecimal, ENTROPY_HEX).when(mixed, ENTROPY_MIXED).otherwise(ENTROPY_ALNUM)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    return candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]") & ~allowed & (F.round(best_entropy(candidate), 9) >= limit)


def scanned(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``__base`` and ``__all``: arrays of ``(start, end, kind)`` in the order of start and kind."""
    text = common.whole_text()
    triple = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    df = docs.withColumn("__text", text)
    text = F.col("__text")
    value = lambda hit: F.regexp_extract(hit, ASSIGN, 2)
    df = df.withColumn("__base", F.array_sort(F.concat(
        F.transform(F.filter(spans_of(text, ASSIGN, "assign"), lambda s: F.length(value(s["hit"])) >= ASSIGN_VALUE), triple),
        F.transform(spans_of(text, ACCESS, "access"), triple),
        F.transform(spans_of(text, HEX, "hex"), triple))))
    found = F.transform(F.filter(spans_of(text, CANDIDATE, "entropy"), lambda s: suspicious(s["hit"])), triple)
    # In order of start, a candidate lies inside a pattern's span if one of those before it ends no sooner.
    reach = lambda spans: running(spans, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(F.lit(0)), F.greatest, 0)
    inside = lambda spans: F.zip_with(spans, reach(spans), lambda s, far: F.struct(s.alias("span"), ((s["kind"] == 3) & (s["end"] <= far)).alias("known")))
    every = bound(F.array_sort(F.concat("__base", found)), lambda spans: F.transform(F.filter(inside(spans), lambda x: ~x["known"]), lambda x: x["span"]))
    return df.withColumn("__all", F.when(F.size(found) > 0, every).otherwise(F.col("__base"))).drop("__text")


def written_out(spans: Column | str) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(kind: str, spans: str = "__base") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def gap(pieces: Column, begin: Column, end: Column) -> Column:
    """Code points from ``begin`` to ``end`` of a text that is given in pieces of ``TEXT_PIECE``."""
    first, last = (F.floor(x / TEXT_PIECE).cast("int") for x in (begin, end))
    inside = (begin % TEXT_PIECE + 1).cast("int")
    one = F.substring(F.get(pieces, first), inside, (end - begin).cast("int"))
    several = F.concat(
        F.substring(F.get(pieces, first), inside, F.lit(TEXT_PIECE)), F.array_join(F.slice(pieces, first + 2, last - first - 1), ""),
        F.substring(F.coalesce(F.get(pieces, last), F.lit("")), F.lit(1), (end % TEXT_PIECE).cast("int")))
    return F.when(end <= begin, "").when(first == last, one).otherwise(several)


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each span of a secret, overlapping ones as one, replaced by a mark; all rows and columns stay.

    A span that starts where all spans before it have ended begins a run. So a gap of the text goes from the end of the run before to the start of the next.
    """
    df = scanned(docs)

    def cuts(spans: Column) -> Column:
        ends = running(spans, lambda s: s["end"], F.greatest, 0)
        runs = F.filter(F.zip_with(spans, ends, lambda s, far: F.struct(far.alias("begin"), s["start"].alias("end"))), lambda x: x["begin"] <= x["end"])
        last = F.struct(F.array_max(F.transform(spans, lambda s: s["end"])).alias("begin"), F.length("text").cast("bigint").alias("end"))
        return F.array_append(runs, last)

    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{TEXT_PIECE}}}"), F.lit(0))
    clean = bound(pieces, lambda p: F.array_join(F.transform(bound(F.col("__all"), cuts), lambda x: gap(p, x["begin"], x["end"])), mark))
    return df.withColumn("text", F.when(F.size("__all") > 0, clean).otherwise(F.col("text"))).drop("__base", "__all")
