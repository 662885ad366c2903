"""Positions of regular-expression matches as DataFrame expressions (no Python on executors).

All of them take time in proportion to a text's length and its matches, but for a logarithm of
the number of matches: running sums and extremes double their reach step by step, and texts
are cut in pieces of bounded length before anything is taken out of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,rank:int,kind:string,value:string>"
NO_SPANS = f"array<{SPAN}>"
PIECE = 256


def none() -> Column:
    return F.array().cast(NO_SPANS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it.

    Plain aliases won't do: the optimiser would push conditions below them and so copy the
    expressions into every use, one copy inside another.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """The array of ``values[0] merge ... merge values[i]``: element i takes in the one 1, 2, 4, ... before it."""
    reach = lambda v: F.filter(F.array(*[F.lit(1 << j) for j in range(31)]), lambda r: r < F.size(v))

    def step(acc: Column, r: Column) -> Column:
        return F.transform(acc, lambda x, i: F.when(i >= r, merge(x, F.get(acc, i - r))).otherwise(x))

    return let(values, lambda v: F.aggregate(reach(v), v, step))


def span(start: Column, end: Column, rank: int, kind: str, value: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), value.alias("value"))


def find(text: Column, pattern: str, rank: int, kind: str, guard: str | None = None, wanted=None) -> Column:
    """Leftmost non-overlapping matches as spans in code points; ``guard`` is a cheaper necessary pattern.

    Of the matches only those stay for whose text ``wanted`` holds.  The matches and the gaps
    between them, which ``split`` gives, alternate; a match ends where all lengths so far end.
    """

    def spans(hits: Column) -> Column:
        # the gap behind the last match has no match beside it
        steps = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits, lambda gap, hit: F.length(gap) + F.length(hit))
        each = lambda ends: F.transform(hits, lambda h, i: span(F.get(ends, i) - F.length(h), F.get(ends, i), rank, kind, h))
        return let(running(steps, lambda a, b: a + b), each)

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)
    if wanted is not None:
        found = F.filter(found, lambda s: wanted(s["value"]))
    return F.when(text.rlike(guard or pattern), found).otherwise(none())


def outside(spans: Column, base: Column) -> Column:
    """The ``spans`` that overlap none of ``base``, by start.

    In the order of starts, with the base first in ties, a span is hit by a base before it if
    the greatest end so far lies beyond its start, and by one behind it if the next start lies
    before its end.
    """
    far = F.lit(2**31 - 1)
    row = lambda s, own: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s.alias("span"))
    merged = F.sort_array(F.concat(F.transform(base, lambda s: row(s, 0)), F.transform(spans, lambda s: row(s, 1))))

    def keep(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda r: F.when(r["own"] == 0, r["end"]).otherwise(0)), F.greatest)
        starts = F.reverse(running(F.reverse(F.transform(rows, lambda r: F.when(r["own"] == 0, r["start"]).otherwise(far))), F.least))
        told = F.arrays_zip(rows.alias("row"), ends.alias("before"), starts.alias("behind"))
        free = F.filter(told, lambda x: (x["row"]["own"] == 1) & (x["before"] <= x["row"]["start"]) & (x["behind"] >= x["row"]["end"]))
        return F.transform(free, lambda x: x["row"]["span"])

    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(let(merged, keep))


def distinct_sorted(values: Column) -> Column:
    """Sorted values without repeats; ``array_distinct`` compares every two structs."""
    return let(F.sort_array(values), lambda v: F.filter(v, lambda x, i: (i == 0) | (x != F.get(v, i - 1))))


def digest_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in pieces of ``PIECE``."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")

    def part(i: Column) -> Column:
        begin = F.greatest(start - i * PIECE, F.lit(0))
        return F.substring(F.get(pieces, i), begin + 1, F.least(end - i * PIECE, F.lit(PIECE)) - begin)

    return F.when(start >= end, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(first, last), part), ""))


def replace_spans(text: Column, spans: Column, label) -> Column:
    """The text with every span replaced by ``label(span)``.

    Spans that overlap are replaced as their union, under the label of the first of them, at
    equal starts of the longest.
    """
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["value"].alias("value"), s["end"].alias("end"))))

    def build(rows: Column, ends: Column, pieces: Column, heads: Column) -> Column:
        at = lambda i: F.get(rows, i)
        # what lies between the end of the union before a head and the head
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1))
        parts = F.transform(heads, lambda i: F.concat(cut(pieces, before(i), at(i)["start"]), label(at(i))))
        return F.concat(F.array_join(parts, ""), cut(pieces, F.array_max(ends), F.length(text)))

    def whole(rows: Column) -> Column:
        def with_ends(ends: Column) -> Column:
            heads = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda i: (i == 0) | (F.get(rows, i)["start"] >= F.get(ends, i - 1)))
            return let(heads, lambda h: let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda p: build(rows, ends, p, h)))

        return let(running(F.transform(rows, lambda r: r["end"]), F.greatest), with_ends)

    return F.when(F.size(spans) == 0, text).otherwise(let(ordered, whole))


def same_document(left: str = "l", right: str = "r") -> Column:
    """Equality of (id, text hash), under which rows with equal ids but other texts stay apart."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_key") == F.col(f"{right}.text_key"))


def of_document(left: str = "l", right: str = "r") -> Column:
    """The same for whole documents on the left: their key is computed, so no column of theirs can clash."""
    key = F.xxhash64(F.coalesce(F.col(f"{left}.text"), F.lit("")))
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (key == F.col(f"{right}.text_key"))
