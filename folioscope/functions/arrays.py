"""Array building blocks that keep work inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` evaluated once: a lambda variable binds it."""
    return F.get(F.transform(F.array(value), body), 0)


def scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running values of an associative `combine`: element i is all of 0 to i combined.

    Each round combines every element with the one 1, 2, 4, ... places before it,
    so the work is n log n, where a fold that appends to an array copies n * n / 2 elements.
    """
    widths = F.filter(F.array(*[F.lit(1 << k) for k in range(30)]), lambda w: w < F.size(values))
    step = lambda acc, w: F.transform(acc, lambda x, i: F.when(i >= w, combine(F.get(acc, i - w), x)).otherwise(x))
    return F.aggregate(widths, values, step)


def sorted_before(values: Column, x: Column) -> Column:
    """How many elements of a sorted array are less than x, by bisection."""
    powers = F.filter(F.array(*[F.lit(1 << k) for k in range(29, -1, -1)]), lambda w: w <= F.size(values))
    return F.aggregate(powers, F.lit(0), lambda acc, w: F.when(F.coalesce(F.get(values, acc + w - 1) < x, F.lit(False)), acc + w).otherwise(acc))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches as an array of (pos, end, value), in code points. Gaps between matches give the positions."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    steps = F.arrays_zip(gaps.alias("gap"), F.transform(matches, F.char_length).alias("size"), values.alias("value"))

    def placed(xs: Column) -> Column:
        ends = scan(F.transform(xs, lambda x: x["gap"] + x["size"]), lambda a, b: a + b)
        at = lambda x, end: F.struct((end - x["size"]).alias("pos"), end.alias("end"), x["value"].alias("value"))
        return F.zip_with(xs, ends, at)

    return let(F.filter(steps, lambda x: x["size"].isNotNull()), placed)


def bag(items: Column) -> Column:
    """An array of texts in which repeats are marked by how many equal ones came before, so that set operations count them.

    The marks are part of the text: on plain strings, set operations hash.
    """

    def marked(s: Column) -> Column:
        starts = F.transform(s, lambda x, i: F.when((i > 0) & (F.get(s, i - 1) == x), F.lit(0)).otherwise(i))
        place = lambda x, nth: F.when(nth == 0, x).otherwise(F.concat_ws("\x02", x, nth.cast("string")))
        since = F.transform(scan(starts, F.greatest), lambda start, i: i - start)
        return F.zip_with(s, since, place)

    return let(items, lambda a: F.when(F.size(F.array_distinct(a)) == F.size(a), a).otherwise(let(F.sort_array(a), marked)))


def bag_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    return F.size(F.array_intersect(bag(a), bag(b)))


def ngrams(tokens: Column, n: int) -> Column:
    def of(t: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.array_join(F.slice(t, i, n), "\x01"))
        return F.when(F.size(t) < n, F.array().cast("array<string>")).otherwise(grams)

    return let(tokens, of)


def dot(a: Column, b: Column) -> Column:
    """Dot product in doubles, summed in array order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if either has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
