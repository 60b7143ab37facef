"""Text keys, ordered rule lists and id-list mappings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from rollspan.functions.numeric import col


def valid_id(c: Column | str) -> Column:
    """International form: ``0084`` followed by nine more characters."""
    return col(c).startswith("0084") & (F.length(col(c)) == 13)


def first_match(rules: Iterable[tuple[Column, str]], default: str | None = None) -> Column:
    """Ordered rules, first hit wins."""
    out = None
    for test, label in rules:
        out = F.when(test, label) if out is None else out.when(test, label)
    if out is None:
        return F.lit(default)
    return out.otherwise(default) if default is not None else out


def like_rules(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """``(label, [LIKE patterns])`` rules."""
    def any_like(patterns):
        test = F.lit(False)
        for p in patterns:
            test = test | col(c).like(p)
        return test
    return first_match([(any_like(p), label) for label, p in rules], default)


def regex_rules(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """``(label, regex)`` rules, unanchored search."""
    return first_match([(col(c).rlike(p), label) for label, p in rules], default)


def threshold_rules(c: Column | str, rules: Sequence[tuple[str, float, bool]], default: str) -> Column:
    """``(label, upper, inclusive)`` rules checked in order."""
    v = col(c)
    return first_match([((v <= u) if inc else (v < u), label) for label, u, inc in rules], default)


def map_ids(c: Column | str, groups: Mapping[str, Sequence], default: str) -> Column:
    """Group label of an id; when lists overlap the first group wins."""
    return first_match([(col(c).isin(list(ids)), label) for label, ids in groups.items()], default)


def sanitize(c: Column | str) -> Column:
    """Upper case without blanks."""
    return F.replace(F.upper(col(c)), F.lit(" "), F.lit(""))


def tidy(c: Column | str) -> Column:
    return F.lower(F.trim(col(c)))


def prefix_key(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def part_of(c: Column | str, sep: str, position: int) -> Column:
    """1-based part of a delimited id; NULL when there are fewer parts."""
    return F.try_element_at(F.split(col(c), sep), F.lit(position))


def any_of(flags: Sequence[Column | str], at_least: int = 2) -> Column:
    """1 when at least ``at_least`` of the capability flags are set; a NULL flag gives 0."""
    summed = sum((col(f) for f in flags[1:]), col(flags[0]))
    return F.when(summed >= at_least, 1).otherwise(0)


def multivalue_bucket(c: Column | str, sep: str, buckets: Sequence[tuple[float, bool, str]],
                      last: str, unknown: str, scale_above: float | None = None,
                      scale_by: float = 1.0) -> Column:
    """Bucket every part of a delimited list and keep the greatest label."""
    def one(part):
        v = F.expr("cast(null as double)") if part is None else part.try_cast("double")
        if scale_above is not None:
            v = F.when(v > scale_above, v / scale_by).otherwise(v)
        out = F.when(v.isNull(), unknown)
        for upper, inclusive, label in buckets:
            out = out.when((v <= upper) if inclusive else (v < upper), label)
        return out.otherwise(last)
    return F.array_max(F.transform(F.split(col(c), sep), one))


def merge_maps(a: Column | str, b: Column | str) -> Column:
    """Key-wise sum of two frequency maps; a missing map counts as empty."""
    both = F.map_zip_with(col(a), col(b),
                          lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
    return F.coalesce(both, col(a), col(b))


def map_text(m: Column | str) -> Column:
    """``k:v`` pairs sorted by key, for storing or comparing maps."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(col(m))),
                                    lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
