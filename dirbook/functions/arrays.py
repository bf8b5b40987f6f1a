"""Candidate lists: expansion to rows, collapsing of fragments, merging of continuations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dirbook.functions.text import compact_address, composed_lists, strip


def string_candidates(values: Column) -> Column:
    """Distinct non-empty texts, first come first, of an array of normalised texts (null: none)."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), strip), lambda x: x != ""))


def composed_candidates(values: Column) -> Column:
    """string_candidates() of texts that aren't normalised yet."""
    return string_candidates(composed_lists(values))


def blank(values: Column) -> Column:
    return ~F.exists(values, lambda x: strip(x) != "")


def expand_candidates(phones: Column, names: Column, addresses: Column) -> Column:
    """Rows (phone, name, address): as many as there are phones or addresses. A single phone goes to all rows, the first
    name and the last address fill up."""
    some = lambda c: F.filter(c, lambda x: x != "")
    filled = lambda c: F.when(F.size(c) > 0, c).otherwise(F.array(F.lit("")))

    def rows(v: Column) -> Column:
        p, n, a = v["p"], v["n"], v["a"]
        # what holds for all rows is bound before them
        fixed = F.struct(p.alias("p"), n.alias("n"), a.alias("a"), F.when(F.size(p) == 1, F.get(p, F.lit(0))).otherwise(F.lit("")).alias("phone"), F.get(n, F.lit(0)).alias("name"), F.element_at(a, -1).alias("address"))
        return _with(fixed, lambda f: F.transform(F.sequence(F.lit(0), F.greatest(F.size(f["p"]), F.size(f["a"])) - 1), lambda i: row(f, i)))

    def row(f: Column, i: Column) -> Column:
        return F.struct(
            F.coalesce(F.get(f["p"], i), f["phone"], F.lit("")).alias("phone"),
            F.coalesce(F.get(f["n"], i), f["name"]).alias("name"),
            F.coalesce(F.get(f["a"], i), f["address"]).alias("address"),
        )

    given = F.struct(phones.alias("p"), some(names).alias("n"), some(addresses).alias("a"))
    return _with(given, lambda g: _with(F.struct(*[filled(g[c]).alias(c) for c in "pna"]), rows))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used: in a lambda it would be computed for each element."""
    return F.transform(F.array(value), use)[0]


def collapse_fragments(addresses: Column) -> Column:
    """The longest address alone if it holds all others in compact form; else all that aren't empty."""
    kept = F.filter(addresses, lambda x: x != "")
    # longest compact form first; the sort keeps the order of equals by their place
    pairs = F.transform(kept, lambda x, i: F.struct((-F.char_length(compact_address(x))).alias("k"), i.alias("i"), x.alias("x"), compact_address(x).alias("c")))
    ordered = F.array_sort(pairs)
    holds = lambda p: (p["c"] != "") & F.forall(pairs, lambda o: (o["x"] == p["x"]) | (o["c"] == "") | F.contains(p["c"], o["c"]))
    whole = F.get(F.filter(ordered, holds), 0)
    return F.when(F.size(kept) <= 1, kept).when(whole.isNotNull(), F.array(whole["x"])).otherwise(kept)


def merge_continuation(addresses: Column, continuations: Column) -> Column:
    more = F.array_join(F.transform(continuations, strip), "")
    base = F.filter(addresses, lambda x: strip(x) != "")
    return F.when(more == "", addresses).when(F.size(base) == 0, F.array(more)).otherwise(F.transform(base, lambda x: F.concat(x, more)))


def put_first(values: Column, hint: Column) -> Column:
    """values with the hint in front unless it is empty or there already."""
    return F.when((hint == "") | F.array_contains(values, hint), values).otherwise(F.array_prepend(values, hint))


def review_flags(flags: Column, starts: Column, ends: Column, continued: Column, phones: Column, addresses: Column) -> Column:
    """Flags of a segment and those that follow from it, each once."""
    derived = F.array(
        F.when(starts, F.lit("starts_mid_entry")),
        F.when(ends, F.lit("ends_mid_entry")),
        F.when(continued, F.lit("continued_from_previous")),
        F.when(F.size(phones) > 1, F.lit("multi_phone")),
        F.when(F.size(addresses) > 1, F.lit("multi_address")),
    )
    return F.array_union(flags, F.filter(derived, lambda x: x.isNotNull()))
