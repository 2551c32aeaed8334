"""Name ratios as plain column expressions: no Python worker, usable in any select, filter or view.

The longest common subsequence by the bit-parallel recurrence of ``functions.lcs``, on a BIGINT:
the pattern's characters are bits, so it may have up to ``MAX_PATTERN`` of them (the sum of two words
must stay below the sign).  The pattern is the shorter string of a pair; the other may be of any
length.  Beyond that the result is null, and ``similarity.score_name_pairs`` has no limit.

Bulk scoring stays with the Arrow kernel, which is faster on millions of pairs; the expressions are
for filters, ad-hoc columns and engines without Python workers.  ``char_masks`` can be kept as a
column of a name table, so that a name's table of positions is built once and not once per pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from regalign.functions.similarity import DEFAULT_WEIGHTS, ratio_from_lcs, tokens

MAX_PATTERN = 62


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _characters(text: Column) -> Column:
    """The code points of a string; none for an empty one."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def _power(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def char_masks(pattern: Column) -> Column:
    """Map from each character of ``pattern`` to the bits of its positions; null when it is too long."""
    none = F.lit(0).cast("long")

    def table(chars: Column) -> Column:
        def bits(c: Column) -> Column:
            at = F.transform(chars, lambda x, i: F.when(x == c, _power(i)).otherwise(none))
            return F.aggregate(at, none, lambda a, b: a.bitwiseOR(b))

        return _let(F.array_distinct(chars), lambda distinct: F.map_from_arrays(distinct, F.transform(distinct, bits)))

    return F.when(F.length(pattern) <= MAX_PATTERN, _let(_characters(pattern), table))


def lcs_with_masks(text: Column, masks: Column, pattern_length: Column) -> Column:
    """LCS length of ``text`` and the pattern that ``char_masks`` was made of."""
    def length(full: Column) -> Column:
        found = F.transform(_characters(text), lambda c: F.coalesce(F.try_element_at(masks, c), F.lit(0).cast("long")))

        def step(v: Column, m: Column) -> Column:
            both = v.bitwiseAND(m)
            return (v + both).bitwiseOR(v - both).bitwiseAND(full)

        return F.bit_count(F.aggregate(found, full, step))

    return F.when(masks.isNotNull(), pattern_length - _let(_power(pattern_length) - F.lit(1).cast("long"), length))


def lcs_length(a: Column, b: Column) -> Column:
    """LCS length in characters (null counts as ""); null when the shorter string is over ``MAX_PATTERN``."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    swap = F.length(b) > F.length(a)
    pair = F.struct(F.when(swap, b).otherwise(a).alias("text"), F.when(swap, a).otherwise(b).alias("pattern"))

    def of(p: Column) -> Column:
        size = F.least(F.length(p["pattern"]), F.lit(MAX_PATTERN))
        return _let(char_masks(p["pattern"]), lambda masks: lcs_with_masks(p["text"], masks, size))

    return _let(pair, of)


def _ratio(p: Column) -> Column:
    """Of a struct of two strings."""
    return ratio_from_lcs(p["a"], p["b"], lcs_length(p["a"], p["b"]))


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def indel_ratio(a: Column, b: Column) -> Column:
    """Whole percent 0 to 100 of the indel similarity: equal strings 100, an empty one 0."""
    return _let(_pair(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))), _ratio)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """``indel_ratio`` of the sorted tokens."""
    return _let(_pair(*(F.array_join(F.array_sort(tokens(x)), " ") for x in (a, b))), _ratio)


def token_set_ratio(a: Column, b: Column) -> Column:
    """The best ratio among the common tokens and both sides' common tokens with their rest; 0 without tokens."""
    def strings(t: Column) -> Column:
        both = F.array_join(F.array_intersect(t["a"], t["b"]), " ")
        return F.struct(both.alias("both"), *[
            F.trim(F.concat_ws(" ", both, F.array_join(F.array_except(t[x], t[y]), " "))).alias(x) for x, y in ("ab", "ba")])

    def best(s: Column) -> Column:
        size = F.length(s["both"])  # the common tokens are a prefix of either side
        # greatest() skips nulls: a side that is too long must not turn into the smaller of the others
        return _let(_ratio(s), lambda sides: F.when(sides.isNotNull(), F.greatest(
            ratio_from_lcs(s["both"], s["a"], size), ratio_from_lcs(s["both"], s["b"], size), sides)))

    def score(t: Column) -> Column:
        return F.when((F.size(t["a"]) == 0) | (F.size(t["b"]) == 0), F.lit(0)).otherwise(_let(strings(t), best))

    return _let(_pair(*(F.array_sort(F.array_distinct(tokens(x))) for x in (a, b))), score)


def name_similarity(a: Column, b: Column, weights: tuple[float, float, float] = DEFAULT_WEIGHTS) -> Column:
    """The weighted score of two names in [0, 1]; 0.0 when either is empty or null."""
    def score(p: Column) -> Column:
        parts = (indel_ratio(p["a"], p["b"]), token_sort_ratio(p["a"], p["b"]), token_set_ratio(p["a"], p["b"]))
        r, s, t = (x / F.lit(100.0) * F.lit(float(w)) for x, w in zip(parts, weights))
        return F.when((p["a"] == "") | (p["b"] == ""), F.lit(0.0)).otherwise(r + s + t)

    return _let(_pair(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))), score)
