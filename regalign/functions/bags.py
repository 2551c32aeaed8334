"""Character bags of names: how many characters two strings can have in common at most.

A common subsequence uses every character at most as often as either string holds it, so
LCS(a, b) <= sum over characters of min(count in a, count in b).  Counts are kept per class of
characters (a letter, one or two digits, anything else); joining characters in a class only raises
the sum.  A count c is stored as c set bits, so the minima of all classes together are the set bits
of an AND: one ``bit_count`` per word and pair, in generated code.  A class has few bits; what goes
beyond them is counted in ``over``, and min(over a, over b) is added, which never lowers the bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (characters, bits) of the classes; every other character belongs to ``OTHER_BITS`` more.
CLASSES = [*((c, 5) for c in "abcdefghijklmnopqrstuvwxyz"), *((c, 3) for c in "012345"), ("67", 3), ("89", 3)]
OTHER_BITS = 35
_WORD_BITS = 63  # without the sign


def _layout() -> list[list[tuple[int, int]]]:
    """Per word the (class, bits) it holds; the last class is that of all other characters."""
    words: list[list[tuple[int, int]]] = [[]]
    for i, bits in enumerate([*(b for _, b in CLASSES), OTHER_BITS]):
        if sum(b for _, b in words[-1]) + bits > _WORD_BITS:
            words.append([])
        words[-1].append((i, bits))
    return words


LAYOUT = _layout()
#: Columns of a bag: the words, and ``over``.
WIDTH = len(LAYOUT) + 1


def counts(column: str) -> Column:
    """Characters of each class in a string column, as an array."""
    all_own = "".join(chars for chars, _ in CLASSES)
    listed = ", ".join(f"'{chars}'" for chars, _ in CLASSES)
    return F.expr(f"concat(transform(array({listed}), c -> length({column}) - length(translate({column}, c, ''))), "
                  f"array(length(translate({column}, '{all_own}', ''))))")


def bag(counted: str) -> list[Column]:
    """The bag, ``WIDTH`` longs, of a column that holds ``counts``."""
    caps = [b for word in LAYOUT for _, b in word]
    listed = f"array({', '.join(map(str, caps))})"
    capped = f"zip_with({counted}, {listed}, (c, most) -> least(c, most))"
    words = []
    for word in LAYOUT:
        at = [sum(b for _, b in word[:i]) for i in range(len(word))]
        own = f"slice({capped}, {word[0][0] + 1}, {len(word)})"
        words.append(F.expr(f"aggregate(zip_with({own}, array({', '.join(map(str, at))}), "
                            "(c, at) -> shiftleft(shiftleft(1L, c) - 1L, at)), 0L, (x, y) -> x | y)"))
    over = f"aggregate(zip_with({counted}, {listed}, (c, most) -> greatest(c - most, 0)), 0L, (x, y) -> x + y)"
    return [*words, F.expr(over)]


def common(a: list[Column], b: list[Column]) -> Column:
    """At least the number of characters two strings have in common, from their bags."""
    shared = [F.bit_count(x.bitwiseAND(y)) for x, y in zip(a[:-1], b[:-1])]
    return reduce(lambda x, y: x + y, shared) + F.least(a[-1], b[-1]).cast("int")


def most_percent(common_chars: Column, len_a: Column, len_b: Column) -> Column:
    """Largest percentage the ratio of two strings can round to, given how many characters they share at most."""
    total = len_a + len_b
    most = F.lit(200.0) * common_chars.cast("double") / F.greatest(total, F.lit(1)).cast("double") + F.lit(0.5)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.least(F.lit(100.0), most))
