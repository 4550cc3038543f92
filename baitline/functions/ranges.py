"""Column functions on ranges (structs s, e; half-open) and identity flags; JVM expressions only."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(frags: Column) -> Column:
    """Total length of ranges."""
    return F.aggregate(frags, F.lit(0).cast("long"), lambda a, f: a + (f["e"] - f["s"]).cast("long"))


def reversed_ranges(frags: Column, length: Column) -> Column:
    """Ranges as seen from the other strand, in the same list order."""
    return F.transform(frags, lambda f: F.struct((length - f["e"]).alias("s"), (length - f["s"]).alias("e")))


def introns(frags: Column) -> Column:
    """Ranges between neighbouring ranges."""
    n = F.size(frags)
    between = lambda i: F.struct(F.element_at(frags, i)["e"].alias("s"), F.element_at(frags, i + 1)["s"].alias("e"))
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), between)).otherwise(F.filter(frags, lambda f: F.lit(False)))


def slices(seq: Column, frags: Column) -> Column:
    """Texts of seq under ranges."""
    return F.transform(frags, lambda f: F.substr(seq, f["s"] + 1, f["e"] - f["s"]))


def exons(frags: Column) -> Column:
    """Ranges with what lies between them taken out, from 0 on."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("out"))

    def step(acc: Column, f: Column) -> Column:
        n = (f["e"] - f["s"]).cast("long")
        return F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("s"), (acc["at"] + n).alias("e")))).alias("out"))

    return F.aggregate(frags, start, step, lambda acc: acc["out"])


def frameshift(spans: Column, most: int = 15) -> Column:
    """Whether a gap is too short for an intron and not whole codons."""
    return F.exists(spans, lambda x: (x < most) & (x % 3 != 0))


def let(value: Column, body) -> Column:
    """body(value) with value computed once; Spark doesn't share subexpressions of higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Windows with at most this many sets of places for mismatches are sought by a regular expression.
MOST_PATTERNS = 64


def flag_text(ident: Column) -> Column:
    """Identity flags as a text of 0 and 1."""
    return F.array_join(ident.cast("array<string>"), "")


def _trim_of(flags: Column, window: int, least: int) -> Column:
    """five_prime_trim of flags as a text: the first window is where a pattern first matches, one for each set of mismatches."""
    patterns = ("".join("." if i in gaps else "1" for i in range(window)) for gaps in combinations(range(window), window - least))
    at = F.regexp_instr(flags, F.lit("|".join(patterns)))
    trim = at + F.instr(F.substr(flags, at, F.lit(window)), F.lit("1")) - 2
    return F.when((F.length(flags) < window) | (at == 1), F.lit(0)).when(at > 1, trim).cast("long")


def five_prime_trim(ident: Column, window: int, threshold: float) -> Column:
    """Units to trim in front: up to the first window above threshold, and its leading mismatches; null if there is none."""
    least = int(threshold * window / 100) + 1  # identical units that are more than threshold percent
    if least <= window and comb(window, window - least) <= MOST_PATTERNS:
        return _trim_of(flag_text(ident), window, least)

    def of(flags: Column) -> Column:
        inside = lambda k: sum((F.get(flags, k + i) for i in range(1, window)), F.get(flags, k)) >= least
        windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size(flags) - window, F.lit(0))), inside)
        trim = lambda k: F.when(k == 1, F.lit(0)).when(k > 1, k + F.array_position(F.slice(flags, k, window), 1) - 2)
        return F.when(F.size(flags) < window, F.lit(0)).otherwise(let(F.array_position(windows, True).cast("int"), trim)).cast("long")

    return let(ident, of)


def terminal_trim(ident: Column, window: int = 5, threshold: float = 75.0) -> Column:
    """(five, three): units to trim at either end."""
    least = int(threshold * window / 100) + 1
    if least <= window and comb(window, window - least) <= MOST_PATTERNS:
        flags = flag_text(ident)
        return F.struct(_trim_of(flags, window, least).alias("five"), _trim_of(F.reverse(flags), window, least).alias("three"))
    return F.struct(five_prime_trim(ident, window, threshold).alias("five"), five_prime_trim(F.reverse(ident), window, threshold).alias("three"))


def identity(ident: Column) -> Column:
    """Percent of identical units, two digits, half to even."""
    return F.bround(F.aggregate(ident, F.lit(0), lambda a, x: a + x) * 100.0 / F.size(ident), 2)
