"""Set-similarity expressions over token arrays, exact in integer arithmetic.

Thresholds are rationals ``p/q`` so that prefix lengths and acceptance tests
never suffer from float rounding (``ceil(0.07 * 100)`` is 8 in floating point).
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

JACCARD = "jaccard"
# The reference's formula: overlap / (|A| + |B|), i.e. J / (1 + J).
OVERLAP_RATIO = "overlap_ratio"


@dataclass(frozen=True)
class Threshold:
    """A similarity threshold ``num/den`` with a measure and a comparison."""

    num: int
    den: int
    measure: str = JACCARD
    strict: bool = False

    @staticmethod
    def of(value, measure: str = JACCARD, strict: bool | None = None) -> "Threshold":
        frac = Fraction(value).limit_denominator(10**6) if not isinstance(value, Fraction) \
            else value
        if strict is None:
            strict = measure == OVERLAP_RATIO
        if not 0 < frac <= 1:
            raise ValueError("threshold must be in (0, 1]")
        if measure == OVERLAP_RATIO and frac >= Fraction(1, 2):
            raise ValueError("overlap_ratio never exceeds 1/2")
        return Threshold(frac.numerator, frac.denominator, measure, strict)

    def jaccard_bound(self) -> tuple[int, int]:
        """Smallest Jaccard value a result pair can have, as (p, q).

        For ``overlap_ratio`` s = J/(1+J), so s >= a/b  <=>  J >= a/(b-a).
        Used for prefix length and size filtering, which stay sound whether the
        final test is strict or not.
        """
        if self.measure == JACCARD:
            return self.num, self.den
        return self.num, self.den - self.num


def prefix_length(size: Column, p: int, q: int) -> Column:
    """Prefix length ``d - ceil(p*d/q) + 1`` (at least 1, at most d) in integers."""
    d = size.cast("bigint")
    x = d * p + (q - 1)
    # exact integer division: x - (x mod q) is a multiple of q
    ceil_td = (x - F.pmod(x, F.lit(q))) / q
    return F.least(d, F.greatest(F.lit(1), d - ceil_td.cast("bigint") + 1)).cast("int")


def size_compatible(size_a: Column, size_b: Column, p: int, q: int) -> Column:
    """Size filter for Jaccard >= p/q: min(|A|,|B|) * q >= max(|A|,|B|) * p."""
    return F.least(size_a, size_b).cast("bigint") * q >= \
        F.greatest(size_a, size_b).cast("bigint") * p


def accept(overlap: Column, size_a: Column, size_b: Column, th: Threshold) -> Column:
    """Exact acceptance test in integers for either measure."""
    o = overlap.cast("bigint")
    a = size_a.cast("bigint")
    b = size_b.cast("bigint")
    if th.measure == JACCARD:
        lhs, rhs = o * th.den, (a + b - o) * th.num          # J = o / (a+b-o)
    else:
        lhs, rhs = o * th.den, (a + b) * th.num              # s = o / (a+b)
    return (lhs > rhs) if th.strict else (lhs >= rhs)


def similarity_value(overlap: Column, size_a: Column, size_b: Column,
                     measure: str = JACCARD) -> Column:
    """Similarity as a double, divided once (identical to SQL's double division)."""
    o = overlap.cast("double")
    if measure == JACCARD:
        return o / (size_a + size_b - overlap).cast("double")
    return o / (size_a + size_b).cast("double")


def overlap_of(tokens_a: Column, tokens_b: Column) -> Column:
    """Number of tokens two distinct-token arrays share."""
    return F.size(F.array_intersect(tokens_a, tokens_b))


#: a signature has this many longs, 64 bits each
SIGNATURE_WORDS = 4


def signature(tokens: Column) -> list[Column]:
    """256 bits of a token set as four longs: every token sets the bit its hash names."""
    bits = F.transform(tokens, lambda t: F.xxhash64(t).bitwiseAND(F.lit(64 * SIGNATURE_WORDS - 1)))

    def word(k: int) -> Column:
        def put(acc: Column, bit: Column) -> Column:
            one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
            return F.when(F.shiftright(bit, 6) == k, acc.bitwiseOR(one)).otherwise(acc)

        return F.aggregate(bits, F.lit(0).cast("bigint"), put)

    return [word(k) for k in range(SIGNATURE_WORDS)]


def signature_overlap(size_a: Column, size_b: Column, sig_a: list[Column], sig_b: list[Column]) -> Column:
    """An upper bound of the overlap: a bit that only one set has stands for a token that the other lacks."""
    def only(one: list[Column], other: list[Column]) -> Column:
        total = F.lit(0)
        for x, y in zip(one, other, strict=True):
            total = total + F.bit_count(x.bitwiseAND(F.bitwise_not(y)))
        return total

    return F.least(size_a - only(sig_a, sig_b), size_b - only(sig_b, sig_a))


def pair_count(n: Column) -> Column:
    """n(n-1)/2 as an exact bigint: the even factor is halved first, so nothing
    overflows unless the result itself exceeds 64 bits (then NULL, never an error)."""
    n = n.cast("bigint")
    even_first = F.try_multiply(F.floor(n / 2).cast("bigint"), n - 1)
    odd_first = F.try_multiply(n, F.floor((n - 1) / 2).cast("bigint"))
    return F.when(F.pmod(n, F.lit(2)) == 0, even_first).otherwise(odd_first)


def pair_ratio(count: Column, n: Column) -> Column:
    """count / (n(n-1)/2) as a double; NULL when there is no pair."""
    pairs = pair_count(n)
    exact = count.cast("double") / pairs.cast("double")
    approx = count.cast("double") / (n.cast("double") * (n - 1).cast("double") / 2.0)
    return F.when(n.cast("bigint") > 1, F.coalesce(exact, approx))

