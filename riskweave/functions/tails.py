"""Tail probabilities of single test statistics; plain arithmetic on a handful of driver numbers."""

from __future__ import annotations

import math

def two_sided_normal(z: float) -> float:
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


def chi_square_tail(x: float, dof: int) -> float:
    """P(X >= x) for an integer number of degrees of freedom, in closed form."""
    if dof == 0:
        return 1.0
    half = x / 2.0
    if half <= 0:
        return 1.0
    log_half = math.log(half)
    if dof % 2 == 0:
        terms = [i * log_half - math.lgamma(i + 1) - half for i in range(dof // 2)]
        base = 0.0
    else:
        terms = [(i - 0.5) * log_half - math.lgamma(i + 0.5) - half for i in range(1, (dof - 1) // 2 + 1)]
        base = math.erfc(math.sqrt(half))
    return min(1.0, base + math.fsum(math.exp(t) for t in terms))


def _small_part_counts(parts: int) -> tuple[list[int], int]:
    """(numerator, step) so that numerator(q) / (1 - q^step)^(parts + 1) counts, at q^j, the partitions of the numbers
    up to j into parts of at most ``parts``. Its length depends on ``parts`` alone."""
    step = math.lcm(*range(1, parts + 1))
    numerator = [1]
    for divisor in (1, *range(1, parts + 1)):
        # (1 - q^step) / (1 - q^divisor) is 1 + q^divisor + ... + q^(step - divisor)
        longer = numerator + [0] * (step - divisor)
        for k in range(divisor, len(longer)):
            longer[k] += longer[k - divisor] - (numerator[k - step] if 0 <= k - step < len(numerator) else 0)
        numerator = longer
    return numerator, step


def exact_rank_sum(u: float, n1: int, n2: int) -> float:
    """Two-sided exact p-value of the rank-sum statistic without ties; the cost follows the smaller sample alone.

    The number of orderings with each U are the coefficients of the Gaussian binomial
    ``prod (1 - q^(large + i)) / (1 - q^i)``. Multiplying out its numerator gives one signed term per subset of the smaller
    sample; each shifts the count of partitions into small parts, which has a closed form.
    """
    small, large = sorted((n1, n2))
    numerator, step = _small_part_counts(small)

    def partitions_up_to(j: int) -> int:
        return sum(c * math.comb((j - d) // step + small, small) for d, c in enumerate(numerator) if d <= j and (j - d) % step == 0)

    below = n1 * n2 - math.ceil(max(u, n1 * n2 - u))  # by symmetry, as many orderings as at or above
    terms = {0: 1}
    for i in range(1, small + 1):
        for shift, sign in list(terms.items()):
            moved = shift + large + i
            if moved <= below:
                terms[moved] = terms.get(moved, 0) - sign
    ways = sum(sign * partitions_up_to(below - shift) for shift, sign in terms.items())
    return min(1.0, 2 * ways / math.comb(n1 + n2, small))
