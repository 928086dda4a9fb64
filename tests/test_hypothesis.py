import itertools
import math
import random

import pytest

from riskweave.functions.tails import chi_square_tail, exact_rank_sum, two_sided_normal
from riskweave.operators import hypothesis as h


def test_chi_square_tail_against_tables():
    # upper five percent points
    for dof, x in {1: 3.841458820694124, 2: 5.991464547107979, 3: 7.814727903251179, 5: 11.070497693516351}.items():
        assert chi_square_tail(x, dof) == pytest.approx(0.05, abs=1e-12)
    assert chi_square_tail(0.0, 4) == chi_square_tail(1.0, 0) == 1.0
    assert 0 < chi_square_tail(200.0, 3) < 1e-40


def test_normal_tail():
    assert two_sided_normal(1.959963984540054) == pytest.approx(0.05)
    assert two_sided_normal(-1.0) == 1.0


@pytest.mark.parametrize(("n1", "n2"), [(1, 4), (3, 4), (4, 3), (5, 5)])
def test_exact_rank_sum_against_enumeration(n1, n2):
    stats = [
        sum(ranks) - n1 * (n1 + 1) / 2 for ranks in itertools.combinations(range(1, n1 + n2 + 1), n1)
    ]
    for u in set(stats):
        above = sum(s >= max(u, n1 * n2 - u) for s in stats) / len(stats)
        assert exact_rank_sum(u, n1, n2) == pytest.approx(min(1.0, 2 * above))


def _amounts(make, fraud, legit):
    return make([{"amount": float(a), "is_fraud": 1} for a in fraud] + [{"amount": float(a)} for a in legit])


def test_u_counts_pairs(make):
    rng = random.Random(8)
    fraud, legit = [rng.randrange(20) for _ in range(30)], [rng.randrange(25) for _ in range(60)]
    row = h.mann_whitney(_amounts(make, fraud, legit)).first()
    assert row["u_statistic"] == sum((f > g) + 0.5 * (f == g) for f in fraud for g in legit)
    n, n1, n2 = 90, 30, 60
    ties = sum(c**3 - c for c in ((fraud + legit).count(v) for v in set(fraud + legit)))
    assert row["tie_term"] == ties
    spread = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    larger = max(row["u_statistic"], n1 * n2 - row["u_statistic"])
    assert row["z"] == pytest.approx((larger - n1 * n2 / 2 - 0.5) / spread)
    assert h.mann_whitney_p(row) == pytest.approx(two_sided_normal(row["z"]))


def test_small_samples_use_the_exact_distribution(make):
    row = h.mann_whitney(_amounts(make, [9, 8, 7], [1, 2, 3, 4])).first()
    assert row["u_statistic"] == 12
    assert h.mann_whitney_p(row) == pytest.approx(2 / 35)
    empty = h.mann_whitney(_amounts(make, [], [1, 2])).first()
    assert h.mann_whitney_p(empty) is None


def _table(make, counts):
    return make(
        [{"payment_type": k, "is_fraud": y} for k, (legit, fraud) in counts.items() for y, c in ((0, legit), (1, fraud)) for _ in range(c)]
    )


def test_chi_square(make):
    counts = {"a": (10, 20), "b": (20, 5), "c": (7, 8)}
    row = h.chi_square(_table(make, counts)).first()
    total, fraud = 70, 33
    want = sum(
        (seen - size * share) ** 2 / (size * share)
        for legit, bad in counts.values()
        for size in (legit + bad,)
        for seen, share in ((bad, fraud / total), (legit, 1 - fraud / total))
    )
    assert (row["chi2"], row["dof"]) == (pytest.approx(want), 2)


def test_two_by_two_gets_the_continuity_correction(make):
    row = h.chi_square(_table(make, {"a": (10, 20), "b": (20, 5)})).first()
    want = sum((abs(s - e) - 0.5) ** 2 / e for s, e in ((10, 180 / 11), (20, 150 / 11), (20, 150 / 11), (5, 125 / 11)))
    assert (row["chi2"], row["dof"]) == (pytest.approx(want), 1)


def test_single_class_has_no_degrees_of_freedom(make):
    row = h.chi_square(_table(make, {"a": (3, 0), "b": (4, 0)})).first()
    assert (row["chi2"], row["dof"]) == (0.0, 0)
    results = {r["test"]: r for r in h.hypothesis_results(_table(make, {"a": (3, 0), "b": (4, 0)})).collect()}
    assert results["chi_square_payment_type"]["p_value"] == 1.0
    assert results["mann_whitney_amount"]["reject"] is None


def test_exact_rank_sum_of_a_small_and_a_large_sample():
    assert exact_rank_sum(0.93 * 8 * 200_000, 8, 200_000) == pytest.approx(4.80e-7, rel=2e-3)
    # one value above all others: two of n + 1 orderings are as extreme
    assert exact_rank_sum(10**6, 1, 10**6) == pytest.approx(2 / (10**6 + 1))
