"""The chromosome X test against all tables in exact integers, and how its work grows."""

import math
import random
from fractions import Fraction

import pytest

from loculoom.operators import hwe_x


def brute(hom_ref, het, hom_alt, male_ref, male_alt, midp):
    females, males, alt = hom_ref + het + hom_alt, male_ref + male_alt, 2 * hom_alt + het + male_alt

    def mass(m, h):
        b = (alt - m - h) // 2
        return math.comb(males, m) * math.comb(females, b) * math.comb(females - b, h) * 2**h

    tables = [mass(m, h) for m in range(min(males, alt) + 1) for h in range((alt - m) % 2, females + 1, 2) if 0 <= (alt - m - h) // 2 <= females - h and alt - m - h >= 0]
    own = mass(male_alt, het)
    assert sum(tables) == math.comb(2 * females + males, alt)
    low, tied = sum(t for t in tables if t <= own), sum(t for t in tables if t == own)
    return float((Fraction(low) - (Fraction(tied, 2) if midp else 0)) / sum(tables))


@pytest.mark.parametrize("midp", [True, False])
def test_all_tables(midp):
    pick = random.Random(3)
    cases = [(0, 0, 0, 5, 3), (4, 0, 0, 0, 0), (0, 9, 0, 0, 0), (0, 0, 0, 0, 7), (3, 2, 1, 0, 0), (1, 0, 0, 0, 1), (40, 0, 40, 3, 60), (0, 60, 0, 30, 30), (55, 1, 0, 40, 1)]
    cases += [tuple(pick.randint(0, pick.choice([1, 5, 40])) for _ in range(5)) for _ in range(150)]
    for case in cases:
        if sum(case):
            assert hwe_x.p_value(*case, midp) == pytest.approx(brute(*case, midp), rel=1e-7, abs=1e-300), case
    assert hwe_x.p_value(0, 0, 0, 0, 0, midp) is None


def test_far_tails_are_not_lost():
    case = (300, 0, 300, 500, 20)
    assert 0 < hwe_x.p_value(*case, True) < 1e-150 and hwe_x.p_value(*case, True) == pytest.approx(brute(*case, True), rel=1e-6)


def test_work_grows_with_the_spread():
    """A hundred times the cohort has a hundred times the tables of each kind; ten times as many rows and columns are within reach."""
    seen = {}
    for n in (300, 3_000, 30_000):
        q = 0.3
        case = (round(n * (1 - q) ** 2), round(n * 2 * q * (1 - q)), round(n * q * q), round(n * (1 - q)), round(n * q))
        seen[n] = hwe_x.low_mass(*case)[3]
        assert hwe_x.p_value(*case, True) > 0.5
    assert seen[30_000] < 15 * seen[3_000] and seen[30_000] < 30_000**2 / 100
    rare = hwe_x.low_mass(99_990, 10, 0, 99_995, 5)[3]
    assert rare < 500
