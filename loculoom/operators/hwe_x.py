"""Exact test of Hardy-Weinberg proportions on chromosome X, females and males together.

Given the number of ALT alleles, a table has a mass by its male ALT alleles m and its heterozygous females h.  The mass of all tables together and that of
a row (all h for one m) are known in closed form; only tables that are no likelier than the observed one are added up.  Rows are taken outwards from the
likeliest until a whole row is negligible against the observed table, and in a row the tables on either side of those that are likelier,
until they are.  A row's ends are found by bisection, so the work grows with the spread of m and h and not with the number of males or females.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Log of the share of the observed mass below which a table or a row is negligible; log masses this close are ties.
NEGLIGIBLE, TIE = 34.0, 1e-8
#: Tables that are held at once.
HELD = 2_000_000
LOG_FACTORIAL = np.zeros(1)


def log_factorial(n: int) -> np.ndarray:
    """ln k! for k = 0..n at least."""
    global LOG_FACTORIAL
    if len(LOG_FACTORIAL) <= n:
        more = np.cumsum(np.log(np.arange(1, max(n, 2 * len(LOG_FACTORIAL)) + 1, dtype=np.float64)))
        LOG_FACTORIAL = np.concatenate([[0.0], more])
    return LOG_FACTORIAL


def first_true(low: np.ndarray, high: np.ndarray, test: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The first place in [low, high) from which on the test holds, else high; for each of several ranges."""
    low, high = low.copy(), high.copy()
    while (low < high).any():
        middle = (low + high) // 2
        hit = test(np.minimum(middle, np.maximum(high - 1, low)))
        open_ = low < high
        high = np.where(open_ & hit, middle, high)
        low = np.where(open_ & ~hit, middle + 1, low)
    return low


def low_mass(hom_ref: int, het: int, hom_alt: int, male_ref: int, male_alt: int) -> tuple[float, float, float, int]:
    """In units of the observed mass: that of all tables no likelier than it, that of its ties, that of all tables (as a log); and how many tables were looked at."""
    females, males = hom_ref + het + hom_alt, male_ref + male_alt
    alt = 2 * hom_alt + het + male_alt
    lf = log_factorial(2 * females + males)

    def mass(m: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Log mass of row m's table t: heterozygotes rise by two from the row's parity."""
        a = alt - m
        h = a % 2 + 2 * t
        b = (a - h) // 2
        return lf[males] - lf[m] - lf[males - m] + lf[females] - lf[b] - lf[h] - lf[females - b - h] + h * math.log(2.0)

    def row(m: np.ndarray) -> np.ndarray:
        return lf[males] - lf[m] - lf[males - m] + lf[2 * females] - lf[alt - m] - lf[2 * females - alt + m]

    own = float(mass(np.array(male_alt), np.array(het // 2)))
    total = float(lf[2 * females + males] - lf[alt] - lf[2 * females + males - alt]) - own
    least, most = max(0, alt - 2 * females), min(males, alt)
    mode = min(max((alt + 1) * (males + 1) // (2 * females + males + 2), least), most)
    one = lambda x: np.array([x])
    begin = int(first_true(one(least), one(mode), lambda m: row(m) >= own - NEGLIGIBLE)[0])
    end = int(first_true(one(mode), one(most + 1), lambda m: row(m) < own - NEGLIGIBLE)[0])
    low = tied = 0.0
    seen = 0
    step = 4096
    for first in range(begin, end, step):
        m = np.arange(first, min(end, first + step))
        a = alt - m
        size = (np.minimum(a, 2 * females - a) - a % 2) // 2 + 1
        zero = np.zeros(len(m), np.int64)

        def falls(t: np.ndarray, a=a) -> np.ndarray:
            """Whether the next table is no likelier."""
            h = a % 2 + 2 * t
            b = (a - h) // 2
            return 4.0 * b * (females - b - h) <= (h + 2.0) * (h + 1.0)

        top = np.minimum(first_true(zero, size, falls), size - 1)
        at = lambda level, m=m: (lambda t: mass(m, t) - own >= level)
        below = lambda level, m=m: (lambda t: mass(m, t) - own < level)
        # rising side: negligible, low, likelier; falling side: likelier, low, negligible
        up = first_true(zero, top + 1, at(-NEGLIGIBLE)), first_true(zero, top + 1, at(TIE))
        down = first_true(top + 1, size, below(TIE)), first_true(top + 1, size, below(-NEGLIGIBLE))
        for lo, hi in (up, down):
            n = np.maximum(hi - lo, 0)
            for k in np.split(np.arange(len(m)), np.flatnonzero(np.diff(np.cumsum(n) // HELD)) + 1):
                if not n[k].sum():
                    continue
                t = np.repeat(lo[k] - np.cumsum(n[k]) + n[k], n[k]) + np.arange(int(n[k].sum()))
                w = mass(np.repeat(m[k], n[k]), t) - own
                ties = np.abs(w) <= TIE
                low += float(np.exp(w[~ties]).sum()) + int(ties.sum())
                tied += int(ties.sum())
                seen += len(w)
    return low, tied, total, seen


def p_value(hom_ref: int, het: int, hom_alt: int, male_ref: int, male_alt: int, midp: bool) -> float | None:
    """Mass of all (male ALT alleles, heterozygous females) that are no likelier than the observed, given all ALT alleles (mid-p: half of the ties' mass)."""
    if not hom_ref + het + hom_alt + male_ref + male_alt:
        return None
    low, tied, total, _ = low_mass(hom_ref, het, hom_alt, male_ref, male_alt)
    return min(1.0, (low - (tied / 2 if midp else 0.0)) * math.exp(-total))


def hwe_x(counts: DataFrame, midp: bool = True) -> DataFrame:
    """Add p_hwe to distinct counts(hom_ref, het, hom_alt of females; male_ref, male_alt)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(p_hwe=[p_value(*map(int, r), midp) for r in b.itertuples(index=False)])

    return counts.mapInPandas(run, "hom_ref long, het long, hom_alt long, male_ref long, male_alt long, p_hwe double")
