"""Synthetic array samples for tests: allele frequencies, genotypes by sex and contig, and intensities with contamination."""

from __future__ import annotations

import numpy as np

from loculoom.sources import binary

SEED, CONTAMINATION, OUTLIERS = 1337, 0.05, 0.02
SD_HOM, SD_HET = 0.03, 0.025
HAPLOID_IN_MALES = ("chrX", "chrY", "chrM")


def frequencies(loci: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).beta(0.5, 0.5, loci)


def genotypes(af: np.ndarray, chroms: list[str], male: bool, rng: np.random.Generator) -> np.ndarray:
    """0 no-call, 1 AA, 2 AB, 3 BB: Hardy-Weinberg draws; one allele where males have one, none on a female's chrY."""
    first, second = rng.random(len(af)) < af, rng.random(len(af)) < af
    haploid = np.array([c == "chrM" or (male and c in HAPLOID_IN_MALES) for c in chroms])
    out = 1 + first + np.where(haploid, first, second)
    return np.where(np.array([c == "chrY" for c in chroms]) & (not male), 0, out)


def b_frequencies(g: np.ndarray, af: np.ndarray, contamination: float, rng: np.random.Generator) -> np.ndarray:
    mean = np.select([g == 1, g == 2, g == 3], [contamination * af, 0.5, 1 - contamination * (1 - af)], 0.5)
    baf = rng.normal(mean, np.where(g == 2, SD_HET, SD_HOM))
    return np.clip(np.where(rng.random(len(g)) < OUTLIERS, rng.random(len(g)), baf), 0, 1)


def write_sample(path: str, name: str, chroms: list[str], male: bool, contamination: float = CONTAMINATION, seed: int = SEED) -> np.ndarray:
    """Write a GTC file of one sample and return its genotypes."""
    af, rng = frequencies(len(chroms)), np.random.default_rng(seed)
    g = genotypes(af, chroms, male, rng)
    zeros = np.zeros(len(g))
    binary.write_gtc(path, name, {"genotypes": g, "scores": np.full(len(g), 0.9), "baf": b_frequencies(g, af, contamination, rng), "lrr": zeros, "x": zeros, "y": zeros})
    return g
