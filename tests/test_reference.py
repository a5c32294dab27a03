"""Variants against an indexed reference, and the dosage of each ALT of an array site."""

import random

import pytest
from pyspark.sql import functions as F

from loculoom.plans import stages
from loculoom.sources import fasta

SITES = "bpm_index int, chrom string, pos long, ref string, alt string, allele_a string, allele_b string"


def write(path, contigs, line=60):
    """A FASTA file with its index; lines end with one byte, those of the second contig with two."""
    text, index = b"", ""
    for k, (name, bases) in enumerate(contigs.items()):
        end = "\r\n" if k == 1 else "\n"
        text += f">{name} about{end}".encode()
        index += f"{name}\t{len(bases)}\t{len(text)}\t{line}\t{line + len(end)}\n"
        text += "".join(bases[a : a + line] + end for a in range(0, len(bases), line)).encode()
    path.write_bytes(text)
    path.with_name(path.name + ".fai").write_text(index)


def brute(bases, pos, ref, alt):
    """All (pos, ref, alt) that spell the same sequence: the leftmost, of these the shortest."""
    whole, best = bases[: pos - 1] + alt + bases[pos - 1 + len(ref) :], None
    longest = max(len(ref), len(alt))
    for p in range(1, pos + longest):
        for n in range(1, longest + 1):
            for_alt = n + len(alt) - len(ref)
            if for_alt >= 1 and bases[: p - 1] + whole[p - 1 : p - 1 + for_alt] + bases[p - 1 + n :] == whole and p - 1 + n <= len(bases):
                if best is None or n < len(best[1]):
                    best = best if best and best[0] < p and n >= len(best[1]) else (p, bases[p - 1 : p - 1 + n], whole[p - 1 : p - 1 + for_alt])
    return best


def test_ranges(tmp_path):
    pick = random.Random(1)
    contigs = {f"chr{k}": "".join(pick.choice("ACGTacgt") for _ in range(n)) for k, n in ((1, 500), (2, 333), ("M", 60))}
    write(tmp_path / "r.fa", contigs)
    f = fasta.Fasta(str(tmp_path / "r.fa"), piece=37)
    for name, bases in contigs.items():
        for _ in range(60):
            a = pick.randint(-5, len(bases))
            b = a + pick.randint(0, 130)
            assert f.take(name, a, b) == bases[max(0, a) : max(0, b)].upper()
    assert [f.name(x) for x in ("1", "chr2", "MT", "chr9")] == ["chr1", "chr2", "chrM", None]


def test_normal_form_by_brute_force(tmp_path):
    """Indels in repeats, over the borders of the pieces that are read."""
    pick = random.Random(2)
    bases = "".join(pick.choice(["A", "CA", "CACACA", "GG", "T", "TTTTT"]) for _ in range(60))
    write(tmp_path / "r.fa", {"chr1": bases})
    f = fasta.Fasta(str(tmp_path / "r.fa"), piece=8)
    moved = 0
    for _ in range(400):
        pos, n = pick.randint(1, len(bases) - 8), pick.randint(1, 7)
        ref = bases[pos - 1 : pos - 1 + n]
        alt = ref[: pick.randint(1, n)] + pick.choice(["", "", "CA", "T"])
        if alt == ref or alt[0] != ref[0]:
            continue
        got = fasta.normal_form(f, "1", pos, ref.lower(), alt)
        want = brute(bases, pos, ref, alt)
        assert got == want, (pos, ref, alt)
        moved += got[0] < pos
    assert moved > 60
    assert fasta.normal_form(f, "chr1", 5, "A" if bases[4] != "A" else "C", "G") is None and fasta.normal_form(f, "chr7", 5, "A", "G") is None
    assert fasta.normal_form(f, "chr1", 5, bases[4:6], "<DEL>") == (5, bases[4:6], "<DEL>") and fasta.normal_form(f, "chr1", len(bases), bases[-1] + "A", "G") is None


def test_sites_over_tiles(spark, tmp_path):
    pick = random.Random(3)
    contigs = {c: "".join(pick.choice(["A", "CACA", "G", "TTT"]) for _ in range(400)) for c in ("chr1", "chr2")}
    write(tmp_path / "r.fa", contigs)
    rows = []
    for k in range(500):
        c = pick.choice(["chr1", "chr2", "chr3"])
        bases = contigs.get(c, "A" * 900)
        pos = pick.randint(1, len(bases) - 12)
        ref = bases[pos - 1 : pos - 1 + pick.randint(1, 5)]
        rows.append((k, c, pos, ref if k % 7 else "N" + ref, ref[0] + pick.choice(["", "CA", "T"]) if pick.random() < 0.5 else pick.choice("ACGT")))
    sites = spark.createDataFrame(rows, "k int, chrom string, pos long, ref string, alt string")
    f = fasta.Fasta(str(tmp_path / "r.fa"))
    want = {k: fasta.normal_form(f, *r) for k, *r in rows}
    got = {r.k: (r.pos, r.ref, r.alt) for r in fasta.normalised(sites, str(tmp_path / "r.fa"), tile=16, piece=16).collect()}
    assert got == {k: w for k, w in want.items() if w is not None} and 0 < len(got) < 450


def test_a_long_repeat_is_read_once(tmp_path):
    """Indels of whole blocks of one repeat, in order: all go to its start, and the file is read about once, not once a site."""
    lead, n = "GTTAC", 60_000
    bases = lead + "ACGT" * (n // 4) + "GGA" + "CA" * 500
    write(tmp_path / "r.fa", {"chr1": bases})
    f = fasta.Fasta(str(tmp_path / "r.fa"), piece=64)
    for pos in range(len(lead) + 4, n, 40):
        assert fasta.normal_form(f, "chr1", pos, bases[pos - 1 : pos + 4], bases[pos - 1]) == (len(lead), "CACGT", "C")
    assert f.reads < 3 * n / 64 + 200
    # back in the repeat, and an insertion in another behind it
    assert fasta.normal_form(f, "chr1", 100, bases[99:104], bases[99])[0] == len(lead)
    end = len(lead) + n + 3
    got = fasta.normal_form(f, "chr1", len(bases) - 7, bases[len(bases) - 8], bases[len(bases) - 8] + bases[len(bases) - 7 : len(bases) - 5])
    assert got == (end - 1, bases[end - 2], bases[end - 2] + bases[end - 1 : end + 1])


#: (site, dosage of each ALT for the genotypes no-call, AA, AB, BB)
ARRAY = [
    ((1, "chr1", 100, "A", "G", None, None), {"G": [None, 0, 1, 2]}),
    ((2, "chr1", 200, "A", "G", "G", "A"), {"G": [None, 2, 1, 0]}),
    ((3, "chr1", 300, "A", "G,T", None, None), {"G": [None] * 4, "T": [None] * 4}),
    ((4, "chr1", 400, "A", "G,T", "A", "T"), {"G": [None, 0, 0, 0], "T": [None, 0, 1, 2]}),
    ((5, "chr1", 500, "A", "G,T", "G", "T"), {"G": [None, 2, 1, 0], "T": [None, 0, 1, 2]}),
    ((6, "chr1", 600, "A", "G", "T", "C"), {"G": [None, 0, 1, 2]}),  # on the other strand
    ((7, "chr1", 700, "A", "G", "A", "C"), {"G": [None] * 4}),  # none of the site's alleles
    ((8, "chr1", 800, "AC", "A", "AC", "A"), {"A": [None, 0, 1, 2]}),
    ((9, "chr1", 900, "A", "G", "G", "G"), {"G": [None, 2, 2, 2]}),
]


@pytest.mark.parametrize("reference", [False, True])
def test_dosage_of_each_alt(spark, tmp_path, reference):
    bases = list("C" * 1000)
    for site, _ in ARRAY:
        bases[site[2] - 1 : site[2] - 1 + len(site[3])] = site[3]
    write(tmp_path / "r.fa", {"chr1": "".join(bases)})
    sites = spark.createDataFrame([s for s, _ in ARRAY] + [(10, "chr1", 950, "T", "G", None, None)] * reference, SITES)
    intensity = spark.createDataFrame([(f"old{g}", s[0], g, None if g == 0 else g - 1, 0.5) for s, _ in ARRAY for g in range(4)], "sample_id string, bpm_index int, gt int, dosage int, score double")
    names = spark.createDataFrame([(f"old{g}", f"S{g}") for g in range(4)], "old_name string, sg_id string")
    heavy, light = stages.plate_calls(intensity, sites, names, str(tmp_path / "r.fa") if reference else None)
    got = {(r.bpm_index, r.alt, r.sample_id): r.dosage for r in light.collect()}
    assert got == {(s[0], alt, f"S{g}"): d for s, alts in ARRAY for alt, ds in alts.items() for g, d in enumerate(ds)}
    assert set(light.columns) < set(heavy.columns) | {"x"} and not [c for c in heavy.columns if c.endswith("copies")]
    short = stages.plate_calls(intensity, sites.drop("allele_a", "allele_b"), names)[1]
    assert short.filter((F.col("bpm_index") == 1) & (F.col("dosage") == 2)).count() == 1 and short.filter("bpm_index = 4 AND dosage IS NOT NULL").isEmpty()
