"""Column functions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TOKENS = ("", ".", "NA", "NaN", "nan", "null", "NULL", "N/A", "n/a", "None", "-nan", "-NaN")


def number(c: Column) -> Column:
    """Text to double: null tokens, text that is no number and NaN become null."""
    t = F.trim(c)
    d = F.when(t.isin(*NULL_TOKENS), None).otherwise(t).try_cast("double")
    return F.nanvl(d, F.lit(None).cast("double"))


def passes(test: Column, *measures: Column) -> Column:
    """A threshold test; null or NaN measures never pass."""
    bad = F.lit(False)
    for m in measures:
        bad = bad | m.isNull() | F.isnan(m)
    return ~bad & F.coalesce(test, F.lit(False))


def float_text(c: Column, digits: int = 4) -> Column:
    """A double rounded half-even as the shortest plain decimal with at least one digit after the point."""
    d = F.bround(c, digits).cast(f"decimal(18,{digits})").cast("string")
    return F.regexp_replace(d, r"(\.\d+?)0+$", "$1")


def variant_id(chrom: str = "chrom", pos: str = "pos", ref: str = "ref", alt: str = "alt") -> Column:
    return F.concat_ws(":", F.col(chrom), F.col(pos).cast("string"), F.col(ref), F.col(alt))


def hwe_exact(hom_ref: Column, het: Column, hom_alt: Column, midp: bool = True) -> Column:
    """Exact test of Hardy-Weinberg proportions from genotype counts: the mass of all heterozygote counts that are no
    likelier than the observed one (mid-p: half of the ties' mass).

    Masses are relative to the observed count's and follow from their neighbours', upwards and downwards, so that each step
    is a few multiplications; a mass beyond the doubles means a p-value of 0.
    """
    n = (hom_ref + het + hom_alt).cast("double")
    rare = F.least(2 * hom_ref + het, 2 * hom_alt + het).cast("long")
    start = het.cast("long")

    def walk(ks: Column, ratio) -> Column:
        def step(s: Column, k: Column) -> Column:
            w, hom = s["w"], (rare - k) / 2.0
            low = w <= 1 + 1e-8
            return F.struct(
                (w * ratio(k.cast("double"), hom, n - k - hom)).alias("w"), (s["all"] + w).alias("all"), (s["low"] + F.when(low, w).otherwise(0.0)).alias("low"),
                (s["tied"] + F.when(low & (w >= 1 - 1e-8), w).otherwise(0.0)).alias("tied"),
            )

        return F.aggregate(ks, F.struct(F.lit(1.0).alias("w"), *[F.lit(0.0).alias(c) for c in ("all", "low", "tied")]), step)

    up = walk(F.sequence(start, rare, F.lit(2).cast("long")), lambda k, a, b: 4.0 * a * b / ((k + 2) * (k + 1)))
    down = walk(F.sequence(start, start % 2, F.lit(-2).cast("long")), lambda k, a, b: k * (k - 1) / (4.0 * (a + 1) * (b + 1)))
    # both walks begin at the observed count, whose mass is 1
    both = lambda u, d, c: u[c] + d[c] - 1
    p = let(up, lambda u: let(down, lambda d: (both(u, d, "low") - both(u, d, "tied") * (0.5 if midp else 0.0)) / both(u, d, "all")))
    return F.when(n > 0, p)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def require(df: DataFrame, *columns: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def ordered_concat(order: list[str], text: str, by: str = ";") -> Column:
    """Aggregate: the texts of a group in the given order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("text_"))))
    return F.array_join(F.transform(rows, lambda x: x["text_"]), by)
