"""Exact quantiles without funnelling a column into one task.

``percentile`` (exact) keeps a value->count map whose final merge runs in a
single task; for a continuous column of billions of rows that map does not fit.
Here the order statistics the linear-interpolation quantile needs are found by
narrowing: an approximate quantile (bounded memory per task) brackets the
wanted ranks, one counting pass places the bracket, and the search continues
inside the bracket only.  Each round shrinks the candidate set by about the
sketch accuracy, so three or four cheap passes reach a set small enough to
order directly.  The result is exact (the same order statistics an exact sort
would give) and each pass is a plain distributed aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL = 10_000
ACCURACY = 10_000


def _bracket_counts(x: DataFrame, v_lo: float, v_hi: float) -> tuple[int, int, int, int]:
    c = x.agg(
        F.count_if(F.col("x") < v_lo).alias("below"),
        F.count_if(F.col("x") == v_lo).alias("at_lo"),
        F.count_if((F.col("x") > v_lo) & (F.col("x") < v_hi)).alias("inside"),
        F.count_if((F.col("x") == v_hi) & F.lit(v_hi != v_lo)).alias("at_hi"),
    ).first()
    return c["below"], c["at_lo"], c["inside"], c["at_hi"]


def _order_stats(x: DataFrame, ranks: list[int], n: int, small: int, accuracy: int) -> dict[int, float]:
    """Values at 0-based ``ranks`` of the (non-null, double) column ``x``, which has ``n`` rows."""
    if n <= small:
        lo, hi = min(ranks), max(ranks)
        if lo <= n - 1 - hi:   # lower ranks: keep the smallest values
            rows = x.orderBy(F.col("x").asc()).offset(lo).limit(hi - lo + 1).collect()
            return {r: rows[r - lo]["x"] for r in ranks}
        # upper ranks (the p90 case): keep only the largest values
        top = n - 1 - hi
        rows = x.orderBy(F.col("x").desc()).offset(top).limit(hi - lo + 1).collect()
        return {r: rows[hi - r]["x"] for r in ranks}
    eps = 3.0 / accuracy
    q_lo = max(0.0, min(ranks) / (n - 1) - eps)
    q_hi = min(1.0, max(ranks) / (n - 1) + eps)
    b = x.agg(F.percentile_approx("x", [q_lo, q_hi], accuracy).alias("b")).first()["b"]
    v_lo = float("-inf") if q_lo == 0.0 else b[0]
    v_hi = float("inf") if q_hi == 1.0 else b[1]
    below, at_lo, inside, at_hi = _bracket_counts(x, v_lo, v_hi)
    if min(ranks) < below or max(ranks) >= below + at_lo + inside + at_hi:
        # the sketch missed its error bound: open the bracket on the missed side(s)
        if min(ranks) < below:
            v_lo = float("-inf")
        if max(ranks) >= below + at_lo + inside + at_hi:
            v_hi = float("inf")
        below, at_lo, inside, at_hi = _bracket_counts(x, v_lo, v_hi)
    out: dict[int, float] = {}
    rest: list[int] = []
    for r in ranks:
        if r < below + at_lo:
            out[r] = v_lo
        elif r < below + at_lo + inside:
            rest.append(r)
        else:
            out[r] = v_hi
    if rest:
        offset = below + at_lo
        sub = x.where((F.col("x") > v_lo) & (F.col("x") < v_hi))
        got = _order_stats(sub, [r - offset for r in rest], inside, small, accuracy)
        out.update({r: got[r - offset] for r in rest})
    return out


def _interpolate(n: int, p: float, stats: dict[int, float]) -> float:
    index = (n - 1) * p
    lo = math.floor(index)
    hi = min(math.ceil(index), n - 1)
    v_lo, v_hi = stats[lo], stats[hi]
    h = index - lo
    if h == 0 or v_lo == v_hi:
        return float(v_lo)
    return float((1 - h) * v_lo + h * v_hi)


def _ranks(n: int, p: float) -> list[int]:
    index = (n - 1) * p
    return sorted({math.floor(index), min(math.ceil(index), n - 1)})


def exact_quantiles(df: DataFrame, specs: dict[str, tuple[str, float]], small: int = SMALL,
                    accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Several linear-interpolation quantiles of ``df`` sharing their scans.

    ``specs`` maps a result name to (column, p).  Pass 1 (one job) counts every
    column and sketches a bracket around each p; pass 2 (one job) places all
    brackets; only the values strictly inside a bracket are searched further.
    """
    names = list(specs)
    xs = {k: F.col(c).cast("double") for k, (c, _) in specs.items()}
    ok = {k: x.isNotNull() & ~F.isnan(x) for k, x in xs.items()}
    eps = 3.0 / accuracy
    aggs = []
    for k in names:
        p = specs[k][1]
        qs = [max(0.0, p - eps), min(1.0, p + eps)]
        aggs += [F.count_if(ok[k]).alias(f"n_{k}"),
                 F.percentile_approx(F.when(ok[k], xs[k]), qs, accuracy).alias(f"b_{k}")]
    first = df.agg(*aggs).first()
    out: dict[str, float | None] = {}
    bracketed = {}
    for k in names:
        n, p = first[f"n_{k}"], specs[k][1]
        col = df.select(xs[k].alias("x")).where(ok[k])
        if n == 0:
            out[k] = None
        else:
            b = first[f"b_{k}"]
            v_lo = float("-inf") if p - eps <= 0.0 else b[0]
            v_hi = float("inf") if p + eps >= 1.0 else b[1]
            bracketed[k] = (col, n, p, v_lo, v_hi)
    if bracketed:
        counts = []
        for k, (_, _, _, v_lo, v_hi) in bracketed.items():
            x = xs[k]
            counts += [F.count_if(ok[k] & (x < v_lo)).alias(f"below_{k}"),
                       F.count_if(ok[k] & (x == v_lo)).alias(f"at_lo_{k}"),
                       F.count_if(ok[k] & (x > v_lo) & (x < v_hi)).alias(f"inside_{k}"),
                       F.count_if(ok[k] & (x == v_hi) & F.lit(v_hi != v_lo)).alias(f"at_hi_{k}")]
        c = df.agg(*counts).first()
        for k, (col, n, p, v_lo, v_hi) in bracketed.items():
            below, at_lo, inside, at_hi = c[f"below_{k}"], c[f"at_lo_{k}"], c[f"inside_{k}"], c[f"at_hi_{k}"]
            ranks = _ranks(n, p)
            if min(ranks) < below or max(ranks) >= below + at_lo + inside + at_hi:
                stats = _order_stats(col, ranks, n, small, accuracy)  # sketch missed: general search
            else:
                stats, rest = {}, []
                for r in ranks:
                    if r < below + at_lo:
                        stats[r] = v_lo
                    elif r < below + at_lo + inside:
                        rest.append(r)
                    else:
                        stats[r] = v_hi
                if rest:
                    off = below + at_lo
                    sub = col.where((F.col("x") > v_lo) & (F.col("x") < v_hi))
                    got = _order_stats(sub, [r - off for r in rest], inside, small, accuracy)
                    stats.update({r: got[r - off] for r in rest})
            out[k] = _interpolate(n, p, stats)
    return out


def exact_quantile(df: DataFrame, column: str, p: float, small: int = SMALL,
                   accuracy: int = ACCURACY) -> float | None:
    """Linear-interpolation quantile (the default of R and of ``percentile``), NULLs skipped.

    Returns None for a column without non-null values.
    """
    return exact_quantiles(df, {"q": (column, p)}, small, accuracy)["q"]
