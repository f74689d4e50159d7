"""Display formatting (E29) with exact round-half-even on the binary value.

``format_string('%.2f')`` rounds half-up on the shortest decimal form of a double, so
0.125 prints "0.13" where the published reports (correctly rounded binary value) print
"0.12". ``with_fixed2`` reproduces correct rounding with integer arithmetic only:

    |x| = M / 2^k exactly, with M an integer below 2^55 (scaling by 2^k is exact),
    cents = round_half_even(100 * M / 2^k) from an integer quotient and remainder.

The steps are separate projections: each intermediate value is referenced several times, so
Catalyst keeps it as one column instead of inlining it (which would multiply the expression
and overflow the generated code). Everything is built-in expressions inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MAX_EXACT = float(2 ** 53)  # every double from here on is an integer: nothing to round
_TINY = 0.004  # |x| below this rounds to 0.00 whatever the tie rule


def _idiv(a: Column, b: Column) -> Column:
    """Exact integral division of a non-negative bigint by a positive bigint."""
    exact = (a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")
    return exact.cast("bigint")


def with_fixed2(df: DataFrame, specs: list[tuple[str, str | None, str | None]]) -> DataFrame:
    """For each ``(source, text_col, round_col)``: ``text_col = f"{x:.2f}"`` and
    ``round_col = round(x, 2)`` with Python's rounding (either may be ``None``)."""
    tmp = {s: f"__fx{i}" for i, (s, _, _) in enumerate(specs)}

    def c(s: str, part: str) -> Column:
        return F.col(f"{tmp[s]}_{part}")

    out = df
    # 1: magnitude and scale exponent k (53 - floor(log2|x|), within 0..62 in the exact range)
    out = out.withColumns({f"{tmp[s]}_ax": F.abs(F.col(s)) for s, _, _ in specs})
    out = out.withColumns({
        f"{tmp[s]}_k": F.when((c(s, "ax") >= _TINY) & (c(s, "ax") < _MAX_EXACT),
                              (F.lit(53) - F.floor(F.log2(c(s, "ax")))).cast("int"))
        for s, _, _ in specs})
    # 2: p = 100 * M and d = 2^k, both exact bigints
    out = out.withColumns({
        f"{tmp[s]}_p": (c(s, "ax") * F.pow(F.lit(2.0), c(s, "k"))).cast("bigint") * F.lit(100)
        for s, _, _ in specs})
    out = out.withColumns({f"{tmp[s]}_d": F.pow(F.lit(2.0), c(s, "k")).cast("bigint") for s, _, _ in specs})
    # 3: quotient and doubled remainder
    out = out.withColumns({f"{tmp[s]}_q": _idiv(c(s, "p"), c(s, "d")) for s, _, _ in specs})
    out = out.withColumns({f"{tmp[s]}_r2": (c(s, "p") - c(s, "q") * c(s, "d")) * F.lit(2) for s, _, _ in specs})
    # 4: cents, half to even
    out = out.withColumns({
        f"{tmp[s]}_cents": F.when(c(s, "ax") < _TINY, F.lit(0).cast("bigint")).when(
            c(s, "k").isNotNull(),
            c(s, "q") + F.when((c(s, "r2") > c(s, "d")) | ((c(s, "r2") == c(s, "d")) & ((c(s, "q") % 2) == 1)),
                               F.lit(1)).otherwise(F.lit(0)))
        for s, _, _ in specs})
    # 5: rounded double (nearest double to cents/100, as Python's round)
    out = out.withColumns({
        f"{tmp[s]}_val": F.when(F.col(s).isNull(), F.lit(None).cast("double"))
        .when(c(s, "ax") >= _MAX_EXACT, F.col(s))
        .otherwise(F.when(F.col(s) < 0, -(c(s, "cents") / F.lit(100.0))).otherwise(c(s, "cents") / F.lit(100.0)))
        for s, _, _ in specs})
    final = {}
    for s, text_col, round_col in specs:
        if text_col:
            # the rounded double prints exactly with two decimals
            final[text_col] = F.when(c(s, "val").isNull(), F.lit(None).cast("string")).otherwise(
                F.when(c(s, "ax") >= _MAX_EXACT, F.format_string("%.2f", F.col(s)))
                .otherwise(F.format_string("%.2f", c(s, "val"))))
        if round_col:
            final[round_col] = c(s, "val")
    out = out.withColumns(final)
    drop = [f"{tmp[s]}_{p}" for s, _, _ in specs for p in ("ax", "k", "p", "d", "q", "r2", "cents", "val")]
    return out.drop(*drop)


def n_pct_text(n: Column, pct_text: Column) -> Column:
    """``"n (p.pp%)"`` from a count and an already formatted percentage."""
    return F.concat(n.cast("string"), F.lit(" ("), pct_text, F.lit("%)"))
