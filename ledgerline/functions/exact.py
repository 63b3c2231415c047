"""Exact sums of doubles, whatever their size and in whatever order they are added.

A double is a whole number times a power of two. Here it is cut by its exponent:
each number belongs to a *band* of 42 exponents, and within the band it is a
whole number of at most 102 bits, held in five parts of 21 bits. Parts are LONGs, so
adding them up is exact and order-independent (2^42 numbers fit one band of one
group). Nothing is rounded until the one value is made at the end, and there is no
largest or smallest number: 1e300 and 4e-7 add up exactly.

``exact_totals`` groups by key and band, combined map-side, and then gathers the few
bands of each key (two at the usual amounts, 53 at most) in one column, an
*accumulator*. Accumulators can be written and rolled up further (``roll_up``); ``value``
turns one into the nearest DOUBLE (ties to even), and no numbers at all into NULL.
All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_BITS, PARTS = 21, 5
BAND_BITS = 2 * PART_BITS
LOWEST = -1115                       # exponent of the first band's first bit
BANDS = (1024 - 53 - LOWEST) // BAND_BITS + 1
USUAL_BAND = (-65 - LOWEST) // BAND_BITS
#: Parts of a whole number that reaches over all bands, with room for carries.
ALL_PARTS = 2 * BANDS + PARTS + 3


def _entry(df: DataFrame, out: str) -> DataFrame:
    """``df`` with ``<out>_band`` and ``<out>_p0`` ... for the number ``<out>_x``; the band is
    NULL for no number. Written as SQL text: one call to the JVM a step, not one per term."""
    x, y, top = f"`{out}_x`", f"`{out}_y`", f"`{out}_top`"
    # the lowest bit, and one below it in case log2 is rounded up
    band = f"cast(greatest(0, floor((floor(log2(abs({x}))) - {53 + LOWEST}) / {BAND_BITS}.0D)) as int)"
    # to a whole number, in two steps that can't overflow; powers of two are exact
    down = [-(LOWEST + BAND_BITS * b) for b in range(BANDS)]
    halves = [", ".join(f"{2.0 ** h!r}D" for h in half) for half in (
        [d // 2 for d in down], [d - d // 2 for d in down])]
    scaled = " * ".join(f"get(array({half}), `{out}_band`)" for half in halves)
    mask, high, low = (1 << PART_BITS) - 1, 2.0 ** (2 * PART_BITS), f"cast({y} - {top} * {2.0 ** 42!r}D as long)"
    parts = [f"{low} & {mask}", f"shiftright({low}, {PART_BITS})", f"{top} & {mask}",
             f"shiftright({top}, {PART_BITS}) & {mask}", f"shiftright({top}, {2 * PART_BITS})"]
    df = df.selectExpr("*", f"CASE WHEN {x} IS NOT NULL THEN coalesce({band}, {USUAL_BAND}) END AS `{out}_band`")
    df = df.selectExpr("*", f"abs({x}) * {scaled} AS {y}")
    df = df.selectExpr("*", f"cast(floor({y} / {high!r}D) as long) AS {top}")
    return df.selectExpr("*", *[f"CASE WHEN {x} < 0 THEN -({p}) ELSE {p} END AS `{out}_p{i}`"
                                for i, p in enumerate(parts)]).drop(f"{out}_x", f"{out}_y", f"{out}_top")


def _parts(out: str) -> list[str]:
    return [f"{out}_p{i}" for i in range(PARTS)]


def _by_band(df: DataFrame, by: list[str], sums: list[str], counts: list[str]) -> DataFrame:
    """Parts added up by key and band, then the bands of each key gathered."""
    bands = [f"{s}_band" for s in sums]
    first = df.groupBy(*by, *bands).agg(*[F.sum(p).alias(p) for s in sums for p in _parts(s)],
                                        *[F.sum(c).alias(c) for c in counts])
    entry = lambda s: F.struct(F.col(f"{s}_band").alias("band"),
                               F.array(*_parts(s)).alias("parts"))
    return first.groupBy(*by).agg(
        *[F.collect_list(F.when(F.col(f"{s}_band").isNotNull(), entry(s))).alias(s) for s in sums],
        *[F.sum(c).alias(c) for c in counts])


def exact_totals(df: DataFrame, by: list[str], sums: dict[str, str | Column],
                 counts: dict[str, Column] | None = None) -> DataFrame:
    """``by`` columns, an accumulator per entry of ``sums``, and integer totals.

    ``counts`` are integer expressions of a row that are added up beside the sums (a
    count is the sum of ones); like SUM they are NULL where there was nothing to add.
    Key and result names must not clash. With no ``by`` there is always one row.
    """
    counts = counts or {}
    rows = df.select(*by, *[(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"{s}_x")
                            for s, c in sums.items()], *[c.cast("long").alias(n) for n, c in counts.items()])
    for s in sums:
        rows = _entry(rows, s)
    return _by_band(rows, by, list(sums), list(counts))


def roll_up(grain: DataFrame, by: list[str], acc: str, counts: list[str]) -> DataFrame:
    """Totals of a coarser key from a grain's accumulator and integer totals."""
    entries = F.when(F.size(acc) > 0, F.col(acc)).otherwise(
        F.array(F.lit(None).cast("struct<band:int,parts:array<bigint>>")))
    rows = grain.select(*by, *counts, F.posexplode(entries).alias("_at", "_e")).select(
        *by, *[F.when(F.col("_at") == 0, F.col(c)).alias(c) for c in counts],
        F.col("_e.band").alias(f"{acc}_band"),
        *[F.get("_e.parts", F.lit(i)).alias(p) for i, p in enumerate(_parts(acc))])
    return _by_band(rows, by, [acc], counts)


def totals_by(df: DataFrame, by: list[str], sums: dict[str, str | Column],
              counts: dict[str, Column] | None = None) -> DataFrame:
    """``exact_totals`` with the sums as doubles, and 0 where nothing was counted."""
    return exact_totals(df, by, sums, counts).select(
        *by, *[value(s).alias(s) for s in sums],
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts or {}])


def known(c: str) -> Column:
    """1 for a row with a value, 0 without: adds up to COUNT(c)."""
    return F.when(F.col(c).isNotNull(), 1).otherwise(0)


def value(acc: str) -> Column:
    """The double nearest to what the accumulator column ``acc`` holds."""
    return F.expr(f"CASE WHEN size(`{acc}`) > 0 THEN coalesce(CASE WHEN size(`{acc}`) = 1 THEN "
                  f"get(transform(`{acc}`, e -> {_ONE_BAND}), 0) END, {_all_bands(f'`{acc}`')}) END")


def _let(name: str, x: str, then: str) -> str:
    """``then`` with ``name`` standing for x, computed once."""
    return f"get(transform(array({x}), {name} -> {then}), 0)"


def _decimal(x: str) -> str:
    return f"cast({x} as decimal(38,0))"


def _digit_value(i: int) -> str:
    return _decimal(f"'{1 << PART_BITS * i}'")


def _scaled(x: str, exponent: str) -> str:
    """x times a power of two, in two steps that can't overflow."""
    half = f"cast(floor(({exponent}) / 2) as int)"
    return f"{x} * power(2.0D, {half}) * power(2.0D, ({exponent}) - {half})"


def _one_band() -> str:
    """The usual case: the parts of entry e fit one decimal of 38 digits, else NULL."""
    whole = _decimal("'0'")
    for i in range(PARTS):
        whole = f"try_add({whole}, try_multiply({_decimal(f'e.parts[{i}]')}, {_digit_value(i)}))"
    return _scaled(f"cast({whole} as double)", f"{LOWEST} + {BAND_BITS} * e.band")


def _all_bands(acc: str) -> str:
    """Parts of all bands in one row of digits to the base 2^21, from the lowest up; its first
    85 bits or more and whether anything stands below them decide the nearest double."""
    last = ALL_PARTS - 1
    laid = (f"transform(sequence(0, {last}), i -> aggregate({acc}, 0L, (t, e) -> t + coalesce("
            f"CASE WHEN i >= 2 * e.band THEN get(e.parts, i - 2 * e.band) END, 0L)))")
    # a negative sum leaves a negative last digit: take the digits of its opposite
    digits = f"CASE WHEN c[{last}] < 0 THEN {_carried('transform(r, x -> -x)')} ELSE c END"
    top = "coalesce(array_max(transform(d, (v, i) -> CASE WHEN v <> 0 THEN i END)), 0)"
    number = f"(CASE WHEN c[{last}] < 0 THEN -1.0D ELSE 1.0D END) * {_NEAREST}"
    return _let("r", laid, _let("c", _carried("r"), _let("d", digits, _let("h", top, number))))


def _carried(parts: str) -> str:
    """Digits 0 <= x < 2^21, all but the last."""
    last, mask = ALL_PARTS - 1, (1 << PART_BITS) - 1
    return (f"aggregate(slice({parts}, 1, {last}), named_struct('carry', 0L, 'out', cast(array() as array<bigint>)), "
            f"(s, x) -> named_struct('carry', shiftright(s.carry + x, {PART_BITS}), "
            f"'out', concat(s.out, array((s.carry + x) & {mask}L))), "
            f"s -> concat(s.out, array(s.carry + get({parts}, {last}))))")


def _nearest() -> str:
    """Of the digits d, the highest of which is h."""
    whole = " + ".join(f"{_decimal(f'CASE WHEN h >= {k} THEN get(d, h - {k}) ELSE 0L END')} * "
                       f"{_digit_value(PARTS - 1 - k)}" for k in range(PARTS))
    below = f"exists(slice(d, 1, greatest(h - {PARTS - 1}, 0)), x -> x <> 0)"
    return _scaled(f"cast(({whole}) * 2 + CASE WHEN {below} THEN 1 ELSE 0 END as double)",
                   f"{LOWEST - 1} + {PART_BITS} * (h - {PARTS - 1})")


_ONE_BAND, _NEAREST = _one_band(), _nearest()
