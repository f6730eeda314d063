"""Exact sums of doubles: the true sum, rounded once, whatever the order.

A double is an integer of 53 bits times a power of two.  Each value is cut into
four lanes of 26 bits on a fixed grid, and every lane is summed as a long, which
is exact and does not depend on the order in which rows or partial sums meet.
The lanes of a group are put together once, at the end, and rounded half to
even, as ``math.fsum`` does.

The grid of ordinary values has units of 2^-64 and reaches to 2^40.  Values
beyond it (very large or tiny ones, NaN, infinities) are grouped by a *window*,
the same grid shifted by a multiple of 52 bits, so they are exact too; a group
without such values is one row of partial sums.  A lane holds 2^37 rows of one
group and window; beyond that the sum of longs fails instead of wrapping.

Everything is a built-in expression: two hash aggregates, the first with a
map-side step, in one SQL text, which Spark analyses faster than the same tree
of column calls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS, LANES, LOW = 26, 4, -64
HIGH = BITS * LANES + LOW          # ordinary values are below 2^HIGH
STEP = 52                          # two lanes: windows share the grid of lanes
NAN, PLUS_INF, MINUS_INF = 63, 62, 61
MAX_COLUMNS = 9                    # windows of all columns in one long
MASK = (1 << BITS) - 1


def _window(x: str) -> str:
    """0 for ordinary values (and NULL), else the shift of the grid that holds the value."""
    # the logarithm may be off next to a power of two
    first = f"floor((log2(abs({x})) + 12) / {STEP})"
    near = (f"{first} + IF(abs({x}) >= pow(2D, ({first} + 1) * {STEP} - 12), 1, 0) - IF(abs({x}) < pow(2D, {first} * {STEP} - 12), 1, 0)")
    return (f"CASE WHEN {x} IS NULL OR abs({x}) < {2.0 ** HIGH!r}D AND rint({x} * {2.0 ** -LOW!r}D) = {x} * {2.0 ** -LOW!r}D THEN 0 "
            f"WHEN isnan({x}) THEN {NAN} WHEN {x} = double('Infinity') THEN {PLUS_INF} WHEN {x} = double('-Infinity') THEN {MINUS_INF} "
            f"ELSE CAST(greatest({near}, -20) AS INT) END")


def _in_window(x: str, w: str) -> str:
    half = f"pow(2D, {w} * -{STEP // 2})"
    return f"CASE WHEN {w} = 0 THEN {x} WHEN {w} >= {MINUS_INF} THEN 0D ELSE {x} * {half} * {half} END"


def _let(value: str, name: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``, computed once however often it is named."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _ordinary(m: Sequence[str]) -> tuple[str, str]:
    """(condition, sum) of four lane sums that together stay below 2^HIGH.

    Carries leave three digits and a signed top; two lanes each are exact as a
    double, so their addition is the only rounding.
    """
    t1 = f"({m[1]} + shiftright({m[0]}, {BITS}))"
    t2 = f"({m[2]} + shiftright({t1}, {BITS}))"
    t3 = f"({m[3]} + shiftright({t2}, {BITS}))"
    high = f"CAST({t3} * {1 << BITS}L + ({t2} & {MASK}L) AS DOUBLE) * {2.0 ** (LOW + 2 * BITS)!r}D"
    low = f"CAST(({t1} & {MASK}L) * {1 << BITS}L + ({m[0]} & {MASK}L) AS DOUBLE) * {2.0 ** LOW!r}D"
    return f"{t3} BETWEEN -{MASK}L AND {MASK}L", f"{high} + {low}"


def _digits(lanes: str) -> str:
    """(carry, digits of 26 bits, lowest first) of lane sums."""
    add = _let("state.carry + lane", "v",
               f"named_struct('carry', shiftright(v, {BITS}), 'digits', concat(state.digits, array(v & {MASK}L)))")
    return f"aggregate({lanes}, named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>)), (state, lane) -> {add})"


def _any(parts: str) -> str:
    """The sum of partial sums of any windows: an array of (w, s0, s1, s2, s3)."""
    def digit(k: int) -> str:
        return f"coalesce(get(digits, t - {k}), 0L)"

    # the two highest digits are exact as a double, and so are the next two; a bit
    # for all that is below them decides ties, and one addition rounds
    below = "IF(exists(slice(digits, 1, greatest(t - 3, 0)), v -> v <> 0), 1L, 0L)"
    high = f"CAST({digit(0)} * {1 << BITS}L + {digit(1)} AS DOUBLE) * {2.0 ** BITS!r}D"
    low = f"CAST({digit(2)} * {1 << BITS}L + {digit(3)} | {below} AS DOUBLE) * {2.0 ** -BITS!r}D"
    scaled = _let(f"(base + t - 2) * {BITS} + {LOW}", "scale",
                  f"({high} + {low}) * pow(2D, floor(scale / 2)) * pow(2D, scale - floor(scale / 2))")
    rounded = _let("array_max(transform(digits, (v, i) -> IF(v <> 0, i, NULL)))", "t", f"IF(t IS NULL, 0D, {scaled})")
    signed = _let(_digits("sums"), "total", _let(
        f"IF(total.carry < 0, {_digits('transform(sums, v -> -v)')}.digits, total.digits)", "digits",
        f"IF(total.carry < 0, -1D, 1D) * {rounded}"))
    own = "CASE lane - p.w * 2 WHEN 0 THEN p.s0 WHEN 1 THEN p.s1 WHEN 2 THEN p.s2 WHEN 3 THEN p.s3 ELSE 0L END"
    # three more lanes take the carry
    sums = (f"transform(sequence(base, array_max(windows) * 2 + {LANES + 2}), "
            f"lane -> aggregate(valid, 0L, (sum, p) -> sum + {own}))")
    finite = _let("array_min(windows) * 2", "base", _let(sums, "sums", signed))
    special = (f"CASE WHEN size(valid) = 0 THEN NULL "
               f"WHEN array_contains(windows, {NAN}) OR array_contains(windows, {PLUS_INF}) AND array_contains(windows, {MINUS_INF}) THEN double('NaN') "
               f"WHEN array_contains(windows, {PLUS_INF}) THEN double('Infinity') WHEN array_contains(windows, {MINUS_INF}) THEN double('-Infinity') "
               f"ELSE {finite} END")
    return _let(f"filter({parts}, p -> p.s0 IS NOT NULL)", "valid", _let("transform(valid, p -> p.w)", "windows", special))


def exact_totals(df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, str | Column],
                 rows: str | None = None) -> DataFrame:
    """``{out: double column}`` summed exactly per ``keys``; ``rows`` names a column with the number of rows.

    NULLs are skipped, all NULL gives NULL.  NaN, infinities of both signs, and
    a sum beyond the doubles come out as in a sum of doubles.  -0.0 counts as 0.0.
    """
    if not 1 <= len(sums) <= MAX_COLUMNS:
        raise ValueError(f"1 to {MAX_COLUMNS} sums at a time")
    keys = [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]
    names = df.select(*keys).columns
    groups, cells, lanes = [f"_k{i}" for i in range(len(keys))], range(len(sums)), range(LANES)
    values = [(F.col(f"`{c}`") if isinstance(c, str) else c).cast("double") for c in sums.values()]
    source = df.select(*[k.alias(g) for k, g in zip(keys, groups, strict=True)], *[v.alias(f"_x{i}") for i, v in zip(cells, values, strict=True)])

    def select(columns: Sequence[str], frame: str, by: Sequence[str] = ()) -> str:
        return f"SELECT {', '.join([*groups, *columns])} FROM {frame}" + (f" GROUP BY {', '.join(by)}" if by else "")

    plain = " AND ".join(f"_w{i} = 0" for i in cells)
    packed = " | ".join(f"shiftleft(CAST(_w{i} + 32 AS BIGINT), {7 * i})" for i in cells)
    text = select([*[f"_x{i}" for i in cells], *[f"{_window(f'_x{i}')} AS _w{i}" for i in cells]], "{source}")
    text = select([f"CASE WHEN {plain} THEN 0L ELSE {packed} END AS _w", *[f"{_in_window(f'_x{i}', f'_w{i}')} AS _r{i}" for i in cells]], f"({text})")
    done: list[str] = []
    for lane in range(LANES - 1, 0, -1):  # what is left after rounding to a lane's unit is exact
        unit = 2.0 ** (LOW + BITS * lane)
        text = select(["_w", *done, *[f"_r{i}" for i in cells], *[f"rint(_r{i} * {1 / unit!r}D) AS _p{i}" for i in cells]], f"({text})")
        text = select(["_w", *done, *[f"_r{i} - _p{i} * {unit!r}D AS _r{i}" for i in cells], *[f"floor(_p{i}) AS _l{i}_{lane}" for i in cells]], f"({text})")
        done += [f"_l{i}_{lane}" for i in cells]
    text = select(["_w", *done, *[f"floor(_r{i} * {2.0 ** -LOW!r}D) AS _l{i}_0" for i in cells]], f"({text})")
    text = select(["_w", *[f"sum(_l{i}_{j}) AS _l{i}_{j}" for i in cells for j in lanes], "count(1) AS _n"], f"({text})", [*groups, "_w"])

    def window(i: int) -> str:
        return f"CAST(CASE WHEN _w = 0 THEN 0 ELSE (shiftright(_w, {7 * i}) & 127L) - 32 END AS INT)"

    def parts(i: int, letter: str) -> str:
        return ", ".join(f"'s{j}', _{letter}{i}_{j}" for j in lanes)

    text = select(["sum(_n) AS _n", *[f"sum(IF({window(i)} = 0, _l{i}_{j}, NULL)) AS _m{i}_{j}" for i in cells for j in lanes],
                   *[f"collect_list(IF({window(i)} <> 0, named_struct('w', {window(i)}, {parts(i, 'l')}), NULL)) AS _o{i}" for i in cells]],
                  f"({text})", groups or ["()"])

    def result(i: int) -> str:
        fits, value = _ordinary([f"_m{i}_{j}" for j in lanes])
        every = f"concat(array(named_struct('w', 0, {parts(i, 'm')})), _o{i})"
        return f"CASE WHEN size(_o{i}) = 0 AND (_m{i}_0 IS NULL OR {fits}) THEN {value} ELSE {_any(every)} END"

    text = select(["_n", *[f"{result(i)} AS _x{i}" for i in cells]], f"({text})")
    merged = df.sparkSession.sql(text, source=source)
    return merged.select(*[F.col(g).alias(k) for g, k in zip(groups, names, strict=True)], *([F.col("_n").alias(rows)] if rows else []),
                         *[F.col(f"_x{i}").alias(name) for i, name in enumerate(sums)])
