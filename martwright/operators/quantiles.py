"""Exact order statistics of columns of any length, without sorting them.

One scan counts each column and brackets every wanted rank between two values with a sketch. A second
scan counts the values below each bracket and reduces those inside to (value, count); only these, a
few of 10,000, are sorted. Brackets that all hold one value, as those of columns of few values do, need
counts and no sort. A rank that falls outside its bracket is looked for again between the column's ends, so no result
rests on the sketch. Values keep their own type and all their digits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType, NumericType

from martwright.operators.ordered import BUCKET, POS, Ordered

ACCURACY = 10_000  # a sketched rank is off by at most the row count divided by this
MARGIN = 2 / ACCURACY

# Where a rank lies, as a share of the rows, and the 0-based rank among so many values.
Rank = tuple[float, Callable[[int], int]]
MEDIAN: dict[str, Rank] = {"median_lo": (0.5, lambda n: (n - 1) // 2), "median_hi": (0.5, lambda n: n // 2)}
QUARTILES: dict[str, Rank] = {"q1": (0.25, lambda n: n // 4), "q3": (0.75, lambda n: 3 * n // 4)}


@dataclass(frozen=True)
class Found:
    """What stands at a rank: the value, how many rows have it, and the rank's place among those."""

    value: object
    rows: int
    place: int


@dataclass(frozen=True)
class Described:
    count: int
    min: object
    max: object
    total: object
    at: Mapping[str, Found]


def _known(df: DataFrame, value: Column) -> tuple[Column, DataType]:
    """A numeric expression and its type; NaN counts as missing."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if not isinstance(kind, NumericType):
        raise TypeError(f"order statistics need numbers, not {kind.simpleString()}")
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(~F.isnan(value), value).cast("double"), DoubleType()
    return value, kind


def _summable(value: Column, kind: DataType) -> Column:
    return value.cast("decimal(20,0)") if isinstance(kind, IntegralType) else value


def describe(df: DataFrame, columns: Mapping[str, tuple[Column, Mapping[str, Rank]]]) -> dict[str, Described]:
    """Count, range, sum and the values at the named ranks of every labelled numeric expression.

    NULL and NaN are left out; an expression without values has count 0 and no ranks.
    """
    exprs = {label: _known(df, value) for label, (value, _) in columns.items()}
    shares = {label: sorted({share for share, _ in ranks.values()}) for label, (_, ranks) in columns.items()}
    aggs = []
    for i, (label, (value, kind)) in enumerate(exprs.items()):
        aggs += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}"),
                 F.sum(_summable(value, kind)).alias(f"sum{i}")]
        if shares[label]:
            around = [end for s in shares[label] for end in (max(s - MARGIN, 0.0), min(s + MARGIN, 1.0))]
            aggs.append(F.percentile_approx(value, around, ACCURACY).alias(f"around{i}"))
    row = df.agg(*aggs).first()

    found: dict[str, dict[str, Found]] = {label: {} for label in columns}
    wanted: list[tuple[str, float, object, object]] = []  # label, share, bracket
    for i, label in enumerate(columns):
        if row[f"n{i}"]:
            for j, share in enumerate(shares[label]):
                wanted.append((label, share, *row[f"around{i}"][2 * j:2 * j + 2]))
    ends = {label: (row[f"min{i}"], row[f"max{i}"]) for i, label in enumerate(columns)}
    counts = {label: row[f"n{i}"] for i, label in enumerate(columns)}
    while wanted:
        brackets = []
        for label, share, low, high in wanted:
            ranks = {n: rank(counts[label]) for n, (s, rank) in columns[label][1].items() if s == share and n not in found[label]}
            brackets.append(_Bracket(*exprs[label], low, high, ranks))
        missed = []
        for (label, share, low, high), hits in zip(wanted, _search(df, brackets)):
            found[label] |= hits
            if any(s == share and n not in found[label] for n, (s, _) in columns[label][1].items()):
                if (low, high) == ends[label]:
                    raise ValueError(f"a rank of {label} lies outside its {counts[label]} values")
                missed.append((label, share, *ends[label]))
        wanted = missed
    return {
        label: Described(row[f"n{i}"], row[f"min{i}"], row[f"max{i}"], row[f"sum{i}"], found[label])
        for i, label in enumerate(columns)}


@dataclass(frozen=True)
class _Bracket:
    value: Column
    kind: DataType
    low: object
    high: object
    ranks: Mapping[str, int]


def _families(brackets: list[_Bracket]) -> list[tuple[str, list[int]]]:
    """Brackets that share one exact type: the decimals and whole numbers where they fit, the doubles."""
    exact = [i for i, b in enumerate(brackets) if not isinstance(b.kind, DoubleType)]
    digits = {i: (k.precision - k.scale, k.scale) if isinstance(k := brackets[i].kind, DecimalType) else (20, 0) for i in exact}
    families = [("double", [i for i, b in enumerate(brackets) if isinstance(b.kind, DoubleType)])]
    scale = max((s for _, s in digits.values()), default=0)
    if max((whole for whole, _ in digits.values()), default=0) + scale <= 38:
        families.append((f"decimal(38,{scale})", exact))
    else:
        families += [(brackets[i].kind.simpleString(), [i]) for i in exact]
    return [(kind, members) for kind, members in families if members]


def _search(df: DataFrame, brackets: list[_Bracket]) -> list[dict[str, Found]]:
    """For each bracket the ranks that fall into it."""
    found: list[dict[str, Found]] = [{} for _ in brackets]
    if all(b.low == b.high for b in brackets):
        known = df.agg(*[
            F.count_if(place).alias(f"{name}{i}") for i, b in enumerate(brackets)
            for name, place in (("below", b.value < F.lit(b.low)), ("same", b.value == F.lit(b.low)))]).first()
        for i, b in enumerate(brackets):
            below, same = known[f"below{i}"], known[f"same{i}"]
            found[i] = {name: Found(b.low, same, rank - below) for name, rank in b.ranks.items() if below <= rank < below + same}
        return found
    for kind, members in _families(brackets):
        def cell(key: int, value) -> Column:
            return F.struct(F.lit(key).alias("key"), value.cast(kind).alias("value"))

        # All values below a bracket become one row, a NULL with their count, that sorts first.
        cells = [
            F.when(b.value < F.lit(b.low), cell(i, F.lit(None))).when(b.value <= F.lit(b.high), cell(i, b.value))
            for i, b in ((i, brackets[i]) for i in members)]
        values = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")
        counted = values.groupBy("key", "value").agg(F.count("*").alias("n"))
        rows = Ordered.of(counted, [F.asc("key"), F.asc_nulls_first("value")]).rows

        targets = []
        before = dict.fromkeys(members, 0)
        totals = rows.groupBy("key", BUCKET).agg(F.sum("n").alias("n")).collect()  # brackets x sort partitions at most
        for total in sorted(totals, key=lambda r: (r["key"], r[BUCKET])):
            start = before[total["key"]]
            for name, rank in brackets[total["key"]].ranks.items():
                if start <= rank < start + total.n:
                    targets.append((total["key"], total[BUCKET], name, rank - start))
            before[total["key"]] = start + total.n
        if not targets:
            continue
        wanted = df.sparkSession.createDataFrame(targets, f"key int, {BUCKET} int, name string, rank bigint")
        upto = Window.partitionBy("key", "name").orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hits = (
            rows.join(F.broadcast(wanted), ["key", BUCKET])  # one row per bracket and rank
            .withColumn("upto", F.sum("n").over(upto))
            .filter(F.col("upto") > F.col("rank"))
            .groupBy("key", "name")
            .agg(F.min_by(F.struct("value", "n", (F.col("rank") - F.col("upto") + F.col("n")).alias("place")), POS).alias("hit"))
        )
        for row in hits.collect():
            if row.hit.value is not None:
                found[row["key"]][row["name"]] = Found(*row.hit)
    return found


def ntile_by_borders(df: DataFrame, scores: Mapping[str, Column], key: str, tiles: int) -> DataFrame:
    """`df` with an NTILE of all rows per score, by rising value and then rising `key`, unique and numeric.

    Only the first row of each tile is looked for: its value, then its key among the rows with that
    value. All rows are scored by comparison with these. `df` is read several times: write it before.
    """
    def starts(n: int) -> list[int]:
        small, extra = divmod(n, tiles)
        return [k * small + min(k, extra) for k in range(1, tiles)]

    def at(k: int) -> Rank:
        return (k + 1) / tiles, lambda n: min(starts(n)[k], n - 1)

    values = describe(df, {name: (value, {str(k): at(k) for k in range(tiles - 1)}) for name, value in scores.items()})
    ties = {}
    for name, value in scores.items():
        for k, start in enumerate(starts(values[name].count)):
            if start < values[name].count:
                first = values[name].at[str(k)]
                held = F.when(value == F.lit(first.value), F.col(key))
                ties[f"{name} {k}"] = held, {"key": (first.place / first.rows, lambda n, place=first.place: place)}
    keys = describe(df, ties) if ties else {}
    scored = {}
    for name, value in scores.items():
        passed = F.lit(1)
        for k in range(tiles - 1):
            if f"{name} {k}" in keys:
                first, first_key = F.lit(values[name].at[str(k)].value), F.lit(keys[f"{name} {k}"].at["key"].value)
                passed += ((value > first) | ((value == first) & (F.col(key) >= first_key))).cast("int")
        scored[name] = passed
    return df.withColumns(scored)
