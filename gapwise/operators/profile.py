"""Table profiling: counts, nulls, duplicates, bounds, value counts, describe.

Every report is one aggregate job over the table (plus, where a share of all
rows is needed, the row count as a scalar subquery). Value histograms use the
hash aggregate's map-side combine, so a value that owns a third of the rows
costs one partial row per task, not a hot partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.functions.scalars import epoch_micros, safe_div


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one column per input column: its number of nulls."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def nonnull_share(df: DataFrame, col: str) -> DataFrame:
    """Non-null count of ``col`` and its share of all rows: (col, col_relative)."""
    return df.agg(F.count(col).alias(col), safe_div(F.count(col), F.count(F.lit(1))).alias(f"{col}_relative"))


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """n_rows, n_unique_rows and n_duplicates = rows - distinct rows (nulls compare equal).

    One grouping over the full row; partial aggregation collapses hot duplicate
    groups before the shuffle.
    """
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_unique_rows")).withColumn(
        "n_duplicates", F.col("n_rows") - F.col("n_unique_rows"))


def dedup_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct rows (any order). With ``cols``, project first."""
    return (df.select(*cols) if cols else df).distinct()


def time_bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def value_counts(df: DataFrame, col: str, sort: bool = True) -> DataFrame:
    """(col, count), most frequent first; ties ordered by value."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), F.asc_nulls_first(col)) if sort else out


def value_proportions(df: DataFrame, col: str, sort: bool = True) -> DataFrame:
    """(col, proportion): share of all rows; the total is a scalar subquery, not a global window."""
    total = df.agg(F.count(F.lit(1))).scalar()
    out = df.groupBy(col).agg((F.count(F.lit(1)) / total).alias("proportion"))
    return out.orderBy(F.desc("proportion"), F.asc_nulls_first(col)) if sort else out


def _as_text(df: DataFrame, c: str) -> Column:
    """The value as text; timestamps as epoch microseconds."""
    return (epoch_micros(c) if _kind(df, c) == "time" else F.col(c)).cast("string")


def profile_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Value counts and proportions of every column in one job.

    Columns are unpivoted to (column, value-as-text) and grouped once, instead
    of one scan per column. Output: column, value, count, proportion.
    """
    cols = cols or df.columns
    total = df.agg(F.count(F.lit(1))).scalar()
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _as_text(df, c).alias("value")) for c in cols])).alias("_kv")
    ).select("_kv.column", "_kv.value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")).withColumn(
        "proportion", F.col("count") / total)


# Fixed statistic names and order of the describe table.
DESCRIBE_STATS = ["count", "null_count", "mean", "std", "min", "25%", "50%", "75%", "max"]
DESCRIBE_QUANTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}

_ACCURACY = 10_000        # a sketch's rank is wrong by a part in so many, at most
_GRID = 2_000             # values read off the sketch of a bracket


def _kind(df: DataFrame, c: str) -> str:
    t = df.schema[c].dataType
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(t, (T.TimestampNTZType, T.TimestampType)):
        return "time"
    if isinstance(t, (T.IntegralType, T.BooleanType)):
        return "int"
    return "text"


def _numeric(df: DataFrame, c: str) -> Column:
    """The value describe works on: booleans as 0/1, timestamps as epoch µs, text as it is."""
    k = _kind(df, c)
    if k == "time":
        return epoch_micros(c)
    return F.col(c).cast({"float": "double", "int": "long", "text": "string"}[k])


def nearest_rank(n: int, q: float) -> int:
    """0-based index of the q-quantile among n sorted values: round half up of (n-1)·q."""
    return int(math.floor((n - 1) * q + 0.5))


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float]) -> dict[tuple[str, float], float | None]:
    """Exact nearest-rank quantiles of several number, time or boolean columns; null for a column without values."""
    keys = df.select(*[_numeric(df, c).alias(f"x{i}") for i, c in enumerate(cols)]).persist()
    try:
        names = [f"x{i}" for i in range(len(cols))]
        row = keys.agg(*[x for c in names for x in (F.count(c), F.min(c), F.max(c), _brackets(c, qs))]).first()
        found, _ = _quantiles(keys, {c: tuple(row[4 * i: 4 * i + 4]) for i, c in enumerate(names)}, qs)
        return {(c, q): found[n, q] for n, c in zip(names, cols) for q in qs}
    finally:
        keys.unpersist()


def _brackets(c: str, qs: list[float]) -> Column:
    """Sketched values on both sides of each quantile, further from it than the sketch may be wrong."""
    slack = 2 / _ACCURACY
    return F.percentile_approx(c, [p for q in qs for p in (max(0.0, q - slack), min(1.0, q + slack))], _ACCURACY)


def _nan_last(v):
    return v != v, v


def _quantiles(keys: DataFrame, stats: dict[str, tuple], qs: list[float], more: list[Column] | None = None) -> tuple[dict, dict]:
    """(column, q) -> value, and the values of the aggregates ``more``, which share the first pass.

    ``stats`` has (count, least, largest, brackets) of each column. A pass counts the
    rows below, inside and at the ends of every bracket, which settles whether it holds the rank, and
    sketches the values inside. Up to ``_GRID / 2`` of them the sketch is exact; else it gives the
    next, hundreds of times narrower bracket. A bracket that turns out wrong,
    as may happen with few rows, becomes the column's bounds.
    """
    out: dict[tuple[str, float], float | None] = {(c, q): None for c in stats for q in qs}
    open_ = {(c, q): (stats[c][3][2 * i], stats[c][3][2 * i + 1]) for c in stats if stats[c][0] for i, q in enumerate(qs)}
    extra: dict = {}
    while open_ or more:
        brackets = sorted({(c, *b) for (c, _), b in open_.items()}, key=repr)
        aggs = []
        for c, lo, hi in brackets:
            x, kind = F.col(c), keys.schema[c].dataType
            lo, hi = F.lit(lo).cast(kind), F.lit(hi).cast(kind)
            inside = (x >= lo) & (x <= hi)
            grid = F.percentile_approx(F.when(inside, x), [i / _GRID for i in range(_GRID + 1)], _ACCURACY)
            aggs += [F.count_if(x < lo), F.count_if(inside), F.count_if(x == lo), F.count_if(x == hi), F.min(F.when(inside & (x > lo), x)),
                     F.max(F.when(inside & (x < hi), x)), grid]
        row = keys.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)], *(more or [])).first()
        if more:
            extra, more = {k: v for k, v in row.asDict().items() if k not in {f"a{i}" for i in range(len(aggs))}}, None
        for (c, q), (lo, hi) in list(open_.items()):
            at = 7 * brackets.index((c, lo, hi))
            below, inside, least, most, following, preceding, grid = row[at: at + 7]
            rank = nearest_rank(stats[c][0], q) - below
            if not 0 <= rank < inside:
                open_[c, q] = stats[c][1:3]
            elif rank < least or rank >= inside - most or inside <= _GRID // 2:
                out[c, q] = float(lo if rank < least else hi if rank >= inside - most else grid[math.floor((rank + 0.5) / inside * _GRID)])
                del open_[c, q]
            else:        # both ends are ruled out, so that the next bracket is narrower in any case
                slack, mid = 2 + math.ceil(2 * _GRID / _ACCURACY), (rank + 1) / inside * _GRID
                open_[c, q] = (max(following, grid[max(0, math.floor(mid) - slack)], key=_nan_last),
                               min(preceding, grid[min(_GRID, math.ceil(mid) + slack)], key=_nan_last))
    return out, extra


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long statistics table: one row per statistic, one column per input column.

    count, null_count, mean, std (sample), min, 25/50/75 % and max, as doubles.
    Booleans count as 0/1, timestamps as epoch microseconds. Quantiles are exact
    nearest-rank (index round((n-1)·q) of the sorted non-null values). Text,
    dates and other types have count, null_count, min and max, as text.

    The columns are read once and kept while two or three aggregates run. The mean
    and deviation of whole numbers come from exact decimal sums of the distances
    from the minimum; where 38 digits do not hold their squares, and for
    doubles, from Spark's running (overflow-safe) deviation.
    """
    cols = cols or df.columns
    kinds = {f"x{i}": _kind(df, c) for i, c in enumerate(cols)}
    keys = df.select(*[_numeric(df, c).alias(f"x{i}") for i, c in enumerate(cols)]).persist()
    try:
        qs = list(DESCRIBE_QUANTILES.values())
        first = keys.agg(F.count(F.lit(1)), *[x for c, k in kinds.items() for x in (
            F.count(c), F.min(c), F.max(c), F.lit(None) if k == "text" else _brackets(c, qs))]).first()
        rows = first[0]
        stats = {c: tuple(first[4 * i + 1: 4 * i + 5]) for i, c in enumerate(kinds)}
        aggs = []
        for c, kind in kinds.items():
            if kind == "text":
                continue
            if kind == "float":
                aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
                continue
            big = F.col(c).cast("decimal(38,0)")
            d = big - F.lit(stats[c][1] or 0).cast("decimal(38,0)")
            n = F.count(c)
            dec = n.cast("decimal(38,0)")
            spread = F.try_subtract(F.try_multiply(dec, F.try_sum(F.try_multiply(d, d))), F.try_multiply(F.sum(d), F.sum(d)))
            exact = F.sqrt(F.try_divide(spread.cast("double"), (n * (n - 1)).cast("double")))
            aggs += [F.try_divide(F.sum(big).cast("double"), n.cast("double")).alias(f"mean_{c}"),
                     F.coalesce(exact, F.stddev_samp(d.cast("double"))).alias(f"std_{c}")]
        quant, moments = _quantiles(keys, {c: stats[c] for c, k in kinds.items() if k != "text"}, qs, aggs)
    finally:
        keys.unpersist()
    table = []
    for stat in DESCRIBE_STATS:
        row: list = [stat]
        for c, kind in kinds.items():
            n, lo, hi, _ = stats[c]
            value = {"count": n, "null_count": rows - n, "min": lo, "max": hi}.get(stat)
            if kind == "text":
                row.append(None if value is None else str(value))
                continue
            if stat in ("mean", "std"):
                value = moments[f"{stat}_{c}"]
            elif stat in DESCRIBE_QUANTILES:
                value = quant[c, DESCRIBE_QUANTILES[stat]]
            row.append(None if value is None else float(value))
        table.append(tuple(row))
    schema = T.StructType([T.StructField("statistic", T.StringType())] + [
        T.StructField(name, T.StringType() if kinds[f"x{i}"] == "text" else T.DoubleType()) for i, name in enumerate(cols)])
    return df.sparkSession.createDataFrame(table, schema).coalesce(1)
