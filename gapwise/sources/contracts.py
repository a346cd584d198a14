"""Schema contracts: declared ``StructType``s, union, widening-only casts and violation counts.

A contract says which columns exist, their types and whether nulls are allowed.
``violations`` checks a DataFrame against one in a single aggregate pass, ``Watch`` and
``checked_write`` while rows pass through a job anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.runtime import drop_scratch

UINT16, UINT32 = 2 ** 16 - 1, 2 ** 32 - 1


def _f(name: str, dtype: T.DataType, nullable: bool = False, most: int | None = None) -> T.StructField:
    """A field; ``most`` bounds an unsigned number, which Spark holds in a wider signed type."""
    return T.StructField(name, dtype, nullable, {} if most is None else {"min": 0, "max": most})


# Fixed column names and types of the click log (unsigned 32 -> bigint,
# unsigned 16 -> int, naive µs datetime -> timestamp_ntz).
BASE = T.StructType([
    _f("ip", T.LongType(), most=UINT32),
    _f("app", T.LongType(), most=UINT32),
    _f("device", T.IntegerType(), most=UINT16),
    _f("os", T.IntegerType(), most=UINT16),
    _f("channel", T.IntegerType(), most=UINT16),
    _f("click_time", T.TimestampNTZType()),
])
TRAIN_EXTRA = T.StructType([
    _f("attributed_time", T.TimestampNTZType(), nullable=True),
    _f("is_attributed", T.BooleanType()),
])
TEST_EXTRA = T.StructType([_f("click_id", T.LongType(), most=UINT32)])
EXTENDED = T.StructType([
    _f("click_timestamp", T.LongType(), most=UINT32),
    _f("previous_sessions", T.LongType(), most=UINT32),
    _f("total_sessions", T.LongType(), most=UINT32),
    _f("current_session_duration_till_now", T.LongType(), most=UINT32),
    _f("current_session_duration", T.LongType(), most=UINT32),
    _f("avg_previous_sessions_duration", T.DoubleType()),
])

LABEL = "is_attributed"


class ContractError(ValueError):
    pass


def merge(*schemas: T.StructType) -> T.StructType:
    """Union of contracts by column name; a later field replaces an earlier one in place."""
    out: dict[str, T.StructField] = {}
    for s in schemas:
        for f in s.fields:
            out[f.name] = f
    return T.StructType(list(out.values()))


TRAIN = merge(BASE, TRAIN_EXTRA)
TEST = merge(BASE, TEST_EXTRA)

# The driver's ``events`` table seen through the click adapter: ``app`` is the
# event type (a string) and there is no device / os.
CLICK_EVENTS = T.StructType([
    _f("click_id", T.LongType()),
    _f("ip", T.LongType()),
    _f("app", T.StringType()),
    _f("channel", T.IntegerType()),
    _f("click_time", T.TimestampNTZType()),
    _f("attributed_time", T.TimestampNTZType(), nullable=True),
    _f("is_attributed", T.BooleanType()),
])

_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}
_FLOAT_RANK = {T.FloatType: 1, T.DoubleType: 2}


def is_widening(src: T.DataType, dst: T.DataType) -> bool:
    """True if every value of ``src`` fits ``dst`` exactly (same type counts)."""
    if src == dst:
        return True
    si, di = _INT_RANK.get(type(src)), _INT_RANK.get(type(dst))
    if si and di:
        return si <= di
    sf, df = _FLOAT_RANK.get(type(src)), _FLOAT_RANK.get(type(dst))
    if sf and df:
        return sf <= df
    if si and isinstance(dst, T.DoubleType):
        return si <= 3
    return False


def check_widening(actual: T.StructType, contract: T.StructType) -> list[tuple[str, str]]:
    """Schema-level problems: (column, rule) for missing columns and narrowing casts."""
    have = {f.name: f.dataType for f in actual.fields}
    problems = []
    for f in contract.fields:
        if f.name not in have:
            problems.append((f.name, "missing"))
        elif not is_widening(have[f.name], f.dataType):
            problems.append((f.name, "narrowing_type"))
    return problems


def conform(df: DataFrame, contract: T.StructType, allow_widening: bool = True) -> DataFrame:
    """Project ``df`` onto the contract's columns and types.

    Integers may widen, never narrow (a narrowing request raises before any
    data is read). The select keeps only contract columns, so the scan reads
    nothing else.
    """
    problems = check_widening(df.schema, contract) if allow_widening else [
        (f.name, "type") for f in contract.fields
        if f.name not in df.columns or df.schema[f.name].dataType != f.dataType]
    if problems:
        raise ContractError(f"schema does not satisfy contract: {problems}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def _checks(schema: T.StructType, contract: T.StructType, rules: dict[str, Column] | None = None) -> list[tuple[str, str, Column]]:
    """(column, rule, count of violating rows) of every check."""
    schema_problems = dict(check_widening(schema, contract))
    checks: list[tuple[str, str, Column]] = []
    for f in contract.fields:
        if f.name in schema_problems:
            checks.append((f.name, schema_problems[f.name], F.count(F.lit(1))))
            continue
        if not f.nullable:
            checks.append((f.name, "not_null", F.count_if(F.col(f.name).isNull())))
        if "max" in f.metadata:
            outside = ~F.col(f.name).between(f.metadata["min"], f.metadata["max"])
            checks.append((f.name, "bounds", F.count_if(F.coalesce(outside, F.lit(False)))))
    for name, pred in (rules or {}).items():
        checks.append(("*", name, F.count_if(~F.coalesce(pred, F.lit(False)))))
    return checks


def violations(df: DataFrame, contract: T.StructType, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row per check: (column, rule, n_violations, ok).

    Schema checks (missing / narrowing type) count every row as violating.
    Null checks cover the non-nullable contract columns, bound checks the
    unsigned ones (nulls are no bound violations). ``rules`` adds
    row predicates that must hold (counted where the predicate is false).
    All counts come from one aggregate; the result is unpivoted with ``stack``.
    """
    checks = _checks(df.schema, contract, rules)
    if not checks:
        return df.sparkSession.createDataFrame([], VIOLATIONS)
    agg = df.agg(*[c.cast("long").alias(f"_v{i}") for i, (_, _, c) in enumerate(checks)])
    args = ", ".join(f"'{col}', '{rule}', _v{i}" for i, (col, rule, _) in enumerate(checks))
    return (agg.selectExpr(f"stack({len(checks)}, {args}) AS (`column`, rule, n_violations)")
            .withColumn("ok", F.col("n_violations") == 0))


VIOLATIONS = "column string, rule string, n_violations long, ok boolean"


class Watch:
    """Counts a contract's violations among the rows that pass through :attr:`df`, as part of the job that uses it.

    Nothing is read for the checks alone. The counts are there once an action on a
    frame made from :attr:`df` is done; an action that does not need all rows counts those it needed.
    """

    def __init__(self, df: DataFrame, contract: T.StructType, rules: dict[str, Column] | None = None):
        self.checks = _checks(df.schema, contract, rules)
        self.seen = Observation()
        # the first metric keeps an observation of a contract without checks valid
        self.df = df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *[c.cast("long").alias(f"v{i}") for i, (_, _, c) in enumerate(self.checks)])

    def counts(self) -> list[tuple[str, str, int, bool]]:
        """(column, rule, n_violations, ok) of every check."""
        got = self.seen.get
        return [(col, rule, int(got.get(f"v{i}") or 0), not got.get(f"v{i}")) for i, (col, rule, _) in enumerate(self.checks)]


def _raise_if_broken(*found: tuple[str, list[tuple[str, str, int, bool]]]) -> None:
    broken = [(side, *row[:3]) for side, rows in found for row in rows if not row[3]]
    if broken:
        raise ContractError(f"contract violated (side, column, rule, rows): {broken}")


def checked_write(df: DataFrame, transform, before: T.StructType, after: T.StructType, path: str,
                  before_rules: dict[str, Column] | None = None, after_rules: dict[str, Column] | None = None) -> DataFrame:
    """``transform(df)`` written as Parquet to ``path`` and read again, its input and output checked on the way.

    A contract that needs other columns or types fails before anything is read. Rows
    that break a contract are counted while the result is written; then the files
    are deleted and ContractError names the broken checks.
    """
    conform(df, before)
    into = Watch(df, before, before_rules)
    out = transform(into.df)
    conform(out, after)
    onto = Watch(out, after, after_rules)
    onto.df.write.parquet(path)
    try:
        _raise_if_broken(("input", into.counts()), ("output", onto.counts()))
    except ContractError:
        drop_scratch(df.sparkSession, path)
        raise
    return df.sparkSession.read.schema(out.schema).parquet(path)


def validate(df: DataFrame, contract: T.StructType, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` itself if it satisfies the contract; raises ContractError naming the broken checks otherwise. Reads ``df`` once for that."""
    broken = [(r["column"], r["rule"], r["n_violations"]) for r in violations(df, contract, rules).where("not ok").collect()]
    if broken:
        raise ContractError(f"contract violated (column, rule, rows): {broken}")
    return df


def checked(df: DataFrame, transform, before: T.StructType, after: T.StructType) -> DataFrame:
    """``transform(df)``, with a contract on what goes in and one on what comes out; each result row is computed once."""
    from gapwise.runtime import scratch_dir
    return checked_write(df, transform, before, after, scratch_dir(df.sparkSession, "checked"))
