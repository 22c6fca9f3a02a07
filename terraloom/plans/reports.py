"""Dataset profiles and guarded query batches."""

from __future__ import annotations

import math
import re
import time
import uuid
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct non-null values per column.

    Each column is scanned alone and its repeats collapse before the shuffle; no
    task holds a column's values.
    """
    def count(name: str) -> DataFrame:
        values = df.select(F.col(f"`{name}`").alias("v")).where("v IS NOT NULL").distinct()
        return values.agg(F.count("*").alias("distinct_values")).select(F.lit(name).alias("column_name"), "distinct_values")

    return reduce(DataFrame.unionByName, [count(c) for c in df.columns])


#: Relative error of the sketches that narrow a quantile's range, and from how many rows in it they are sorted out by value.
SKETCH_ACCURACY = 10_000
FEW_ROWS = 100_000


def exact_quantiles(df: DataFrame, columns: list[str], quantiles: tuple[float, ...] = (0.25, 0.5, 0.75),
                    accuracy: int = SKETCH_ACCURACY, few: int = FEW_ROWS) -> DataFrame:
    """``column_name, quantile, value``: the smallest value that at least that share of a column's numbers does not exceed.

    Distributed selection by value, without a sort. Each round narrows every open quantile's range to two values that
    a sketch of the range puts on both sides of its rank, and counts the rows below, at and between
    them, so a wrong sketch costs a round and never a wrong answer. A round reads the table twice and brings a few
    numbers per quantile to the driver; the range shrinks about ``accuracy / 4`` times. Once at most ``few`` rows are
    inside, they are grouped by value. Values count as doubles; null and NaN are left out, and a column without
    numbers has a null quantile.
    """
    spark = df.sparkSession
    schema = "column_name string, quantile double, value double"
    if not columns or not quantiles:
        return spark.createDataFrame([], schema)
    numbers = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    first = numbers.agg(*[f(f"c{i}").alias(f"{n}{i}") for i in range(len(columns)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    found: dict[tuple[int, float], float | None] = {}
    # Open ranges: both ends are known not to be the answer, or infinite; rank counts from the lower end.
    opened: dict[tuple[int, float], tuple[float | None, float | None, int, int]] = {}
    for i in range(len(columns)):
        for q in quantiles:
            rank = max(1, math.ceil(Fraction(str(q)) * first[f"n{i}"]))
            if not first[f"n{i}"] or first[f"lo{i}"] == first[f"hi{i}"]:
                found[i, q] = first[f"lo{i}"]
            else:
                opened[i, q] = (None, None, rank, first[f"n{i}"])

    def inside(i: int, low: float | None, high: float | None):
        c = F.col(f"c{i}")
        return c.isNotNull() & (F.lit(True) if low is None else c > F.lit(low)) & (F.lit(True) if high is None else c < F.lit(high))

    while wide := {key: span for key, span in opened.items() if span[3] > few}:
        keys = list(wide)
        slack = 2.0 / accuracy
        sketches = []
        for j, (i, _) in enumerate(keys):
            low, high, rank, rows = wide[keys[j]]
            cuts = F.array(*[F.lit(min(max(rank / rows + s, 0.0), 1.0)) for s in (-slack, slack)])
            sketches.append(F.percentile_approx(F.when(inside(i, low, high), F.col(f"c{i}")), cuts, accuracy).alias(f"s{j}"))
        ends = numbers.agg(*sketches).first()
        counts = []
        for j, (i, _) in enumerate(keys):
            (low, high, _, _), (a, b), c = wide[keys[j]], ends[j], F.col(f"c{i}")
            counts += [F.count_if(inside(i, low, a)), F.count_if(c == F.lit(a)), F.count_if(inside(i, a, b)), F.count_if(c == F.lit(b))]
        seen = numbers.agg(*[c.alias(f"n{k}") for k, c in enumerate(counts)]).first()
        for j, key in enumerate(keys):
            low, high, rank, rows = wide[key]
            (a, b), (below, at_a, between, at_b) = ends[j], seen[4 * j : 4 * j + 4]
            if a == b:
                between = at_b = 0
            del opened[key]
            if rank <= below:
                opened[key] = (low, a, rank, below)
            elif rank <= below + at_a:
                found[key] = a
            elif rank <= below + at_a + between:
                opened[key] = (a, b, rank - below - at_a, between)
            elif rank <= below + at_a + between + at_b:
                found[key] = b
            else:
                rest = below + at_a + between + at_b
                opened[key] = (b, high, rank - rest, rows - rest)
    done = spark.createDataFrame([(columns[i], float(q), v) for (i, q), v in found.items()], schema)
    if not opened:
        return done
    left = [
        F.when(inside(i, low, high), F.struct(F.lit(columns[i]).alias("column_name"), F.lit(float(q)).alias("quantile"), F.lit(rank).alias("rank"), F.col(f"c{i}").alias("value")))
        for (i, q), (low, high, rank, _) in opened.items()
    ]
    key = ["column_name", "quantile", "rank"]
    values = numbers.select(F.inline(F.array_compact(F.array(*left)))).groupBy(*key, "value").agg(F.count("*").alias("copies"))
    upto = Window.partitionBy(*key).orderBy("value")
    reached = values.withColumn("upto", F.sum("copies").over(upto)).where("upto >= rank").groupBy(*key).agg(F.min("value").alias("value"))
    return done.unionByName(reached.drop("rank"))


def profile(df: DataFrame, exact: bool = False, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, extremes, mean, deviation, quantiles.

    Quantiles and distinct counts are sketches unless ``exact``. Numbers, other
    columns and sketches are aggregated apart: together, the sketches would take the
    plain aggregates out of generated code. Nested columns are left out.
    """
    columns = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    names = ["nulls", "distinct_values", "min_value", "max_value", "mean", "std", *[f"q{q * 100:g}" for q in quantiles]]
    no_double, no_long = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    cuts = F.array(*[F.lit(q) for q in quantiles])
    numbers, others, sketches = [F.count("*").alias("rows")], [], []
    have = set()

    def add(part: list, i: int, **stats) -> None:
        part += [v.alias(f"{i}_{k}") for k, v in stats.items()]
        have.update(f"{i}_{k}" for k in stats)

    for i, field in enumerate(columns):
        c = F.col(f"`{field.name}`")
        number = isinstance(field.dataType, NUMBERS)
        add(numbers if number else others, i, filled=F.count(c), min_value=F.min(c).cast("string"), max_value=F.max(c).cast("string"))
        if number:
            add(numbers, i, mean=F.avg(c.cast("double")), std=F.stddev_samp(c.cast("double")))
        if number and not exact:
            add(sketches, i, cuts=F.percentile_approx(c.cast("double"), cuts))
        if not exact:
            add(sketches, i, distinct_values=F.approx_count_distinct(c))
    one = F.lit(1).alias("_one")
    wide = reduce(
        lambda left, right: left.join(right, "_one"), [df.agg(*part).select(one, "*") for part in (numbers, others, sketches) if part]
    )

    def value(i: int, name: str, missing):
        return F.col(f"`{i}_{name}`") if f"{i}_{name}" in have else missing

    def row(i: int, field: T.StructField):
        stats = [
            (F.col("rows") - value(i, "filled", None)).alias("nulls"), value(i, "distinct_values", no_long).alias("distinct_values"),
            *[value(i, n, None).alias(n) for n in ("min_value", "max_value")], *[value(i, n, no_double).alias(n) for n in ("mean", "std")],
            *[(F.get(f"`{i}_cuts`", F.lit(j)) if f"{i}_cuts" in have else no_double).alias(n) for j, n in enumerate(names[6:])],
        ]
        return F.struct(F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("column_type"), "rows", *stats)

    out = wide.select(F.explode(F.array(*[row(i, f) for i, f in enumerate(columns)])).alias("r")).select("r.*")
    if exact:
        counts = distinct_counts(df.select(*[F.col(f"`{f.name}`") for f in columns]))
        out = out.drop("distinct_values").join(counts, "column_name", "left").fillna(0, ["distinct_values"])
        found = exact_quantiles(df, [f.name for f in columns if isinstance(f.dataType, NUMBERS)], quantiles)
        wide_cuts = found.groupBy("column_name").agg(*[F.max(F.when(F.col("quantile") == q, F.col("value"))).alias(n) for q, n in zip(quantiles, names[6:])])
        out = out.drop(*names[6:]).join(wide_cuts, "column_name", "left")
    return out.select("column_name", "column_type", "rows", *names)


def signature(df: DataFrame) -> DataFrame:
    """Row count and an order-free content hash that other engines can repeat.

    A row is the text of its columns by name, nulls as an empty cell after ``N`` and others
    after ``V``; the first 15 hex digits of its md5 are a number, and the numbers are summed.
    """
    cells = [
        F.when(F.col(f"`{c}`").isNull(), F.lit("N")).otherwise(F.concat(F.lit("V"), F.col(f"`{c}`").cast("string"))) for c in sorted(df.columns)
    ]
    row = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *cells).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row), F.lit(0)).cast("string").alias("signature"))


def sample_rows(df: DataFrame, limit: int = 30) -> DataFrame:
    return df.limit(limit)


_OWN_LIMIT = re.compile(r"\blimit\s+(\d+|all)(\s+offset\s+\d+)?\s*$", re.IGNORECASE)


def guarded(spark: SparkSession, sql: str, limit: int = 30) -> DataFrame:
    """A read-only query, with a default row limit where it ends without one.

    The text runs as a subquery, where only a single query is valid: commands,
    writes and statement lists are refused by the SQL grammar itself.
    """
    text = sql.strip().rstrip(";").rstrip()
    tail = "" if _OWN_LIMIT.search(text) else f" LIMIT {int(limit)}"
    return spark.sql(f"SELECT * FROM (\n{text}\n){tail}")


INDEX = "run_id string, name string, status string, row_count bigint, duration double, path string, error string"


def run_queries(spark: SparkSession, queries: dict[str, str], out_dir: str, limit: int = 30,
                run_id: str | None = None) -> DataFrame:
    """Run each query, save its result under the run's folder, and index counts, durations and failures.

    A failing query is recorded and does not stop the others.
    """
    run_id = run_id or uuid.uuid4().hex
    rows = []
    for name, sql in queries.items():
        path, started = f"{out_dir}/run_id={run_id}/{name}", time.monotonic()
        try:
            guarded(spark, sql, limit).write.parquet(path)
            count = spark.read.parquet(path).count()
            rows.append((run_id, name, "ok", count, time.monotonic() - started, path, None))
        except Exception as problem:
            text = str(problem).strip().splitlines()
            rows.append((run_id, name, "failed", None, time.monotonic() - started, None, text[0] if text else type(problem).__name__))
    return spark.createDataFrame(rows, INDEX)


def append_run(index: DataFrame, table_dir: str) -> DataFrame:
    """Put a run's index rows into the table of all runs.

    A run that is written again takes the place of its own rows and of no others, and its
    rows show once the write commits, so a repeated or failed write neither doubles nor halves a run.
    """
    index.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(table_dir)
    return index.sparkSession.read.parquet(table_dir)
