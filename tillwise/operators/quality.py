"""Data quality profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.scale import running_total


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required columns that the table lacks, sorted."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required, name: str = "table") -> DataFrame:
    """The table itself, or an error that names what is missing."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{name} missing columns: {missing}")
    return df


def _unpivot_counts(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One scan; one output row per column with the given ``measures`` (name -> function of the column)."""
    one = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[make(c).alias(f"{m}:{c}") for c in columns for m, make in measures.items()])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("n_rows"), *[F.col(f"`{m}:{c}`").alias(m) for m in measures])
            for c in columns]
    return one.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """Rows and NULLs per column."""
    return _unpivot_counts(df, df.columns, {"n_null": lambda c: F.count_if(F.col(c).isNull())})


def numeric_profile(df: DataFrame) -> DataFrame:
    """Count, mean, spread and range of the numeric columns."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    as_double = lambda c: F.col(c).cast("double")
    return _unpivot_counts(df, numeric, {
        "n": lambda c: F.count(c), "mean": lambda c: F.avg(as_double(c)), "std": lambda c: F.stddev(as_double(c)),
        "min": lambda c: F.min(as_double(c)), "max": lambda c: F.max(as_double(c))})


def chk_required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Per required column: present or not, and how many of its values are filled."""
    here = [c for c in required if c in df.columns]
    filled = _unpivot_counts(df, here, {"n_filled": lambda c: F.count(c)}) if here else None
    absent = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[F.lit(c) for c in missing_columns(df, required)])).alias("column_name"), "n_rows",
        F.lit(0).cast("long").alias("n_filled")) if missing_columns(df, required) else None
    parts = [p.withColumn("is_present", F.lit(flag)) for p, flag in ((filled, True), (absent, False)) if p is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def schema_adherence(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared against actual type of every column, with the filled rows of those that exist."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in declared}
    names = list(wanted) + [c for c in actual if c not in wanted]
    counts = chk_required_columns(df, names)

    def lookup(types: dict[str, str]):
        return F.try_element_at(F.create_map(*[F.lit(v) for kv in types.items() for v in kv]), F.col("column_name"))

    expected, found = lookup(wanted), lookup(actual)
    return counts.select("column_name", expected.alias("declared_type"), found.alias("actual_type"),
                         F.coalesce(expected == found, F.lit(False)).alias("matches"), "n_filled")


def date_coverage(df: DataFrame, date: str, by: list[str] | None = None, step_days: int = 1) -> DataFrame:
    """First and last date, periods present and periods missing in between."""
    day = F.to_date(date)
    span = F.date_diff("last_date", "first_date") / step_days
    return (df.groupBy(*(by or [])).agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"),
                                        F.count_distinct(day).alias("n_present"))
            .withColumn("n_missing", F.floor(span).cast("long") + 1 - F.col("n_present")))


def missing_dates(df: DataFrame, date: str, step_days: int = 1) -> DataFrame:
    """Calendar dates without any row."""
    present = df.select(F.to_date(date).alias("date")).distinct()
    calendar = present.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(
        F.explode(F.sequence("a", "b", F.make_dt_interval(F.lit(step_days)))).alias("date"))
    return calendar.join(present, "date", "left_anti")


def outlier_profile(df: DataFrame, columns: list[str], k: float = 1.5) -> DataFrame:
    """Quartiles and the rows outside the fences ``k`` quartile ranges away, per measure.

    All measures are ranked together: equal values are counted per (measure, value), one range order and its offsets
    place them, and both the ranks and the rows beyond the fences are read off these counts. So the table itself is
    read once, whatever the number of measures, and nothing returns to the driver.
    """
    values = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in columns])
    counted = (df.select(F.inline(values)).where(F.col("v").isNotNull()).groupBy("measure", "v")
               .agg(F.count("*").alias("times")))
    ranked = running_total(counted, [F.asc("measure"), F.asc("v")], "times", "upto")
    # one row per measure: its size, and where its ranks begin
    before = Window.orderBy("measure").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("measure").agg(F.sum("times").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = F.array(*[F.struct(F.lit(p).alias("prob"), (F.lit(p) * (F.col("n") - 1)).alias("pos")) for p in (0.25, 0.75)])
    upto = F.col("upto") - F.col("first")
    hits = (ranked.join(F.broadcast(sizes), "measure").withColumn("w", F.explode(wanted))
            .where((upto > F.floor("w.pos")) & (upto - F.col("times") <= F.ceil("w.pos"))))
    low, high = F.min("v"), F.max("v")
    at = hits.groupBy("measure", F.col("w.prob").alias("prob"), F.col("w.pos").alias("pos")).agg(
        (low + (high - low) * (F.col("pos") - F.floor("pos"))).alias("value"))
    quartiles = at.groupBy("measure").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(q)
                                            for p, q in ((0.25, "q1"), (0.75, "q3"))])
    step = F.lit(k) * (F.col("q3") - F.col("q1"))
    outside = lambda beyond: F.sum(F.when(beyond, F.col("times")).otherwise(0))
    found = (ranked.join(F.broadcast(quartiles), "measure").groupBy("measure", "q1", "q3")
             .agg(F.sum("times").alias("n"), outside(F.col("v") < F.col("q1") - step).alias("n_low"),
                  outside(F.col("v") > F.col("q3") + step).alias("n_high")))
    measures = df.sparkSession.createDataFrame([(c,) for c in columns], "measure string")
    return (measures.join(found, "measure", "left").fillna(0, ["n", "n_low", "n_high"])
            .select("measure", "n", "n_low", "n_high", "q1", "q3"))
