"""Cleaning of raw sales lines and reviews, and small column normalisers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scalars import money, ratio, try_double
from tillwise.functions.scale import materialise


EPOCH = datetime(1970, 1, 1)


def clean_transactions(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Valid sales lines with their exact value.

    The strict form drops lines without customer and cancelled invoices (``C…``); the lenient form only
    wants a positive quantity and price.
    """
    keep = (F.col("quantity") > 0) & (F.col("price") > 0)
    if not lenient:
        keep = keep & F.col("customer_id").isNotNull() & ~F.col("invoice").startswith("C")
    return raw.where(keep).withColumn("sales", money(F.col("quantity") * F.col("price")))


def clean_reviews(raw: DataFrame, sample_n: int | None = None) -> DataFrame:
    """Reviews with a summary and a text; date, helpfulness share and joined review text are added."""
    kept = raw.where(F.col("summary").isNotNull() & F.col("text").isNotNull())
    if sample_n is not None:
        kept = stratified_sample(kept, sample_n)
    helpful = F.when(F.col("helpfulness_denominator") > 0,
                     ratio("helpfulness_numerator", "helpfulness_denominator")).otherwise(F.lit(0.0))
    # epoch plus interval: the same date in every session time zone
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("time").cast("decimal(18,6)"))
    return (kept.withColumn("date", F.lit(EPOCH).cast("timestamp_ntz") + since_epoch)
            .withColumn("helpfulness", helpful)
            .withColumn("review_text", F.concat("summary", F.lit(". "), "text")))


def stratified_sample(df: DataFrame, sample_n: int, by: str = "score", key: str = "id") -> DataFrame:
    """Exactly ``floor(sample_n * share)`` rows of each group, those with the smallest ``md5(key)``.

    The table is read twice: once for a stored table of groups and hashes, on which histograms of 4, then 8 hex
    digits close in on the hash that cuts each group, and once to keep the rows up to the cut. No group is sorted: a
    histogram has at most 65,536 bins a group. Rows that share the key of a cut are told apart by their content. A
    table of at most ``sample_n`` rows is kept whole.
    """
    own = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    hashes = materialise(df.select(F.col(by).alias("_by"), own.alias("_hash")))
    sizes = hashes.groupBy("_by").agg(F.count("*").alias("_size"))
    total = sizes.agg(F.sum("_size")).scalar()
    quota = F.when(total <= sample_n, F.col("_size")).otherwise(F.floor(F.lit(sample_n) * F.col("_size") / total))
    need = sizes.select("_by", quota.alias("_need")).where("_need > 0").withColumn("_bin", F.lit(""))
    for digits in (4, 8, 32):
        need = materialise(_cut(hashes, need, digits))      # one row per group
    same = df[by].eqNullSafe(need["_by"])
    if need.where("_need < _times").isEmpty():
        return df.join(need, same & (own <= need["_bin"]), "left_semi")
    below = df.join(need, same & (own < need["_bin"]), "left_semi")
    place = F.row_number().over(Window.partitionBy("_by").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    tied = df.join(need, same & (own == need["_bin"])).withColumn("_place", place).where("_place <= _need")
    return below.unionByName(tied.select(*[F.col(f"`{c}`") for c in df.columns]))


def _cut(hashes: DataFrame, need: DataFrame, digits: int) -> DataFrame:
    """(_by, _bin, _need, _times) of the hash prefix that holds each group's ``_need``-th row of its present ``_bin``.

    ``_need`` then counts from the first row of the new bin, which holds ``_times`` rows.
    """
    inside = F.col("g._by").eqNullSafe(F.col("h._by")) & F.startswith("h._hash", "g._bin")
    counts = (hashes.alias("h").join(need.alias("g"), inside)
              .groupBy("g._by", "g._need", F.substring("h._hash", 1, digits).alias("_bin"))
              .agg(F.count("*").alias("_times")))
    upto = F.sum("_times").over(Window.partitionBy("_by").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    left = F.col("_need") - (F.col("_upto") - F.col("_times"))
    return (counts.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_need")) & (left > 0))
            .select("_by", "_bin", left.alias("_need"), "_times"))


def extract_rating(df: DataFrame, column: str, out: str = "rating") -> DataFrame:
    """First digit of a rating text."""
    digit = F.regexp_extract(column, r"(\d)", 1)
    return df.withColumn(out, F.when(digit != "", digit).cast("int"))


def coerce_numeric(df: DataFrame, column: str) -> DataFrame:
    """Numbers in a text column; anything else becomes 0."""
    return df.withColumn(column, F.coalesce(try_double(column), F.lit(0.0)))


def coerce_date_drop(df: DataFrame, column: str, *tie_break: str) -> DataFrame:
    """Dates in a text column; rows without one are dropped, the rest ordered by date."""
    return (df.withColumn(column, F.col(column).try_cast("date"))
            .where(F.col(column).isNotNull()).orderBy(column, *tie_break))


def norm_column_names(df: DataFrame, trim_values: tuple[str, ...] = ()) -> DataFrame:
    """Header names without surrounding blanks; the named text columns are trimmed too."""
    out = df.toDF(*[c.strip() for c in df.columns])
    return out.withColumns({c: F.trim(F.col(c).cast("string")) for c in trim_values if c in out.columns})


def relative_date_filter(df: DataFrame, years: int, column: str = "date") -> DataFrame:
    """Rows not older than ``years`` before the newest row."""
    newest: Column = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) >= F.add_months(newest, -12 * years))
