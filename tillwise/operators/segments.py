"""Customer recency / frequency / spend, clusters and segment names."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise

FEATURES = ["recency", "frequency", "monetary"]
UNNAMED = "Low Engagement"
SEGMENT_NAMES = ["Champions", "Loyal Customers", "At Risk", "Promising", UNNAMED]


def rfm(clean: DataFrame, snapshot: datetime | None = None) -> DataFrame:
    """Whole 24-hour periods since the last purchase, distinct invoices and spend of every customer.

    The snapshot defaults to one day after the newest sale.
    """
    when = F.col("invoice_date")
    end = (clean.agg(F.max(when) + F.expr("interval 1 day")).scalar() if snapshot is None
           else F.lit(snapshot).cast("timestamp_ntz"))
    elapsed = F.col("elapsed")
    whole = F.extract(F.lit("DAY"), elapsed)
    partial = elapsed < F.make_dt_interval(whole)           # a purchase after the snapshot: round down, not to zero
    return (clean.groupBy(F.col("customer_id").cast("string").alias("customer_id"))
            .agg(F.max(when).alias("last"), F.count_distinct("invoice").alias("frequency"),
                 F.sum("sales").cast("double").alias("monetary"))
            .withColumn("elapsed", end - F.col("last"))
            .select("customer_id", F.when(partial, whole - 1).otherwise(whole).cast("long").alias("recency"),
                    "frequency", "monetary"))


#: one standard deviation in the whole numbers that distances are computed with, and the furthest a value may be out
UNIT, FAR = 100_000, 800_000_000
CANDIDATES = 8              # customers drawn per start and cluster, of which seeds are chosen
MAX_STEPS = 60


def scale_features(customers: DataFrame) -> DataFrame:
    """Adds ``point``: the three measures centred and scaled, in whole UNITs, so that sums and distances are exact.

    A value further out than FAR counts as that far; a measure without spread counts as its mean.
    """
    stats = customers.agg(*[f(F.col(c).cast("double")).alias(n + c) for c in FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    row = stats.first()                                     # six numbers
    def scaled(c):
        spread = row["s" + c] or 0.0
        z = (F.col(c) - row["m" + c]) / spread if spread > 0 else F.lit(0.0)
        return F.coalesce(F.greatest(F.least(F.round(z * UNIT), F.lit(FAR)), F.lit(-FAR)), F.lit(0)).cast("long")
    return customers.withColumn("point", F.array(*[scaled(c) for c in FEATURES]))


def _seeds(points: DataFrame, ks, starts: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """(k, start) -> k seeds. A start draws CANDIDATES * k customers by the hash of their id and takes, from the first
    on, always the one furthest from those taken; so row count, order and partitions play no part."""
    many = CANDIDATES * max(ks)
    ident = F.concat_ws(":", F.lit(seed), F.col("start").cast("string"), F.col("customer_id").cast("string"))
    drawn = points.select("customer_id", "point", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))).alias("start"))
    place = F.row_number().over(Window.partitionBy("start").orderBy("h", "customer_id"))    # tasks cut their share first
    drawn = drawn.withColumn("h", F.md5(ident)).withColumn("place", place).where(F.col("place") <= many)
    found: dict[int, list] = {}
    for r in drawn.select("start", "place", "point").collect():                             # starts * many rows
        found.setdefault(r.start, []).append((r.place, r.point))
    out = {}
    for start, rows in found.items():
        candidates = np.array([p for _, p in sorted(rows)], np.int64)
        for k in ks:
            own, taken = candidates[:CANDIDATES * k], [0]
            while len(taken) < k:
                taken.append(int(((own[:, None] - own[taken]) ** 2).sum(2).min(1).argmax()))
            out[k, start] = own[taken]
    return out


def _step(points: DataFrame, models: list[np.ndarray]) -> list[tuple[list, list, int]]:
    """One scan for all models: counts and sums of every cluster, and the sum of squared distances of every model."""
    ends = np.cumsum([len(m) for m in models])
    centres = np.concatenate(models)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cost = np.zeros(len(centres), np.int64), np.zeros((len(centres), 3), np.int64), [0] * len(models)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy().reshape(-1, 3)
            for at in range(0, len(flat), 2048):
                own = flat[at:at + 2048]
                far = ((own[:, None] - centres) ** 2).sum(2)
                for i, (begin, end) in enumerate(zip(np.append(0, ends), ends)):
                    best = far[:, begin:end].argmin(1)
                    least = far[np.arange(len(own)), begin + best]
                    np.add.at(n, begin + best, 1)
                    np.add.at(sums, begin + best, own)
                    cost[i] += (int((least >> 32).sum()) << 32) + int((least & 0xFFFFFFFF).sum())
        model = np.repeat(np.arange(len(models)), [len(m) for m in models])
        first = np.append(0, ends[:-1])
        shown = [Decimal(cost[m]) if c == first[m] else Decimal(0) for c, m in enumerate(model)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(centres))), pa.array(n), *[pa.array(s) for s in sums.T], pa.array(shown, pa.decimal128(38, 0))],
            ["c", "n", "x", "y", "z", "cost"])

    parts = points.select("point").mapInArrow(totals, "c long, n long, x long, y long, z long, cost decimal(38,0)")
    rows = sorted(parts.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("n", "x", "y", "z", "cost")]).collect())     # one per centre
    out = []
    for begin, end in zip(np.append(0, ends), ends):
        own = rows[begin:end]
        out.append(([r.n for r in own], [(r.x, r.y, r.z) for r in own], int(sum(r.cost for r in own))))
    return out


def _fits(points: DataFrame, ks, starts: int, seed: int) -> dict[int, tuple[int, np.ndarray]]:
    """k -> (squared distances, centres) of the cheapest of ``starts`` runs of Lloyd's algorithm.

    All k and starts move together, one scan a step, until no centre moves or after MAX_STEPS steps. Whole numbers
    throughout: the result does not depend on how the rows lie. Of equal runs the first start wins.
    """
    open_ = _seeds(points, ks, starts, seed)
    done: dict[int, tuple[int, int, np.ndarray]] = {}
    for step in range(MAX_STEPS + 1):
        if not open_:
            break
        keys = sorted(open_)
        moved = {}
        for key, (n, sums, cost) in zip(keys, _step(points, [open_[k] for k in keys])):
            old = open_[key]
            new = np.array([[(2 * s + m) // (2 * m) for s in xyz] if m else c for m, xyz, c in zip(n, sums, old.tolist())], np.int64)
            if step < MAX_STEPS and (new != old).any():
                moved[key] = new
            else:
                done[key[0]] = min(done.get(key[0], (cost, key[1], old)), (cost, key[1], old), key=lambda f: f[:2])
        open_ = moved
    return {k: (cost, centres) for k, (cost, _, centres) in done.items()}


def elbow_inertias(customers: DataFrame, ks=range(2, 9), starts: int = 10, seed: int = 42) -> DataFrame:
    """Rows ``(k, inertia)``: squared distances in standard deviations to the nearest of k centres."""
    points = materialise(scale_features(customers).select("customer_id", "point"))      # one scan a step
    rows = [(k, cost / UNIT ** 2) for k, (cost, _) in sorted(_fits(points, list(ks), starts, seed).items())]
    return customers.sparkSession.createDataFrame(rows, "k int, inertia double")


def elbow_k(inertias: DataFrame) -> DataFrame:
    """The k where the gain of one more cluster falls off most (one row); 4 when there are too few points."""
    by_k = Window.orderBy("k")          # one row per candidate k
    drops = inertias.select("k", (F.col("inertia") - F.lead("inertia").over(by_k)).alias("drop"))
    knees = drops.select(F.lead("k").over(by_k).alias("knee"), "k",
                         (F.col("drop") - F.lead("drop").over(by_k)).alias("bend"))
    best = F.max_by("knee", F.struct("bend", -F.col("k")))
    return knees.where(F.col("bend").isNotNull()).agg(F.coalesce(best, F.lit(4)).cast("int").alias("k"))


def rfm_kmeans(customers: DataFrame, k: int | None = None, starts: int = 10, seed: int = 42) -> DataFrame:
    """Customers with ``cluster_id``; ``k=None`` picks it by the elbow."""
    if k is None:
        k = elbow_k(elbow_inertias(customers, starts=starts, seed=seed)).first()["k"]
    points = materialise(scale_features(customers))
    fits = _fits(points.select("customer_id", "point"), [k], starts, seed)
    if k not in fits:                                                                   # no customers
        return points.drop("point").withColumn("cluster_id", F.lit(None).cast("int"))
    far = F.array(*[_squared([F.lit(int(x)) for x in centre]) for centre in fits[k][1]])
    return points.withColumn("cluster_id", (F.array_position(far, F.array_min(far)) - 1).cast("int")).drop("point")


def _squared(other: list) -> Column:
    """Squared distance of ``point``."""
    return reduce(lambda a, b: a + b, [(F.get("point", F.lit(i)) - x) * (F.get("point", F.lit(i)) - x) for i, x in enumerate(other)])


def cluster_quality(clustered: DataFrame) -> DataFrame:
    """Mean silhouette (squared distances) of the clustering with the size of every cluster.

    The mean squared distance to a cluster follows from its size, centre and mean square, so one scan of sums and one
    of customers are enough. A customer alone in its cluster counts 0.
    """
    points = materialise(scale_features(clustered).select("cluster_id", F.transform("point", lambda x: x.cast("double") / UNIT).alias("point")))
    coordinate = [F.get("point", F.lit(i)) for i in range(3)]
    square = reduce(lambda a, b: a + b, [x * x for x in coordinate])
    per = materialise(points.groupBy("cluster_id").agg(F.count("*").alias("n"), F.avg(square).alias("q"),
                                                       *[F.avg(x).alias(f"m{i}") for i, x in enumerate(coordinate)]))
    listed = per.agg(F.sort_array(F.collect_list(F.struct("cluster_id", "n", "q", "m0", "m1", "m2")))).scalar()      # one per cluster
    far = F.transform("_all", lambda c: F.struct(
        (square + c["q"] - 2 * reduce(lambda a, b: a + b, [x * c[f"m{i}"] for i, x in enumerate(coordinate)])).alias("d"),
        c["cluster_id"].alias("c"), c["n"].alias("n")))
    seen = points.withColumn("_all", listed).withColumn("_far", far)
    own = F.element_at(F.filter("_far", lambda f: f["c"] == F.col("cluster_id")), 1)
    other = F.array_min(F.transform(F.filter("_far", lambda f: f["c"] != F.col("cluster_id")), lambda f: f["d"]))
    seen = seen.select(own.alias("own"), other.alias("b")).withColumn("a", F.try_divide(F.col("own.d") * F.col("own.n"), F.col("own.n") - 1))
    score = F.when((F.col("own.n") > 1) & (F.greatest("a", "b") > 0), (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0)
    return per.select("cluster_id", F.col("n").alias("customer_count"), seen.agg(F.avg(score)).scalar().alias("silhouette"))


def cluster_means(clustered: DataFrame) -> DataFrame:
    """Unrounded profile of every cluster."""
    return (clustered.groupBy("cluster_id")
            .agg(F.count("customer_id").alias("customer_count"), F.avg("recency").alias("avg_recency"),
                 F.avg("frequency").alias("avg_frequency"),
                 F.avg(F.col("monetary").cast("decimal(18,2)")).cast("double").alias("avg_monetary")))


def rounded(profile: DataFrame) -> DataFrame:
    return profile.withColumns({"avg_recency": F.bround("avg_recency", 1),
                                "avg_frequency": F.bround("avg_frequency", 1),
                                "avg_monetary": F.bround("avg_monetary", 2)})


def cluster_summary(clustered: DataFrame) -> DataFrame:
    return rounded(cluster_means(clustered))


def segment_names(clustered: DataFrame) -> DataFrame:
    """Cluster profiles with business names.

    Champions are recent and frequent (sum of average ranks); of the rest the most frequent cluster is
    Loyal, then the longest absent is At Risk, then the most recent is Promising. Ties go to the lower id.
    All windows run over one row per cluster.
    """
    def average_rank(col: str, descending: bool = False):
        order = F.desc(col) if descending else F.asc(col)
        ties = F.count("*").over(Window.partitionBy(col))
        return F.rank().over(Window.orderBy(order)) + (ties - 1) / 2

    profile = cluster_means(clustered).withColumn(
        "standing", average_rank("avg_recency") + average_rank("avg_frequency", descending=True))
    picks = [("Champions", F.asc("standing")), ("Loyal Customers", F.desc("avg_frequency")),
             ("At Risk", F.desc("avg_recency")), ("Promising", F.asc("avg_recency"))]
    profile = profile.withColumn("segment_name", F.lit(UNNAMED))
    for name, order in picks:
        open_row = F.col("segment_name") == UNNAMED
        place = F.row_number().over(Window.orderBy(F.desc(open_row), order, F.asc("cluster_id")))
        profile = (profile.withColumn("_place", place)
                   .withColumn("segment_name", F.when(open_row & (F.col("_place") == 1), name)
                               .otherwise(F.col("segment_name"))))
    return rounded(profile.drop("standing", "_place"))


# Columns of the segment report, in order; absent ones are skipped.
SEGMENT_COLUMNS = ["segment_name", "customer_count", "avg_age", "avg_purchase_frequency", "avg_purchase_amount",
                   "promo_usage_rate", "avg_satisfaction", "cluster_id"]


def segments_table(segments: DataFrame) -> DataFrame:
    """Report columns that exist, biggest segment first."""
    present = [c for c in SEGMENT_COLUMNS if c in segments.columns]
    count = F.coalesce(F.col("customer_count").try_cast("long"), F.lit(0))
    return (segments.select(*present).withColumn("customer_count", count)
            .orderBy(F.desc("customer_count"), "segment_name"))
