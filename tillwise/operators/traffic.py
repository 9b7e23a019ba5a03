"""Visitors per zone and frame from person boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scalars import try_double

THIRDS = ["A", "B", "C"]


def is_wide(camera: Column) -> Column:
    """Cameras whose picture is split in three zones."""
    name = F.lower(F.trim(camera))
    return (name == "41") | F.contains(name, F.lit("wide"))


def _third(cx: Column, width: Column) -> Column:
    """Letter of the third that holds ``cx``; NULL outside the picture."""
    left, right = F.floor(width / 3), F.floor(2 * width / 3)
    return (F.when((cx >= 0) & (cx < left), "A").when((cx >= left) & (cx < right), "B")
            .when((cx >= right) & (cx < width), "C"))


def join_box_zone(boxes: DataFrame) -> DataFrame:
    """Boxes with centre and zone; boxes outside every zone are dropped.

    The zones of a picture follow from its width, so the range join is a projection.
    """
    centred = boxes.withColumns({"cx": (F.col("x1") + F.col("x2")) / 2.0, "cy": (F.col("y1") + F.col("y2")) / 2.0})
    split = F.concat(F.col("camera"), F.lit("_"), _third(F.col("cx"), F.col("width")))
    return (centred.withColumn("zone_id", F.when(is_wide(F.col("camera")), split).otherwise(F.col("camera")))
            .where(F.col("zone_id").isNotNull()))


def frame_zone_counts(boxes: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """People per frame and zone, zeros included for every third of a wide frame.

    ``frames`` (camera, image) adds frames without any box. One aggregation per frame counts all thirds
    at once, so neither a zone table nor a product of frames and zones is needed.
    """
    cx = (F.col("x1") + F.col("x2")) / 2.0
    third = _third(cx, F.col("width"))
    counts = boxes.groupBy("camera", "image").agg(
        F.count("*").alias("all"), *[F.count_if(third == z).alias(z) for z in THIRDS])
    if frames is not None:
        counts = (frames.select("camera", "image").join(counts, ["camera", "image"], "left")
                  .fillna(0, ["all", *THIRDS]))
    zone = [F.struct(F.concat("camera", F.lit("_" + z)).alias("zone_id"), F.col(z).alias("people_count"))
            for z in THIRDS]
    whole = F.struct(F.col("camera").alias("zone_id"), F.col("all").alias("people_count"))
    cells = F.when(is_wide(F.col("camera")), F.array(*zone)).otherwise(F.array(whole))
    return (counts.select(F.col("image").alias("timestamp"), F.inline(cells)))


def heat_grid(boxes: DataFrame, cell: int = 1) -> DataFrame:
    """Box centres per zone and grid cell of ``cell`` pixels; centres outside the picture are dropped."""
    x, y = F.col("cx").cast("int"), F.col("cy").cast("int")
    inside = (x >= 0) & (x < F.col("width")) & (y >= 0) & (y < F.col("height"))
    size = F.lit(cell)
    return (join_box_zone(boxes).where(inside)
            .groupBy("zone_id", F.floor(x / size).cast("int").alias("gx"), F.floor(y / size).cast("int").alias("gy"))
            .agg(F.count("*").alias("people")))


def zone_stats(traffic: DataFrame, top_n: int = 15) -> DataFrame:
    """Peak, total, mean and number of frames per zone, busiest peak first."""
    people = F.coalesce(try_double("people_count"), F.lit(0.0))
    return (traffic.groupBy("zone_id")
            .agg(F.max(people).alias("max_people_per_frame"), F.sum(people).alias("total_people"),
                 F.avg(people).alias("avg_people_per_frame"), F.count("*").alias("frames"))
            .orderBy(F.desc("max_people_per_frame"), "zone_id").limit(top_n))


def count_error(detected: DataFrame, truth: DataFrame) -> DataFrame:
    """Mean absolute difference of detected and true counts per zone; a missing frame counts as zero."""
    d = detected.select("timestamp", "zone_id", F.col("people_count").alias("d"))
    t = truth.select("timestamp", "zone_id", F.col("people_count").alias("t"))
    miss = F.abs(F.coalesce("d", F.lit(0)) - F.coalesce("t", F.lit(0)))
    return (d.join(t, ["timestamp", "zone_id"], "full").groupBy("zone_id")
            .agg(F.count("*").alias("frames"), F.avg(miss).alias("mae")))
