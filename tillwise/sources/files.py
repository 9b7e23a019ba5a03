"""Files in and out."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.scale import materialise
from tillwise.operators.cleaning import clean_transactions

# Known output tables, each with the columns that identify it under another name.
CATALOG = {
    "cv_foot_traffic": ["timestamp", "zone_id", "people_count"],
    "sales_forecast": ["date", "product_id", "predicted_sales"],
    "inventory_recommendations": ["product_id", "decision", "recommended_order"],
    "discount_recommendations": ["product_id", "discount_action", "discount_rate"],
    "review_insights": ["date", "avg_rating"],
    "review_keywords": ["sentiment", "keyword", "score"],
    "review_topics": ["sentiment", "topic_id", "top_words"],
    "customer_segments": ["cluster_id", "segment_name"],
}
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"
IMAGE_PATTERN = r"(?i)\.(png|jpg|jpeg)$"


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet dataset, or CSV with a header when the path says so."""
    return _reader(spark.read.schema(schema) if schema and _is_csv(path) else spark.read, path)(path)


def _is_csv(path: str) -> bool:
    return re.search(r"\.csv/?$", path) is not None


def _reader(reader, path: str):
    """The load function for what ``path`` names; it takes a path or a list of files."""
    if _is_csv(path):
        return reader.options(header=True, multiLine=True, escape='"').csv
    return lambda files: reader.parquet(*([files] if isinstance(files, str) else files))


def _has_compressed(spark: SparkSession, path: str) -> bool:
    try:
        files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    except AnalysisException:
        return False
    return not files.where(F.col("file").rlike(COMPRESSED)).isEmpty()


def extract_report(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file of the extracts: ``(path, file, is_read, n_rows, why)``.

    Rows are counted per file with broken files passed over, which for Parquet reads the footers only. A listed file
    without rows is opened alone to tell an empty one from a broken one, and so is every compressed CSV file, since a
    broken one gives rows before it fails. Plain CSV files are not read: ``n_rows`` is NULL. A path that is not there is
    one row without a file.
    """
    parts = [_file_report(spark, path) for path in paths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


REPORT = "path string, file string, is_read boolean, n_rows long, why string"


def _file_report(spark: SparkSession, path: str) -> DataFrame:
    file = F.col("_metadata.file_path")
    try:
        listed = spark.read.format("binaryFile").load(path).select(file.alias("file"))
    except AnalysisException:
        return spark.createDataFrame([(path, None, False, 0, "not found")], REPORT)
    if _is_csv(path):
        counted = listed.select("file", F.lit(None).cast("long").alias("n_rows"))
        suspect = listed.where(F.col("file").rlike(COMPRESSED))
    else:
        try:
            read = spark.read.option("ignoreCorruptFiles", True).parquet(path)
            rows = read.groupBy(file.alias("file")).agg(F.count("*").alias("n_rows"))
            counted = materialise(listed.join(rows, "file", "left"))
        except Exception:       # no schema at all, or a fault that Spark does not pass over: every file is in doubt
            counted = materialise(listed.withColumn("n_rows", F.lit(None).cast("long")))
        suspect = counted.where(F.col("n_rows").isNull()).select("file")
    opened = [(r["file"], *_opened(spark, r["file"])) for r in suspect.collect()]       # only the files in doubt
    found = spark.createDataFrame(opened, "file string, n_opened long, why string")
    return counted.join(found, "file", "left").select(
        F.lit(path).alias("path"), "file", F.col("why").isNull().alias("is_read"),
        F.when(F.col("why").isNotNull(), 0).otherwise(F.coalesce("n_rows", "n_opened")).alias("n_rows"), "why")


def _opened(spark: SparkSession, file: str) -> tuple[int, str | None]:
    """Rows of one file, or 0 and the first line of what stands against reading it."""
    try:
        return (spark.read.csv(file) if re.search(COMPRESSED, file) else spark.read.parquet(file)).count(), None
    except Exception as e:                      # whatever a reader throws at a broken file
        return 0, str(e).strip().splitlines()[0]


def src_union_extracts(spark: SparkSession, paths: list[str], clean: bool = True) -> DataFrame:
    """Readable extracts put together (columns by name) and cleaned; fails when none can be read.

    A broken file is left out as a whole and the other files of its extract stay; :func:`extract_report` names it. A file
    that breaks only behind a sound footer is an error when the rows are read, never a silent loss.
    """
    parts = []
    for path in paths:
        if _is_csv(path) and not _has_compressed(spark, path):
            try:
                parts.append(read_any(spark, path))
            except AnalysisException:
                continue
            continue
        report = _file_report(spark, path)
        if report.where("not is_read").isEmpty():
            if not report.isEmpty():
                parts.append(read_any(spark, path))
            continue
        sound = [r["file"] for r in report.where("is_read").select("file").collect()]    # a listing, as Spark holds too
        if sound:
            parts.append(_reader(spark.read.option("basePath", path), path)(sound))
    if not parts:
        raise ValueError(f"no extract could be read: {paths}")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return clean_transactions(out) if clean else out


def src_csv_skip_bad(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8",
                     header: bool = True) -> DataFrame:
    """CSV lines with at most the declared number of fields; longer lines are dropped, short ones padded.

    Values are read as text and cast one by one, so a bad value becomes NULL and keeps its line.
    """
    overflow = "_overflow"
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(overflow, T.StringType())])
    rows = (spark.read.schema(texts)
            .options(header=header, multiLine=True, escape='"', mode="PERMISSIVE", encoding=encoding).csv(path))
    return (rows.where(F.col(overflow).isNull())
            .select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]))


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 unless some line does not decode as UTF-8; looks at whole files, on the executors."""
    broken = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1)     # the text source keeps raw bytes
    return "ISO-8859-1" if broken.count() else "UTF-8"


def src_csv_encoding_fallback(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """CSV as UTF-8, else as Latin-1; None when there is no such file."""
    try:
        encoding = detect_encoding(spark, path)
    except AnalysisException:
        return None
    return src_csv_skip_bad(spark, path, schema, encoding)


# -- output folder ------------------------------------------------------------------------------------

def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Paths of the datasets right under ``root``, through the Hadoop file system (any storage)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(path))


def _readable(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_any(spark, path)
    except AnalysisException:
        return None


def src_discover_by_columns(spark: SparkSession, root: str, required: list[str]) -> str | None:
    """First dataset under ``root`` whose header holds all ``required`` columns; only schemas are read."""
    for path in list_tables(spark, root):
        df = _readable(spark, path)
        if df is not None and set(required) <= {c.strip() for c in df.columns}:
            return path
    return None


def _table_name(path: str) -> str:
    return re.sub(r"\.(csv|parquet)$", "", path.rstrip("/").rsplit("/", 1)[-1])


def locate_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Path per known table: by name, else by its columns."""
    here = {_table_name(p): p for p in list_tables(spark, root)}
    found = {}
    for name, columns in CATALOG.items():
        path = here.get(name) or src_discover_by_columns(spark, root, columns)
        if path:
            found[name] = path
    return found


def src_load_catalog(spark: SparkSession, root: str, views: bool = False) -> dict[str, DataFrame]:
    """Known tables that exist, lazily; absent ones have no key."""
    out = {}
    for name, path in locate_tables(spark, root).items():
        df = _readable(spark, path)
        if df is not None:
            out[name] = df
            if views:
                df.createOrReplaceTempView(name)
    return out


def src_outputs_status(spark: SparkSession, root: str) -> DataFrame:
    """Per known table: under its own name, found elsewhere, number of columns."""
    named = {_table_name(p) for p in list_tables(spark, root)}
    tables = src_load_catalog(spark, root)
    rows = [(name, name in named, name in tables, len(tables[name].columns) if name in tables else 0)
            for name in CATALOG]
    return spark.createDataFrame(rows, "name string, exists boolean, found boolean, n_cols int")


def sink_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Overwrites one output table; CSV carries a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(header=True, escape='"').csv(path)
    else:
        writer.format(fmt).save(path)
    return path


# -- facts and word lists -----------------------------------------------------------------------------

def sink_chunk_store(chunks: DataFrame, path: str, model: PipelineModel | None = None, version: str = "1") -> str:
    """Facts with their vectors, laid out by source so that a source filter reads only its own files.

    The model that made the vectors is kept beside them under its ``version``, where reading the facts does not see it,
    so that a later session embeds its questions alike.
    """
    chunks.write.mode("overwrite").partitionBy("source").parquet(path)
    if model is not None:
        model.write().overwrite().save(f"{path}/_models/{version}")
    return path


def src_embed_model(spark: SparkSession, path: str, version: str = "1") -> PipelineModel:
    """The embedding model that is stored with the facts under ``path``."""
    return PipelineModel.read().session(spark).load(f"{path}/_models/{version}")


def src_chunk_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sink_stopwords(words: DataFrame, path: str) -> str:
    """One word per line, sorted."""
    words.select("word").distinct().orderBy("word").select(F.col("word").alias("value")).write.mode("overwrite").text(path)
    return path


def src_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Lower-cased words of a list; an absent list is empty."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], "word string")
    word = F.lower(F.trim("value"))
    return lines.select(word.alias("word")).where(F.col("word") != "").distinct()


# -- pictures and annotations -------------------------------------------------------------------------

def _zone_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/images/[^/]+$", 1)


def src_image_listing(spark: SparkSession, root: str) -> DataFrame:
    """Pictures under ``<zone>/images/``; the contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    image = F.regexp_extract("path", r"([^/]+)$", 1)
    return (files.where(F.regexp_like("path", F.lit(IMAGE_PATTERN)))
            .select(_zone_of(F.col("path")).alias("camera"), image.alias("image"), "length")
            .where(F.col("camera") != ""))


ANNOTATION_SCHEMA = T.StructType([
    T.StructField("_label", T.StringType()),
    T.StructField("box", T.ArrayType(T.StructType(
        [T.StructField("_frame", T.LongType()), T.StructField("_outside", T.IntegerType())]
        + [T.StructField(f"_{c}", T.DoubleType()) for c in ("xtl", "ytl", "xbr", "ybr")])))])


def frame_file(camera: Column, frame: Column) -> Column:
    """Picture name of a frame number without extension; the style depends on the camera."""
    padded = lambda n: F.lpad(frame.cast("string"), n, "0")
    short = F.when(F.length(frame.cast("string")) > 2, frame.cast("string")).otherwise(padded(2))
    name = F.lower(F.regexp_replace(camera, r"(?i)^zone", ""))
    return (F.when(name == "41", F.concat(F.lit("frame_"), padded(6)))
            .when(name == "2", F.concat(F.lit("second_frame_"), short))
            .otherwise(F.concat(F.lit("first_frame_"), short)))


def src_box_annotations(spark: SparkSession, path: str, sizes: DataFrame | None = None) -> DataFrame:
    """Boxes of tracked annotations (``<zone>/annotations.xml``); boxes marked outside are dropped.

    ``sizes`` (camera, image, width, height) adds centre and size relative to the picture and keeps the
    boxes whose picture exists.
    """
    tracks = (spark.read.format("xml").option("rowTag", "track").schema(ANNOTATION_SCHEMA).load(path)
              .select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("camera"),
                      F.explode("box").alias("b")))
    boxes = (tracks.where(F.coalesce(F.col("b._outside"), F.lit(0)) != 1)
             .select("camera", F.col("b._frame").alias("frame"), frame_file(F.col("camera"), F.col("b._frame")).alias("stem"),
                     F.col("b._xtl").alias("x1"), F.col("b._ytl").alias("y1"), F.col("b._xbr").alias("x2"),
                     F.col("b._ybr").alias("y2")))
    if sizes is None:
        return boxes
    pictures = sizes.select("camera", "image", "width", "height",
                            F.regexp_replace("image", IMAGE_PATTERN, "").alias("stem"),
                            (~F.endswith(F.lower("image"), F.lit(".png"))).alias("_second"))
    # a frame stored twice counts once, its png first
    pictures = (pictures.groupBy("camera", "stem")
                .agg(F.min_by(F.struct("image", "width", "height"), "_second").alias("p"))
                .select("camera", "stem", "p.*"))
    return (boxes.join(pictures, ["camera", "stem"])
            .withColumns({"x_center": (F.col("x1") + F.col("x2")) / 2 / F.col("width"),
                          "y_center": (F.col("y1") + F.col("y2")) / 2 / F.col("height"),
                          "box_width": (F.col("x2") - F.col("x1")) / F.col("width"),
                          "box_height": (F.col("y2") - F.col("y1")) / F.col("height")})
            .drop("stem"))
