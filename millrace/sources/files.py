"""Files whose name carries a date, delimited text with rejects, XML rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Name masks of the delivered files.
DAY_MASK = (r"_(\d{8})\.", "ddMMyyyy")
MINUTE_MASK = (r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2})", "yyyy-MM-dd_HH-mm")


def name_time(mask: tuple[str, str], path: str = "_metadata.file_path") -> Column:
    """Time stated in the name of the file, or dated folder of part files, a row comes from."""
    pattern, layout = mask
    text = F.regexp_extract(F.col(path), pattern, 1)
    return F.try_to_timestamp(F.when(text != "", text), F.lit(layout))


def next_dated_file(
    df: DataFrame, high_water: str, mask: tuple[str, str] = DAY_MASK, stamp: str = "file_dt"
) -> DataFrame:
    """Rows of the earliest file newer than ``high_water``, stamped with its time.

    The choice is by date, not by name, and needs only the file listing. The filter uses file metadata
    alone, so the other files are dropped when the scan is planned.
    """
    spark = df.sparkSession
    names = spark.createDataFrame([(f,) for f in df.inputFiles()], "path string")
    times = names.select(name_time(mask, "path").alias("t"))
    first = times.filter(F.col("t") > F.lit(high_water).cast("timestamp")).agg(
        F.date_format(F.min("t"), "yyyy-MM-dd HH:mm:ss").alias("t")
    ).first()["t"]
    at = name_time(mask)
    chosen = df.filter(at == F.lit(first).cast("timestamp"))
    return chosen.withColumn(stamp, at.cast("timestamp_ntz"))


def newer_dated_files(
    df: DataFrame, high_water: str, mask: tuple[str, str] = MINUTE_MASK, stamp: str = "file_dt"
) -> DataFrame:
    """Rows of every file newer than ``high_water``, stamped with the file's time."""
    at = name_time(mask)
    return df.filter(at > F.lit(high_water).cast("timestamp")).withColumn(
        stamp, at.cast("timestamp_ntz")
    )


def delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
    header: bool = True, timestamp_format: str | None = None,
) -> DataFrame:
    """Delimited text with a declared schema; nothing is inferred."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option(
            "timestampNTZFormat", timestamp_format
        )
    return reader.csv(path)


def load_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows and, apart, the text of malformed lines; an empty field is NULL.

    Lines are parsed as an expression, so whether one is malformed never depends on the columns asked
    for. Lines that repeat the column names are headers.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide)
    options = {
        "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "nullValue": "",
    }
    text = spark.read.text(path)
    lines = text.filter(F.trim("value") != "")
    if header:
        lines = lines.filter(F.translate("value", '"', "") != sep.join(schema.names))
    parsed = lines.select(
        F.from_csv("value", ddl, options).alias("_r"), F.col("value").alias("rejected_data"),
        F.col("_metadata.file_name").alias("file_name"),
    )
    broken = F.col(f"_r.{CORRUPT}").isNotNull()
    good = parsed.filter(~broken).select(*[F.col(f"_r.{n}") for n in schema.names])
    return good, parsed.filter(broken).select("rejected_data", "file_name")


# One waybill per document: attributes on the root, licence and period nested.
WAYBILL = T.StructType([
    T.StructField("_number", T.StringType()),
    T.StructField("_issuedt", T.TimestampNTZType()),
    T.StructField("car", T.StringType()),
    T.StructField("driver", T.StructType([T.StructField("license", T.StringType())])),
    T.StructField("period", T.StructType([
        T.StructField("start", T.TimestampNTZType()),
        T.StructField("stop", T.TimestampNTZType()),
    ])),
])


def read_waybills(spark: SparkSession, path: str) -> DataFrame:
    """XML waybills, one flat row each."""
    docs = spark.read.format("xml").option("rowTag", "waybill").schema(WAYBILL).load(path)
    return docs.select(
        F.col("_number").alias("waybill_num"),
        F.col("driver.license").alias("driver_license"),
        F.col("car").alias("car_plate_num"),
        F.col("period.start").alias("work_start_dt"),
        F.col("period.stop").alias("work_end_dt"),
        F.col("_issuedt").alias("issue_dt"),
    )
