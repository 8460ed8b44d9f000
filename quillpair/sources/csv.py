"""CSV scans and sinks (A1-A4, A6-A8), Parquet between our own stages.

All text columns are read as strings by header name (never positionally).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

EXTRA = "_extra"


def _reader(spark: SparkSession):
    return (spark.read.option("header", True).option("multiLine", True)
            .option("escape", '"').option("mode", "PERMISSIVE"))


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (reads only the first line)."""
    return spark.read.option("header", True).option("multiLine", True).csv(path).columns


def read_projected(spark: SparkSession, path: str,
                   columns: Sequence[str] = ("context", "question")) -> DataFrame:
    """``read_csv(usecols=...)`` (A1): select by header name; over-long
    lines are truncated, short lines padded with null."""
    return _reader(spark).csv(path).select(*columns)


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """``read_csv(error_bad_lines=False)`` (A2): all columns; a line with more
    fields than the header is dropped, a short line is kept (null-padded).

    The schema carries one extra trailing column: a line that fills it had
    too many fields.
    """
    cols = header_columns(spark, path)
    schema = Ty.StructType([Ty.StructField(c, Ty.StringType()) for c in cols]
                           + [Ty.StructField(EXTRA, Ty.StringType())])
    df = _reader(spark).option("enforceSchema", True).schema(schema).csv(path)
    return df.filter(F.col(EXTRA).isNull()).drop(EXTRA)


def read_indexed(spark: SparkSession, path: str, columns: Sequence[str] = ("context", "question"),
                 name: str = "row_id") -> DataFrame:
    """Projected read with a 0-based row index in file order, like the pandas index.

    Files are ordered by name, rows by their place in the file. A multi-line
    CSV file is one split, so numbering within a file adds no wider task; the
    offset of a file is the number of rows in the files before it (one small
    row per file). Spark's packing of files into tasks has no influence.
    """
    src = _reader(spark).csv(path)
    rows = src.select(*columns, F.col("_metadata.file_path").alias("_file"),
                      F.monotonically_increasing_id().alias("_at"))
    counts = src.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_file").orderBy("_at")) - 1
    return (rows.withColumn("_place", place).join(offsets, "_file")
            .select((F.col("_off") + F.col("_place")).cast("bigint").alias(name), *columns))


def read_split(spark: SparkSession, path: str, split: str,
               columns: Sequence[str] = ("context", "question")) -> DataFrame:
    """One split as (row_id, context, question, split) (A1 + E3 + G1)."""
    return read_indexed(spark, path, columns).withColumn("split", F.lit(split))


def read_splits(spark: SparkSession, paths: dict[str, str],
                columns: Sequence[str] = ("context", "question")) -> DataFrame:
    """Named splits as one DataFrame with a ``split`` column (G1)."""
    out = None
    for split, path in paths.items():
        df = read_split(spark, path, split, columns)
        out = df if out is None else out.unionByName(df)
    return out


def write_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Clean splits, partitioned by split, ids kept."""
    w = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with a header; line breaks and quotes survive (A1-A2 input)."""
    df.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions (A4) as written by :func:`write_predictions`."""
    return spark.read.parquet(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Generated rows, one folder per variant (A7); a distributed write."""
    df.write.mode("overwrite").partitionBy("variant").parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    """Feature arrays as Parquet (A8), one folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
