"""File sources and the CSV dialect that sinks and sources share.

CSV files keep every value: timestamps carry microseconds, NULL is ``\\N``, the empty text is
quoted, blanks around a text stay, and in texts a backslash, a line feed and a carriage
return are written as ``\\\\``, ``\\n`` and ``\\r``. No record spans two lines, so large files
can be split.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

FORMATS = ("parquet", "csv")
CSV = {
    "header": "true",
    "nullValue": "\\N",
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def csv_text(text: Column) -> Column:
    """A text without line breaks that ``plain_text`` turns back."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def plain_text(text: Column) -> Column:
    """The text before ``csv_text``: doubled backslashes are set apart before the rest."""
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda t: F.replace(F.replace(t, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.array_join(parts, "\\")


def map_texts(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def check_format(fmt: str) -> str:
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    return fmt


def read_files(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", schema: StructType | None = None, base: str | None = None
) -> DataFrame:
    """Read landed files, of one folder or of several partitions of the table ``base``. CSV needs the schema, as every column would be a string without."""
    fmt = check_format(fmt)
    if fmt == "csv" and schema is None:
        raise ValueError("reading csv needs a schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    if fmt == "csv":
        return map_texts(reader.options(**CSV).option("mode", "FAILFAST").load(path), plain_text)
    return reader.load(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet files under ``path``, or no rows when the path does not exist yet.

    Every other failure is raised: taking an unreachable table for an empty one would
    start a full reload.
    """
    try:
        return read_files(spark, path, schema=schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that exist."""
    hadoop = spark._jsc.hadoopConfiguration()
    places = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return [p for p, place in zip(paths, places) if place.getFileSystem(hadoop).exists(place)]


def folders(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below a folder; nothing if it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().toString() for f in files.listStatus(place)] if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def files_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table; it changes when they are written again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in listed))
