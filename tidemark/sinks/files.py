"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.files import CSV, check_format, csv_text, map_texts


PARQUET_CODEC = "zstd"


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: list[str] | None = None,
    max_records_per_file: int = 5_000_000,
) -> None:
    """Write files, one or more per task. There is no step that gathers rows in one task."""
    csv = check_format(fmt) == "csv"
    writer = (map_texts(df, csv_text) if csv else df).write.format(fmt.lower()).mode(mode)
    writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if csv:
        writer = writer.options(**CSV)
    elif fmt.lower() == "parquet":
        writer = writer.option("compression", PARQUET_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of files that no reader uses."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole: it appears under its name when it is complete."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    part = hadoop.Path(place.getParent().getParent(), f"_{place.getName()}.part")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(part, True)
    out.write(text.encode())
    out.close()
    files.mkdirs(place.getParent())
    files.delete(place, False)
    if not files.rename(part, place):
        raise OSError(f"cannot write {path}")
