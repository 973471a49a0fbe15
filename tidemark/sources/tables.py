"""Tables on shared storage, in Delta or in any built-in file format.

A plain table that is replaced as a whole keeps each content in a folder of its own below
the table's, and a small file names the current one. Readers see the old content until the
new one is complete; a failed write changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Formats that keep the schema with the table, refuse another, and swap content themselves.
SELF_DESCRIBING = ("delta",)

CURRENT = "_current"
CONTENT = "content-"


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def table_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _files(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _files(spark, path)
    files.delete(folder, True)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's content: a named one, or the table's own."""
    files, pointer = _files(spark, f"{path}/{CURRENT}")
    if not files.exists(pointer):
        return path
    stream = files.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name.strip()}"


def _switch(spark: SparkSession, path: str, content: str) -> None:
    """Makes ``content`` the current one; content before the last is removed."""
    before = current_path(spark, path)
    files, aside = _files(spark, f"{path}/_{content}.pointer")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    _, pointer = _files(spark, f"{path}/{CURRENT}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(
        files.makeQualified(aside).toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(files.makeQualified(aside), files.makeQualified(pointer), options)
    _, folder = _files(spark, path)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(CONTENT) and name != content and not before.endswith(f"/{name}"):
            files.delete(status.getPath(), True)


def read_table(
    spark: SparkSession,
    path: str,
    table_format: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """The table at ``path``.

    With ``schema``, plain files need not be opened to learn it, and a table that was
    written without any row can be read.
    """
    reader = spark.read.format(table_format)
    if table_format in SELF_DESCRIBING:
        return reader.load(path)
    if schema is not None:
        reader = reader.schema(schema)
    # Days that retention has removed are still named in a streaming sink's own file list.
    return reader.option("ignoreMissingFiles", "true").load(current_path(spark, path))


def replace_table(
    rows: DataFrame,
    path: str,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Replaces the table's whole content, or leaves it as it was if the write fails.

    Delta does so itself. Of plain files the content before is kept until the next run,
    for readers that have just begun with it.
    """
    content = f"{CONTENT}{uuid.uuid4().hex}"
    own_swap = table_format in SELF_DESCRIBING
    writer = rows.write.format(table_format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path if own_swap else f"{path}/{content}")
    if not own_swap:
        _switch(rows.sparkSession, path, content)


def replace_partitions(
    rows: DataFrame, path: str, partition_by: Sequence[str], table_format: str = "parquet"
) -> None:
    """Replaces the partitions that ``rows`` have data for; others stay as they are."""
    own_swap = table_format in SELF_DESCRIBING
    (
        rows.write.format(table_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path if own_swap else current_path(rows.sparkSession, path))
    )


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of ``column`` that the plain table at ``path`` has folders for."""
    files, folder = _files(spark, current_path(spark, path))
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [name.split("=", 1)[1] for name in names if name.startswith(f"{column}=")]


def stored_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of all files below ``path``."""
    files, folder = _files(spark, path)
    summary = files.getContentSummary(folder)
    return summary.getFileCount(), summary.getLength()


def remove_partitions(
    spark: SparkSession, path: str, column: str, values: Iterable, table_format: str = "parquet"
) -> None:
    """Empties the partitions of ``column`` with these values; null is one of them."""
    for value in values:
        if table_format in SELF_DESCRIBING:
            match = f"{column} is null" if value is None else f"{column} = '{value}'"
            spark.sql(f"delete from {table_format}.`{path}` where {match}")
        else:
            name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            remove_folder(spark, f"{current_path(spark, path)}/{column}={name}")
