"""Small catalog and file-system helpers shared by the table operators."""

from __future__ import annotations

from pyspark.sql import SparkSession


def sql_string(value: str) -> str:
    """Quote a Python string as a Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_ident(name: str) -> str:
    """Quote a possibly qualified identifier (``db.table`` -> `` `db`.`table` ``)."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def split_name(spark: SparkSession, name: str) -> tuple[str, str]:
    """``(database, table)`` for ``db.table`` or a bare name in the current database.

    The database keeps its catalog: ``catalog.db.table`` gives ``("catalog.db", "table")``.
    """
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def database_location(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on whatever file system it names (HDFS, object store, local)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION {sql_string(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(database)}{loc}")


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the entries directly below ``path`` (empty if it does not exist)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [str(st.getPath().toString()) for st in fs.listStatus(hpath)]


def table_location(spark: SparkSession, name: str) -> str:
    """The location the catalog records for a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(name)}").collect()
    for r in rows:
        if r[0] == "Location":
            return r[1].rstrip("/")
    raise ValueError(f"table {name} has no location")


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below ``path`` (0 if it does not exist)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return 0
    return int(fs.getContentSummary(hpath).getLength())


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name; ``False`` if there is."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath.getParent())
    if fs.exists(hpath):
        return False
    try:
        out = fs.create(hpath, False)
    except Exception:
        if fs.exists(hpath):            # another writer was faster
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
