"""Named tables and views over folders this package writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A possibly qualified name for SQL, each part in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()
    return {row["col_name"]: row["data_type"] for row in rows}


def _folder(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().getPath().rstrip("/")


def publish_table(
    spark: SparkSession, name: str, df: DataFrame, path: str, comment: str = "", within: str | None = None
) -> None:
    """Register the folder as an external table, so that ``spark.read.table`` and
    ``spark.readStream.table`` find it by name.

    ``df`` gives the columns. Registering again replaces the definition, never the files: a
    table of this name that is managed, a view, or lies elsewhere is left alone and an error.
    With ``within``, one that lies anywhere below that folder is an older version of this one; if its
    columns are the same, it is pointed to the new folder in one step and is there all the time.
    """
    if spark.catalog.tableExists(quoted(name)):
        found = _described(spark, name)
        place = _folder(spark, found["Location"]) if found.get("Type") == "EXTERNAL" else None
        ours = place == _folder(spark, path) or (
            place is not None and within is not None and place.startswith(_folder(spark, within) + "/")
        )
        if not ours:
            raise ValueError(f"there is another table or view named {name}")
        if within is not None and spark.table(quoted(name)).dtypes == df.dtypes:
            spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION {_text(path)}")
            spark.sql(f"COMMENT ON TABLE {quoted(name)} IS {_text(comment)}")
            return spark.catalog.refreshTable(quoted(name))
        spark.sql(f"DROP TABLE {quoted(name)}")
    spark.catalog.createTable(
        quoted(name),
        path=path,
        source="parquet",
        schema=df.schema,
        description=comment,
        recursiveFileLookup="true",
    )


def publish_view(spark: SparkSession, name: str, sql: str, comment: str = "") -> None:
    """Register a view in the catalog. A table of this name is an error and stays."""
    if spark.catalog.tableExists(quoted(name)) and _described(spark, name).get("Type") != "VIEW":
        raise ValueError(f"there is a table named {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} COMMENT {_text(comment)} AS {sql}")


def refresh(spark: SparkSession, name: str) -> None:
    """Forget which files a published table had when this session last read it."""
    if spark.catalog.tableExists(quoted(name)):
        spark.catalog.refreshTable(quoted(name))
