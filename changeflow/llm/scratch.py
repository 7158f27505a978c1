"""Tables written between the steps of a job, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from changeflow.session import scratch_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame as Parquet and read it again: lineage ends here, and a lost executor
    costs a read of these files and not what came before."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_by_key(df: DataFrame, label: str, key: str, files: int) -> DataFrame:
    """As :func:`written`, bucketed by ``key``: later joins on it do not move these rows again.

    The catalog entry is only needed to resolve the plan and goes at once; the files stay.
    """
    spark: SparkSession = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    rows = df.repartition(files, key)
    writer = rows.write.option("compression", "zstd").option("path", scratch_dir(spark, label))
    writer.bucketBy(files, key).format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolves
    spark.sql(f"DROP TABLE `{name}`")
    return table


def tasks_for(df: DataFrame) -> int:
    """How many tasks a shuffle of this session deals rows to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
