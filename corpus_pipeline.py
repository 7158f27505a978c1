"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm import minhash, mixing, packing, quality, suffix
from changeflow.llm.queries import quality_model
from changeflow.llm.scratch import free_name, written
from changeflow.llm.ship import shipped


@shipped
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go. Columns keep their names and values, whatever they are."""
    model = quality_model(spark, sf_dir, docs.select("doc_id", "text", "n_chars"))
    score = free_name(docs, "_score")
    return quality.score_quality(docs, model, score=score).filter(F.col(score) >= 0.5).drop(score)


def _nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, _mark, _node) of all ids that have several texts: a number no id has for each text,
    in the order of ids and texts' hashes."""
    pairs = docs.select("doc_id", _mark())
    several = pairs.groupBy("doc_id").agg(F.min("_mark").alias("lo"), F.max("_mark").alias("hi")).filter("lo <> hi")
    pairs = pairs.join(several.select("doc_id"), "doc_id", "left_semi").distinct()
    pairs = pairs.repartitionByRange("doc_id", "_mark").withColumn("_part", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy("_part").orderBy("doc_id", "_mark")).cast("long")
    pairs = written(pairs.withColumn("_place", place), "pipeline-nodes")
    sizes = sorted((r["_part"], r["count"]) for r in pairs.groupBy("_part").count().collect())
    total = sum(n for _, n in sizes)
    before, node = 0, F.lit(None).cast("long")
    if total:
        least, most = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
        before = most if most + total < 1 << 63 else least - total - 1
        if before < -(1 << 63):
            raise ValueError("no free numbers above or below the ids")
        starts = []
        for part, n in sizes:
            starts += [F.lit(part), F.lit(before).cast("long")]
            before += n
        node = F.create_map(*starts)[F.col("_part")] + F.col("_place")
    return pairs.select("doc_id", "_mark", node.alias("_node"))


def _mark() -> Column:
    return F.coalesce(F.sha2("text", 256), F.lit("")).alias("_mark")


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the least id.

    A document is an id with a text. Rows that repeat both are one, of which the first by
    source, language and length stays; different texts of one id are documents of their own,
    and of those that are near each other the one of the least hash stays. Rows without an id
    stay.
    """
    mark, node, first = (free_name(docs, name) for name in ("_mark", "_node", "_first"))
    nodes = written(_nodes(docs.filter("doc_id IS NOT NULL")), "pipeline-nodes")
    nodes = nodes.select("doc_id", F.col("_mark").alias(mark), F.col("_node").alias(node))
    named = docs.filter("doc_id IS NOT NULL").withColumn(mark, _mark())
    named = named.join(nodes, ["doc_id", mark], "left").withColumn(node, F.coalesce(node, "doc_id"))
    pairs = named.select(F.col(node).alias("_node"), "text")
    found = written(minhash.near_duplicates(pairs, "_node"), "pipeline-near")
    known = nodes.select(F.col(node).alias("_node"), F.col("doc_id").alias("_id"))
    found = found.select("_node", "component_id").distinct().join(known, "_node", "left")
    kept = found.groupBy("component_id").agg(F.min(F.struct(F.coalesce("_id", "_node").alias("id"), "_node")).alias("m"))
    named = named.join(kept.select(F.col("m._node").alias(node)), node, "left_semi")
    place = F.row_number().over(Window.partitionBy(node).orderBy("source", "lang", "n_chars"))
    named = named.withColumn(first, place).filter(F.col(first) == 1).select(*docs.columns)
    return named.unionByName(docs.filter("doc_id IS NULL"))


@shipped
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages an earlier document has go. A character that is cut goes as a whole. ``n_chars`` is
    counted again; other columns keep their names and values, whatever they are."""
    held = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    apart = {f"_column_{i}": c for i, c in enumerate(held)}  # no name an operator adds
    given = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(name) for name, c in apart.items()])
    found = suffix.remove_repeats(given, with_text=True).withColumnRenamed("_kept_text", "text")
    found = found.withColumn("n_chars", F.length("text").cast("long"))
    found = found.select("doc_id", "text", "n_chars", *[F.col(name).alias(c) for name, c in apart.items()])
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


@shipped
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.take(docs)


@shipped
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("minhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed_sequences),
]

# Models, hashes of the engine and greedy packing have no SQL form. Tests compare operators with
# brute force or their rules; the stages as a whole are compared with nothing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
