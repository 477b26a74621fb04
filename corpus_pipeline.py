"""From raw documents to training shards.

Five stages, each one operator of ``cloakwork.llm``; every stage reads what the one
before has written and works on all of it:

1. ``quality``: texts that the weakly supervised rules reject go;
2. ``near``: one document of each group of near duplicates stays;
3. ``decontaminate``: documents that hold benchmark passages go;
4. ``mix``: documents are left out or repeated as the mix takes them;
5. ``shard``: every document gets its shard and its slot.

Stages 1 to 4 return the columns of ``documents``.  Tables between the stages lie in
the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm import decontaminate, mixture, near, ring, rules
from cloakwork.llm.common import guarded, hidden, same, shown, table
from cloakwork.session import materialize


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return near.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.drop_documents(docs, table(spark, folder, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix takes its words, rounded to whole documents.

    A source above its target loses documents, one below it repeats some, so the words
    of each source come within half a document of what the mix takes.  Rows equal in
    key, text and source get equal numbers of copies; texts without words are not drawn.
    """
    got = mixture.taken(mixture.sized(docs)).groupBy("doc_id", "crc", "source").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    other = materialize(got.select("doc_id", "crc", "source", copies.alias("copies")).filter("copies <> 1"))
    side = guarded(other, other.count())
    plain, names = hidden(docs)
    named = plain.select("*", F.col(names["doc_id"]).alias("doc_id"), F.col(names["source"]).alias("source"), F.xxhash64(F.coalesce(names["text"], F.lit(""))).alias("crc"))
    met = named.join(side, same(named, side, ["crc", "doc_id", "source"]), "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    return shown(met.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))), names)


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return ring.shards_of(docs)


STAGES = [("quality", quality), ("near", near_duplicates), ("decontaminate", benchmark), ("mix", mix), ("shard", shard)]

#: The near-duplicate search and the fit of the rules are not expressed in SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, folder))
    return docs
