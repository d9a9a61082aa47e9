"""From raw documents to a training mix: five stages, each one operator of gridstone.llm.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with their columns. The last one
returns every document as often as the mix takes it. The near-duplicate stage judges every row by
its text, with or without an id, and does not take rows of one id for one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstone.llm.common import missing_last, read, written
from gridstone.llm.decontaminate import find_items
from gridstone.llm.language import UNKNOWN, identify, learn
from gridstone.llm.minhash_dedup import near_duplicates
from gridstone.llm.mixing import mix_sources, n_words
from gridstone.llm.pseudonyms import replace_personal

KEY = "a key that the owner of the data chooses and keeps"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no language (null, or without a letter) go, and no others: the score is not used, so a text
    in a language that no document teaches passes. The same holds when nothing can be learned."""
    model = learn(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    said = identify(docs, model, docs.columns, names=("__lang_pred", "__score"))
    return said.where(F.col("__lang_pred") != UNKNOWN).drop("__lang_pred", "__score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the smallest id, none being the largest.
    Texts without words are near nothing."""
    node = F.when(F.col("text").isNotNull(), F.xxhash64("text"))
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind))
    rows = docs.withColumns({"__node": node, "__id": missing_last("doc_id"), "__row": hashed})
    texts = rows.groupBy("__node").agg(F.min(F.struct("__id", "__row")).alias("least"), F.count("*").alias("n")).select("__node", "least.*", "n")
    judged = near_duplicates(docs.select(node.alias("__node"), "text"), key="__node", width=5, percent=80)
    groups = judged.where("n_shingles > 0").select("__node", "component_id").distinct().join(texts, "__node")
    best = groups.groupBy("component_id").agg(F.min(F.struct("__id", "__node")).alias("best"))
    decided = groups.join(best, "component_id").withColumn("stays", F.col("__node") == F.col("best.__node"))
    named = written(decided.where("not stays or n > 1").select("__node", "__id", "__row", "stays"), "not_single")
    single = rows.join(named.select("__node"), "__node", "left_anti").select(*docs.columns)
    repeated = rows.join(named.where("stays"), ["__node", "__id", "__row"], "left_semi").dropDuplicates(["__node"]).select(*docs.columns)
    return single.unionByName(repeated)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = find_items(docs, read(spark, sf_dir, "benchmark"), docs.columns, name="__items")
    return found.where(F.size("__items") == 0).drop("__items")


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of the same format."""
    return replace_personal(docs, KEY, count="__replaced").drop("__replaced")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, numbered by ``copy``, with its source's figures;
    columns of these names that the documents had are replaced."""
    docs = docs.drop("size", "turn", "source_size", "target", "taken", "copies", "copy")
    taken = mix_sources(docs.select("doc_id", "text", "source"))
    same = ("doc_id", "source", "size", "turn")
    figures = taken.where("copies > 0").select(*(F.col(c).alias(f"__{c}") for c in same), "source_size", "target", "taken", "copies")
    sized = docs.withColumn("size", n_words(F.col("text")))
    # Rows that agree in id, source and size share their copies by number.
    numbered = sized.withColumn("turn", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("text"))).cast("long"))
    fits = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in same]
    mixed = numbered.join(figures, fits).drop("turn", *(f"__{c}" for c in same))
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("personal", personal), ("mixing", mixing)]
#: The keyed network, the learned language model and the random rounding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
