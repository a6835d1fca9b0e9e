"""Corpus preparation in five stages: toxicity, exact and near duplicates, repeated passages, packing.

Each stage takes what its predecessor kept and calls one operator of tanisight.llm; all but the last
return the columns of documents.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tanisight.llm import exact, neardup, packing, substrings, toxicity
from tanisight.llm.common import as_bytes, small_slices, written
from tanisight.llm.queries import BYTE_BPE, held, table
from tanisight.session import materialize, scratch_path, scratch_scope, ship_package

TOXIC = 0.7
NEAR = 80  # percent of shared shingles from which the later of two texts goes


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7, with all their columns. Null and empty texts have no toxic term and stay."""
    labels = table(spark, sf_dir, "labels")
    machine = toxicity.train(spark, docs, labels, ~held(toxicity.fold(F.col("doc_id")), 1))
    if machine is None:
        return docs
    model = spark.sparkContext.broadcast(machine)

    def clean(batches):
        for batch in small_slices(batches, 2000):
            yield batch.filter(pa.array(model.value.scores(as_bytes(batch)) < TOXIC))

    return docs.mapInArrow(clean, docs.schema)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that the table has already."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for k in range(len(taken) + 1) if (n := "_" * k + name).lower() not in taken) for name in names]


def keep(docs: DataFrame, judge) -> DataFrame:
    """Documents that judge() marks as kept. Rows that repeat a doc_id and its text become one row."""
    own, = fresh(docs, "id")
    with scratch_scope(docs.sparkSession):
        verdicts = judge()
        per_id = materialize(verdicts.groupBy(F.col("doc_id").alias(own)).agg(F.max("kept").alias("kept"), F.count("*").alias("rows")))
    dropped, again = per_id.filter("not kept").select(own), per_id.filter("kept and rows > 1").select(own)
    stay = docs.join(dropped, docs["doc_id"].eqNullSafe(dropped[own]), "left_anti")
    if again.isEmpty():
        return stay
    same = stay["doc_id"].eqNullSafe(again[own])
    return stay.join(again, same, "left_anti").union(stay.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for the case of A-Z, the one of the largest doc_id. Null counts as empty text."""
    ship_package(spark)
    return keep(docs, lambda: exact.deduplicate(spark, docs).select("doc_id", "kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 percent of shared five-word shingles, the one of the smallest doc_id. Those without a word stay."""
    return keep(docs, lambda: neardup.link_copies(spark, docs, NEAR).select("doc_id", "kept"))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; texts of which nothing is left go.

    A text that loses nothing stays as it is; otherwise its words are joined by one space, and n_chars,
    if there, is counted anew. Of rows that share a doc_id each loses its own passages. Rows meet the runs
    of words they lose in one join, by their keys.
    """
    row, cuts = fresh(docs, "row", "cuts")
    with scratch_scope(spark):
        found = materialize(substrings.repeats(spark, docs))
    runs = written(found.select(F.col("row").alias(row), F.col("cuts").alias(cuts)), "cuts")
    joined = docs.withColumn(row, substrings.row_key(docs)).join(runs, row, "left")
    own = joined.columns.index("text")

    def cut(batches):
        for batch in small_slices(batches, 2000):
            lost = batch.column(cuts).to_pylist()
            if any(x is not None for x in lost):
                texts = [t if x is None else substrings.cut_words(t, x) for t, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), lost, strict=True)]
                batch = batch.set_column(own, "text", pa.array(texts, pa.binary()).cast(batch.column("text").type, safe=False))
            yield batch

    after = joined.mapInArrow(cut, joined.schema).filter(F.col(cuts).isNull() | (F.col("text") != ""))
    new = {}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(cuts).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return after.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    ship_package(spark)
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_passages),
    ("packing", pack),
]

#: A fitted model and packing cannot be stated in SQL; tests compare the stages, one by one and as a run, with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
