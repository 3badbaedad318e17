"""Operators as filters of a table of documents: what is kept, in all its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import quality_classifier as quality
from starloom.llm import quality_rules as rules
from starloom.llm.jaccard_join import near_duplicates
from starloom.session import cut_lineage, join_cell_table

def _renamed(docs: DataFrame) -> DataFrame:
    """All columns under names that no operator uses."""
    return docs.toDF(*[f"_stage_{k}" for k in range(len(docs.columns))])


def _name(docs: DataFrame, column: str) -> str:
    return f"_stage_{docs.columns.index(column)}"


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents by their own names."""
    return rows.select(*[F.col(f"_stage_{k}").alias(name) for k, name in enumerate(docs.columns)])


def keep_by_rules(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Documents that pass the quality rules and whose host does."""
    judged = rules.apply_quality_rules(_renamed(docs), _name(docs, text), _name(docs, host))
    return _restored(judged.filter("kept"), docs)


def keep_by_score(docs: DataFrame, model: quality.Model, text: str = "text") -> DataFrame:
    """Documents that the classifier scores at its threshold or above."""
    scored = quality.add_quality_score(_renamed(docs), model, _name(docs, text))
    return _restored(scored.filter(F.col("score") >= quality.THRESHOLD), docs)


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class of near duplicates; of rows equal in key and text, one.

    The rows to leave out are few and joined by broadcast while they are small.
    """
    found = cut_lineage(near_duplicates(docs, key, text).select("row_hash", "kept"))
    gone = found.filter(~F.col("kept")).select("row_hash").distinct()
    again = found.filter("kept").groupBy("row_hash").count().filter(F.col("count") > 1).select("row_hash")
    gone, again = cut_lineage(gone), cut_lineage(again)
    own = _renamed(docs)
    hashed = own.withColumn("row_hash", F.xxhash64(_name(docs, key), _name(docs, text)))
    rest = join_cell_table(hashed, gone, "row_hash", "left_anti")
    if not again.isEmpty():
        repeated = join_cell_table(rest, again, "row_hash", "left_semi").dropDuplicates(["row_hash"])
        rest = join_cell_table(rest, again, "row_hash", "left_anti").unionByName(repeated)
    return _restored(rest, docs)
