"""JSON documents that hold a list of records, with literal rows as a fallback."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERSON = "struct<craft:string,name:string>"
DOCUMENT = f"number int, people array<{PERSON}>"

# Rows used when the documents cannot be read.
FALLBACK_PEOPLE = [
    ("ISS", "Oleg Kononenko"),
    ("ISS", "Nikolai Chub"),
    ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"),
    ("ISS", "Michael Barratt"),
    ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"),
    ("ISS", "Butch Wilmore"),
    ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"),
    ("Tiangong", "Li Cong"),
    ("Tiangong", "Ye Guangfu"),
]


def _incomplete() -> Column:
    return F.col("number").isNull() | F.col("people").isNull()


def complete(documents: DataFrame) -> DataFrame:
    """``documents``; one without a number or a list of records fails the query, as a bad cast does."""
    message = F.format_string("incomplete document: number %s", F.col("number"))
    # The check is part of the list itself: a filter beside it could run after one that drops missing lists.
    checked = F.when(_incomplete(), F.raise_error(message).cast(f"array<{PERSON}>")).otherwise(F.col("people"))
    return documents.withColumn("people", checked).where(F.size("people") >= 0)


def parse_documents(df: DataFrame, json_col: str) -> DataFrame:
    """Add ``number`` and ``people`` parsed from a JSON text column; malformed text fails the query."""
    parsed = F.from_json(json_col, DOCUMENT, {"mode": "FAILFAST"})
    documents = df.withColumn("doc", parsed).select(
        *df.columns, F.col("doc.number").alias("number"), F.col("doc.people").alias("people")
    )
    return complete(documents)


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Documents from JSON files: one per line, or one per file with ``multi_line``."""
    return spark.read.json(path, schema=DOCUMENT, multiLine=multi_line)


def fallback_document(spark: SparkSession) -> DataFrame:
    people = [{"craft": craft, "name": name} for craft, name in FALLBACK_PEOPLE]
    return spark.createDataFrame([(len(people), people)], DOCUMENT)


def documents_or_fallback(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The documents at ``path``; the literal rows if there is none that can be used.

    One usable document is enough to tell, so the input isn't read twice. Next to usable documents, an
    incomplete or malformed one fails the query.
    """
    try:
        documents = read_documents(spark, path, multi_line)
    except AnalysisException:
        return fallback_document(spark)
    if documents.where(~_incomplete()).isEmpty():
        return fallback_document(spark)
    return complete(documents)
