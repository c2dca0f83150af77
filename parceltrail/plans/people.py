"""Messages from nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parceltrail.sources.people import complete

# Wording of the message.
GREETING = "Hello! :)"
MESSAGE = "%s is currently in space flying on the %s! %s"


def message(craft: Column, name: Column, greeting: Column) -> Column:
    return F.format_string(MESSAGE, name, craft, greeting)


def person_rows(documents: DataFrame) -> DataFrame:
    """One row per record of ``people``, next to the other columns; a document without a list fails the query."""
    others = [c for c in documents.columns if c != "people"]
    return complete(documents).select(*others, F.inline("people"))


def messages(documents: DataFrame, greeting: str = GREETING) -> DataFrame:
    """One message per record; the greeting is the same for all."""
    return person_rows(documents).withColumn(
        "message", message(F.col("craft"), F.col("name"), F.lit(greeting))
    )


def count_matches(documents: DataFrame) -> DataFrame:
    """Whether the announced ``number`` equals the number of records."""
    return documents.withColumn("count_ok", F.size("people") == F.col("number"))
