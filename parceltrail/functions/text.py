"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word with what follows it up to the next one, or whatever precedes the first word.
_WORDS = r"[\p{L}\p{N}]++[^\p{L}\p{N}]*+|[^\p{L}\p{N}]++"


def capitalise_words(col: Column) -> Column:
    """First letter of every alphanumeric run in upper case, the rest in lower case.

    Spark's ``initcap`` starts a word only after a blank ("Mogi-guacu D'oeste"); here every
    character that is neither letter nor digit ends a word ("Mogi-Guacu D'Oeste"). A letter
    without a one-letter upper case, such as the German sharp s, stays as it is.
    """

    def capitalise(word: Column) -> Column:
        first = F.left(word, F.lit(1))
        upper = F.upper(first)
        return F.concat(F.when(F.length(upper) == 1, upper).otherwise(first), F.substr(word, F.lit(2)))

    words = F.regexp_extract_all(F.lower(col), F.lit(_WORDS), F.lit(0))
    return F.array_join(F.transform(words, capitalise), "")


def category_label(col: Column) -> Column:
    """``moveis_decoracao`` becomes ``Moveis Decoracao``; a missing category gets a label."""
    return F.coalesce(
        capitalise_words(F.replace(col, F.lit("_"), F.lit(" "))),
        F.lit("Sem Categoria"),  # fixed value
    )
