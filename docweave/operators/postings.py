"""Prefix postings for search-as-you-type.

Postings stay rows. A prefix shared by a third of all documents is then just many rows, never one
long list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.session import materialize

MIN_GRAM, MAX_GRAM = 1, 20
_SEPARATORS = r"[^\p{L}\p{N}]+"
# Weights of a search document's fields: spelled out name or alias, name, alias (fixed values).
SPELLED_WEIGHT, NAME_WEIGHT, ALIAS_WEIGHT = 20, 10, 5


def tokens(text: Column) -> Column:
    """Distinct lower-cased words of a text."""
    words = F.array_distinct(F.split(F.lower(text), _SEPARATORS))
    return F.filter(words, lambda word: word != "")


def prefixes(words: Column, low: int = MIN_GRAM, high: int = MAX_GRAM) -> Column:
    """Distinct prefixes of ``low`` to ``high`` characters of a list of words."""

    def of_word(word: Column) -> Column:
        lengths = F.sequence(F.lit(low), F.least(F.length(word), F.lit(high)))
        return F.transform(lengths, lambda n: F.substring(word, F.lit(1), n))

    long_enough = F.filter(words, lambda word: F.length(word) >= low)
    return F.array_distinct(F.flatten(F.transform(long_enough, of_word)))


def prefix_postings(df: DataFrame, key: str, column: str, low: int = MIN_GRAM, high: int = MAX_GRAM) -> DataFrame:
    """Distinct (``term``, ``key``) for every prefix; ``df`` has one row per key.

    The prefixes of a row are made distinct inside the row, so no shuffle is needed for it.
    """
    return df.select(key, F.explode(prefixes(tokens(F.col(column)), low, high)).alias("term"))


def prefix_index(df: DataFrame, key: str, column: str, low: int = MIN_GRAM, high: int = MAX_GRAM) -> DataFrame:
    """Per term the number of documents and the first and last of them."""
    return prefix_postings(df, key, column, low, high).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(key).alias("first_doc"), F.max(key).alias("last_doc")
    )


def weighted_postings(df: DataFrame, key: str, weights: dict[str, int], words: dict[str, int] | None = None) -> DataFrame:
    """Sum of the field weights per (``term``, ``key``) over the fields that contain the term.

    A field of ``weights`` is a text and has the prefixes of its words as terms; one of ``words`` is an array of words, as ``segment`` makes
    them, and has those.

    The weights of a row are summed inside the row, so the rows of a key that comes once are not aggregated at all: what is expanded goes
    neither through a hash table nor through a shuffle. Only rows of keys that repeat do, null among them. ``df`` is read twice.
    """

    def weighted(terms: Column, weight: int) -> Column:
        present = F.filter(F.coalesce(terms, F.array().cast("array<string>")), lambda term: term.isNotNull())
        return F.map_from_entries(F.transform(present, lambda term: F.struct(term, F.lit(weight).cast("bigint"))))

    per_field = [weighted(prefixes(tokens(F.col(column))), weight) for column, weight in weights.items()]
    of_null = F.lit(0).cast("bigint")  # a word that is null is a term too, but no key of a map
    for column, weight in (words or {}).items():
        per_field.append(weighted(F.array_distinct(F.col(column)), weight))
        of_null += F.when(F.exists(F.col(column), lambda word: word.isNull()), F.lit(weight)).otherwise(F.lit(0))
    summed = per_field[0]
    for field in per_field[1:]:
        summed = F.map_zip_with(summed, field, lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    entries = F.map_entries(summed)
    if words:
        null_entry = F.array(F.struct(F.lit(None).cast("string").alias("key"), of_null.alias("value")))
        entries = F.concat(entries, F.filter(null_entry, lambda e: e["value"] > 0))

    def expanded(rows: DataFrame) -> DataFrame:
        each = rows.select(key, F.explode(entries).alias("_e"))
        return each.select(F.col("_e.key").alias("term"), key, F.col("_e.value").alias("weight"))

    seen = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = materialize(seen.select(F.col(key).alias("_again")), "repeated-keys")
    same = F.col(key).eqNullSafe(F.col("_again"))
    once = expanded(df.join(repeated, same, "left_anti"))
    several = expanded(df.join(repeated, same, "left_semi")).groupBy("term", key).agg(F.sum("weight").alias("weight"))
    return once.unionByName(several)
