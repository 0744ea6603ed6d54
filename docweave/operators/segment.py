"""Cut texts without blanks into words of the own dictionary.

Of all ways to lay dictionary words over a text, the best covers the most characters, then has the fewest words, then
the longest word at the first place where two ways differ. What no word covers becomes words of its own: runs of letters
and digits, and single Han characters. Words are compared in lower case.

A dictionary of up to ``BROADCAST_CHARS`` characters, which is measured, becomes a trie in every task and texts are cut where they lie. A larger one is
never collected: the substrings of its word lengths are joined to it by a shuffle, and every text gets back the places of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BROADCAST_CHARS = 8_000_000
_HAN = "㐀-䶿一-鿿"
_REST = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")
_END = ""


def trie_of(words: list[str]) -> dict:
    """Words as nested dictionaries by character; ``_END`` marks a word."""
    root: dict = {}
    for word in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[_END] = True
    return root


def word_lengths(trie: dict, text: str) -> list[list[int]]:
    """For every place of a text the lengths of the words that begin there, rising."""
    out = []
    for at in range(len(text)):
        node, found = trie, []
        for i in range(at, len(text)):
            node = node.get(text[i])
            if node is None:
                break
            if _END in node:
                found.append(i + 1 - at)
        out.append(found)
    return out


def best_cut(text: str, lengths: list[list[int]]) -> list[str]:
    """The words of a text, given those that begin at every place."""
    n = len(text)
    covered, words, step = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for at in range(n - 1, -1, -1):
        best = (covered[at + 1], -words[at + 1], 0)
        for length in lengths[at]:
            best = max(best, (length + covered[at + length], -words[at + length] - 1, length))
        covered[at], words[at], step[at] = best[0], -best[1], best[2]
    out, at, gap = [], 0, 0
    while at < n:
        if step[at]:
            out += _REST.findall(text, gap, at) if gap < at else []
            out.append(text[at : at + step[at]])
            at += step[at]
            gap = at
        else:
            at += 1
    return out + _REST.findall(text, gap)


_WORDS = pa.list_(pa.string())


def _with_trie(words: DataFrame, columns: list[str]):
    shared = words.sparkSession.sparkContext.broadcast([r["word"] for r in words.collect()])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(shared.value)
        for batch in batches:
            cut = batch
            for name in columns:
                texts = batch.column(name).to_pylist()
                made = [None if t is None else best_cut(t, word_lengths(trie, t)) for t in texts]
                cut = cut.set_column(cut.schema.get_field_index(name), name, pa.array(made, _WORDS))
            yield cut

    return task


def _with_places(columns: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = batch.drop_columns(["_places"])
            found = batch.column("_places").to_pylist()
            for field, name in enumerate(columns):
                made = []
                for text, places in zip(batch.column(name).to_pylist(), found):
                    lengths: list[list[int]] = [[] for _ in text or ""]
                    for place in places or ():
                        if place["field"] == field:
                            lengths[place["at"]].append(place["n"])
                    made.append(None if text is None else best_cut(text, lengths))
                cut = cut.set_column(cut.schema.get_field_index(name), name, pa.array(made, _WORDS))
            yield cut

    return task


def _places(texts: DataFrame, key: str, columns: list[str], words: DataFrame) -> DataFrame:
    """(key, _places): where words of the dictionary stand in the texts of a row, from a join on the substring."""
    sizes = [r[0] for r in words.select(F.length("word")).distinct().collect()]  # different lengths only
    field = F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(c).alias("text")) for i, c in enumerate(columns)]))
    rows = texts.select(key, field.alias("_f")).select(key, "_f.*").filter("text <> ''")
    starts = rows.select(key, "field", "text", F.explode(F.sequence(F.lit(0), F.length("text") - 1)).alias("at"))
    tried = starts.select(key, "field", "text", "at", F.explode(F.lit(sizes).cast("array<int>")).alias("n"))
    parts = tried.filter("at + n <= length(text)").select(key, "field", "at", "n", F.substring("text", F.col("at") + 1, F.col("n")).alias("word"))
    hits = parts.join(words, "word", "left_semi")
    return hits.groupBy(key).agg(F.collect_list(F.struct("field", "at", "n")).alias("_places"))


def segment(df: DataFrame, key: str, columns: list[str], dictionary: DataFrame, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """``key`` and the words of each text column as an array under its name; a null text stays null.

    ``df`` has one row per key; ``dictionary`` has a column ``word``.
    """
    words = dictionary.select(F.lower("word").alias("word")).filter("word <> ''").distinct()
    texts = df.select(key, *[F.lower(c).alias(c) for c in columns])
    schema = ", ".join([f"`{key}` {df.schema[key].dataType.simpleString()}", *[f"`{c}` array<string>" for c in columns]])
    chars = words.agg(F.sum(F.length("word"))).first()[0] or 0
    if chars <= broadcast_chars:
        return texts.mapInArrow(_with_trie(words, columns), schema)
    placed = texts.join(_places(texts, key, columns, words), key, "left")
    return placed.select(key, *columns, "_places").mapInArrow(_with_places(columns), schema)
