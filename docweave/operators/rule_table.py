"""Many rules, as a table: the plan does not grow with them.

A rule's names and patterns become rows. A plain name is joined to a catalogue's names. A pattern is only tried on names that hold a
piece of text which every match must have: ``GRAM`` characters of it are joined to the same characters of the names. Patterns without such a piece
(``open`` ones, ``^..$``) are few different texts in practice; they are one expression, and more than ``MOST_OPEN`` of them are an error.
``*`` on one side leaves a rule to its other side; a rule that is ``*`` on both meets every table, and may come ``MOST_OPEN`` times.

What is matched are different names, not tables: a catalogue of many tables in databases of one name pattern matches the name once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.operators.rules import _REGEX_CHARS, Rule

GRAM = 3
MOST_OPEN = 1_000
SCHEMA = "rule_id long, excludes boolean, db string, tbl string"


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """A row for every pair of a database and a table that a rule names, in lower case; what it leaves out is marked."""
    rows = []
    for i, rule in enumerate(rules):
        for excludes, databases, tables in ((False, rule.databases, rule.tables), (True, rule.exclude_databases, rule.exclude_tables)):
            rows += [(i, excludes, d, t) for d in databases if d for t in tables if t]
    return spark.createDataFrame(rows, SCHEMA)


def required_text(pattern: str) -> str:
    """The longest text that every match of a pattern holds, as far as it shows without alternatives and groups."""
    if "|" in pattern:
        return ""
    runs, run, i, depth = [], "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            escaped = pattern[i + 1 : i + 2]
            i += 1
            if depth == 0 and escaped and not escaped.isalnum():
                run += escaped
            else:
                if escaped == "Q" or escaped in "xucp0":  # quotes and codes take more characters
                    return ""
                runs.append(run)
                run = ""
        elif c == "[":
            end = pattern.find("]", i + 2 + (pattern[i + 1 : i + 2] == "^"))
            if end < 0 or "[" in pattern[i + 1 : end] or "&&" in pattern[i:end] or "\\" in pattern[i:end]:
                return ""
            i = end
            runs.append(run)
            run = ""
        elif c in "()":
            depth += 1 if c == "(" else -1
            runs.append(run)
            run = ""
        elif c in "*?{":
            runs.append(run[:-1])
            run = ""
            if c == "{":
                i = max(i, pattern.find("}", i))
        elif c in ".^$+":
            runs.append(run)
            run = ""
        elif depth == 0:
            run += c
        i += 1
    return max([*runs, run], key=len)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        patterns = batch.column("pattern").to_pylist()
        plain = [not _REGEX_CHARS & set(p) for p in patterns]
        pieces = ["" if flat else required_text(p) for p, flat in zip(patterns, plain)]
        yield pa.record_batch([batch.column("pattern"), pa.array(plain), pa.array(pieces, pa.string())], names=["pattern", "plain", "piece"])


def name_matches(names: DataFrame, patterns: DataFrame, most_open: int = MOST_OPEN) -> DataFrame:
    """(name, pattern): which of the different ``names`` (lower case) a pattern matches; ``*`` is left out."""
    kinds = patterns.filter("pattern <> '*'").distinct().mapInArrow(_described, "pattern string, plain boolean, piece string")
    exact = names.join(kinds.filter("plain").select(F.col("pattern").alias("name")), "name", "left_semi").select("name", F.col("name").alias("pattern"))
    keyed = kinds.filter(~F.col("plain") & (F.length("piece") >= GRAM)).select("pattern", F.lower(F.substring("piece", 1, GRAM)).alias("gram"))
    starts = F.sequence(F.lit(1), F.length("name") - GRAM + 1)
    grams = names.filter(F.length("name") >= GRAM).select("name", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("name"), i, F.lit(GRAM))))).alias("gram"))
    tried = grams.join(keyed, "gram").filter(F.expr("name rlike concat('(?i)', pattern)")).select("name", "pattern")
    open_ = [r["pattern"] for r in kinds.filter(~F.col("plain") & (F.length("piece") < GRAM)).select("pattern").limit(most_open + 1).collect()]
    if len(open_) > most_open:
        raise ValueError(f"more than {most_open} different patterns without {GRAM} characters that every match has")
    parts = [exact, tried]
    if open_:
        hits = F.array_compact(F.array(*[F.when(F.col("name").rlike(f"(?i){p}"), F.lit(p)) for p in open_]))
        parts.append(names.select("name", F.explode(hits).alias("pattern")))
    return reduce(DataFrame.union, parts)


def rule_pairs(catalog: DataFrame, rules: DataFrame, most_open: int = MOST_OPEN) -> DataFrame:
    """Distinct (db, tbl, rule_id, excludes) of a catalogue's tables and the rules that name them."""
    tables = catalog.select("db", "tbl", F.lower("db").alias("_db"), F.lower("tbl").alias("_tbl")).distinct()
    rules = rules.select("rule_id", "excludes", F.col("db").alias("_pdb"), F.col("tbl").alias("_ptbl"))
    plain = lambda c: F.when(F.col(c).rlike(r"[\\.+*?()|\[\]{}^$]"), F.col(c)).otherwise(F.lower(c))
    rules = rules.withColumns({"_pdb": plain("_pdb"), "_ptbl": plain("_ptbl")}).distinct()

    def hits(side: str) -> DataFrame:
        found = name_matches(tables.select(F.col(f"_{side}").alias("name")).distinct(), rules.select(F.col(f"_p{side}").alias("pattern")), most_open)
        return found.select(F.col("name").alias(f"_{side}"), F.col("pattern").alias(f"_p{side}"))

    of_db, of_tbl, out = hits("db"), hits("tbl"), ["db", "tbl", "rule_id", "excludes"]
    any_db, any_tbl = F.col("_pdb") == "*", F.col("_ptbl") == "*"
    both = rules.filter(~any_db & ~any_tbl).join(of_tbl, "_ptbl").join(tables, "_tbl").join(of_db, ["_db", "_pdb"], "left_semi")
    by_tbl = rules.filter(any_db & ~any_tbl).join(of_tbl, "_ptbl").join(tables, "_tbl")
    by_db = rules.filter(~any_db & any_tbl).join(of_db, "_pdb").join(tables, "_db")
    everywhere = rules.filter(any_db & any_tbl).select("rule_id", "excludes").distinct().limit(most_open + 1).collect()
    if len(everywhere) > most_open:
        raise ValueError(f"more than {most_open} rules for all tables")
    parts = [p.select(*out) for p in (both, by_tbl, by_db)]
    if everywhere:
        listed = F.array(*[F.struct(F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["excludes"]).alias("excludes")) for r in everywhere])
        parts.append(tables.select("db", "tbl", F.inline(listed)).select(*out))
    return reduce(DataFrame.unionByName, parts).distinct()


def match_rules(catalog: DataFrame, rules: DataFrame, most_open: int = MOST_OPEN) -> DataFrame:
    """Every (table, rule) match, as ``rules.rule_match`` gives it."""
    pairs = rule_pairs(catalog, rules, most_open).filter(~F.col("excludes")).select("db", "tbl", "rule_id")
    return catalog.join(pairs, ["db", "tbl"])


def effective_by_table(catalog: DataFrame, rules: DataFrame, most_open: int = MOST_OPEN) -> DataFrame:
    """Tables that some rule includes and none excludes, with the last including rule; one aggregation over the matches."""
    judged = rule_pairs(catalog, rules, most_open).groupBy("db", "tbl").agg(
        F.max(F.when(~F.col("excludes"), F.col("rule_id"))).alias("rule_id"), F.max("excludes").alias("_out")
    )
    kept = judged.filter(~F.col("_out") & F.col("rule_id").isNotNull()).drop("_out")
    found = catalog.join(kept, ["db", "tbl"])
    return found.filter("has_key") if "has_key" in catalog.columns else found
