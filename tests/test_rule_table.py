import random
import re

import pytest
from conftest import rows_of

from docweave.operators.rule_table import effective_by_table, match_rules, required_text, rules_frame
from docweave.operators.rules import Rule, effective_rules, rule_match

CATALOG = [("db_a", "fm_x", True), ("db_a", "FM_Y", True), ("db_b", "fm_x", False), ("other", "fm_z", True), ("db_a", "fm_x", True)]


@pytest.mark.parametrize(
    "pattern, text",
    [
        ("^fm_(view|error)$", ""), ("db_app.*", "db_app"), ("abc+d", "abc"), ("abc?de", "ab"), ("a{2}bcd", "bcd"), (r"a\\.b\\_c", "a.b_c"), (r"ab\\dcde", "cde"),
        ("x[abc]yz", "yz"), ("(abc)?de", "de"), ("a(?i)b", "a"), (r"\\Qa.b\\E", ""), ("[a[b]]cde", ""), (".*", ""), ("^..$", ""), ("abc*", "ab"),
    ],
)
def test_required_text(pattern, text):
    assert required_text(pattern.replace("\\\\", "\\")) == text


def test_required_text_is_in_every_match():
    rng = random.Random(3)
    pieces = ["ab", "c", "d_", ".", ".*", "e+", "f?", "[gh]", "(ij)?", r"\\d", r"\\.", "^", "$", "k{0,2}", "lm"]
    for _ in range(2000):
        pattern = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6))).replace("\\\\", "\\")
        name = "".join(rng.choice(["ab", "c", "d_", "e", "f", "g", "ij", "1", ".", "k", "lm"]) for _ in range(8))
        if re.search(pattern, name):
            assert required_text(pattern) in name, (pattern, name)


RULES = [
    Rule(["db_a"], ["fm_y"], structure="string"),
    Rule(["db_.*"], ["x$"], structure="string", exclude_databases=["*"], exclude_tables=["FM_Z"]),
    Rule(["*"], ["*"], structure="string"),
    Rule(["*", "DB_B"], ["Fm_.+", "fm_x"], structure="string", exclude_databases=["^db_b"], exclude_tables=["*"]),
]


def test_agrees_with_the_expression(spark, frame):
    catalog = frame(CATALOG, "db string, tbl string, has_key boolean")
    for rules in (RULES, RULES[:1], RULES[1:2], RULES[2:3], RULES[3:]):
        table = rules_frame(spark, rules)
        columns = ["db", "tbl", "rule_id"]
        assert rows_of(match_rules(catalog, table).select(columns)) == rows_of(rule_match(catalog, rules).select(columns))
        assert rows_of(effective_by_table(catalog, table).select(columns)) == rows_of(effective_rules(catalog, rules).select(columns))


def test_ten_thousand_rules(spark, frame):
    rng = random.Random(5)
    names = [f"t_{rng.randrange(10**6):06d}" for _ in range(300)]
    catalog = frame([(f"db{i % 7}", n) for i, n in enumerate(names)], "db string, tbl string")
    rows = []
    for i in range(10_000):
        known = rng.choice(names)
        table = rng.choice([known, f"t_{rng.randrange(10**6):06d}", f"^{known[:5]}.*", f"{known[3:7]}$", known.upper(), f"{known[:4]}[0-9]+{known[-1]}"])
        rows.append((i, rng.random() < 0.1, rng.choice(["*", f"db{i % 9}", f"^db[{i % 5}-{i % 5 + 2}]$", "DB1"]), table))
    table = spark.createDataFrame(rows, "rule_id long, excludes boolean, db string, tbl string")

    def matcher(pattern):
        if pattern == "*":
            return lambda name: True
        if set(pattern) & set("\\.+*?()|[]{}^$"):
            return re.compile(pattern, re.I).search
        return lambda name: name.lower() == pattern.lower()

    tables, expected = [(r["db"], r["tbl"]) for r in catalog.collect()], set()
    for i, out, db, tbl in rows:
        if not out:
            of_db, of_tbl = matcher(db), matcher(tbl)
            expected |= {(d, n, i) for d, n in tables if of_tbl(n) and of_db(d)}
    expected = sorted(expected)
    found = match_rules(catalog, table)
    got = rows_of(found)
    assert sorted(set(got) ^ set(expected))[:5] == [] and len(got) == len(expected)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40_000 and "Cartesian" not in found._jdf.queryExecution().executedPlan().toString()


def test_too_many_open_patterns(spark, frame):
    catalog = frame([("a", "b")], "db string, tbl string")
    table = spark.createDataFrame([(i, False, "a", f"^.{{{i}}}$") for i in range(5)], "rule_id long, excludes boolean, db string, tbl string")
    assert rows_of(match_rules(catalog, table)) == [("a", "b", 1)]
    with pytest.raises(ValueError):
        match_rules(catalog, table, most_open=4)
