import itertools
import random

import pytest
from conftest import rows_of

from docweave.operators.postings import weighted_postings
from docweave.operators.segment import best_cut, segment, trie_of, word_lengths


def brute(text, words):
    """All ways to cut a text, the best by definition: (covered characters, fewest words, longest first)."""

    def ways(at):
        if at == len(text):
            yield ()
            return
        for rest in ways(at + 1):
            yield (0, *rest)
        for n in range(1, len(text) - at + 1):
            if text[at : at + n] in words:
                for rest in ways(at + n):
                    yield (n, *rest)

    best = max(ways(0), key=lambda w: (sum(w), -sum(n > 0 for n in w), w))
    out, at = [], 0
    for wordly, group in itertools.groupby(best, key=bool):
        for n in [sum(1 for _ in group)] if not wordly else group:
            out.append(text[at : at + n])
            at += n
    return out


def cut(text, words):
    return best_cut(text, word_lengths(trie_of(list(words)), text))


def test_best_cut_agrees_with_all_ways():
    rng = random.Random(1)
    for _ in range(400):
        words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(0, 6))}
        text = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 9)))
        assert cut(text, words) == brute(text, words), (text, words)


@pytest.mark.parametrize(
    "text, words, expected",
    [
        ("研究生命起源", {"研究", "研究生", "生命", "起源"}, ["研究", "生命", "起源"]),  # more characters than with the longest first
        ("新电影abc12上映", {"电影"}, ["新", "电影", "abc12", "上", "映"]),
        ("a, b.c", set(), ["a", "b", "c"]),
        ("", {"x"}, []),
    ],
)
def test_words_and_what_is_left(text, words, expected):
    assert cut(text, words) == expected


@pytest.mark.parametrize("chars", [0, 1_000_000])
def test_broadcast_and_join_agree(spark, chars):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcä") for _ in range(rng.randrange(1, 6))) for _ in range(40)]
    rows = [(i, "".join(rng.choice("abcÄd ") for _ in range(rng.randrange(0, 30))), rng.choice(["AB", None, ""])) for i in range(120)]
    rows += [(1000, "ab" * 2000, None)]
    df = spark.createDataFrame(rows, "id long, name string, alias string")
    dictionary = spark.createDataFrame([(w, 1) for w in [*words, "", "AB"]], "word string, update_time int")
    got = {r["id"]: (r["name"], r["alias"]) for r in segment(df, "id", ["name", "alias"], dictionary, chars).collect()}
    known = {w.lower() for w in [*words, "AB"]}
    for i, name, alias in rows:
        assert got[i] == (cut(name.lower(), known), None if alias is None else cut(alias.lower(), known))


def test_empty_inputs(spark):
    df = spark.createDataFrame([(1, "ab c")], "id long, name string")
    none = spark.createDataFrame([], "word string")
    for chars in (0, 10):
        assert segment(df, "id", ["name"], none, chars).first()["name"] == ["ab", "c"]
        assert segment(df.limit(0), "id", ["name"], none, chars).count() == 0


def test_a_large_dictionary_is_not_collected(spark):
    df = spark.createDataFrame([(1, "abc")], "id long, name string")
    words = spark.createDataFrame([("ab",)], "word string")
    joined = segment(df, "id", ["name"], words, 0)
    assert "LeftSemi" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_segmented_fields_add_their_weight(spark):
    df = spark.createDataFrame([(1, "ab", ["ab", "ab", "x"], None)], "id long, spelled string, name array<string>, alias array<string>")
    got = rows_of(weighted_postings(df, "id", {"spelled": 20}, {"name": 10, "alias": 5}))
    assert got == [("a", 1, 20), ("ab", 1, 30), ("x", 1, 10)]


def test_weights_of_repeated_and_null_keys_and_null_words_add_up(spark):
    rows = [(1, "ab a", ["x", None]), (2, "a", None), (2, "ab", ["a", "a"]), (None, "a", ["x"]), (None, None, ["x"]), (None, "", [])]
    df = spark.createDataFrame(rows, "id bigint, spelled string, name array<string>")
    got = rows_of(weighted_postings(df, "id", {"spelled": 20}, {"name": 10}))
    expected = [("a", 1, 20), ("ab", 1, 20), ("x", 1, 10), (None, 1, 10), ("a", 2, 50), ("ab", 2, 20), ("a", None, 20), ("x", None, 20)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_postings_of_keys_that_come_once_are_not_aggregated(spark):
    """A task's memory would grow with the postings of its rows."""
    df = spark.createDataFrame([(i, f"word{i} other") for i in range(50)], "id bigint, spelled string")
    plan = weighted_postings(df, "id", {"spelled": 20})._jdf.queryExecution().optimizedPlan().toString()
    once, several = plan.split("LeftAnti")[0], plan.split("LeftSemi")[0].split("LeftAnti")[1]
    assert "Generate" in once and "Aggregate" not in once and "Aggregate" in several
