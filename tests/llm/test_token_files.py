import json
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from docweave.llm import queries, token_files
from llm.conftest import EDGE_TEXTS

FILE = token_files.public_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def by_hand(rows, whole):
    """doc_id -> (start, n_tokens, crc32) by definition."""
    out, start = {}, 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*whole(text or ""), 0]
        out[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_query_agrees_with_definition(spark, sf, whole):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.QUERIES["op12_token_files"](spark, sf).collect()}
    assert got == by_hand(rows, whole)


def test_edge_texts_and_small_shards(spark, docs, whole, tmp_path):
    rows = [(i, t) for i, t in enumerate([*EDGE_TEXTS, "a<|endoftext|> b", "a\x00 b  c", "tab\tx \n y\n\n\nz ", "née l'été  x"])]
    path = str(tmp_path / "shards")
    token_files.write_token_shards(docs([*rows, (None, "no id")]), path, "byte_bpe_50k.json", shard_ids=50)
    back = token_files.read_token_shards(spark, path).collect()
    expected = by_hand([*rows, (None, "no id")], whole)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in back} == expected
    lines = [json.loads(x) for x in open(os.path.join(path, "manifest.jsonl"))]
    assert len(lines) == 4 and sum(x["documents"] for x in lines) == len(rows) + 1
    assert sorted(x["file"] for x in lines) == sorted(f for f in os.listdir(path) if f.endswith(".tok"))


def test_repeated_rows_clashing_columns_and_none(spark, whole, tmp_path):
    table = spark.createDataFrame([(5, "b b", 1, "x"), (5, "b b", 2, "y"), (3, "a", 3, "z")], "doc_id long, text string, start long, ids string")
    got = sorted(tuple(r) for r in token_files.token_digest(table, str(tmp_path / "a")).collect())
    two = zlib.crc32(np.array([*whole("b b"), 0], "<u4").tobytes())
    first = len(whole("a")) + 1
    assert got[0][:3] == (3, 0, first)
    assert got[1:] == [(5, first, 3, two), (5, first + 3, 3, two)]
    assert token_files.token_digest(table.limit(0), str(tmp_path / "b")).count() == 0


BLANKS = st.sampled_from([" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", " ", " ", "\x00", "\x1c", "\r\n", ""])
WORDS = st.sampled_from(["the", "don't", "'s", "Ärger", "12", "a1b2", "...", "<|endoftext|>", "日本", "🙂", "x" * 70, ""])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(WORDS, BLANKS), max_size=8).map(lambda p: "".join(a + b for a, b in p)), min_size=1, max_size=6))
def test_pieces_give_the_ids_of_whole_texts(whole, texts):
    encoder = ENCODERS.setdefault("one", token_files.Encoder(FILE, limit=20))  # kept over examples, and emptied often
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)] == [whole(t) for t in texts]


ENCODERS: dict = {}


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (3, 400), (5_000, 300), (600_000, 90_000), (70_001, 20_000_000)])
def test_round_trip_of_widths(n, most, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 4096)
    ids = np.random.default_rng(n).integers(0, most, n).astype("<u4")
    ranked, control, data = token_files.pack(ids)
    assert len(control) == -(-n // 4)
    blocks = list(token_files.unpack(ranked, control, data, n))
    assert np.array_equal(np.concatenate([np.empty(0, "<u4"), *blocks]), ids)


def test_frequent_ids_take_one_byte():
    ids = np.concatenate([np.full(5_000, 40_000), np.arange(1_000)]).astype("<u4")
    ranked, control, data = token_files.pack(ids)
    assert ranked[0] == 40_000 and len(data) == 5_000 + 255 + 2 * 745


def test_other_tokenizers_get_whole_texts(docs):
    file = token_files.public_path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    assert not token_files.Encoder(file).cuts
    got = token_files.tokenize(docs([(1, "Some words  here")]), file).first()["ids"]
    assert np.frombuffer(got, "<u4").tolist() == [*Tokenizer.from_file(file).encode("Some words  here", add_special_tokens=False).ids, 0]


def test_bare_words_need_no_match_of_their_own(whole, monkeypatch):
    """New words make up most of the work; only those with a line feed or marks are taken apart one by one."""
    encoder = token_files.Encoder(FILE)
    seen = []

    class Pattern:
        @staticmethod
        def fullmatch(piece, pattern=token_files._PLAIN_WORD):
            seen.append(piece)
            return pattern.fullmatch(piece)

    monkeypatch.setattr(token_files, "_PLAIN_WORD", Pattern)
    texts = ["Word other été\nfeed marks, é 12 other", "other, Word word  two feed", "marks marks, été"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in [*encoder(texts), *encoder(texts)]]
    assert got == [whole(t) for t in texts] * 2
    assert not {"Word", " other", " été", " Word", " word"} & set(seen) and {"\nfeed", " marks,", "other,", " 12"} <= set(seen)
