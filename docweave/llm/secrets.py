"""Secrets in texts: fixed patterns, and strings that a primed compressor can't explain.

A sensitive word (``SENSITIVE``) makes the rest of its line and the ``LINES_AFTER`` lines after it a sensitive context; a key block reaches
from its begin mark to its end mark. Every string in it of at least ``LEAST_CHARS`` characters of the usual alphabets of keys that mixes
digits with letters, or of ``LEAST_LETTERS`` without a digit, is a candidate, however long. It is compressed by zstandard behind the code around it, with a
dictionary of the words of identifiers that stand around sensitive words anywhere in the corpus: the marginal bytes are what the candidate adds to its
context. A long string is measured in pieces, each behind the one before. A string that adds at least ``NOVELTY`` bytes a character is reported as
``novel``; names, words, versions and placeholders are explained by dictionary and context and add little.

The dictionary holds the words found in the most different contexts of all documents, at most ``DICTIONARY_BYTES``, which bounds what is
broadcast. A context counts once, however many copies of a document have it, and words are plain and shorter than a candidate, so
neither a secret nor a part of one gets in and hides its copies. Texts are read once; only candidates and their contexts go on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from docweave.llm.words import text_chunks
from docweave.session import materialize

KINDS = ("assign", "access", "hex", "novel")
SENSITIVE = ("passw", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private", "credential", "bearer")
LINES_AFTER = 2
CONTEXT = 96
LEAST_CHARS = 12
LEAST_LETTERS = 24
PIECE = 1024
NOVELTY = 0.7
DICTIONARY_BYTES = 16_384
DICTIONARY_WORDS = 2_048
LEVEL = 9

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_STEMS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_MAP = bytes(ord("h") if chr(i) in "0123456789abcdef" else ord(".") for i in range(256))
_SENSITIVE = re.compile("|".join(SENSITIVE), re.I | re.A)
_STEMS = tuple(s.encode() for s in SENSITIVE)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)
_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*KEY[A-Z0-9 ]*-----.*?-----END ", re.S)
_WORD = r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])"


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in code points, in order; the raw bytes only decide which patterns are worth a try."""
    lower = text.lower()
    assign = any(stem in lower for stem in _ASSIGN_STEMS)
    access = b"AKIA" in text
    hexes = b"h" * 24 in text.translate(_HEX_MAP)
    if not (assign or access or hexes):
        return []
    decoded = text.decode()
    spans = []
    if assign:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(decoded) if len(m[2]) >= 6]
    if access:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(decoded) if len(m[0]) >= 20]
    if hexes:
        spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(decoded)]
    return sorted(spans)


def zones(text: str) -> list[tuple[int, int]]:
    """The sensitive contexts, joined where they touch: a string that begins inside of one is in it."""
    found = [m.span() for m in _BLOCK.finditer(text)]
    line_end = reach = -1  # of the line of the word before, and of the lines after it
    for word in _SENSITIVE.finditer(text):
        if word.end() > line_end:
            line_end = reach = _end_of_line(text, word.end())
            for _ in range(LINES_AFTER):
                reach = _end_of_line(text, min(reach + 1, len(text)))
        found.append((word.end(), reach))
    out: list[tuple[int, int]] = []
    for begin, end in sorted(found):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _end_of_line(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def candidates(text: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, context before, string) in sensitive contexts; each string once."""
    lower = text.lower()
    if not any(stem in lower for stem in _STEMS):
        return []
    decoded, found, done = text.decode(), [], 0
    for begin, end in zones(decoded):
        for m in _CANDIDATE.finditer(decoded, max(begin, done)):
            if m.start() >= end:
                break
            done, string = m.end(), m[0]
            letters = any(c.isalpha() for c in string)
            if letters and (len(string) >= LEAST_LETTERS or any(c.isdigit() for c in string)):
                found.append((m.start(), m.end(), decoded[max(0, m.start() - CONTEXT) : m.start()], string))
    return found


_ROWS = "doc_id long, n_assign long, n_access long, n_hex long, base string, found array<struct<at: long, to: long, context: string, string: string>>"
_FOUND = pa.list_(pa.struct([("at", pa.int64()), ("to", pa.int64()), ("context", pa.string()), ("string", pa.string())]))


def spell(spans: list[tuple[int, int, int]], kinds=KINDS) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in text_chunks(batch, "text"):
            spans = [base_spans(t) if t else [] for t in texts]
            found = [
                [dict(zip(("at", "to", "context", "string"), c)) for c in candidates(t)] if t else [] for t in texts
            ]
            counts = [pa.array([sum(s[1] == k for s in row) for row in spans], pa.int64()) for k in range(3)]
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(first, len(texts)),
                    *counts,
                    pa.array([spell(row) for row in spans], pa.string()),
                    pa.array(found, _FOUND),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base", "found"],
            )


class Novelty:
    """Marginal compressed bytes of strings, given a dictionary."""

    def __init__(self, dictionary: bytes):
        prime = None
        if len(dictionary) >= 8:
            prime = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            prime.precompute_compress(level=LEVEL)
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=prime, **options)

    def __call__(self, context: str, string: str) -> float:
        """Bytes a character that the string adds behind its context, piece by piece."""
        added = 0
        for at in range(0, len(string), PIECE):
            before, piece = (context if at == 0 else string[at - CONTEXT : at]).encode(), string[at : at + PIECE].encode()
            added += len(self.compressor.compress(before + piece)) - len(self.compressor.compress(before))
        return added / max(len(string), 1)


def context_dictionary(rows: DataFrame) -> bytes:
    """The words of the most different contexts, the most frequent last, where matches are cheapest."""
    contexts = rows.select(F.explode("found.context").alias("context")).distinct()
    words = contexts.select(F.explode(F.array_distinct(F.split("context", _WORD))).alias("word"))
    words = words.filter(F.length("word").between(3, LEAST_CHARS - 1)).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    top = [r["word"] for r in words.orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).collect()]
    kept, size = [], 0
    for word in top:
        size += len(word) + 1
        if size > DICTIONARY_BYTES:
            break
        kept.append(word)
    return " ".join(reversed(kept)).encode()


def _judge(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        for batch in batches:
            bases, founds = batch.column("base").to_pylist(), batch.column("found").to_pylist()
            spans, counts = [], []
            for base, found in zip(bases, founds):
                known = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                new = [
                    (c["at"], 3, c["to"])
                    for c in found
                    if not any(a < c["to"] and c["at"] < b for a, _, b in known) and novelty(c["context"], c["string"]) >= NOVELTY
                ]
                counts.append(len(new))
                spans.append(spell(sorted(known + new)))
            columns = [batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex", "base")]
            yield pa.record_batch(
                [*columns, pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base", "n_novel", "spans"],
            )

    return run, "doc_id long, n_assign long, n_access long, n_hex long, base string, n_novel long, spans string"


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_novel, ``base`` and ``spans`` as kind:start:end lists.

    A null text is empty. A novel string that overlaps a base span is not reported again. Rows that
    repeat are judged alike; a row without id keeps its null. No rows in, no rows out.
    """
    rows = materialize(documents.select("doc_id", "text").mapInArrow(_scan, _ROWS), "secret-candidates")
    run, schema = _judge(context_dictionary(rows))
    return rows.mapInArrow(run, schema)


def secret_digest(documents: DataFrame) -> DataFrame:
    """The spans of the patterns as a hash, all spans as text."""
    return find_secrets(documents).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_novel"
    )
