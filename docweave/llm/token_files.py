"""Token ids of texts in binary shard files: frequency-ranked ids in one to four bytes, control bytes apart.

Documents are range-partitioned and sorted by id; a Spark data source (``token_shards``) encodes them by a public tokenizer and
writes them in that order. A shard holds up to ``SHARD_IDS`` ids, more only for a single longer document:

    magic, then as 64-bit little-endian numbers: documents, ids, ranked ids, control bytes, data bytes
    document ids (8 bytes each), null flags (1 byte each), lengths (8 bytes each)
    ranked ids (4 bytes each, most frequent first, the smaller of equally frequent ones first)
    control bytes: two bits for each id, the first id lowest: bytes of its rank less one
    data bytes: the rank of each id in as few little-endian bytes as it needs

Ranks are by the shard's own counts, so a shard is written in one pass, follows its own language, and is read without the others.
Reading looks every control byte up in a table of the places and lengths of its four ranks, gathers the bytes with numpy and maps
ranks back. The driver commits one line for each shard to ``manifest.jsonl`` after all tasks have ended, so files of lost or
repeated tasks are never read; a shard's first id follows from the lines before it.

A byte-level tokenizer cuts before every space or line feed that stands between a character and a word, so texts are cut there
first and each *piece* is encoded once for all its occurrences in a worker. Other tokenizers get whole texts. Ids are the same
either way.

Defined results: null and empty texts have the end id only. Documents of equal id follow each other by a hash of the text;
null ids come first. Repeated rows are encoded each. Empty tables give a manifest without lines. Special tokens' strings in
texts become special tokens, as the library does by default; ``specials_as_text`` treats them as text.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from docweave.llm.words import text_chunks

END_ID = 0
SHARD_IDS = 4 << 20
BLOCK_IDS = 1 << 17
CACHE_PIECES = 1_600_000
LONGEST_KEPT = 64
MAGIC = b"TOKSHRD1"

_MARK = "\x00"
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def public_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers; pieces are kept over texts and tasks."""

    def __init__(self, file: str, specials_as_text: bool = False, limit: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = specials_as_text
        self.bare = Tokenizer(self.tokenizer.model)  # no cutting, no special tokens
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.cuts = self._cuts()
        self.feed = self._encode(["\n"])[0]  # not kept with the pieces: alone it is no plain one

    def _cuts(self) -> bool:
        """Whether the tokenizer works on parts that never cross a cut before a space or line feed and a word."""
        parts = json.loads(self.tokenizer.to_str())
        form, model = parts["pre_tokenizer"] or {}, parts["model"]
        byte_level = form.get("type") == "ByteLevel" and form.get("use_regex") and not form.get("add_prefix_space")
        bare = model.get("type") == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "unk_token")
        )
        # special tokens inside of a plain word would need a look at every word
        marked = all(_PLAIN_WORD.fullmatch(t["content"]) is None and not re.search(r"\s", t["content"]) for t in parts["added_tokens"])
        strips = any(t["lstrip"] or t["rstrip"] for t in parts["added_tokens"])
        return bool(byte_level) and bare and marked and not strips and parts["normalizer"] is None

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return self._encode(texts)
        rows, open_, fresh = [], [], {}
        get = self.known.get
        for text in texts:
            pieces = _pieces(text)
            row = list(map(get, pieces))
            if None in row:
                gaps = [i for i, own in enumerate(row) if own is None]
                open_.append((len(rows), pieces, gaps))
                fresh.update(zip(map(pieces.__getitem__, gaps), repeat(None)))
            rows.append(row)
        odd = self._resolve(fresh)
        for n, pieces, gaps in open_:
            if odd and not odd.isdisjoint(pieces):  # blanks that follow each other: cut with a look at both sides
                pieces = _CUT.split(texts[n])
                once = {p: None for p in pieces if p not in self.known and p not in fresh}
                self._resolve(once)
                rows[n] = [self.known.get(p) or fresh.get(p) or once[p] for p in pieces]
            else:
                row = rows[n]
                for i, own in zip(gaps, map(fresh.__getitem__, map(pieces.__getitem__, gaps))):
                    row[i] = own
        if len(self.known) > self.limit:  # begin anew with what is in use
            self.known = {p: own for _, pieces, _ in open_ for p in pieces if (own := self.known.get(p)) is not None}
        return [b"".join(row) for row in rows]

    def _resolve(self, fresh: dict[str, bytes | None]) -> set[str]:
        """Put in the ids of new pieces; those that are not one word after one blank at most are returned."""
        bare = list(filter(_BARE_WORD.fullmatch, fresh))  # most of them: a part as they are
        parts = dict.fromkeys(bare)
        words, others = [], []
        for piece in [p for p in fresh if p not in parts]:
            word = _PLAIN_WORD.fullmatch(piece)
            if word:
                groups = word.groups()
                words.append((piece, groups))
                if groups[1] not in self.known:
                    parts[groups[1]] = None
                if groups[2] and groups[2] not in self.known:
                    parts[groups[2]] = None
            else:
                others.append(piece)
        self._encode_parts(list(parts))
        fresh.update(zip(bare, map(self.known.__getitem__, bare)))
        for piece, (feed, letters, marks) in words:
            own = self.known[letters]
            if marks:
                own += self.known[marks]
            if feed:
                own = self.feed + own
            fresh[piece] = self.known[piece] = own
        odd = set()
        for piece, own in zip(others, self._encode(others)):
            fresh[piece] = own
            if not _is_plain(piece):
                odd.add(piece)
            elif len(piece) <= LONGEST_KEPT:
                self.known[piece] = own
        odd.discard("")
        return odd

    def _encode_parts(self, parts: list[str]) -> None:
        """Ids of runs of letters, after a space or not, and of runs of marks: a part each for the model."""
        if not parts:
            return
        joined = np.frombuffer("\n".join(parts).encode(), np.uint8)  # no part holds a line feed
        spelled = _SPELLED[joined].tobytes().decode("utf-32-le").split(_FEED)
        found = self.bare.encode(spelled, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(found.word_ids, minlength=len(parts)))).tolist()
        self.known.update(zip(parts, map(ids.__getitem__, map(slice, [0, *ends], ends))))


#: Byte-level vocabularies spell a byte that is no visible Latin-1 character as the next character from U+0100 on.
_SPELLED = np.arange(256, dtype="<u4")
_HIDDEN = np.flatnonzero((_SPELLED < 33) | ((_SPELLED > 126) & (_SPELLED < 161)) | (_SPELLED == 173))
_SPELLED[_HIDDEN] = 0x100 + np.arange(len(_HIDDEN))
_FEED = chr(_SPELLED[ord("\n")])
_LETTERS = " ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]{1,40}"
_BARE_WORD = re.compile(_LETTERS)
_PLAIN_WORD = re.compile(f"(\n?)({_LETTERS})([.,;:!?]{{0,8}})")


def _is_plain(piece: str) -> bool:
    """One word, after one blank at most."""
    return len(piece.split()) == 1 and not (piece[-1].isspace() or piece[1:2].isspace())


def _pieces(text: str) -> list[str]:
    """The text cut before every space and line feed."""
    if _MARK in text:
        return _CUT.split(text)
    return text.replace(" ", _MARK + " ").replace("\n", _MARK + "\n").split(_MARK)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder_of(file: str, specials_as_text: bool) -> Encoder:
    """One encoder for each worker process and file."""
    key = (file, specials_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def _encoded(batch: pa.RecordBatch, name: str, specials_as_text: bool, end_id: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, ids with the end id) of the chunks of a batch with texts."""
    encoder = encoder_of(name if os.path.isabs(name) else public_path(name), specials_as_text)
    end = np.array([end_id], "<u4").tobytes()
    for first, texts in text_chunks(batch, "text"):
        yield first, [i + end for i in encoder([(t or b"").decode() for t in texts])]


def _encode_task(name: str, specials_as_text: bool, end_id: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids in _encoded(batch, name, specials_as_text, end_id):
                doc_ids = batch.column("doc_id").slice(first, len(ids))
                yield pa.record_batch([doc_ids, pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return task


def in_order(documents: DataFrame) -> DataFrame:
    """(doc_id, text): ascending over the partitions and inside them; equal rows and ids may be spread over several."""
    placed = documents.select("doc_id", "text").withColumns({"_h": F.xxhash64("text"), "_at": F.monotonically_increasing_id()})
    order = ("doc_id", "_h", "_at")
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def tokenize(documents: DataFrame, tokenizer: str, specials_as_text: bool = False, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids) of (doc_id, text), row by row.

    ``tokenizer`` is an absolute path that all executors have, or the name of a public tokenizer's file.
    """
    slim = documents.select("doc_id", "text")
    return slim.mapInArrow(_encode_task(tokenizer, specials_as_text, end_id), "doc_id long, ids binary")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ranked ids, control bytes, data bytes) of some ids, which are places in a vocabulary and so bound the counts."""
    counts = np.bincount(ids)
    ranked = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    ranks = rank_of[ids]
    extra = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    codes = np.zeros(-(-len(extra) // 4) * 4, np.uint8)
    codes[: len(extra)] = extra
    return ranked.astype("<u4"), np.bitwise_or.reduce(codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8), axis=1), data


_WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # of the four ranks of a control byte
_PLACES = np.cumsum(_WIDTHS, axis=1) - _WIDTHS
_SIZES = _WIDTHS.sum(axis=1)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(ranked: np.ndarray, control: np.ndarray, data: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The ids again, ``BLOCK_IDS`` at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = 0
    for first in range(0, len(control), BLOCK_IDS // 4):
        part = control[first : first + BLOCK_IDS // 4]
        sizes, widths = _SIZES[part], _WIDTHS[part].ravel()[: n - 4 * first]
        ends = np.cumsum(sizes)
        places = ((ends - sizes + at)[:, None] + _PLACES[part]).ravel()[: n - 4 * first]
        ranks = padded[places].astype(np.uint32)
        for k in range(1, int(widths.max())):
            ranks |= padded[places + k].astype(np.uint32) << np.uint32(8 * k)
        yield ranked[ranks & _MASKS[widths]]
        at += int(ends[-1])


def shard_bytes(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One shard file."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    ranked, control, data = pack(flat)
    head = np.array([len(doc_ids), len(flat), len(ranked), len(control), len(data)], "<i8")
    return b"".join(
        [
            MAGIC,
            head.tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array([len(i) // 4 for i in ids], "<i8").tobytes(),
            ranked.tobytes(),
            control.tobytes(),
            data.tobytes(),
        ]
    )


def shard_rows(content: bytes, start: int = 0) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, n_tokens, ids) of a shard whose first id has the number ``start``."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    at = len(MAGIC)

    def take(n: int, kind) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(content, kind, n, at)
        at += out.nbytes
        return out

    docs, n, n_ranked, n_control, n_data = map(int, take(5, "<i8"))
    doc_ids, nulls, lengths = take(docs, "<i8"), take(docs, np.uint8), take(docs, "<i8")
    blocks = unpack(take(n_ranked, "<u4"), take(n_control, np.uint8), take(n_data, np.uint8), n)
    ends = np.cumsum(lengths)
    done, rest, seen = 0, np.empty(0, "<u4"), 0  # documents given, ids not yet given, ids decoded
    for block in blocks:
        rest = np.concatenate([rest, block])
        seen += len(block)
        upto = int(np.searchsorted(ends, seen, side="right"))
        if upto > done:
            used = int(ends[upto - 1] - (ends[done] - lengths[done]))
            cuts = np.concatenate([[0], np.cumsum(lengths[done:upto])]) * 4
            raw = rest[:used].tobytes()
            yield pa.record_batch(
                [
                    pa.array(doc_ids[done:upto], mask=nulls[done:upto].astype(bool)),
                    pa.array(ends[done:upto] - lengths[done:upto] + start),
                    pa.array(lengths[done:upto]),
                    pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
            done, rest = upto, rest[used:]


@dataclass
class Shard:
    """A line of the manifest."""

    file: str
    part: int
    documents: int
    ids: int


@dataclass
class ShardsWritten(WriterCommitMessage):
    shards: list[Shard]


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, shard_ids: int, tokenizer: str, specials_as_text: bool, end_id: int):
        self.path, self.shard_ids, self.encoding = path, shard_ids, (tokenizer, specials_as_text, end_id)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardsWritten:
        system, root = _files(self.path)
        system.create_dir(root, recursive=True)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        shards, doc_ids, ids, size = [], [], [], 0

        def flush():
            nonlocal doc_ids, ids, size
            name = f"shard-{part:06d}-{len(shards):04d}-{uuid.uuid4().hex}.tok"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(shard_bytes(doc_ids, ids))
            shards.append(Shard(name, part, len(doc_ids), size))
            doc_ids, ids, size = [], [], 0

        for batch in iterator:
            numbers = batch.column("doc_id").to_pylist()
            for first, chunk in _encoded(batch, *self.encoding):
                for doc_id, own in zip(numbers[first:], chunk):
                    if doc_ids and size + len(own) // 4 > self.shard_ids:
                        flush()
                    doc_ids.append(doc_id)
                    ids.append(own)
                    size += len(own) // 4
        if doc_ids:
            flush()
        return ShardsWritten(shards)

    def commit(self, messages: list[ShardsWritten | None]) -> None:
        system, root = _files(self.path)
        system.create_dir(root, recursive=True)
        shards = [s for m in messages if m is not None for s in m.shards]
        shards.sort(key=lambda s: s.part)  # stable: a task's own shards stay in order
        with system.open_output_stream(f"{root}/manifest.jsonl") as out:
            out.write("".join(json.dumps(asdict(s)) + "\n" for s in shards).encode())

    def abort(self, messages: list[ShardsWritten | None]) -> None:
        system, root = _files(self.path)
        for message in messages:
            for shard in message.shards if message is not None else []:
                system.delete_file(f"{root}/{shard.file}")


class _Part(InputPartition):
    def __init__(self, file: str | None, start: int):
        self.file, self.start = file, start


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_Part]:
        system, root = _files(self.path)
        with system.open_input_stream(f"{root}/manifest.jsonl") as lines:
            shards = [Shard(**json.loads(line)) for line in lines.read().splitlines()]
        parts, start = [], 0
        for shard in shards:
            parts.append(_Part(shard.file, start))
            start += shard.ids
        return parts or [_Part(None, 0)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if partition.file is None:
            return
        system, root = _files(self.path)
        with system.open_input_stream(f"{root}/{partition.file}") as file:
            content = file.read()
        yield from shard_rows(content, partition.start)


class TokenShards(DataSource):
    """``token_shards``: written from (doc_id, text), read as (doc_id, start, n_tokens, ids)."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        options = self.options
        specials = options.get("specials_as_text", "false").lower() == "true"
        return _Writer(options["path"], int(options.get("shard_ids", SHARD_IDS)), options["tokenizer"], specials, int(options.get("end_id", END_ID)))


def write_token_shards(
    documents: DataFrame, path: str, tokenizer: str, shard_ids: int = SHARD_IDS, specials_as_text: bool = False, end_id: int = END_ID
) -> None:
    """Encode (doc_id, text) and write to a new folder, an absolute path or URI that all executors reach.

    ``tokenizer`` is an absolute path that all executors have, or the name of a public tokenizer's file.
    """
    documents.sparkSession.dataSource.register(TokenShards)
    options = {"tokenizer": tokenizer, "shard_ids": shard_ids, "specials_as_text": specials_as_text, "end_id": end_id}
    in_order(documents).write.format("token_shards").options(**options).mode("append").save(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents; ids as little-endian unsigned 32-bit numbers."""
    spark.dataSource.register(TokenShards)
    return spark.read.format("token_shards").load(path)


def token_digest(documents: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Encode, write and read back: (doc_id, start, n_tokens, ids_crc32)."""
    write_token_shards(documents, path, tokenizer)
    back = read_token_shards(documents.sparkSession, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
