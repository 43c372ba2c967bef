"""Operator 4, byte-level BPE: merges picked from a hierarchical-bitmap queue of ranks.

:func:`merge` is the queue for one pre-token. Tasks use the same queue for all new pre-tokens of a batch at once
(``merging.merge_all``): its buckets hold the positions of all of them, and the positions of a rank are joined together.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peoplelake.llm.common import ship
from peoplelake.llm.merging import BitmapOfRanks, Remembered, Strings, merge_all, packed, pair_table, slices

#: Chunks and pieces that a worker remembers in each generation, and bytes of text that it encodes together. Idle workers keep
#: much of what a task took, and an executor has several, so both bound what it holds. Results depend on neither.
CACHE = 1 << 17
PART = 1 << 21
#: White space as the pattern's ``\s`` has it; the standard ``re`` counts four control characters more.
SPACE = "\t-\r \x85\xa0  -     　"
#: Stretches that the split pattern can never match across: a word with the blank before it, or white space.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: the whole piece if it is a token, else adjacent parts joined by lowest rank.

    The parts are a linked list over byte positions. The queue keeps positions in a bucket per rank, a heap, so that of
    equal ranks the leftmost comes first; a bitmap of 256 ranks a word and one of the words in use find the lowest rank by
    find-first-set. Entries stay when their pair changes and are skipped when taken. Each merge takes time that hardly
    depends on the length of the piece. The queue is written out here, as calls would take most of the time.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    rank_of = ranks.get
    ends = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n - 1))  # start of the part before
    pair = [rank_of(piece[i:i + 2]) for i in range(n - 1)]  # rank of this part joined with the next
    pair.append(None)
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    top = 0
    for at, rank in enumerate(pair):
        if rank is None:
            continue
        if rank in buckets:
            buckets[rank].append(at)  # positions rise, so this is a heap
        else:
            buckets[rank] = [at]
            word = rank >> 8
            if word in words:
                words[word] |= 1 << (rank & 255)
            else:
                words[word] = 1 << (rank & 255)
                top |= 1 << word
    while top:
        word = (top & -top).bit_length() - 1
        bits = words[word]
        bit = bits & -bits
        rank = word << 8 | bit.bit_length() - 1
        bucket = buckets[rank]
        at = heappop(bucket)
        if not bucket:
            del buckets[rank]
            if bits == bit:
                del words[word]
                top ^= 1 << word
            else:
                words[word] = bits ^ bit
        if pair[at] != rank:
            continue  # the pair that was queued is no more
        gone = ends[at]
        end = ends[at] = ends[gone]
        pair[gone] = pair[at] = None
        if end < n:
            before[end] = at
        for start in (at, before[at]):  # the pairs that the joined part now makes with the next and with the one before
            stop = ends[start] if start >= 0 else n
            if stop == n:
                continue
            rank = pair[start] = rank_of(piece[start:ends[stop]])
            if rank is None:
                continue
            if rank in buckets:
                heappush(buckets[rank], start)
            else:
                buckets[rank] = [start]
                word = rank >> 8
                words[word] = words.get(word, 0) | 1 << (rank & 255)
                top |= 1 << word
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:ends[at]]])
        at = ends[at]
    return ids


class Encoder:
    """Text to ids, as little-endian unsigned 32-bit integers in bytes, by ranks and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self._unit = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._pairs = pair_table(ranks, ranks.get)
        self._rank = np.arange(max(ranks.values()) + 1, dtype=np.int32)
        self.forget()

    def forget(self) -> None:
        self.chunks = Remembered(lambda chunks: self.pieces.joined([self.split.findall(c) for c in chunks]), CACHE)
        self.pieces = Remembered(self._merged, CACHE)

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece: the whole piece if it is a token, else what the merges leave."""
        raw = [p.encode("utf-8") for p in pieces]
        whole = [self.ranks.get(r) for r in raw]
        others = [r for r, rank in zip(raw, whole) if rank is None]
        sizes = np.array([len(r) for r in others], np.int64)
        starts = np.cumsum(sizes) - sizes
        units = self._unit[np.frombuffer(b"".join(others), np.uint8)]
        symbols, starts, doubtful = merge_all(units, starts, self._pairs, self._rank, BitmapOfRanks)
        found = packed(symbols, starts)
        for i in doubtful.tolist():
            found[i] = np.array(merge(others[i], self.ranks), "<u4").tobytes()
        ready = iter(found)
        return [next(ready) if rank is None else rank.to_bytes(4, "little") for rank in whole]

    def encode_all(self, texts: Sequence[str]) -> Iterator[bytes]:
        for part in slices(texts):
            yield from self.chunks.joined([CHUNK.findall(t) for t in part])

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks from the text of a rank file: base64 token and rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines.splitlines() if x.strip())}


_ENCODERS: dict[tuple[str, str], Encoder] = {}
_TABLES: dict[str, Strings] = {}


def _ranks_of(name: str) -> dict[bytes, int]:
    with open(SparkFiles.get(name), "rb") as file:
        return read_ranks(file.read())


def _encoder(name: str, pattern: str) -> Encoder:
    if (name, pattern) not in _ENCODERS:
        _ENCODERS[name, pattern] = Encoder(_ranks_of(name), pattern)
    return _ENCODERS[name, pattern]


def _table(name: str) -> Strings:
    """The bytes of each id."""
    if name not in _TABLES:
        ranks = _ranks_of(name)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _TABLES[name] = Strings(tokens)
    return _TABLES[name]


def _ship(df: DataFrame, ranks_path: str) -> str:
    """Give every executor the rank file and this package; the file's name there."""
    ship(df.sparkSession)
    df.sparkSession.sparkContext.addFile(ranks_path)
    return ranks_path.rstrip("/").rpartition("/")[2]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole text in ``out`` (array of int) in place of ``text_col``.

    Pre-tokens are the matches of ``pattern``; each is encoded by itself, without special tokens. Null and empty texts
    have no ids. All other columns pass through; a column already called ``out`` is replaced. No rows give no rows. The
    pattern must, like the public one, never match across a word's end other than over the blank before the next.
    """
    name = _ship(docs, ranks_path)
    kept = [c for c in docs.columns if c != text_col and c.lower() != out.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    return docs.select(*kept, text_col).mapInArrow(lambda batches: _encoded(batches, name, pattern, out), schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """All rows of a batch, in runs with up to PART bytes in the last column, a text; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = before = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, before + PART, side="right")))
        yield batch.slice(at, stop - at)
        at, before = stop, int(ends[stop - 1])


def _encoded_texts(batches, name: str, pattern: str):
    """(rows, ids of their last column, a text), a part of a batch at a time. What the encoder remembers goes with the task, as
    idle workers keep their memory."""
    encoder = _encoder(name, pattern)
    try:
        for batch in batches:
            for part in _parts(batch):
                yield part, list(encoder.encode_all([t or "" for t in part.column(part.num_columns - 1).to_pylist()]))
    finally:
        encoder.forget()


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) // 4 for x in ids])
    if ends[-1] >= 1 << 31:
        raise ValueError("over 2**31 tokens in one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))


def _encoded(batches, name: str, pattern: str, out: str):
    for batch, ids in _encoded_texts(batches, name, pattern):
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(ids)], names=[*batch.schema.names[:-1], out])


_DIGESTS = (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))


def _digests_of(ids: list[bytes], table: Strings) -> list[pa.Array]:
    counts, of_ids, of_text = [], [], []
    for raw in ids:
        counts.append(len(raw) // 4)
        of_ids.append(hashlib.sha256(raw).hexdigest())
        of_text.append(hashlib.sha256(table.joined(np.frombuffer(raw, "<u4"))).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]


def encode_digests(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str | None = None
) -> DataFrame:
    """:func:`encode` and then :func:`digests` in one pass, so a task needs one Python worker.

    The ids stay there, or with a name in ``ids_col`` come as that column (array of int) before the digests.
    """
    name = _ship(docs, ranks_path)
    ids = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)] if ids_col else []
    own = [n for n, _ in _DIGESTS] + [f.name.lower() for f in ids]
    kept = [c for c in docs.columns if c != text_col and c.lower() not in own]
    schema = T.StructType([*(docs.schema[c] for c in kept), *ids, *(T.StructField(n, k) for n, k in _DIGESTS)])

    def run(batches):
        for batch, found in _encoded_texts(batches, name, pattern):
            lists = [_lists(found)] if ids_col else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *lists, *_digests_of(found, _table(name))], names=schema.names)

    return docs.select(*kept, text_col).mapInArrow(run, schema)


def digests(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Decode the ids: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (hex) in place of ``ids_col``.

    Columns of these names are replaced. The bytes of the decoded text are hashed where they are made. Null ids count as
    none; an id without a token fails.
    """
    name = _ship(encoded, ranks_path)
    own = [n for n, _ in _DIGESTS]
    kept = [c for c in encoded.columns if c != ids_col and c.lower() not in own]
    schema = T.StructType([*(encoded.schema[c] for c in kept), *(T.StructField(n, k) for n, k in _DIGESTS)])

    def run(batches):
        for batch in batches:
            found = [np.array(ids.as_py() or (), "<u4").tobytes() for ids in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *_digests_of(found, _table(name))], names=schema.names)

    return encoded.select(*kept, ids_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for in ``out`` (binary) in place of ``ids_col``; null ids give none."""
    name = _ship(encoded, ranks_path)
    kept = [c for c in encoded.columns if c != ids_col and c.lower() != out.lower()]
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(out, T.BinaryType())])

    def run(batches):
        table = _table(name)
        for batch in batches:
            texts = [table.joined(np.array(ids.as_py() or (), np.int64)) for ids in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(texts, pa.binary())], names=[*kept, out])

    return encoded.select(*kept, ids_col).mapInArrow(run, schema)
