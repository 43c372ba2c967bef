"""Operator 11, SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peoplelake.llm.common import ship
from peoplelake.llm.merging import NONE, Remembered, Strings, merge_all, packed, pair_table, slices

#: The sign that stands for a blank inside pieces.
BLANK = "▁"
#: Blanks and what follows up to the next blank. No piece may hold a blank after anything else, so no merge crosses this.
CHUNK = re.compile(f"[ {BLANK}]*[^ {BLANK}]+|[ {BLANK}]+")
#: Piece types and model type of the public model format, fixed values.
NORMAL, UNKNOWN, CONTROL, BYTE, MERGES = 1, 2, 3, 6, 2


def _fields(raw: bytes):
    """(number, value) of each field of a protocol-buffer message: integers, and the bytes of all other kinds."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, raw[at:at + size]
        at += size


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says: ``rank`` orders the pieces that merges may make, best score first, equal scores alike."""

    texts: list[str]
    kinds: list[int]
    ids: dict[str, int]
    rank: dict[str, int]
    byte_ids: list[int]
    end_id: int
    unknown: str


def read_model(raw: bytes) -> Vocabulary:
    """The vocabulary in a model file. A model is refused whose rules this module does not follow: it must be of the merge
    type with byte fallback, keep the text as it is (identity, blanks kept, one blank put in front), have neither
    user-defined nor unused pieces and no piece with a blank after another character."""
    texts, scores, kinds, trainer, rules = [], [], [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            piece = dict(_fields(value))
            texts.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece.get(2, b"\0" * 4))[0])
            kinds.append(piece.get(3, NORMAL))
        elif number in (2, 3):
            (trainer if number == 2 else rules).update(_fields(value))
    known = {NORMAL, UNKNOWN, CONTROL, BYTE}
    if trainer.get(3) != MERGES or not trainer.get(35) or kinds.count(BYTE) != 256 or set(kinds) - known:
        raise ValueError("only merge-type models with byte fallback and without user-defined or unused pieces are supported")
    if rules.get(2) or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
        raise ValueError("only models that keep the text as it is and put one blank in front are supported")
    ids = {t: i for i, (t, k) in enumerate(zip(texts, kinds)) if k == NORMAL}
    if any(BLANK in t.lstrip(BLANK) for t in ids):
        raise ValueError("a piece holds a blank after another character")
    order = {s: r for r, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
    byte_ids = [texts.index(f"<0x{b:02X}>") for b in range(256)]
    end = texts.index(trainer.get(47, b"</s>").decode())
    return Vocabulary(texts, kinds, ids, {t: order[scores[i]] for t, i in ids.items()}, byte_ids, end,
                      trainer.get(44, " ⁇ ".encode()).decode())


def merge(chunk: str, rank: dict[str, int]) -> list[str]:
    """The pieces of one chunk: adjacent symbols, first its characters, joined by the best score, leftmost on a tie.

    The symbols are a linked list over positions. The agenda is a heap of (rank, position) as one number; an entry whose
    pair has changed meanwhile is skipped when taken.
    """
    n = len(chunk)
    rank_of = rank.get
    ends = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pair = [rank_of(chunk[i:i + 2]) for i in range(n - 1)]
    pair.append(None)
    agenda = [r << 40 | at for at, r in enumerate(pair) if r is not None]
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        at = entry & 0xFFFFFFFFFF
        if pair[at] != entry >> 40:
            continue
        gone = ends[at]
        end = ends[at] = ends[gone]
        pair[gone] = pair[at] = None
        if end < n:
            before[end] = at
        for start in (at, before[at]):
            stop = ends[start] if start >= 0 else n
            if stop < n:
                found = pair[start] = rank_of(chunk[start:ends[stop]])
                if found is not None:
                    heappush(agenda, found << 40 | start)
    out, at = [], 0
    while at < n:
        out.append(chunk[at:ends[at]])
        at = ends[at]
    return out


class Codec:
    """Text to ids and back. New chunks are merged together, by one agenda; those that come often are remembered."""

    def __init__(self, vocabulary: Vocabulary, library: sentencepiece.SentencePieceProcessor | None = None):
        self.vocabulary = known = vocabulary
        self.library, self.doubted = library, set()
        size = len(known.texts)
        self._decimals = Strings([f"{i} ".encode() for i in range(size)])
        self._kinds = np.array(known.kinds)
        made = {NORMAL: lambda t: t.replace(BLANK, " ").encode(), BYTE: lambda t: bytes([int(t[3:5], 16)]),
                UNKNOWN: lambda t: known.unknown.encode(), CONTROL: lambda t: b""}
        self._surfaces = Strings([made[k](t) for t, k in zip(known.texts, known.kinds)])
        # a character outside the vocabulary is a symbol of its own, beyond the ids, that merges with nothing
        self._unit = np.arange(size, size + 0x110000, dtype=np.int32)
        for text, i in known.ids.items():
            if len(text) == 1:
                self._unit[ord(text)] = i
        self._rank = np.full(size, NONE, np.int32)
        self._rank[[known.ids[t] for t in known.rank]] = list(known.rank.values())
        self._pairs = pair_table(known.ids, lambda c: int(self._unit[ord(c)]))
        self._chunks = Remembered(self._merged)

    def forget(self) -> None:
        self._chunks.forget()
        self.doubted.clear()

    def _check(self, chunks: list[str], found: list[bytes]) -> None:
        """Put those chunks among the doubted for which the library has other ids, or which it does not get back from them.

        It puts a blank in front by itself, so a chunk goes without its first; one that is only this can't be asked for.
        """
        asked = [(c, f) for c, f in zip(chunks, found) if len(c) > 1]
        rest = [c[1:] for c, _ in asked]
        theirs = self.library.encode(rest, num_threads=1)
        texts = self.library.decode(theirs, num_threads=1)
        sizes = [len(ids) * 4 for ids in theirs]
        flat = np.fromiter(chain.from_iterable(theirs), "<u4").tobytes()
        end = 0
        for (chunk, own), r, text, size in zip(asked, rest, texts, sizes):
            end += size
            if own != flat[end - size:end] or (text != r and text != r.replace(BLANK, " ")):
                self.doubted.add(chunk)

    def _merged(self, chunks: list[str]) -> list[bytes]:
        texts = [c.replace(" ", BLANK) for c in chunks]
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        units = self._unit[np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")]
        symbols, starts, doubtful = merge_all(units, starts, self._pairs, self._rank)
        out = packed(symbols, starts)
        size = len(self.vocabulary.texts)
        strange = np.flatnonzero(symbols >= size)
        for i in np.unique(np.searchsorted(starts, strange, side="right") - 1).tolist():
            out[i] = self._with_bytes(np.frombuffer(out[i], "<u4").tolist())
        for i in doubtful.tolist():
            found = merge(texts[i], self.vocabulary.rank)
            out[i] = self._with_bytes([self.vocabulary.ids.get(p, size + ord(p[0])) for p in found])
        if self.library:
            self._check(chunks, out)
        return out

    def _with_bytes(self, symbols: list[int]) -> bytes:
        """Ids of the symbols, the bytes of its character for one outside the vocabulary."""
        size, out = len(self.vocabulary.texts), []
        for s in symbols:
            out += [self.vocabulary.byte_ids[b] for b in chr(s - size).encode()] if s >= size else [s]
        return np.array(out, "<u4").tobytes()

    def encode_all(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, the end id last."""
        end = struct.pack("<I", self.vocabulary.end_id)
        for ids, _ in self._encoded(texts):
            yield ids + end

    def _encoded(self, texts: Sequence[str]) -> Iterator[tuple[bytes, bool]]:
        """(ids without the end id, whether a chunk of the text is doubted) of each text."""
        for part in slices(texts):
            chunks = [CHUNK.findall(" " + t) if t else [] for t in part]
            for ids, own in zip(self._chunks.joined(chunks), chunks):
                yield ids, bool(self.doubted) and not self.doubted.isdisjoint(own)

    def encode_checked(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, bytes, bool]]:
        """(ids, the bytes they decode to, whether the library agrees) of each text; without a library none is doubted."""
        end = struct.pack("<I", self.vocabulary.end_id)
        for text, (raw, doubted) in zip(texts, self._encoded(texts)):
            ids = np.frombuffer(raw + end, "<u4")
            decoded = self.decode(ids)
            yield ids, decoded, not doubted and decoded == text.replace(BLANK, " ").encode()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encode_all([text])), "<u4").tolist()

    def _surface(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the ids, blanks as they are: control pieces are silent, runs of byte pieces are read as UTF-8."""
        kinds = self._kinds[ids]
        raw = self._surfaces.joined(ids)
        if not (kinds == CONTROL).any() and _utf8(raw) == raw:
            return raw
        runs = np.split(ids, np.flatnonzero(kinds[1:] != kinds[:-1]) + 1)  # each run of bytes is read by itself
        return b"".join(_utf8(self._surfaces.joined(run)) for run in runs)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of the ids, without the blank that encoding put in front of the first piece."""
        if len(ids) and ids[-1] == self.vocabulary.end_id:
            ids = ids[:-1]
        text, kinds = self._surface(ids), self._kinds[ids]
        first = kinds[kinds != CONTROL][:1]
        return text[1:] if len(first) and first[0] == NORMAL and text.startswith(b" ") else text

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by one blank."""
        return self._decimals.joined(ids)[:-1]


def _utf8(raw: bytes) -> bytes:
    """Bytes as UTF-8, a replacement character for each byte that begins no valid character."""
    out = []
    while raw:
        try:
            raw.decode()
            out.append(raw)
            break
        except UnicodeDecodeError as error:
            out += [raw[:error.start], "\N{REPLACEMENT CHARACTER}".encode()]
            raw = raw[error.start + 1:]
    return b"".join(out)


_CODECS: dict[str, Codec] = {}


def _codec(name: str) -> Codec:
    if name not in _CODECS:
        with open(SparkFiles.get(name), "rb") as file:
            _CODECS[name] = Codec(read_model(file.read()))
    return _CODECS[name]


def _shipped(df: DataFrame, model_path: str) -> str:
    ship(df.sparkSession)
    df.sparkSession.sparkContext.addFile(model_path)
    return model_path.rstrip("/").rpartition("/")[2]


def _rewritten(df: DataFrame, column: str, new: list[T.StructField], name: str, work) -> DataFrame:
    """``df`` with ``column`` replaced by the columns ``new``; ``work`` gives a task what makes their arrays from the column's.
    Columns of these names (case aside) are replaced. The chunks that a worker remembers go with the task."""
    taken = {f.name.lower() for f in new} | {column.lower()}
    kept = [c for c in df.columns if c.lower() not in taken]
    schema = T.StructType([*(df.schema[c] for c in kept), *new])

    def run(batches):
        codec = _codec(name)
        made = work(codec)
        try:
            for batch in batches:
                arrays = made(batch.column(batch.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=schema.names)
        finally:
            codec.forget()

    return df.select(*kept, column).mapInArrow(run, schema)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of the whole text, the end id last, in ``out`` (array of int) in place of ``text_col``.

    Null and empty texts have the end id alone. Other columns pass through; one already called ``out`` is replaced. No
    rows give no rows. A very long text is taken in one piece; a stretch without blanks costs n log n.
    """
    name = _shipped(docs, model_path)

    def work(codec):
        def made(texts):
            found = list(codec.encode_all([t.as_py() or "" for t in texts]))
            ends = np.cumsum([0] + [len(x) // 4 for x in found])
            if ends[-1] >= 1 << 31:
                raise ValueError("over 2**31 ids in one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
            return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(found), "<i4")))]

        return made

    return _rewritten(docs, text_col, [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)], name, work)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in ``out`` in place of ``ids_col``; null and empty lists give the empty text,
    an id that the model has not fails."""
    name = _shipped(encoded, model_path)

    def work(codec):
        return lambda lists: [pa.array([codec.decode(np.array(ids.as_py() or [], np.int64)).decode() for ids in lists], pa.string())]

    return _rewritten(encoded, ids_col, [T.StructField(out, T.StringType())], name, work)


_DIGESTS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType())]


def encode_digests(docs: DataFrame, model_path: str, text_col: str = "text", agrees_col: str | None = None) -> DataFrame:
    """:func:`encode` and :func:`decode` in one worker: ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one blank)
    and ``decoded_sha256`` (of the decoded text in UTF-8) in place of ``text_col``.

    With a name in ``agrees_col``, that column tells whether the public library gives the same: in each Arrow batch it is asked
    to encode and to decode every chunk that is new to the worker. As no piece has a blank after another character, which
    :func:`read_model` makes sure of, chunks that agree make texts that agree. It takes no part in the results. Null and empty texts, clashing names: see :func:`encode`.
    """
    name = _shipped(docs, model_path)

    def work(codec):
        if agrees_col and codec.library is None:
            codec.library = sentencepiece.SentencePieceProcessor(model_file=SparkFiles.get(name))

        def made(column):
            counts, of_ids, of_text, same = [], [], [], []
            for ids, decoded, agrees in codec.encode_checked([t.as_py() or "" for t in column]):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(codec.decimals(ids)).hexdigest())
                of_text.append(hashlib.sha256(decoded).hexdigest())
                same.append(agrees)
            arrays = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            return arrays + ([pa.array(same, pa.bool_())] if agrees_col else [])

        return made

    extra = [T.StructField(agrees_col, T.BooleanType())] if agrees_col else []
    return _rewritten(docs, text_col, [*_DIGESTS, *extra], name, work)
