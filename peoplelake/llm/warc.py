"""Operator 3, WARC: archives with revisit records, and a two-level capture index for range reads.

Archives are files of gzip members, one per record. The capture index holds lines sorted by reversed-host URL key in gzip
blocks; a directory has one row per block, in shards by range of keys. A lookup finds the shards of a key by their bounds,
the blocks by binary search in a shard's directory, and reads just those blocks and then just the records.
"""

from __future__ import annotations

import json
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peoplelake.llm.common import join_by_key, ship, staged
from peoplelake.session import scratch_path

#: Payloads under this many bytes are always stored.
SMALL = 100
#: Lines of an index block, and bytes after which an archive file is full.
BLOCK_LINES = 2000
FILE_BYTES = 1 << 30
#: Neighbouring records are read at once up to so many bytes.
READ_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, file string, offset bigint, length bigint"


def url_key(url: str | Column) -> Column:
    """Sort key of a URL: host parts in reverse and lower case, then the rest as it is; null counts as empty."""
    text = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/?#]*)"
    host = F.lower(F.regexp_extract(text, pattern, 1))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(text, pattern, ""))


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(page_id: str | None, url: str | None, kind: str, digest: str, size: int, refers_to: str | None, payload: bytes) -> bytes:
    """One WARC record. A revisit has the HTTP head, with the length of the payload, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        # a header line can't hold line breaks
        fields.append(("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record: page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload (None in a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    of = lambda name: None if (v := field.get(name)) is None or v == "<urn:page:None>" else v[len("<urn:page:"):-1]
    url, kind = field.get("WARC-Target-URI"), field["WARC-Type"]
    return {
        "page_id": of("WARC-Record-ID"), "record_type": kind, "payload_bytes": size,
        "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload_digest": field["WARC-Payload-Digest"].removeprefix("sha256:"), "refers_to": of("WARC-Refers-To"),
        "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` to archives below ``path``; the captures (key, file, offset, length), staged.

    Of rows with equal payloads (the text in UTF-8, null: empty) of SMALL bytes or more, that with the smallest id is a
    response and the others revisit it; rows that repeat this id are responses too. Smaller payloads, and those all of
    whose ids are null, are responses. A failed task leaves a file that no capture names.
    """
    spark = pages.sparkSession
    ship(spark)
    payload = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("number"), F.col(url_col).alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    same = rows.groupBy("digest").agg(F.min("number").cast("string").alias("first"), F.count(F.lit(1)).alias("held"))
    decided = join_by_key(rows, staged(same, "payloads"), "digest", "held")
    stored = (F.octet_length("payload") < SMALL) | F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))
    ready = decided.select(
        "id", "url", "digest", F.octet_length("payload").cast("bigint").alias("size"), url_key("url").alias("key"),
        F.when(~stored, F.col("first")).alias("refers_to"), F.when(stored, F.col("payload")).alias("payload"))

    def write(batches):
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        sink, name, at = None, "", 0
        try:
            for batch in batches:
                made = []
                for row in batch.to_pylist():
                    if sink is None or at >= FILE_BYTES:
                        if sink is not None:
                            sink.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    packed = member(record(
                        row["id"], row["url"], kind, row["digest"], row["size"], row["refers_to"], row["payload"] or b""))
                    sink.write(packed)
                    made.append((row["key"], name, at, len(packed)))
                    at += len(packed)
                key, file, offset, length = zip(*made, strict=True) if made else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([
                    pa.array(key, pa.string()), pa.array(file, pa.string()), pa.array(offset, pa.int64()),
                    pa.array(length, pa.int64())], names=["key", "file", "offset", "length"])
        finally:
            if sink is not None:
                sink.close()

    return staged(ready.mapInArrow(write, CAPTURE), "captures")


def write_index(captures: DataFrame, path: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the capture index below ``path``; its directory (shard, first, last, file, offset, length), staged.

    Captures are range-partitioned by key and place, so a key with any number of captures spreads over shards. Each
    partition is one index file, whose gzip blocks hold ``block_lines`` sorted lines; the directory has a row per block.
    """
    ship(captures.sparkSession)
    order = ["key", "file", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id())

    def write(frames):
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        sink, name, at, waiting, shard = None, "", 0, [], 0

        def flush():
            nonlocal at, waiting
            packed = member("".join(json.dumps(x) + "\n" for x in waiting).encode())
            sink.write(packed)
            done = pd.DataFrame([[shard, waiting[0][0], waiting[-1][0], name, at, len(packed)]],
                                columns=["shard", "first", "last", "file", "offset", "length"])
            at, waiting = at + len(packed), []
            return done

        try:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    if sink is None:
                        name, shard = f"{uuid.uuid4().hex}.cdx.gz", row.shard
                        sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    waiting.append((row.key, row.file, row.offset, row.length))
                    if len(waiting) == block_lines:
                        yield flush()
            if waiting:
                yield flush()
        finally:
            if sink is not None:
                sink.close()

    return staged(ranged.mapInPandas(
        write, "shard int, first string, last string, file string, offset bigint, length bigint"), "directory")


def look_up(keys: DataFrame, directory: DataFrame, path: str) -> DataFrame:
    """(key, file, offset, length): all captures of the distinct ``keys`` (key).

    The driver holds the bounds of the shards, one row per index file. Keys go to the shards that may hold them; there
    their blocks are found by binary search in the shard's part of the directory, read and searched.
    """
    ship(keys.sparkSession)
    bounds = sorted(directory.groupBy("shard").agg(F.min("first"), F.max("last")).collect(), key=lambda r: r[1:])
    shards, firsts, lasts = [r[0] for r in bounds], [r[1] for r in bounds], [r[2] for r in bounds]

    @F.pandas_udf("array<int>")
    def shards_of(key: pd.Series) -> pd.Series:
        return pd.Series([shards[bisect_left(lasts, k):bisect_right(firsts, k)] for k in key], dtype=object)

    dealt = keys.filter("key is not null").distinct().withColumn("shard", F.explode(shards_of("key")))

    def search(wanted: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        store, root = fs.FileSystem.from_uri(path)
        blocks = blocks.sort_values("offset")
        first, last = blocks["first"].tolist(), blocks["last"].tolist()
        needed: dict[int, list[str]] = {}
        for key in wanted["key"]:
            for at in range(bisect_left(last, key), bisect_right(first, key)):
                needed.setdefault(at, []).append(key)
        found = []
        if needed:
            with store.open_input_file(f"{root}/{blocks['file'].iloc[0]}") as file:
                for at, asked in needed.items():
                    offset, length = int(blocks["offset"].iloc[at]), int(blocks["length"].iloc[at])
                    lines = [json.loads(x) for x in zlib.decompress(file.read_at(length, offset), 31).splitlines()]
                    in_block = [x[0] for x in lines]
                    for key in asked:
                        found += lines[bisect_left(in_block, key):bisect_right(in_block, key)]
        return pd.DataFrame(found, columns=["key", "file", "offset", "length"])

    held = directory.select("shard", "first", "last", "file", "offset", "length")
    return dealt.groupBy("shard").cogroup(held.groupBy("shard")).applyInPandas(search, CAPTURE)


def read_records(captures: DataFrame, path: str) -> DataFrame:
    """The records at ``captures`` (file, offset, length), parsed; neighbours in a file are read at once."""
    ship(captures.sparkSession)
    schema = T.StructType([
        T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.StringType()),
        T.StructField("payload", T.BinaryType())])
    names = schema.fieldNames()
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def read(batches):
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            places = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            at = 0
            while at < len(places):
                name, start, length = places[at]
                end, stop = at + 1, start + length
                while end < len(places) and places[end][:2] == (name, stop) and stop - start < READ_BYTES:
                    stop, end = stop + places[end][2], end + 1
                with store.open_input_file(f"{root}/{name}") as file:
                    data = file.read_at(stop - start, start)
                rows = [parse(zlib.decompress(data[o - start:o - start + n], 31)) for _, o, n in places[at:end]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)
                at = end

    near = captures.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return near.mapInArrow(read, schema)


def archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Write ``pages`` to archives and an index below ``path`` (default: the shared folder) and read every row back.

    One row per row of ``pages``: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null in a
    revisit, whose size and digest come from its header). Ids have the type of ``id_col``. Each URL of ``pages`` is looked
    up in the index, once. Null URLs have an empty key and are found by it. Other columns are not looked at. No rows give no
    rows.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{path}/archive", id_col, url_col, text_col)
    directory = write_index(captures, f"{path}/index")
    found = look_up(pages.select(url_key(url_col).alias("key")), directory, f"{path}/index")
    records = read_records(found, f"{path}/archive")
    kind = pages.schema[id_col].dataType
    return records.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})
