"""WARC archives with a two-level capture index.

Writing: rows meet their payload's first holder by the digest (one shuffle of
the payloads; AQE splits a hot digest), then each task writes its partition as
gzip-per-record WARC files and returns where each record lies. The returned
rows are written as a table first (the manifest), so a repeated task leaves at
most an unreferenced file.

Index, first level: captures sorted by (reversed-host URL key, page id) over
range partitions; each partition writes blocks of ``block_lines`` captures,
each a gzip member. Second level: one directory per shard with the first key
and the byte range of each block, and the list of the shards' first keys
(bounded by the number of partitions, not by the data).

Lookup: keys are dealt out in key order; a task binary-searches the shard
list, then the shard's directory, reads the byte range of the block and finds
the capture. Records are then read by byte ranges, in file order, neighbouring
ranges in one read.

Files are opened through ``pyarrow.fs`` by the URI of the shared checkpoint
folder, never in a machine-local folder.

Defined results: null html is an empty payload, a null url an empty target; a
null page id is never the one referred to unless all ids of its payload are
null; rows that repeat both the page id and the payload of the response are
responses too; an empty table gives an empty table; further columns are not
read. CR and LF inside a url are percent-encoded in the header.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty

#: Captures in an index block.
BLOCK_LINES = 3000
#: A task starts a new archive file after so many bytes.
FILE_BYTES = 256 * 1024 ** 2
#: Neighbouring records are read together up to so many bytes.
READ_BYTES = 4 * 1024 ** 2

CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, intact boolean")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host reversed by commas, then path; scheme, port and fragment are left out."""
    rest = (url or "").split("#", 1)[0]
    if "://" in rest:
        rest = rest.split("://", 1)[1]
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].split(":", 1)[0].lower()
    key = ",".join(reversed(host.split("."))) + ")/" + path
    return "".join(c if c > " " else "%%%02X" % ord(c) for c in key)


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _id_text(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _id_back(value: str) -> int | None:
    digits = value[len("<urn:x-page:"):-1]
    return int(digits) if digits else None


def make_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
                date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP headers (with the payload's length) and leaves the payload out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id_text(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_id_text(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def read_record(data: bytes) -> dict:
    """The fields of one WARC record, with the payload (None in a revisit)."""
    at = data.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in data[:at].decode().split("\r\n")[1:])
    block = data[at + 4:at + 4 + int(head["Content-Length"])]
    http_end = block.index(b"\r\n\r\n")
    http = dict(line.split(b": ", 1) for line in block[:http_end].split(b"\r\n")[1:])
    revisit = head["WARC-Type"] == "revisit"
    payload = None if revisit else block[http_end + 4:]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    return {"page_id": _id_back(head["WARC-Record-ID"]), "url": head["WARC-Target-URI"],
            "payload_bytes": int(http[b"Content-Length"]), "payload_digest": digest, "record_type": head["WARC-Type"],
            "refers_to": _id_back(head["WARC-Refers-To"]) if revisit else None, "payload": payload,
            "intact": revisit or (len(payload) == int(http[b"Content-Length"])
                                  and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


CAPTURE_ARROW = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                           ("offset", pa.int64()), ("length", pa.int64())])


def _archive_writer(folder: str, date: str, file_bytes: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, body, digest, first, revisit in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = _member(make_record(page_id, url, body.encode(), base64.b32encode(digest).decode(),
                                           first, revisit, date))
                out.write(data)
                rows.append((url_key(url), page_id, name, at, len(data)))
                at += len(data)
                if at >= file_bytes:
                    out.close()
                    out = None
            if rows:
                yield _batch(rows, CAPTURE_ARROW)
        if out is not None:
            out.close()
    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   body_col: str = "html", min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row under ``folder``; gives the captures (lazy: write them down before using them).

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the smallest id is the response, the
    others are revisits that refer to it.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), text_or_empty(F.col(url_col)).alias("url"),
                        text_or_empty(F.col(body_col)).alias("body"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("body").cast("binary"))))
    first = rows.select("page_id", "digest").groupBy("digest").agg(F.min("page_id").alias("first"))
    revisit = (F.octet_length("body") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    joined = rows.join(first.hint("merge"), "digest").select("page_id", "url", "body", "digest", "first",
                                                             revisit.alias("revisit"))
    return joined.mapInArrow(_archive_writer(folder, date, file_bytes), CAPTURE)


def _sort_id(page_id: int | None) -> int:
    return -(1 << 63) - 1 if page_id is None else page_id


def _line(row: tuple) -> str:
    return "\t".join("" if v is None else str(v) for v in row)


def _parse_line(line: str) -> tuple:
    key, page_id, file, offset, length = line.split("\t")
    return key, int(page_id) if page_id else None, file, int(offset), int(length)


SHARD = "shard string, first_key string, first_id long, captures long"
SHARD_ARROW = pa.schema([("shard", pa.string()), ("first_key", pa.string()), ("first_id", pa.int64()),
                         ("captures", pa.int64())])


def _index_writer(folder: str, block_lines: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        out, name, at, total, first, lines, directory = None, f"shard-{uuid.uuid4().hex}", 0, 0, None, [], []

        def flush() -> None:
            nonlocal at
            data = _member("\n".join(map(_line, lines)).encode())
            out.write(data)
            directory.append(_line((lines[0][0], lines[0][1], at, len(data))))
            at += len(data)
            lines.clear()

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out, first = fs.open_output_stream(f"{base}/{name}.cdx.gz", compression=None), row
                lines.append(row)
                total += 1
                if len(lines) >= block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with fs.open_output_stream(f"{base}/{name}.dir") as d:
                d.write("\n".join(directory).encode())
            yield _batch([(name, first[0], first[1], total)], SHARD_ARROW)
    return write


def _by_key(df: DataFrame, shards: int) -> DataFrame:
    return df.repartitionByRange(shards, "key", "page_id").sortWithinPartitions("key", "page_id")


def write_index(captures: DataFrame, folder: str, shards: int, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the two-level index; gives one row per shard (write them down before using them)."""
    return _by_key(captures, shards).mapInArrow(_index_writer(folder, block_lines), SHARD)


class _Shard:
    """One shard's directory, and its last block that was read."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        with fs.open_input_file(f"{path}.dir") as f:
            entries = [x.split("\t") for x in f.read().decode().split("\n")]
        self.firsts = [(k, _sort_id(int(i) if i else None)) for k, i, _, _ in entries]
        self.ranges = [(int(o), int(n)) for _, _, o, n in entries]
        self.file = fs.open_input_file(f"{path}.cdx.gz")
        self.at, self.block = -1, []

    def read(self, i: int) -> list[tuple]:
        if i != self.at:
            offset, length = self.ranges[i]
            self.file.seek(offset)
            self.block = [_parse_line(x) for x in zlib.decompress(self.file.read(length), 31).decode().split("\n")]
            self.at = i
        return self.block

    def find(self, want: tuple) -> Iterator[tuple]:
        """All captures of a (key, page id): from the block before the first that begins at or after it."""
        i = max(0, bisect.bisect_left(self.firsts, want) - 1)
        while i < len(self.firsts) and self.firsts[i] <= want:
            block = self.read(i)
            j = bisect.bisect_left(block, want, key=lambda r: (r[0], _sort_id(r[1])))
            while j < len(block) and (block[j][0], _sort_id(block[j][1])) == want:
                yield block[j]
                j += 1
            i += 1


def _finder(folder: str, shards: list[tuple[str, str, int | None]]):
    firsts = [(key, _sort_id(page_id)) for _, key, page_id in shards]

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        at, shard = -1, None
        for batch in batches:
            rows = []
            for key, page_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                want = (key, _sort_id(page_id))
                i = bisect.bisect_right(firsts, want) - 1
                if i < 0:
                    continue
                if i != at:
                    at, shard = i, _Shard(fs, f"{base}/{shards[i][0]}")
                rows += shard.find(want)
            if rows:
                yield _batch(rows, CAPTURE_ARROW)
    return find


def lookup(keys: DataFrame, shards: DataFrame, folder: str, parts: int) -> DataFrame:
    """The captures of (key, page_id) rows, found through the index. ``shards``: the table of `write_index`."""
    top = [(r.shard, r.first_key, r.first_id) for r in
           shards.orderBy("first_key", "first_id").select("shard", "first_key", "first_id").collect()]
    return _by_key(keys.select("key", "page_id").distinct(), parts).mapInArrow(_finder(folder, top), CAPTURE)


def _fetcher(folder: str, read_bytes: int, with_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]
    schema = pa.schema(list(zip(names, types)))

    def runs(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
        run: list[tuple] = []
        for row in rows:
            if run and (row[0] != run[0][0] or row[1] > run[-1][1] + run[-1][2] or row[1] + row[2] - run[0][1] > read_bytes):
                yield run
                run = []
            run.append(row)
        if run:
            yield run

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        name, file = None, None
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))))
        for run in runs(rows):
            if run[0][0] != name:
                name = run[0][0]
                file = fs.open_input_file(f"{base}/{name}")
            start = run[0][1]
            file.seek(start)
            data = file.read(run[-1][1] + run[-1][2] - start)
            found = [read_record(zlib.decompress(data[o - start:o - start + n], 31)) for _, o, n in run]
            yield _batch([tuple(r[n] for n in names) for r in found], schema)
    return fetch


def fetch(captures: DataFrame, folder: str, parts: int, with_payload: bool = False,
          read_bytes: int = READ_BYTES) -> DataFrame:
    """Read records back by byte ranges, in file order."""
    rows = captures.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    return rows.sortWithinPartitions("file", "offset").mapInArrow(
        _fetcher(folder, read_bytes, with_payload), RECORD + (", payload binary" if with_payload else ""))


def archive_and_index(pages: DataFrame, scratch: Scratch, **options) -> tuple[DataFrame, DataFrame, str]:
    """Write archives and index into the shared folder: the table of captures, that of shards, and the folder."""
    folder = scratch.path("files")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    captures = scratch.keep(write_archives(pages, folder, **options), "captures")
    return captures, scratch.keep(write_index(captures, folder, parts), "shards"), folder


def op9_warc_index(spark, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back through the index."""
    pages = table(spark, sf_dir, "pages")
    scratch = Scratch(spark, "warc")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _, shards, folder = archive_and_index(pages, scratch)
    key = F.pandas_udf(lambda urls: urls.map(url_key), "string")
    keys = pages.select(key(text_or_empty(F.col("url"))).alias("key"), F.col("page_id").cast("long").alias("page_id"))
    records = fetch(lookup(keys, shards, folder, parts), folder, parts)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


#: Base32 of the SHA-1 in SQL: 32 groups of 5 bits of the 160.
ORACLE_SQL = """
WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, strlen(body) AS n, sha1(body) AS hex FROM t),
f AS (SELECT body, min(page_id) AS first FROM d GROUP BY body),
b AS (SELECT d.*, f.first, string_agg(lpad(to_base(('0x' || substr(hex, i * 5 + 1, 5))::BIGINT, 2), 20, '0'), '' ORDER BY i)
      AS bits FROM d JOIN f USING (body), range(8) r(i) GROUP BY ALL)
SELECT page_id, n::BIGINT AS payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (list_reduce(list_transform(range(1, 6), lambda k: substr(bits, j * 5 + k::INT, 1)::INT), lambda x, y: x * 2 + y))::INT + 1, 1),
               '' ORDER BY j) FROM range(32) q(j)) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS intact
FROM b
"""

QUERIES = {"op9_warc_index": op9_warc_index}
ORACLE = {"op9_warc_index": ORACLE_SQL}
