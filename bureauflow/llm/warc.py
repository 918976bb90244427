"""WARC archives and the normaliser of monolithic ones (operator 12).

Archives are often one gzip stream each, which can only be read from its start. The normaliser inflates such a stream once, piece by piece,
writes every record as a gzip member of its own and notes each member's offset and length in a sidecar index, a Parquet table. Records are
then read by their offsets, alone or in ranges of any archive, by as many tasks as there are bytes for.

write_archives makes such monolithic archives of a table in one pass and returns the record list; payloads are neither sorted nor exchanged.
Equal payloads are found in the record list alone (digest, length, id), and the normaliser turns all but one of them into revisits.

Recovery: each attempt of a task writes archives of new names, and the record list and index, which Spark commits, name those of attempts
that counted; others are never read. Folders must be ones that pyarrow.fs reaches (file, hdfs, viewfs, s3, gs).

Defined results: a null payload is empty; a null url is left out and control characters in it are percent-encoded; rows with the same id
and payload are all responses, as none of them can be told apart, and so are equal payloads that have no id at all, while beside an id a row
without one revisits it; very long payloads pass the normaliser in pieces, one at a time elsewhere; an empty table gives an empty result;
other columns aren't read. A damaged or cut archive, or a payload unlike its digest, raises.
"""

from __future__ import annotations

import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from urllib.parse import quote, unquote
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauflow.llm import storage

#: Bytes inflated, copied or read at a time.
PIECE = 1 << 20
#: An archive is closed after so many bytes of records, or so many records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 100_000
#: Compressed bytes that a reading task is given, about.
READ_BYTES = 32 << 20
MAX_TASKS = 50_000
#: Levels of archives that are read once, and of those that are kept.
RAW_LEVEL, LEVEL = 3, 6
DATE = "1970-01-01T00:00:00Z"
#: The profile of a revisit with the same payload, and the start of a record's id.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
GZIP = 31
END = b"\r\n\r\n"
LIST_SCHEMA = "archive string, place int, {key}, n_bytes bigint, digest string"
INDEX_SCHEMA = "archive string, place int, offset bigint, length bigint, record_id string, record_type string"


def opened(folder: str):
    """(file system, path) of a folder's address."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def head(fields: list[tuple[str, str]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode("utf-8", "surrogateescape")


def parse(raw: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields, by lower-case name, of a record's or HTTP message's head."""
    lines = raw.decode("utf-8", "surrogateescape").strip("\r\n").split("\r\n")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"no header field: {line[:80]!r}")
        fields.setdefault(name.strip().lower(), value.strip())
    return lines[0], fields


def digest_of(payload: bytes) -> str:
    return b32encode(sha1(payload, usedforsecurity=False).digest()).decode()


def urn(key: object) -> str:
    return URN + ("" if key is None else quote(str(key), safe=""))


def response(key: object, url: str | None, payload: bytes, digest: str, date: str) -> tuple[bytes, bytes]:
    """Head and HTTP head of a response record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    target = [] if url is None else [("WARC-Target-URI", "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url))]
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{urn(key)}>"), ("WARC-Date", date), *target, ("WARC-Payload-Digest", f"sha1:{digest}")]
    return head([*fields, ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http) + len(payload)))]), http


def revisit(fields: dict[str, str], refers_to: str, size: int) -> bytes:
    """Head of the revisit that a response becomes: its own id, date, target and digest, and the HTTP head alone."""
    kept = [(name, fields[name.lower()]) for name in ("WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest") if name.lower() in fields]
    return head([("WARC-Type", "revisit"), *kept, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{URN}{quote(refers_to, safe='')}>"), ("Content-Type", fields["content-type"]), ("Content-Length", str(size))])


# --- writing -------------------------------------------------------------------------------------


class Archive:
    """A monolithic archive being written: one gzip stream."""

    def __init__(self, folder: str, date: str) -> None:
        files, path = opened(folder)
        files.create_dir(path, recursive=True)
        self.name = f"{uuid4().hex}.warc.gz"
        self.file = files.open_output_stream(f"{path}/{self.name}", compression=None)
        self.gzip = zlib.compressobj(RAW_LEVEL, zlib.DEFLATED, GZIP)
        self.size = self.records = 0
        note = b"format: WARC File Format 1.1\r\n"
        self.add(head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(note)))]), note)

    def add(self, *parts: bytes) -> int:
        """Writes a record; its place in the archive."""
        for part in (*parts, END):
            self.file.write(self.gzip.compress(part))
            self.size += len(part)
        self.records += 1
        return self.records - 1

    def close(self) -> None:
        self.file.write(self.gzip.flush())
        self.file.close()


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE) -> DataFrame:
    """Writes a response for each row of pages to monolithic archives in folder; the list of the records: archive, place, key, n_bytes, digest.

    The list is a written table: the pages are read once.
    """
    schema = LIST_SCHEMA.format(key=f"`{key}` {pages.schema[key].dataType.simpleString()}")

    def raw(column: pa.Array) -> pa.Array:
        return column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()).cast(pa.large_binary())

    def wrote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            names, places, sizes, digests = [], [], [], []
            for k, link, body in zip(batch.column(0).to_pylist(), raw(batch.column(1)).to_pylist(), raw(batch.column(2)), strict=True):
                u, content = link and link.decode("utf-8", "replace"), body.as_py() or b""
                if archive is None or archive.size >= ARCHIVE_BYTES or archive.records > ARCHIVE_RECORDS:
                    if archive:
                        archive.close()
                    archive = Archive(folder, date)
                digests.append(digest_of(content))
                places.append(archive.add(*response(k, u, content, digests[-1], date), content))
                names.append(archive.name)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int32()), batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["archive", "place", key, "n_bytes", "digest"])
        if archive:
            archive.close()

    return storage.written(pages.select(key, url, payload).mapInArrow(wrote, schema))


def repeated(records: DataFrame, key: str = "page_id", least: int = 0) -> DataFrame:
    """Records (archive, place) that are to revisit another: of equal payloads of `least` bytes or more all but that of the largest key, refers_to."""
    rows = records.where(F.col("n_bytes") >= least)
    groups = rows.groupBy("digest", "n_bytes").agg(F.max(key).alias("kept"), F.count("*").alias("copies"))
    found = rows.join(groups.where("copies > 1 and kept is not null").drop("copies"), ["digest", "n_bytes"])
    return found.where(~F.col(key).eqNullSafe(F.col("kept"))).select("archive", "place", F.col("kept").cast("string").alias("refers_to"))


# --- normaliser ----------------------------------------------------------------------------------


def inflated(file) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or several, in pieces; read from its start to its end once."""
    stream, fresh, data = zlib.decompressobj(GZIP), True, b""
    while data := data or file.read(PIECE):
        if fresh and not (data := data.lstrip(b"\0")):  # padding
            continue
        piece, fresh = stream.decompress(data, PIECE), False
        data = stream.unconsumed_tail
        if stream.eof:
            stream, fresh, data = zlib.decompressobj(GZIP), True, stream.unused_data
        if piece:
            yield piece
    if not fresh:
        yield stream.flush()
        if not stream.eof:
            raise ValueError("the archive ends inside a gzip stream")


class Records:
    """Reads records off a stream of pieces."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held, self.at = pieces, b"", 0

    def left(self) -> int:
        return len(self.held) - self.at

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is not None:
            self.held, self.at = self.held[self.at :] + piece, 0
        return piece is not None

    def until_blank_line(self, most: int | None = None) -> bytes:
        """The bytes up to the next blank line and with it, or `most` bytes if that is fewer; none at the end of the stream."""
        seen = 0
        while (found := self.held.find(END, self.at + seen)) < 0 and (most is None or self.left() < most):
            seen = max(0, self.left() - 3)
            if not self.more():
                if most is None and self.left():
                    raise ValueError("the archive ends inside a record's head")
                break
        size = found + len(END) - self.at if found >= 0 else self.left()
        return self.some(size if most is None else min(size, most))

    def some(self, size: int) -> bytes:
        out = self.held[self.at : self.at + size]
        self.at += len(out)
        return out

    def next_head(self) -> bytes:
        while True:
            if self.held.startswith(b"\r\n", self.at):
                self.at += 2
            elif self.left() >= 2 or not self.more():
                return self.until_blank_line()

    def take(self, size: int) -> Iterator[bytes]:
        """The next bytes in pieces."""
        while size:
            if not self.left() and not self.more():
                raise ValueError("the archive ends inside a record")
            piece = self.some(size)
            size -= len(piece)
            yield piece


def rewritten(pieces: Iterator[bytes], file, revisits: dict[int, str]) -> Iterator[tuple[int, int, int, str, str]]:
    """Writes every record of a stream to file as a member; (place, offset, length, record id, type) of each."""
    records, place, offset = Records(pieces), 0, 0
    while raw := records.next_head():
        first, fields = parse(raw)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record: {first[:80]!r}")
        size = int(fields["content-length"])
        member, length = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0
        if place in revisits and fields.get("warc-type") == "response":
            http = records.until_blank_line(size)
            for _ in records.take(size - len(http)):
                pass
            fields["warc-type"] = "revisit"
            parts: Iterator[bytes] = iter([revisit(fields, revisits[place], len(http)), http])
        else:
            parts = (part for some in ((raw,), records.take(size)) for part in some)
        for part in parts:
            length += file.write(member.compress(part))
        length += file.write(member.compress(END) + member.flush())
        yield place, offset, length, fields.get("warc-record-id", "").strip("<>"), fields.get("warc-type", "")
        place, offset = place + 1, offset + length


def normalise(archives: DataFrame, source: str, folder: str, revisits: DataFrame | None = None) -> DataFrame:
    """Rewrites archives (rows of `archive`, names in the folder source) to folder, a gzip member for each record; the sidecar index.

    revisits (archive, place, refers_to): responses that become revisits. An archive is one task's work, as its stream can't be split, and
    what reaches that task is its name and its revisits. The index is a written table: each archive is inflated once.
    """
    spark = archives.sparkSession
    names = archives.select("archive").distinct()
    # the work isn't in the rows that are exchanged, so their number of partitions is given and not derived from their size
    tasks = max(1, min(MAX_TASKS, names.count()))
    rows = names.select("archive", F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("refers_to"))
    if revisits is not None:
        rows = rows.unionByName(revisits.select("archive", "place", "refers_to"))

    def one(group: pa.Table) -> pa.Table:
        name = group.column("archive")[0].as_py()
        known = {p: r for p, r in zip(group.column("place").to_pylist(), group.column("refers_to").to_pylist(), strict=True) if p is not None}
        files, path = opened(source)
        out, to = opened(folder)
        out.create_dir(to, recursive=True)
        new = f"{uuid4().hex}.warc.gz"
        with files.open_input_stream(f"{path}/{name}", compression=None) as stream, out.open_output_stream(f"{to}/{new}", compression=None) as file:
            found = list(rewritten(inflated(stream), file, known))
        places, offsets, lengths, ids, types = zip(*found, strict=True) if found else ([], [], [], [], [])
        return pa.table([pa.array([new] * len(found), pa.string()), pa.array(places, pa.int32()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.string()), pa.array(types, pa.string())], ["archive", "place", "offset", "length", "record_id", "record_type"])

    return storage.written(rows.repartition(tasks, "archive").groupBy("archive").applyInArrow(one, INDEX_SCHEMA))


# --- reading -------------------------------------------------------------------------------------


def unframed(member: bytes, with_payload: bool) -> tuple[str | None, int, str, str, str | None, bytes | None]:
    """(id, payload bytes, digest, type, refers to, payload) of a response's or revisit's member."""
    stream = zlib.decompressobj(GZIP)
    raw = stream.decompress(member)
    if not stream.eof or stream.unused_data:
        raise ValueError("the index doesn't fit the archive")
    at = raw.index(END) + 4
    _, fields = parse(raw[:at])
    stop = at + int(fields["content-length"])
    body = raw.index(END, at, stop) + 4
    _, http = parse(raw[at:body])
    kind, size = fields["warc-type"], int(http["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    payload = raw[body:stop] if kind == "response" else None
    if payload is not None and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} differs from its digest")
    name = lambda x: unquote(x.strip("<>").removeprefix(URN)) or None
    return name(fields["warc-record-id"]), size, digest, kind, name(fields["warc-refers-to"]) if kind == "revisit" else None, payload if with_payload else None


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """id, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits, or unless asked for) of the index's
    responses and revisits. A filtered index reads only the bytes of its records."""
    rows = index.where(F.col("record_type").isin("response", "revisit")).select("archive", "offset", "length")
    total = rows.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(MAX_TASKS, -(-total // READ_BYTES)), min(MAX_TASKS, rows.sparkSession.sparkContext.defaultParallelism))
    rows = rows.repartition(tasks, "archive", F.floor(F.col("offset") / (READ_BYTES // 4))).sortWithinPartitions("archive", "offset")
    names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        name, file = None, None
        for batch in batches:
            archives, offsets, lengths = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            row = 0
            while row < len(archives):
                if archives[row] != name:
                    if file:
                        file.close()
                    name, file = archives[row], files.open_input_file(f"{path}/{archives[row]}")
                # records that follow each other are read together
                stop = row + 1
                while stop < len(archives) and archives[stop] == name and offsets[stop] == offsets[stop - 1] + lengths[stop - 1] and offsets[stop] + lengths[stop] - offsets[row] <= PIECE:
                    stop += 1
                raw = memoryview(file.read_at(int(offsets[stop - 1] + lengths[stop - 1] - offsets[row]), int(offsets[row])))
                cuts = np.append(offsets[row:stop] - offsets[row], len(raw)).tolist()
                found = [unframed(raw[a:b], with_payload) for a, b in zip(cuts, cuts[1:], strict=False)]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names)
                row = stop
        if file:
            file.close()

    return rows.mapInArrow(read, "id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary")


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Pages written, normalised and read back: key, payload_bytes, payload_digest, record_type, refers_to."""
    spark, kind = pages.sparkSession, pages.schema[key].dataType
    raw, folder = storage.shared_folder(spark), storage.shared_folder(spark)
    records = write_archives(pages, raw, key, url, payload)
    index = normalise(records, raw, folder, repeated(records, key, least))
    storage.remove(spark, raw)
    return read_records(index, folder).select(F.col("id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
