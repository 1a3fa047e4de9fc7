"""WARC in seekable Zstandard bundles: independent frames, a seek table as footer, and an index of records."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import bounded, materialise, scratch

#: Fixed values of the seekable format: the skippable frame that holds the table, and the footer's mark.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "bundle string, record_id string, page_id long, frame int, offset long, size long, record_type string"
RECORDS = (
    "record_id string, page_id long, uri string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_record(page: int | None, uri: str | None, payload: bytes, refers_to: int | None, record_id: str) -> bytes:
    """One WARC/1.1 record. A revisit carries the digest and the length of its payload, but not the payload."""
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {DATE}"]
    lines += [f"WARC-Page: {page}"] if page is not None else []
    lines += ["WARC-Target-URI: " + " ".join(uri.split())] if uri is not None else []
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To-Page: {refers_to}"]
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = payload if refers_to is None else b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def read_record(data: bytes, offset: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and end of the record at an offset of a frame."""
    end = data.index(b"\r\n\r\n", offset)
    first, *lines = data[offset:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at {offset}: {first!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {offset} does not end where its length says")
    return headers, data[start:stop], stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer of a bundle: (compressed, decompressed) size of each frame, in a skippable frame."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(place in the file, compressed size, decompressed size) of each frame, from the end of the file only."""
    size = source.size()
    source.seek(size - 9)
    count, _, mark = struct.unpack("<IBI", source.read(9))
    if mark != SEEKABLE:
        raise ValueError("no seek table")
    source.seek(size - 9 - 8 * count)
    sizes = np.frombuffer(source.read(8 * count), "<u4").reshape(-1, 2).astype(np.int64)
    places = np.r_[0, np.cumsum(sizes[:, 0])]
    return [(int(place), int(a), int(b)) for place, (a, b) in zip(places, sizes)]


def read_frame(source: pa.NativeFile, place: int, compressed: int, size: int) -> bytes:
    source.seek(place)
    return zstandard.ZstdDecompressor().decompress(source.read(compressed), max_output_size=size)


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared location, local or remote."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def payload_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id``, ``same``, ``size`` and ``refers_to``: of pages with equal payloads, all but the largest refer to the largest.

    A row stands for a page and a payload (``same`` is its digest), as one ``page_id`` may carry several. Payloads are compared by SHA-256 and length. Payloads under ``least`` bytes, and rows with a null ``page_id``, refer
    to nothing. Only digests are shuffled; equal ones are combined before the shuffle, and a digest that many pages
    share is a join key that adaptive execution splits.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    light = pages.select(F.col("page_id").cast("long").alias("page_id"), *_identity(payload)).filter(F.col("page_id").isNotNull() & (F.col("size") >= least))
    light = materialise(light, "payloads")
    most = light.groupBy("same", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    repeated = materialise(most.filter("n > 1").drop("n"), "repeated")
    revisits = light.join(bounded(repeated), ["same", "size"]).filter("refers_to <> page_id")
    return revisits.select("page_id", "same", "size", "refers_to").distinct()


def _identity(payload: Column) -> list[Column]:
    return [F.unhex(F.sha2(payload, 256)).alias("same"), F.octet_length(payload).alias("size")]


def write_bundles(
    pages: DataFrame, folder: str, least: int = 0, frame_bytes: int = 1 << 20, bundle_bytes: int = 64 << 20
) -> DataFrame:
    """Write a WARC record per page into bundles under ``folder``; returns the index of records.

    A bundle is closed once it holds ``bundle_bytes``, and a frame once it holds ``frame_bytes``, before compression;
    a record never spans frames, so a task holds one frame and one page. The index (``bundle``, ``record_id``,
    ``page_id``, ``frame``, ``offset`` within the decompressed frame, ``size``, ``record_type``) is written as a
    table when all bundles are; a bundle of a task that was lost or run twice is not in it and is never read. A null
    html is an empty payload, a null page_id or url leaves the header out, repeated rows are records of their own
    (all with the largest page_id are responses), and a page_id with several payloads has a record of its own role for each. Other columns are left out.
    """
    roles = materialise(payload_roles(pages, least), "roles")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), *_identity(payload)
    ).join(bounded(roles), on=["page_id", "same", "size"], how="left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        files.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        name, out, frames, held, filled, written = "", None, [], [], 0, 0
        index: list[tuple] = []

        def close_frame() -> None:
            nonlocal held, filled, written
            if held:
                raw = b"".join(held)
                packed = packer.compress(raw)
                out.write(packed)
                frames.append((len(packed), len(raw)))
                written += len(raw)
                held, filled = [], 0

        def close_bundle() -> pa.RecordBatch:
            nonlocal out, frames, written, index
            close_frame()
            out.write(seek_table(frames))
            out.close()
            columns = list(zip(*index))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
            names = [one.split()[0] for one in MANIFEST.split(", ")]
            out, frames, written, index = None, [], 0, []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            names = ("page_id", "url", "payload", "refers_to")
            for row in range(len(batch)):
                page, url, payload, refers = (batch.column(one)[row].as_py() for one in names)
                if out is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    out = files.open_output_stream(store(name)[1], compression=None)
                record_id = str(uuid.uuid4())
                record = write_record(page, url, payload, refers, record_id)
                if filled and filled + len(record) > frame_bytes:
                    close_frame()
                kind = "response" if refers is None else "revisit"
                index.append((name, record_id, page, len(frames), filled, len(record), kind))
                held.append(record)
                filled += len(record)
                if written + filled >= bundle_bytes:
                    yield close_bundle()
        if out is not None:
            yield close_bundle()

    return materialise(rows.mapInArrow(run, MANIFEST), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record that the index lists, parsed from the archives; frames are read once, one at a time.

    The work is dealt by runs of 16 frames, so neither a large bundle nor many small ones make a slow task.
    """
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
    # The index is tiny beside the frames it points at, so its partitions must not be merged by size.
    width = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frames.withColumn("run", (F.col("frame") / 16).cast("int")).repartition(width, "bundle", "run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, table, source = None, [], None
        names = [one.split()[0] for one in RECORDS.split(", ")]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            for row in range(len(batch)):
                bundle, frame, offsets = (batch.column(one)[row].as_py() for one in ("bundle", "frame", "offsets"))
                if bundle != opened:
                    files, path = store(bundle)
                    source, opened = files.open_input_file(path), bundle
                    table = read_seek_table(source)
                data = read_frame(source, *table[frame])
                rows = []
                for offset in offsets:
                    headers, body, _ = read_record(data, offset)
                    page, refers = headers.get("WARC-Page"), headers.get("WARC-Refers-To-Page")
                    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Type"] == "response" and digest(body) != said:
                        raise ValueError(f"damaged payload in {bundle}")
                    name = headers["WARC-Record-ID"].removeprefix("<urn:uuid:").removesuffix(">")
                    rows.append((name, page and int(page), headers.get("WARC-Target-URI"), headers["WARC-Type"],
                                 refers and int(refers), int(headers["WARC-Payload-Length"]), said, body))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return dealt.select("bundle", "frame", "offsets").mapInArrow(run, RECORDS)


def lookup(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records with these identifiers (column ``record_id``): only their frames are read."""
    return read_bundles(index.join(record_ids.select("record_id").distinct(), on="record_id", how="left_semi"))


def archive(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write the pages as WARC bundles and read the archives back (see :func:`write_bundles`, :func:`read_bundles`)."""
    folder = folder or scratch(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder, least))
