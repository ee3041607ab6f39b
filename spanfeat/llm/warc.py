"""Sharded WARC archives: written in range order, committed by a manifest, read back."""

from __future__ import annotations

import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import text_rows
from spanfeat.session import scratch, staged

DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, page_id, url: str | None, digest: str, size: int, refers_to, payload: bytes) -> bytes:
    """One record with its headers; a revisit has no payload of its own."""
    body = b"" if kind == "revisit" else payload
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + body
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    address = "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """One gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes) -> tuple[dict, bytes]:
    """Headers and block of one record, with its length and block digest checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if "sha256:" + hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest differs in {headers['WARC-Record-ID']}")
    return headers, block


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = 64 << 20, min_revisit: int = 100) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the manifest, read back.

    Payloads of at least ``min_revisit`` bytes that repeat become revisits of the record with
    the smallest page_id, and so do further rows of that page with the same payload. Records
    are range-sorted by (page_id, digest, url), each range rolls
    over to a new file once the compressed size passes ``roll_bytes``; a file is written under
    a temporary name, with the attempt in it, and renamed when whole, so a repeated task puts
    the same bytes under the same name. The manifest, written last, is the commit: files not
    in it do not exist for a reader.
    """
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.length("payload").cast("long"))
    light = base.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = staged(light.filter("n > 1").select("digest", "first"), "payloads")
    # only repeated payloads meet their first page; the light columns carry no payload
    roles = base.select("page_id", "url", "digest", "size").join(firsts, "digest").filter("page_id > first")
    roles = staged(roles.groupBy("page_id", "digest").agg(F.min("first").alias("first")), "revisits")
    known = base.join(roles, ["page_id", "digest"], "left")
    # rows of one page and payload stay together: the first of them is the response
    ranged = known.repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest", "url")

    def write(batches):
        import pandas as pd
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        files, sink, before = [], None, None

        def close():
            nonlocal sink
            if sink is not None:
                sink.close()
                store.move(f"{root}/{files[-1]['file']}.{task.taskAttemptId()}.tmp", f"{root}/{files[-1]['file']}")
                sink = None

        for pdf in batches:
            for page_id, url, payload, digest, size, first in zip(*(pdf[c].astype(object).where(pdf[c].notna(), None) for c in ("page_id", "url", "payload", "digest", "size", "first"))):
                if sink is None:
                    name = f"part-{task.partitionId():06d}-{len(files):05d}.warc.gz"
                    files.append({"file": name, "records": 0, "bytes": 0, "sha256": hashlib.sha256()})
                    sink = store.open_output_stream(f"{root}/{name}.{task.taskAttemptId()}.tmp", compression=None)
                if first is None and page_id is not None and (page_id, digest) == before and size >= min_revisit:
                    first = page_id
                before = (page_id, digest)
                kind = "response" if first is None else "revisit"
                ids = [None if x is None else int(x) for x in (page_id, first)]
                member = _member(record(kind, ids[0], url, digest, int(size), ids[1], bytes(payload)))
                sink.write(member)
                files[-1]["records"] += 1
                files[-1]["bytes"] += len(member)
                files[-1]["sha256"].update(member)
                if files[-1]["bytes"] >= roll_bytes:
                    close()
        close()
        yield pd.DataFrame(
            [f | {"sha256": f["sha256"].hexdigest()} for f in files], columns=["file", "records", "bytes", "sha256"]
        )

    spark = pages.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    manifest = ranged.mapInPandas(write, "file string, records long, bytes long, sha256 string")
    manifest.write.mode("error").json(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).json(f"{folder}/manifest")


def read_archives(manifest: DataFrame, folder: str, chunk: int = 1 << 20) -> DataFrame:
    """Records of all files of a manifest: (page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload). A file is streamed; one record is held at a time.
    Digests, lengths and record counts are checked.
    """

    def read(file, records):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        seen = 0
        with store.open_input_stream(f"{root}/{file}", compression=None) as source:
            data = source.read(chunk)
            while data:
                unpack, parts = zlib.decompressobj(31), []
                while not unpack.eof:
                    parts.append(unpack.decompress(data))
                    data = unpack.unused_data if unpack.eof else source.read(chunk)
                    if not data and not unpack.eof:
                        raise ValueError(f"{file} ends within a record")
                headers, block = parse(b"".join(parts))
                payload = block.partition(b"\r\n\r\n")[2]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                kind, refers = headers["WARC-Type"], headers.get("X-Refers-To-Page")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload digest differs in {file}")
                seen += 1
                page = headers["X-Page-Id"]
                yield (
                    int(page) if page else None, headers["WARC-Target-URI"], int(headers["X-Payload-Length"]), digest,
                    kind, int(refers) if refers else None, payload if kind == "response" else None,
                )
                data = data or source.read(chunk)
        if seen != records:
            raise ValueError(f"{file} has {seen} records, the manifest {records}")

    # one task per file, by an explicit number that is not merged for the rows' small size
    files = manifest.select("file", "records").repartitionByRange(max(1, manifest.count()), "file")
    return text_rows(
        files, read, ["file", "records"],
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long, payload binary",
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to the shared folder and read the archives back.

    One row per page. Null html is an empty payload, null url an empty address. Of several
    rows of one page_id and payload of at least 100 bytes one is a response at most. A null
    page_id is always a response and refers to nothing. Extra columns are ignored; an empty table gives no rows.
    """
    folder = scratch(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
