"""Token ids on disk: canonical length-limited Huffman codes from global counts.

A file holds the code lengths, one bit string per document, and an index: doc_id, number of
ids and, as a checkpoint, the bits that every block of ``BLOCK`` ids takes. From the
checkpoints all blocks start at known bit offsets, so they are decoded side by side: one
table look-up per step gives the id and the length of the next code of every block.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanfeat.llm.common import release, staged_tight
from spanfeat.llm.flat_text import binary, flat, parts
from spanfeat.llm.piece_ids import piece_encoder
from spanfeat.operators.skew import tasks_of
from spanfeat.session import scratch

# Fixed values of the file format.
MAGIC, VERSION = b"IDHF", 1
BLOCK = 256
MAX_BITS = 20  # a code and 7 bits before it fit in 32 bits
TRAILER = struct.Struct("<QQII4s")  # places of bodies' end and index's end, their CRC-32, magic
# Ids decoded at once.
PART_IDS = 1 << 20


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits, by package-merge; 0 where unused.

    Level by level, pairs of the lightest items of the level below become packages beside
    the single symbols. A symbol's length is the number of levels that use it.
    """
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit in codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order]
    items, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        items = both[rank]
        is_leaf.append(rank < n)
    take = 2 * (n - 1)
    for level in reversed(is_leaf):
        single = int(level[:take].sum())
        lengths[order[:single]] += 1
        take = 2 * (take - single)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, symbol); within one length they count up."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        size = lengths[order].astype(np.int64)
        top = int(size[-1])
        step = np.int64(1) << (top - size)
        codes[order] = (np.cumsum(step) - step) >> (top - size)
    return codes


class Coder:
    """Encoder and decoder tables of one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths).astype(np.uint64)
        self.top = int(lengths.max(initial=0))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        width = np.int64(1) << (self.top - self.lengths[order])
        self.symbols = np.repeat(order.astype(np.uint32), width)
        self.steps = np.repeat(self.lengths[order], width)
        if len(order) == 1:  # the only code is a single 0
            self.symbols, self.steps = np.repeat(self.symbols, 2), np.repeat(self.steps, 2)

    def encode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all documents, their offsets, and the bits of every block.

        ``ends`` are the offsets of the documents in ``ids``; each begins on a whole byte.
        """
        size = self.lengths[ids]
        if len(ids) and not size.min():
            raise ValueError("an id has no code")
        upto = np.concatenate([[0], np.cumsum(size)])
        bits = np.diff(upto[ends])
        offsets = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
        counts = np.diff(ends)
        at = upto[:-1] + np.repeat(8 * offsets[:-1] - upto[ends[:-1]], counts)
        out = np.zeros(int(offsets[-1]) // 8 + 2, np.uint64)
        word, spare = at >> 6, 64 - (at & 63) - size
        code = self.codes[ids]
        if len(ids):
            here = np.where(spare >= 0, code << np.maximum(spare, 0).astype(np.uint64), code >> np.maximum(-spare, 0).astype(np.uint64))
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            out[word[first]] = np.bitwise_or.reduceat(here, first)
            over = spare < 0
            out[word[over] + 1] |= code[over] << (64 + spare[over]).astype(np.uint64)
        blocks = -(-counts // BLOCK)
        row = np.repeat(np.arange(len(counts)), blocks)
        start = ends[:-1][row] + BLOCK * (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        stop = np.minimum(start + BLOCK, ends[1:][row])
        return out.astype(">u8").view(np.uint8)[: offsets[-1]], offsets, (upto[stop] - upto[start]).astype(np.uint16)

    def decode(self, data: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of independent blocks that start at bits ``at`` and hold ``counts`` ids, in block order."""
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")  # blocks still open are always the first ones
        place, put, left = at[order].copy(), starts[order], counts[order]
        padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
        window = padded[:-3] << np.uint32(24) | padded[1:-2] << np.uint32(16) | padded[2:-1] << np.uint32(8) | padded[3:]
        down = np.uint32(32 - self.top)
        for k in range(int(left[0]) if len(left) else 0):
            live = np.searchsorted(-left, -k)  # blocks with more than k ids
            p = place[:live]
            slot = window[p >> 3] << (p & 7).astype(np.uint32) >> down
            out[put[:live] + k] = self.symbols[slot]
            place[:live] += self.steps[slot]
        return out


def pack_lengths(lengths: np.ndarray) -> bytes:
    return zlib.compress(lengths.astype(np.uint8).tobytes(), 9)


@lru_cache(maxsize=2)
def coder_of(packed: bytes) -> Coder:
    """Coder of packed code lengths; built once per worker."""
    return Coder(np.frombuffer(zlib.decompress(packed), np.uint8))


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n, ids): ids of each whole text and the end id, as little-endian 32-bit numbers."""

    def run(batches):
        encoder = piece_encoder(tokenizer)
        for batch in batches:
            for part in parts(batch, "text"):
                ids, ends = encoder.encode(*flat(part.column("text")))
                rows = np.arange(part.num_rows)
                all_ids = np.insert(ids, ends[1:], end_id)
                ends = ends + np.append(rows, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(ends)), binary(all_ids.astype("<u4").view(np.uint8), 4 * ends).cast(pa.binary())],
                    names=["doc_id", "n", "ids"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, n long, ids binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs; one row per task and id meets in the shuffle."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in parts(batch, "ids"):
                data, _ = flat(part.column("ids"))
                made = np.bincount(np.ascontiguousarray(data).view("<u4"), minlength=len(total))
                made[: len(total)] += total
                total = made
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _rank(doc_id, row) -> tuple:
    """Place of a row in the order of the files; a null doc_id comes first."""
    return (doc_id is not None, doc_id or 0, row)


class _File:
    """One archive under construction; documents are appended whole."""

    def __init__(self, store, path: str, header: bytes):
        self.sink = store.open_output_stream(path, compression=None)
        self.sink.write(header)
        self.size, self.crc = len(header), zlib.crc32(header)
        self.docs, self.ids, self.index = 0, 0, ([], [], [], [])

    def add(self, doc_id, n: int, bits: bytes, body: bytes) -> None:
        self.sink.write(body)
        self.size += len(body)
        self.crc = zlib.crc32(body, self.crc)
        self.docs += 1
        self.ids += n
        for column, value in zip(self.index, (doc_id or 0, doc_id is None, n, bits)):
            column.append(value)

    def close(self) -> None:
        ids, absent, n, bits = self.index
        index = zlib.compress(
            struct.pack("<Q", len(ids)) + np.array(ids, "<i8").tobytes() + np.array(absent, np.uint8).tobytes()
            + np.array(n, "<u8").tobytes() + b"".join(bits)
        )
        self.sink.write(index)
        self.sink.write(TRAILER.pack(self.size, self.size + len(index), self.crc, zlib.crc32(index), MAGIC))
        self.sink.close()


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int, roll_bytes: int = 32 << 20) -> DataFrame:
    """Write the ids of all documents below ``folder``, by ascending doc_id; returns the manifest, read back.

    Tokens are staged once, counted, and coded before they are range-sorted by (doc_id, row),
    so the shuffle carries code bits; the ranges come from those two columns alone. A task
    writes its range to files that roll over at
    ``roll_bytes``. File names hold the task's attempt; only files in the manifest, which is
    written last, exist for a reader. Manifest: file, part, seq, docs, ids, bytes.
    """
    spark = docs.sparkSession
    tokens = staged_tight(token_table(docs, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id()), "tokens")
    # at most one row per id of the vocabulary
    counted = id_counts(tokens).toArrow()
    found = counted.column("id").to_numpy()
    counts = np.zeros(int(found.max(initial=0)) + 1, np.int64)
    counts[found] = counted.column("n").to_numpy()
    packed = pack_lengths(code_lengths(counts))
    header = MAGIC + struct.pack("<II", VERSION, len(packed)) + packed
    order = ["doc_id", "row"]
    ranges = tokens.select(*order).repartitionByRange(tasks_of(tokens), *order)
    first = ranges.groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("at"))
    # one row per range
    bounds = sorted(_rank(*r["at"]) for r in first.collect())

    def code(batches):
        coder = coder_of(packed)
        for batch in batches:
            for part in parts(batch, "ids"):
                data, ends = flat(part.column("ids"))
                out, offsets, bits = coder.encode(np.ascontiguousarray(data).view("<u4"), ends // 4)
                blocks = np.concatenate([[0], np.cumsum(-(-np.diff(ends // 4) // BLOCK))])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("n"), part.column("row"),
                        pa.array(
                            [bisect_right(bounds, _rank(d, r)) - 1 for d, r in zip(*(part.column(c).to_pylist() for c in order))],
                            pa.int32(),
                        ),
                        binary(bits.astype("<u2").view(np.uint8), 2 * blocks).cast(pa.binary()),
                        binary(out, offsets).cast(pa.binary()),
                    ],
                    names=["doc_id", "n", "row", "range", "bits", "body"],
                )

    coded = tokens.select("doc_id", "n", "row", "ids").mapInArrow(
        code, "doc_id long, n long, row long, range int, bits binary, body binary"
    )
    ranged = coded.repartitionById(max(1, len(bounds)), F.col("range")).sortWithinPartitions(*order)

    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        made, now = [], None

        def close():
            now.close()
            made[-1].update(docs=now.docs, ids=now.ids, bytes=now.size)

        for batch in batches:
            for doc_id, n, bits, body in zip(*(batch.column(c) for c in ("doc_id", "n", "bits", "body"))):
                if now is None:
                    name = f"part-{task.partitionId():06d}-{len(made):05d}.{task.taskAttemptId()}.ids"
                    made.append({"file": name, "part": task.partitionId(), "seq": len(made)})
                    now = _File(store, f"{root}/{name}", header)
                now.add(doc_id.as_py(), n.as_py(), bits.as_py(), body.as_py())
                if now.size >= roll_bytes:
                    close()
                    now = None
        if now is not None:
            close()
        yield pa.RecordBatch.from_pylist(made, schema=pa.schema(
            [("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]
        ))

    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    schema = "file string, part int, seq int, docs long, ids long, bytes long"
    ranged.select("doc_id", "n", "bits", "body").mapInArrow(write, schema).write.mode("error").json(f"{folder}/manifest")
    release(tokens)
    return spark.read.schema(schema).json(f"{folder}/manifest")


def read_file(store, path: str):
    """Batches (doc_ids, ids, offsets) of one file; checks magic, sizes and, at the end, CRCs."""
    with store.open_input_file(path) as source:
        size = source.size()
        source.seek(size - TRAILER.size)
        body_end, index_end, crc, index_crc, magic = TRAILER.unpack(source.read(TRAILER.size))
        source.seek(body_end)
        index = source.read(index_end - body_end)
        if magic != MAGIC or index_end + TRAILER.size != size or zlib.crc32(index) != index_crc:
            raise ValueError(f"{path} is damaged or not a file of ids")
        source.seek(0)
        head = source.read(len(MAGIC) + 8)
        version, length = struct.unpack("<II", head[len(MAGIC) :])
        if head[: len(MAGIC)] != MAGIC or version != VERSION:
            raise ValueError(f"{path} has another version")
        packed = source.read(length)
        coder = coder_of(packed)
        crc_now = zlib.crc32(packed, zlib.crc32(head))
        index = zlib.decompress(index)
        docs = struct.unpack_from("<Q", index)[0]
        ids = np.frombuffer(index, "<i8", docs, 8)
        absent = np.frombuffer(index, np.uint8, docs, 8 + 8 * docs).astype(bool)
        n = np.frombuffer(index, "<u8", docs, 8 + 9 * docs).astype(np.int64)
        bits = np.frombuffer(index, "<u2", offset=8 + 17 * docs).astype(np.int64)
        blocks = np.concatenate([[0], np.cumsum(-(-n // BLOCK))])
        upto = np.concatenate([[0], np.cumsum(bits)])
        ends = np.concatenate([[0], np.cumsum(n)])
        bytes_upto = np.concatenate([[0], np.cumsum((np.diff(upto[blocks]) + 7) // 8)])
        at = 0
        while at < docs:
            # whole documents; their blocks are decoded side by side
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + PART_IDS, side="right")) - 1)
            data = source.read(int(bytes_upto[to] - bytes_upto[at]))
            crc_now = zlib.crc32(data, crc_now)
            row = np.repeat(np.arange(at, to), np.diff(blocks[at : to + 1]))
            number = np.arange(blocks[at], blocks[to])
            start = 8 * (bytes_upto[row] - bytes_upto[at]) + upto[number] - upto[blocks[row]]
            count = np.minimum(n[row] - BLOCK * (number - blocks[row]), BLOCK)
            got = coder.decode(np.frombuffer(data, np.uint8), start, count)
            yield pa.array(ids[at:to], pa.int64(), mask=absent[at:to]), got, ends[at : to + 1] - ends[at]
            at = to
        if crc_now != crc:
            raise ValueError(f"{path} is damaged")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): all documents of the files in a manifest.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian 32-bit
    numbers. One task per file.
    """
    # one row per file
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    files = files.repartitionByRange(max(1, manifest.count()), "part", "seq").select("file", "start", "docs", "ids")

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.to_pylist():
                start, docs, first = file["start"], 0, file["start"]
                for doc_ids, ids, ends in read_file(store, f"{root}/{file['file']}"):
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_ids, pa.array(start + ends[:-1]), pa.array(np.diff(ends)),
                            binary(ids.astype("<u4").view(np.uint8), 4 * ends).cast(pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    start, docs = start + int(ends[-1]), docs + len(doc_ids)
                if (docs, start - first) != (file["docs"], file["ids"]):
                    raise ValueError(f"{file['file']} does not hold what the manifest says")

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def id_archive_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): written to the shared folder and read back.

    Null text counts as empty: the end id alone. Rows of one doc_id stand side by side in the
    order of the input; a null doc_id comes first. Extra columns are ignored; an empty table
    gives no rows. A text is coded whole, whatever its length.
    """
    folder = scratch(docs.sparkSession, "ids")
    back = read_ids(write_ids(docs, tokenizer, folder, end_id), folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
