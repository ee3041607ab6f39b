"""Packing of documents into sequences along a Hilbert curve through hashed vectors."""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanfeat.llm.common import text_rows
from spanfeat.llm.flat_text import flat, parts
from spanfeat.llm.piece_ids import piece_encoder
from spanfeat.session import staged

END = 1
BUCKETS, DIMS, BITS = 256, 3, 10


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    return np.random.default_rng(5).standard_normal((BUCKETS, DIMS))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of cells (rows) with integer coordinates below 2 ** bits.

    The coordinates' axes are rotated and mirrored level by level so that neighbouring
    sub-cubes join, then the Gray code of the interleaved bits is decoded.
    """
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    gray = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            gray = gray << 1 | (x[i] >> b & 1)
    shift = 1
    while shift < dims * bits:
        gray ^= gray >> shift
        shift *= 2
    return gray


def cells(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cells of documents: hashed token shares, projected with fixed signs and squashed.

    ``ends`` are the documents' offsets in ``ids``; a document without ids lies in the cell
    of the zero vector's corner.
    """
    n = np.diff(ends)
    slot = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
    row = np.repeat(np.arange(len(n)), n)
    sums = np.stack([np.bincount(row, weights=_signs()[slot, d], minlength=len(n)) for d in range(DIMS)], axis=1)
    made = (((np.tanh(sums / np.maximum(n, 1)[:, None] * 4) + 1) / 2) * ((1 << BITS) - 1)).astype(np.int64)
    made[n == 0] = 0
    return made


def sequence_bounds(total: int, size: int) -> list[int]:
    """Ends of the sequences after the last full one: the rest in falling powers of two."""
    full, ends = total // size * size, []
    rest, at = total - full, full
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def pieces(start: int, count: int, total: int, size: int) -> list[tuple[int, int, int, int]]:
    """Pieces (start in document, length, sequence, offset) of tokens [start, start+count)."""
    out, at, stop = [], start, start + count
    full = total // size * size
    ends = sequence_bounds(total, size)
    while at < stop:
        if at < full:
            seq, begin = at // size, at // size * size
            end = begin + size
        else:
            k = next(k for k, e in enumerate(ends) if at < e)
            seq, begin, end = full // size + k, ends[k - 1] if k else full, ends[k]
        upto = min(stop, end)
        out.append((at - start, upto - at, seq, at - begin))
        at = upto
    return out


def pack(docs: DataFrame, tokenizer: str, size: int = 2048) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    Documents are range-sorted by (Hilbert key, doc_id) and laid end to end, so neighbours
    on the curve share sequences and none is padded: what is left after the last full
    sequence is cut into falling powers of two. Null text counts as empty: only the end id.
    Repeated rows are packed as often as given. Extra columns are ignored; an empty table
    gives no rows. ``tokenizer`` is the path of the vocabulary file on every machine.
    """

    end = struct.pack("<I", END)

    def encode(batches):
        encoder = piece_encoder(tokenizer)
        for batch in batches:
            for part in parts(batch, "text"):
                ids, ends = encoder.encode(*flat(part.column("text")))
                data = ids.astype("<u4").tobytes()
                packed = [zlib.compress(data[4 * a : 4 * b] + end, 1) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(ends) + 1),
                        pa.array(hilbert_keys(cells(ids, ends))), pa.array(packed, pa.binary()),
                    ],
                    names=["doc_id", "n", "curve", "ids"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = source.mapInArrow(encode, "doc_id long, n long, curve long, ids binary")
    tokens = staged(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    order = ["curve", "doc_id", "row"]
    light = tokens.select("row", "doc_id", "n", "curve").repartitionByRange(*order)
    light = staged(light.withColumn("part", F.spark_partition_id()), "ranges")
    # one row per range
    sums = sorted(tuple(r) for r in light.groupBy("part").agg(F.sum("n")).collect())
    starts, total = [], 0
    for part, n in sums:
        starts.append((part, total))
        total += n
    base = docs.sparkSession.createDataFrame(starts, "part int, base long")
    along = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    light = light.withColumn("inside", F.coalesce(F.sum("n").over(along), F.lit(0))).join(F.broadcast(base), "part")
    placed = tokens.select("row", "doc_id", "n", "ids").join(light.select("row", (F.col("base") + F.col("inside")).alias("at")), "row")

    def cut(doc_id, n, ids, at):
        data = zlib.decompress(ids)
        for start, length, seq, offset in pieces(at, n, total, size):
            yield doc_id, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), n, seq, offset

    return text_rows(
        placed, cut, ["doc_id", "n", "ids", "at"],
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
