"""Document fingerprints: Merkle trees over sentences, paragraphs and sections."""

from __future__ import annotations

import hashlib
import re
import struct
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import staged_tight
from spanfeat.llm.flat_text import parts

# A leaf ends after a sentence mark or a paragraph end, and after any word of a long
# stretch without marks whose hash says so.
_LEAF = re.compile(r"[^.!?\n]*(?:[.!?]+[^\S\n]*\n?|\n|$)")
LONG = 200
_WORD = re.compile(r"\S+\s*|\s+")


_PARAGRAPH = re.compile(r"[^\n]*\n|[^\n]+")


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def leaves(paragraph: str) -> list[str]:
    """Pieces of a paragraph; joined they give it back."""
    out = []
    for piece in _LEAF.findall(paragraph):
        if len(piece) <= LONG:
            if piece:
                out.append(piece)
            continue
        run = []
        for word in _WORD.findall(piece):
            run.append(word)
            if _digest(word.encode())[0] % 12 == 0:
                out.append("".join(run))
                run = []
        if run:
            out.append("".join(run))
    return out


# Bytes of a node's digest in the stored tree; the root and all digests that go into a
# parent's are 16 bytes long.
SHORT, FULL = 8, 16
_HEAD = struct.Struct("<III")  # numbers of sections, paragraphs and leaves


def fingerprint(text: str) -> bytes:
    """Stored Merkle tree: root, counts, then sections, paragraphs and leaves level by level.

    A section is its digest and number of paragraphs, a paragraph its digest and number of
    leaves, a leaf its digest. Paragraphs end at line feeds. A section ends after a paragraph
    whose digest begins with a byte divisible by four, so an edit moves only the sections
    near it. Inner nodes hash their children's full digests; equal roots mean equal texts.
    """
    sections, paragraphs, leaf_level, roots, nodes = [], [], [], [], []

    def close():
        digest = _digest(b"".join(nodes))
        roots.append(digest)
        sections.append(digest[:SHORT] + len(nodes).to_bytes(4, "little"))
        nodes.clear()

    for paragraph in _PARAGRAPH.findall(text):
        hashes = [_digest(leaf.encode()) for leaf in leaves(paragraph)]
        node = _digest(b"".join(hashes))
        nodes.append(node)
        paragraphs.append(node[:SHORT] + len(hashes).to_bytes(4, "little"))
        leaf_level += [h[:SHORT] for h in hashes]
        if node[0] % 4 == 0:
            close()
    if nodes:
        close()
    head = _HEAD.pack(len(sections), len(paragraphs), len(leaf_level))
    return _digest(b"".join(roots)) + head + b"".join(sections) + b"".join(paragraphs) + b"".join(leaf_level)


class Tree:
    """Reader of a stored tree; a level's digests are cut out only when they are asked for."""

    def __init__(self, stored: bytes):
        self.data, self.root = stored, stored[:FULL]
        self.sizes = _HEAD.unpack_from(stored, FULL)
        start = FULL + _HEAD.size
        wide = SHORT + 4
        self.starts = (start, start + wide * self.sizes[0], start + wide * (self.sizes[0] + self.sizes[1]))
        self._first: dict[int, list[int]] = {}

    def digest(self, level: int, k: int) -> bytes:
        """Digest of node ``k`` of level 0 (sections), 1 (paragraphs) or 2 (leaves)."""
        at = self.starts[level] + k * (SHORT + (4 if level < 2 else 0))
        return self.data[at : at + SHORT]

    def children(self, level: int, k: int) -> range:
        """Nodes of the next level below node ``k``."""
        first = self._first.get(level)
        if first is None:
            at, wide, first = self.starts[level] + SHORT, SHORT + 4, [0]
            for j in range(self.sizes[level]):
                first.append(first[-1] + int.from_bytes(self.data[at + j * wide : at + j * wide + 4], "little"))
            self._first[level] = first
        return range(first[k], first[k + 1])

    def leaves_below(self, level: int, k: int) -> int:
        if level == 2:
            return 1
        below = self.children(level, k)
        if level == 1:
            return len(below)
        return self.children(1, below[-1]).stop - self.children(1, below[0]).start if below else 0


def _common(a: Tree, b: Tree, level: int, left: list[int], right: list[int]) -> tuple[int, list[int]]:
    """Leaves that two lists of nodes share, and the nodes of the left that the right lacks.

    Equal nodes are matched whole; only what is left of both sides is opened.
    """
    have = defaultdict(list)
    for k in right:
        have[b.digest(level, k)].append(k)
    total, rest, used = 0, [], set()
    for k in left:
        twins = have.get(a.digest(level, k))
        if twins:
            used.add(twins.pop())
            total += a.leaves_below(level, k)
        else:
            rest.append(k)
    if level < 2 and rest and len(used) < len(right):
        open_a = [c for k in rest for c in a.children(level, k)]
        open_b = [c for k in right if k not in used for c in b.children(level, k)]
        total += _common(a, b, level + 1, open_a, open_b)[0]
    return total, rest


def compare(a: bytes, b: bytes) -> tuple[float, list[int]]:
    """Share of leaves in common, from 0 to 1 (1 for equal roots alone), and the sections of
    ``a``, counted from 0, that ``b`` lacks."""
    if a[:FULL] == b[:FULL]:
        return 1.0, []
    x, y = Tree(a), Tree(b)
    same, rest = _common(x, y, 0, list(range(x.sizes[0])), list(range(y.sizes[0])))
    total = x.sizes[2] + y.sizes[2]
    return min(2 * same / total, 0.9999) if total else 0.0, rest


def _row(doc_id, text: str, following: str, own: bytes | None = None, other: bytes | None = None):
    cut = len(text) // 4
    edited = text[: len(text) - cut] + following[:cut]
    own, after = own or fingerprint(text), fingerprint(edited)
    near, sections = compare(own, after)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return doc_id, len(text), digest, own, after, near, compare(own, other or fingerprint(following))[0], sections


COLUMNS = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_sections",
]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each whole text and of its edit with the next document's beginning.

    Columns as in ``COLUMNS``: fingerprints are hexadecimal, ``edited_sections`` are the
    sections of the text, counted from 0, that the edit changed. Documents are range-sorted
    by (doc_id, hash of the text, row), null doc_id first, so rows repeated in full spread
    over tasks, and the keys that the range partitioner samples hold no text; each task
    streams over its range. The texts travel compressed. The two ends of each range are
    written apart and joined in a second step, so one row per range meets one other row.
    Null text counts as empty. Extra columns are ignored; an empty table gives no rows; a
    single row is its own next document.
    """

    def squeeze(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in parts(batch, "text"):
                packed = [packer.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), part.column("row"), pa.array(packed, pa.binary())],
                    names=["doc_id", "h", "row", "packed"],
                )

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("row"), "text",
    )
    order = ["doc_id", "h", "row"]
    packed = keyed.mapInArrow(squeeze, "doc_id long, h long, row long, packed binary")
    ranged = packed.repartitionByRange(*order).sortWithinPartitions(*order)

    def walk(batches):
        import zstandard
        from pyspark import TaskContext

        unpack = zstandard.ZstdDecompressor().decompress
        part, held, first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            out = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist()):
                text = unpack(data).decode()
                fp = fingerprint(text)
                if first:
                    out.append((*[None] * 8, part, text, None))
                    first = False
                else:
                    out.append((*_row(held[0], held[1], text, held[2], fp), None, None, None))
                held = (doc_id, text, fp)
            yield _batch(out)
        if held is not None:
            yield _batch([(held[0], *[None] * 7, part, None, held[1])])

    walked = staged_tight(ranged.mapInArrow(walk, SCHEMA + ", part long, first string, last string"), "walk")
    inside = walked.filter("part IS NULL").select(*COLUMNS)
    # part numbers only: one row per range
    numbers = sorted(r[0] for r in walked.filter("first IS NOT NULL").select("part").collect())
    after = dict(zip(numbers, numbers[1:] + numbers[:1]))
    pairs = docs.sparkSession.createDataFrame(list(after.items()), "part long, next long")
    heads = walked.filter("first IS NOT NULL").select(F.col("part").alias("next"), F.col("first").alias("following"))
    tails = walked.filter("last IS NOT NULL").select("part", "doc_id", F.col("last").alias("text"))
    seams = tails.join(pairs, "part").join(heads, "next").select("doc_id", "text", "following")

    def finish(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")))
            made = [_row(*r) for r in rows]
            yield _batch(made, len(COLUMNS))

    made = inside.unionByName(seams.mapInArrow(finish, SCHEMA))
    return made.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double, edited_sections array<int>"
)
_TYPES = [
    pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.list_(pa.int32()),
    pa.int64(), pa.string(), pa.string(),
]


def _batch(rows: list[tuple], width: int = len(_TYPES)) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * width
    names = [*COLUMNS, "part", "first", "last"][:width]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=names)
