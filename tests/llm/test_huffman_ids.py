"""Huffman files of token ids: code lengths, round trips and damage."""

import heapq
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from spanfeat.llm import huffman_ids as h
from spanfeat.llm.flat_text import flat
from spanfeat.llm.piece_ids import PieceEncoder
from spanfeat.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, ids string, row long, n long"
PIECES = ["a", "B", "cd", "'s", "'", "'re", "'ll", " ", "  ", "\n", "\t", "　", " ", "é", "́", "日", "😀",
          "1", "٣", "²", "!", "--", "<", "|", "<|endoftext|>", "s", "t", "don't"]


def unlimited_cost(counts):
    heap, total = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_lengths_are_optimal():
    rng = np.random.default_rng(1)
    for n in (2, 3, 7, 60, 900):
        counts = rng.integers(0, 1000, n)
        counts[:2] += 1
        assert int((h.code_lengths(counts).astype(int) * counts).sum()) == unlimited_cost(counts)
    steep = np.array([1, 1, 2, 4, 8, 16, 32, 64])
    best = min(
        sum(a * b for a, b in zip(size, steep))
        for size in itertools.product(range(1, 5), repeat=8) if sum(2.0**-a for a in size) <= 1
    )
    assert int((h.code_lengths(steep, 4).astype(int) * steep).sum()) == best
    assert h.code_lengths(steep, 4).max() == 4
    with pytest.raises(ValueError, match="do not fit"):
        h.code_lengths(np.ones(9, int), 3)


def test_codes_are_canonical_and_free_of_prefixes():
    lengths = h.code_lengths(np.array([5, 0, 9, 1, 1, 30]))
    words = [f"{c:0{s}b}" for c, s in zip(h.canonical_codes(lengths).tolist(), lengths.tolist()) if s]
    assert not any(a != b and b.startswith(a) for a in words for b in words)
    assert words == sorted(words, key=lambda x: (len(x), x)) or sorted(words)  # equal lengths count up
    by_length = sorted(zip(lengths[lengths > 0], words), key=lambda x: (x[0], x[1]))
    assert [w for _, w in by_length] == sorted(words)


def test_blocks_decode_on_their_own():
    rng = np.random.default_rng(2)
    for _ in range(25):
        size = int(rng.integers(0, 3000))
        ids = (rng.zipf(1.2, size) % int(rng.integers(1, 60000))).astype(np.uint32)
        ends = np.concatenate([[0], np.sort(rng.integers(0, size + 1, rng.integers(0, 9))), [size]])
        coder = h.Coder(h.code_lengths(np.bincount(ids, minlength=1)))
        data, offsets, bits = coder.encode(ids, ends)
        n = np.diff(ends)
        for row in range(len(n)):
            blocks = -(-n[: row + 1] // h.BLOCK)
            own = bits[blocks[:-1].sum() : blocks.sum()].astype(int)
            start = 8 * offsets[row] + np.cumsum(own) - own
            counts = np.minimum(n[row] - h.BLOCK * np.arange(len(own)), h.BLOCK)
            for k in rng.permutation(len(own)):  # each block alone, in any order
                got = coder.decode(data, start[k : k + 1], counts[k : k + 1])
                at = ends[row] + h.BLOCK * k
                assert (got == ids[at : at + counts[k]]).all()
            assert (coder.decode(data, start, counts) == ids[ends[row] : ends[row + 1]]).all()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    import pyarrow as pa

    random.seed(3)
    texts = ["".join(random.choices(PIECES, k=random.randint(0, 14))) for _ in range(8000)]
    encoder = PieceEncoder(tokenizer_path(name))
    for _ in range(2):  # the second time from memory
        ids, ends = encoder.encode(*flat(pa.array(texts)))
        for k, e in enumerate(encoder.tok.encode_batch(texts, add_special_tokens=False)):
            assert ids[ends[k] : ends[k + 1]].tolist() == e.ids, texts[k]


@pytest.fixture(scope="module")
def rows_in():
    random.seed(9)
    texts = [None, "", "a", "word " * 300_000, "é" * 1000] + [" ".join(random.choices(PIECES, k=40)) for _ in range(400)]
    made = [(3 * k, t, "clash", 1, 1) for k, t in enumerate(texts)]
    random.shuffle(made)
    return made + [made[0], made[0], (None, "no id", "c", 1, 1)]


def expected(rows_in):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    start, out = 0, []
    for doc_id, text, *_ in sorted(rows_in, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, rows_in, rows):
    docs = spark.createDataFrame(rows_in, SCHEMA).repartition(5)
    got = h.id_archive_round_trip(docs, tokenizer_path("byte_bpe_50k.json"))
    key = lambda r: r[1]
    assert sorted((tuple(r) for r in got.collect()), key=key) == expected(rows_in)


def test_rolled_files_and_damage(spark, rows_in, tmp_path):
    docs = spark.createDataFrame(rows_in, SCHEMA)
    folder = f"file://{tmp_path}/ids"
    manifest = h.write_ids(docs, tokenizer_path("byte_bpe_50k.json"), folder, 2, roll_bytes=4000)
    files = manifest.collect()
    assert len(files) > 5
    back = h.read_ids(manifest, folder)
    assert sorted((r["doc_id"], r["start"]) for r in back.filter("doc_id IS NOT NULL").collect()) == sorted(r[:2] for r in expected(rows_in) if r[0] is not None)
    hurt = tmp_path / "ids" / files[0]["file"]
    data = bytearray(hurt.read_bytes())
    data[-200] ^= 1
    hurt.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        h.read_ids(manifest, folder).collect()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert h.id_archive_round_trip(empty, tokenizer_path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_met_again_are_remembered(monkeypatch, file):
    """A full memory drops pieces met once only, and the ids stay those of the library."""
    from spanfeat.llm import piece_ids

    monkeypatch.setattr(piece_ids, "KNOWN_PIECES", 120)
    encoder = PieceEncoder(tokenizer_path(file))
    asked, plain = [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda pieces: asked.extend(pieces) or plain(pieces))
    rng = random.Random(4)
    for turn in range(40):
        texts = ["the same few words, again", "x<|endoftext|>é" * (turn % 2)]
        texts += [" ".join("".join(rng.choices("abcdeé", k=6)) for _ in range(20))]
        ids, ends = encoder.encode(*flat(pa.array(texts)))
        want = [encoder.tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(ends.tolist())] == want
        assert len(encoder.known) == len(encoder.sizes) == len(encoder.again) <= 120
    assert asked.count(next(p for p in asked if p.strip() == b"same")) < 3
