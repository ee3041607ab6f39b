"""Token ids of whole texts by way of their distinct pieces.

A vocabulary of the tokenizers library first cuts a text into pieces and merges inside each
piece only. The borders of all pieces of a batch are found in NumPy, Arrow's hash table
makes the pieces distinct, the library encodes each distinct piece once, and a gather lays
the ids out. The ids equal those of ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import accumulate, chain, pairwise, repeat

import numpy as np
import pyarrow as pa

# Pieces whose ids a worker remembers, and ids it remembers for them; then only pieces met again
# stay, if they are at most half.
KNOWN_PIECES, KNOWN_IDS = 250_000, 1_500_000
# Patterns of the two kinds of vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, DIGIT, SPACE, OTHER = range(4)
# Letters up to here are letters in every version of Unicode that the libraries may follow.
LAST_LATIN = "\u024f"


def _byte_signs() -> dict[int, str]:
    """Sign of every byte in byte-level vocabularies: printable ones stand for themselves, others count up from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()
SIGN_POINTS = np.array([ord(BYTE_SIGNS[b]) for b in range(256)], "<u4")


class Kinds:
    """Kind of every character under the vocabulary's own pattern, learnt when first met."""

    def __init__(self, tok):
        self.cut = tok.pre_tokenizer.pre_tokenize_str
        self.table = np.full(0x110000, -1, np.int8)
        self.ascii = np.array([self._kind(chr(c)) for c in range(128)] + [OTHER] * 128, np.int8)

    def _kind(self, c: str) -> int:
        for kind, beside in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")):
            if len(self.cut(beside + c)) == 1:
                return kind
        return SPACE

    def of(self, data: np.ndarray) -> np.ndarray:
        """Kind of every byte; the bytes of one character are alike."""
        kind = self.ascii[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            first = data[lead].astype(np.int64)
            size = 2 + (first >= 0xE0) + (first >= 0xF0)
            point = np.where(size == 2, first & 0x1F, np.where(size == 3, first & 0x0F, first & 0x07))
            for k in (1, 2, 3):
                has = size > k
                point[has] = point[has] << 6 | data[lead[has] + k] & 0x3F
            new = np.unique(point[self.table[point] < 0])
            self.table[new] = [self._kind(chr(c)) for c in new.tolist()]
            for k in range(4):
                has = size > k
                kind[lead[has] + k] = self.table[point[has]]
        return kind


def byte_borders(data: np.ndarray, offsets: np.ndarray, kinds: Kinds) -> np.ndarray:
    """Whether a piece of ``BYTE_PATTERN`` begins at each byte.

    A piece is a run of one kind; the last blank of a run of white space goes with the piece
    that follows, another last white space stands alone; an apostrophe takes a contraction.
    """
    kind = kinds.of(data)
    begins = np.empty(len(data) + 1, bool)
    begins[0] = begins[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=begins[1:-1])
    begins[offsets] = True
    edges = np.flatnonzero(begins)
    ends_text = np.zeros(len(data) + 1, bool)
    ends_text[offsets] = True
    white = edges[1:][(kind[edges[:-1]] == SPACE) & ~ends_text[edges[1:]]]  # where such a run ends
    last = white - 1
    for _ in range(3):
        last = last - ((data[last] & 0xC0) == 0x80)
    begins[last] = True
    begins[white[data[last] == 0x20]] = False
    quote = np.flatnonzero((data == 0x27) & begins[:-1])
    if len(quote):
        stop = offsets[np.searchsorted(offsets, quote, side="right")]
        padded = np.append(data, [0, 0])
        one, two = padded[quote + 1], padded[quote + 2]
        short = (quote + 1 < stop) & np.isin(one, list(b"stmd"))
        pair = one.astype(np.int64) << 8 | two
        long = (quote + 2 < stop) & np.isin(pair, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
        begins[quote[short | long] + 1] = False
        begins[quote[short] + 2] = True
        begins[quote[long] + 3] = True
    return begins[:-1]


def word_borders(data: np.ndarray, offsets: np.ndarray, kinds: Kinds) -> np.ndarray:
    """Borders that no piece of ``WORD_PATTERN`` spans.

    They stand around ASCII white space and digits, and between an ASCII letter and another
    ASCII character, but for an apostrophe before a letter.
    """
    digit = (data >= 0x30) & (data <= 0x39)
    white = (data == 0x20) | (data == 0x09) | (data == 0x0A) | (data == 0x0D)
    letter = ((data | 0x20) - np.uint8(97)) < 26
    plain = data < 0x80
    begins = digit.copy()
    begins[1:] |= digit[:-1] | (white[1:] != white[:-1])
    begins[1:] |= (letter[1:] != letter[:-1]) & plain[1:] & plain[:-1] & (data[:-1] != 0x27)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    return begins


class PieceEncoder:
    """Encoder of texts in flat form; vocabularies with other patterns encode whole texts."""

    def __init__(self, path: str):
        # one task per core already; threads inside would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        made = json.loads(self.tok.to_str())
        rule = made["pre_tokenizer"] or {}
        first = (rule.get("pretokenizers") or [{}])[0]
        self.borders = self.kinds = None
        if rule.get("type") == "ByteLevel" and rule["use_regex"] and not rule["add_prefix_space"] and not made["normalizer"]:
            self.borders, self.kinds = byte_borders, Kinds(self.tok)
        elif first.get("pattern") == {"Regex": WORD_PATTERN} and first.get("behavior") == "Removed" and first.get("invert"):
            self.borders = word_borders
        after = (rule.get("pretokenizers") or [{}])[1:]
        self.signs = len(after) == 1 and after[0].get("type") == "ByteLevel" and not after[0]["add_prefix_space"] and not after[0].get("use_regex")
        self.normalize = self.tok.normalizer.normalize_str if self.tok.normalizer else None
        # a text that may hold a special token stays one piece
        self.special = sorted({t["content"][:2].encode() for t in made["added_tokens"]})
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.again = np.empty(0, bool)  # whether a remembered piece was met again

    def _shrink(self, pieces: int) -> None:
        """Room for more pieces: those met only once go, or all of them."""
        stay = np.flatnonzero(self.again)
        size = self.sizes[stay]
        if 2 * len(stay) + pieces > KNOWN_PIECES or 2 * size.sum() > KNOWN_IDS:
            self.forget()
            return
        first = (np.cumsum(self.sizes) - self.sizes)[stay]
        self.ids = self.ids[np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())]
        place = np.cumsum(self.again) - 1
        flags, place = self.again.tolist(), place.tolist()
        self.known = {p: place[k] for p, k in self.known.items() if flags[k]}
        self.sizes, self.again = size, np.zeros(len(stay), bool)

    def _lookup(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``self.ids`` and sizes of distinct pieces."""
        if len(self.known) + len(pieces) > KNOWN_PIECES or len(self.ids) > KNOWN_IDS:
            self._shrink(len(pieces))
        place = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        absent = np.flatnonzero(place < 0)
        self.again[place[place >= 0]] = True
        if len(absent):
            new = [pieces[k] for k in absent.tolist()]
            first = len(self.known)
            place[absent] = np.arange(first, first + len(new))
            self.known.update(zip(new, range(first, first + len(new))))
            made = self._encode(new)
            self.again = np.append(self.again, np.zeros(len(new), bool))
            self.sizes = np.append(self.sizes, np.fromiter(map(len, made), np.int64, len(made)))
            flat_ids = np.fromiter(chain.from_iterable(made), np.uint32, int(self.sizes[first:].sum()))
            self.ids = np.append(self.ids, flat_ids)
        ends = np.cumsum(self.sizes)
        return ends[place] - self.sizes[place], self.sizes[place]

    def _unit(self, piece: bytes) -> str | None:
        """The piece as the vocabulary's merges see it, where it is known to be a single unit."""
        if self.borders is word_borders:
            if piece.isalpha():  # ASCII letters
                return piece.lower().decode()
            text = piece.decode()
            if self.signs and text.isalpha() and max(text) <= LAST_LATIN:
                text = self.normalize(text)
                return text.encode().decode("latin-1").translate(BYTE_SIGNS) if text.isalpha() else None
        return None

    def _byte_units(self, pieces: list[bytes]) -> list[str | None]:
        """Signs of all pieces by one look-up; none for pieces that may hold a special token."""
        joined = b"".join(pieces)
        signs = SIGN_POINTS[np.frombuffer(joined, np.uint8)].tobytes().decode("utf-32-le")
        ends = list(accumulate(map(len, pieces), initial=0))
        units = [signs[a:b] for a, b in pairwise(ends)]
        met = [s for s in self.special if s in joined]
        return [None if any(s in p for s in met) else u for p, u in zip(pieces, units)] if met else units

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece: merges alone for single units, the whole path of the library for others."""
        units = self._byte_units(pieces) if self.borders is byte_borders else [self._unit(p) for p in pieces]
        others = [p.decode() for p, u in zip(pieces, units) if u is None]
        full = iter(self.tok.encode_batch_fast(others, add_special_tokens=False))
        merge = self.tok.model.tokenize
        return [next(full).ids if u is None else [t.id for t in merge(u)] for u in units]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, and the offsets of the texts in them."""
        begins = np.zeros(len(data), bool)
        if self.borders and len(data):
            begins = self.borders(data, offsets, self.kinds)
            for start in self.special:
                at = np.flatnonzero((data[:-1] == start[0]) & (data[1:] == start[-1]))
                row = np.searchsorted(offsets, at, side="right") - 1
                for row in np.unique(row[at + 1 < offsets[row + 1]]):
                    begins[offsets[row] : offsets[row + 1]] = False
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        at = np.flatnonzero(begins)
        if not len(at):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        tiles = np.append(at, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(tiles), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        start, size = self._lookup(pieces.dictionary.to_pylist())
        code = pieces.indices.to_numpy()
        sizes = size[code]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(start[code] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(at, offsets)]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per worker and vocabulary."""
    return PieceEncoder(path)
