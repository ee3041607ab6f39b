"""Fill-in-middle: texts are cut in three at unit borders and reordered for infilling.

All texts of an Arrow batch are one byte array. The cuts give each stretch (prefix, middle,
suffix) one displacement; its changes go into a difference array, whose cumulative sum is
the displacement of every byte, and one scatter writes the outputs. The inverse reads the
marks in the outputs, builds displacements the same way and gathers the texts back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from spanfeat.llm.flat_text import binary, flat, parts

# Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3


def draws(doc_ids: list, key: int) -> np.ndarray:
    """Four 32-bit numbers per document from the SHA-256 of ``key:doc_id`` (null: nothing after the colon)."""
    raw = b"".join(hashlib.sha256(b"%d:%s" % (key, b"" if d is None else b"%d" % d)).digest()[:16] for d in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def marks(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of all marks; one that spans two rows is none."""
    if len(values) < MARK:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letters = (values[1:-1] == PREFIX[1]) | (values[1:-1] == SUFFIX[1]) | (values[1:-1] == MIDDLE[1])
    at = np.flatnonzero(letters & (values[:-2] == PREFIX[0]) & (values[2:] == PREFIX[2]))
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + MARK <= offsets[row + 1]
    return row[inside], at[inside]


def unit_starts(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where a unit begins: a run of ASCII letters, or any other single code point."""
    letter = ((values | 0x20) - np.uint8(97)) < 26
    begins = (values & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


def displacements(starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    """Shift of every byte, where stretch k begins at ``starts[k]`` (ascending) and moves by ``shifts[k]``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(shifts, prepend=0))
    return np.cumsum(change[:size])


def _order(lengths: np.ndarray, spm: np.ndarray) -> np.ndarray:
    """Where prefix, middle and suffix begin within an output that has marks."""
    p, m, s = lengths.T
    first = np.where(spm, s, p)
    return np.stack([np.where(spm, 2 * MARK + s, MARK), 3 * MARK + p + s, np.where(spm, MARK, 2 * MARK + first)], axis=1)


def transform(values: np.ndarray, offsets: np.ndarray, drawn: np.ndarray, rate: int, spm_rate: int):
    """Outputs of all rows: (bytes, offsets, units, form, prefix code points, middle code points).

    ``form`` is 0 for plain, 1 for psm, 2 for spm.
    """
    units = unit_starts(values, offsets)
    first = np.searchsorted(units, offsets)
    n = np.diff(first)
    h1, h2, h3, h4 = drawn.T
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)], axis=1), axis=1)
    borders = np.append(units, len(values))
    c = np.where(cuts == n[:, None], offsets[1:, None], borders[np.minimum(first[:-1, None] + cuts, len(units))])
    begin, end = offsets[:-1], offsets[1:]
    plain = (begin == end) | (h3 % 100 >= rate)
    plain[marks(values, offsets)[0]] = True
    spm = ~plain & (h4 % 100 < spm_rate)
    lengths = np.stack([c[:, 0] - begin, c[:, 1] - c[:, 0], end - c[:, 1]], axis=1)
    out_offsets = np.concatenate([[0], np.cumsum(end - begin + np.where(plain, 0, 3 * MARK))])
    at = out_offsets[:-1]
    source = np.stack([begin, c[:, 0], c[:, 1]], axis=1)
    target = np.where(plain[:, None], at[:, None] + source - begin[:, None], at[:, None] + _order(lengths, spm))
    shift = displacements(source.ravel(), (target - source).ravel(), len(values))
    out = np.empty(out_offsets[-1], np.uint8)
    out[np.arange(len(values)) + shift] = values
    for k, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        for j, byte in enumerate(mark):
            out[target[~plain, k] - MARK + j] = byte
    points = np.flatnonzero((values & 0xC0) != 0x80)
    upto = np.searchsorted(points, np.stack([begin, c[:, 0], c[:, 1]], axis=1))
    return out, out_offsets, n, np.where(plain, 0, np.where(spm, 2, 1)), upto[:, 1] - upto[:, 0], upto[:, 2] - upto[:, 1]


def inverse(out: np.ndarray, out_offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of all rows from outputs and forms alone: (bytes, offsets)."""
    row, at = marks(out, out_offsets)
    moved = form[row] > 0
    row, at = row[moved], at[moved]
    which = np.flatnonzero(form > 0)
    if len(row) != 3 * len(which) or (row.reshape(-1, 3) != which[:, None]).any():
        raise ValueError("an output does not hold its three marks")
    at = at.reshape(-1, 3)
    spm = form[which] == 2
    letters = out[at + 1]
    expected = np.where(spm[:, None], list(b"SPM"), list(b"PSM"))
    if (letters != expected).any():
        raise ValueError("the marks of an output are not in the order of its form")
    size = np.diff(out_offsets)
    size[which] -= 3 * MARK
    offsets = np.concatenate([[0], np.cumsum(size)])
    # stretches of the outputs between the marks, as prefix, middle, suffix
    begin = at + MARK
    stop = np.concatenate([at[:, 1:], out_offsets[1:][which][:, None]], axis=1)
    pick = np.where(spm[:, None], [1, 2, 0], [0, 2, 1])
    begin, stop = np.take_along_axis(begin, pick, axis=1), np.take_along_axis(stop, pick, axis=1)
    source = np.repeat(out_offsets[:-1, None], 3, axis=1)
    lengths = np.zeros((len(form), 3), np.int64)
    lengths[:, 0] = size
    source[which], lengths[which] = begin, stop - begin
    target = offsets[:-1, None] + np.cumsum(lengths, axis=1) - lengths
    # a plain row is one stretch; its empty middle and suffix move no byte
    shift = displacements(target.ravel(), (source - target).ravel(), int(offsets[-1]))
    return out[np.arange(len(shift)) + shift], offsets


FORMS = np.array(["plain", "psm", "spm"])


def fill_in_middle(docs: DataFrame, rate: int = 90, spm_rate: int = 20, key: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per row of ``docs``.

    A unit is a run of ASCII letters or any other code point; cuts fall between units. Texts
    that are empty, null or hold a mark, and ``100 - rate`` of 100 others, stay plain; of the
    rest ``spm_rate`` of 100 put the suffix first. All draws depend on ``key`` and doc_id
    alone, so rows of one doc_id are cut by the same numbers. Extra columns are ignored; an
    empty table gives no rows. A text is worked on whole, whatever its length.
    """

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                ids = part.column("doc_id")
                out, ends, n, form, prefix, middle = transform(
                    *flat(part.column("text")), draws(ids.to_pylist(), key), rate, spm_rate
                )
                plain = form == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(n, pa.int64()), pa.array(FORMS[form], pa.string()),
                        pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain),
                        binary(out, ends).cast(pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(made: DataFrame) -> DataFrame:
    """``made`` with the column ``text``, rebuilt from its columns output and form alone.

    Rows without a form or an output give null. A malformed output raises an error.
    """
    if "text" in made.columns:
        raise ValueError("column text is already there")

    def run(batches):
        for batch in batches:
            for part in parts(batch, "output"):
                output, ends = flat(part.column("output"))
                named = part.column("form").fill_null("plain").to_numpy(zero_copy_only=False)
                form = np.select([named == "psm", named == "spm"], [1, 2], 0)
                text = binary(*inverse(output, ends, form)).cast(pa.binary()).cast(pa.string())
                gone = pc.or_(part.column("form").is_null(), part.column("output").is_null())
                text = pc.if_else(gone, pa.scalar(None, pa.string()), text)
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "text"])

    return made.mapInArrow(run, StructType([*made.schema.fields, StructField("text", StringType())]))


def digests(docs: DataFrame) -> DataFrame:
    """Outputs and rebuilt texts as SHA-256, beside the columns of ``fill_in_middle``."""
    back = restore(fill_in_middle(docs))
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("restored_sha256"),
    )


SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), numbered AS (
    SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
           CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM drawn
), cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbered
), pieces AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
           array_to_string(units[b + 1:n], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""
