"""Line removal by overlapping three-line windows, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import row_key, shielded
from spanfeat.session import staged


def line_dedup(docs: DataFrame, width: int = 3) -> DataFrame:
    """Remove the lines of each window of ``width`` lines that an earlier place also holds.

    Lines are the pieces between line feeds. Places are ordered by (doc_id, line number);
    the first place of a window stays, later ones go, and overlapping windows merge into one
    set of covered lines. Windows of blank lines only are ignored. Returns all columns of
    ``docs`` with ``text`` replaced (null stays null; ``n_chars``, where present, follows)
    plus ``lines_removed`` (long). Texts with fewer lines stay whole. Rows equal in doc_id
    and text share one place, so none of them is the later copy of another; between rows of
    one doc_id the text's hash decides. Other columns stay, whatever their names; one named
    ``lines_removed`` is replaced. An empty table gives no rows.
    """
    return shielded(docs, ["doc_id", "text", "n_chars"], ["lines_removed"], lambda d: _line_dedup(d, width))


def _line_dedup(docs: DataFrame, width: int) -> DataFrame:
    base = docs.withColumn("_ld_key", row_key("doc_id", "text"))
    cuts = base.select("doc_id", "_ld_key", F.split("text", "\n", -1).alias("lines")).filter(F.size("lines") >= width)
    window = lambda i: F.array_join(F.slice("lines", i, width), "\n")
    marks = F.transform(
        F.sequence(F.lit(1), F.size("lines") - (width - 1)),
        lambda i: F.when(
            F.trim(window(i)) == "\n" * (width - 1), F.lit(None)
        ).otherwise(F.struct(F.xxhash64(window(i)).alias("w"), F.crc32(window(i)).alias("c"))),
    )
    seen = cuts.select("doc_id", "_ld_key", F.posexplode(marks).alias("pos", "mark")).filter("mark IS NOT NULL")
    seen = seen.select("doc_id", "_ld_key", "pos", "mark.w", "mark.c")
    place = F.struct(F.col("doc_id"), F.col("_ld_key"), F.col("pos"))
    first = seen.groupBy("w", "c").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = staged(first.filter("first <> last").select("w", "c", "first"), "windows")
    later = seen.join(first, ["w", "c"]).filter(place != F.col("first"))
    gone = later.groupBy("_ld_key").agg(F.collect_set("pos").alias("_ld_at"))
    joined = base.join(gone, "_ld_key", "left")
    covered = F.array_distinct(
        F.flatten(F.transform("_ld_at", lambda p: F.sequence(p, p + (width - 1))))
    )
    kept = F.array_join(
        F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(F.col("_ld_gone"), i)), "\n"
    )
    out = joined.withColumn("_ld_gone", covered).withColumn(
        "text", F.when(F.col("_ld_at").isNull(), F.col("text")).otherwise(kept)
    )
    out = out.withColumn("lines_removed", F.coalesce(F.size("_ld_gone"), F.lit(0)).cast("long"))
    out = out.withColumn("lines_removed", F.when(F.col("_ld_at").isNull(), F.lit(0).cast("long")).otherwise(F.col("lines_removed")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("_ld_at").isNull(), F.col("n_chars")).otherwise(size))
    return out.select(*docs.columns, "lines_removed")


SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l WHERE len(lines) >= 3),
x AS (SELECT doc_id, i, lines[i] || chr(10) || lines[i+1] || chr(10) || lines[i+2] AS win FROM w),
x2 AS (SELECT * FROM x WHERE trim(win, ' ') <> chr(10) || chr(10)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM x2),
g AS (SELECT DISTINCT doc_id, i + o AS line FROM f, (VALUES (0), (1), (2)) v(o) WHERE k > 1),
e AS (SELECT doc_id, unnest(lines) AS line_text, unnest(range(1, len(lines) + 1)) AS line FROM l),
k AS (SELECT e.doc_id, string_agg(line_text, chr(10) ORDER BY e.line) AS text
      FROM e LEFT JOIN g ON e.doc_id = g.doc_id AND e.line = g.line WHERE g.line IS NULL GROUP BY e.doc_id),
r AS (SELECT doc_id, count(*) AS lines_removed FROM g GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       d.lang, d.source,
       CASE WHEN r.doc_id IS NULL THEN d.n_chars ELSE length(coalesce(k.text, '')) END AS n_chars,
       coalesce(r.lines_removed, 0) AS lines_removed
FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN r USING (doc_id)
"""
