"""Removal of passages of three lines or more that occur earlier in the corpus.

Every three consecutive lines of a document are hashed; windows that occur more
than once in the whole corpus are found by one aggregation, and the lines under
every occurrence but the first go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, packed, unpacked


def drop_repeated_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3, added: str = "lines_removed"
) -> DataFrame:
    """``df`` with repeated passages taken out of its texts, and the number of removed lines.

    Lines are the pieces between line feeds, compared without ASCII white space at
    their ends. Lines without a word belong to no window and stay. A window is
    ``window`` consecutive other lines; its first occurrence is the one with the
    smallest (id, text hash, place). All lines under later occurrences are removed,
    overlapping ones once; the rest is joined by line feeds again.

    Null texts and texts with fewer lines stay as they are, with 0 removed. A null
    id sorts first. Rows equal in id and text are one document: each gets the
    same result. Other columns are passed through; one called as ``added`` is
    replaced. An empty table gives an empty table.
    """
    names = df.columns
    docs = packed(df, id=id_col, text=text_col).withColumn("mark", F.xxhash64("text"))
    parts = F.split("text", "\n", -1)
    lines = F.filter(F.transform(parts, lambda x, i: F.struct(F.btrim(x, F.lit(BLANKS)).alias("t"), i.alias("p"))), lambda x: x.t != "")
    short = docs.select("id", "mark", lines.alias("lines")).where(F.size("lines") >= window)

    def hashed(i, salt, order):
        return F.xxhash64(F.lit(salt), *(F.get(F.col("lines"), i + F.lit(k)).t for k in order))

    steps = range(window)
    starts = F.sequence(F.lit(0), F.size("lines") - window)
    windows = short.select(
        "id",
        "mark",
        F.explode(
            F.transform(
                starts,
                lambda i: F.struct(
                    hashed(i, 1, steps).alias("h1"),
                    hashed(i, 2, reversed(steps)).alias("h2"),
                    i.alias("i"),
                    F.array(*(F.get(F.col("lines"), i + F.lit(k)).p for k in steps)).alias("places"),
                ),
            )
        ).alias("w"),
    ).select("id", "mark", "w.*")
    at = F.struct("id", "mark", "i")
    first = windows.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = windows.join(first, ["h1", "h2"]).where(~at.eqNullSafe(F.col("first")))
    gone = (
        later.select("id", "mark", F.explode("places").alias("place"))
        .groupBy("id", "mark")
        .agg(F.collect_set("place").alias("gone"))
        .select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark"), "gone")
    )
    matched = docs.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    # the pieces are split once for each text, not once for each line
    kept = F.get(F.transform(F.array(parts), lambda all_parts: F.array_join(F.transform(left, lambda i: F.get(all_parts, i)), "\n")), 0)
    return unpacked(
        matched,
        names,
        {text_col: F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept)},
        {added: F.coalesce(F.size("gone"), F.lit(0)).cast("long")},
    )


#: The windows of one text column by SQL, for the query's counterpart.
ORACLE = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM split
), numbered AS (
  SELECT doc_id, p, t, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i FROM lines WHERE t <> ''
), windows AS (
  SELECT a.doc_id, a.i, a.p AS p1, b.p AS p2, c.p AS p3, a.t AS t1, b.t AS t2, c.t AS t3
  FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN numbered c ON a.doc_id = c.doc_id AND c.i = a.i + 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY t1, t2, t3 ORDER BY doc_id, i) AS k FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest([p1, p2, p3]) AS p FROM ranked WHERE k > 1
)
SELECT d.doc_id,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce((
    SELECT string_agg(s.line, chr(10) ORDER BY s.p) FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p
    WHERE s.doc_id = d.doc_id AND g.p IS NULL), '') END AS text,
  (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS lines_removed
FROM documents d
"""
