"""Line dedup: lines that occur on many sites are boilerplate and leave every document.

One HyperLogLog sketch of sites per line hash, merged by aggregation on the map side,
finds how far each line spreads.  Where the estimate lies near the threshold, the sites
are counted exactly.  Only hashes are shuffled by line; the texts move once, to meet
the positions of their removed lines.

Defined results
  null text        stays null, no lines
  empty text       stays empty, one line that is never removed
  blank line       never removed
  null site        counts as one site of its own
  null, repeated ids   every row is handled by its own text; equal rows get equal results
  extra columns    are ignored; the result has the four columns of ``RESULT``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.text import SPACE, ascii_lower
from vitrina.session import stored

RESULT = ["doc_id", "n_lines", "n_removed", "text"]


def normalised(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(SPACE)))


def _lines(docs: DataFrame, row: Column) -> DataFrame:
    """(row, site, pos, key) of every line that is not blank."""
    line = normalised(F.col("line"))
    return (
        docs.select(row.alias("row"), "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(line != "")
        .select("row", "site", "pos", F.unhex(F.md5(line)).alias("key"))
    )


def boilerplate(lines: DataFrame, min_sites: int, margin: float, lg_k: int) -> DataFrame:
    """Keys of the lines that occur on ``min_sites`` sites or more.

    ``margin`` is the relative error that the sketch is trusted to stay within; it is over
    nine standard errors for the default ``lg_k``.  Estimates inside it are replaced by exact counts.
    """
    low, high = int(min_sites * (1 - margin)), min_sites * (1 + margin) + 1
    spread = lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))
    spread = stored(spread.where(F.col("sites") >= low), "spread")
    near = spread.where(F.col("sites") <= high).select("key")
    # Distinct (line, site) pairs first: a line on every page is combined before it is shuffled.
    exact = lines.join(near, "key", "left_semi").groupBy("key", "site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy("key").agg(F.count("one").alias("sites"))
    wide = spread.where(F.col("sites") > high).select("key")
    return wide.unionByName(exact.where(F.col("sites") >= min_sites).select("key"))


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    site_column: str = "source",
    min_sites: int = 5,
    margin: float = 0.15,
    lg_k: int = 12,
) -> DataFrame:
    """Documents without the lines that at least ``min_sites`` sites share."""
    site = F.coalesce(F.concat(F.lit("="), F.col(site_column).cast("string")), F.lit("")).alias("site")
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), site)
    row = F.unhex(F.md5(F.concat_ws("\x00", F.col("doc_id").cast("string"), F.col("text"))))
    # Read by the sketches, the exact counts and the removal; hashing the lines costs more than storing the hashes.
    lines = stored(_lines(docs, row), "lines")
    keys = boilerplate(lines, min_sites, margin, lg_k)
    removed = lines.join(keys, "key", "left_semi").groupBy("row").agg(F.collect_set("pos").alias("removed"))
    split = docs.select("doc_id", row.alias("row"), F.split("text", "\n").alias("lines"))
    joined = split.join(removed, "row", "left")
    n = F.coalesce(F.size("lines"), F.lit(0))
    # Set difference of positions is linear in the number of lines.
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("removed"))
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return joined.select(
        "doc_id",
        F.when(F.col("lines").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.array_join("lines", "\n")).otherwise(text).alias("text"),
    )


def oracle(min_sites: int = 5) -> str:
    """The same rows with exact counts throughout."""
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, text, coalesce('=' || source, '') AS site FROM documents),
    l AS (
      SELECT r, site, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS pos FROM d WHERE text IS NOT NULL),
    k AS (
      SELECT r, site, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM l),
    b AS (SELECT norm FROM k WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT site) >= {min_sites}),
    g AS (
      SELECT r, count(*) AS n_lines, count(b.norm) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (b.norm IS NULL), '') AS text
      FROM k LEFT JOIN b ON k.norm = b.norm GROUP BY r)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, g.text
    FROM d LEFT JOIN g USING (r)"""
