"""Quality rules: base counts of each text, and how much of it is boilerplate of its host.

Lines are normalised and hashed; for every (host, line) the distinct documents are counted.
A line that more documents of its host hold than the limit is removed, and a document whose
remainder is too short, in words or as a share, is rejected.  The limit is the larger of a
number of documents and a share of the host's documents, so that it means the same on a small
and on a large host.  Distinct (host, line, document) triples are formed first, which spreads
a line that stands in every document over all tasks.

Defined results
  null, empty text   all counts 0, base_failed true, kept false
  null host          a host of its own
  null id            documents without an id count as one document per text
  repeated rows      count as one document and get equal results
  empty table        empty result
  extra columns      are ignored
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.text import SPACE, ascii_lower, n_words, texts
from vitrina.session import stored

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words in repeated windows
WINDOW = 3

LINE_DOCS = 10
LINE_SHARE = 0.1
LEFT_WORDS = 10
LEFT_SHARE = 0.3

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The counts of ``BASE`` for one text, in time linear in its length."""
    words = text.split()  # of bytes, splits at ASCII white space only
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8", "replace"))
    n_symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    n_dup_lines = 0
    for line in text.split(b"\n"):
        if line in seen:
            n_dup_lines += 1
        elif line and not line.isspace():
            seen.add(line)
    windows = list(zip(*[words[i:] for i in range(WINDOW)], strict=False))
    n_repeat_words, covered = 0, 0  # covered: words before this position are counted
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        for i, window in enumerate(windows):
            if times[window] > 1:
                n_repeat_words += i + WINDOW - max(i, covered)
                covered = i + WINDOW
    return len(words), word_chars, n_symbols, n_dup_lines, n_repeat_words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [pa.array(c, pa.int64()) for c in zip(*map(base_counts, texts(batch, "text")), strict=True)]
        if counts:
            kept = [batch.column(name) for name in ("id", "host", "hash")]
            yield pa.RecordBatch.from_arrays([*kept, *counts], ["id", "host", "hash", *BASE.replace(" long", "").split(", ")])


def common_lines(lines: DataFrame, hosts: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, key) of the lines above the limit; ``lines`` has one row per document and line."""
    counts = lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    over = counts.join(hosts, "host").where(F.col("n") > F.greatest(F.lit(min_docs), F.col("docs") * share))
    return over.select("host", "key")


def quality_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    line_docs: int = LINE_DOCS,
    line_share: float = LINE_SHARE,
    left_words: int = LEFT_WORDS,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """Counts and verdict per document: BASE, n_common_lines, n_left_words, base_failed, kept."""
    id_, text = F.col(id_column), F.col(text_column)
    host = F.coalesce(F.concat(F.lit("="), F.col(host_column).cast("string")), F.lit(""))
    digest = F.unhex(F.md5(F.concat_ws("\x00", id_.cast("string"), F.coalesce(text, F.lit("")))))
    chosen = docs.select(id_.alias("id"), text.alias("text"), host.alias("host"), digest.alias("hash"))
    kind = docs.schema[id_column].dataType.simpleString()
    base = chosen.mapInArrow(_count, f"id {kind}, host string, hash binary, {BASE}")

    line = ascii_lower(F.trim(F.col("line"), F.lit(SPACE)))
    lines = chosen.select("host", "hash", "id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumns({"key": F.unhex(F.md5(line)), "words": n_words(F.col("line"))}).where("words > 0")
    document = F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.hex("hash"))
    held = lines.groupBy("host", "key", document.alias("doc")).agg(F.lit(1).alias("one"))
    ids = chosen.groupBy("host", document.alias("doc")).agg(F.lit(1).alias("one"))
    hosts = ids.groupBy("host").agg(F.count("one").alias("docs"))
    common = stored(common_lines(held, hosts, line_docs, line_share), "common")
    # A set of positions: repeated rows have equal texts and must not be added up.
    gone = lines.join(common, ["host", "key"], "left_semi").groupBy("host", "hash")
    gone = gone.agg(F.collect_set(F.struct("pos", "words")).alias("gone"))
    joined = base.join(gone, ["host", "hash"], "left")
    lost = F.aggregate("gone", F.lit(0).cast("long"), lambda total, line: total + line["words"])
    left = F.col("n_words") - F.coalesce(lost, F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = (left < left_words) | (left < left_share * F.col("n_words"))
    return joined.select(
        F.col("id").alias("doc_id"),
        *BASE.replace(" long", "").split(", "),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_common_lines"),
        left.alias("n_left_words"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )


def oracle(
    line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE, left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE
) -> str:
    """The same rows: windows over numbered words, and counts over exploded lines."""
    word = "[^\\x20\\x09-\\x0D]+"
    space = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '{word}') AS words FROM documents),
    w AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
    v AS (
      SELECT r, i, {", ".join(f"lead(word, {k}) OVER o AS w{k}" for k in range(1, WINDOW))}, word AS w0
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
    t AS (
      SELECT r, i, count(*) OVER (PARTITION BY r, {", ".join(f"w{k}" for k in range(WINDOW))}) > 1 AS twice
      FROM v WHERE w{WINDOW - 1} IS NOT NULL),
    p AS (SELECT r, count(DISTINCT i + k) AS n FROM t, range({WINDOW}) s(k) WHERE twice GROUP BY r),
    l AS (
      SELECT r, doc_id, host, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
    k AS (
      SELECT *, len(regexp_extract_all(line, '{word}')) AS n,
             translate(trim(line, {space}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm,
             row_number() OVER (PARTITION BY r, line ORDER BY pos) AS nth FROM l),
    h AS (SELECT host, count(DISTINCT doc_id) AS docs FROM d GROUP BY host),
    c AS (
      SELECT k.host, norm FROM k JOIN h ON h.host = k.host WHERE n > 0 GROUP BY k.host, norm
      HAVING count(DISTINCT doc_id) > greatest({line_docs}, any_value(docs) * {line_share})),
    g AS (
      SELECT r, count(*) FILTER (nth > 1) AS dup, count(c.norm) AS n_common, sum(CASE WHEN c.norm IS NULL THEN 0 ELSE n END) AS gone
      FROM k LEFT JOIN c ON k.host = c.host AND k.norm = c.norm WHERE n > 0 GROUP BY r),
    b AS (
      SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(dup, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words,
             coalesce(n_common, 0) AS n_common_lines, CAST(len(words) - coalesce(gone, 0) AS BIGINT) AS n_left_words
      FROM d LEFT JOIN p USING (r) LEFT JOIN g USING (r))
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
           NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
             AND n_left_words >= {left_words} AND n_left_words >= {left_share} * n_words AS kept
    FROM b"""
