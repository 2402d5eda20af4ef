"""Importance resampling towards a target text distribution, with hashed n-gram features.

Every run of 1 to ``runs`` words is a feature; its bucket is the CRC-32 of its bytes modulo
``buckets``.  The checksums come from a position table: over zero initial state CRC-32 is linear,
so a string's checksum is the XOR of what each byte contributes at its distance from the end,
and a constant of the string's length.  A batch is one buffer in which words are joined by one
space; the contributions of all bytes are looked up at once and folded with
``bitwise_xor.reduceat`` over the spans of the features.  Spans longer than the table are cut into
blocks of its length, which are folded one after the other by the matrix that moves a block on.

Bucket counts are bounded tables (one row per bucket) that add up over partitions.  The gains of
the buckets go to the second pass as one array.  The draw adds seeded Gumbel noise and takes the
highest scores; scores are whole numbers whose range grows with the logarithm of the counts, so
ranks are the number of documents at higher scores plus a number inside one score.

Defined results
  null, empty text  no words, no features, weight 0, never drawn
  null id           seeds as ``seed:``; after all other ids among equal scores
  repeated rows     are documents of their own and have equal scores; ranks differ
  empty table       empty result; an empty target or corpus has counts of zero
  extra columns     are ignored
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.llm.text import texts
from vitrina.session import stored

RUNS = 2
BUCKETS = 10_000
SCALE = 1000
SHARE = 25  # per cent of the documents that are long enough
MIN_WORDS = 20
SEED = 7

TABLE = 64  # distances from the end that the position table covers
PART = 1 << 20  # bytes of text that are folded at a time

_BREAK = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NORMAL = bytes(32 if b in set(_BREAK) and not 65 <= b <= 90 else _LOWER[b] for b in range(256))


def _position_table(size: int) -> np.ndarray:
    """[distance from the end, byte]: what a byte adds to the checksum, apart from the length's constant."""
    table = np.empty((size, 256), dtype=np.uint32)
    table[0] = [zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)]
    for distance in range(1, size):
        # One zero byte behind a contribution moves it on: fold its low byte, shift the rest.
        before = table[distance - 1]
        table[distance] = table[0][before & 0xFF] ^ before >> 8
    return table


POSITIONS = _position_table(TABLE)
LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(TABLE + 1)], dtype=np.uint32)
# A contribution, by its four bytes, moved on by a whole block: the first byte counts as the farthest.
MOVED = np.stack([POSITIONS[TABLE - 1 - i] for i in range(4)])


def _long_checksum(span: np.ndarray) -> int:
    """A span of any length: blocks of the table's length from the end, folded from the first to the last."""
    total = 0
    begin = len(span) % TABLE
    for block in [span[:begin], *span[begin:].reshape(-1, TABLE)]:
        if len(block):
            if len(block) == TABLE:
                total = int(np.bitwise_xor.reduce([MOVED[i][total >> 8 * i & 0xFF] for i in range(4)]))
            total ^= int(np.bitwise_xor.reduce(POSITIONS[np.arange(len(block) - 1, -1, -1), block]))
    return total ^ zlib.crc32(bytes(len(span)))  # the length's constant


def checksums(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans [begin, end) of a buffer; spans follow each other without overlap."""
    sizes = end - begin
    distance = np.repeat(end, np.diff(np.append(begin, len(buffer)))) - 1 - np.arange(begin[0], len(buffer))
    inside = (distance >= 0) & (distance < TABLE)
    parts = np.where(inside, POSITIONS[np.clip(distance, 0, TABLE - 1), buffer[begin[0] :]], np.uint32(0))
    found = np.bitwise_xor.reduceat(parts, begin - begin[0]) ^ LENGTHS[np.minimum(sizes, TABLE)]
    for i in np.flatnonzero(sizes > TABLE):
        found[i] = _long_checksum(buffer[begin[i] : end[i]])
    return found


def _segments(raw: bytes, runs: int) -> Iterator[tuple[bytes, int]]:
    """(words joined by one space, words that only lead on from the segment before).

    A text of more than ``PART`` bytes is cut between words; each segment begins with the last
    ``runs`` - 1 words of the one before, so that no run of words is lost.
    """
    text, begin, lead = raw.translate(_NORMAL), 0, []
    while begin < len(text):
        end = len(text)
        if end - begin > PART:
            end = text.rfind(b" ", begin, begin + PART)
            end = len(text) if end <= begin and (end := text.find(b" ", begin + PART)) < 0 else end
        words = lead + text[begin:end].split()
        if len(words) > len(lead):
            yield b" ".join(words), len(lead)
        lead, begin = words[max(0, len(words) - runs + 1) :] if runs > 1 else [], end


def _parts(batch: pa.RecordBatch, runs: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """(row, segment, leading words) in parts of about ``PART`` bytes."""
    part, size = [], 0
    for row, raw in enumerate(texts(batch, "text")):
        for words, lead in _segments(raw, runs):
            part.append((row, words, lead))
            size += len(words)
            if size >= PART:
                yield part
                part, size = [], 0
    if part:
        yield part


def features(batch: pa.RecordBatch, runs: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words of the run, row, checksum) of all features of a batch, in parts."""
    for part in _parts(batch, runs):
        buffer = np.frombuffer(b" ".join(words for _, words, _ in part), dtype=np.uint8)
        gaps = np.flatnonzero(buffer == 32)
        begin, end = np.append(0, gaps + 1), np.append(gaps, len(buffer))
        starts = np.cumsum([0] + [len(words) + 1 for _, words, _ in part[:-1]])
        segment = np.searchsorted(starts, begin, "right") - 1
        row, lead = np.array([p[0] for p in part]), np.array([p[2] for p in part])
        nth = np.arange(len(begin)) - np.searchsorted(begin, starts)[segment]
        for n in range(1, runs + 1):
            for turn in range(n):
                # Every n-th run, so that spans do not overlap.
                first = np.arange(turn, len(begin) - n + 1, n)
                last = first + n - 1
                first = first[(segment[first] == segment[last]) & (nth[last] >= lead[segment[last]])]
                if len(first):
                    yield n, row[segment[first]], checksums(buffer, begin[first], end[first + n - 1])


def _counts(runs: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, found in features(batch, runs):
                total += np.bincount((found % np.uint32(buckets)).astype(np.intp), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return run


def bucket_counts(frame: DataFrame, text_column: str, runs: int, buckets: int) -> DataFrame:
    """(bucket, n): how many features of the frame fall into each bucket; one row per bucket at most."""
    parts = frame.select(F.col(text_column).alias("text")).mapInArrow(_counts(runs, buckets), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int, scale: int = SCALE) -> DataFrame:
    """(bucket, gain) of every bucket: the floored log ratio of smoothed shares."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    corpus, target = corpus.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    both = every.join(corpus, "bucket", "left").join(target, "bucket", "left").fillna(0, ["s", "t"])
    whole = W.partitionBy()  # one row per bucket
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    all_s, all_t = (F.sum(c).over(whole).cast("double") for c in ("s", "t"))
    ratio = ((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets))
    return both.select("bucket", F.floor(scale * F.log(ratio)).cast("long").alias("gain"))


def _weights(gain: np.ndarray, runs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, count, total = np.zeros((3, batch.num_rows), dtype=np.int64)
            for n, row, found in features(batch, runs):
                times = np.bincount(row, minlength=batch.num_rows)
                count += times
                words += times if n == 1 else 0
                gained = np.bincount(row, gain[found % np.uint32(len(gain))], minlength=batch.num_rows)
                total += gained.astype(np.int64)  # sums of whole numbers far below 2 ** 53
            weight = np.floor_divide(total, np.maximum(count, 1))
            columns = [batch.column("id"), *map(pa.array, (words, count, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_features", "weight"])

    return run


def noise(id_: Column, seed: int, scale: int = SCALE) -> Column:
    """Seeded Gumbel noise of a document, floored."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    runs: int = RUNS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null where it is not drawn."""
    corpus = stored(bucket_counts(docs, text_column, runs, buckets), "buckets")
    gain = np.zeros(buckets, dtype=np.int64)
    # One number per bucket, whatever the size of the corpus.
    for row in gains(corpus, bucket_counts(target, target_column, runs, buckets), buckets).collect():
        gain[row.bucket] = row.gain
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    weighed = chosen.mapInArrow(_weights(gain, runs), f"id {kind}, n_words long, n_features long, weight long")
    score = (F.col("weight") + noise(F.col("id"), seed)).alias("score")
    scored = stored(weighed.select("id", "n_words", "n_features", "weight", score), "scores")
    fit = F.col("n_words") >= min_words
    # One row per score: a few tens of thousands, as scores are logarithms.
    counts = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        "score",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"),
        F.floor(F.sum("n").over(W.partitionBy()) * share / 100).alias("most"),
    )
    drawn = scored.where(fit).join(F.broadcast(before.where("before < most")), "score")
    inside = F.row_number().over(W.partitionBy("score").orderBy(F.col("id").asc_nulls_last()))
    drawn = drawn.withColumn("rank", F.col("before") + inside)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= F.col("most"), F.col("rank")))
    rest = scored.join(F.broadcast(before.where("before < most").select("score", F.lit(True).alias("reached"))), "score", "left")
    rest = rest.where(~F.coalesce(fit & F.col("reached"), F.lit(False)))
    columns = [F.col("id").alias("doc_id"), "n_features", "weight", "score"]
    return drawn.select(*columns, "rank").unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


def oracle(
    share: int = SHARE, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED, scale: int = SCALE
) -> str:
    """The same rows for runs of one and two words; checksums byte by byte, once per distinct feature."""
    # Fixed value: the reflected polynomial of CRC-32.
    halved = "CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH c AS (
      SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda a, k: {halved}, CAST(n AS BIGINT))) AS crc),
    a AS (
      SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents
      UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
    w AS MATERIALIZED (
      SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM a),
    f AS MATERIALIZED (
      SELECT side, r, unnest(words) AS feature FROM w
      UNION ALL
      SELECT side, r, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM w),
    d AS (SELECT feature, encode(feature) AS raw FROM (SELECT DISTINCT feature FROM f)),
    y AS (
      SELECT feature, list_transform(
               range(octet_length(raw)), lambda i: CAST('0x' || hex(raw)[2 * i + 1:2 * i + 2] AS BIGINT)) AS bytes FROM d),
    b AS MATERIALIZED (
      SELECT feature, xor(4294967295, list_reduce(
               bytes, lambda a, b: xor(a // 256, crc[xor(a, b) % 256 + 1]), CAST(4294967295 AS BIGINT))) % {buckets} AS bucket
      FROM y, c),
    n AS (
      SELECT k AS bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
      FROM range({buckets}) u(k) LEFT JOIN (SELECT side, bucket FROM f JOIN b USING (feature)) ON bucket = k GROUP BY k),
    g AS (
      SELECT bucket, CAST(floor({scale} * ln(
        ((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + {buckets}))
        / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + {buckets})))) AS BIGINT) AS gain FROM n),
    m AS (
      SELECT r, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 0 GROUP BY r),
    z AS (
      SELECT doc_id, len(words) >= {min_words} AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-{scale} * ln(-ln(
               (CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
               / 4294967296.0::DOUBLE))) AS BIGINT) AS score
      FROM w LEFT JOIN m USING (r) WHERE side = 0),
    p AS (
      SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST) AS place,
             count(*) FILTER (fit) OVER () * {share} // 100 AS most FROM z)
    SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= most THEN place END AS rank FROM p"""
