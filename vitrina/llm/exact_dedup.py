"""Exact dedup with a heavy-hitter split.

Every text is reduced to the SHA-256 digest of its bytes after A-Z became a-z.  Misra-Gries
summaries, one per partition and merged by adding up, name the frequent digests.  A count of
those candidates verifies them and finds their winners; the winners are broadcast, so copies
of a frequent text are settled where they are read.  All other digests are shuffled as usual.

Bound of the broadcast: a candidate needs a summed lower bound above N / (k + 1).  The lower
bounds add up to N at most, so there are never more than k candidates, whatever the data are.

Defined results
  null text             counts as the empty text
  null id               loses against every other id; a group of null ids only keeps one row, keep_id null
  repeated rows         one row of a (text, id) pair stays
  empty table           empty result
  extra columns         ``classes`` ignores them, ``dedup`` returns them as they are
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.text import ascii_lower
from vitrina.session import stored

COUNTERS = 1000
# Names that no input column is expected to have.
_PAIR, _TOP = "__digest_and_id", "__top_of_digest"


def digest(text: Column) -> Column:
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def _shrink(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Merge step of Misra-Gries: lower all counters until at most k are left."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {key: n - cut for key, n in counts.items() if n > cut}


def misra_gries(k: int):
    """One summary of at most ``k`` (key, lower bound) pairs per partition."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for key, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                counts[key] = counts.get(key, 0) + n
            counts = _shrink(counts, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["key", "n"]
        )

    return summary


def frequent(keys: DataFrame, k: int) -> DataFrame:
    """Candidates for the heavy hitters of a one-column frame of binary keys.

    Every key with more than 2N / (k + 1) rows is among them; at most k keys are.
    """
    parts = keys.mapInArrow(misra_gries(k), "key binary, n long")
    summed = parts.groupBy("key").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") > keys.count() / (k + 1)).select("key")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed = docs.select(
        F.col(id_column).alias("id"),
        F.unhex(digest(F.col(text_column))).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = stored(keyed, "digests")
    heavy = stored(frequent(keyed.select("key"), k), "frequent")
    # Largest id first, then the earliest row.
    top = F.max(F.struct("id", (-F.col("row")).alias("turn"))).alias("top")
    summary = [top, F.count(F.lit(1)).alias("group_size")]
    winners = keyed.join(F.broadcast(heavy), "key", "left_semi").groupBy("key").agg(*summary)
    winners = stored(winners, "winners")
    settled = keyed.join(F.broadcast(winners), "key")
    rest = keyed.join(F.broadcast(heavy), "key", "left_anti")
    rest = rest.join(rest.groupBy("key").agg(*summary), "key")
    return settled.unionByName(rest).select(
        F.col("id").alias("doc_id"),
        F.col("top")["id"].alias("keep_id"),
        "group_size",
        (F.col("row") == -F.col("top")["turn"]).alias("kept"),
        F.lower(F.hex("key")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = COUNTERS) -> DataFrame:
    """The input rows that stay, with all their columns.

    Rows of a frequent text are removed before the shuffle unless they hold the winner's id.
    """
    columns = docs.columns
    pair = F.struct(F.unhex(digest(F.col(text_column))).alias("key"), F.col(id_column).alias("id"))
    keyed = docs.withColumn(_PAIR, pair)
    pairs = stored(keyed.select(f"{_PAIR}.key", f"{_PAIR}.id"), "digests")
    heavy = stored(frequent(pairs.select("key"), k), "frequent")
    top = F.max(F.struct("key", "id")).alias(_TOP)  # a null id is the smallest
    winners = stored(pairs.join(F.broadcast(heavy), "key", "left_semi").groupBy("key").agg(top).drop("key"), "winners")
    rest = pairs.join(F.broadcast(heavy), "key", "left_anti").groupBy("key").agg(top).drop("key")
    losing = (F.col(f"{_PAIR}.key") == F.col(f"{_TOP}.key")) & (F.col(_PAIR) != F.col(_TOP))
    keyed = keyed.join(F.broadcast(winners), losing, "left_anti")
    keepers = winners.unionByName(rest).select(F.col(_TOP).alias(_PAIR))
    # The join leaves equal pairs side by side, so repeated rows go without another shuffle.
    return keyed.join(keepers, _PAIR, "left_semi").dropDuplicates([_PAIR]).select(*columns)


ORACLE = """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)"""
