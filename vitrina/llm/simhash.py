"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code of 64-bit strings: nine blocks of seven bits,
each a word of the perfect Hamming code [7, 4] with covering radius one, and a last bit that
is copied.  Each string decodes to one anchor within the covering radius (at most one bit per
block).  Two fingerprints that differ in at most ``distance`` bits have a string between them
that differs from each in at most half of that.  It decodes to an anchor to which both are
replicated, when every fingerprint goes to the anchors of all strings within half of the
distance.  So each pair meets at an anchor within the covering radius plus the threshold, with 25
replicas of a fingerprint (for two bits) instead of several hundred.

The replicas are the only thing that moves.  At each anchor its fingerprints are compared through
the strings of that anchor that lie between them: those within half of the distance of the same
string are linked to the smallest one there, which gives the same components as all pairs do
and never lists the pairs of a group.  Strings of other anchors are compared there.  Anchors with
more than ``CROWD`` fingerprints are not read into one task; their strings are dealt instead.

Equal fingerprints are one node from the start.  Components are found by star contraction.

Defined results
  null, empty text  fingerprint zero, linked like any other
  null id           is component_id only where a component has no other
  repeated rows     share fingerprint and component
  empty table       empty result
  extra columns     ``near_duplicates`` ignores them; ``near_dedup`` returns them
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vitrina.llm.components import components
from vitrina.llm.text import texts
from vitrina.session import stored

SHINGLE = 3
DISTANCE = 2
SEED = 42
CROWD = 16384  # fingerprints of an anchor that one task compares
BITS = 64
BLOCK, BLOCKS = 7, 9
_PAIR = "__id_and_hash"  # a name that no input column is expected to have
CHUNK = 1 << 16  # hashes that are unpacked into bits at a time


def _shingle_hashes(words: list[bytes], begin: int, end: int, shingle: int) -> np.ndarray:
    seed = SEED
    parts = [words[begin + k : end + k] for k in range(shingle)]
    hashes = [xxh64_intdigest(b" ".join(part), seed) for part in zip(*parts, strict=True)]
    return np.array(hashes, dtype="<u8")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the shingles' hashes."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, n, CHUNK):
        hashes = _shingle_hashes(words, begin, min(begin + CHUNK, n), shingle)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = (fingerprint(text, shingle) for text in texts(batch, "text"))
            found = np.fromiter(prints, dtype=np.uint64, count=batch.num_rows)
            columns = [batch.column("id"), batch.column("hash"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "hash", "fp"])

    return run


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, hash, fp): the fingerprint as the signed long with the same bits, and a hash of the whole text."""
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.col(text_column)
    chosen = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    return chosen.mapInArrow(_fingerprints(shingle), f"id {kind}, hash long, fp long")


def _nearest() -> list[int]:
    """Nearest code word of every 7-bit string: the parity check names the wrong bit."""
    table = []
    for word in range(1 << BLOCK):
        syndrome = 0
        for bit in range(BLOCK):
            syndrome ^= (bit + 1) * (word >> bit & 1)
        table.append(word ^ (1 << syndrome - 1) if syndrome else word)
    return table


NEAREST = np.array(_nearest(), dtype=np.uint64)
LAST = np.uint64(BITS - 1)


def flips(half: int) -> np.ndarray:
    """What to add to a string to reach all strings within ``half`` bits."""
    chosen = (c for n in range(half + 1) for c in combinations(range(BITS), n))
    return np.array([sum(1 << bit for bit in c) for c in chosen], dtype=np.uint64)


def around(fps: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All strings some steps away from each fingerprint, and the anchor that each decodes to."""
    between = fps[:, None] ^ steps
    anchors = between & (np.uint64(1) << LAST)
    for i in range(BLOCKS):
        at = np.uint64(BLOCK * i)
        anchors |= NEAREST[(between >> at & np.uint64((1 << BLOCK) - 1)).astype(np.intp)] << at
    return between, anchors


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def _longs(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(column.view(np.int64)) for column in columns]


def _replicas(half: int):
    """Each fingerprint once at every anchor within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = flips(half)
        for batch in _parts(batches):
            fps = batch.column("fp").to_numpy().view(np.uint64)
            anchors = np.sort(around(fps, steps)[1], axis=1)
            first = np.ones(anchors.shape, dtype=bool)
            first[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
            pairs = anchors[first], np.repeat(fps, first.sum(axis=1))
            yield pa.RecordBatch.from_arrays(_longs(*pairs), ["anchor", "fp"])

    return run


def own_strings(anchors: np.ndarray, fps: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, fingerprint): the strings within reach of each fingerprint that belong to the anchor at hand."""
    between, of = around(fps, steps)
    here = of == anchors[:, None]
    return between[here], np.repeat(fps, here.sum(axis=1))


def meetings(anchors: np.ndarray, fps: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(u, v) links between the fingerprints of whole anchors."""
    strings, found = own_strings(anchors, fps, steps)
    order = np.lexsort((found, strings))
    strings, found = strings[order], found[order]
    first = np.flatnonzero(np.append(True, strings[1:] != strings[:-1])[: len(strings)])
    least = np.repeat(found[first], np.diff(np.append(first, len(found))))
    pairs = np.unique(np.stack([found, least])[:, found != least], axis=1)
    return pairs[0], pairs[1]


def _compare(half: int, rows: int = 4096):
    """Links within each anchor; rows come in order of their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = flips(half)
        held = np.zeros((2, 0), dtype=np.uint64)
        for batch in batches:
            columns = [batch.column(name).to_numpy().view(np.uint64) for name in ("anchor", "fp")]
            held = np.concatenate([held, np.stack(columns)], axis=1)
            # The last anchor may go on in the next batch.
            ends = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
            begin = 0
            for end in ends:
                if end - begin >= rows:
                    yield pa.RecordBatch.from_arrays(_longs(*meetings(*held[:, begin:end], steps)), ["u", "v"])
                    begin = end
            held = held[:, begin:]
        yield pa.RecordBatch.from_arrays(_longs(*meetings(*held, steps)), ["u", "v"])
        pa.default_memory_pool().release_unused()  # workers live on after their task

    return run


def _strings(half: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = flips(half)
        for batch in _parts(batches):
            anchors, fps = (batch.column(name).to_numpy().view(np.uint64) for name in ("anchor", "fp"))
            yield pa.RecordBatch.from_arrays(_longs(*own_strings(anchors, fps, steps)), ["between", "fp"])

    return run


def links(fps: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """(u, v) edges whose components are those of all pairs within ``distance`` bits; ``fps`` is distinct.

    ``distance`` is even and at most 4: a string between two fingerprints halves it.
    """
    if distance not in (0, 2, 4):
        raise ValueError("the distance must be 0, 2 or 4 bits")
    half = distance // 2
    replicas = stored(fps.select("fp").mapInArrow(_replicas(half), "anchor long, fp long"), "replicas")
    crowded = stored(replicas.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd), "crowded")
    hot = not crowded.isEmpty()
    meeting = replicas.join(crowded, "anchor", "left_anti") if hot else replicas
    meeting = meeting.repartition("anchor").sortWithinPartitions("anchor")
    edges = meeting.mapInArrow(_compare(half), "u long, v long")
    if hot:
        # As many strings lie within reach of a string as within reach of a fingerprint, which bounds the lists.
        strings = replicas.join(crowded, "anchor", "left_semi").mapInArrow(_strings(half), "between long, fp long")
        linked = strings.groupBy("between").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        dealt = linked.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v"))
        edges = edges.unionByName(dealt.where("u > v"))
    return edges


def _classes(docs: DataFrame, id_column: str, text_column: str, shingle: int, distance: int) -> DataFrame:
    """(id, hash, fp, first) with the struct of the first document of the component."""
    ids = stored(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("first")
    nodes = stored(ids.groupBy("fp").agg(first), "nodes")
    roots = stored(components(links(nodes, distance)).withColumnRenamed("node", "fp"), "roots")
    linked = nodes.join(roots, "fp")
    of_root = linked.groupBy("root").agg(F.min("first").alias("of_root"))
    moved = roots.join(of_root, "root").select("fp", "of_root")
    nodes = nodes.join(moved, "fp", "left").select("fp", F.coalesce("of_root", "first").alias("first"))
    return ids.join(nodes, "fp")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    found = _classes(docs, id_column, text_column, shingle, distance)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("first.id").alias("component_id"))


def near_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The input rows that stay, one of each component, with all their columns."""
    found = _classes(docs, id_column, text_column, shingle, distance)
    pair = F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("hash"))
    keepers = found.select(F.struct("first.id", "first.hash").alias(_PAIR)).distinct()
    kept = docs.withColumn(_PAIR, pair).join(keepers, _PAIR, "left_semi")
    return kept.dropDuplicates([_PAIR]).drop(_PAIR)
