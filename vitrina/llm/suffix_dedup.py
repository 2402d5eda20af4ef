"""Removal of repeated byte strings by suffix sorting in two stages.

A byte leaves if a string of ``length`` bytes that covers it also starts earlier: in a smaller
document, or further up in the same one.

1. Spreading.  Every window of ``length`` bytes is named by the smallest hash of its k-byte
   strings, so equal windows have equal names wherever they stand.  A piece is a run of windows
   of one name.  Names with one piece only hold no repeat and leave.
2. Equal pieces are combined before they move: the earliest stays for all, the windows of the
   others all start earlier somewhere.  Names with one distinct piece are settled by that.
3. Suffix sorting.  The distinct pieces of a name meet in one task, which works through its
   names in blocks.  Only the suffixes smaller than their successors are sorted by their bytes;
   the others are induced by one scan over the buckets of first bytes, from the smallest to the
   largest.  Order matters to the depth of ``length`` only.
4. Adjacent common prefixes of at least ``length`` bytes join windows into classes; all but the
   earliest window of a class mark their bytes.

A name with more than ``crowd`` distinct pieces (a phrase that stands in very many contexts) is
cut anew by longer strings, at last by whole windows, so that no name fills a task whatever the
data are.  Nothing is dropped on the way: equal windows get equal names at every level.

Defined results
  null, empty text  no bytes, nothing removed, the digest of nothing
  null id           after every other id; rows without an id count as one document
  repeated rows     rows that share an id count as one document: only an earlier start counts
  empty table       empty result
  extra columns     are ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vitrina.session import stored

LENGTH = 100
LEVELS = (24, 60, 90, 100)  # bytes of the naming strings, per cent of ``length``
CROWD = 8192
BLOCK = 1 << 20  # bytes that are suffix-sorted at a time
CHUNK = 1 << 16  # windows that are named at a time
CAP = 512  # windows of a piece, so that a monotonous text makes no long ones

_PLACE = np.uint64(17)  # bits below a name that tell where its string stands in a chunk
_draw = np.random.Generator(np.random.PCG64(11))
_BYTE = _draw.integers(0, 2**64, 256, dtype=np.uint64)
_ODD = _draw.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def string_hashes(text: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k-byte string, put together from strings of powers of two."""
    power, size, level = _BYTE[text], 1, 0
    whole, have = None, 0
    while True:
        if k & size:
            n = len(text) - have - size + 1
            whole = power[:n] if whole is None else whole[:n] * _ODD[level] + power[have : have + n]
            have += size
        if 2 * size > k:
            break
        power = power[:-size] * _ODD[level + 8] + power[size:]
        size, level = 2 * size, level + 1
    whole = (whole ^ whole >> np.uint64(32)) * _ODD[15]
    return whole ^ whole >> np.uint64(29)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def pieces(raw: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(begin, windows, name, places of its string) of the pieces of texts that lie end to end."""
    begins, ends = offsets[:-1], offsets[1:] - length + 1
    for base in range(int(offsets[0]), int(offsets[-1]) - length + 1, CHUNK):
        text = raw[base : min(base + CHUNK, int(offsets[-1]) - length + 1) + length - 1]
        hashes = string_hashes(text, k) >> _PLACE << _PLACE
        least = sliding_least(hashes | np.arange(len(hashes), dtype=np.uint64), length - k + 1)
        n = len(least)
        first, last = np.searchsorted(ends, base, "right"), np.searchsorted(begins, base + n, "left")
        step = np.zeros(n + 1, dtype=np.int32)
        low = np.clip(begins[first:last] - base, 0, n)
        high = np.clip(ends[first:last] - base, low, n)
        np.add.at(step, low, 1)
        np.add.at(step, high, -1)
        inside = np.cumsum(step[:n]) > 0
        names = least >> _PLACE
        cut = inside.copy()
        cut[1:] &= (names[1:] != names[:-1]) | ~inside[:-1]
        begin = np.flatnonzero(cut)
        if not len(begin):
            continue
        at = np.cumsum(inside)
        windows = np.diff(np.append(at[begin] - 1, at[-1]))
        moves = np.cumsum(np.append(False, least[1:] != least[:-1]))
        places = moves[begin + windows - 1] - moves[begin] + 1
        parts = -(-windows // CAP)
        if parts.max() > 1:
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            windows = np.minimum(np.repeat(windows, parts) - nth * CAP, CAP)
            places, begin = np.repeat(places, parts), np.repeat(begin, parts) + nth * CAP
        yield begin + base, windows, names[begin].view(np.int64), places


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column and the offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8), offsets


def _names(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = list(pieces(*_buffers(batch.column("text")), length, k))
            if found:
                names, inverse = np.unique(np.concatenate([f[2] for f in found]), return_inverse=True)
                places = np.bincount(inverse, np.concatenate([f[3] for f in found])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(places)], ["name", "places"])

    return run


def _pieces(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, offsets = _buffers(batch.column("text"))
            at, view = batch.column("at").to_numpy(), memoryview(raw)
            for begin, windows, names, places in pieces(raw, offsets, length, k):
                row = np.searchsorted(offsets, begin, "right") - 1
                spans = zip(begin.tolist(), (begin + windows + length - 1).tolist(), strict=True)
                digests = np.array([xxh64_intdigest(view[a:b]) for a, b in spans], dtype=np.uint64)
                taken = pa.array(row)
                columns = [
                    pa.array(names),
                    pa.array(digests.view(np.int64)),
                    batch.column("id").take(taken),
                    batch.column("hash").take(taken),
                    pa.array(begin - offsets[row] + at[row]),
                    pa.array(windows.astype(np.int32)),
                    pa.array(places.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["name", "digest", "id", "hash", "at", "windows", "places"])

    return run


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes, sorted by their first ``depth`` bytes at least; a suffix that ends comes first.

    Ties keep the order of the text where the direct sort or a run of one byte meets them.
    """
    n = len(text) + depth
    padded = np.zeros(n + depth, dtype=np.uint8)
    padded[: len(text)] = text
    t = padded[:n]
    # The next byte that differs decides between a suffix and its successor; the end is smallest.
    changes = np.flatnonzero(t[1:] != t[:-1])
    following = np.searchsorted(changes, np.arange(n), "left")
    smaller = np.zeros(n, dtype=bool)
    known = following < len(changes)
    at = changes[following[known]]
    smaller[known] = t[at + 1] > t[at]
    run_left = np.where(known, changes[np.minimum(following, len(changes) - 1)] + 1 if len(changes) else n, n) - np.arange(n)
    # Stage one: only the suffixes smaller than their successors are compared byte by byte.
    direct = np.flatnonzero(smaller)
    strings = np.ndarray((n,), f"S{depth}", padded, strides=(1,))
    direct = direct[np.argsort(strings[direct], kind="stable")]
    bounds = np.searchsorted(t[direct], np.arange(257))
    # Stage two: a scan over the buckets places each of the others next to its successor.
    long_runs = np.flatnonzero(~smaller & (run_left > depth))
    long_runs = {int(c): long_runs[t[long_runs] == c] for c in np.unique(t[long_runs])}
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(t[-1])].append(np.array([n - 1]))
    order = []
    for c in range(256):
        bucket, here = [], np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, dtype=np.int64)
        for _ in range(depth):
            if not len(here):
                break
            bucket.append(here)
            here = here[here > 0] - 1
            here = here[t[here] == c]
        if c in long_runs:
            bucket.append(long_runs[c])
        bucket.append(direct[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > c]
        before = before[np.argsort(t[before], kind="stable")]
        firsts = np.flatnonzero(np.append(True, t[before][1:] != t[before][:-1])) if len(before) else []
        for part in np.split(before, firsts[1:]) if len(before) else []:
            waiting[int(t[part[0]])].append(part)
    order = np.concatenate(order)
    return order[order < len(text)]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix shares with the one before it in ``order``; 0 for the first."""
    padded = np.zeros(len(text) + depth + 8, dtype=np.uint8)
    padded[: len(text)] = text
    words = np.ndarray((len(text) + depth,), "<u8", padded, strides=(1,))
    shared = np.zeros(len(order), dtype=np.int64)
    open_ = np.arange(1, len(order))
    for step in range(0, depth, 8):
        unlike = words[order[open_] + step] ^ words[order[open_ - 1] + step]
        same = unlike == 0
        stop = open_[~same]
        low = unlike[~same] & (~unlike[~same] + np.uint64(1))  # the lowest bit that differs
        shared[stop] = step + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        open_ = open_[same]
    shared[open_] = depth
    return np.minimum(shared, depth)


def later_windows(text: np.ndarray, valid: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Which valid windows have an equal one at a smaller place."""
    order = suffix_order(text, length)
    order = order[valid[order]]
    later = np.zeros(len(text), dtype=bool)
    if not len(order):
        return later
    classes = np.flatnonzero(common_prefixes(text, order, length) < length)
    first = np.minimum.reduceat(place[order], classes)
    later[order] = place[order] > np.repeat(first, np.diff(np.append(classes, len(order))))
    return later


def _sorted_block(rows: pa.Table, length: int) -> pa.RecordBatch:
    raw, offsets = _buffers(rows.column("text").combine_chunks())
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    ids = rows.column("id").to_pylist()
    rank = {id_: i for i, id_ in enumerate(sorted({i for i in ids if i is not None}))}
    rank[None] = len(rank)
    sizes = np.diff(offsets)
    inside = np.arange(len(raw)) - np.repeat(offsets[:-1], sizes)
    at = rows.column("at").to_numpy()
    place = np.repeat((np.array([rank[i] for i in ids], dtype=np.int64) << 40) + at, sizes) + inside
    later = later_windows(raw, inside + length <= np.repeat(sizes, sizes), place, length)
    # Runs of marked windows; no run crosses a piece, whose last windows are never valid.
    edge = np.diff(np.concatenate([[0], later.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    row = np.searchsorted(offsets, begin, "right") - 1
    taken, moved = pa.array(row), at[row] - offsets[row]
    found = [rows.column("id").take(taken), rows.column("hash").take(taken)]
    found = [column.combine_chunks() for column in found]
    return pa.RecordBatch.from_arrays(
        [*found, pa.array(begin + moved), pa.array(end + moved + length - 1)], ["id", "hash", "begin", "end"]
    )


def _suffix_sort(length: int, block: int):
    """Works through rows in order of their names, whole names at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("name").to_numpy()
            if size >= block and held[-1].column("name")[-1].as_py() != names[0]:
                yield _sorted_block(pa.Table.from_batches(held), length)
                held, size = [], 0
            sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype=np.int64)
            begin, before = 0, 0
            # A block ends where a name ends.
            for end in np.flatnonzero(np.append(names[1:] != names[:-1], False)) + 1:
                if size + sizes[end - 1] - before >= block:
                    held.append(batch.slice(begin, end - begin))
                    yield _sorted_block(pa.Table.from_batches(held), length)
                    held, size, begin, before = [], 0, int(end), int(sizes[end - 1])
            held.append(batch.slice(begin))
            size += int(sizes[-1]) - before
        if held:
            yield _sorted_block(pa.Table.from_batches(held), length)

    return run


def _cut(length: int):
    """The texts of the pieces that were chosen from each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_buffer()
                chosen = batch.column("chosen").slice(i, 1).flatten()
                names, at, windows, crowded = (chosen.field(f) for f in ("name", "at", "windows", "crowded"))
                spans = zip(at.to_pylist(), windows.to_pylist(), strict=True)
                parts = pa.array([text.slice(a, n + length - 1).to_pybytes() for a, n in spans], pa.binary())
                same = pa.array(np.full(len(parts), i))
                columns = [names, batch.column("id").take(same), batch.column("hash").take(same), at, crowded, parts]
                yield pa.RecordBatch.from_arrays(columns, ["name", "id", "hash", "at", "crowded", "text"])

    return run


def _doc() -> Column:
    return F.struct("id", "hash").alias("doc")


def _texts(docs: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """(name, id, hash, at, crowded, text) of chosen pieces, each document read once."""
    chosen = chosen.groupBy(F.struct("first.id", "first.hash").alias("doc"))
    chosen = chosen.agg(F.collect_list(F.struct("name", F.col("first.at").alias("at"), "windows", "crowded")).alias("chosen"))
    kind = docs.schema["id"].dataType.simpleString()
    joined = docs.withColumn("doc", _doc()).join(chosen.hint("merge"), "doc").select("id", "hash", F.col("text").cast("binary"), "chosen")
    return joined.mapInArrow(_cut(length), f"name long, id {kind}, hash long, at long, crowded boolean, text binary")


def repeats(docs: DataFrame, length: int = LENGTH, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """(id, hash, begin, end) spans whose bytes start earlier elsewhere; ``docs`` has id, hash, text."""
    kind = docs.schema["id"].dataType.simpleString()
    source = docs.select("id", "hash", F.lit(0).cast("long").alias("at"), "text")
    found = []
    for level in LEVELS:
        k, last = max(1, length * level // 100), level == LEVELS[-1]
        names = source.select("text").mapInArrow(_names(length, k), "name long, places long")
        names = stored(names.groupBy("name").agg(F.sum("places").alias("n")).where("n > 1").select("name"), "names")
        # Names and copies grow with the corpus: they are merged, never broadcast, at every size.
        names = names.hint("merge")
        schema = f"name long, digest long, id {kind}, hash long, at long, windows int, places int"
        parts = stored(source.mapInArrow(_pieces(length, k), schema).join(names, "name", "left_semi"), "pieces")
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at", "hash")).alias("first")
        grouped = parts.groupBy("name", "digest").agg(
            first, F.max("windows").alias("windows"), F.max("places").alias("places"), F.count(F.lit(1)).alias("copies")
        )
        firsts = stored(grouped, "firsts")
        place = F.struct(F.col("id").isNull().alias("none"), "id", "at")
        copies = firsts.where("copies > 1").select("name", "digest", F.struct("first.none", "first.id", "first.at").alias("first"))
        later = parts.join(copies.hint("merge"), ["name", "digest"]).where(place > F.col("first"))
        end = F.col("at") + F.col("windows") + (length - 1)
        found.append(later.select("id", "hash", F.col("at").alias("begin"), end.alias("end")))
        sizes = firsts.groupBy("name").agg(F.count(F.lit(1)).alias("distinct"), F.max("places").alias("most"))
        sizes = sizes.where("distinct > 1 or most > 1").select("name", "distinct")
        crowded = F.lit(False) if last else F.col("distinct") > crowd
        deeper = not last and not sizes.where(crowded).isEmpty()
        unsettled = firsts.select("name", "first", "windows").join(sizes.hint("merge"), "name")
        texts = _texts(docs, unsettled.withColumn("crowded", crowded), length)
        if deeper:
            texts = stored(texts, "texts")
            source = texts.where("crowded").select("id", "hash", "at", "text")
            texts = texts.where("not crowded")
        texts = texts.drop("crowded").repartition("name").sortWithinPartitions("name")
        found.append(stored(texts.mapInArrow(_suffix_sort(length, block), f"id {kind}, hash long, begin long, end long"), "spans"))
        if not deeper:
            break
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, spans, kept = ([], [], []), [], []
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_buffer()
            given = batch.column("given").slice(i, 1).flatten()
            begin, end = given.field("begin").to_numpy(), given.field("end").to_numpy()
            turn = np.argsort(begin, kind="stable")
            begin, end = begin[turn], np.maximum.accumulate(end[turn]) if len(turn) else end
            opens = np.append(True, begin[1:] > end[:-1])[: len(begin)]
            begin, end = begin[opens], end[np.append(opens[1:], True)[: len(opens)]]
            counts[0].append(text.size)
            counts[1].append(int((end - begin).sum()))
            counts[2].append(len(begin))
            spans.append([{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
            edges = [0, *[x for pair in zip(begin.tolist(), end.tolist(), strict=True) for x in pair], text.size]
            kept.append(b"".join(text.slice(a, b - a).to_pybytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
        columns = [batch.column("id"), *(pa.array(c, pa.int64()) for c in counts)]
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        columns += [pa.array(spans, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


def dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    crowd: int = CROWD,
    block: int = BLOCK,
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, the removed ``spans`` and the ``kept`` bytes."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    docs = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    given = repeats(docs, length, crowd, block).groupBy(_doc())
    given = given.agg(F.collect_list(F.struct("begin", "end")).alias("given"))
    joined = docs.withColumn("doc", _doc()).join(given.hint("merge"), "doc", "left")
    joined = joined.select("id", F.col("text").cast("binary"), F.coalesce("given", F.array().cast(given.schema["given"].dataType)).alias("given"))
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<begin:long,end:long>>, kept binary"
    return joined.mapInArrow(_without, schema)


def oracle(length: int = LENGTH) -> str:
    """The digests of ``dedup``: every window by its hash, joined with the smallest place of an equal one."""
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
             CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
    w AS MATERIALIZED (
      SELECT r, row(doc_id IS NULL, coalesce(doc_id, 0), i) AS place, i, md5_number(h[2 * i + 1:2 * (i + {length})]) AS k
      FROM (SELECT r, doc_id, h, unnest(range(n - {length} + 1)) AS i FROM d WHERE n >= {length})),
    f AS (SELECT k, min(place) AS first FROM w GROUP BY k),
    m AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w JOIN f USING (k) WHERE place > first),
    s AS (
      SELECT r, min(i) AS a, max(i) + {length} AS b
      FROM (SELECT r, i, count(*) FILTER (before IS NULL OR i > before + {length}) OVER (PARTITION BY r ORDER BY i) AS run FROM m)
      GROUP BY r, run),
    g AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS since FROM s),
    k AS (
      SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(h[2 * since + 1:2 * a], '' ORDER BY a) AS head
      FROM g JOIN d USING (r) GROUP BY r)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(head, '') || h[2 * coalesce(last, 0) + 1:])) AS kept_sha256
    FROM d LEFT JOIN k USING (r)"""
