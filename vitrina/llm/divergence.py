"""How a source's words differ from its language and from the language's other sources.

Counts become whole-number shares ``p`` of a billion, so all arithmetic is exact: decimals
where a count is multiplied, longs elsewhere.

Terms.  The score of a term grows with its count in the group and falls with its count in the
language.  Whatever at least ``top`` others dominate (a count at least as high, a language count at
most as high, earlier in UTF-8) cannot be among the first ``top``.  Each partition keeps that
skyband of its terms, group by group; the skybands of a group are merged in the same way, and
only what is left gets an exact score and rank.

Pairs.  The list of all pairs of sources of a language is the result itself.  Their sums over
terms are found in blocks: the terms that occur in either of two blocks of ``side`` sources are
dealt over the tasks and folded as matrices of ``side`` rows and some thousand terms, so no pair
of rows is ever emitted per term.  Terms that occur in neither source add one constant each.

Defined results
  null, empty text  no terms; its (lang, source) group occurs all the same
  null lang, source count as ''
  null id           no matter, ids are not used
  repeated rows     are documents of their own
  empty table       empty result
  extra columns     are ignored
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.llm.text import texts
from vitrina.session import stored

MIN_DOCS = 3
TOP = 200
WHOLE = 1_000_000_000
SIDE = 64  # sources of a block
WIDTH = 2048  # terms of a block
CHUNK = 1 << 20  # bytes of text that are split into terms at a time
HELD = 400_000  # counts that a task holds before it passes them on
PRUNE = 8192  # terms of a group that a task holds before it prunes them

_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def term_chunks(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in bounded lists."""
    text, begin = raw.translate(_NORMAL), 0
    while begin < len(text):
        end = text.find(b" ", begin + CHUNK)
        end = len(text) if end < 0 else end
        yield text[begin:end].split()
        begin = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a partition, added up as far as memory allows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            names = pa.array(list(times), pa.binary()).cast(pa.string())
            found = [pa.array([lang], pa.string()), pa.array([source], pa.string())]
            found = [pa.repeat(value[0], len(names)) for value in found]
            sums = [pa.array(list(times.values()), pa.int64()), pa.array([docs[term] for term in times], pa.int64())]
            yield pa.RecordBatch.from_arrays([*found, names, *sums], ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for group, raw in zip(groups, texts(batch, "text"), strict=True):
            if group not in held:
                held[group] = Counter(), Counter()
            times, docs = held[group]
            before, seen = len(times), set()
            for chunk in term_chunks(raw):
                times.update(chunk)
                seen.update(chunk)
            docs.update(seen)
            size += len(times) - before
            if size >= HELD:
                yield from flush()
                size = 0
    yield from flush()


def undominated(n: np.ndarray, lang_n: np.ndarray, top: int) -> np.ndarray:
    """Which rows, in UTF-8 order of their terms, fewer than ``top`` others dominate."""
    # Of equal counts only the first ``top`` terms can stay.
    order = np.lexsort((np.arange(len(n)), lang_n, n))
    first = np.flatnonzero(np.append(True, (np.diff(n[order]) != 0) | (np.diff(lang_n[order]) != 0))[: len(n)])
    nth = np.arange(len(n)) - np.repeat(first, np.diff(np.append(first, len(n))))
    kept = np.sort(order[nth < top])
    n, lang_n = n[kept], lang_n[kept]
    dominated = np.zeros(len(kept), dtype=np.int64)
    for begin in range(0, len(kept), 512):
        end = min(begin + 512, len(kept))
        above = (n[None, :end] >= n[begin:end, None]) & (lang_n[None, :end] <= lang_n[begin:end, None])
        above &= np.arange(end)[None, :] < np.arange(begin, end)[:, None]
        dominated[begin:end] = above.sum(axis=1)
    return kept[dominated < top]


def _group(rows: pa.Table) -> tuple[str, str]:
    return rows.column("lang")[0].as_py(), rows.column("source")[0].as_py()


def _changes(batch: pa.RecordBatch) -> list[int]:
    """Where the group of a row is not that of the row before."""
    n = batch.num_rows
    unlike = [pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)) for c in ("lang", "source")]
    return (np.flatnonzero(pc.or_(*unlike).to_numpy(zero_copy_only=False)) + 1).tolist()


def _skyband(top: int):
    """Keeps the skyband of each group; rows come sorted by group."""

    def pruned(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("term")  # binary order is UTF-8 order
        stay = undominated(rows.column("n").to_numpy(), rows.column("lang_n").to_numpy(), top)
        return rows.take(pa.array(stay))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        limit = PRUNE
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            cuts = [0, *_changes(batch), batch.num_rows]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(begin, end - begin)
                if held is not None and _group(held) != _group(part):
                    yield from pruned(held).to_batches()
                    held, limit = None, PRUNE
                held = part if held is None else pa.concat_tables([held, part])
                if held.num_rows >= limit:
                    held = pruned(held)
                    limit = max(PRUNE, 2 * held.num_rows)
        if held is not None:
            yield from pruned(held).to_batches()

    return run


def skyband(rows: DataFrame, top: int) -> DataFrame:
    """The rows (lang, source, term, n, lang_n, ...) of each partition that can be among their group's first ``top``."""
    return rows.sortWithinPartitions("lang", "source").mapInArrow(_skyband(top), rows.schema)


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(WHOLE * (n + 1) / (total + kept)), exactly."""
    wide = [F.coalesce(c, F.lit(0)).cast("decimal(20,0)") for c in (n, total, kept)]
    # The divisor is 0 only where there are no terms at all.
    divisor = F.greatest(wide[1] + wide[2], F.lit(1).cast("decimal(21,0)"))
    return _div((wide[0] + 1).cast("decimal(21,0)") * F.lit(WHOLE).cast("decimal(10,0)"), divisor) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _score(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _pair_sums(width: int):
    """Sums of the scores of all pairs of one block of sources with another, and how many terms they cover.

    Rows come sorted by (lang, one, other, term).  A tile begins with rows without a term, which
    list the sources of both blocks and their shares without a term; the others are the share of
    a term in one source, named by its block and its place in it.
    """

    def fold(rows: pa.Table, starts: np.ndarray, tile: dict, sums: np.ndarray) -> None:
        block, at, share = (rows.column(c).to_numpy() for c in ("block", "at", "p"))
        term = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
        sides = []
        for name, listed in (("one", "ones"), ("other", "others")):
            shares = np.repeat(np.array([s["base"] for s in tile[listed]], dtype=np.int64)[:, None], len(starts), axis=1)
            mine = block == tile[name]
            shares[at[mine], term[mine]] = share[mine]
            sides.append(shares)
        for i, p in enumerate(sides[0]):
            sums[i] += ((p - sides[1]) ** 2 // sides[1]).sum(axis=1)

    def done(tile: dict, sums: np.ndarray, seen: int) -> pa.RecordBatch:
        ones, others = ([s["source"] for s in tile[listed]] for listed in ("ones", "others"))
        columns = [
            pa.array([tile["lang"]] * sums.size, pa.string()),
            pa.array([source for source in ones for _ in others], pa.string()),
            pa.array(others * len(ones), pa.string()),
            pa.array(sums.ravel()),
            pa.array(np.full(sums.size, seen)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "item", "value", "seen"])

    def units(rows: pa.Table) -> np.ndarray:
        """Where a head or the cells of a term begin."""
        n = rows.num_rows
        columns = [rows.column(c).combine_chunks() for c in ("lang", "one", "other", "term")]
        unlike = [pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False) for c in columns]
        return np.append(0, np.flatnonzero(np.logical_or.reduce(unlike)) + 1) if n else np.zeros(0, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, sums, seen, held = None, None, 0, None

        def take(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal tile, sums, seen
            is_head = rows.column("term").is_null().to_numpy()[starts]
            heads = np.flatnonzero(is_head)
            for first, last in zip(np.append(0, heads), np.append(heads, len(starts)), strict=True):
                if first == last:
                    continue
                if is_head[first]:
                    if seen:
                        yield done(tile, sums, seen)
                    (head,) = rows.slice(starts[first], 1).select(["lang", "one", "other", "lists"]).to_pylist()
                    tile = head | json.loads(head["lists"])
                    sums, seen, first = np.zeros((len(tile["ones"]), len(tile["others"])), dtype=np.int64), 0, first + 1
                for low in range(first, last, width):
                    high = min(low + width, last)
                    end = starts[high] if high < len(starts) else rows.num_rows
                    fold(rows.slice(starts[low], end - starts[low]), starts[low:high] - starts[low], tile, sums)
                    seen += high - low

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            starts = units(rows)
            if len(starts):
                # The last term may go on in the next batch.
                held = rows.slice(starts[-1])
                yield from take(rows.slice(0, starts[-1]), starts[:-1])
        if held is not None and held.num_rows:
            yield from take(held, np.zeros(1, dtype=np.int64))
        if seen:
            yield done(tile, sums, seen)

    return run


def pair_sums(cells: DataFrame, groups: DataFrame, side: int, width: int) -> DataFrame:
    """(lang, source, item, value, seen): sums over the terms of a tile, and how many those are.

    The sources of a language are cut into blocks of ``side``, so a tile has side * side sums
    whatever their number.  The terms of a tile are dealt over the tasks.
    """
    spark = cells.sparkSession
    number = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    blocks = groups.select("lang", "source", "base", number.alias("number")).select(
        "lang", "source", "base", F.floor(F.col("number") / side).cast("int").alias("block"), (F.col("number") % side).alias("at")
    )
    blocks = stored(blocks, "blocks")
    numbers = blocks.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = numbers.agg(F.sum(F.col("blocks").cast("long") * F.col("blocks"))).first()[0] or 1
    chunks = max(1, -(-4 * tasks // tiles))
    listed = blocks.groupBy("lang", "block").agg(F.sort_array(F.collect_list(F.struct("at", "source", "base"))).alias("sources"))
    one = listed.select("lang", F.col("block").alias("one"), F.col("sources").alias("ones"))
    other = listed.select("lang", F.col("block").alias("other"), F.col("sources").alias("others"))
    lists = F.to_json(F.struct("ones", "others")).alias("lists")
    heads = one.join(other, "lang").select("lang", "one", "other", lists)
    heads = heads.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    # A cell goes to the tiles of its block: one row and one column of them.
    placed = cells.join(blocks.drop("base"), ["lang", "source"]).join(numbers, "lang")
    across = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("lang", "term", "p", "block", "at", across.alias("next"))
    block, next_ = (F.coalesce(F.col(c), F.lit(0)) for c in ("block", "next"))  # never null; one type for both structs
    tile = [F.struct(a.alias("one"), b.alias("other")) for a, b in ((block, next_), (next_, block))]
    placed = placed.select("lang", "term", "p", "block", "at", F.explode(F.array_distinct(F.array(*tile))).alias("tile"))
    placed = placed.select("lang", "tile.one", "tile.other", "term", "block", "at", "p")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int"))
    rows = heads.unionByName(placed, allowMissingColumns=True)
    rows = rows.repartition(tasks, "lang", "one", "other", "chunk").sortWithinPartitions("lang", "one", "other", F.col("term").asc_nulls_first())
    # Several chunks of a tile may meet in a task; their heads are equal, one is enough.
    schema = "lang string, source string, item string, value long, seen long"
    found = rows.drop("chunk").mapInArrow(_pair_sums(width), schema)
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def audit(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    side: int = SIDE,
    width: int = WIDTH,
) -> DataFrame:
    """lang, source, part, item, value and rank: the other sources and the most telling terms of every source."""
    named = {"lang": F.coalesce(F.col(lang_column), F.lit("")), "source": F.coalesce(F.col(source_column), F.lit(""))}
    docs = docs.select(F.col(text_column).alias("text"), *(c.alias(name) for name, c in named.items()))
    counted = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = stored(counted, "counts")
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = stored(kept.where(F.col("docs") >= min_docs).drop("docs"), "kept")
    cells = stored(counted.drop("docs").join(kept, ["lang", "term"]), "cells")
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("q_total"), F.count(F.lit(1)).alias("kept"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("p_total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["p_total", "q_total", "kept"])
    groups = stored(groups.withColumn("base", _share(F.lit(0), F.col("p_total"), F.col("kept"))), "groups")

    shares = cells.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "n",
        "lang_n",
        _share(F.col("n"), F.col("p_total"), F.col("kept")).alias("p"),
        _share(F.col("lang_n"), F.col("q_total"), F.col("kept")).alias("q"),
    )
    shares = stored(shares, "shares")
    band = skyband(shares.where("p > q"), top)
    band = skyband(band.repartition("lang", "source"), top)
    telling = band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _score(F.col("p"), F.col("q")).alias("value"))

    one = groups.select("lang", "source", "kept", "base")
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other_base"))
    sums = pair_sums(shares, groups, side, width)
    pairs = one.join(other, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left")
    rest = F.col("kept") - F.coalesce("seen", F.lit(0))
    value = F.coalesce("value", F.lit(0)) + rest * _score(F.col("base"), F.col("other_base"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))

    ranking = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    telling = telling.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranking)).unionByName(telling)


def oracle(min_docs: int = MIN_DOCS, top: int = TOP) -> str:
    """The same rows: every group with every kept term of its language, in wide integers."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    wide = f"CAST({WHOLE} AS HUGEINT)"
    return f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
      FROM documents),
    w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {min_docs}),
    c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
    g AS (SELECT DISTINCT lang, source FROM d),
    f AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n,
             CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS HUGEINT) AS total,
             CAST(count(*) OVER (PARTITION BY g.lang, g.source) AS HUGEINT) AS kept,
             CAST(sum(k.lang_n) OVER (PARTITION BY g.lang, g.source) AS HUGEINT) AS lang_total
      FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    p AS MATERIALIZED (
      SELECT lang, source, term, n, 1 + {wide} * (n + 1) // (total + kept) AS p,
             1 + {wide} * (lang_n + 1) // (lang_total + kept) AS q FROM f),
    s AS (
      SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    x AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
    o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM x)
    SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= {top}"""
