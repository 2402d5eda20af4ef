"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Targets.  Sources in code point order, null last, get the weights in turn; together they
   take as many words as all documents hold.  No target exceeds ``most`` times its source;
   the excess goes to the others by weight.  Sorted by the level at which they fill up, the
   sources show that level in one pass.
2. Quotas.  The total is cut into blocks of equal size: one word each unless told otherwise, so
   that the smallest source of the smallest corpus meets its target too.  The blocks go to the
   sources by highest quotients target / (2j - 1), and a source's blocks go to its shards in the
   same way by their sizes.  Only quotients between two proven divisors are ranked, at most a few per
   party, because Webster's divisor lies between total / (blocks + n/2) and
   total / (blocks - n/2).
3. Selection.  A shard's documents lie end to end in a seeded order.  Whole rounds are taken
   first, then the rest from a seeded block on, around the end of the shard if need be.

A source of n documents has ceil(sqrt(n)) shards, so neither a shard nor the list of a
source's shards grows faster than the square root of the source: a hot source is one of many
keys in every window.  The list of sources has one row per component of the mixture, however many
there are; Spark broadcasts it only where its own size check allows.

Defined results
  null, empty text  size 0, nothing taken
  null source       a source of its own, last in order
  repeated rows     are documents of their own; equal rows share alike up to their order
  empty table       empty result
  extra columns     ``mix`` ignores them; ``mixed`` returns them
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vitrina.llm.text import SPACE, WORD, n_words
from vitrina.session import stored

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 1
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: rank, source, docs, source_size, target."""
    by_source = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    everything = W.partitionBy()
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    ranked = by_source.withColumn("rank", number.cast("int"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    # In order of cap / weight every source before the level is full and none after it is.
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), "rank")
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sharing = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    ranked = ranked.withColumns(
        {"left": F.sum("source_size").over(everything) - full, "sharing": sharing}
    ).withColumn("open", F.col("left") * F.col("weight") <= F.col("cap") * F.col("sharing"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "rank", "left", "sharing")))
    level = first.over(everything)
    share = (level["left"] * F.col("weight")).cast("double") / level["sharing"]
    target = F.when(
        F.struct(F.col("cap") / F.col("weight"), "rank") < F.struct(level["col1"], level["rank"]),
        F.col("cap").cast("double"),
    ).otherwise(share)
    return ranked.select("rank", "source", "docs", "source_size", target.alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: str, claim: str, blocks: Column) -> DataFrame:
    """Integer ``quota`` of each party: ``blocks`` of its group, by highest quotients claim / (2j - 1).

    ``blocks`` is the same for all rows of a group.  Ties go to the smaller ``party``.
    """
    here = W.partitionBy(*group)
    parties = parties.withColumn("blocks", blocks).withColumns(
        {"all": F.sum(claim).over(here).cast("double"), "half": F.count(F.lit(1)).over(here) / 2}
    )
    seats = {
        # One seat of slack on either side covers rounding in the divisors.
        "sure": F.when(
            (F.col("blocks") > F.col("half")) & (F.col("all") > 0),
            F.greatest(F.lit(0), F.floor(F.col(claim) / F.col("all") * (F.col("blocks") - F.col("half")) + 0.5) - 1),
        ).otherwise(0),
        "most": F.when(
            F.col("all") > 0, F.floor(F.col(claim) / F.col("all") * (F.col("blocks") + F.col("half")) + 0.5) + 1
        ).otherwise(0),
    }
    parties = parties.withColumns({name: value.cast("long") for name, value in seats.items()})
    parties = parties.withColumn("open", F.col("blocks") - F.sum("sure").over(here))
    seat = F.explode(F.sequence(F.col("sure") + 1, F.col("most")))
    contested = parties.where("sure < most").select(*group, party, claim, "open", seat.alias("seat"))
    quotient = F.col(claim) / (2 * F.col("seat") - 1)
    place = F.row_number().over(here.orderBy(quotient.desc(), party, "seat"))
    won = contested.withColumn("place", place).where("place <= open").groupBy(*group, party)
    won = won.agg(F.count(F.lit(1)).alias("won"))
    quota = (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota")
    return parties.join(won, [*group, party], "left").select(*group, party, quota)


def _draw(*parts: str | Column) -> Column:
    """A seeded order: the same in every run and on every engine."""
    return F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def _number(draw: Column, below: Column) -> Column:
    return F.pmod(F.conv(F.substring(draw, 1, 8), 16, 10).cast("long"), below)


def _positions(sizes: DataFrame, weights: Sequence[int], most: int, block: int, seed: str) -> DataFrame:
    """sizes with source_size, target, and the words [a, b) of each round that the mix takes."""
    sources = stored(source_targets(sizes, weights, most), "sources")
    named = sources.withColumnRenamed("source", "name")
    placed = sizes.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    draw = _draw(seed, F.col("id"))
    count = F.ceil(F.sqrt(F.col("docs"))).cast("long")
    placed = placed.withColumn("draw", draw).withColumn("shard", _number(F.substring("draw", 9, 8), count))
    shards = stored(placed.groupBy("rank", "shard").agg(F.sum("size").alias("length")), "shards")
    total = F.sum("target").over(W.partitionBy())
    blocks = F.floor(total / block + 0.5).cast("long")
    quotas = sainte_lague(sources.select("rank", "target"), [], "rank", "target", blocks)
    shards = shards.join(quotas.withColumnRenamed("quota", "of_source"), "rank")
    taking = sainte_lague(shards, ["rank"], "shard", "length", F.col("of_source"))
    in_shard = F.greatest(F.lit(1), F.ceil(F.col("length") / block)).cast("long")
    shards = shards.join(taking, ["rank", "shard"]).select(
        "rank",
        "shard",
        "length",
        F.least(F.col("quota") * block, F.col("length") * most).alias("take"),
        (_number(_draw(seed, F.col("rank"), F.col("shard")), in_shard) * block).alias("from"),
    )
    along = W.partitionBy("rank", "shard").orderBy("draw", "id", "size")
    end = F.sum("size").over(along.rowsBetween(W.unboundedPreceding, W.currentRow))
    lined = placed.withColumn("end", end).join(shards.where("length > 0"), ["rank", "shard"], "left")
    rounds = F.floor(F.col("take") / F.col("length"))
    rest = F.col("take") - rounds * F.col("length")
    begin = F.col("end") - F.col("size")
    until = F.col("from") + rest
    wrapped = until - F.col("length")

    def inside(point: Column) -> Column:
        return F.greatest(F.lit(0), F.least(point - begin, F.col("size"))).cast("long")

    zero = F.lit(0).cast("long")
    return lined.select(
        *sizes.columns,
        "source_size",
        "target",
        F.coalesce(rounds, zero).cast("long").alias("rounds"),
        F.coalesce(inside(F.col("from")), zero).alias("a"),
        F.coalesce(inside(F.least(until, F.col("length"))), zero).alias("b"),
        F.coalesce(inside(F.greatest(wrapped, zero)), zero).alias("c"),
    )


def _span(begin: Column, n: Column) -> Column:
    return F.struct(begin.alias("begin"), n.alias("n"))


def _taken() -> Column:
    return F.col("rounds") * F.col("size") + F.col("b") - F.col("a") + F.col("c")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    sizes = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), n_words(F.col(text_column)).alias("size")
    )
    found = _positions(stored(sizes, "sizes"), weights, most, block, seed)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", _taken().alias("taken"))


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    seed: str = SEED,
) -> DataFrame:
    """The mixture itself: a row for each time a document is taken, with the words taken.

    Whole documents keep their text as it is; a part keeps the white space between its words.
    """
    docs = docs.withColumn("__size", n_words(F.col(text_column)))
    sizes = docs.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        F.col("__size").alias("size"),
        F.xxhash64(text_column).alias("__hash"),
    )
    found = _positions(stored(sizes, "sizes"), weights, most, block, seed).where(_taken() > 0)
    keys = F.struct(F.col("id"), F.col("__hash")), F.struct(F.col(id_column), F.xxhash64(text_column))
    zero = F.lit(0).cast("long")
    rounds = F.array_repeat(_span(zero, F.col("size")), F.col("rounds").cast("int"))
    parts = F.array(_span(F.col("a"), F.col("b") - F.col("a")), _span(zero, F.col("c")))
    parts = F.filter(parts, lambda span: span["n"] > 0)
    spans = found.select(keys[0].alias("__key"), F.concat(rounds, parts).alias("__spans"))
    # Repeated rows of one document are one text with all their spans.
    spans = spans.groupBy("__key").agg(F.flatten(F.collect_list("__spans")).alias("__spans"))
    texts = docs.withColumn("__key", keys[1]).dropDuplicates(["__key"])
    taken = texts.join(spans, "__key").withColumn("__span", F.explode("__spans"))
    words = F.regexp_extract_all(F.col(text_column), F.lit(f"[{SPACE}]*({WORD})"), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("__span.begin") + 1).cast("int"), F.col("__span.n").cast("int")), "")
    whole = F.col("__span.n") == F.col("__size")
    text = F.when(whole, F.col(text_column)).otherwise(F.ltrim(part, F.lit(SPACE)))
    return taken.withColumn(text_column, text).drop("__key", "__spans", "__span", "__size")


def oracle(weights: Sequence[int] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: str = SEED) -> str:
    """The same rows; here every quotient of every party is listed and ranked."""
    listed = ", ".join(map(str, weights))

    def seats(parties: str, group: str, party: str, claim: str, blocks: str) -> str:
        by = f"PARTITION BY {group}" if group else ""
        most_ = f"CAST(floor({claim} / total * ({blocks} + n / 2.0) + 0.5) AS BIGINT) + 1"
        keys = f"{group}, {party}" if group else party
        return f"""
      SELECT {keys}, count(*) AS quota FROM (
        SELECT {keys}, {blocks} AS seats, row_number() OVER (
          {by} ORDER BY {claim} / (2 * j - 1) DESC, {party}, j) AS place
        FROM (SELECT *, unnest(generate_series(1, {most_})) AS j FROM (
          SELECT *, CAST(sum({claim}) OVER ({by}) AS DOUBLE) AS total, count(*) OVER ({by}) AS n FROM {parties})
          WHERE total > 0))
      WHERE place <= seats GROUP BY {keys}"""

    return f"""
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
             md5(concat_ws(':', '{seed}', doc_id)) AS draw FROM documents),
    s AS (SELECT source, count(*) AS docs, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    r AS (
      SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rnk, {most} * source_size AS cap FROM s),
    w AS (SELECT *, [{listed}][(rnk - 1) % {len(weights)} + 1] AS weight FROM r),
    f AS (
      SELECT *, row_number() OVER o AS turn,
             sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing
      FROM w WINDOW o AS (ORDER BY cap / weight, rnk)),
    v AS (SELECT * FROM f WHERE rest * weight <= cap * sharing ORDER BY turn LIMIT 1),
    t AS (
      SELECT f.rnk, f.source, f.docs, f.source_size,
             CASE WHEN f.turn < v.turn THEN CAST(f.cap AS DOUBLE)
                  ELSE CAST(v.rest * f.weight AS DOUBLE) / v.sharing END AS target
      FROM f, v),
    b AS (SELECT *, CAST(floor(sum(target) OVER () / {block} + 0.5) AS BIGINT) AS blocks FROM t),
    q AS ({seats("b", "", "rnk", "target", "blocks")}),
    p AS (
      SELECT d.*, t.rnk, t.source_size, t.target,
             CAST('0x' || substr(draw, 9, 8) AS BIGINT) % CAST(ceil(sqrt(docs)) AS BIGINT) AS shard
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    h AS (
      SELECT p.rnk, shard, CAST(sum(size) AS BIGINT) AS length, any_value(coalesce(quota, 0)) AS of_source
      FROM p LEFT JOIN q ON p.rnk = q.rnk GROUP BY p.rnk, shard),
    g AS ({seats("h", "rnk", "shard", "length", "of_source")}),
    k AS (
      SELECT h.rnk, h.shard, length, least(coalesce(quota, 0) * {block}, length * {most}) AS take,
             CAST('0x' || substr(md5(concat_ws(':', '{seed}', h.rnk, h.shard)), 1, 8) AS BIGINT)
               % CAST(greatest(1, ceil(length / {block})) AS BIGINT) * {block} AS start
      FROM h LEFT JOIN g ON h.rnk = g.rnk AND h.shard = g.shard),
    e AS (
      SELECT *, sum(size) OVER (PARTITION BY rnk, shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop FROM p),
    z AS (
      SELECT e.*, k.*, stop - size AS begin, take // greatest(length, 1) AS rounds,
             start + take % greatest(length, 1) AS until
      FROM e JOIN k ON e.rnk = k.rnk AND e.shard = k.shard)
    SELECT doc_id, size, source_size, target,
           CAST(rounds * size + greatest(0, least(least(until, length) - begin, size))
             - greatest(0, least(start - begin, size))
             + greatest(0, least(until - length - begin, size)) AS BIGINT) AS taken
    FROM z"""
