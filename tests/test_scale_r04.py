from __future__ import annotations

import hashlib
import random
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest

from vitrina.functions.digests import smallest
from vitrina.operators import joins, orders


def test_pairs_of_an_interval_follow_each_other(spark):
    """Written pairs hold runs of an interval instead of a value per pair."""
    base = datetime(2021, 1, 1)
    sold = [(i, base + timedelta(days=i % 3, hours=1 + i % 20)) for i in range(900)]
    offers = [(i, date(2020, 12, 1), date(2021, 2, 1 + i % 20)) for i in range(70)]
    facts = spark.createDataFrame(sold, "id_orden BIGINT, fecha_orden TIMESTAMP_NTZ")
    intervals = spark.createDataFrame(offers, "id_promocion BIGINT, fecha_inicio DATE, fecha_fin DATE")
    pairs = joins.interval_join(facts, "fecha_orden", intervals, "fecha_inicio", "fecha_fin", buckets=2).collect()
    assert len({(r.id_orden, r.id_promocion) for r in pairs}) == len(pairs) == 900 * 70
    changes = sum(a.id_promocion != b.id_promocion for a, b in zip(pairs, pairs[1:]))
    assert changes * 16 < len(pairs)


@pytest.mark.parametrize("lanes", [64, 1000])
@pytest.mark.parametrize("digits", [1, 6, 40])
def test_smallest_digest_equals_hashing_every_pair(lanes, digits):
    some = random.Random(digits)
    heads = ["", *(f"{some.randrange(-(10 ** some.randint(1, digits)), 10**digits)}-" for _ in range(30))]
    tails = [str(some.randrange(10 ** some.randint(1, digits))) for _ in range(90)]
    allowed = np.array([[some.random() < 0.2 and i % 5 > 0 for _ in tails] for i in range(len(heads))])
    for pairs in (None, allowed, allowed & False):
        every = ((i, hashlib.md5((h + t).encode()).hexdigest(), j) for i, h in enumerate(heads) for j, t in enumerate(tails) if pairs is None or pairs[i, j])
        expected = {}
        for i, digest, j in every:
            expected[i] = min(expected.get(i, (digest, j)), (digest, j))
        assert smallest(pa.array(heads), pa.array(tails), pairs, np.empty((5, lanes), np.uint32)) == expected


def test_orders_draw_in_blocks_and_get_the_minimum_over_all_pairs(spark, rows):
    base = datetime(2021, 1, 1)
    sold = [(i * 37 % 20011 - 50, base + timedelta(days=i % 9, hours=i % 24)) for i in range(400)] + [(7, base), (7, base + timedelta(days=4)), (8, None), (None, base)]
    offers = [(i * 131, i % 5 or None, (base + timedelta(days=i % 11 - 5)).date(), (base + timedelta(days=i % 11 - 5 + i % 4)).date() if i % 7 else None, i % 3 > 0) for i in range(150)]
    offers += [*offers[:40], (131, 9, date(2020, 1, 1), None, True), (None, 1, date(2020, 1, 1), None, True), (5, 1, None, None, True)]
    sold = spark.createDataFrame(sold, "id_orden BIGINT, fecha_orden TIMESTAMP_NTZ")
    offers = spark.createDataFrame(offers, "id_promocion BIGINT, valor BIGINT, fecha_inicio DATE, fecha_fin DATE, activa BOOLEAN").selectExpr("*", "'Fijo' AS tipo")
    chosen = orders.chosen_promotion(sold, offers)
    known = offers.where("id_promocion IS NOT NULL")
    assert rows(chosen) == rows(orders.one_promotion_per_order(orders.active_promotions(sold.where("id_orden IS NOT NULL"), known))) + rows(chosen.where("id_orden IS NULL"))
    assert chosen.where("id_orden IS NULL").count() == 1
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "md5(" not in plan
