"""Running values of groups that are dealt out, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dataset, scan, validate


@pytest.mark.parametrize("part", [None, "place"])
def test_values_are_carried_over_parts(spark, monkeypatch, part):
    monkeypatch.setattr(scan, "PLACES", 7)
    if part is None:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which makes one range of so few rows
    rng = random.Random(4)
    data = []
    for g, n in (("hot", 400), ("a", 1), ("b", 15), (None, 30), ("gaps", 60)):
        data += [(g, i, rng.randrange(5) if rng.random() < (0.05 if g == "gaps" else 0.7) else None) for i in rng.sample(range(2 * n), n)]
    df = spark.createDataFrame(data, "g string, i int, v int").repartition(5)
    made = scan.Scan(df, ["g"], ["i"], scan.by_place("i") if part else None)
    made.number("n").total("sum", F.coalesce("v", F.lit(0))).last_before("last", F.col("v")).row_before("before", F.col("v"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {(r.g, r.i): (r.n, r.sum, r.last, r.before and (r.before.v,)) for r in made.result().collect()}
    want = {}
    for g in {x[0] for x in data}:
        total, last, before = 0, None, None
        for n, (_, i, v) in enumerate(sorted((x for x in data if x[0] == g), key=lambda x: x[1]), 1):
            total += v or 0
            want[g, i] = (n, total, last, before)
            last, before = (last if v is None else v), (v,)
    assert got == want
    parts = made.rows.where("g = 'hot'").select("__part").distinct().count()
    assert parts > (50 if part else 2)  # the group with most of the rows is dealt out


def test_checks_and_timelines_of_a_hot_group(spark):
    rng = random.Random(5)
    rows = [("hot", i, rng.choice("aab"), rng.randrange(100) if rng.random() < 0.8 else None) for i in range(25_000)] + [("x", i, "a", i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, pos int, kind string, v int").repartition(6)
    bad, prev = set(), None
    for g, i, _, v in rows[:25_000]:
        if v is not None:
            if prev is not None and v < prev:
                bad.add((f"{g}|{i}", str(prev)))
            prev = v
    assert {(r.key, r.detail) for r in validate.check_order(df, ["g"], "pos", "v", "c").collect()} == bad
    islands = []
    for g, i, k, _ in rows:
        if islands and islands[-1][0] == g and islands[-1][1] == k:
            islands[-1][3] += 1
        else:
            islands.append([g, k, i, 1])
    folded = dataset.fold_timeline(df, ["g"], "pos", "kind", "kind")
    assert sorted((r.g, r.kind, r.first_pos, r.n) for r in folded.collect()) == sorted(map(tuple, islands))
    assert all(r.text == r.kind * r.n for r in folded.collect())
