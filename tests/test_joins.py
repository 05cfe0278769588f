"""Range join against brute force, with ranges of very different widths."""

import random

from gleaner.operators.joins import range_join


def test_range_join_matches_brute_force(spark):
    rnd = random.Random(7)
    ranges = [(0, 10**9, "huge")]  # one very wide range must not drag the rest
    for i in range(200):
        lo = rnd.randrange(0, 100_000)
        ranges.append((lo, lo + rnd.choice([0, 3, 50, 900, 20_000]), f"r{i}"))
    keys = [rnd.randrange(-10, 130_000) for _ in range(2000)] + [None]
    rdf = spark.createDataFrame(ranges, "lo bigint, hi bigint, name string")
    ldf = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = sorted((r["k"], r["name"]) for r in range_join(ldf, "k", rdf, "lo", "hi").collect())
    exp = sorted((k, n) for k in keys if k is not None for lo, hi, n in ranges if lo <= k <= hi)
    assert got == exp


def test_range_left_join_keeps_unmatched(spark):
    rdf = spark.createDataFrame([(10, 19, "a"), (20, 29, "b")], "lo bigint, hi bigint, name string")
    ldf = spark.createDataFrame([(5,), (15,), (25,), (25,), (None,)], "k bigint")
    got = sorted(((r["k"], r["name"]) for r in range_join(ldf, "k", rdf, "lo", "hi", how="left").collect()),
                 key=repr)
    assert got == sorted([(5, None), (15, "a"), (25, "b"), (25, "b"), (None, None)], key=repr)
