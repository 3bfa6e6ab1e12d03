import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tokenloom.operators.ordering import CHUNKS, chunk_by_key, chunk_by_order, first_rows, running_totals

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute(rows):
    seen, out = {}, {}
    for g, k, v in sorted(rows):
        n, total = seen.get(g, (0, 0))
        out[(g, k)] = (n, total)
        seen[g] = (n + 1, total + v)
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "g string, k bigint, v bigint").repartition(5)


def totals(spark, rows, width, fanout):
    df = chunk_by_key(table(spark, rows), "k", width, fanout)
    placed = running_totals(
        df, group=["g"], chunk=CHUNKS, order=["k"], totals={"n": F.lit(1), "t": F.col("v")}, bounds_of="t"
    )
    return placed.collect()


@quick
@given(
    keys=st.lists(st.tuples(st.sampled_from("aab"), st.integers(-50, 400)), min_size=1, max_size=60, unique=True),
    width=st.integers(1, 90),
    fanout=st.integers(1, 4),
)
def test_running_totals_equal_a_plain_scan(spark, keys, width, fanout):
    rows = [(g, k, (k * 7) % 5) for g, k in keys]
    want = brute(rows)
    got = totals(spark, rows, width, fanout)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.t) == want[(r.g, r.k)]
        assert r.chunk_first <= r.t and r.t + r.v <= r.chunk_past


def test_one_group_with_most_rows(spark):
    random.seed(1)
    rows = [("hot", k, random.randint(0, 9)) for k in range(3000)] + [("cold", 5, 1)]
    want = brute(rows)
    assert all((r.n, r.t) == want[(r.g, r.k)] for r in totals(spark, rows, 64, 8))


@quick
@given(
    keys=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300)), min_size=1, max_size=60, unique=True),
    limit=st.integers(0, 40),
    width=st.integers(1, 50),
)
def test_first_rows(spark, keys, limit, width):
    df = chunk_by_key(table(spark, [(g, k, 1) for g, k in keys]), "k", width, 3)
    got = sorted((r.g, r.k) for r in first_rows(df, group=["g"], chunk=CHUNKS, order=["k"], limit=limit).collect())
    want = sorted(x for g in "ab" for x in sorted(k for k in keys if k[0] == g)[:limit])
    assert got == want


KEYS = {
    "dense": lambda i: i,
    "hashed": lambda i: random.Random(i).randrange(-(1 << 62), 1 << 62),
    "clustered": lambda i: (i % 7) * 10**15 + i // 7,
    "text": lambda i: f"{random.Random(i).randrange(10**9)}é{i}",
}


@pytest.mark.parametrize("kind", KEYS)
def test_any_key_orders_in_bounded_windows(spark, kind):
    rows = [("ab"[i % 5 == 0], KEYS[kind](i), i % 11) for i in range(3000)]
    df = spark.createDataFrame(rows, f"g string, k {'string' if kind == 'text' else 'bigint'}, v bigint").repartition(5)
    chunked = chunk_by_order(df, ["k"], group=["g"], rows_per_chunk=16, fanout=8)
    placed = running_totals(chunked, group=["g"], chunk=CHUNKS, order=["k"], totals={"n": F.lit(1), "t": F.col("v")})
    assert {(r.g, r.k): (r.n, r.t) for r in placed.collect()} == brute(rows)
    chunked = chunked.cache()
    assert chunked.groupBy("g", *CHUNKS).count().agg(F.max("count")).first()[0] <= 16
    assert chunked.groupBy("g", CHUNKS[0]).agg(F.count_distinct(CHUNKS[1]).alias("n")).agg(F.max("n")).first()[0] <= 8
    assert chunked.select("g", CHUNKS[0]).distinct().count() <= 3000 / 128 + 4
    chunked.unpersist()


def test_equal_keys_share_a_chunk(spark):
    df = spark.createDataFrame([("a", k // 3, 1) for k in range(90)], "g string, k bigint, v bigint")
    chunked = chunk_by_order(df, ["k"], group=["g"], rows_per_chunk=4, fanout=2)
    assert chunked.count() == 90
    assert chunked.groupBy("k").agg(F.count_distinct("chunk").alias("n")).where("n > 1").count() == 0
    assert chunk_by_order(df.limit(0), ["k"], group=["g"]).count() == 0
    with pytest.raises(Exception, match="NULL in k"):
        chunk_by_order(df.withColumn("k", F.lit(None).cast("bigint")), ["k"], group=["g"]).count()


def test_large_keys_divide_exactly(spark):
    key = 2**62 + 1
    df = spark.createDataFrame([(key,), (key - 1,)], "k bigint")
    assert {(r.k, r.chunk) for r in chunk_by_key(df, "k", 2, 2).collect()} == {(key, key // 2), (key - 1, (key - 1) // 2)}


@pytest.mark.parametrize("row", [(None, 1, 1), ("a", None, 1)])
def test_null_keys_fail_instead_of_vanishing(spark, row):
    rows = [("a", 2, 1), row]
    with pytest.raises(Exception, match="NULL in"):
        totals(spark, rows, 4, 2)
    with pytest.raises(Exception, match="NULL in"):
        df = chunk_by_key(table(spark, rows), "k", 4, 2)
        first_rows(df, group=["g"], chunk=CHUNKS, order=["k"], limit=5).collect()
