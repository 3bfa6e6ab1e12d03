"""Lookups over stored tables read what was asked for, and feeds move what they must."""

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.tokens import HashTokenizer
from tokenloom.operators import index as idx, packing
from tokenloom.operators.lookup import in_ranges, wanted_ranges
from tokenloom.plans.prepare import index_corpus
from tokenloom.sources import token_table

LEN = 16


def corpus(spark, n=600):
    rows = [(i, "ab"[i % 3 == 0], " ".join(f"w{i}_{j}" for j in range(i % 23))) for i in range(n)]
    return index_corpus(spark.createDataFrame(rows, "k bigint, dataset string, text string"), HashTokenizer(), key="k")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("tables")
    token_table.write_tokens(corpus(spark), f"{home}/plain", presorted=True)
    plain = token_table.read_tokens(spark, f"{home}/plain")
    token_table.compact_tokens(plain, f"{home}/ranges", target_bytes=800)
    return plain, token_table.read_tokens(spark, f"{home}/ranges"), str(home)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def scanned(df):
    """Rows that the scans of a finished query brought up from files, of columns that hold tokens."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name.startswith("Scan parquet") and "tokens#" in node.output().toString():
                found += node.metrics().apply("numOutputRows").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.length())]
    return found


def test_compacted_files_hold_disjoint_ranges_of_about_their_size(tables):
    plain, ranges, _ = tables
    columns = ("dataset", "seq_id", "num_tokens", "token_start", "byte_pointer", "tokens")
    assert rows(ranges, *columns) == rows(plain, *columns)
    files = ranges.groupBy("dataset", F.input_file_name().alias("f")).agg(
        F.min("seq_id").alias("lo"), F.max("seq_id").alias("hi"), F.sum("num_tokens").alias("n"), F.max("num_tokens").alias("longest")
    )
    found = sorted((r.dataset, r.lo, r.hi, r.n, r.longest) for r in files.collect())
    total = {r.dataset: r.n for r in plain.groupBy("dataset").agg(F.sum("num_tokens").alias("n")).collect()}
    assert len(found) == sum(-(-n * 4 // 800) for n in total.values())
    for (d, _, hi, n, longest), after in zip(found, found[1:] + [None]):
        assert 4 * n < 800 + 4 * longest
        assert after is None or after[0] != d or after[1] == hi + 1


def test_ranges_cover_what_is_wanted_and_stay_few(spark):
    wanted = spark.createDataFrame([("a", k, k + 3) for k in (0, 2, 900, 5000, 5001)] + [("b", 7, 7)], "d string, lo bigint, hi bigint")
    assert wanted_ranges(wanted, ["d"], "lo", "hi", limit=1000) == [("a", 0, 5), ("a", 900, 903), ("a", 5000, 5004), ("b", 7, 7)]
    assert wanted_ranges(wanted, ["d"], "lo", "hi", limit=1) == [("a", 0, 5004), ("b", 7, 7)]
    many = spark.range(0, 100_000, 7).select(F.lit("a").alias("d"), F.col("id").alias("lo"), F.col("id").alias("hi"))
    assert len(wanted_ranges(many, ["d"], "lo", "hi", limit=32)) <= 32
    assert spark.range(1).where(in_ranges([], ["d"], "id")).count() == 0


def test_sequences_read_grow_with_those_wanted(spark, tables):
    plain, ranges, _ = tables
    read = {}
    for count in (1, 60, 300):
        wanted = spark.range(count).select(F.lit("a").alias("dataset"), F.col("id").alias("seq_id"))
        found = idx.get_sequences(ranges, wanted)
        read[count] = scanned(found)
        assert rows(found, "seq_id", "tokens") == rows(plain.where(f"dataset = 'a' and seq_id < {count}"), "seq_id", "tokens")
    assert read[1] < 40 and read[1] < read[60] < 160 < read[300]


def test_blocks_read_grow_with_those_wanted(spark, tables):
    plain, ranges, _ = tables
    every = {(d, b): t for d, b, t in rows(packing.pack_blocks(plain, LEN), "dataset", "block_id", "tokens")}
    last = max(b for d, b in every if d == "b")
    read = {}
    for wanted in ([("a", 3)], [("a", 0), ("b", last), ("b", 1), ("a", 0)], list(every)):
        asked = spark.createDataFrame(wanted, "dataset string, block_id bigint")
        found = packing.get_blocks(ranges, asked, LEN)
        read[len(wanted)] = scanned(found)
        assert {(d, b): t for d, b, t in rows(found, "dataset", "block_id", "tokens")} == {w: every[w] for w in wanted}
    assert read[1] < 60 and read[4] < 200 < read[len(every)]


def test_long_sequences_and_gaps_between_offsets(spark):
    """Offsets in chunks where no sequence starts, from a sequence that starts coarse chunks earlier."""
    sizes = [3, 5000, 1, 70_000, 2]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    index = spark.createDataFrame([("d", i, s, n) for i, (s, n) in enumerate(zip(starts, sizes))], "dataset string, seq_id bigint, token_start bigint, num_tokens bigint")
    asked = [0, 2, 3, 4000, 5002, 5003, 5004, 40_000, 75_003, 75_004, 75_005, 40_000]
    offsets = spark.createDataFrame([("d", a) for a in asked], "dataset string, offset bigint")
    want = sorted((a, max(i for i, s in enumerate(starts) if s <= a)) for a in asked)
    for span in (1, 16, 4096):
        assert rows(idx.locate_tokens(index, offsets, span=span), "offset", "seq_id") == want
    for bad in (("d", 75_006), ("d", None), ("e", 0), (None, 0)):
        with pytest.raises(Exception, match="token offset out of range"):
            idx.locate_tokens(index, spark.createDataFrame([("d", 1), bad], "dataset string, offset bigint")).collect()


def test_feeds_move_pieces_once_and_tokens_never(spark, tables):
    plain, _, home = tables
    buckets = token_table.bucket_tokens(plain, "lookup_tokens", f"{home}/buckets", 4)
    columns = ("dataset", "seq_id", "tokens")
    assert rows(buckets, *columns) == rows(plain, *columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        options = dict(seed=1, workers=3, epochs=2)
        blocks = packing.pack_worker_streams(buckets, LEN, **options)
        plan = blocks._jdf.queryExecution().executedPlan().toString()
        want = rows(packing.pack_worker_streams(plain, LEN, **options), "dataset", "worker", "block_id", "tokens")
        assert rows(blocks, "dataset", "worker", "block_id", "tokens") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pieces = plan.index("Exchange hashpartitioning(dataset")
    assert "block_id" in plan[pieces : plan.index("\n", pieces)]
    # between the exchange of pieces and the bucketed scan there is no other
    scan = plan.index("Bucketed: true")
    path_down = plan[pieces + 8 : scan]
    assert "SortMergeJoin" in path_down and "Exchange" not in path_down
    spark.sql("DROP TABLE lookup_tokens")
    again = token_table.open_buckets(spark, "lookup_tokens", f"{home}/buckets", 4)
    assert rows(again, *columns) == rows(plain, *columns)
    spark.sql("DROP TABLE lookup_tokens")
