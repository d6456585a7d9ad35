"""The k-d tree: the law of equal bytes, gapless slots, cuts at medians."""
import random
import zlib
from collections import defaultdict

from conftest_llm import SCHEMA
from early_warning.llm import sharding as sh


def check(df, shards=8, **more):
    rows, got = df.collect(), sh.kd_shards(df, shards, **more).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = sorted(((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == want
    slots, byte = defaultdict(list), defaultdict(int)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        byte[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max((size(r.text) for r in rows), default=0)
    share = sum(size(r.text) for r in rows) / shards
    texts, where, n = defaultdict(int), defaultdict(set), defaultdict(int)
    for r in got:
        n[r["size"], r.text_crc32] += 1
        texts[r["size"], r.text_crc32] += r["size"]
        where[r["size"], r.text_crc32].add(r.shard)
    whole = [t for t, b in texts.items() if b <= sh.WHOLE * share and n[t] <= sh.WHOLE * len(rows) / shards]
    assert all(len(where[t]) == 1 for t in whole)
    # each of three cuts is off by less than a row or a group that stays whole
    largest = max([largest, *(texts[t] for t in whole)])
    assert all(abs(byte[s] - share) <= 2 * largest for s in range(shards))
    return byte


def test_corpus(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_edges(edges, wide, nothing):
    check(edges)
    check(wide)
    assert sh.kd_shards(nothing).count() == 0


def test_equal_rows_are_dealt_evenly(spark):
    rows = [(1, "same text", "en", "hot", 9)] * 3000 + [(i, "other " * (i % 7), "en", "x", i) for i in range(500)]
    byte = check(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert max(byte.values()) - min(byte.values()) <= 60


def test_other_shard_counts(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(300), rng.choice("ab"), rng.choice("pqr"), rng.randrange(9)) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(df, 5)
    check(df, 1)
    assert sh.kd_shards(df, None, target_bytes=40_000).select("shard").distinct().count() == 4


def test_leaves_are_boxes(spark):
    """Rows of one leaf lie on one side of every cut: with distinct coordinates, ranges of the first cut do not mix."""
    rows = [(i, "x" * 10, "en", "s", 5) for i in range(800)]
    got = sh.kd_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    ranges = sorted((min(x), max(x)) for x in ([r.doc_id for r in got if r.shard == s] for s in range(8)))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_texts_of_one_prefix_are_told_apart(spark):
    """Sources that differ only at their end are a dimension of their own: the first cut separates them."""
    rows = [(1, f"t{i}", "en", f"https://example.org/{i % 2}", 5) for i in range(400)]
    got = sh.kd_shards(spark.createDataFrame(rows, SCHEMA).repartition(3), 2, dims=("source",), keep=("source",)).collect()
    assert {r.source for r in got if r.shard == 0} == {"https://example.org/0"}
    df = spark.createDataFrame(rows + [(2, "n", None, None, 5)], SCHEMA).repartition(4)
    assert sorted(map(tuple, sh.ranks(df.source, df).collect())) == [("https://example.org/0", 0.0), ("https://example.org/1", 1.0)]


def test_copies_stay_together(spark):
    rows = [(i, f"text {i // 4} " * 9, "en", f"s{i % 5}", i) for i in range(2400)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(6))


def test_no_python_in_plan(edges):
    plan = sh.kd_shards(edges)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
