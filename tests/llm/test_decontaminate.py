"""Wu-Manber search against naive search of all windows."""
import hashlib
import random
import re

from conftest_llm import by_id
from early_warning.llm import decontaminate as dc
from early_warning.llm.common import alnum_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        p = words(t)
        k = min(10, len(p))
        for i in range(len(p) - k + 1) if p else ():
            for at in range(len(w) - k + 1):
                if w[at:at + k] == p[i:i + k]:
                    hit.update(range(at, at + k))
                    if item is not None:
                        found.add(str(item))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def check(spark, docs, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((r.doc_id, *brute(r.text, items)) for r in docs.collect()), key=repr)
    assert by_id(dc.leak_digest(dc.decontaminate(docs, bench, **more)), *COLUMNS) == want


def test_words_match_the_pattern(edges):
    for r in edges.collect():
        assert [x.decode() for x in alnum_words(r.text.encode() if r.text else None)] == words(r.text)


def items(edges):
    rng = random.Random(3)
    out = [(1, None), (2, ""), (3, "!!"), (4, "the3"), (4, "one two"), (None, "one"), (100, "ONE, two!")]
    for k, r in enumerate(edges.collect()):
        w = words(r.text)
        if len(w) > 30:
            at = rng.randrange(len(w) - 25)
            out += [(10 + k, " ".join(w[at:at + 14])), (40 + k, " ".join(w[at + 3:at + 9])), (40 + k, "no such words at all")]
    return out


def test_edges(spark, edges, wide, nothing):
    mixed = items(edges)
    check(spark, edges, mixed)
    check(spark, wide, mixed, block_bytes=150)
    check(spark, edges, [])
    check(spark, nothing, mixed)


def test_random_small_alphabet(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.randrange(200))) for i in range(60)], "doc_id long, text string")
    check(spark, docs, [(i, text(rng.randrange(1, 16))) for i in range(12)])


def test_stage_keeps_clean_rows_whole(spark, wide, tmp_path):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    left = dc.drop_contaminated(wide, bench)
    assert left.columns == wide.columns and left.schema["n_chars"] == wide.schema["n_chars"]
    assert sorted(left.collect(), key=repr) == sorted((r for r in wide.collect() if r.doc_id != 11), key=repr)


def test_many_blocks_one_live_broadcast(spark, wide, monkeypatch):
    """Items of many blocks: same rows as in one block, and a block's broadcast is gone before the next is made."""
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.randrange(300)), i % 2) for i in range(40)]
                                 + [(100 + i, "a b c a b c a b c a b", 0) for i in range(60)]
                                 + [(200, None, 0), (201, "", 1)], "doc_id long, text string, block long")
    items = [(i, text(rng.randrange(1, 30))) for i in range(25)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    live, most, made = set(), [0], []
    sc = spark.sparkContext
    real = type(sc).broadcast

    def broadcast(self, value):
        got = real(self, value)
        live.add(id(got))
        made.append(got)
        most[0] = max(most[0], len(live))
        end = got.destroy
        got.destroy = lambda *a: (live.discard(id(got)), end(*a))
        return got
    monkeypatch.setattr(type(sc), "broadcast", broadcast)
    few = dc.leak_digest(dc.decontaminate(docs, bench, keep=["doc_id", "block"], block_bytes=60), ["doc_id", "block"])
    got = by_id(few, *COLUMNS)
    assert len(made) > 5 and most[0] == 1
    assert got == sorted(((r.doc_id, *brute(r.text, items)) for r in docs.collect()), key=repr)
    assert few.columns[:2] == ["doc_id", "block"]


def test_word_count_of_the_jvm(spark, edges):
    from pyspark.sql import functions as F
    for r in edges.withColumn("n", F.coalesce(F.regexp_count("text", F.lit(dc.WORD)), F.lit(0))).collect():
        assert r.n == len(words(r.text))
