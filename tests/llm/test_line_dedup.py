"""Winnowed runs against all runs of lines."""
import random
import re

from conftest_llm import by_id
from pyspark.sql import functions as F

from early_warning.llm import line_dedup as ld

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, least):
    """doc -> lines to delete: those in a run of at least so many words that stands at an earlier place.

    Lines without words go only with a shortest such run.
    """
    seen, gone = set(), {}
    for doc, text in docs:
        lines = [(i, x, len(WORD.findall(x))) for i, x in enumerate((text or "").split("\n")) if WORD.search(x)]
        gone[doc] = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += lines[b][2]
                if n >= least:
                    run = tuple(x[1] for x in lines[a:b + 1])
                    if run in seen:
                        gone[doc].update(x[0] for x in lines[a:b + 1])
                        if n - min(lines[a][2], lines[b][2]) < least or n - max(lines[a][2], lines[b][2]) < least:
                            gone[doc].update(range(lines[a][0], lines[b][0] + 1))
                    seen.add(run)
    return gone


def check(df, least=ld.MIN_WORDS):
    """Rows with equal id and text are one document; documents are in the order of (id, hash of the text)."""
    rows = df.withColumn("th__", F.xxhash64("text")).collect()
    docs = {(r.doc_id is not None, r.doc_id or 0, r.th__): (r.doc_id, r.text) for r in rows}
    gone = brute([((i, t), t) for _, (i, t) in sorted(docs.items())], least)
    want = []
    for r in rows:
        g = gone[(r.doc_id, r.text)]
        lines = r.text.split("\n") if r.text is not None else []
        left = "\n".join(x for i, x in enumerate(lines) if i not in g) if r.text is not None else None
        want.append((r.doc_id, left, len(lines), len(g)))
    assert by_id(ld.dedup_lines(df, min_words=least), "text", "n_lines", "n_removed") == sorted(want, key=repr)


def test_edges(edges, wide, nothing):
    small = edges.where("doc_id is null or doc_id != 5")
    check(small)
    check(small, 1)
    check(wide.where("doc_id is null or doc_id != 5"))
    assert ld.dedup_lines(nothing).count() == 0


def test_long_document_twice(edges):
    twice = edges.where("doc_id = 5").unionAll(edges.where("doc_id = 5").withColumn("doc_id", F.lit(50).cast("long")))
    got = {r.doc_id: (r.n_removed, r.text) for r in ld.dedup_lines(twice).collect()}
    assert got[5][0] == 0 and got[50] == (400, "")


def test_random_lines(spark):
    rng = random.Random(6)
    lines = ["a", "b b", "c c c", "", "  ", "d d d d", "a a"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(14)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (1, 4, 9):
        check(df, least)


def test_run_is_found_beside_an_earlier_lone_line(spark):
    """The first place of a run's fingerprint line need not be the run's own first place."""
    x, y, z = ("x " * 20).strip(), ("y " * 20).strip(), ("z " * 20).strip()
    docs = [(1, x), (2, f"{x}\n{y}\n{z}"), (3, f"p\n{x}\n{y}\n{z}\nq"), (4, f"{y}\n{x}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(df).collect()}
    assert got == {1: x, 2: f"{x}\n{y}\n{z}", 3: "p\nq", 4: f"{y}\n{x}"}


def test_no_python_in_plan(edges):
    plan = ld.dedup_lines(edges)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
