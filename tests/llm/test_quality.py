"""Quality rules against a plain Python version, and the threshold table."""
import re
from collections import Counter

from conftest_llm import by_id
from early_warning.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def check(docs):
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert by_id(quality.quality_rules(docs), *COLUMNS) == want


def test_edges(edges, wide, nothing):
    check(edges)
    check(wide)
    assert quality.quality_rules(nothing).count() == 0


def test_corpus(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_repeats(spark):
    texts = ["a b c a b c d a b c", "x " * 90, "a b a b a b", "l1 w\nl1 w\n\n\nl1 w\n  \nl2", "# $ <a> *b* | &c"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_rules_are_a_table(spark):
    docs = spark.createDataFrame([(1, "the of and " * 20), (2, "zz " * 60)], "doc_id long, text string")
    judged = quality.quality_rules(docs, base_rules=(), rules=(("stop", "stop_ratio", 0.5, None), ("long", "n_words", None, 59)))
    assert {r.doc_id: r.broken_rules for r in judged.collect()} == {1: ["long"], 2: ["stop", "long"]}


def test_no_python_in_plan(edges):
    plan = quality.quality_rules(edges)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
