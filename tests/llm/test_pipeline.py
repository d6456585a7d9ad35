"""Stages and run() against the operators' brute-force versions."""
import re

import pytest

import corpus_pipeline
from early_warning.llm import stages
from test_decontaminate import brute as leaks
from test_line_dedup import WORD, brute as repeated
from test_quality import brute as quality
from test_simhash import brute_components, brute_fingerprint
from test_tokens import digests, library  # noqa: F401

NAMES = ["quality_rules", "line_dedup", "simhash_near_dedup", "decontamination", "sentencepiece"]


def test_stages_are_listed():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES


def test_run_equals_brute_force(spark, sf_dir, library):  # noqa: F811
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages.quality_stage(spark, docs, sf_dir).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert kept <= {i for i, t in rows if not quality(t)[-1]}
    rows = [r for r in rows if r[0] in kept]
    gone = repeated(rows, 50)
    left = []
    for i, t in rows:
        text = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        if not gone[i] or WORD.search(text):
            left.append((i, text))
    fps = {i: brute_fingerprint(t) for i, t in left}
    group = brute_components(set(fps.values()))
    seen, firsts = set(), []
    for i, t in left:
        if frozenset(group[fps[i]]) not in seen:
            seen.add(frozenset(group[fps[i]]))
            firsts.append((i, t))
    grams = set()
    for _, t in items:
        w = re.findall("[a-z0-9\x80-\U0010ffff]+", t.lower())
        grams |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    clean = [(i, t) for i, t in firsts if not leaks(t, items)[-1]]
    got = corpus_pipeline.run(spark, sf_dir)
    columns = ("n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted((r.doc_id, *(r[c] for c in columns)) for r in got.collect()) == [(i, *digests(library, t)) for i, t in clean]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, sf_dir, wide, nothing, name, stage):
    for docs in (wide, nothing):
        done = stage(spark, docs, sf_dir)
        if name != NAMES[-1]:
            assert done.columns == docs.columns and done.schema.simpleString() == docs.schema.simpleString()
        assert done.count() <= docs.count()


def test_line_stage(spark, sf_dir):
    a, b = ("a " * 30).strip(), ("b " * 30).strip()
    docs = spark.createDataFrame([(1, f"{a}\n{b}", 0), (2, f"{a}\n{b}\nown", 9), (3, f"{a}\n{b}\n ", 9), (4, None, 9)],
                                 "doc_id long, text string, n_chars int")
    got = sorted(tuple(r) for r in stages.line_stage(spark, docs, sf_dir).collect())
    assert got == [(1, f"{a}\n{b}", 0), (2, "own", 3), (4, None, 9)]
