"""The n-gram Jaccard join against all pairs of shingle sets."""
import random

import numpy as np
import pytest

from early_warning.llm import jaccard as jc


def brute_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """Multiset of (doc_id, set size, component id)."""
    sets = [brute_set(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for j in range(i):
            both = len(a & distinct[j])
            if 100 * both >= 80 * (len(a) + len(distinct[j]) - both):
                root[find(i)] = find(j)
    at = {s: find(i) for i, s in enumerate(distinct)}
    ids = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            ids[at[s]] = min(doc_id, ids.get(at[s], doc_id))
    return sorted(((d, len(s), ids.get(at[s]) if s else d) for (d, _), s in zip(rows, sets)), key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    got = sorted((tuple(r) for r in jc.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert got == want
    return want


def test_edges(edges, wide, nothing):
    check(edges)
    check(wide)
    assert jc.jaccard_components(nothing).count() == 0


def near_copies(rng, groups, size, words, edits):
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(20000)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], [f"e{rng.randrange(99)}"], [copy[at], "more"]])
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_near_copies_at_the_threshold(spark):
    rows = near_copies(random.Random(3), 12, 8, 120, 7)
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert 12 < len({c for _, _, c in want}) < 90


def test_hot_passages_and_chains(spark, monkeypatch):
    """Passages in many documents, sizes that differ, chains of copies of copies, blocks of few sets."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"q{rng.randrange(9999)}" for _ in range(rng.randrange(1, 60))])) for i in range(60)]
    chain = [f"c{i}" for i in range(150)]
    for i in range(25):
        rows.append((100 + i, " ".join(chain)))
        for _ in range(3):
            chain[rng.randrange(len(chain))] = f"n{rng.randrange(9999)}"
    monkeypatch.setattr(jc, "BLOCK_SETS", 4)
    monkeypatch.setattr(jc, "STEP_PAIRS", 10)
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert any(c == 100 for d, _, c in want if d > 110)


def test_given_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize("seed", range(3))
def test_prefixes_share_a_token_and_skips_keep_links(seed):
    """Any two sets that link meet in a prefix, and no skip rules them out there."""
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, 1 << jc.SKETCH_BITS)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 6))).astype(np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        x, y = jc.in_order(a, counts, 80, 100), jc.in_order(b, counts, 80, 100)
        shared = set(x.tolist()) & set(y.tolist())
        assert shared
        for token in shared:
            side = [({"row": np.array([k]), "n": np.array([len(s)]), "pos": np.array([p.tolist().index(token)]), "root": np.array([k]),
                      "block": np.array([0]), "near": np.array([.3 * k]), "far": np.array([.1 + .3 * k])},
                     (jc.folded(jc.signature(s)).view(np.uint64), np.array([0, jc.SIGNATURE_WORDS])), np.array([0, 1]))
                    for k, (s, p) in enumerate(((a, x), (b, y)))]
            assert sum(len(u) for u, *_ in jc.meet(*side, 80, 100)) == 1


@pytest.mark.parametrize("sizes", [(100, 90), (700, 500), (5000, 4100), (9000, 8000)])
def test_signatures_differ_in_no_more_bits_than_sets_in_tokens(sizes):
    rng = np.random.default_rng(sum(sizes))
    a = np.unique(rng.integers(0, 1 << 63, sizes[0]).astype(np.uint64))
    b = np.unique(np.concatenate([a[:sizes[1]], rng.integers(0, 1 << 63, 40).astype(np.uint64)]))
    held = [(jc.signature(s).view(np.uint64), np.array([0, len(jc.signature(s))])) for s in (a, b)]
    differ = jc.differing_bits(*held, np.array([0]), np.array([0]))[0]
    assert 0 < differ <= len(np.setxor1d(a, b)) and (differ - len(np.setxor1d(a, b))) % 2 == 0


def test_order_is_one_of_all_tokens():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, 1 << jc.SKETCH_BITS)
    x = np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    rank = {t: i for i, t in enumerate(sorted(x.tolist(), key=lambda t: (counts[t >> 64 - jc.SKETCH_BITS], t)))}
    part = jc.in_order(x, counts, 80, 100).tolist()
    assert [rank[t] for t in part] == list(range(jc.prefix_size(len(x), 80, 100)))
