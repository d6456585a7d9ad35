"""Tiled comparison and components against all pairs."""
import random

import numpy as np
import xxhash

from conftest_llm import by_id
from early_warning.llm import simhash as sh


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=3):
    """fp -> set of the fps of its component."""
    todo, out = set(fps), {}
    while todo:
        group, front = set(), [todo.pop()]
        while front:
            x = front.pop()
            group.add(x)
            near = {y for y in todo if (x ^ y).bit_count() <= radius}
            todo -= near
            front += near
        out |= dict.fromkeys(group, group)
    return out


def unsigned(x):
    return x & (1 << 64) - 1


def check(docs):
    rows = docs.collect()
    fps = {id(r): brute_fingerprint(r.text) for r in rows}
    group = brute_components(set(fps.values()))
    ids = {}
    for r in rows:
        ids.setdefault(frozenset(group[fps[id(r)]]), []).append(r.doc_id)
    want = sorted(((r.doc_id, fps[id(r)], min((i for i in ids[frozenset(group[fps[id(r)]])] if i is not None), default=None))
                   for r in rows), key=repr)
    got = sorted(((r.doc_id, unsigned(r.fp), r.component_id) for r in sh.near_duplicates(docs).collect()), key=repr)
    assert got == want
    return group


def test_edges(edges, wide, nothing):
    check(edges)
    check(wide)
    assert sh.near_duplicates(nothing).count() == 0


def test_near_copies(spark):
    rng = random.Random(8)
    rows, at = [], 0
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "edit"
            rows.append((at, " ".join(copy)))
            at += 1
    group = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert any(len(g) > 1 for g in group.values())


def test_dense_points_and_chains(spark, monkeypatch):
    """Balls of points, chains three bits apart, and tiles of a few points."""
    rng = random.Random(9)
    points = {0, (1 << 64) - 1}
    for _ in range(6):
        x = rng.getrandbits(64)
        points |= {x} | {x ^ 1 << rng.randrange(64) for _ in range(40)}
        for _ in range(30):
            for _ in range(3):
                x ^= 1 << rng.randrange(64)
            points.add(x)
    monkeypatch.setattr(sh, "TILE_POINTS", 4)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long")
    root = {unsigned(r.fp): unsigned(r.root) for r in sh.groups(df).collect()}
    want = brute_components(points)
    assert root.keys() == points
    assert all((root[a] == root[b]) == (b in want[a]) for a in points for b in points)


def test_skipped_tiles_hold_no_links():
    rng = random.Random(1)
    steps = set(sh._steps(3))
    count = lambda x: tuple((x >> 16 * i & 0xFFFF).bit_count() for i in range(4))
    for _ in range(2000):
        x = y = rng.getrandbits(64)
        for _ in range(3):
            y ^= 1 << rng.randrange(64)
        d = tuple(b - a for a, b in zip(count(x), count(y)))
        assert d in steps or tuple(-v for v in d) in steps


def test_forest_spans_all_links():
    rng = np.random.default_rng(3)
    left = rng.integers(0, 1 << 8, 60, dtype=np.int64)
    out = sh.forest(left, left, True, 1)
    assert len(out) <= len(set(left.tolist()))
    assert all((a ^ b).bit_count() <= 1 for a, b in out)


def test_one_row_of_each_group(spark, wide):
    left = sh.first_of_groups(wide)
    assert left.columns == wide.columns
    rows = wide.collect()
    group = brute_components({brute_fingerprint(r.text) for r in rows})
    of = lambda r: frozenset(group[brute_fingerprint(r.text)])
    kept = left.collect()
    assert len(kept) == len({of(r) for r in rows}) == len({of(r) for r in kept})
    for r in kept:
        assert r in rows
        ids = [x.doc_id for x in rows if of(x) == of(r) and x.doc_id is not None]
        assert r.doc_id == min(ids, default=None)


def test_one_of_equal_rows_stays(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, None), (2, None)], "doc_id long, text string")
    assert by_id(sh.first_of_groups(docs), "text") == [(1, "a b c d"), (2, None)]
