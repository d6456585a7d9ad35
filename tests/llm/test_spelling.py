"""Spelling variants against all pairs of words."""
import random
import zlib
from collections import Counter

import pytest

from early_warning.llm import spelling as sp


def brute_counts(rows, modulus=97):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z":
                c = c.lower()
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % modulus == 0 else run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def found(words_df):
    return sorted(tuple(r) for r in sp.spelling_groups(words_df).select("word", "form", "root", "n", "n_near", "form_n").collect())


def random_words(rng, n):
    stems = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(4, 9))) for _ in range(n // 8)]
    words = {}
    for _ in range(n):
        w = list(rng.choice(stems))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], [rng.choice("abcdeéÿ")], [w[at], rng.choice("abcdeé")]]) or ["a"]
        if len(w) >= 5:
            words["".join(w)] = rng.choice([3, 4, 7, 15, 40, 200, 1000])
    return words


@pytest.mark.parametrize("block_words", [512, 3])
def test_random_words(spark, monkeypatch, block_words):
    monkeypatch.setattr(sp, "BLOCK_WORDS", block_words)
    words = random_words(random.Random(block_words), 700)
    want = brute(words)
    assert found(spark.createDataFrame(list(words.items()), "word string, n long")) == want
    assert any(r[2] != r[1] and r[1] for r in want)


def test_long_chains_and_very_long_words(spark):
    words = {"a" * 5 + "b" * i: 3 << i for i in range(45)}
    words |= {"x" * 30000: 3, "x" * 29999 + "y": 9, "x" * 30001: 2 ** 40, "y" + "x" * 29999: 3}
    assert found(spark.createDataFrame(list(words.items()), "word string, n long")) == brute(words)


def test_documents(spark, edges, wide, nothing):
    for docs in (edges, wide):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert {r.word: r.n for r in sp.word_counts(docs).collect()} == brute_counts(rows)
        assert found(sp.word_counts(docs)) == brute(brute_counts(rows))
    assert found(sp.word_counts(nothing)) == []
    rng = random.Random(2)
    vocab = ["Hello", "hellos", "hallo", "straße", "STRASSE", "naïveté", "abcde", "×÷×÷×", "tiny"]
    rows = [(rng.choice([None, *range(400)]), "-".join(rng.choice(vocab) for _ in range(30))) for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_counts(rows)
    assert {r.word: r.n for r in sp.word_counts(docs).collect()} == want and len(want) > len(vocab)


def test_near_words_of_two_blocks():
    rng = random.Random(1)
    for m in (1, 2, 5, 8):
        words = list({"".join(rng.choice("ab") for _ in range(rng.choice([m, max(1, m - 1)]))) for _ in range(60)})
        left, right = words[::2], words[1::2]
        got = set()
        for suffix in (False, True):
            pairs = list(zip(*sp.near_words([w.encode() for w in left], [w.encode() for w in right], m, suffix)))
            assert not got & set(pairs)
            got |= set(pairs)
        assert got == {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if max(len(a), len(b)) == m and one_edit(a, b)}
