"""Pigeonhole seeds and bounded-error matching against edit distances of all word ranges."""
import random
import re

from conftest_llm import by_id
from early_warning.llm import licenses as li


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def versioned_distance(part, phrase):
    """Edit distance in which the words of digits of the phrase stand as they are and no digit is put in."""
    fixed = set()
    for m in re.finditer(r"(?<![^ ])\d+(?: \d+)*(?![^ ])", phrase):
        fixed |= set(range(*m.span()))
    if not fixed:
        return distance(part, phrase)
    far = 10 ** 6
    # an insertion before phrase[i] is no part of a version if phrase[i - 1] is not, or if phrase[i] is not
    inner = lambda i: i - 1 in fixed and (i in fixed or i == len(phrase))
    row = [0]
    for c in part:
        row.append(row[-1] + 1 if not c.isdigit() and not inner(0) else far)
    for i, p in enumerate(phrase, 1):
        new = [row[0] + 1 if i - 1 not in fixed else far]
        for j, c in enumerate(part, 1):
            ways = [row[j - 1] + (0 if c == p else 1 if i - 1 not in fixed and not c.isdigit() else far)]
            if i - 1 not in fixed:
                ways.append(row[j] + 1)
            if not c.isdigit() and not inner(i):
                ways.append(new[j - 1] + 1)
            new.append(min(ways))
        row = new
    return row[-1]


def brute(line):
    """phrase -> least edits over all word ranges, for every notice that is near enough."""
    words, best = line.split(), {}
    for _, phrase in li.BASE_NOTICES + li.NOTICES:
        k, size = li.max_edits(phrase), len(phrase)
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                part = " ".join(words[i:j])
                if len(part) > size + k:
                    break
                if len(part) >= size - k and (d := versioned_distance(part, phrase)) <= k:
                    best[phrase] = min(d, best.get(phrase, k))
    return best


def noisy(rng, phrase):
    """Up to three edits, in front of the first letter too."""
    chars = list(phrase)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(chars))
        chars[at:at + 1] = rng.choice([[], ["q"], [chars[at], "z"], [" "], ["x", chars[at]]])
    if rng.random() < .2:
        chars.insert(0, rng.choice("xz"))
    return "".join(chars)


def test_against_edit_distance(spark):
    rng = random.Random(11)
    notices = [p for _, p in li.BASE_NOTICES + li.NOTICES]
    lead = lambda: "".join(f"w{rng.randrange(9)} " for _ in range(rng.choice([0, 0, 1, 5])))
    texts = [lead() + noisy(rng, rng.choice(notices)) + rng.choice(["", " tail", " " + noisy(rng, rng.choice(notices))]) for _ in range(1000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in li.license_digest(li.scan_licenses(docs)).collect()}
    wrong = []
    for i, text in enumerate(texts):
        best = brute(" ".join(w.decode() for w in li.alnum_words(text.encode())))
        labels = ",".join(sorted({x for x, p in li.BASE_NOTICES + li.NOTICES if p in best}))
        score = max((1 - d / len(p) for p, d in best.items()), default=0.0)
        if got[i].labels != labels or abs(got[i].score - score) > 1e-12:
            wrong.append((text, got[i].labels, labels, got[i].score, score))
    assert not wrong, wrong[:5]


def test_insertions_in_front_and_near_places_beside_exact_ones():
    find = li.scanner(li.BASE_NOTICES, li.NOTICES)
    at = lambda line, label: [(a, e) for n, a, _, e in sorted(find.spans(line), key=lambda s: s[1]) if n.label == label]
    assert at("xall rights reserved", "all-rights-reserved") == [(0, 1)]
    assert at("all rights reserved all rights reservd", "all-rights-reserved") == [(0, 0), (20, 1)]
    assert at("all right reserved all rights reserved", "all-rights-reserved") == [(0, 1), (19, 0)]
    assert at("gnu general public license version 3", "gpl-2") == []


def base(text):
    words = [w.decode() for w in li.alnum_words(text.encode() if text else None)]
    at, labels = [], set()
    for label, phrase in li.BASE_NOTICES:
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        at += own
        labels |= {label} if own else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check_base(docs):
    want = sorted(((r.doc_id, *base(r.text)) for r in docs.collect()), key=repr)
    got = li.license_digest(li.scan_licenses(docs))
    assert by_id(got, "n_words", "n_base", "first_word", "last_word", "base_labels") == want


def test_base_places(spark):
    texts = ["Under the MIT License. under the mit licenses under-the-mit-license", "cc by nc cc by nc, CC BY-NC 4.0",
             "xcc by nc", "cc by ncx", "under the mit licence under the mit license under the mit license",
             "Apache License, Version 2.0 apache license version 20", "underthe mit license", "", None]
    check_base(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_edges(edges, wide, nothing):
    check_base(edges)
    check_base(wide)
    assert li.scan_licenses(nothing).count() == 0


def test_corpus(spark, sf_dir):
    check_base(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_spans_report_what_stands_there(spark):
    docs = spark.createDataFrame([(1, "see: Licensed under the Apach Licence, Version 2")], "doc_id long, text string")
    spans = li.scan_licenses(docs).first().spans
    assert [(s.label, s.first_word, s.end_word, s.edits, s.found) for s in spans] == [
        ("apache-2", 1, 6, 2, "licensed under the apach licence"), ("apache-2", 4, 8, 2, "apach licence version 2")]


def test_versions_allow_no_edits(spark):
    cases = [("GNU General Public License, version 2", "gpl-2"), ("GNU General Public License, version 3", "gpl-3"),
             ("the GNU Genral Public Licence version 3 or later", "gpl-3"), ("GNU General Public License version 1", ""),
             ("gnu general public license version", ""), ("gnu general public license version 23", ""),
             ("gnu general public license version 12", ""), ("gnu general public icense versio2", "gpl-2"),
             ("Apache License, Version 1.1", ""), ("Apache License, Version 1.2", ""), ("Apache License, Version 2.0", "apache-2"),
             ("Apach Licence, Version 2.0", "apache-2"), ("Mozilla Public License Version 1.1", ""),
             ("Mozila Public License Version 2.0", "mpl-2"),
             ("gnu general public license version 2 gnu general public license version 3", "gpl-2,gpl-3"),
             ("Creative Commons Attribution 3.0 International", ""),
             ("Creative Common Attribution 4.0 Internationel", "cc-by")]
    docs = spark.createDataFrame([(i, f"see {t} for more") for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in li.license_digest(li.scan_licenses(docs)).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases
