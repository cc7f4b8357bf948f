import random
import time
from collections import Counter

from codetide.llm import licenses as lic
from conftest import SF_DIR


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + 1 if x == y else 0)
    return row[-1]


def test_every_notice_line_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {lic.TEMPLATES[n].lower() + ".": n for n in lic.TEMPLATES}
    want = {(r.doc_id, *lic.license_and_form(lines[x.strip().lower()])) for r in docs.collect() for x in r.text.split("\n") if x.strip().lower() in lines}
    got = {(r.doc_id, r.license, r.form): r.coverage for r in lic.find_notices(docs).collect()}
    assert want and want <= set(got) and all(got[k] == 1.0 for k in want)


def test_coverage_of_edited_templates():
    """Never more than the longest common subsequence, and all of it where every word is unique."""
    rng = random.Random(1)
    for name, text in lic.TEMPLATES.items():
        template = lic.words_of(text)
        for edits in range(4):
            words = list(template)
            for _ in range(edits):
                words[rng.randrange(len(words))] = f"other{rng.randrange(99)}"
            pairs = lic.aligned(words, template)
            assert pairs == sorted(pairs) and all(words[i] == template[j] for i, j in pairs)
            assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))
            assert len(pairs) <= longest_common(words, template)
            if len(set(template)) == len(template):
                assert len(pairs) == longest_common(words, template), name


def test_found_within_text_and_several_times():
    rng = random.Random(2)
    for name, text in lic.TEMPLATES.items():
        fill = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(50))
        found = [f for f in lic.NoticeFinder({name: text}, 0.8)(f"{fill()} {text} {fill()} {text.upper()}\n{fill()}")]
        n = len(lic.words_of(text))
        assert [(f[1], f[2], f[3]) for f in sorted(found, key=lambda f: f[2])] == [(1.0, 50, 50 + n), (1.0, 100 + n, 100 + 2 * n)], name


def best(text):
    return [name for name, *_ in lic.NoticeFinder(lic.TEMPLATES, lic.LEAST_COVERAGE)(text)]


def test_each_template_is_found_as_itself():
    for name, text in lic.TEMPLATES.items():
        assert best(f"w1 w2 {text} w3 w4") == [name]


def test_words_that_tell_licenses_apart():
    assert best("This work is licensed under the GNU General Public License, version 2") == ["GPL-2.0 notice"]
    assert best("This work is licensed under the GNU Lesser General Public License, version 3") == ["LGPL-3.0 notice"]
    assert best("Licensed under the Apache License, Version 1.1") == ["Apache-1.1 notice"]
    assert best("Creative Commons Attribution-NonCommercial 4.0 International") == ["CC-BY-NC-4.0 name"]
    for unknown in ("the GNU General Public License, version 5", "a Creative Commons Attribution 9.0 International License"):
        assert best(f"This work is licensed under {unknown}") == []
    assert best("Released under the Foo License") == best("Licensed under the Apache License, Version 7.0") == []
    for variant in ("Affero", "Lesser"):
        changed = lic.TEMPLATES["GPL-3.0"].replace("GNU General", f"GNU {variant} General")
        assert "GPL-3.0" not in best(changed) and best(lic.TEMPLATES["GPL-3.0"]) == ["GPL-3.0"]


def test_scattered_words_are_no_notice():
    words = lic.words_of(lic.TEMPLATES["MIT"])
    assert not list(lic.NoticeFinder(lic.TEMPLATES, 0.8)(" ".join(f"{w} x y z" for w in words)))


def test_common_subsequences():
    rng = random.Random(4)
    for _ in range(200):
        a, b = (rng.choices("abcdef", k=rng.randrange(1, 30)) for _ in range(2))
        assert lic.Template("t", b).in_order(a) == longest_common(a, b)


def exhaustive(words, template):
    """Whether any stretch with enough of the template's words has an alignment of the needed share, without bounds on their order."""
    width, n, own = int(lic.STRETCH * len(template)) + 1, len(template), Counter(template)
    for start in range(len(words)):
        if words[start] not in own or sum((Counter(words[start : start + width]) & own).values()) < lic.LEAST_COVERAGE * n:
            continue
        pairs = lic.NoticeFinder._within(width, lic.aligned(words[start : start + width + n], template))
        if len(pairs) >= lic.LEAST_COVERAGE * n:
            return True
    return False


def test_bounds_lose_nothing():
    """Edited wordings among other words: what an alignment of every stretch finds is found."""
    rng = random.Random(6)
    found = 0
    for round_ in range(150):
        name = rng.choice(["ISC", "MIT", "BSD-2-Clause", "MPL-2.0 header", "MIT notice"])
        template = lic.words_of(lic.TEMPLATES[name])
        words = list(template)
        for _ in range(rng.randrange(0, max(3, len(words)))):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choices([*template, "odd", "words"], k=rng.randrange(2))
        words = [*rng.choices(template, k=8), *words, *rng.choices(template, k=8)]
        finder = lic.NoticeFinder({name: lic.TEMPLATES[name]}, lic.LEAST_COVERAGE)
        finder._told = lambda *_: True
        got = list(finder(" ".join(words)))
        assert bool(got) == exhaustive(words, template), (round_, name)
        found += bool(got)
    assert 20 < found < 140


def test_texts_of_license_words_are_cheap():
    """Words of a license in random order, in shuffled runs, and a notice repeated."""
    rng = random.Random(5)
    words = lic.words_of(lic.TEMPLATES["Apache-2.0"])
    shuffled = rng.choices(words, k=1_000_000)
    runs = [w for _ in range(4000) for at in [rng.randrange(len(words) - 5)] for w in words[at : at + 5]]
    notice = "Released under the MIT License. " * 4000
    find = lic.NoticeFinder(lic.TEMPLATES, lic.LEAST_COVERAGE)
    start = time.perf_counter()
    assert not list(find(" ".join(shuffled))) and not [f for f in find(" ".join(runs)) if f[1] * len(lic.words_of(lic.TEMPLATES[f[0]])) > 50]
    assert len(list(find(notice))) == 4000
    assert time.perf_counter() - start < 120


def test_longest_increasing():
    rng = random.Random(3)
    for _ in range(200):
        values = [rng.randrange(20) for _ in range(rng.randrange(12))]
        best = [1] * len(values)
        for i, v in enumerate(values):
            best[i] = 1 + max((best[j] for j in range(i) if values[j] < v), default=0)
        picked = [values[i] for i in lic.longest_increasing(values)]
        assert len(picked) == max(best, default=0) and all(a < b for a, b in zip(picked, picked[1:], strict=False))


def test_cases(spark, make_documents):
    text = "Released under the MIT License."
    docs = make_documents((1, None), (2, ""), (3, text), (3, text), (None, text), (4, "word " * 30000 + text))
    rows = sorted((r.doc_id or 0, f"{r.license} {r.form}", r.first_word) for r in lic.find_notices(docs).collect())
    assert rows == [(0, "MIT notice", 0), (3, "MIT notice", 0), (3, "MIT notice", 0), (4, "MIT notice", 30000)]
    assert lic.find_notices(docs.limit(0)).count() == 0
    assert lic.find_notices(spark.read.parquet(f"{SF_DIR}/documents.parquet"), {"none": "..."}).count() == 0
