import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.rows import documents, odd_documents

from ferryline.llm import spelling
from ferryline.sources.collections import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """The contract, word by word: near words by taking out every letter of every word."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    gaps, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i] + w[i + 1:]].add((w, i))
    for w in words:
        for other, _ in gaps.get(w, ()):
            near[w].add(other)
            near[other].add(w)
    for found in gaps.values():
        for a, i in found:
            near[a] |= {b for b, j in found if i == j and a != b}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def check(docs, folder, **more):
    got = spelling.spelling_forms(docs, folder, **more).collect()
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, got), key=repr) == want
    return want


@pytest.mark.parametrize("cell", [64, spelling.CELL])
def test_tables(spark, tmp_path, cell):
    found = check(table(spark, "/root/testdata/sf0.01", "documents"), f"{tmp_path}/s", cell=cell)
    assert sum(f is not None for _, f, *_ in found) > 10 and any(n > 1 for *_, n, _ in found)


def test_chains_ties_long_words_and_letters(spark, tmp_path):
    dice = random.Random(3)
    long = "".join(dice.choice("abcdefgh") for _ in range(3000)) + "d" * 3000
    words = {"grandest": 1200, "grandesk": 100, "grandeskx": 8, "brandest": 100, "naïveté": 30, "naiveté": 3,
             "NAIVETÉ": 2, "naïvetés": 2, long: 30, long[:-1] + "zz": 2, long + "q": 2, "×÷×÷×÷×": 2, "x" * 47: 2, "x" * 48: 2,
             "x" * 49: 2, "x" * 50: 20, "sevenly": 3, "evensly": 3}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    found = {w: (form, root) for w, form, root, *_ in check(documents(spark, [text, text]), f"{tmp_path}/s")}
    assert found["grandeskx"] == ("grandesk", "grandest")


def test_odd_rows(spark, tmp_path):
    check(odd_documents(spark), f"{tmp_path}/o")
    assert spelling.spelling_forms(documents(spark, []), f"{tmp_path}/e").count() == 0


def test_boxes_reach_every_point():
    """A pruned search finds what comparing all words finds."""
    dice = random.Random(5)
    words = sorted({"".join(dice.choice("abcé") for _ in range(dice.randint(7, 9))).encode("latin-1") for _ in range(3000)})
    found = {(words[i], words[j]) for q, p in spelling.search_cell(words, np.full(len(words), 7)) for i, j in zip(q, p)}
    for a in words[::20]:
        assert {b for b in words if spelling.one_edit(a, b)} == {b for x, b in found if x == a}
