import random
import re
from collections import Counter, defaultdict

import pytest
from llm.rows import DOCUMENT, documents, odd_documents

from ferryline.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """The contract by counting every run of up to four words."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        rows = []
        for p, a in found.items():
            if not (inside[p] and 100 * inside[p] >= 80 * a):
                score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(docs, folder, **more):
    got = phrases.collocations(docs, folder, **more).collect()
    want = brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()], phrases.LEAST, phrases.TOP)
    assert sorted(map(tuple, got)) == want
    return want


def prose(dice, count):
    vocabulary = [f"w{i}" for i in range(60)]
    fixed = ["every one of these words", "Common Opening line", "w1 w2 w3 w4 w5 w6", "a-b é ü ☃"]
    for _ in range(count):
        words = [vocabulary[min(59, int(dice.expovariate(0.12)))] for _ in range(dice.randint(0, 60))]
        words.insert(dice.randint(0, len(words)), dice.choice(fixed))
        yield "".join(w + dice.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for w in words)


@pytest.mark.parametrize("top, ahead, lower", [(2000, 4, 8), (5, 1, 2), (40, 1, 2)])
def test_rounds(spark, tmp_path, monkeypatch, top, ahead, lower):
    """From one round to many: the threshold falls until the last place is settled, and changes no result."""
    monkeypatch.setattr(phrases, "TOP", top)
    monkeypatch.setattr(phrases, "LOWER", lower)
    dice = random.Random(top)
    rows = [(i, t, dice.choice(["en", "en", "de", None, "und"]), "s", 1) for i, t in enumerate(prose(dice, 700))]
    found = check(spark.createDataFrame(rows, DOCUMENT), f"{tmp_path}/p", ahead=ahead)
    assert {lang for lang, *_ in found} == {"en", "de", "und"} and any(p.count(" ") == 3 for _, _, p, *_ in found)


def test_covered_ties_and_long_texts(spark, tmp_path):
    """Covered at exactly 80 of 100, overlaps, equal scores, a long word and a long text."""
    texts = ["x y z. " * 32 + "x y! " * 8, "p q r; " * 31 + "p q? " * 8, "go go go go\n" * 20, "k" * 200000 + " b,",
             " ".join(["left right"] * 100000), "m1 m2. " * 30 + "l1 l2. " * 30]
    found = [p for _, _, p, *_ in check(documents(spark, texts), f"{tmp_path}/p")]
    assert "x y" not in found and "p q" in found


def test_odd_rows(spark, tmp_path):
    check(odd_documents(spark).union(odd_documents(spark)), f"{tmp_path}/o")
    assert phrases.collocations(documents(spark, []), f"{tmp_path}/e").count() == 0
