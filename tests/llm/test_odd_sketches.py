import random

import numpy as np
import pytest
from llm.rows import documents, odd_documents
from llm.test_jaccard import brute, edited

from ferryline.llm import linked_sets, odd_sketches
from ferryline.llm.odd_sketches import odd_sketch, samples, similarity
from ferryline.sources.collections import table


def check(docs, folder, size=5, percent=85):
    got = odd_sketches.odd_sketch_groups(docs, folder, size, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], size, percent)
    want = sorted(((d, n, d if n == 0 else c, d == (d if n == 0 else c)) for d, n, c in want), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    return want


def test_tables(spark, tmp_path):
    check(table(spark, "/root/testdata/sf0.01", "documents"), f"{tmp_path}/j")


@pytest.mark.parametrize("members", [8, 512])
def test_large_groups_of_near_copies(spark, tmp_path, monkeypatch, members):
    """Copies around the threshold, with and without their source, truncated ones, and a passage that others share."""
    monkeypatch.setattr(linked_sets, "MEMBERS", members)
    dice = random.Random(11)
    texts = []
    for source in range(3):
        words = [f"v{source}-{i}" for i in range(150)]
        texts += [" ".join(words)] * (source % 2)
        texts += [edited(words, dice, dice.choice([0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(50)]
        texts += [" ".join(words[:dice.randint(115, 150)]) for _ in range(20)]
        texts += [" ".join(words[:70] + [f"own{dice.random()}" for _ in range(60)]) for _ in range(40)]
    dice.shuffle(texts)
    found = check(documents(spark, texts), f"{tmp_path}/j")
    assert 20 < len({c for _, _, c, _ in found}) < len(texts) - 50


def test_odd_rows(spark, tmp_path):
    check(odd_documents(spark), f"{tmp_path}/o")
    assert odd_sketches.odd_sketch_groups(documents(spark, []), f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("size", [8, 60, 2000])
def test_estimates(size):
    """Estimates of known similarities: close where they are high, never below the gate at the threshold."""
    dice = np.random.Generator(np.random.PCG64(size))
    for percent in (85, 95, 50):
        errors = []
        for _ in range(300):
            common = max(1, round(size * percent / 100))
            values = dice.integers(0, 2**64, size, dtype=np.uint64)
            half = common + (size - common) // 2
            a, b = values[:half], np.concatenate((values[:common], values[half:]))
            odd = np.bitwise_count((odd_sketch(samples(a)) ^ odd_sketch(samples(b))).view(np.uint64)).sum()
            errors.append(similarity(np.array([odd]))[0] - common / size)
        assert abs(np.mean(errors)) < 0.03 and (percent == 50 or min(errors) > -odd_sketches.MARGIN)
