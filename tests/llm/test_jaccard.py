import random
from collections import defaultdict

import numpy as np
import pytest
from llm.rows import WORD, documents, odd_documents

from ferryline.llm import jaccard, linked_sets
from ferryline.llm.shingles import folded, odd_bits, parity
from ferryline.sources.collections import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size, percent):
    """[(id, number of shingles, component)] by comparing all pairs that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    held = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in held[g]:
                shared[j] += 1
            held[g].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        at = find(i)
        if doc is not None and (least.get(at) is None or doc < least[at]):
            least[at] = doc
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def check(docs, folder, size, percent):
    got = jaccard.jaccard_groups(docs, folder, size, percent).select("doc_id", "n_shingles", "component_id").collect()
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], size, percent)
    assert sorted(map(tuple, got), key=repr) == want
    return want


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_tables(spark, tmp_path, size, percent):
    check(table(spark, "/root/testdata/sf0.01", "documents"), f"{tmp_path}/j", size, percent)


def edited(words, dice, share):
    return " ".join(f"w{dice.random()}" if dice.random() < share else w for w in words)


@pytest.mark.parametrize("members", [3, 512])
def test_large_groups_of_near_copies(spark, tmp_path, monkeypatch, members):
    """More copies than a task may settle, with and without their source, so that pivots and later levels work."""
    monkeypatch.setattr(linked_sets, "MEMBERS", members)
    dice = random.Random(7)
    texts = []
    for source in range(4):
        words = [f"v{source}-{i}" for i in range(120)]
        texts += [" ".join(words)] * (source % 2)
        texts += [edited(words, dice, dice.choice([0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(40)]
        texts += [" ".join(words[:dice.randint(95, 120)]) for _ in range(10)]
    dice.shuffle(texts)
    found = check(documents(spark, texts), f"{tmp_path}/j", 4, 85)
    assert len({c for _, _, c in found}) < len(texts)


def test_candidates_far_apart_are_not_counted(spark, tmp_path, monkeypatch):
    """Texts that share most of a page meet in fragments, in pairs and in stars; bitmaps tell that none of them link."""
    asked, counted = [], linked_sets._counted
    monkeypatch.setattr(linked_sets, "_counted", lambda pairs, *rest: asked.append(pairs.count()) or counted(pairs, *rest))
    page = [f"p{i}" for i in range(150)]
    texts = [" ".join(page + [f"own{k}-{i}" for i in range(60)]) for k in range(30)]
    check(documents(spark, texts), f"{tmp_path}/a", 4, 85)
    assert sum(asked) == 0
    check(documents(spark, texts + [texts[0] + " more"]), f"{tmp_path}/b", 4, 85)
    assert sum(asked) == 1


@pytest.mark.parametrize("members, compared", [(4_096, 4_096), (7, 4_096), (7, 16)])
def test_a_large_star_takes_one_turn(spark, tmp_path, monkeypatch, members, compared):
    """Edits around the threshold leave members open: they are held against the others once, in blocks, and not star by star."""
    monkeypatch.setattr(linked_sets, "MEMBERS", members)
    monkeypatch.setattr(linked_sets, "COMPARED", compared)
    monkeypatch.setattr(linked_sets, "DIFFERENCES", 2_000)
    turns, counted = [], linked_sets._counted
    monkeypatch.setattr(linked_sets, "_counted", lambda *rest: turns.append(1) or counted(*rest))
    dice = random.Random(23)
    words = [f"v{i}" for i in range(200)]
    far = edited(words, dice, 0.06).split()
    texts = [edited(source, dice, dice.choice([0.005, 0.01, 0.02, 0.03, 0.04])) for source in (words, far) for _ in range(60)]
    texts += [" ".join(words[:150] + [f"own{k}-{i}" for i in range(40)]) for k in range(30)]
    found = check(documents(spark, texts), f"{tmp_path}/j", 4, 85)
    assert 30 < len({c for _, _, c in found}) < 100
    assert len(turns) == 1


def test_texts_of_a_long_list_are_found_by_a_bitmap(spark, tmp_path, monkeypatch):
    """Of more texts than are broadcast, the chosen ones only are shuffled: few of the others pass a bitmap."""
    passed, perhaps = [], jaccard._perhaps
    monkeypatch.setattr(jaccard, "BROADCAST_TEXTS", 0)
    monkeypatch.setattr(jaccard, "_perhaps", lambda *rest: passed.append(perhaps(*rest)) or passed[0])
    page = [f"p{i}" for i in range(60)]
    near = [" ".join(page + [f"own{k}"]) for k in range(5)]
    check(documents(spark, [None, ""] + near + near[:2] + [f"alone {k} of its kind" for k in range(300)]), f"{tmp_path}/j", 4, 85)
    assert 7 <= passed[0].count() < 20


def test_settled_groups_are_not_worked_on_again(spark, tmp_path, monkeypatch):
    """Where all members link with their pivot, no labels are merged and no differences are sent to tasks."""
    worked = []
    for name in ("_merged", "_links_of"):
        before = getattr(linked_sets, name)
        monkeypatch.setattr(linked_sets, name, lambda *a, before=before, name=name: worked.append(name) or before(*a))
    page = [f"p{i}" for i in range(200)]
    texts = [" ".join(page + [f"own{k}"]) for k in range(12)] + ["quite another text of a few words", " ".join(page[:20])]
    found = check(documents(spark, texts), f"{tmp_path}/j", 4, 85)
    assert len({c for _, _, c in found}) == 3
    assert worked == []


def test_parity_is_a_lower_bound():
    dice = np.random.default_rng(3)
    for size in (1, 5, 64, 65, 1_000, 100_000):
        a = np.unique(dice.integers(0, 2**64, size, dtype=np.uint64))
        for own in (0, size // 10, size):
            b = np.unique(np.concatenate((a[own:], dice.integers(0, 2**64, own, dtype=np.uint64)))) if own else a
            x, y = parity(a), parity(b)
            words = min(x.size, y.size)
            odd = odd_bits(folded(x, words) ^ folded(y, words))
            assert odd <= np.setxor1d(a, b).size and (own or odd == 0)


def test_short_texts_and_chains(spark, tmp_path):
    words = [f"c{i}" for i in range(200)]
    chain = [" ".join(words[i:i + 100]) for i in range(0, 60, 4)]
    short = ["a", "A", "a b", "a b c", "a b c d", "a b c d e", "", " ", None, "a b c d"]
    check(documents(spark, short + chain), f"{tmp_path}/j", 4, 85)


def test_odd_rows(spark, tmp_path):
    check(odd_documents(spark), f"{tmp_path}/j", 4, 85)
    assert jaccard.jaccard_groups(documents(spark, []), f"{tmp_path}/e", 4, 85).count() == 0
