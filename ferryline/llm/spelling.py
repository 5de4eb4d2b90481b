"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One edit moves the vector of letter counts by at most two in L1: a replaced letter lowers one count and raises another,
an added letter raises one. So the points of one length are searched by the words of the same length (one count up, one
down at most) and by the words one shorter (one count up, none down), and a box that needs more is pruned. What is left
has the right letters; the order of the letters is verified then.

The upper part of each tree deals the words out to cells. It is fitted on at most ``SAMPLE`` words, which steers balance
only; every word is a point of one cell and a query in all cells whose box it may reach. The lower part is built by the
task that searches a cell. Letters are U+00FF at most, so a word is one byte a letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.linked_sets import Tables

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 7
FEWEST = 2
TIMES = 10
DELETED_BY = 31
CELL = 16_384
SAMPLE = 65_536
LONG = 48  # words of this length or more share one tree
LEAF = 128
HELD = 400_000
CHUNK = 4_096
# A form occurs TIMES as often as its word, so 18 steps exhaust 64-bit counts; five doublings reach 32.
DOUBLINGS = 5


def thinned_words(doc_id: int | None, text: str | None) -> Counter:
    """Words of one text with their counts, after the deletions; ``:word`` is what is hashed where the id is null."""
    found: Counter = Counter()
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(re.findall(f"[{LETTERS}]{{{SHORTEST},}}", lowered)).items():
        h = zlib.crc32(word.encode(), start)
        if h % DELETED_BY == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        if len(word) >= SHORTEST:
            found[word] += n
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.update(thinned_words(doc, text.as_py()))
            if len(held) >= HELD:
                yield flush()
    if held:
        yield flush()


def vectors(words: list[bytes]) -> np.ndarray:
    """Letter counts, one row a word: a-z and the 64 letters from U+00C0."""
    if not words:
        return np.zeros((0, 90), np.int32)
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    place = np.where(letters < 128, letters - 97, letters - 0xC0 + 26)
    return np.bincount(row * 90 + place, minlength=len(words) * 90).reshape(len(words), 90).astype(np.int32)


@dataclass
class Node:
    """A split ``count of letter <= at`` with what the box allowed of that letter so far, or a leaf."""

    letter: int = 0
    at: int = 0
    low: int = 0
    high: int = 2**30
    sides: tuple[Node, Node] | None = None
    cell: int = -1
    rows: np.ndarray | None = None


def grow(points: np.ndarray, rows: np.ndarray, leaf: int, box: dict[int, tuple[int, int]]) -> Node:
    """A tree over ``points[rows]``: the most even split of any letter, until a leaf has ``leaf`` points or all are equal."""
    if rows.size > leaf:
        own = points[rows]
        middle = np.median(own, axis=0)
        best = None
        for shift in (0, -1):
            at = np.floor(middle).astype(np.int32) + shift
            share = np.abs((own <= at).mean(axis=0) - 0.5)
            letter = int(share.argmin())
            if share[letter] < 0.5 and (best is None or share[letter] < best[0]):
                best = (share[letter], letter, int(at[letter]))
        if best:
            _, letter, at = best
            low, high = box.get(letter, (0, 2**30))
            left = own[:, letter] <= at
            return Node(letter, at, low, high, (
                grow(points, rows[left], leaf, {**box, letter: (low, at)}),
                grow(points, rows[~left], leaf, {**box, letter: (at + 1, high)})))
    return Node(rows=rows)


def leaves(node: Node) -> Iterator[Node]:
    if node.sides is None:
        yield node
    else:
        for side in node.sides:
            yield from leaves(side)


def reached(node: Node, queries: np.ndarray, rows: np.ndarray, most_up: int, most_down: int,
            up: np.ndarray | None = None, down: np.ndarray | None = None) -> Iterator[tuple[Node, np.ndarray]]:
    """(leaf, rows of the queries that may have points in it): counts rise by ``most_up`` and fall by ``most_down`` at most."""
    up = np.zeros(rows.size, np.int32) if up is None else up
    down = np.zeros(rows.size, np.int32) if down is None else down
    if not rows.size:
        return
    if node.sides is None:
        yield node, rows
        return
    own = queries[rows, node.letter]
    # What the letter has cost so far counts once: the box is narrowed, not added.
    fall = down - np.maximum(own - node.high, 0) + np.maximum(own - node.at, 0)
    rise = up - np.maximum(node.low - own, 0) + np.maximum(node.at + 1 - own, 0)
    left, right = fall <= most_down, rise <= most_up
    yield from reached(node.sides[0], queries, rows[left], most_up, most_down, up[left], fall[left])
    yield from reached(node.sides[1], queries, rows[right], most_up, most_down, rise[right], down[right])


def fit_cells(sample: list[bytes], sizes: dict[int, int], cell: int) -> dict[int, Node]:
    """A tree for each length, with about ``cell`` words a leaf; the leaves are numbered through."""
    by_length: dict[int, list[bytes]] = {}
    for word in sample:
        by_length.setdefault(min(len(word), LONG), []).append(word)
    trees, number = {}, 0
    for length, size in sorted(sizes.items()):
        own = by_length.get(length, [])
        points = vectors(own)
        parts = max(1, size // cell)
        trees[length] = grow(points, np.arange(len(own)), max(1, -(-len(own) // parts)), {})
        for leaf in leaves(trees[length]):
            leaf.cell, leaf.rows, number = number, None, number + 1
    return trees


def _deal(trees: dict[int, Node]):
    """Rows ``cell, word, n, point, same, longer``: where a word lies, and where it looks for words as long or one longer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            counts = np.asarray(batch.column(1), dtype=np.int64)
            places, lengths = vectors(words), np.array([len(w) for w in words])
            kinds: dict[int, np.ndarray] = {}

            def mark(length, own, up, down, kind):
                if length in trees:
                    for leaf, rows in reached(trees[length], places, own, up, down):
                        flags = kinds.setdefault(leaf.cell, np.zeros(len(words), np.uint8))
                        flags[rows] |= kind

            for length in np.unique(np.minimum(lengths, LONG)):
                own = np.flatnonzero(np.minimum(lengths, LONG) == length)
                mark(length, own, 0, 0, 1)
                mark(length, own, 1, 1, 2)
                mark(length + 1 if length < LONG else LONG, own, 1, 0, 4)
            for cell, flags in kinds.items():
                rows = np.flatnonzero(flags)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows.size, cell, np.int32)), batch.column(0).take(pa.array(rows)), pa.array(counts[rows]),
                    pa.array(flags[rows].astype(np.int32))], ["cell", "word", "n", "kind"])
    return run


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether ``a`` becomes ``b`` by exactly one replaced or one added letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) + 1 != len(b):
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same:] == b[same + 1:]


def letter_table(words: list[bytes], sizes: np.ndarray) -> np.ndarray | None:
    """The letters of the words, one row each; none where a word has more than ``LONG``."""
    if sizes.max() > LONG:
        return None
    table = np.zeros((len(words), LONG + 1), np.uint8)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    table[np.repeat(np.arange(len(words)), sizes), place] = np.frombuffer(b"".join(words), np.uint8)
    return table


def _in_order(words: list[bytes], table: np.ndarray | None, sizes: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which of the pairs of words are one edit apart, by the order of their letters."""
    if table is None:
        return np.array([one_edit(words[i], words[j]) for i, j in zip(q, p)], dtype=bool)
    a, b, na, nb = table[q], table[p], sizes[q], sizes[p]
    replaced = (na == nb) & ((a != b).sum(axis=1) == 1)
    inside = np.arange(LONG)[None, :] < na[:, None]
    before = np.cumprod((a[:, :-1] == b[:, :-1]) & inside, axis=1, dtype=np.uint8).sum(axis=1)
    shifted = (a[:, :-1] == b[:, 1:]) | ~inside
    after = np.cumprod(shifted[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1) - (LONG - na)
    return replaced | ((na + 1 == nb) & (before + after >= na))


def search_cell(words: list[bytes], kinds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query rows, point rows) of words one edit apart in one cell; the query is as long as the point or one shorter."""
    points = np.flatnonzero(kinds & 1)
    if not points.size:
        return
    places = vectors(words)
    places = places[:, places.any(axis=0)]  # letters that no word of the cell has
    sizes = np.array([len(w) for w in words])
    table = letter_table(words, sizes)
    tree = grow(places, points, LEAF, {})
    dense = places.astype(np.float32 if places.sum(axis=1).max() <= 2_048 else np.float64)  # squares stay exact
    squares = (dense * dense).sum(axis=1)
    for kind, most_down, distance in ((2, 1, 2), (4, 0, 1)):
        for leaf, rows in reached(tree, places, np.flatnonzero(kinds & kind), 1, most_down):
            for start in range(0, rows.size, CHUNK):
                own = rows[start:start + CHUNK]
                # Squared distance 2 (same length) or 1 (one longer): exactly one count up, and one or none down.
                apart = squares[own][:, None] + squares[leaf.rows][None, :] - 2 * dense[own] @ dense[leaf.rows].T
                i, j = np.nonzero(apart == distance)
                q, p = own[i], leaf.rows[j]
                for at in range(0, q.size, 16 * CHUNK):
                    some = slice(at, at + 16 * CHUNK)
                    fits = _in_order(words, table, sizes, q[some], p[some])
                    yield q[some][fits], p[some][fits]


def _search(key: tuple, table: pa.Table) -> pa.Table:
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    counts = table.column("n").to_numpy()
    found = list(search_cell(words, table.column("kind").to_numpy()))
    q = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    p = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
    sizes = np.array([len(w) for w in words])
    # A word that is as long finds the pair itself from its own side.
    longer = sizes[p] > sizes[q]
    ends, others = np.concatenate((q, p[longer])), np.concatenate((p, q[longer]))
    names = table.column("word").combine_chunks()
    return pa.table({"word": names.take(pa.array(ends)), "near": names.take(pa.array(others)), "near_n": pa.array(counts[others], pa.int64())})


def spelling_forms(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", cell: int = CELL,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of ``SHORTEST`` letters or more with ``FEWEST`` occurrences or more.

    A word is a maximal run of letters, A-Z as a-z; where 31 divides the crc32 of ``<id>:<word>``, one letter is taken
    out. ``form`` is the most frequent word one edit away, the first in code-point order of ties, if it occurs ten times
    as often; ``root`` is where forms lead.

    Nulls: a null text has no words; a null id is hashed as an empty one. Repeated rows count again. Words of any length
    are searched. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    tables = Tables(spark, folder)
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = read.mapInArrow(_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = tables.keep(counted.where(F.col("n") >= FEWEST))

    length = F.least(F.length("word"), F.lit(LONG)).alias("length")
    sizes = {r.length: r.n for r in words.groupBy(length).agg(F.count("*").alias("n")).collect()}  # LONG rows at most
    every = max(1, -(-2 * sum(sizes.values()) // SAMPLE))
    sample = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").limit(SAMPLE)
    trees = fit_cells([r.word.encode("latin-1") for r in sample.collect()], sizes, cell)

    dealt = words.select("word", "n").mapInArrow(_deal(trees), "cell int, word string, n bigint, kind int")
    near = tables.keep(dealt.groupBy("cell").applyInArrow(_search, "word string, near string, near_n bigint")
                       .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"),
                                                      (-F.col("best.less")).alias("near_n"))
    formed = F.col("near_n") >= TIMES * F.col("n")
    told = tables.keep(joined.select("word", "n", "n_near", F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")))
    steps = tables.keep(told.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    for _ in range(DOUBLINGS):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        steps = tables.keep(steps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")))
    return told.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
