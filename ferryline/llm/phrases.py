"""Phrase collocations by best-first growth of prefixes, each language on its own.

A phrase of 2 to 4 words scores ``floor(2000000 a / (l + r))`` at its worst cut. A prefix P of count f(P) that begins with
the word w bounds whatever grows from it: its first word occurs f(w) times and its rest at least as often as itself, so
no longer phrase scores above ``floor(2000000 f(P) / (f(w) + f(P)))``. Prefixes are expanded from the highest bound down
to a threshold; phrases at or above it are known whole then, with all that decides whether they survive. The threshold
falls for the languages that have fewer than ``TOP`` survivors, until every one has them or has no frontier left. One
word alone bounds nothing, so all pairs of frequent words are counted.

A pass over the texts counts occurrences of one length. What may count is looked up in bitmaps of a fixed size, built
from tables: a false hit costs a row, and nothing is missed. A word is a 64-bit fingerprint of language and text; a
phrase is the tuple of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.linked_sets import Tables
from ferryline.llm.shingles import mix, powers

LEAST = 30
LONGEST = 4
TOP = 2000
AHEAD = 4  # the first threshold: the score of pair number AHEAD * TOP of a language
LOWER = 8  # how many times as many pairs the next one takes
BITS = 25  # log2 of the bits of a bitmap: 4 MB
SLICE = 2_000_000  # bytes of text that are taken apart at once
WORDS = 2_000_000  # occurrences that are summed before they leave a task

_ODD = np.uint64(0x9E3779B97F4A7C15)
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LETTER = np.random.Generator(np.random.PCG64(20240602)).integers(1, 2**64, 256, dtype=np.uint64)
_LETTER[_KIND > 0] = 0


@lru_cache(maxsize=1024)
def lang_key(lang: str) -> np.uint64:
    key = np.zeros(1, np.uint64)
    for byte in lang.encode("utf-8", "surrogatepass"):
        key = mix(key * _ODD + np.uint64(byte + 1))
    return key[0]


def taken_apart(texts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word fingerprints, piece of each, first byte of each, byte behind each, all bytes) of lower-cased texts."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not starts.size:
        return np.zeros(0, np.uint64), starts, starts, ends, raw
    lengths = np.diff(np.append(starts, raw.size))
    place = np.arange(starts[0], raw.size) - np.repeat(starts, lengths)
    longest = int((ends - starts).max())
    power = powers(64 if longest <= 64 else 1 << longest.bit_length())
    # Bytes behind a word weigh nothing, so their place may be cut.
    summed = np.add.reduceat(_LETTER[raw[starts[0]:]] * power[np.minimum(place, power.size - 1)], starts - starts[0])
    bounds = np.cumsum([len(t) + 1 for t in texts])
    words = mix(mix(summed) ^ keys[np.searchsorted(bounds, starts, side="right")])
    return words, np.cumsum(kind == 2)[starts], starts, ends, raw


def _slices(batches: Iterator[pa.RecordBatch]):
    texts, langs, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
            texts.append(raw)
            langs.append(lang.as_py())
            held += len(raw)
            if held >= SLICE:
                yield texts, langs, np.array([lang_key(x) for x in langs], np.uint64)
                texts, langs, held = [], [], 0
    if texts:
        yield texts, langs, np.array([lang_key(x) for x in langs], np.uint64)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, key, n``; a row with an empty word has the number of all words of a language."""
    for texts, langs, keys in _slices(batches):
        words, _, starts, ends, raw = taken_apart(texts, keys)
        if not words.size:
            continue
        found, first, counts = np.unique(words, return_index=True, return_counts=True)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(bounds, starts, side="right")
        body = raw.tobytes()
        names = [body[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        of = [langs[i] for i in doc[first].tolist()]
        totals: dict[str, int] = {}
        for i, n in zip(*np.unique(doc, return_counts=True)):
            totals[langs[i]] = totals.get(langs[i], 0) + int(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(of + list(totals), pa.string()), pa.array(names + [""] * len(totals), pa.string()),
            pa.array(np.concatenate((found.view(np.int64), np.zeros(len(totals), np.int64)))),
            pa.array(np.concatenate((counts, list(totals.values()))).astype(np.int64))], ["lang", "word", "key", "n"])


def joint(parts: list[np.ndarray]) -> np.ndarray:
    """One fingerprint for a run of words."""
    out = np.full(parts[0].size, len(parts), np.uint64)
    for part in parts:
        out = mix(out * _ODD + part)
    return out


def _in(bitmap: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.zeros(keys.size, bool)
    slot = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _runs(size: int, maps: dict[str, np.ndarray]):
    """Counts ``w1..w4`` of runs of ``size`` words that the bitmaps admit; for four words also runs of three that a cut needs."""
    def admitted(words, pieces):
        count = words.size - size + 1
        if count <= 0:
            return
        at = np.flatnonzero(pieces[:count] == pieces[size - 1:])
        if size == 2:
            frequent = _in(maps["words"], words)
            at = at[frequent[at] & frequent[at + 1]]
            yield [words[at], words[at + 1]]
            return
        # Every pair of words inside has to be frequent.
        pair = joint([words[:-1], words[1:]])
        frequent = _in(maps["pairs"], pair)
        if size == 3:
            at = at[frequent[at] & frequent[at + 1]]
            at = at[_in(maps["grow3"], pair[at]) | _in(maps["cover3"], pair[at + 1])]
            yield [words[at + k] for k in range(3)]
            return
        three = np.flatnonzero(frequent[:-1] & frequent[1:] & (pieces[:-2] == pieces[2:]))
        late = three[_in(maps["ends4"], pair[three]) & ~(_in(maps["grow3"], pair[three]) | _in(maps["cover3"], pair[three + 1]))]
        yield [words[late + k] for k in range(3)]
        at = at[frequent[at] & frequent[at + 1] & frequent[at + 2]]
        head, tail = joint([words[at + k] for k in range(3)]), joint([words[at + k] for k in (1, 2, 3)])
        at = at[_in(maps["grow4"], head) | _in(maps["cover4"], tail)]
        yield [words[at + k] for k in range(4)]

    def summed(held: list[list[np.ndarray]]):
        for width in sorted({len(x) for x in held}):
            parts = [np.concatenate([x[k] for x in held if len(x) == width]) for k in range(width)]
            if not parts[0].size:
                continue
            order = np.lexsort(parts[::-1])
            parts = [p[order] for p in parts]
            new = np.zeros(order.size, bool)
            new[0] = True
            for p in parts:
                new[1:] |= p[1:] != p[:-1]
            first = np.flatnonzero(new)
            none = pa.nulls(first.size, pa.int64())
            columns = [pa.array(p[first].view(np.int64)) for p in parts] + [none] * (LONGEST - width)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.diff(np.append(first, order.size)).astype(np.int64))],
                [*(f"w{k + 1}" for k in range(LONGEST)), "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for texts, _, keys in _slices(batches):
            words, pieces, *_ = taken_apart(texts, keys)
            for parts in admitted(words, pieces):
                held.append(parts)
                count += parts[0].size
            if count >= WORDS:
                yield from summed(held)
                held, count = [], 0
        yield from summed(held)
    return run


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the low ``BITS`` bits of ``key``: 4 MB for the driver and every task, whatever the table holds."""
    slot = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)) + 1
    blocks = keys.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in blocks.collect():
        bits = np.frombuffer(row.bits, np.uint8)
        start = (row.block - 1) * 4096
        out[start:start + bits.size] = bits
    return out


def _joint_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [np.asarray(batch.column(k)).astype(np.int64).view(np.uint64) for k in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays([pa.array(joint(parts).view(np.int64))], ["key"])


def _set(rows: DataFrame, *columns: str) -> np.ndarray:
    return bitmap(rows.select(*columns).mapInArrow(_joint_keys, "key bigint"))


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def _score(a: str, left: str, right: str) -> Column:
    return F.expr(f"CAST(2000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(19,0)) "
                  f"DIV (CAST({left} AS DECIMAL(19,0)) + CAST({right} AS DECIMAL(19,0)))")


def _count(docs: DataFrame, size: int, maps: dict[str, np.ndarray]) -> DataFrame:
    names = [f"w{k + 1}" for k in range(LONGEST)]
    runs = docs.mapInArrow(_runs(size, maps), f"{', '.join(f'{x} bigint' for x in names)}, n bigint")
    counted = runs.repartition(*names).groupBy(*names).agg(F.sum("n").alias("a"))
    return counted.where(F.col("a") >= LEAST)


def _cut(phrases: DataFrame, size: int, counts: dict[int, DataFrame]) -> DataFrame:
    """``phrases`` with ``l, r, score`` of the lowest cut, and the ``bound`` on what grows from them."""
    names = [f"w{k + 1}" for k in range(size)]
    out = phrases
    for k in range(1, size):
        for side, part in (("l", names[:k]), ("r", names[k:])):
            of = counts[len(part)]
            out = out.join(of.select(*[F.col(f"w{i + 1}").alias(x) for i, x in enumerate(part)], F.col("a").alias(f"{side}{k}")), part)
    cuts = [F.struct(_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"),
                     F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]
    best = F.array_min(F.array(*cuts))
    return out.withColumns({"best": best, "bound": _score("a", "l1", "a")}).select(
        "lang", *names, "a", "best.l", "best.r", "best.score", "bound")


def _survive(phrases: DataFrame, size: int, longer: DataFrame) -> DataFrame:
    """Phrases that no counted phrase one word longer covers; a covering phrase of two more words has one inside that covers."""
    names = [f"w{k + 1}" for k in range(size)]
    for shift in (0, 1):
        cover = longer.select(*[F.col(f"w{k + 1 + shift}").alias(x) for k, x in enumerate(names)], F.col("a").alias("f"))
        cover = cover.groupBy(*names).agg(F.max("f").alias("f"))
        phrases = phrases.join(cover, names, "left").where(
            F.coalesce(100 * _wide("f") < 80 * _wide("a"), F.lit(True))).drop("f")
    return phrases


def _threshold(phrases: DataFrame, depth: int) -> DataFrame:
    """``lang, least``: about the score of phrase number ``depth``, 0 where there are fewer.

    Scores are counted in steps of 100 first, so that a language is at most 10,001 rows in the window.
    """
    steps = phrases.groupBy("lang", F.expr("score DIV 100").alias("step")).agg(F.count("*").alias("c"))
    above = steps.withColumn("above", F.sum("c").over(Window.partitionBy("lang").orderBy(F.desc("step"))))
    return above.groupBy("lang").agg((100 * F.coalesce(F.max(F.when(F.col("above") >= depth, F.col("step"))), F.lit(0))).alias("least"))


def collocations(
    docs: DataFrame, folder: str, lang: str = "lang", text: str = "text", ahead: int = AHEAD,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``TOP`` best surviving phrases of every language.

    ``a`` occurrences of the phrase, ``l`` and ``r`` of its parts at the lowest cut, ``n`` words of the language. A phrase
    needs ``LEAST`` occurrences, and goes where a longer one has 80 of a hundred of them. Order: score, ``a``, then the
    phrase in UTF-8 order. ``ahead`` sets where growth starts and changes no result.

    Nulls: a null text is empty, a null language is ``und``. Repeated rows count again. Pieces, words and texts may have
    any length. Languages without a phrase have no row; an empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    tables = Tables(spark, folder)
    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    words = read.mapInArrow(_words, "lang string, word string, key bigint, n bigint").groupBy("lang", "word").agg(
        F.sum("n").alias("a"), F.max("key").alias("w1"))
    words = tables.keep(words.where(f"a >= {LEAST} OR word = ''"))
    totals = words.where("word = ''").select("lang", F.col("a").alias("n"))
    words = words.where("word <> ''")
    ones = words.select("w1", "a")
    of_lang = words.select("w1", "lang")
    maps = {"words": bitmap(words.select(F.col("w1").alias("key")))}

    two = tables.keep(_cut(_count(read, 2, maps).join(of_lang, "w1"), 2, {1: ones}))
    maps["pairs"] = _set(two, "w1", "w2")
    done: list[DataFrame] = []
    going, depth = totals.select("lang"), ahead * TOP
    while True:
        least = tables.keep(_threshold(two.join(going, "lang", "left_semi"), depth))
        pairs = two.join(least, "lang")
        maps["grow3"] = _set(pairs.where("bound >= least"), "w1", "w2")
        maps["cover3"] = _set(pairs.where("score >= least"), "w1", "w2")
        three = tables.keep(_cut(_count(read, 3, maps).join(of_lang, "w1"), 3, {1: ones, 2: two}))
        triples = three.join(least, "lang")
        maps["grow4"] = _set(triples.where("bound >= least"), "w1", "w2", "w3")
        maps["cover4"] = _set(triples.where("score >= least"), "w1", "w2", "w3")
        maps["ends4"] = _set(triples.where("bound >= least"), "w2", "w3")
        fours = tables.keep(_count(read, 4, maps).join(of_lang, "w1"))
        late = fours.where("w4 IS NULL").select("w1", "w2", "w3", "a")
        four = tables.keep(_cut(fours.where("w4 IS NOT NULL"), 4, {
            1: ones, 2: two, 3: three.select("w1", "w2", "w3", "a").unionByName(late)}))
        kept = _survive(pairs.where("score >= least"), 2, three).unionByName(
            _survive(triples.where("score >= least"), 3, fours.where("w4 IS NOT NULL")), allowMissingColumns=True).unionByName(
            four.join(least, "lang").where("score >= least"), allowMissingColumns=True)
        kept = tables.keep(kept.select("lang", *[f"w{k + 1}" for k in range(LONGEST)], "a", "l", "r", "score"))
        found = least.join(kept.groupBy("lang").agg(F.count("*").alias("c")), "lang", "left")
        settled = F.expr(f"least = 0 OR coalesce(c, 0) >= {TOP}")
        done.append(kept.join(found.where(settled).select("lang"), "lang", "left_semi"))
        going = tables.keep(found.where(~settled).select("lang"))
        if going.isEmpty():
            break
        depth *= LOWER

    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    # Ties of the last place stay until the phrases decide them.
    best = every.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(
        F.col("place") <= TOP)
    for k in range(LONGEST):
        best = best.join(words.select(F.col("w1").alias(f"w{k + 1}"), F.col("word").alias(f"t{k}")), f"w{k + 1}", "left")
    phrase = F.concat_ws(" ", *[f"t{k}" for k in range(LONGEST)])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = best.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= TOP)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
