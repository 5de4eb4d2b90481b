"""Jaccard self-join of word shingle sets by vertical partitioning, and the groups that its links form.

The global order of all shingles is the order of their fingerprints, so each fragment of it is a range of values.

* Candidates. Two sets that link differ in at most ``k`` shingles, where ``k`` follows from their sizes. Sets of one
  length class are cut into more than ``k`` fragments, so two that link are equal in a whole fragment. A fragment that
  is not empty becomes a key; a set with too few such fragments also sends its empty ones. A shared passage does not
  make two sets equal in a fragment, as their own shingles fall into the same ranges.
* Bounds. A parity bitmap of each set tells of how many shingles two sets differ at least; candidates that differ in
  too many by that are none.
* Counting. Each candidate set is cut into ``FRAGMENTS`` ranges. The overlap of a pair is counted in every range by
  itself, and the counts are summed per pair.
* Large groups list no pairs: members are counted against a pivot, and what that leaves open goes on by differences from
  the pivot (``linked_sets``). No link between two components is lost.

Equal sets are one node from the start; copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.linked_sets import FRAGMENTS, Tables, settle
from ferryline.llm.shingles import mix, parity, set_key, shingle_set

KEYS_PER_BATCH = 500_000
BROADCAST_TEXTS = 200_000
BITMAP_WORDS = 1 << 18
_HIGH = np.uint64(32)


def length_classes(percent: int, longest: int) -> list[tuple[int, int]]:
    """Ranges of set sizes; sizes of two sets that link lie in one range or in neighbouring ones."""
    ranges, low = [], 1
    while low <= longest:
        following = low * 100 // percent + 1
        ranges.append((low, following - 1))
        low = following
    return ranges


def most_apart(percent: int, size: int) -> int:
    """The most shingles in which two sets of up to ``size`` shingles differ if they link."""
    return (100 - percent) * 2 * size // (100 + percent)


def fragment_keys(values: np.ndarray, percent: int) -> np.ndarray:
    """Keys of one sorted set for its own length class and, if it may link upwards, the next one."""
    found = []
    ranges = length_classes(percent, values.size * 100 // percent + 2)
    own = next(i for i, (low, high) in enumerate(ranges) if low <= values.size <= high)
    for number in (own, own + 1):
        low, high = ranges[number]
        if number > own and 100 * values.size < percent * low:
            continue
        apart = most_apart(percent, high)
        count = apart + 1 + (1 + apart // 16 if apart else 0)
        part = ((values >> _HIGH) * np.uint64(count)) >> _HIGH
        starts = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1))
        named = mix(part[starts] + np.uint64(number << 40))
        found.append(mix(np.add.reduceat(mix(values), starts) ^ named))
        if starts.size <= apart:
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), part[starts])
            found.append(mix(~mix(empty + np.uint64(number << 40))))
    return np.concatenate(found).view(np.int64)


def signatures(size: int):
    """``doc_id, text_key, node, n, parity``; parity is null where the batch has the set already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, parities = [], [], []
            held: set[int | None] = {None}
            for text in batch.column("text"):
                values = shingle_set(text.as_py(), size)
                nodes.append(set_key(values) if values.size else None)
                counts.append(values.size)
                parities.append(None if nodes[-1] in held else parity(values))
                held.add(nodes[-1])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                pa.array(parities, pa.list_(pa.int64()))], ["doc_id", "text_key", "node", "n", "parity"])
    return run


def once(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int | None, np.ndarray]]:
    """(node, smallest document id, set) of every different set in a batch: copies are dropped before the shuffle."""
    first: dict[int, int | None] = {}
    held: dict[int, np.ndarray] = {}
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        values = shingle_set(text.as_py(), size)
        if not values.size:
            continue
        node = set_key(values)
        if node not in held:
            held[node], first[node] = values, doc
        elif doc is not None and (first[node] is None or doc < first[node]):
            first[node] = doc
    for node, values in held.items():
        yield node, first[node], values


def _keys(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes, firsts, held = [], [], [], 0

            def flush():
                lengths = [len(k) for k in keys]
                return pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(nodes, dtype=np.int64), lengths)),
                    pa.array(firsts, pa.int64()).take(pa.array(np.repeat(np.arange(len(keys)), lengths))),
                ], ["key", "node", "first"])

            for node, first, values in once(batch, size):
                keys.append(fragment_keys(values, percent))
                nodes.append(node)
                firsts.append(first)
                held += keys[-1].size
                if held >= KEYS_PER_BATCH:
                    yield flush()
                    keys, nodes, firsts, held = [], [], [], 0
            if keys:
                yield flush()
    return run


def segments(size: int):
    """Rows ``node, n, pieces, copied`` of the different sets of a batch, each set in FRAGMENTS ranges of its sorted fingerprints."""
    cuts = (np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64(2**64 // FRAGMENTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, bool] = {}
            counts, pieces = [], []
            for text, copied in zip(batch.column("text"), batch.column("copied").to_pylist()):
                values = shingle_set(text.as_py(), size)
                node = set_key(values) if values.size else None
                if node is not None and node not in held:
                    held[node] = copied
                    counts.append(values.size)
                    pieces += np.split(values, np.searchsorted(values, cuts))
            if held:
                offsets = np.concatenate(([0], np.cumsum([p.size for p in pieces]))).astype(np.int32)
                inner = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(pieces).view(np.int64)))
                outer = pa.array(np.arange(len(held) + 1, dtype=np.int32) * FRAGMENTS)
                yield pa.RecordBatch.from_arrays([
                    pa.array(held.keys(), pa.int64()), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(outer, inner),
                    pa.array(held.values(), pa.bool_())], ["node", "n", "pieces", "copied"])
    return run


def signed_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text, text_key`` of the documents."""
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.withColumn("text_key", F.xxhash64("text"))


def first_rows(signed: DataFrame) -> DataFrame:
    """``node, first, text_key, copies``: the smallest id, one text and the number of rows of every set."""
    return signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.count("*").alias("copies"))


def _perhaps(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows whose ``text_key`` may be ``chosen``, by a bitmap of a fixed size that is broadcast.

    A false hit costs a row, and nothing is missed, so the texts of the others are not shuffled.
    """
    word, bit = (f"pmod({{0}}, {BITMAP_WORDS}L)", "CAST(shiftrightunsigned({0}, 40) & 63 AS INT)")
    bitmap = chosen.groupBy(F.expr(word.format("chosen")).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, {bit.format('chosen')}))").alias("bits"))
    met = rows.withColumn("word", F.expr(word.format("text_key"))).join(F.broadcast(bitmap), "word")
    return met.where(f"shiftright(bits, {bit.format('text_key')}) & 1 = 1").select(*rows.columns)


def sets_from(rows: DataFrame, firsts: DataFrame, size: int, tables: Tables):
    """The sets of asked nodes, made again from one text of each; a short list of texts is broadcast, of a long one a bitmap."""
    def sets_of(nodes: DataFrame) -> DataFrame:
        chosen = tables.keep(firsts.join(nodes, "node", "left_semi").select(
            F.col("text_key").alias("chosen"), (F.col("copies") > 1).alias("copied")))
        if chosen.count() <= BROADCAST_TEXTS:
            chosen, met = F.broadcast(chosen), rows
        else:
            met = _perhaps(rows, chosen)
        texts = met.join(chosen, F.col("text_key") == F.col("chosen")).select("text", "copied")
        # Only sets of several rows can come twice; the others are not written again.
        found = tables.keep(texts.mapInArrow(segments(size), "node bigint, n bigint, pieces array<array<bigint>>, copied boolean"))
        copied = tables.keep(found.where("copied").dropDuplicates(["node"]))
        return found.where("NOT copied").unionByName(copied).drop("copied")
    return sets_of


def named_rows(signed: DataFrame, firsts: DataFrame, labels: DataFrame, doc_id: str) -> DataFrame:
    """``doc_id, n_shingles, component_id, node, text_key`` of every document from the components of the nodes."""
    named = firsts.join(labels, "node", "left").select(
        "node", "first", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = named.join(smallest, "component").select("node", "component", "component_id")
    return signed.join(of_node, "node", "left").select(
        F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component", "text_key")


def jaccard_groups(
    docs: DataFrame, folder: str, size: int, percent: int, doc_id: str = "doc_id", text: str = "text",
    listed: tuple[int, int] | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, component, text_key`` for every row; sets link from a Jaccard similarity of
    ``percent`` / 100.

    ``component`` names the group also where no id does (null for a text without words); ``text_key`` is ``xxhash64`` of
    the text, so that rows which share an id can be told apart. ``listed``: up to how many members a group lists its
    pairs, ``linked_sets.LISTED`` by default; other values give the same result.

    Words are compared with A-Z as a-z. A text with fewer than ``size`` words is one shingle. ``folder``: a new one
    that all executors reach.

    Nulls: a null text is empty; texts without words have no shingles, link to nothing and are their own component. A
    null id takes part in links and never names a component; a component with null ids only is named null. Repeated
    rows are equal sets. Ties: the smallest id names a component. An empty table gives an empty result. Other columns
    are ignored, whatever their names.
    """
    tables = Tables(docs.sparkSession, folder)
    rows = signed_rows(docs, doc_id, text)
    told = tables.keep(rows.mapInArrow(
        signatures(size), "doc_id bigint, text_key bigint, node bigint, n bigint, parity array<bigint>"))
    signed = told.drop("parity")
    firsts = first_rows(signed)
    parities = told.where("parity IS NOT NULL").select("node", "n", "parity")
    groups = rows.select("doc_id", "text").mapInArrow(_keys(size, percent), "key bigint, node bigint, first bigint")
    labels = settle(groups, sets_from(rows, firsts, size, tables), percent, tables, listed, parities=parities)
    return named_rows(signed, firsts, labels, doc_id)
