"""Near-duplicate groups by MinHash bands, verified first by odd sketches and then on the whole sets.

``BANDS * ROWS`` MinHash samples of a set give ``BANDS`` keys. The same samples are folded into a parity bitmap: sample
``i`` flips the bit that a hash of ``i`` and its value names. Equal samples of two sets cancel, so the number of odd bits
of the XOR of two bitmaps tells how many samples differ, most precisely where few do.

* Candidates are groups of equal band keys. At a similarity of 0.85 a pair misses all bands in 1 of 25 million cases.
* A small group lists its pairs, and a pair is dropped whose bitmaps estimate a similarity more than ``MARGIN`` below
  the threshold, six standard deviations or more. Large groups list none; their members are counted against a pivot.
* The parity bitmap of a whole set bounds the differences of two sets; candidates beyond the threshold by that are none.
* What is left is counted on the whole sets, and what a pivot leaves open goes on as in ``linked_sets``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.jaccard import first_rows, named_rows, sets_from, signed_rows
from ferryline.llm.linked_sets import Tables, settle
from ferryline.llm.shingles import mix, parity, set_key, shingle_set

BANDS, ROWS = 36, 6
SAMPLES = BANDS * ROWS
SKETCH = 512
MARGIN = 0.2

_DRAW = np.random.Generator(np.random.PCG64(20240603))
_XOR = _DRAW.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_ODD = _DRAW.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLACE = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))


def samples(values: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set of fingerprints."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 2**32 - 1, np.uint32)
    for start in range(0, short.size, 2048):
        part = short[start:start + 2048]
        np.minimum(least, ((part[None, :] ^ _XOR[:, None]) * _ODD[:, None]).min(axis=1), out=least)
    return least


def band_keys(drawn: np.ndarray) -> np.ndarray:
    rows = drawn.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def odd_sketch(drawn: np.ndarray) -> np.ndarray:
    """The parity bitmap of the samples, as ``SKETCH / 64`` integers."""
    bits = (mix(drawn.astype(np.uint64) ^ _PLACE) % np.uint64(SKETCH)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=SKETCH) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def similarity(odd_bits: np.ndarray) -> np.ndarray:
    """The estimate for pairs whose bitmaps differ in so many bits; half of the bits odd, or more, say nothing: 0."""
    share = np.minimum(2 * odd_bits / SKETCH, 1 - 1e-9)
    return np.maximum(0, 1 + SKETCH / (4 * SAMPLES) * np.log(1 - share))


def most_odd(least: float) -> int:
    """The largest number of odd bits at which the estimate is still ``least`` or more."""
    return math.floor(SKETCH / 2 * (1 - math.exp(4 * SAMPLES / SKETCH * (least - 1))))


def _signed(size: int):
    """``doc_id, text_key, node, n, bands, sketch, parity``; the last three are null where the batch has the set already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, bands, sketches, parities = [], [], [], [], []
            held: set[int] = set()
            for text in batch.column("text"):
                values = shingle_set(text.as_py(), size)
                node = set_key(values) if values.size else None
                nodes.append(node)
                counts.append(values.size)
                new = node is not None and node not in held
                if new:
                    held.add(node)
                    drawn = samples(values)
                    bands.append(band_keys(drawn))
                    sketches.append(odd_sketch(drawn))
                    parities.append(parity(values))
                else:
                    bands.append(None)
                    sketches.append(None)
                    parities.append(None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "node", "n", "bands", "sketch", "parity"])
    return run


def likely_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs ``pivot, node`` whose bitmaps do not rule out a link."""
    of_pivot = sketches.select(F.col("node").alias("pivot"), F.col("sketch").alias("other"))
    met = pairs.join(of_pivot, "pivot").join(sketches, "node")
    odd = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("other")[i])) for i in range(SKETCH // 64)), F.lit(0))
    return met.where(odd <= most_odd(percent / 100 - MARGIN)).select("pivot", "node")


def odd_sketch_groups(
    docs: DataFrame, folder: str, size: int = 5, percent: int = 85, doc_id: str = "doc_id", text: str = "text",
    listed: tuple[int, int] | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, component, text_key`` for every row.

    Sets of ``size``-word shingles link from a Jaccard similarity of ``percent`` / 100, confirmed on the whole sets;
    ``component_id`` is the smallest id that links reach, and ``kept`` tells whether the row has that id. ``component`` names
    the group also where no id does, ``text_key`` is ``xxhash64`` of the text.

    Words are compared with A-Z as a-z; a text with fewer words is one shingle. Nulls: a null text is empty; texts
    without words link to nothing and are their own component. A null id takes part in links, names no component and is
    kept only where its component has no id. Repeated rows are equal sets and share id and verdict. Ties: the smallest
    id. An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    tables = Tables(docs.sparkSession, folder)
    rows = signed_rows(docs, doc_id, text)
    signed = tables.keep(rows.mapInArrow(
        _signed(size), "doc_id bigint, text_key bigint, node bigint, n bigint, bands array<bigint>, sketch array<bigint>, parity array<bigint>"))
    firsts = first_rows(signed)
    groups = signed.select(F.explode("bands").alias("key"), "node", F.col("doc_id").alias("first"))
    sketches = signed.where("sketch IS NOT NULL").select("node", "sketch").dropDuplicates(["node"])
    parities = signed.where("parity IS NOT NULL").select("node", "n", "parity")
    labels = settle(groups, sets_from(rows, firsts, size, tables), percent, tables, listed,
                    likely=lambda pairs: likely_pairs(pairs, sketches, percent), parities=parities)
    named = named_rows(signed.select("doc_id", "text_key", "node", "n"), firsts, labels, doc_id)
    return named.withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id"))).select(
        doc_id, "n_shingles", "component_id", "kept", "component", "text_key")
