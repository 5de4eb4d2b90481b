"""Token ids in flat binary files.

A part of the collection is three files: ``.ids``, the ids of all its documents as little-endian unsigned integers of 16
bits (of 32 if the vocabulary needs them); ``.offsets``, 64-bit places in it where documents begin, and its end; ``.docs``,
64-bit document ids and a byte for each that is 1 where the id is null. Parts follow each other in ascending order of
documents. A manifest has a row for each part, and its base: the ids in all parts before it.

Tasks write under a name of their own attempt and then rename, so a repeated or doubled task leaves the same files.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.columns import text_of

CACHED_UNITS = 600_000
# Units of a text that the vocabulary's own pattern never matches across: a run of letters and digits before a mark or
# white space, other runs, and white space up to the space in front of a word.
UNIT = re.compile(r" ?[^\W_]+(?=[.,;:!?\s]|\Z)| ?\S+|\s+(?!\S)|\s+")
ODD_SPACE = re.compile("[\x1c-\x1f\x85]")  # white space to one of the two patterns only: such texts are one unit


class Encoder:
    """Ids of whole texts, by the tokenizers library; repeated units of a text are encoded once."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(model)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.line_end = self._ids(["\n"])[0].tolist()
        self.recent: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, units: set[str], odd: set[str]) -> None:
        """Units without white space but a space in front are encoded as lines of one text, which is cheaper than a call
        for each: a line end between them is a piece of its own."""
        lines = [u for u in units - odd if not u.isspace()] if len(self.line_end) == 1 else []
        if lines:
            (ids,) = self._ids(["\n".join(lines)])
            raw, cuts = ids.tobytes(), np.flatnonzero(ids == self.line_end[0])
            lows, highs = (4 * np.append(-1, cuts) + 4).tolist(), (4 * np.append(cuts, ids.size)).tolist()
            self.recent.update((unit, raw[low:high]) for unit, low, high in zip(lines, lows, highs))
        others = list(units.difference(lines))
        self.recent.update((u, ids.tobytes()) for u, ids in zip(others, self._ids(others)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        odd = {text for text in texts if ODD_SPACE.search(text)}
        cut = [[text] if text in odd else UNIT.findall(text) for text in texts]
        if len(self.recent) > CACHED_UNITS:
            self.known, self.recent = self.recent, {}
        missing = set().union(*cut).difference(self.recent)
        self.recent.update([(u, self.known[u]) for u in missing if u in self.known])
        self._fresh(missing.difference(self.known), odd)
        return [b"".join(map(self.recent.__getitem__, units)) for units in cut]


@lru_cache(maxsize=1)
def encoder(model: str) -> Encoder:
    return Encoder(model)


def _write(model: str, end_id: int, folder: str, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        drafts = {kind: f"{root}/draft-{part:06d}-{attempt}.{kind}" for kind in ("ids", "offsets", "docs")}
        offsets, docs, nulls, written, sink = [0], [], [], 0, None
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            if sink is None:
                store.create_dir(root, recursive=True)
                sink = store.open_output_stream(drafts["ids"])
            texts = batch.column("text")
            for low in range(0, batch.num_rows, 256):
                for ids in encoder(model).encode(texts.slice(low, 256).to_pylist()):
                    values = np.frombuffer(ids + end, dtype="<u4")
                    sink.write(values.astype(width).tobytes())
                    written += values.size
                    offsets.append(written)
            docs.append(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            nulls.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype("u1"))
        if sink is None:
            return
        sink.close()
        with store.open_output_stream(drafts["offsets"]) as out:
            out.write(np.array(offsets, dtype="<u8").tobytes())
        with store.open_output_stream(drafts["docs"]) as out:
            out.write(np.concatenate(docs).tobytes() + np.concatenate(nulls).tobytes())
        for kind, draft in drafts.items():
            store.move(draft, f"{root}/part-{part:06d}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": [part], "docs": [len(offsets) - 1], "ids": [written]})
    return run


def write_tokens(
    docs: DataFrame, folder: str, model: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all documents in ascending order of their id; returns the manifest ``part, docs, ids, base, width``.

    Nulls: a null text is empty, and has its end id only; null ids come first. Rows of equal id stand in the order of a
    hash of the text, then of the text, so an id that repeats spreads over parts. An empty table writes no part. Other
    columns are ignored, whatever their names. ``folder``: a new one that all executors reach, as a path or a URI.
    """
    spark = docs.sparkSession
    width = "<u2" if max(encoder(model).tokenizer.get_vocab_size(), end_id + 1) <= 2**16 else "<u4"
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    keyed = read.withColumn("key", F.xxhash64("text"))
    placed = keyed.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key", "text").drop("key")
    parts = placed.mapInArrow(_write(model, end_id, f"{folder}/parts", width), "part bigint, docs bigint, ids bigint")
    parts.write.parquet(f"{folder}/counts")
    # One row for each part file, not for each document.
    counts = spark.read.schema("part bigint, docs bigint, ids bigint").parquet(f"{folder}/counts")
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    manifest = counts.withColumn("base", F.coalesce(before, F.lit(0))).withColumn("width", F.lit(width))
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark, folder: str) -> DataFrame:
    return spark.read.schema("part bigint, docs bigint, ids bigint, base bigint, width string").parquet(f"{folder}/manifest")


def _opened(store: pafs.FileSystem, path: str) -> pa.Buffer:
    """A file's bytes: mapped where the store is a file system, read where it is not."""
    if isinstance(store, pafs.LocalFileSystem):
        with pa.memory_map(path) as mapped:
            return mapped.read_buffer()
    with store.open_input_file(path) as source:
        return source.read_buffer()


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{root}/part-{row['part']:06d}"
                offsets = np.frombuffer(_opened(store, f"{name}.offsets"), dtype="<u8").astype(np.int64)
                ids = np.frombuffer(_opened(store, f"{name}.ids"), dtype=row["width"])
                raw = _opened(store, f"{name}.docs")
                docs = np.frombuffer(raw, dtype="<i8", count=row["docs"])
                nulls = np.frombuffer(raw, dtype="u1", offset=8 * row["docs"]).astype(bool)
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=nulls), pa.array(row["base"] + offsets[:-1]), pa.array(np.diff(offsets)),
                     pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(spark, folder: str, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    manifest = read_manifest(spark, folder)
    parts = manifest.repartition("part")
    read = parts.mapInArrow(_read(f"{folder}/parts"), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return read.withColumnRenamed("doc_id", doc_id)
