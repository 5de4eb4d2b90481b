"""SentencePiece encoding and decoding as a relational lattice.

The pieces of a model are a table. Every different word of the corpus gives its substrings up to the longest piece; an
equi-join with the pieces keeps the edges of its lattice, and a fold over the edges of a word, a higher-order ``aggregate``,
finds its path. For a unigram model that is the path of the highest sum of scores (``viterbi``). The scores of a BPE model
are no log probabilities but ranks of merges, and the path of the highest sum is not what such a model means; there the
fold joins the best pair of neighbours at a time along the same edges (``merges``), which gives the library's ids.

A word is a run of ``▁`` with what follows up to the next one. No piece has ``▁`` behind another character, so the best
path of a text is the best paths of its words. Each chunk of the documents, the part of a file that one task reads, gets
a dictionary of its own words, so no word that occurs often, and no text, is shuffled more than once a chunk.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm.columns import let, text_of, without

SPACE = "▁"
WORD = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
LONGEST_FOLDED = 1_000  # characters; the fold copies its state at every step, so longer words are walked in a task
UNKNOWN_PENALTY = 10.0
EDGES = "array<struct<cost:double,first:int,last:int>>"
PLACES = "array<struct<score:double,first:int,id:int>>"
HELD_WORDS = 200_000
SLICE = 256
PARTITIONS = 4


@dataclass(frozen=True)
class Pieces:
    """The pieces of a model; ``byte_ids`` by value, empty for a model without byte fallback."""

    rows: tuple[tuple[str, int, float], ...]
    texts: tuple[bytes, ...]
    byte_ids: tuple[int, ...]
    unknown: int
    longest: int
    lowest: float


@lru_cache(maxsize=2)
def read_pieces(model: str) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    rows, texts, byte_ids = [], [], {}
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
        else:
            rows.append((piece, i, float(sp.get_score(i))))
            texts.append(piece.encode())
    if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece, _, _ in rows):
        raise ValueError("a piece crosses words; texts cannot be cut into words for this model")
    return Pieces(tuple(rows), tuple(texts), tuple(byte_ids[b] for b in sorted(byte_ids)), sp.unk_id(),
                  max(len(p) for p, _, _ in rows), min(s for _, _, s in rows))


def piece_table(spark: SparkSession, pieces: Pieces, folder: str) -> DataFrame:
    """``piece, id, score`` as a stored table: as large as the model's vocabulary, whatever the corpus."""
    rows = pa.table({"piece": [r[0] for r in pieces.rows], "id": pa.array([r[1] for r in pieces.rows], pa.int32()),
                     "score": [r[2] for r in pieces.rows]})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{folder}/pieces")
    return spark.read.schema("piece string, id int, score double").parquet(f"{folder}/pieces")


def lattice_edges(words: DataFrame, table: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, first, last, id, score``: a row for every piece in a word, and for characters that no piece covers."""
    # Two plain explodes: generated code makes the substrings, where lambdas over arrays would be interpreted.
    starts = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("first"))
    longest = F.least(F.lit(pieces.longest), F.length("word") - F.col("first"))
    spans = starts.select("word", "first", F.explode(F.sequence(F.lit(1), longest)).alias("n"))
    substrings = spans.select("word", "first", (F.col("first") + F.col("n")).alias("last"),
                              F.substring("word", F.col("first") + 1, F.col("n")).alias("piece"))
    met = substrings.join(F.broadcast(table), "piece", "left")
    known = met.where("id IS NOT NULL OR last = first + 1")
    return known.select("word", "first", "last", F.coalesce("id", F.lit(-1)).alias("id"),
                        F.coalesce("score", F.lit(pieces.lowest - UNKNOWN_PENALTY)).alias("score"))


def best_path(edges: Column) -> Column:
    """The path of the highest sum of scores as structs ``score, first, id``; id -1 for an unknown character.

    ``edges`` come in the order of ``last``, then ``first``; of equal sums the earlier ``first`` stays. The state has the
    best way to every place so far: an edge opens the next place or improves the last one.
    """
    def step(best, e):
        score = F.get(best, e["first"])["score"] + e["score"]
        place = F.array(F.struct(score.alias("score"), e["first"].alias("first"), e["id"].alias("id")))
        at = F.size(best) - 1
        return F.when(e["last"] > at, F.concat(best, place)).when(
            score > F.get(best, at)["score"], F.concat(F.slice(best, 1, at), place)).otherwise(best)

    def traced(best):
        def hop(t, i):
            here = F.get(best, i)
            return F.when(t["at"] == i, F.struct(
                here["first"].alias("at"), F.concat(F.array(here), t["path"]).alias("path"))).otherwise(t)

        first = F.struct((F.size(best) - 1).alias("at"), F.array().cast(PLACES).alias("path"))
        return F.when(F.size(best) > 1, F.aggregate(
            F.sequence(F.size(best) - 1, F.lit(1), F.lit(-1)), first, hop, lambda t: t["path"]))

    origin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("first"), F.lit(-1).alias("id")))
    return F.aggregate(edges, origin, step, traced)


def merged_path(edges: Column, length: Column) -> Column:
    """The path that merging leaves, as structs ``first, id``: of all edges that join two neighbours, the one of the
    highest score is taken, the leftmost of equal ones, until none is left.

    The state has the end of the symbol that starts at each place (-1 inside a symbol) and the edges that may still come.
    """
    empty = F.array().cast(EDGES)

    def step(state, _):
        ends, live = state["ends"], state["live"]
        best = F.get(F.filter(live, lambda e: F.get(ends, F.get(ends, e["first"])) == e["last"]), F.lit(0))

        def joined(b):
            middle = F.get(ends, b["first"])
            after = F.transform(ends, lambda v, i: F.when(i == b["first"], b["last"]).when(i == middle, -1).otherwise(v))
            return let(after, lambda a: F.struct(a.alias("ends"), F.filter(
                live, lambda e: (F.get(a, e["first"]) >= 0) & (F.get(a, e["first"]) < e["last"]) & (F.get(a, e["last"]) >= 0)
            ).alias("live")))

        return F.when(F.size(live) == 0, state).otherwise(let(best, lambda b: F.when(b.isNull(), F.struct(
            ends.alias("ends"), empty.alias("live"))).otherwise(joined(b))))

    def symbols(state):
        starts = F.filter(F.sequence(F.lit(0), length - 1), lambda i: F.get(state["ends"], i) >= 0)
        return F.transform(starts, lambda i: F.struct(i.alias("first"), F.get(F.filter(
            edges, lambda e: (e["first"] == i) & (e["last"] == F.get(state["ends"], i))), F.lit(0))["id"].alias("id")))

    long = F.filter(edges, lambda e: e["last"] > e["first"] + 1)
    ranked = F.sort_array(F.transform(long, lambda e: F.struct(
        (-e["score"]).alias("cost"), e["first"].alias("first"), e["last"].alias("last"))))
    # The last place is past the end: it ends itself.
    ends = F.transform(F.sequence(F.lit(0), length), lambda i: F.least(i + 1, length))
    state = F.struct(ends.alias("ends"), ranked.alias("live"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(long), F.lit(1))), state, step, symbols)


def _with_bytes(path: Column, word: Column, pieces: Pieces) -> Column:
    """Ids of a path; an unknown character becomes its bytes, or the unknown id in a model without them."""
    if not pieces.byte_ids:
        return F.transform(path, lambda p: F.when(p["id"] < 0, pieces.unknown).otherwise(p["id"]))
    table = F.split(F.lit(",".join(map(str, pieces.byte_ids))), ",").cast("array<int>")

    def spelled(p):
        code = F.hex(F.encode(F.substring(word, p["first"] + 1, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda at: F.get(
            table, F.conv(F.substring(code, at, F.lit(2)), 16, 10).cast("int")))

    return F.flatten(F.transform(path, lambda p: F.when(p["id"] < 0, spelled(p)).otherwise(F.array(p["id"]))))


def _viterbi(word: str, pieces: Pieces, table: dict) -> list[tuple[int, int]]:
    best, back = [0.0], [(-1, 0)]
    for last in range(1, len(word) + 1):
        top = None
        for first in range(max(0, last - pieces.longest), last):
            found = table.get(word[first:last]) or ((-1, pieces.lowest - UNKNOWN_PENALTY) if first == last - 1 else None)
            if found and (top is None or best[first] + found[1] > top[0]):
                top = (best[first] + found[1], found[0], first)
        best.append(top[0])
        back.append(top[1:])
    path, at = [], len(word)
    while at:
        path.append((back[at][0], back[at][1]))
        at = back[at][1]
    return path[::-1]


def _merges(word: str, pieces: Pieces, table: dict) -> list[tuple[int, int]]:
    ends, starts = list(range(1, len(word) + 1)), list(range(-1, len(word)))  # of the symbol at a place, and before it
    heap: list[tuple[float, int, int, int]] = []

    def offer(first: int) -> None:
        middle = ends[first]
        if middle < len(word) and (found := table.get(word[first:ends[middle]])):
            heapq.heappush(heap, (-found[1], first, middle, ends[middle]))

    for first in range(len(word) - 1):
        offer(first)
    while heap:
        _, first, middle, last = heapq.heappop(heap)
        if ends[first] != middle or ends[middle] != last:
            continue
        ends[first], ends[middle], starts[last] = last, -1, first
        offer(first)
        if first:
            offer(starts[first])
    return [(table.get(word[i:end], (-1,))[0], i) for i, end in enumerate(ends) if end > 0]


def _walked(pieces: Pieces, fold: str):
    """Long words, one after the other: the same path by a plain walk, in memory in proportion to the word."""
    table = {piece: (i, score) for piece, i, score in pieces.rows}
    walk = {"viterbi": _viterbi, "merges": _merges}[fold]

    def ids(word: str) -> list[int]:
        found = walk(word, pieces, table)
        unknown = lambda c: [pieces.byte_ids[b] for b in c.encode()] if pieces.byte_ids else [pieces.unknown]
        return [i for piece, first in found for i in ([piece] if piece >= 0 else unknown(word[first]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column("word").to_pylist():
                yield pa.RecordBatch.from_pydict({"word": [word], "ids": pa.array([ids(word)], pa.list_(pa.int32()))})
    return run


def encode_words(words: DataFrame, table: DataFrame, pieces: Pieces, fold: str) -> DataFrame:
    """``word, ids`` of different words ``word, length``. Edges stay where their word is, so they need no shuffle."""
    short = words.where(F.col("length") <= LONGEST_FOLDED)
    edges = lattice_edges(short, table, pieces).groupBy("word").agg(F.sort_array(F.collect_list(
        F.struct("last", "first", "id", "score"))).alias("edges"))
    path = best_path(F.col("edges")) if fold == "viterbi" else let(
        F.col("edges"), lambda e: merged_path(e, F.length("word")))
    folded = edges.select("word", _with_bytes(path, F.col("word"), pieces).alias("ids"))
    long = words.where(F.col("length") > LONGEST_FOLDED).select("word")
    return folded.unionByName(long.mapInArrow(_walked(pieces, fold), "word string, ids array<int>"))


def shown(text: str | None) -> str:
    """Spaces as ``▁``, one more in front; an empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what is made of them stays small beside the texts."""
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE):
            yield batch.slice(low, SLICE)


def _words_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``chunk, word``: the words of a chunk, each once unless there are more than HELD_WORDS."""
    cut, held, seen = re.compile(WORD), None, set()

    def flush():
        words = pa.array(list(seen), pa.string())
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(held, pa.int64()), len(words)), words], ["chunk", "word"])

    for batch in batches:
        for chunk, text in zip(batch.column("chunk").to_pylist(), batch.column("text")):
            if seen and (chunk != held or len(seen) > HELD_WORDS):
                yield flush()
                seen = set()
            held = chunk
            seen.update(cut.findall(shown(text.as_py())))
    if seen:
        yield flush()


def _assembled(folder: str, width: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        held, ids = None, {}
        cut = re.compile(WORD)
        for batch in _slices(batches):
            out = []
            for chunk, text in zip(batch.column(names[1]).to_pylist(), batch.column(names[0])):
                if chunk != held:
                    held, ids = chunk, {}
                    path = f"{root}/chunk={chunk}"
                    if store.get_file_info(path).type != pafs.FileType.NotFound:
                        for part in pads.dataset(path, filesystem=store, format="parquet").to_batches(
                                columns=["word", "packed"], batch_readahead=1, fragment_readahead=1):
                            ids.update(zip(part.column("word").to_pylist(), part.column("packed").to_pylist()))
                packed = b"".join(map(ids.__getitem__, cut.findall(shown(text.as_py()))))
                out.append(np.frombuffer(packed, dtype=width))
            offsets = np.concatenate(([0], np.cumsum([o.size for o in out]))).astype(np.int32)
            flat = np.concatenate(out).astype(np.int32) if out else np.empty(0, np.int32)
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in names]
            kept = [n for n in batch.schema.names if n not in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*kept, names[2]])
    return run


def encode(docs: DataFrame, folder: str, model: str, text: str = "text", out: str = "ids", stored: bool = False,
           fold: str = "viterbi") -> DataFrame:
    """Every input row with an array ``out`` of piece ids. ``fold``: ``viterbi`` for unigram models, ``merges`` for BPE.

    ``folder``: a new one that all executors reach. ``stored``: the rows are a plain read of files; others are written
    first, as a chunk is known by its place in a file.

    Nulls: a null text has no ids, an empty array, as an empty one has. Repeated rows are encoded alike. Of paths of equal
    sums the one whose last pieces begin earlier is taken, of merges of equal scores the leftmost. ``▁`` in a text is a space to the model. An empty table gives
    an empty result. Other columns pass through, whatever their names; ``out`` must be a new name.
    """
    spark = docs.sparkSession
    if not stored:
        docs.write.parquet(f"{folder}/documents")
        docs = spark.read.schema(docs.schema).parquet(f"{folder}/documents")
    pieces = read_pieces(model)
    body, chunk, ids = without([*docs.columns, out], "body", "chunk", "ids")
    placed = docs.withColumn(body, text_of(text)).withColumn(chunk, F.xxhash64(F.input_file_name(), F.input_file_block_start()))

    # A word once for each chunk, written so that texts are cut once. The one exchange by word serves the lattice and the
    # words' chunks; its number of partitions is fixed, as the rows are few and small beside the work that they make, and
    # high enough for the edges of a partition's words to be sorted in memory.
    found = "chunk bigint, word string"
    cut = placed.select(F.col(chunk).alias("chunk"), F.col(body).alias("text")).mapInArrow(_words_once, found)
    cut.write.parquet(f"{folder}/words")
    partitions = PARTITIONS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = spark.read.schema(found).parquet(f"{folder}/words").where("word IS NOT NULL").repartition(partitions, "word")
    where = seen.groupBy("word", "chunk").agg(F.lit(1).alias("one")).drop("one")
    # What is asked of aggregates stays above the exchange, so that Spark sees it is the same for all.
    words = seen.groupBy("word").agg(F.min("chunk").alias("any"), F.max(F.length("word")).alias("length")).where("any IS NOT NULL")
    encoded = encode_words(words, piece_table(spark, pieces, folder), pieces, fold)
    narrow = len(pieces.texts) <= 2**16
    packed = F.unhex(F.array_join(F.transform("ids", lambda i: F.lpad(F.hex(i), 4 if narrow else 8, "0")), ""))
    entries = where.join(encoded, "word").select("chunk", "word", packed.alias("packed"))
    entries.repartition("chunk").write.partitionBy("chunk").parquet(f"{folder}/dictionary")
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    encoded = placed.mapInArrow(_assembled(f"{folder}/dictionary", ">u2" if narrow else ">u4", [body, chunk, ids]), f"{shape}, `{ids}` array<int>")
    return encoded.withColumnRenamed(ids, out)


def _spelled(texts: tuple[bytes, ...], ids: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = []
            for row in batch.column(ids):
                if not row.is_valid:
                    found.append(None)
                    continue
                spelled = b"".join(map(texts.__getitem__, row.values.to_pylist() if len(row) else ()))
                found.append(spelled.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" "))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, out])
    return run


def decode(encoded: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every input row with the text ``out`` of its ids; null ids give a null text. ``out`` must be a new name."""
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_spelled(read_pieces(model).texts, ids, out), f"{shape}, `{out}` string")
