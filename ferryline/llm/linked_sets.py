"""Components of linked sets from groups of candidates, exactly and without listing the pairs of large groups.

Groups are ``key, node, first``: two sets that link share a key. A group of few lists its pairs. A larger one is a star,
which falls into the parts between which parity bitmaps leave no link. In each, every member is counted against one pivot ``v``. With ``m`` shingles of ``v`` that a member lacks, ``b`` that it has
beyond ``v``, weight ``w = 100 m + percent b`` and limit ``t = (100 - percent) |v|``, two members link if and only if

    w(x) + w(y) <= t + (100 + percent) s,    s = shingles in which x and y differ from v alike.

So a member with ``w <= t`` links with the pivot itself, and a star whose members are one component by then is done. Of the
others, a link that the star does not show has an end ``y`` with ``w(y) > t``. Those ends are held against all members, in
blocks of up to ``MEMBERS`` members and ``DIFFERENCES`` differences a side, one task a block: bitmaps of the differences
rule out most, the closest of the rest are counted first, and members that are joined already are not counted at all.
A block gives back at most one link a member, so all is known after one turn, however large the star.

No link between two components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.shingles import MOST_BITS, folded, odd_bits, parity

FRAGMENTS = 4
LISTED = (2, 4)  # members up to which a group lists its pairs; the second number is of no use any more
HOPS = 1
MEMBERS = 4_096  # members and differences of one side of a block
COMPARED = 4_096  # members of a star whose bitmaps one task compares; of a larger one, of a side of a block
DIFFERENCES = 2_000_000
NEAREST = 8
BROADCAST_NODES = 200_000


# Spark's own setting: shuffle files of an execution go when it ends, not when the driver happens to collect garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Numbered Parquet tables below one shared folder, so that no lineage grows and lost executors cost little.

    A written table needs its shuffles no more, so their files are freed with it.
    """

    def __init__(self, spark, folder: str):
        self.spark, self.folder, self.count = spark, folder, 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path, before = f"{self.folder}/t{self.count}", self.spark.conf.get(FREED, None)
        self.spark.conf.set(FREED, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(FREED) if before is None else self.spark.conf.set(FREED, before)
        return self.spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``: large and small stars in turn, a table a turn.

    It ends when all edges lead from a node to its component: no node has two edges, none is at both ends.
    """
    def turned(df):
        return df.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()

    current = tables.keep(turned(edges))
    while True:
        ends = current.select(F.col("u").alias("x"), F.lit(1).alias("from"), F.lit(0).alias("to")).unionByName(
            current.select(F.col("v").alias("x"), F.lit(0).alias("from"), F.lit(1).alias("to")))
        open_ends = ends.groupBy("x").agg(F.sum("from").alias("from"), F.max("to").alias("to")).where("from > 1 OR from > 0 AND to > 0")
        if open_ends.isEmpty():
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = turned(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*")
        current = tables.keep(turned(small))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _merged(labels: DataFrame, links: DataFrame, tables: Tables) -> DataFrame:
    """The labels ``node, component`` after further links; only links between two components cost work."""
    of = labels.select("node", "component")
    ends = links.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    for end in ("a", "b"):
        named = of.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        ends = ends.join(named, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    between = tables.keep(ends.where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    if between.isEmpty():
        return labels
    joined = components(between, tables)
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("into"))
    return tables.keep(of.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
                       .unionByName(joined.join(of, "node", "left_anti")))


def _first_pairs(groups: DataFrame, tables: Tables, limit: int) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs ``pivot, node`` of the small groups, and the stars ``pivot, node`` of the others.

    The pivot is the node of the smallest id. ``HOPS`` times it gives way to the node that is its own pivot in most groups:
    whole groups move, so similar sets come to share one pivot and are counted once.
    """
    order = F.struct(F.coalesce("first", F.lit(2**63 - 1)).alias("first"), F.col("node").alias("node"))
    group = Window.partitionBy("key")
    # The exchange by key serves the grouping, the window and the lists of small groups.
    seen = groups.repartition("key").groupBy("key", "node").agg(F.min("first").alias("first"))
    sized = seen.select("key", "node", F.min(order).over(group).alias("p"), F.count("*").over(group).alias("c"))
    shared = tables.keep(sized.where("c > 1").select("key", "node", F.col("p.node").alias("pivot"), "c"))
    listed = shared.where(F.col("c") <= limit).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("l"))
    both = listed.select(F.explode(F.flatten(F.transform("l", lambda a, i: F.transform(
        F.slice("l", i + 2, F.size("l")), lambda b: F.struct(a.alias("pivot"), b.alias("node")))))).alias("x"))
    stars = tables.keep(shared.where(f"c > {limit} AND node <> pivot").groupBy("pivot", "node").agg(F.count("*").alias("keys")))
    leaders = stars.groupBy("node").agg(F.max_by("pivot", F.struct("keys", "pivot")).alias("leader"))
    leaders = leaders.select(F.col("node").alias("pivot"), "leader")
    # A pivot has a smaller id than the members of its group, so its own leader is never one of them.
    stars = stars.withColumn("least", F.col("pivot")).select("pivot", "node", "least")
    for _ in range(HOPS):
        moved = stars.join(leaders, "pivot", "left")
        stars = moved.select(F.coalesce("leader", "pivot").alias("pivot"), "node", "least")
    stars = stars.select("pivot", "node").unionByName(
        stars.where("pivot <> least").select("pivot", F.col("least").alias("node")))
    return both.select("x.*").distinct(), stars.where("pivot <> node").distinct()


def _may_link(odd: np.ndarray, n: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` and ``other`` shingles may link; they differ in ``odd`` at least."""
    return (100 + percent) * np.maximum(odd, np.abs(n - other)) <= (100 - percent) * (n + other)


def _likely(percent: int):
    """Rows ``pivot, node`` of those ``pivot, node, n, parity, n_pivot, of_pivot`` that may link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = np.zeros(batch.num_rows, np.int64)
            for i, (a, b) in enumerate(zip(batch.column("parity"), batch.column("of_pivot"))):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                words = min(a.size, b.size)
                odd[i] = odd_bits(folded(a, words) ^ folded(b, words))
            near = _may_link(odd, batch.column("n").to_numpy(), batch.column("n_pivot").to_numpy(), percent)
            yield batch.select(["pivot", "node"]).filter(pa.array(near))
    return run


def _parts(percent: int):
    """Rows ``pivot, node, star`` of the parts of a star, from ``node, n, parity`` of its members.

    Members that may link are joined. A part in which only one member may link with others is pairs; another one is a star
    around the member that may link with most.
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        bits = table.column("parity").combine_chunks()
        lengths, flat = bits.value_lengths().to_numpy(), bits.flatten().to_numpy()
        begins, words = np.cumsum(lengths) - lengths, lengths.min()
        held = np.stack([folded(flat[b:b + k], words) for b, k in zip(begins, lengths)])
        near = np.zeros((nodes.size, nodes.size), bool)
        for i in range(nodes.size - 1):
            near[i, i + 1:] = _may_link(odd_bits(held[i] ^ held[i + 1:]), n[i], n[i + 1:], percent)
        near |= near.T
        degree = near.sum(axis=1)
        pivots, others, stars = [], [], []
        while degree.any():
            pivot = int(degree.argmax())
            part, front = np.zeros(nodes.size, bool), near[pivot]
            while front.any():
                part |= front
                front = near[front].any(axis=0) & ~part
            star = bool(degree[part].sum() > 2 * degree[pivot])
            degree[part], part[pivot] = 0, False
            for node in nodes[part].tolist():
                pivots.append(int(nodes[pivot]) if star else min(int(nodes[pivot]), node))
                others.append(node if star else max(int(nodes[pivot]), node))
                stars.append(star)
        return pa.table({"pivot": pa.array(pivots, pa.int64()), "node": pa.array(others, pa.int64()), "star": pa.array(stars, pa.bool_())})
    return run


def _blocks(percent: int):
    """Rows ``node, other, degree`` of a block of a large star: edges that join what may link, and with how many a node may.

    A block is two chunks of members, or all within one chunk, from ``a, b, chunk, node, n, parity``.
    """
    def run(table: pa.Table) -> pa.Table:
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        chunk, first = table.column("chunk").to_numpy(), table.column("a")[0].as_py()
        inside = first == table.column("b")[0].as_py()
        bits = table.column("parity").combine_chunks()
        lengths, flat = bits.value_lengths().to_numpy(), bits.flatten().to_numpy()
        begins, words = np.cumsum(lengths) - lengths, lengths.min()
        held = np.stack([folded(flat[b:b + k], words) for b, k in zip(begins, lengths)])
        of, degree, edges = np.arange(nodes.size), np.zeros(nodes.size, np.int64), []
        others = np.flatnonzero(inside | (chunk != first))
        for i in np.flatnonzero(chunk == first):
            rest = others[others > i] if inside else others
            near = rest[_may_link(odd_bits(held[i] ^ held[rest]), n[i], n[rest], percent)]
            degree[i] += near.size
            degree[near] += 1
            for label, j in zip(*np.unique(of[near], return_index=True)):
                if label != of[i]:
                    edges.append((nodes[i], nodes[near[j]]))
                    of[of == label] = of[i]
        own = degree > 0
        return pa.table({
            "node": pa.array([a for a, _ in edges] + nodes[own].tolist(), pa.int64()),
            "other": pa.array([b for _, b in edges] + nodes[own].tolist(), pa.int64()),
            "degree": pa.array([0] * len(edges) + degree[own].tolist(), pa.int64())})
    return run


def _large_parts(stars: DataFrame, held: DataFrame, percent: int, tables: Tables) -> DataFrame:
    """Stars ``pivot, node`` around the nodes that may link with most, from large stars ``pivot, node, chunks``.

    The members of a star are dealt to chunks, and every two chunks are compared by a task of their own.
    """
    members = stars.unionByName(stars.select("pivot", F.col("pivot").alias("node"), "chunks").distinct()).join(held, "node")
    dealt = members.withColumn("chunk", F.expr("pmod(xxhash64(node), chunks)"))
    blocks = dealt.withColumn("with", F.explode(F.expr("sequence(0L, chunks - 1)"))).withColumns(
        {"a": F.least("chunk", "with"), "b": F.greatest("chunk", "with")})
    told = tables.keep(blocks.select("pivot", "a", "b", "chunk", "node", "n", "parity").groupBy("pivot", "a", "b").applyInArrow(
        _blocks(percent), "node bigint, other bigint, degree bigint"))
    parts = components(told.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")), tables)
    degrees = told.groupBy("node").agg(F.sum("degree").alias("degree"))
    named = tables.keep(parts.join(degrees, "node"))
    pivots = named.groupBy("component").agg(F.max_by("node", F.struct("degree", "node")).alias("pivot"))
    return named.join(pivots, "component").where("pivot <> node").select("pivot", "node")


def _bounded(
    pairs: DataFrame, stars: DataFrame, parities: DataFrame, percent: int, tables: Tables,
) -> tuple[DataFrame, DataFrame]:
    """The pairs that may link, and the stars in parts between which nothing may. Bitmaps are small beside their sets."""
    pairs, stars = tables.keep(pairs), tables.keep(stars)
    asked = pairs.select("pivot").union(pairs.select("node")).union(stars.select("pivot")).union(stars.select("node"))
    held = tables.keep(parities.join(asked.distinct().toDF("node"), "node", "left_semi").dropDuplicates(["node"]))
    of_pivot = held.select(F.col("node").alias("pivot"), F.col("n").alias("n_pivot"), F.col("parity").alias("of_pivot"))
    likely = pairs.join(of_pivot, "pivot").join(held, "node").mapInArrow(_likely(percent), "pivot bigint, node bigint")
    large = tables.keep(stars.groupBy("pivot").count().where(f"count >= {COMPARED}").select(
        "pivot", F.expr(f"CAST(ceil((count + 1) / {COMPARED}) AS BIGINT)").alias("chunks")))
    compared = stars.join(large, "pivot", "left_anti")
    members = compared.unionByName(compared.select("pivot", F.col("pivot").alias("node")).distinct()).join(held, "node")
    parts = tables.keep(members.groupBy("pivot").applyInArrow(_parts(percent), "pivot bigint, node bigint, star boolean"))
    whole = parts.where("star").drop("star")
    if not large.isEmpty():
        whole = whole.unionByName(_large_parts(stars.join(large, "pivot"), held, percent, tables))
    return likely.unionByName(parts.where("NOT star").drop("star")).distinct(), whole.distinct()


def _counted(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The overlap of every pair, counted fragment by fragment and summed; of stars also what differs, in one order."""
    pivots = pairs.select(F.col("pivot").alias("node")).distinct()
    if pivots.count() <= BROADCAST_NODES:
        pivots = F.broadcast(pivots)
    of_pivot = sets.join(pivots, "node", "left_semi").select(
        F.col("node").alias("pivot"), F.col("n").alias("n_pivot"), F.col("pieces").alias("held"))
    met = pairs.join(of_pivot, "pivot").join(sets.select("node", "n", "pieces"), "node")
    parts = [(F.col("pieces")[i], F.col("held")[i]) for i in range(FRAGMENTS)]
    overlap: Column = sum((F.size(F.array_intersect(a, b)) for a, b in parts), F.lit(0))
    apart = F.concat(*[F.array_except(a, b) for a, b in parts], *[F.array_except(b, a) for a, b in parts])
    counted = met.select("pivot", "node", "star", "n_pivot", "n", overlap.alias("common"), F.when(F.col("star"), apart).alias("apart"))
    return counted.withColumn("weight", F.expr(f"100L * (n_pivot - common) + {percent}L * (n - common)")).withColumn(
        "most", F.expr(f"{100 - percent}L * n_pivot"))


def _component(rows: DataFrame, labels: DataFrame, node: str, out: str) -> DataFrame:
    named = labels.select(F.col("node").alias(node), F.col("component").alias(out))
    return rows.join(named, node, "left").withColumn(out, F.coalesce(out, node))


def _unsettled(stars: DataFrame, labels: DataFrame) -> DataFrame:
    """``pivot, lightest, sides, asking`` of the stars with an open member: one that is in no component with the pivot.

    ``sides`` and ``asking`` are the numbers of chunks for all members, and for those that do not link with the pivot.
    """
    sizes = stars.select("pivot", "node", "weight", "most", F.size("apart").alias("size"))
    rows = _component(_component(sizes, labels, "node", "component"), labels, "pivot", "home")
    heavy = F.expr("weight > most")

    def chunks(members: Column, differences: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(members / MEMBERS), F.ceil(differences / DIFFERENCES)).cast("bigint")

    return rows.groupBy("pivot").agg(
        F.min(F.when(heavy & F.expr("component <> home"), F.col("weight"))).alias("lightest"),
        chunks(F.count("*"), F.sum("size")).alias("sides"),
        chunks(F.count(F.when(heavy, 1)), F.sum(F.when(heavy, F.col("size")))).alias("asking"),
    ).where("lightest IS NOT NULL")


def _dealt(rows: DataFrame, percent: int) -> DataFrame:
    """The members of stars ``lightest, sides, asking`` in blocks ``pivot, a, b``: ends that ask, and all that they may link with.

    With ``s`` shared differences a partner weighs ``percent s`` at least, so one that asks needs ``(w - t) / 100`` of
    them. Others need as many as a link with the lightest open member takes.
    """
    rows = rows.withColumn("asks", F.expr("weight > most")).where(
        f"size(apart) >= IF(asks, ceil((weight - most) / 100D), ceil((weight + lightest - most) / {100 + percent}D))")
    deal = "pmod(xxhash64(node), {0})"
    columns = ["pivot", "a", "b", "node", "weight", "most", "asks", "apart"]
    ends = rows.where("asks").withColumn("a", F.expr(deal.format("asking"))).withColumn("b", F.explode(F.expr("sequence(0L, sides - 1)")))
    others = rows.withColumn("b", F.expr(deal.format("sides"))).withColumn("a", F.explode(F.expr("sequence(0L, asking - 1)")))
    return ends.select(columns).unionByName(others.withColumn("asks", F.lit(False)).select(columns))


def _links_of(percent: int):
    """Rows ``pivot, node`` of links that join the members of a block, those that ask with the others."""
    def run(table: pa.Table) -> pa.Table:
        nodes, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        asks, most = table.column("asks").to_numpy(), table.column("most")[0].as_py()
        lists = table.column("apart").combine_chunks()
        sizes, flat = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy().view(np.uint64)
        begins = np.cumsum(sizes) - sizes
        width = min(MOST_BITS, max(64, 1 << int(8 * sizes.mean()).bit_length()))
        held = np.stack([parity(flat[b:b + k], width) for b, k in zip(begins, sizes)])
        # All that link with the pivot are one component, the others one a node; a node may be on both sides.
        of = np.where(weight <= most, -1, np.unique(nodes, return_inverse=True)[1])
        others, found = np.flatnonzero(~asks), []
        for i in np.flatnonzero(asks):
            # Of two that ask, the one of the larger number does.
            rest = others[(of[others] != of[i]) & ((weight[others] <= most) | (nodes[others] < nodes[i]))]
            odd = odd_bits(held[i] ^ held[rest])
            spare = most + (100 + percent) * ((sizes[i] + sizes[rest] - odd) // 2) - weight[i] - weight[rest]
            rest = rest[spare >= 0][np.argsort(-spare[spare >= 0], kind="stable")]
            own, taken = np.sort(flat[begins[i]:begins[i] + sizes[i]]), NEAREST
            while rest.size:
                some, rest, taken = rest[:taken], rest[taken:], 4 * taken
                values = np.concatenate([flat[begins[j]:begins[j] + sizes[j]] for j in some])
                hit = own[np.minimum(np.searchsorted(own, values), own.size - 1)] == values
                shared = np.bincount(np.repeat(np.arange(some.size), sizes[some]), weights=hit, minlength=some.size).astype(np.int64)
                for j in some[weight[i] + weight[some] <= most + (100 + percent) * shared]:
                    if of[j] != of[i]:
                        found.append((nodes[i], nodes[j]))
                        of[of == of[j]] = of[i]
                rest = rest[of[rest] != of[i]]
        return pa.table({"pivot": pa.array([a for a, _ in found], pa.int64()), "node": pa.array([b for _, b in found], pa.int64())})
    return run


def settle(
    groups: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, tables: Tables,
    listed: tuple[int, int] | None = None, likely: Callable[[DataFrame], DataFrame] | None = None,
    parities: DataFrame | None = None,
) -> DataFrame:
    """``node, component`` of the nodes that link, from groups ``key, node, first`` of candidates.

    ``sets_of(nodes)`` gives ``node, n, pieces`` of the asked nodes: every set cut into FRAGMENTS ranges of sorted
    fingerprints. ``likely`` may drop listed pairs ``pivot, node`` that cannot link, before they are counted.
    ``parities``: ``node, n, parity`` of the nodes, repeated or not; what they rule out is never counted.
    """
    pairs, stars = _first_pairs(groups, tables, (listed or LISTED)[0])
    if parities is not None:
        pairs, stars = _bounded(pairs, stars, parities, percent, tables)
    if likely is not None:
        pairs = likely(pairs)
    alone = pairs.join(stars, ["pivot", "node"], "left_anti").withColumn("star", F.lit(False))
    asked = tables.keep(alone.unionByName(stars.withColumn("star", F.lit(True))))
    if asked.isEmpty():
        return tables.keep(tables.spark.createDataFrame([], "node bigint, component bigint"))
    sets = sets_of(asked.select("pivot").union(asked.select("node")).distinct().toDF("node"))
    counted = tables.keep(_counted(asked, sets, percent))
    linked = counted.where("weight <= most")
    labels = tables.keep(components(linked.select(F.col("pivot").alias("a"), F.col("node").alias("b")), tables))
    # Where no star is open nothing is left to do.
    stars = tables.keep(_unsettled(counted.where("star"), labels))
    if stars.isEmpty():
        return labels
    blocks = _dealt(counted.where("star").join(stars, "pivot"), percent)
    links = blocks.groupBy("pivot", "a", "b").applyInArrow(_links_of(percent), "pivot bigint, node bigint")
    return _merged(labels, tables.keep(links), tables)
