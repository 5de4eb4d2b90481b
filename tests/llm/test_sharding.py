import hashlib
import zlib
from collections import defaultdict

import pytest
from llm.rows import documents, odd_documents

from ferryline.llm.queries import shared
from ferryline.llm.sharding import Cells, shard, smallest_capacity
from ferryline.sources.collections import table


def fewest(sizes, capacity):
    count, held = 1, 0
    for s in sizes:
        if held + s > capacity:
            count, held = count + 1, 0
        held += s
    return count


def check(docs, shards, spark):
    shared(spark, "shards")
    rows = shard(docs, shards).collect()
    texts = [(r.text or "").encode() for r in docs.collect()]
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len(t) + 1, zlib.crc32(t)) for t in texts)
    groups = defaultdict(int)
    for t in texts:
        groups[hashlib.md5(t).hexdigest()] += len(t) + 1
    sizes = [groups[k] for k in sorted(groups)]
    held, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[r.size, r.text_crc32].add(r.shard)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    if sizes:
        best = next(c for c in range(max(sizes), sum(sizes) + 1) if fewest(sizes, c) <= shards)
        assert max(held.values()) <= best
        return best, held
    return 0, held


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_capacity_is_smallest(spark, shards):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    best, _ = check(docs, shards, spark)
    groups = spark.createDataFrame(
        [(hashlib.md5(t.encode()).hexdigest(), (len(t.encode()) + 1) * n, n) for t, n in
         docs.groupBy("text").count().collect()], "digest string, bytes long, n long")
    cells = Cells(groups)
    assert smallest_capacity(cells, shards, max(r.bytes for r in groups.collect())) == best


def test_hot_group_few_groups_and_odd_rows(spark):
    _, held = check(documents(spark, ["the same"] * 300 + [f"text {i}" for i in range(300)]), 16, spark)
    assert max(held.values()) == 300 * 9  # the large group is alone; behind it in the order shards may stay empty
    check(documents(spark, ["a", "b", "b"]), 16, spark)
    check(odd_documents(spark), 4, spark)
    check(documents(spark, []), 16, spark)


def test_sizes_are_even(spark):
    _, held = check(documents(spark, [f"{i} " * (1 + i % 7) for i in range(4000)]), 16, spark)
    assert max(held.values()) - min(held.values()) < 200
