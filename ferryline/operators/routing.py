"""Message routing, properties and headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.derived import filled_id, iso
from ferryline.operators.ranking import ROWS_PER_BUCKET, number_rows
from ferryline.schemas import BINDINGS, HIGH_PRIORITY_ABOVE, MAIN_EXCHANGE, MAX_PRIORITY, ROUTES
from ferryline.session import checkpointed

TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _routed(queue_type: Column, part: int) -> Column:
    usual = F.lit(ROUTES["processing"][part])
    return F.coalesce(*[F.when(queue_type == kind, route[part]) for kind, route in ROUTES.items()], usual)


def route_message(df: DataFrame) -> DataFrame:
    """Routing key, the queue named in the reply and the queue the message lands in.

    A priority above 5 sends the message to the priority queue; the reply still names the original one.
    """
    plain = _routed(F.col("queue_type"), 0)
    urgent = F.concat(F.lit("priority."), F.element_at(F.split(plain, "\\."), 2))
    key = F.when(F.col("priority") > HIGH_PRIORITY_ABOVE, urgent).otherwise(plain)
    return df.withColumns({
        "routing_key": key,
        "reported_queue": _routed(F.col("queue_type"), 1),
        "delivered_queue": F.get(matching_queues(key, BINDINGS), F.lit(0)),
    })


def _pattern_regex(pattern: str) -> str:
    """A topic pattern as a regular expression: ``*`` is one word, ``#`` any number of words."""
    out, words = "", pattern.split(".")
    words = [w for i, w in enumerate(words) if w != "#" or not i or words[i - 1] != "#"]  # a run of # says no more than one
    if words == ["#"]:
        return r"\A[\s\S]*\z"
    for i, word in enumerate(words):
        one = r"[^.]*" if word == "*" else "".join(f"\\{c}" if not c.isalnum() else c for c in word)
        if word != "#":
            glue = r"\." if i and words[i - 1] != "#" else ""
            out += glue + one
        elif i == 0:
            out += r"(?:[^.]*\.)*"
        elif i == len(words) - 1:
            out += r"(?:\.[^.]*)*"
        else:
            out += r"\.(?:[^.]*\.)*"
    return rf"\A{out}\z"


def matching_queues(key: Column, bindings: Sequence[tuple[str, str]]) -> Column:
    """The queues whose patterns match, each once. Bindings are configuration, so this is one expression."""
    hits = [F.when(key.rlike(_pattern_regex(pattern)), F.lit(queue)) for pattern, queue in bindings]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def topic_route(messages: DataFrame, bindings: Sequence[tuple[str, str]] = BINDINGS) -> DataFrame:
    """One row per message and queue it is delivered to; ``queue`` is null where no pattern matches.

    No join and no shuffle: the patterns are evaluated where the message is.
    """
    return messages.withColumn("queue", F.explode_outer(matching_queues(F.col("routing_key"), bindings)))


def _words(pattern: str) -> Column:
    """The words of a pattern; a run of ``#`` says no more than one."""
    words = F.split(F.col(pattern), "\\.")
    return F.filter(words, lambda w, i: (w != "#") | (i == 0) | (F.get(words, i - 1) != "#"))


def _trie(bindings: DataFrame) -> DataFrame:
    """Edges ``node, word, child`` of the words of all patterns; a node is the number and text of the words that lead to it."""
    words = bindings.select("pattern").distinct().select(_words("pattern").alias("w"))

    def name(w, count):
        return F.concat(count.cast("string"), F.lit(":"), F.array_join(F.slice(w, F.lit(1), count), "."))

    steps = words.select("w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("i"))
    return steps.select(
        name(F.col("w"), F.col("i")).alias("node"), F.get("w", F.col("i")).alias("word"), name(F.col("w"), F.col("i") + 1).alias("child")
    ).distinct()


def matching_bindings(keys: DataFrame, bindings: DataFrame) -> DataFrame:
    """``routing_key, queue`` of every binding ``pattern, queue`` that matches, each pair once, for a table of bindings.

    The patterns form a trie, and all distinct keys walk it together, a word a step: an equi-join with the edges of the
    node for the word itself and for ``*``. A node after ``#`` keeps what it holds, and is entered without a word as well.
    Work follows the edges that match, not keys times bindings. There are as many steps as the longest key has words, and
    each ends in a checkpoint, as the next one reads its states several times. Null keys and patterns match nothing.
    Bindings made more than once count once from the start, or every key would meet each of their copies.
    """
    known = checkpointed(bindings.where("pattern IS NOT NULL AND queue IS NOT NULL").select("pattern", "queue").distinct())
    edges = checkpointed(_trie(known))
    loops = edges.where("word = '#'").select("node", F.col("child").alias("any"))
    plain = edges.where("word <> '#'").select("node", "word", "child")
    walking = keys.where("routing_key IS NOT NULL").select("routing_key").distinct().withColumn("w", F.split("routing_key", "\\."))
    steps = walking.agg(F.max(F.size("w"))).first()[0] or 0

    def entered(states):
        further = states.join(loops, "node").select("routing_key", "w", F.col("any").alias("node"), F.lit(True).alias("free"))
        return states.select("routing_key", "w", "node", "free").unionByName(further).distinct()

    states = checkpointed(entered(walking.withColumns({"node": F.lit("0:"), "free": F.lit(False)})))
    ended = []
    for i in range(steps):
        ended.append(states.where(F.size("w") == i).select("routing_key", "node"))
        states = states.where(F.size("w") > i)
        # A word of a key that reads '#' is an ordinary one: no plain edge has it.
        heard = F.array_distinct(F.array(F.get("w", F.lit(i)), F.lit("*")))
        moved = states.select("routing_key", "w", "node", F.explode(heard).alias("word")).join(plain, ["node", "word"])
        moved = moved.select("routing_key", "w", F.col("child").alias("node"), F.lit(False).alias("free"))
        states = checkpointed(entered(moved.unionByName(states.where("free"))))
    ended.append(states.select("routing_key", "node"))
    reached = ended[0]
    for part in ended[1:]:
        reached = reached.unionByName(part)
    words = _words("pattern")
    ends = known.select(F.concat(F.size(words).cast("string"), F.lit(":"), F.array_join(words, ".")).alias("node"), "queue")
    return reached.join(ends, "node").select("routing_key", "queue").distinct()


def topic_route_table(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    """:func:`topic_route` for bindings in a table ``pattern, queue``: one row per message and queue, ``queue`` null where
    no pattern matches. Keys are matched once each, however many messages carry them.
    """
    return messages.join(matching_bindings(messages, bindings), "routing_key", "left")


def message_headers(df: DataFrame, as_of: Column) -> DataFrame:
    """Header map and expiration; needs ``batch_size``, ``priority``, ``queue_type`` and ``delay_ms``."""
    label = F.when(F.col("priority") > HIGH_PRIORITY_ABOVE, "high").otherwise("normal")
    headers = F.create_map(
        F.lit("batchSize"), F.col("batch_size").cast("string"),
        F.lit("source"), F.lit("queue-service"),
        F.lit("timestamp"), iso(as_of),
        F.lit("priority"), label,
        F.lit("queueType"), F.col("queue_type"),
        F.lit("x-published-at"), iso(as_of),
    )
    expiration = F.when(F.col("delay_ms") > 0, F.col("delay_ms").cast("string"))
    return df.withColumns({"headers": headers, "expiration": expiration})


def ensure_ids(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Fill blank or missing correlation and message ids, the same way on every run."""
    return df.withColumns({
        name: filled_id(F.col(name), F.col(key), seed, name) for name in ("correlation_id", "message_id")
    })


def publish_batches(
    batches: DataFrame, priority: int, queue_type: str, ttl_ms: int, as_of: Column, seed: int = 0
) -> DataFrame:
    """Batches as message rows: body text (an envelope), routing, ids, headers."""
    if not 0 <= priority <= MAX_PRIORITY:
        raise ValueError(f"priority must be between 0 and {MAX_PRIORITY}")
    metadata = F.struct(
        F.col("metadata.batch_size").alias("batchSize"),
        F.col("metadata.batch_number").alias("batchNumber"),
        F.col("metadata.total_batches").alias("totalBatches"),
        iso(as_of).alias("timestamp"),
    )
    body = F.struct(F.col("batch_id").alias("batchId"), "collection", "data", metadata.alias("metadata"))
    sized = batches.select(
        F.col("batch_id").alias("correlation_id"),
        F.lit(None).cast("string").alias("message_id"),
        F.lit(MAIN_EXCHANGE).alias("exchange"),
        F.lit(priority).alias("priority"),
        F.lit(queue_type).alias("queue_type"),
        F.lit(ttl_ms).cast("bigint").alias("delay_ms"),
        F.col("metadata.batch_size").alias("batch_size"),
        F.to_json(body, TIMES).alias("body"),
    )
    return ensure_ids(message_headers(route_message(sized), as_of), seed, "correlation_id")


def to_kafka_rows(messages: DataFrame) -> DataFrame:
    """Messages in the columns of Spark's Kafka sink; the queue becomes the topic."""
    headers = F.transform(
        F.map_entries("headers"),
        lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")),
    )
    return messages.select(
        F.col("delivered_queue").alias("topic"),
        F.col("correlation_id").alias("key"),
        F.col("body").alias("value"),
        headers.alias("headers"),
    )


def delivery_order(messages: DataFrame, queue: str = "queue_type", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Place of every message in its queue: higher priority first, then arrival.

    A handful of queues hold all rows, so the places are computed over (queue, bucket).
    """
    order = ["-priority", "published_at", "message_id"]
    return number_rows(messages, order, [queue], "delivery_position", rows_per_bucket)
