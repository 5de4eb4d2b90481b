"""The operators of this package as queries on the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import hosts, lattice, token_files, warc
from ferryline.llm.decontamination import leaks
from ferryline.llm.jaccard import jaccard_groups
from ferryline.llm.odd_sketches import odd_sketch_groups
from ferryline.llm.oracles import ORACLES  # noqa: F401
from ferryline.llm.phrases import collocations
from ferryline.llm.pseudonyms import Key, pseudonymise
from ferryline.llm.quality import quality_report
from ferryline.llm.secrets import find_secrets, secret_report
from ferryline.llm.sharding import shard
from ferryline.llm.spelling import spelling_forms
from ferryline.session import work_folder
from ferryline.sources.collections import table

END_ID = 2


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def shared(spark: SparkSession, label: str) -> str:
    """A new folder that all executors reach; checkpoints go beside it where the session names no place for them."""
    folder = work_folder(spark, label)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{folder}-checkpoints")
    return folder


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality_rules(spark, folder):
    told = quality_report(table(spark, folder, "documents"), shared(spark, "quality"), ["doc_id"])
    return told.withColumns({n: F.round(n, 6) for n in ("class_distance", "word_distance")})


@query
def op2_sharding(spark, folder):
    shared(spark, "sharding")
    return shard(table(spark, folder, "documents"))


@query
def op3_token_files(spark, folder):
    home = shared(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), home, tokenizer_file("byte_bpe_50k.json"), END_ID)
    return token_files.read_tokens(spark, home)


@query
def op4_pii_pseudonyms(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonymise(docs, Key("production key from the caller's vault"))


@query
def op5_benchmark_decontamination(spark, folder):
    shared(spark, "decontamination")
    found = leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "found", "windows", "kind")


@query
def op6_warc_derivatives(spark, folder):
    records = warc.derive_records(table(spark, folder, "pages"), "2024-02-01T00:00:00Z").where("type <> 'response'")
    return records.withColumn("block", F.col("block").cast("string"))


@query
def op7_sentencepiece(spark, folder):
    """Ids of every document, and whether decoding them gives the text again."""
    model = tokenizer_file("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = lattice.encode(docs, shared(spark, "lattice"), model, stored=True, fold="merges")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return lattice.decode(encoded, model).select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", same.alias("round_trip"))


@query
def op8_ngram_jaccard_join(spark, folder):
    found = jaccard_groups(table(spark, folder, "documents"), shared(spark, "jaccard"), 4, 85)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op9_secret_scans(spark, folder):
    return secret_report(find_secrets(table(spark, folder, "documents")), ["doc_id"])


@query
def op10_url_filters(spark, folder):
    """Pages share their numbers with the labels; a page is bad if its label says low quality or toxic."""
    shared(spark, "hosts")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return hosts.judge_urls(table(spark, folder, "pages"), outcomes)


@query
def op11_odd_sketches(spark, folder):
    found = odd_sketch_groups(table(spark, folder, "documents"), shared(spark, "sketches"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op12_phrase_collocations(spark, folder):
    return collocations(table(spark, folder, "documents"), shared(spark, "phrases"))


@query
def op13_spelling_variants(spark, folder):
    return spelling_forms(table(spark, folder, "documents"), shared(spark, "spelling"))
