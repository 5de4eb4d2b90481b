"""Secret scans: fixed patterns, and strings whose characters look drawn at random.

Candidates for the second kind are runs of ``window`` or more characters of keys and hashes. A window of ``window``
characters slides along a run; the counts of its characters change by the one that enters and the one that leaves, and
with them the sum of ``c * log2(c)``, from which the Shannon entropy follows. The highest entropy of a run is held against
the limit of its character class. Runs on the allow list are no secrets; alphabets and stand-ins within a run are cut
out, and what is left is judged. What a pattern's span covers of a run is left out likewise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.columns import let, text_of, total

# The patterns of the base kinds, in their order, with the least length of the whole match or of group 2.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|""" \
    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-="


@dataclass(frozen=True)
class EntropyRules:
    """Limits in bits a character, by class: hex digits, one case with digits, mixed.

    ``allowed``: patterns of whole runs, or pieces, that are no secrets. ``cut``: what is taken out of a run before its
    pieces are judged, so that a secret beside it is seen.
    """

    window: int = 20
    hex_limit: float = 3.0
    single_case_limit: float = 3.5
    mixed_limit: float = 3.9
    allowed: Sequence[str] = (
        r"[A-Za-z]+",                                                              # words without digits
        r"[0-9]+",                                                                 # numbers
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",                     # UUIDs
        r"[A-Za-z]{1,20}([-_/][A-Za-z]{1,20}|[-_/][0-9]{1,4})+",                   # paths and slugs
    )
    cut: Sequence[str] = (
        r"0123456789|abcdefghijkl|ABCDEFGHIJKL",                                   # alphabets
        r"(?<![^/])[^/]*?(?i:example|placeholder|changeme|redacted)[^/]*",         # parts of a path that hold a stand-in
    )


def _located(text: Column, pattern: str) -> Column:
    """Structs ``start, end, value`` of all matches, in code points."""
    def run(x):
        gaps, found = x["gaps"], x["found"]
        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

        def step(state, hit, i):
            start = state["at"] + F.length(F.get(gaps, i))
            end = start + F.length(hit)
            return F.struct(end.alias("at"), F.concat(state["l"], F.array(
                F.struct(start.alias("start"), end.alias("end"), hit.alias("value")))).alias("l"))

        numbered = F.transform(found, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
        first = F.struct(F.lit(0).alias("at"), empty.alias("l"))
        return F.aggregate(numbered, first, lambda s, n: step(s, n["v"], n["i"]), lambda s: s["l"])

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(both, run)).otherwise(none)


def highest_entropy(run: Column, window: int) -> Column:
    """The highest Shannon entropy of any ``window`` characters of a run of ALPHABET, from incremental counts."""
    places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    zeros = F.array_repeat(F.lit(0), len(ALPHABET) + 1)

    def weight(c):
        return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    def moved(state, place, step):
        """One character in or out: its count and the sum of c * log2(c)."""
        count = F.get(state["counts"], place)
        return F.struct(
            F.transform(state["counts"], lambda c, k: F.when(k == place, c + step).otherwise(c)).alias("counts"),
            (state["sum"] + weight(count + step) - weight(count)).alias("sum"), state["low"].alias("low"))

    def fold(p):
        def step(state, i):
            entered = moved(state, F.get(p, i), F.lit(1))
            left = let(entered, lambda s: F.when(i >= window, moved(s, F.get(p, i - window), F.lit(-1))).otherwise(s))
            return let(left, lambda s: F.struct(
                s["counts"].alias("counts"), s["sum"].alias("sum"),
                F.when(i >= window - 1, F.least(s["low"], s["sum"])).otherwise(s["low"]).alias("low")))

        first = F.struct(zeros.alias("counts"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("low"))
        width = F.least(F.lit(window), F.size(p))
        lowest = F.aggregate(F.sequence(F.lit(0), F.size(p) - 1), first, step, lambda s: F.when(
            s["low"] < 1e9, s["low"]).otherwise(s["sum"]))
        return F.log2(width) - lowest / width

    return let(places, fold)


def _looks_random(run: Column, rules: EntropyRules) -> Column:
    """Whether a piece of a run is as random as a secret, apart from what the allow list knows."""
    limit = lambda v: F.when(v.rlike(r"^[0-9a-fA-F]+$"), rules.hex_limit).when(
        v.rlike("[a-z]") & v.rlike("[A-Z]"), rules.mixed_limit).otherwise(rules.single_case_limit)
    allowed, cut = "|".join(f"(^{p}$)" for p in rules.allowed), "|".join(f"({p})" for p in rules.cut)
    pieces = F.when(run.rlike(cut), F.split(run, cut, -1)).otherwise(F.array(run))
    return ~run.rlike(allowed) & F.exists(pieces, lambda v: (F.length(v) >= rules.window) & ~v.rlike(allowed) & (
        highest_entropy(v, rules.window) >= limit(v)))


def _outside(run: Column, base: Column, text: Column) -> Column:
    """The parts of a run that lie outside the sorted spans ``base``."""
    part = lambda a, b: F.struct(a.alias("start"), b.alias("end"), F.substring(text, a + 1, b - a).alias("value"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    met = F.filter(base, lambda o: (o["start"] < run["end"]) & (run["start"] < o["end"]))
    walked = F.aggregate(met, F.struct(run["start"].alias("at"), none.alias("l")), lambda s, o: F.struct(
        F.greatest(s["at"], o["end"]).alias("at"),
        F.when(o["start"] > s["at"], F.concat(s["l"], F.array(part(s["at"], o["start"])))).otherwise(s["l"]).alias("l")))
    rest = let(walked, lambda s: F.when(s["at"] < run["end"], F.concat(s["l"], F.array(part(s["at"], run["end"])))).otherwise(s["l"]))
    return F.when(F.size(met) == 0, F.array(run)).otherwise(rest)


def _random_runs(text: Column, base: Column, rules: EntropyRules) -> Column:
    """Runs of ``window`` characters or more, without what the spans ``base`` cover of them, that look random."""
    runs = _located(text, rf"[A-Za-z0-9+/_=-]{{{rules.window},}}")
    parts = F.flatten(F.transform(runs, lambda r: _outside(r, base, text)))
    return F.filter(parts, lambda r: (F.length(r["value"]) >= rules.window) & _looks_random(r["value"], rules))


def _spans(text: Column, rules: EntropyRules) -> Column:
    """Structs ``start, rank, end`` of all spans; entropy spans lie outside those of the patterns."""
    def kind(found, rank):
        return F.transform(found, lambda r: F.struct(
            r["start"].alias("start"), F.lit(rank).alias("rank"), r["end"].alias("end")))

    assigned = F.filter(_located(text, ASSIGN), lambda r: F.length(F.regexp_extract(r["value"], ASSIGN, 2)) >= 8)
    base = F.concat(kind(assigned, 0), kind(_located(text, ACCESS), 1), kind(_located(text, HEX), 2))
    return let(F.sort_array(base), lambda b: F.sort_array(F.concat(b, kind(_random_runs(text, b, rules), 3))))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", rules: EntropyRules = EntropyRules()) -> DataFrame:
    """Every input row with an array ``out`` of structs ``start, rank, end``: code points, end exclusive, rank in KINDS.

    Nulls: a null text is empty and has no spans, an empty array. Repeated rows are scanned one by one. Matches of
    several kinds at one place are all kept, in the order of KINDS. An empty table gives an empty result. Other columns
    pass through; ``out`` must be a new name.
    """
    return docs.withColumn(out, let(text_of(text), lambda t: _spans(t, rules)))


def secret_report(found: DataFrame, keys: Sequence[str], out: str = "secrets") -> DataFrame:
    """``keys``, counts by kind, the SHA-256 of the base spans as text, and all spans as text."""
    def of_kind(rank):
        return F.size(F.filter(F.col(out), lambda s: s["rank"] == rank)).cast("bigint").alias(f"n_{KINDS[rank]}")

    base = F.filter(F.col(out), lambda s: s["rank"] < 3)
    counts = [of_kind(rank) for rank in range(len(KINDS))]
    return found.select(*keys, *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col(out)).alias("spans"))


def redact_secrets(docs: DataFrame, text: str = "text", rules: EntropyRules = EntropyRules()) -> DataFrame:
    """The documents with every span (overlapping ones as one) replaced by ``[SECRET]``; null texts stay null."""
    def masked(x):
        t, spans = x["t"], x["s"]
        kept = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("done")), lambda a, s: F.when(
            s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(
                a["done"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.lit("[SECRET]")).alias("done"))
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["done"].alias("done"))))
        return F.when(F.size(spans) == 0, t).otherwise(let(kept, lambda k: F.concat(
            k["done"], F.substring(t, k["at"] + 1, F.length(t)))))

    with_spans = F.struct(F.col(text).alias("t"), let(text_of(text), lambda t: _spans(t, rules)).alias("s"))
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), let(with_spans, masked))).select(*docs.columns)
