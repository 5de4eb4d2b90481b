"""Quality rules: counts per document, and distance of its histograms from those of its language.

Every document gives two histograms: characters by class, and the common words of its language (with one bin for all
other words). The reference of a language has in each bin the median over its sources of the median share of their documents: a
document counts once however long it is, and a source once however many documents it has, so that junk does not move the
reference while most sources are mostly sound. A document whose histogram
lies further from its reference (Jensen-Shannon distance, base 2, 0 to 1) than the language's limit is not kept. The limit
is the median distance and some median deviations of it, between two bounds. Texts below ``min_words`` words say too little
about a distribution, and languages with fewer than ``min_reference`` longer texts have no measure, so neither is judged by
distance. Medians are exact: they are read off counts of shares in steps of 1/1,000 and distances in steps of 1/10,000.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from string import ascii_uppercase, digits

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.columns import let, text_of, total, windows, without, words_of

# The most frequent function words of each language, equally many for all.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se"],
}
# The characters of each class that is counted; besides, all others and UTF-8 bytes beyond one a character.
CHAR_CLASSES = {"upper": ascii_uppercase, "digit": digits, "mark": ".,;:!?'\"()-", "symbol": "#*$%&|<>"}
BLANK = r"\x20\x09-\x0D"
WINDOW = 8
SHARES, STEPS = 1_000, 10_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRules:
    """Jensen-Shannon distances in steps of 1/``STEPS``: ``(least, most, deviations)`` of the limit for each histogram."""

    base_min_words: int = 20
    max_repeat_percent: int = 30
    min_words: int = 50
    min_reference: int = 20
    class_limit: tuple[int, int, int] = (1_000, 2_000, 20)
    word_limit: tuple[int, int, int] = (2_000, 3_400, 6)
    common_words: Mapping[str, Sequence[str]] = field(default_factory=lambda: COMMON_WORDS)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more, each word once."""

    def covered(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda o: let(
            F.sort_array(F.array_compact(F.transform(o, lambda x, k: F.when(
                (F.get(o, k - 1)["h"] == x["h"]) | (F.get(o, k + 1)["h"] == x["h"]), x["i"])))),
            lambda starts: total(F.transform(starts, lambda s, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))).cast("bigint"))),
        ))

    return let(windows(words, WINDOW), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))


def _only(text: Column, chars: str) -> Column:
    """``text`` without all other characters; single characters match by one table lookup, ranges would not."""
    listed = "".join(c if c.isalnum() else f"\\{c}" for c in chars)
    return F.regexp_replace(text, f"[^{listed}]+", "")


def _histograms(text: Column, words: Column, language: Column, common: Mapping[str, Sequence[str]]) -> Column:
    """Struct of ``classes`` (the counts of CHAR_CLASSES, other characters, extra bytes) and ``commons`` (each listed
    word in lower case, and all other words). One pass leaves the few characters that the classes then look through."""
    counted = let(_only(text, "".join(CHAR_CLASSES.values())), lambda rest: F.concat(
        F.array(*[F.length(_only(rest, chars)).cast("bigint") for chars in CHAR_CLASSES.values()]),
        F.array((F.length(text) - F.length(rest)).cast("bigint"),
                (F.octet_length(text) - F.length(text)).cast("bigint")),
    ))
    forms = sorted({w for listed in common.values() for w in listed})
    lists = F.create_map(*[
        part for name, listed in common.items()
        for part in (F.lit(name), F.array(*[F.lit(w) for w in listed]))
    ])
    counts = let(F.filter(words, lambda w: w.isin(*forms)), lambda seen: F.transform(
        lists[language], lambda w: (F.size(seen) - F.size(F.array_remove(seen, w))).cast("bigint")))
    with_rest = let(counts, lambda c: F.concat(c, F.array(F.size(words) - total(c))))
    return F.struct(counted.alias("classes"), with_rest.alias("commons"))


def _language(lang: Column, common: Mapping[str, Sequence[str]]) -> Column:
    """The language judged by; null and unlisted languages are judged by no distance."""
    return F.when(lang.isin(*common), lang)


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts."""
    n, m = total(counts).cast("double"), total(reference).cast("double")

    def part(a, mean):
        return F.when(a > 0, a * F.log2(a / mean)).otherwise(F.lit(0.0))

    def bins(sums):
        return F.zip_with(counts, reference, lambda a, b: let(
            F.struct((a / sums["n"]).alias("p"), (b / sums["m"]).alias("q")),
            lambda x: let((x["p"] + x["q"]) / 2, lambda mean: part(x["p"], mean) + part(x["q"], mean))))

    divergence = let(F.struct(n.alias("n"), m.alias("m")), lambda s: total(bins(s), "double") / 2)
    return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def _medians(counted: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the lower median ``m`` of ``v``, from rows ``keys, v, c``: a value and how often it occurs."""
    place = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumns({"upto": F.sum("c").over(place), "all": F.sum("c").over(Window.partitionBy(*keys))})
    return upto.where("2 * upto >= all").groupBy(*keys).agg(F.min("v").alias("m"))


def language_references(counted: DataFrame, rules: QualityRules) -> DataFrame:
    """``language, ref_classes, ref_commons, class_limit, word_limit`` from rows ``language, source, h`` with the facts of documents.

    Windows see counts of shares and distances, whose number is bounded; documents are counted before they are shuffled.
    At most one row a listed language, with shares in steps of 1/``SHARES`` and limits in steps of 1/``STEPS``.
    """
    judged = counted.where("language IS NOT NULL").where(F.col("h.n_words") >= rules.min_words).select(
        "language", "source", "h.classes", "h.commons")
    classes = len(CHAR_CLASSES) + 2

    def shares(counts):
        return let(total(counts), lambda n: F.transform(counts, lambda c: F.floor(c * SHARES / n)))

    bins = judged.select("language", "source", F.posexplode(F.concat(shares(F.col("classes")), shares(F.col("commons")))).alias("bin", "v"))
    of_source = _medians(bins.groupBy("language", "source", "bin", "v").agg(F.count("*").alias("c")), "language", "source", "bin")
    middle = _medians(of_source.groupBy("language", "bin", F.col("m").alias("v")).agg(F.count("*").alias("c")), "language", "bin")
    sized = judged.groupBy("language").agg(F.count("*").alias("documents")).where(F.col("documents") >= rules.min_reference)
    listed = middle.groupBy("language").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("bin", "m"))), lambda x: x["m"]).alias("ref"))
    refs = listed.join(sized, "language").select(
        "language", F.slice("ref", 1, classes).alias("ref_classes"),
        F.slice("ref", classes + 1, F.size("ref") - classes).alias("ref_commons"))

    far = judged.join(F.broadcast(refs), "language")
    steps = F.array(*[F.floor(_distance(F.col(h), F.col(f"ref_{h}")) * STEPS) for h in ("classes", "commons")])
    counts = far.select("language", F.posexplode(steps).alias("kind", "v")).where("v IS NOT NULL").groupBy(
        "language", "kind", "v").agg(F.count("*").alias("c"))
    centre = _medians(counts, "language", "kind")
    apart = counts.join(F.broadcast(centre), ["language", "kind"]).groupBy(
        "language", "kind", F.abs(F.col("v") - F.col("m")).alias("d")).agg(F.sum("c").alias("c")).withColumnRenamed("d", "v")
    spread = _medians(apart, "language", "kind").withColumnRenamed("m", "s")
    least, most, deviations = (F.element_at(F.array(F.lit(a), F.lit(b)), F.col("kind") + 1)
                               for a, b in zip(rules.class_limit, rules.word_limit))
    limits = centre.join(F.broadcast(spread), ["language", "kind"]).select(
        "language", "kind", F.least(most, F.greatest(least, F.col("m") + deviations * F.col("s"))).alias("limit"))
    chosen = limits.groupBy("language").agg(*[
        F.max(F.when(F.col("kind") == i, F.col("limit"))).alias(f"{n}_limit") for i, n in enumerate(("class", "word"))])
    return refs.join(F.broadcast(chosen), "language")


def _facts(rules: QualityRules, text: str, lang: str) -> Column:
    body = text_of(text)
    language = _language(F.col(lang), rules.common_words)
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))
    symbol = list(CHAR_CLASSES).index("symbol")
    return let(words_of(body), lambda words: let(
        _histograms(body, words, language, rules.common_words), lambda h: F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.get(h["classes"], F.lit(symbol)).alias("n_symbols"),
            let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint")).alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            h["classes"].alias("classes"), h["commons"].alias("commons"),
        )))


def _verdict(f: Column, refs: Sequence[Column], rules: QualityRules) -> Column:
    classes, commons, class_limit, word_limit = refs
    measured = f["n_words"] >= rules.min_words
    far = F.struct(
        F.when(measured, _distance(f["classes"], classes)).alias("c"),
        F.when(measured, _distance(f["commons"], commons)).alias("w"),
    )
    failed = (f["n_words"] < rules.base_min_words) | (
        100 * f["n_repeat_words"] > rules.max_repeat_percent * f["n_words"])
    return let(F.struct(far.alias("far"), failed.alias("failed")), lambda x: F.struct(
        *[f[n].alias(n) for n in COUNTS],
        x["far"]["c"].alias("class_distance"), x["far"]["w"].alias("word_distance"),
        x["failed"].alias("base_failed"),
        (~x["failed"] & F.coalesce(x["far"]["c"] * STEPS <= class_limit, F.lit(True))
         & F.coalesce(x["far"]["w"] * STEPS <= word_limit, F.lit(True))).alias("kept"),
    ))


REFERENCE = ("ref_classes", "ref_commons", "class_limit", "word_limit")


def _counted(docs: DataFrame, folder: str, rules: QualityRules, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``key, language, source, h``: the facts of every row, read once and stored in ``folder``, some 200 bytes a document."""
    text, lang, source = names
    counted = docs.select(F.struct(F.lit(0).alias("_"), *keys).alias("key"), F.col(source).cast("string").alias("source"),
                          _language(F.col(lang), rules.common_words).alias("language"), _facts(rules, text, lang).alias("h"))
    counted.write.mode("overwrite").parquet(folder)
    return docs.sparkSession.read.schema(counted.schema).parquet(folder)


def quality(
    docs: DataFrame, folder: str, rules: QualityRules = QualityRules(), text: str = "text", lang: str = "lang", out: str = "quality",
    source: str = "source",
) -> DataFrame:
    """Every input row with a struct ``out``: the counts, both distances, ``base_failed`` and ``kept``.

    The texts are read twice, for the references and for the verdicts, and never shuffled. ``folder``: one that all
    executors reach.

    Nulls: a null text is empty, so it has no words and fails the base rules; a null or unlisted language has no
    reference, so its distances are null and only the base rules judge it; null sources are one source. Repeated rows are judged one by one. An
    empty table gives an empty result. Other columns pass through, whatever their names; ``out`` must be a new one.
    """
    names = without([*docs.columns, out], "language", *REFERENCE)
    stored = _counted(docs, folder, rules, (text, lang, source), [])
    refs = language_references(stored, rules).select("language", *REFERENCE).toDF(*names)
    language = _language(F.col(lang), rules.common_words)
    # One reference row for each listed language: a bound that does not grow with the documents.
    joined = docs.join(F.broadcast(refs), language == F.col(names[0]), "left")
    verdict = let(_facts(rules, text, lang), lambda f: _verdict(f, [F.col(n) for n in names[1:]], rules))
    return joined.withColumn(out, verdict).drop(*names)


def quality_report(
    docs: DataFrame, folder: str, keys: Sequence[str], rules: QualityRules = QualityRules(),
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``keys`` and the fields of ``quality``, reading the texts once. Same verdicts and rules for odd rows as ``quality``."""
    stored = _counted(docs, folder, rules, (text, lang, source), keys)
    joined = stored.join(F.broadcast(language_references(stored, rules)), "language", "left")
    verdict = _verdict(F.col("h"), [F.col(n) for n in REFERENCE], rules)
    return joined.select("key", verdict.alias("v")).select(*[f"key.{k}" for k in keys], "v.*")


def keep_good(
    docs: DataFrame, folder: str, rules: QualityRules = QualityRules(), text: str = "text", lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The rows whose verdict is ``kept``, with the input's columns."""
    (verdict,) = without(docs.columns, "verdict")
    return quality(docs, folder, rules, text, lang, verdict, source).where(F.col(f"{verdict}.kept")).select(*docs.columns)
