import math
import re
from collections import Counter

from llm.rows import WORD, documents, odd_documents
from pyspark.sql import functions as F

from ferryline.llm.quality import CHAR_CLASSES, COMMON_WORDS, QualityRules, keep_good, quality, quality_report
from ferryline.sources.collections import table


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if places[tuple(words[i:i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def histograms(text, lang):
    classes = [sum(c in chars for c in text) for chars in CHAR_CLASSES.values()]
    classes += [len(text) - sum(classes), len(text.encode()) - len(text)]
    words = WORD.findall(text)
    commons = [words.count(w) for w in COMMON_WORDS[lang]]
    return classes, commons + [len(words) - sum(commons)]


def distance(a, b):
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    kl = lambda u: sum(x * math.log2(x / ((y + z) / 2)) for x, y, z in zip(u, p, q) if x)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def middle(values):
    return sorted(values)[(len(values) - 1) // 2]


def references(docs):
    """By language and histogram: the median shares, the limit of the distance."""
    rules, found = QualityRules(), {}
    for lang in COMMON_WORDS:
        sources = {}
        for text, x, source in docs:
            if x == lang and len(WORD.findall(text or "")) >= rules.min_words:
                sources.setdefault(source, []).append(histograms(text, lang))
        hs = [h for held in sources.values() for h in held]
        if len(hs) < rules.min_reference:
            continue
        for kind, (least, most, deviations) in enumerate((rules.class_limit, rules.word_limit)):
            ref = [middle([middle([1000 * h[kind][i] // sum(h[kind]) for h in held]) for held in sources.values()])
                   for i in range(len(hs[0][kind]))]
            far = [int(10_000 * distance(h[kind], ref)) for h in hs]
            spread = middle([abs(x - middle(far)) for x in far])
            found[lang, kind] = ref, min(most, max(least, middle(far) + deviations * spread)) / 10_000
    return found


def test_report_equals_plain_python(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.collect()
    refs = references([(r.text, r.lang, r.source) for r in rows])
    assert refs
    rules = QualityRules()
    got = {r.doc_id: r for r in quality_report(docs, f"{tmp_path}/q", ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want, x = base(r.text), got[r.doc_id]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == want
        kept = not want[-1]
        if want[0] >= rules.min_words and (r.lang, 0) in refs:
            far = [distance(a, refs[r.lang, i][0]) for i, a in enumerate(histograms(r.text, r.lang))]
            assert abs(far[0] - x.class_distance) < 1e-9 and abs(far[1] - x.word_distance) < 1e-9
            kept = kept and all(d <= refs[r.lang, i][1] for i, d in enumerate(far))
        else:
            assert x.class_distance is None and x.word_distance is None
        assert x.kept == kept


def test_junk_goes_and_sound_documents_stay(spark, tmp_path):
    """By the labels: also where one source of menus holds a third of all rows."""
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents").where("lang IS NOT NULL")
    menu = F.concat_ws(" | ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("Home #"), (i + F.col("id")).cast("string"))))
    n = docs.count() // 2
    third = spark.range(n).select((F.col("id") + 10**9).alias("doc_id"), menu.alias("text"), F.lit("en").alias("lang"), F.lit("menus").alias("source"))
    labels = table(spark, folder, "labels")
    for name, rows in (("given", docs.select("doc_id", "text", "lang", "source")), ("menus", docs.select("doc_id", "text", "lang", "source").unionByName(third))):
        judged = quality_report(rows, f"{tmp_path}/{name}", ["doc_id"]).where("n_words >= 50 AND NOT base_failed")
        told = judged.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()
        share = {r.quality: r.share for r in told}
        assert share[1] >= 0.99 and share.get(0, 0) <= 0.1, (name, share)
        assert judged.where("doc_id >= 1000000000 AND kept").isEmpty()


def test_both_readings_agree(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    stored = {r.doc_id: tuple(r)[1:] for r in quality_report(docs, f"{tmp_path}/q", ["doc_id"]).collect()}
    inline = {r.doc_id: tuple(r.quality) for r in quality(docs, f"{tmp_path}/i").select("doc_id", "quality").collect()}
    assert stored == inline
    assert {r.doc_id for r in keep_good(docs, f"{tmp_path}/k").collect()} == {k for k, v in stored.items() if v[-1]}


def test_odd_rows(spark, tmp_path):
    docs = odd_documents(spark)
    judged = quality(docs, f"{tmp_path}/q").collect()
    assert len(judged) == docs.count()
    for r in judged:
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == base(r.text)
    assert keep_good(docs, f"{tmp_path}/k").columns == docs.columns
    assert quality(documents(spark, []), f"{tmp_path}/e").count() == 0


def test_repeats_overlap_and_lines(spark, tmp_path):
    texts = ["a b c d e f g h " * 3 + "x" * 5, "\n".join(["same line", "same line", " ", " ", "other"]), "a " * 9, "a b " * 40]
    got = quality(documents(spark, texts), f"{tmp_path}/q").select("doc_id", "quality.*").orderBy("doc_id").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got] == list(map(base, texts))
