import textwrap

from llm.rows import documents, odd_documents
from pyspark.sql import functions as F

from ferryline.llm import decontamination
from ferryline.llm.columns import words_of
from ferryline.llm.decontamination import leaks, without_leaks
from ferryline.llm.queries import shared
from ferryline.sources.collections import table

ITEM = "A train that left the station at 9 travels 120 miles toward Boston while another driver named Alice covers 45 km every 3 hours; " \
    "when will Alice reach Boston?"


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def test_exact_changed_and_chance(spark):
    shared(spark, "leaks")
    changed = ITEM.replace("Alice", "Bertha").replace("Boston", "Denver").replace("120", "350").replace("45", "62")
    mixed = ITEM.replace("named Alice", "named Bertha").replace("will Alice", "will Carol").replace("120 miles", "350 miles")
    filler = "and here is some other writing that has nothing to do with it at all"
    texts = [f"{filler} {ITEM} {filler}", f"{filler}. {changed} {filler}", f"{filler}. {mixed} {filler}", filler, None, "",
             " ".join(f"{w}&&&" for w in ITEM.upper().split()), ITEM[:60]]
    found = {r.doc_id: r.kind for r in leaks(documents(spark, texts), bench(spark, [ITEM, None, ""])).collect()}
    assert found == {0: "exact", 1: "reparameterised"}
    left = without_leaks(documents(spark, texts), bench(spark, [ITEM])).collect()
    assert {r.doc_id for r in left} == {2, 3, 4, 5, 6, 7}


def test_all_planted_passages_are_found(spark):
    shared(spark, "leaks")
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
        texts = {r.item_id: r.text for r in items.collect()}
        whole = {(d.doc_id, i) for d in docs.collect() for i, t in texts.items() if t in d.text}
        found = {(r.doc_id, r.item_id) for r in leaks(docs, items).collect()}
        assert found == whole


def test_odd_rows(spark):
    shared(spark, "leaks")
    docs = odd_documents(spark)
    assert leaks(docs, bench(spark, ["same words in here again and again"])).count() == 2
    assert without_leaks(docs, bench(spark, ["same words in here again and again"])).count() == docs.count() - 3
    assert without_leaks(docs, bench(spark, [])).count() == docs.count()
    assert without_leaks(docs, bench(spark, [])).columns == docs.columns
    assert leaks(documents(spark, []), bench(spark, [ITEM])).count() == 0


def test_every_occurrence_is_judged(spark):
    shared(spark, "leaks")
    one = ITEM.replace("Alice", "Bertha").replace("120", "350").replace("45", "62")
    two = ITEM.replace("Alice", "Carol").replace("120", "77").replace("45", "81")
    mixed = ITEM.replace("named Alice", "named Bertha").replace("will Alice", "will Carol").replace("120 miles", "350 miles")
    filler = "and here is some other writing that has nothing to do with it at all"
    stray = f"{filler} at 4 travels 99 miles {filler}"
    moved = one.replace("toward", "without any further stop toward")
    texts = [one, f"{one} {two}", " ".join([one, two] * 20), f"{filler}. {one} {stray}", f"{stray}. {two}", f"{mixed} {mixed}",
             f"{two} {ITEM}", f"{moved} {two}", f"{mixed} {filler} {one}", one[:90], f"{one[:90]} {filler * 9} {two[90:]}",
             one.replace("toward", f"{filler} {filler} toward")]
    found = {r.doc_id: r.kind for r in leaks(documents(spark, texts), bench(spark, [ITEM])).collect()}
    again = "reparameterised"
    assert found == {0: again, 1: again, 2: again, 3: again, 4: again, 6: "exact", 7: again, 8: again, 10: again, 11: again}


def test_case_line_breaks_first_names_passages_and_short_items(spark):
    shared(spark, "leaks")
    tom = "Tom has 12 apples and 3 green pears in the old basket. Tom gives 5 of them to the poor man at the gate"
    items = [ITEM, tom, "Who wrote Hamlet", "Add 3 to it"]
    filler = "and here is some other writing that has nothing to do with it at all"
    words = ITEM.split()
    texts = [ITEM.lower(), ITEM.replace(" Alice", "\nAlice").replace(" Boston", " \n Boston"), textwrap.fill(ITEM, 60), ITEM.title(),
             tom.replace("Tom", "Anna"), tom.replace("Tom", "Anna").replace("12", "31").replace(" 5 ", " 8 "),
             f"{filler} {' '.join(words[4:25])} {filler}", f"{filler} {' '.join(words[4:16])} {filler}",
             f"{filler}: who wrote Hamlet? {filler}", f"{filler} add 9 to it {filler}", f"{filler} who wrote Faust"]
    found = {(r.doc_id, r.item_id): r.kind for r in leaks(documents(spark, texts), bench(spark, items)).collect()}
    exact, again = "exact", "reparameterised"
    assert found == {(0, 0): exact, (1, 0): exact, (2, 0): exact, (3, 0): exact, (4, 1): again, (5, 1): again, (6, 0): exact,
                     (8, 2): exact, (9, 3): again, (10, 2): again}


def test_words_are_cut_without_a_lookup_of_every_character(spark):
    """The forms have the words that a search finds, and are made without character tables and searches for words."""
    texts = ["", " ", "a", " a  b ", "Dr. Who, 5 km\tfrom Bonn -- NATO 3.5", "--- ... !!!", "\u0001x\u0006 Ulm", "É É5 ÄB"]
    text = F.col("text")
    plain = decontamination._plain(text)
    for row in spark.createDataFrame([(t,) for t in texts], "text string").select(
            decontamination._words(plain).alias("cut"), words_of(plain).alias("found"), decontamination._forms(text).alias("f")).collect():
        assert row.cut == row.found
        assert len(row.f.inside) == len(row.f.all) == len(row.f.literal) == len(row.cut)
    plan = spark.createDataFrame([("a",)], "text string").select(decontamination._forms(text))._jdf.queryExecution().analyzed().toString()
    assert "translate(" not in plan and "regexp_extract_all(" not in plan


def test_places_of_changed_words_are_looked_up_once(spark):
    """Windows of several widths share the places in which two forms differ; values of slots stay with their windows."""
    def filters(short):
        return spark.range(1).select(decontamination.template_windows(F.lit(ITEM), short))._jdf.queryExecution().analyzed().toString().count("filter(")

    assert filters(()) == filters((2, 3))
    rows = spark.range(1).select(F.explode(decontamination._filled_windows(F.lit("at 5 km we saw Bob"), (3,))).alias("x")).select("x.*")
    values = {(r.form, r.i, len(r.v)): r.v for r in rows.collect()}
    assert values["inside", 0, 2] == ["5", "km"] and values["inside", 1, 3] == ["5", "km", "bob"]
    assert {size for form, _, size in values if form == "literal"} == {0}
