"""Benchmark decontamination by templates.

A text becomes a template: its words without punctuation, in lower case, with numbers, names and units of measure as
typed slots. Three forms stand side by side: names are capitalised words inside sentences (``INSIDE``), or all capitalised
words (``ALL``), or nothing is a slot (``LITERAL``; words all in capitals stay apart from others there: US, us). Windows of
five words of an item are looked up among the windows of every document, shorter items by windows of their own length.
Where a document holds four fifths of an item's windows, or ``RUN`` words of it in one piece, the values in its slots
decide: the item's own values make an ``exact`` leak; other values are a ``reparameterised`` question if each value of the
item has one counterpart throughout; otherwise the likeness of the template is a coincidence. This is judged for the
document as a whole and for every occurrence of the item in it; one that passes makes the leak.
"""

from __future__ import annotations

from string import punctuation

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.columns import let, text_of, without

WINDOW = 5
SHARE = 0.8
RUN = 20
BROADCAST_WINDOWS = 1_000_000
BROADCAST_ROWS = 200_000
# Units of measure that may follow a number.
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "min", "h", "hr", "hrs", "mph", "kmh", "hz",
    "khz", "mhz", "w", "kw", "kwh", "v", "a", "j", "kj", "n", "pa", "kpa", "bar", "inch", "inches", "foot", "feet", "ft",
    "yard", "yards", "mile", "miles", "ounce", "ounces", "oz", "pound", "pounds", "lb", "lbs", "gallon", "gallons",
    "litre", "litres", "liter", "liters", "metre", "metres", "meter", "meters", "gram", "grams", "second", "seconds",
    "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "degree",
    "degrees", "percent", "cent", "cents", "dollar", "dollars", "euro", "euros", "usd", "eur", "gbp",
)
NAME_MARK, NUMBER_SLOT, NAME_SLOT, UNIT_SLOT = "\u0001", "\u0002", "\u0003", "\u0004"
HEAD_MARK, CAPITALS_MARK = "\u0005", "\u0006"
SLOTS = (NUMBER_SLOT, NAME_SLOT, UNIT_SLOT)
MARKS = "[\u0001-\u0006]+"
FORMS = INSIDE, ALL, LITERAL = "inside", "all", "literal"
# Single characters match by one table lookup, ranges would not.
ASCII_PUNCTUATION = "[" + "".join(f"\\{c}" for c in punctuation) + "]+"


def _plain(text: Column) -> Column:
    """Words without punctuation, one space between them. Capitalised words carry a mark in front, one inside a sentence
    and another elsewhere; words of two and more letters that are all capitals also one behind.

    Patterns begin with the character they look for and look around from there, so that each pass is a plain scan.
    """
    clean = F.when(text.rlike(MARKS), F.regexp_replace(text, MARKS, "")).otherwise(text)
    spaced = F.regexp_replace(clean, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")
    marked = F.regexp_replace(spaced, r"\x20(?<=[\p{Ll}\p{N},;]\x20)(?=\p{Lu})", f" {NAME_MARK}")
    joined = F.regexp_replace(marked, r"[.,](?<=[0-9][.,])(?=[0-9])", "")
    ascii_only = F.regexp_replace(joined, ASCII_PUNCTUATION, "")
    bare = F.regexp_replace(ascii_only, r"[^\x00-\x7F\p{L}\p{N}]+", "")
    heads = F.regexp_replace(bare, r"\p{Lu}(?<![^\x20]\p{Lu})", f"{HEAD_MARK}$0")
    return F.regexp_replace(heads, rf"[{NAME_MARK}{HEAD_MARK}]\p{{Lu}}{{2,}}(?!\S)", f"$0{CAPITALS_MARK}")


def _without_marks(text: Column, *marks: str) -> Column:
    """``replace`` compares bytes, where ``translate`` would look up every character."""
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def _words(plain: Column) -> Column:
    """The words of a text that has spaces only between them."""
    return F.array_remove(F.split(plain, " "), "")


def _forms(text: Column) -> Column:
    """Struct of the words of a text in each of FORMS, all of one length."""
    def numbered(p):
        numbers = F.regexp_replace(p, r"\b[0-9]+\b", NUMBER_SLOT)
        return F.regexp_replace(numbers, rf"{NUMBER_SLOT}\x20(?i:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"{NUMBER_SLOT} {UNIT_SLOT}")

    def named(units, marks, *left):
        slots = F.regexp_replace(units, rf"[{marks}]\p{{L}}+{CAPITALS_MARK}?", NAME_SLOT)
        return _words(F.lower(_without_marks(slots, *left, CAPITALS_MARK)))

    def run(p):
        literal = _words(F.lower(_without_marks(p, NAME_MARK, HEAD_MARK)))
        units = F.when(p.rlike("[0-9]"), numbered(p)).otherwise(p)
        return let(F.struct(units.alias("u"), literal.alias("l")), lambda x: F.struct(
            named(x["u"], NAME_MARK, HEAD_MARK).alias(INSIDE), named(x["u"], NAME_MARK + HEAD_MARK, HEAD_MARK).alias(ALL), x["l"].alias(LITERAL)))

    return let(_plain(text), run)


def _word_hashes(x: Column) -> Column:
    """Struct of the hashes of the words of a text in each of FORMS."""
    return F.struct(*[F.transform(x[f], lambda w: F.xxhash64(w)).alias(f) for f in FORMS])


def _hashes(h: Column) -> Column:
    """Hash of every template window, from word hashes; a shorter text is one window, none without words."""
    return F.when(F.size(h) >= WINDOW, _runs(h, WINDOW)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
        F.array().cast("array<bigint>"))


def _runs(h: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` word hashes, of which there are so many at least."""
    return F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))


def _short_hashes(h: Column, width: int) -> Column:
    """As ``_hashes`` for items of ``width`` words, fewer than a window has."""
    return F.when(F.size(h) >= width, _runs(h, width)).otherwise(F.array().cast("array<bigint>"))


def _changed(h: Column, other: Column, widths: tuple[int, ...]) -> Column:
    """Hashes of the runs of ``widths`` words in which two forms of one text differ, from the word hashes of both."""
    def hashed(places, width):
        starts = F.array_distinct(F.flatten(F.transform(places, lambda k: F.sequence(
            F.greatest(F.lit(0), k - (width - 1)), F.least(k, F.size(h) - width)))))
        runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
        return F.when(F.size(h) >= width, runs).otherwise(F.array().cast("array<bigint>"))

    places = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda k: F.get(h, k) != F.get(other, k))
    return let(places, lambda x: F.concat(*[hashed(x, n) for n in widths]))


def template_windows(text: Column, short: tuple[int, ...] = ()) -> Column:
    """The windows of a text in all forms, and those as wide as the short items are. What a text repeats comes again.

    Most windows hold no slot and are the same in all forms: a form is hashed only where it differs from the one before.
    """
    widths = (WINDOW, *short)

    def run(x):
        return let(_word_hashes(x), lambda y: F.concat(
            *[_short_hashes(y[LITERAL], n) for n in widths],
            *[_changed(y[f], y[before], widths) for f, before in ((INSIDE, LITERAL), (ALL, INSIDE))],
            # A text shorter than a window is one window in each form.
            *[F.when(F.size(y[f]).between(1, WINDOW - 1), F.array(F.xxhash64(y[f]))).otherwise(F.array().cast("array<bigint>"))
              for f in FORMS]))

    return let(_forms(text), run)


def _filled_windows(text: Column, short: tuple[int, ...] = (), item: bool = False) -> Column:
    """Windows as structs of their place ``i``, the ``form``, the hash ``w`` and the values ``v`` of its slots, in order;
    ``t`` is the hash of the place in the form INSIDE.

    Short items are one window, and one more that is looked up inside of texts: with slots only where two words are none.
    """
    def slots(x, form):
        # Null where no slot is: whether a word is one is asked once, not in every window.
        return F.transform(x[form], lambda w, k: F.when(w.isin(*SLOTS), F.translate(F.get(x[LITERAL], k), CAPITALS_MARK, "")))

    def placed(y, form, hashes, width):
        def values(i):
            none = F.array().cast("array<string>")
            if form == LITERAL:
                return none
            # Places behind the end of a text are null too.
            at = [F.get(y[f"slots_{form}"], i + k) for k in range(width)]
            return F.when(F.coalesce(*at).isNotNull(), F.filter(F.array(*at), lambda v: v.isNotNull())).otherwise(none)

        return F.transform(hashes, lambda w, i: F.struct(
            i.alias("i"), F.lit(form).alias("form"), w.alias("w"), values(i).alias("v"), F.coalesce(F.get(y["t"], i), w).alias("t")))

    def run(x):
        def windows(y):
            n = F.size(x[LITERAL])
            parts = [placed(y, f, _hashes(y["h"][f]), WINDOW) for f in FORMS]
            for f in FORMS:
                says = F.size(F.filter(x[f], lambda w: ~w.isin(*SLOTS))) >= 2
                for k in short:
                    some = placed(y, f, _short_hashes(y["h"][f], k), k)
                    parts.append(F.filter(some, lambda _: (n == k) & (says | F.lit(f == LITERAL))) if item else some)
            return F.concat(*parts)

        return let(_word_hashes(x), lambda h: let(F.struct(
            h.alias("h"), _hashes(h[INSIDE]).alias("t"), *[slots(x, f).alias(f"slots_{f}") for f in (INSIDE, ALL)]), windows))

    return let(_forms(text), run)


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, text_key, item_id, found, windows, kind``: every different (id, text) that holds a benchmark item.

    Nulls: a null text is empty and holds nothing; an item without words is never found; null ids are kept, as
    ``text_key`` (a hash of the text) tells rows apart. Repeated documents give one row. Items of equal text are each
    reported. Empty tables give an empty result. Other columns are ignored, whatever their names.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), text_of(item_text).alias("item_text"))
    in_items = items.distinct().withColumn("item_key", F.xxhash64("item_text")).withColumn(
        "n", F.size(_forms(F.col("item_text"))[LITERAL]))
    # At most as many as a window has words.
    short = tuple(sorted(r.n for r in in_items.where(F.col("n").between(1, WINDOW - 1)).select("n").distinct().collect()))
    in_items = in_items.withColumn("y", F.explode(_filled_windows(F.col("item_text"), short, item=True))).select(
        "item_id", "item_key", F.greatest(F.col("n") - WINDOW + 1, F.lit(1)).alias("places"), "y.i", "y.form", "y.w", "y.t",
        F.col("y.v").alias("want")).checkpoint()
    wanted = in_items.select("item_id", "w", "t").distinct()
    sizes = wanted.groupBy("item_id").agg(F.count_distinct("t").alias("windows"))
    read = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("body"))
    keyed = read.withColumn("text_key", F.xxhash64("body"))
    small = wanted.count() <= BROADCAST_WINDOWS
    held = keyed.select("doc_id", "text_key", F.explode(template_windows(F.col("body"), short)).alias("w"))
    met = held.join(F.broadcast(wanted) if small else wanted, "w")
    pair = ["doc_id", "text_key", "item_id"]
    found = met.groupBy(*pair).agg(F.count_distinct("t").alias("found"))
    enough = found.join(sizes.toDF("sized", "windows"), F.col("item_id").eqNullSafe(F.col("sized"))).where(
        F.col("found") >= F.least(SHARE * F.col("windows"), F.lit(RUN - WINDOW + 1))).select(*pair, "found", "windows")
    likely = enough.checkpoint()

    # The slots of likely pairs only: their texts are read again.
    ids = likely.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    texts = keyed.join(ids, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "text_key"])
    in_docs = texts.select("doc_id", "text_key", F.explode(_filled_windows(F.col("body"), short)).alias("x"))
    hits = likely.alias("p").join(in_items.withColumnRenamed("form", "item_form").alias("i"), F.expr("p.item_id <=> i.item_id")).select(
        "p.*", "i.item_key", "i.places", "i.i", "i.item_form", "i.w", "i.t", "i.want").alias("p").join(
        in_docs.select("doc_id", "text_key", F.col("x.i").alias("d"), "x.form", F.col("x.w").alias("w"), F.col("x.v").alias("have")).alias("h"),
        F.expr("p.doc_id <=> h.doc_id AND p.text_key = h.text_key AND p.w = h.w")).select("p.*", "h.d", "h.form", "h.have")
    # Two readings, one by the form INSIDE alone and one by all: what begins sentences may differ, or be a name.
    alone = (F.col("form") == INSIDE) & (F.col("item_form") == INSIDE)
    read_as = F.explode(F.when(alone, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("reading")
    at = [*pair, "found", "windows", "reading", "item_key", "places", "i", "d", "t"]
    slots = F.struct(F.size("want").alias("n"), F.col("want"), F.col("have"))
    hits = hits.select("*", read_as).groupBy(*at).agg(
        F.bool_or(F.col("want") == F.col("have")).alias("own"), F.max(slots).alias("z")).select(
        *at, "own", "z.want", "z.have").withColumnRenamed("t", "w").checkpoint()
    key = [*pair, "found", "windows", "reading"]
    ranked = _whole(hits, key).unionByName(_occurrences(hits, key)).unionByName(_passages(hits, key)).drop("reading")
    kind = F.when(F.min("rank") == 0, "exact").otherwise("reparameterised")
    return ranked.where("rank IS NOT NULL").groupBy(*key[:-1]).agg(kind.alias("kind"))


def _rank(same: Column, *consistent: Column) -> Column:
    """0 for an exact leak, 1 for a reparameterised one, null for none."""
    return F.when(same >= SHARE * F.col("windows"), 0).when(F.greatest(F.lit(False), *consistent), 1).alias("rank")


def _whole(hits: DataFrame, key: list[str]) -> DataFrame:
    """``key, rank`` from all windows of a document, wherever they are."""
    met = hits.select(*key, "w", "own", "want", "have").distinct()
    told = met.select(*key, "w", "own", F.explode_outer(F.arrays_zip("want", "have")).alias("z"))
    return told.groupBy(*key).agg(
        F.count_distinct("w").alias("met"), F.count_distinct(F.when(F.col("own"), F.col("w"))).alias("same"),
        F.count_distinct("z.want").alias("n_values"),
        F.count_distinct(F.when(F.col("z").isNotNull(), F.col("z"))).alias("n_pairs"),
    ).select(*key, _rank(F.col("same"), F.expr(f"met >= {SHARE} * windows AND n_pairs > 0 AND n_values = n_pairs")))


def _occurrences(hits: DataFrame, key: list[str]) -> DataFrame:
    """``key, rank`` of every occurrence: windows whose places in the document and in the item differ by about the same.

    That difference, the shift, is cut into bins of half an item, each overlapping the next by its half: words put in or
    left out may move it by a quarter of the item, and neighbouring occurrences lie in different bins. Of several hits of
    one place of the item in a bin, the one whose shift most hits share counts. Hits alone on their shift may be chance,
    so an occurrence also passes if those that are not suffice without them.
    """
    one = [*key, "item_key", "bin"]
    step = F.greatest(F.lit(2), F.floor(F.col("places") / 4))
    bins = F.floor((F.col("d") - F.col("i")) / step)
    # All that follows groups the hits of one pair: they are dealt out once.
    spread = hits.withColumn("shift", F.col("d") - F.col("i")).withColumn("bin", F.explode(F.array(bins, bins - 1)))
    voted = spread.withColumn("votes", F.count("*").over(Window.partitionBy(*one, "shift")))
    first = F.row_number().over(Window.partitionBy(*one, "i").orderBy(F.desc("votes"), "shift"))
    chosen = voted.withColumn("n", first).where("n = 1")

    firm = F.col("votes") > 1
    return chosen.groupBy(*one).agg(
        F.count_distinct("w").alias("met"), F.count_distinct(F.when(firm, F.col("w"))).alias("met_firm"),
        F.count_distinct(F.when(F.col("own"), F.col("w"))).alias("same"),
        _pairs(F.lit(True)).alias("z"), _pairs(firm).alias("z_firm"),
    ).select(*key, _rank(F.col("same"), *[
        (F.col(met) >= SHARE * F.col("windows")) & _clear(F.col(z)) for met, z in (("met", "z"), ("met_firm", "z_firm"))]))


def _passages(hits: DataFrame, key: list[str]) -> DataFrame:
    """``key, rank`` of every piece of RUN or more words of an item without a gap."""
    one = [*key, "item_key", "shift"]
    shifted = hits.withColumn("shift", F.col("d") - F.col("i"))
    piece = F.col("i") - F.row_number().over(Window.partitionBy(*one).orderBy("i"))
    held = shifted.withColumn("piece", piece).groupBy(*one, "piece").agg(
        F.count("*").alias("n"), F.bool_and("own").alias("own"), _pairs(F.lit(True)).alias("z")).where(F.col("n") >= RUN - WINDOW + 1)
    return held.select(*key, F.when(F.col("own"), 0).when(_clear(F.col("z")), 1).alias("rank"))


def _pairs(held: Column) -> Column:
    """The different pairs of values of an item and a document."""
    return F.array_distinct(F.flatten(F.collect_list(F.when(held, F.arrays_zip("want", "have")))))


def _clear(pairs: Column) -> Column:
    """Whether each value of the item has one counterpart."""
    return F.size(F.array_distinct(F.transform(pairs, lambda x: x["want"]))) == F.size(pairs)


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    found = leaks(docs, benchmark, doc_id, text).select("doc_id", "text_key").distinct()
    d, t, k = without(docs.columns, "leak_id", "leak_text", "text_key")
    found = found.toDF(d, t).checkpoint()
    found = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    keyed = docs.withColumn(k, F.xxhash64(text_of(text)))
    return keyed.join(found, F.col(doc_id).eqNullSafe(F.col(d)) & (F.col(k) == F.col(t)), "left_anti").select(*docs.columns)
