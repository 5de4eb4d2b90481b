import datetime

from llm.rows import documents, odd_documents
from pyspark.sql import functions as F

from ferryline.llm.pseudonyms import Key, feistel, permuted_digits, pseudonym, pseudonymise

KEY = Key("k", "test")


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def iban(value):
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def of(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", pseudonym(F.col("v"), KEY).alias("p"))
    return {r.v: r.p for r in rows.collect()}


def test_feistel_is_a_permutation(spark):
    size = (F.lit(13).cast("bigint"), F.lit(29).cast("bigint"))
    pairs = spark.range(13 * 29).select(feistel(F.floor(F.col("id") / 29), F.col("id") % 29, size, KEY, "t").alias("x")).distinct()
    assert pairs.count() == 13 * 29
    digits = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    new = [r.p for r in digits.select(permuted_digits(F.col("d"), KEY, "t").alias("p")).collect()]
    assert len(set(new)) == 1000 and all(len(n) == 3 for n in new)


def test_dates_are_permuted_among_dates(spark):
    first = datetime.date(1904, 1, 1)
    days = [str(first + datetime.timedelta(days=i)) for i in range(0, 71589, 37)]
    new = of(spark, days)
    assert len(set(new.values())) == len(days)
    assert all("1904-01-01" <= str(datetime.date.fromisoformat(d)) <= "2099-12-31" for d in new.values())
    assert of(spark, ["2023-02-30", "1903-12-31"]) == {"2023-02-30": "2023-02-30", "1903-12-31": "1903-12-31"}


def test_formats_stay_valid(spark):
    cards = ["4785380592391139", "4994226020900891", "4111 1111 1111 1111", "4111-1111-1111-1111"]
    cards = [c for c in cards if luhn(c.replace(" ", "").replace("-", ""))]
    others = ["DE89370400440532013000", "GB82WEST12345698765432", "152.143.123.131", "123-45-6789", "+1 (743) 555-3824", "743-555-3824"]
    new = of(spark, cards + others)
    assert all(new[v] != v for v in cards + others)
    for c in cards:
        assert luhn("".join(x for x in new[c] if x.isdigit())) and [x.isdigit() for x in c] == [x.isdigit() for x in new[c]]
    assert iban(new[others[0]]) and iban(new[others[1]]) and new[others[1]].startswith("GB")
    assert all(0 <= int(p) < 256 for p in new["152.143.123.131"].split("."))
    assert new["+1 (743) 555-3824"].startswith("+1 (")
    kept = ["4785380592391130", "DE00370400440532013000", "300.1.1.1", "000-12-3456"]
    assert of(spark, kept) == {v: v for v in kept}


def test_equal_values_stay_linked(spark):
    texts = ["call +1 (743) 555-3824, mail Ab.1@mail5.example.com now", "at 152.143.123.131: +1 (743) 555-3824", "nothing", None]
    rows = {r.doc_id: r for r in pseudonymise(documents(spark, texts), KEY).collect()}
    number = rows[0].text.split("call ")[1].split(",")[0]
    assert number in rows[1].text and "555-3824" not in rows[0].text + rows[1].text
    assert "mail5" not in rows[0].text and "152.143.123.131" not in rows[1].text
    assert [rows[i].replaced for i in range(4)] == [2, 2, 0, 0] and rows[2].text == "nothing" and rows[3].text is None


def test_odd_rows(spark):
    docs = odd_documents(spark)
    done = pseudonymise(docs, KEY)
    assert done.count() == docs.count() and done.columns == [*docs.columns, "replaced"]
    assert pseudonymise(documents(spark, []), KEY).count() == 0


def test_values_inside_candidates_and_other_shapes(spark):
    cards = ["4111111111111111 123", "12 4111111111111111", "4111 1111 1111 1111 123"]
    new = of(spark, [*cards, "4111111111111111", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "24.12.1985", "12/24/1985",
                     "1985-12-24", "24/12/1985", "+49 30 12345678", "5551234567", "555-123-4567", "32.12.1985"])
    inner = new["4111111111111111"]
    assert luhn(inner) and inner != "4111111111111111"
    assert new[cards[0]] == f"{inner} 123" and new[cards[1]] == f"12 {inner}"
    assert new[cards[2]].replace(" ", "") == f"{inner}123" and new[cards[2]][4::5] == "    "
    assert new["DE89 3704 0044 0532 0130 00"].replace(" ", "") == new["DE89370400440532013000"] != "DE89370400440532013000"
    y, m, d = new["1985-12-24"].split("-")
    assert (new["24.12.1985"], new["12/24/1985"], new["24/12/1985"]) == (f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{d}/{m}/{y}")
    assert new["+49 30 12345678"].startswith("+49 ") and new["+49 30 12345678"] != "+49 30 12345678"
    assert new["5551234567"] == new["555-123-4567"].replace("-", "") and new["32.12.1985"] == "32.12.1985"
    text = "pay 4111111111111111 123, born 24.12.1985, call 5551234567 or +49 30 12345678, IBAN DE89 3704 0044 0532 0130 00."
    row = pseudonymise(documents(spark, [text]), KEY).collect()[0]
    assert row.replaced == 5 and not any(v in row.text for v in ("4111111111111111", "24.12.1985", "5551234567", "12345678", "0532"))


def test_long_runs_and_addresses_side_by_side(spark):
    """A megabyte without an address is looked through once; an address right behind another is found."""
    texts = ["a" * 1_000_000, "1" * 1_000_000, "a." * 500_000 + "@", "me@site.org_you@site.org"]
    rows = pseudonymise(documents(spark, texts), KEY).orderBy("doc_id").collect()
    assert [r.replaced for r in rows] == [0, 0, 0, 2] and [r.text for r in rows[:3]] == texts[:3]
    assert rows[3].text.count("@example.invalid") == 2
