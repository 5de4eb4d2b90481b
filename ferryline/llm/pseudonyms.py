"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation.

Numbers and dates that pass their checks (payment cards, IBANs, social security numbers, telephone numbers, IPv4
addresses, dates) are permuted among the values of the same format: length, separators, country code, issuer-independent
check digits and calendar stay valid. Mail addresses keep their shape: letters become letters, digits digits, under the
reserved domain ``example.invalid``. The permutation depends on the key and the format only, so equal values have equal
pseudonyms in all documents, and different values different ones.

A Feistel round adds a keyed hash of one half to the other, modulo the size of that half. Halves need not be of one size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.columns import let, total

ROUNDS = 8
# The formats found, in the order in which they are tried at one place.
# A run of address characters is tried from its start only, or from where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,4})?)(?![A-Za-z0-9])"
DATE = r"(?<![0-9.-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DOTTED = r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2}(?![0-9]|\.[0-9])"
SLASHED = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}(?![0-9/])"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9-])[0-9](?:[\x20-]?[0-9]){12,18}(?![0-9-])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"
FOREIGN = r"(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,8}){2,4}(?![0-9-])"
PLAIN_PHONE = r"(?<![0-9A-Za-z+.,/-])[2-9][0-9]{9}(?![0-9A-Za-z-]|[.,/][0-9])"
KINDS = (
    ("email", EMAIL), ("iban", IBAN), ("date", DATE), ("dotted", DOTTED), ("slashed", SLASHED), ("ip", IP), ("ssn", SSN),
    ("card", CARD), ("phone", PHONE), ("foreign", FOREIGN), ("plain_phone", PLAIN_PHONE),
)
ANY = "|".join(pattern for _, pattern in KINDS)
# 7 * 28 years of which every fourth is a leap year, from 1904-01-01 to 2099-12-31, are 147 * 487 days.
FIRST_DAY, DAYS = "1904-01-01", (147, 487)
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Key:
    """``secret`` is given by the caller; ``label`` keeps the pseudonyms of different uses apart."""

    secret: str
    label: str = ""


def _round_hash(key: Key, kind: str, number: Column, half: Column) -> Column:
    """60 bits from SHA-256 of the key, the format, the round and a half."""
    words = F.concat_ws("|", F.lit(key.secret), F.lit(key.label), F.lit(kind), number.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(words, 256), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, sizes: tuple[Column, Column], key: Key, kind: str) -> Column:
    """A keyed permutation of pairs ``left < sizes[0], right < sizes[1]``: a struct of both."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def step(state, number):
        turned = F.struct(F.pmod(state["l"] + F.pmod(_round_hash(key, kind, number, state["r"]), sizes[0]), sizes[0]).alias("l"),
                          state["r"].alias("r"))
        other = F.struct(state["l"].alias("l"), F.pmod(
            state["r"] + F.pmod(_round_hash(key, kind, number, state["l"]), sizes[1]), sizes[1]).alias("r"))
        return F.when(number % 2 == 0, turned).otherwise(other)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(digits: Column) -> Column:
    return F.pow(F.lit(10.0), digits).cast("bigint")


def permuted_digits(digits: Column, key: Key, kind: str) -> Column:
    """A string of 2 to 34 digits as another one of the same length; one digit is shifted by the key."""
    def halves(d):
        a = F.floor(F.length(d) / 2).cast("int")
        b = F.length(d) - a
        sizes = F.struct(_power(a).alias("a"), _power(b).alias("b"))
        left = F.when(a > 0, F.substring(d, F.lit(1), a).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return let(sizes, lambda s: let(
            feistel(left, F.substring(d, a + 1, b).cast("bigint"), (s["a"], s["b"]), key, kind),
            lambda x: F.concat(F.when(a > 0, F.lpad(x["l"].cast("string"), a, "0")).otherwise(F.lit("")),
                               F.lpad(x["r"].cast("string"), b, "0"))))

    return let(F.struct(digits.alias("d")), lambda x: halves(x["d"]))


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by ``digits``; separators stay."""
    chars = F.split(value, "")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(s, c):
        digit = c.rlike("^[0-9]$")
        return F.struct((s["at"] + digit.cast("int")).alias("at"), F.concat(s["done"], F.when(
            digit, F.substring(digits, s["at"] + 1, F.lit(1))).otherwise(c)).alias("done"))

    return F.aggregate(chars, state, step, lambda s: s["done"])


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _check_digit(body: Column) -> Column:
    """The Luhn check digit of a string of digits."""
    def weighed(c, i):
        twice = (F.length(body) - 1 - i) % 2 == 0
        d = c.cast("int")
        return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d).cast("bigint")

    return ((10 - total(F.transform(F.split(body, ""), weighed)) % 10) % 10).cast("string")


def _remainder(chars: Column) -> Column:
    """A string of digits and A-Z (as 10 to 35) modulo 97."""
    def step(s, c):
        digit = c.rlike("^[0-9]$")
        value = F.when(digit, c.cast("int")).otherwise(F.ascii(c) - 55)
        return ((s * F.when(digit, 10).otherwise(100) + value) % 97).cast("int")

    return F.aggregate(F.split(chars, ""), F.lit(0), step)


def _card(value: Column, key: Key) -> Column:
    def run(d):
        body = F.substring(d, F.lit(1), F.length(d) - 1)
        valid = F.length(d).between(13, 19) & (F.substring(d, F.length(d), F.lit(1)) == _check_digit(body))
        new = let(permuted_digits(body, key, "card"), lambda b: F.concat(b, _check_digit(b)))
        return F.when(valid, let(new, lambda n: _refilled(value, n)))

    return let(_only_digits(value), run)


def _iban(value: Column, key: Key) -> Column:
    country, body = F.substring(value, 1, 2), F.substring(value, F.lit(5), F.length(value))
    valid = _remainder(F.concat(body, country, F.substring(value, 3, 2))) == 1

    def checked(b):
        return F.concat(country, F.lpad((98 - _remainder(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b)

    new = let(_refilled(body, permuted_digits(_only_digits(body), key, "iban")), checked)
    return F.when(valid & (F.length(_only_digits(body)) > 0), new)


def _date(value: Column, key: Key, form: str = "yyyy-MM-dd") -> Column:
    """A day has one pseudonym, however it is written."""
    day = F.to_date(F.try_to_timestamp(value, F.lit(form)))
    first = F.lit(FIRST_DAY).cast("date")
    number = F.datediff(day, first)
    sizes = tuple(F.lit(n).cast("bigint") for n in DAYS)
    new = let(feistel(F.floor(number / DAYS[1]), number % DAYS[1], sizes, key, "date"),
              lambda x: F.date_format(F.date_add(first, (x["l"] * DAYS[1] + x["r"]).cast("int")), form))
    return F.when(number.between(0, DAYS[0] * DAYS[1] - 1), new)


def _dotted(value: Column, key: Key) -> Column:
    return _date(value, key, "dd.MM.yyyy")


def _slashed(value: Column, key: Key) -> Column:
    """Month first; where that is no day, day first."""
    return F.coalesce(_date(value, key, "MM/dd/yyyy"), _date(value, key, "dd/MM/yyyy"))


def _ip(value: Column, key: Key) -> Column:
    def run(parts):
        valid = ~F.exists(parts, lambda p: (p.cast("int") > 255) | p.rlike("^0[0-9]"))
        half = lambda i: F.get(parts, F.lit(i)).cast("bigint") * 256 + F.get(parts, F.lit(i + 1)).cast("bigint")
        size = F.lit(65536).cast("bigint")
        new = let(feistel(half(0), half(2), (size, size), key, "ip"), lambda x: F.concat_ws(
            ".", *[c.cast("string") for n in ("l", "r") for c in (F.floor(x[n] / 256), x[n] % 256)]))
        return F.when(valid, new)

    return let(F.split(value, r"\."), run)


def _ssn(value: Column, key: Key) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999, each valid again."""
    area, group, serial = (F.substring(value, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    sizes = (F.lit(898).cast("bigint"), F.lit(99 * 9999).cast("bigint"))

    def shown(x):
        back = F.when(x["l"] >= 665, x["l"] + 2).otherwise(x["l"] + 1)
        parts = ((back, 3), (F.floor(x["r"] / 9999) + 1, 2), (x["r"] % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(c.cast("string"), n, "0") for c, n in parts])

    return F.when(valid, let(feistel(place, (group - 1) * 9999 + serial - 1, sizes, key, "ssn"), shown))


def _phone(value: Column, key: Key) -> Column:
    """The last ten digits are permuted, a country code in front stays."""
    def run(d):
        new = F.concat(F.substring(d, F.lit(1), F.length(d) - 10), permuted_digits(F.substring(d, F.length(d) - 9, F.lit(10)), key, "phone"))
        return let(new, lambda n: _refilled(value, n))

    return let(_only_digits(value), run)


def _foreign(value: Column, key: Key) -> Column:
    """Up to ten digits at the end are permuted, 8 to 15 there are in all; the first two stay."""
    def run(d):
        n = F.least(F.lit(10), F.length(d) - 2)
        new = let(permuted_digits(F.substring(d, F.length(d) - n + 1, n), key, "phone"),
                  lambda p: F.concat(F.substring(d, F.lit(1), F.length(d) - n), p))
        return F.when(F.length(d).between(8, 15), let(new, lambda x: _refilled(value, x)))

    return let(_only_digits(value), run)


def _email(value: Column, key: Key) -> Column:
    """The local part keeps its length and the kind of each character; the keystream comes from the whole address, and a
    keyed tag keeps different addresses apart."""
    address = F.lower(value)
    local = F.substring_index(value, "@", 1)
    seed = F.sha2(F.concat_ws("|", F.lit(key.secret), F.lit(key.label), F.lit("email"), address), 256)

    def shifted(c, i):
        step = F.conv(F.substring(F.sha2(F.concat(seed, i.cast("string")), 256), 1, 8), 16, 10).cast("bigint")
        pick = lambda letters: F.substring(F.lit(letters), (step % len(letters)).cast("int") + 1, F.lit(1))
        return F.when(c.rlike("^[a-z]$"), pick(LOWER)).when(c.rlike("^[A-Z]$"), pick(UPPER)).when(
            c.rlike("^[0-9]$"), pick("0123456789")).otherwise(c)

    return F.concat(F.array_join(F.transform(F.split(local, ""), shifted), ""), F.lit("-"), F.substring(seed, 1, 12),
                    F.lit("@example.invalid"))


def _pieces(value: Column, wanted: str, made) -> Column:
    """``value`` with the first run of its groups that passes replaced: long runs before short ones, none across a group.

    ``wanted`` is the separator of groups; there are at most 19 groups, and runs that cannot pass by length are not tried.
    """
    def run(groups):
        spans = F.flatten(F.transform(F.sequence(F.lit(0), F.size(groups) - 1), lambda a: F.transform(
            F.sequence(a, F.size(groups) - 1), lambda b: F.struct((a - b).alias("short"), a.alias("a"), b.alias("b")))))
        text = lambda a, n: F.array_join(F.slice(groups, a + 1, n), "")
        tried = F.transform(F.sort_array(spans), lambda s: let(
            F.struct(text(s["a"], s["b"] - s["a"] + 1).alias("v")), lambda x: F.struct(made(x["v"]).alias("new"), s["a"].alias("a"), s["b"].alias("b"))))
        passed = F.filter(tried, lambda x: x["new"].isNotNull())
        return let(F.get(passed, F.lit(0)), lambda x: F.when(x.isNotNull(), F.concat(
            text(F.lit(0), x["a"]), x["new"], text(x["b"] + 1, F.size(groups)))))

    return let(F.regexp_extract_all(value, F.lit(wanted), F.lit(0)), run)


def _card_in(value: Column, key: Key) -> Column:
    """The whole candidate, or the longest run of its groups that is a card: a card beside other numbers."""
    def of(v):
        core = F.regexp_extract(v, "^([\\x20-]?)(.*)$", 2)
        lead = F.regexp_extract(v, "^([\\x20-]?)(.*)$", 1)
        return F.when(F.length(_only_digits(v)).between(13, 19), F.concat(lead, _card(core, key)))

    return F.coalesce(_card(value, key), F.when(value.rlike("[\\x20-]"), _pieces(value, "[\\x20-]?[0-9]+", of)))


def _iban_in(value: Column, key: Key) -> Column:
    """The whole candidate, or without groups at its end that do not belong to it; spaces stay where they were."""
    def spaced(v):
        compact = F.regexp_replace(v, "\\x20", "")
        groups = lambda n: F.trim(F.regexp_replace(n, "(.{4})", "$1 "))
        return F.when(v.startswith(" ") | ~v.rlike("^[A-Z]{2}[0-9]{2}"), None).otherwise(let(_iban(compact, key), groups))

    return F.when(F.contains(value, F.lit(" ")), _pieces(value, "\\x20?[A-Z0-9]+", spaced)).otherwise(_iban(value, key))


_BY_KIND = {
    "email": _email, "iban": _iban_in, "date": _date, "dotted": _dotted, "slashed": _slashed, "ip": _ip, "ssn": _ssn,
    "card": _card_in, "phone": _phone, "foreign": _foreign, "plain_phone": _phone,
}


def pseudonym(value: Column, key: Key) -> Column:
    """The pseudonym of one match; the match itself where it passes no check."""
    found = [F.when(value.rlike(f"^(?:{pattern})$"), _BY_KIND[kind](value, key)) for kind, pattern in KINDS]
    return F.coalesce(*found, value)


def pseudonymise(docs: DataFrame, key: Key, text: str = "text", out: str = "replaced") -> DataFrame:
    """The documents with personal data in ``text`` replaced, and ``out``: how many values were.

    Nulls: a null text stays null with 0 replaced. Repeated rows get equal pseudonyms. Values that fail their checks
    (a wrong check digit, a day that does not exist) stay. An empty table gives an empty result. Other columns pass
    through; ``out`` must be a new name.
    """
    def run(t):
        parts = F.struct(F.split(t, ANY, -1).alias("gaps"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)).alias("found"))
        return let(parts, lambda p: let(F.transform(p["found"], lambda v: pseudonym(v, key)), lambda new: F.struct(
            F.array_join(F.flatten(F.zip_with(p["gaps"], new, lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))), "").alias("text"),
            F.size(F.filter(F.zip_with(p["found"], new, lambda a, b: a != b), lambda d: d)).cast("bigint").alias("n"))))

    plain = F.struct(F.col(text).alias("text"), F.lit(0).cast("bigint").alias("n"))
    done = let(F.col(text), lambda t: F.when(t.rlike(ANY), run(t)))
    return docs.withColumn(out, F.coalesce(done, plain)).withColumn(text, F.col(f"{out}.text")).withColumn(out, F.col(f"{out}.n"))
