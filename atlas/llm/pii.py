"""Format-preserving pseudonyms for personal numbers and dates, in SQL functions only.

Values are found by pattern and validated: card numbers by their check digit, addresses by their octets, social security
numbers by their ranges, dates by the calendar. A valid value is replaced by its image under a keyed permutation of all
valid values of its format: a Feistel network on two halves of sizes a and b, whose rounds add a keyed hash of one
half to the other modulo its size, so it is a bijection of a * b values for any a and b. Equal values, however
separated, become equal pseudonyms in every document; different ones stay different. Signs between digits stay.
Cards keep a correct check digit, telephone numbers all but their last ten digits, dates their layout (years 1800
to 2199); a date with slashes is month first where the calendar allows it, else day first. A telephone number ends at a group
of four digits after another one, so a number behind it is not taken for a part. E-mail addresses are no numbers; they get a keyed digest as name under ``MAIL_DOMAIN``.

Defined results: a null text stays null with no values, an empty one empty; invalid values stay as they are; repeated rows
are treated alike; an empty table gives an empty result; all columns but the text are kept, and pii_counts is added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import let

ROUNDS = 6
MAIL_DOMAIN = "example.org"
FIRST_DAY, DAYS = "1800-01-01", (189, 773)   # 400 Gregorian years are 189 * 773 days

# Layouts, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}[ .-]?[0-9]{4}(?![0-9])|(?:[ .-]?[0-9]{2,4}){2,3})|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9])",
}
KINDS = tuple(PATTERNS)
ANY_VALUE = "|".join(PATTERNS.values())


def _long(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")


def feistel(value: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """The keyed image of ``value`` among 0 … a * b - 1, a permutation of these numbers for any a and b up to 2^31."""
    def noise(r: Column, half: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), r.cast("string"), F.lit("|"), a.cast("string"), F.lit("|"), b.cast("string"), F.lit("|"), half.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def step(s: Column, r: Column) -> Column:
        return (F.when(r % 2 == 1, F.struct(F.pmod(s["x"] + noise(r, s["y"]) % a, a).alias("x"), s["y"].alias("y")))
                .otherwise(F.struct(s["x"].alias("x"), F.pmod(s["y"] + noise(r, s["x"]) % b, b).alias("y"))))

    first = F.struct(_div(value, b).alias("x"), (value % b).alias("y"))
    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, step), lambda s: s["x"] * b + s["y"])


def _div(value: Column, by: Column) -> Column:
    """Integer quotient, exact for all longs."""
    return F.call_function("div", value, by)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def check_digit(body: Column) -> Column:
    """The digit that completes ``body`` to a number with a correct check sum."""
    n = F.length(body)
    terms = F.transform(F.sequence(F.lit(1), n), lambda i: let(
        F.substring(body, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return ((10 - F.aggregate(terms, F.lit(0), lambda s, t: s + t) % 10) % 10).cast("string")


def refill(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, from the last on, by those of ``digits``; earlier ones stay."""
    skip = F.length(digits_of(layout)) - F.length(digits)

    def put(s: Column, i: Column) -> Column:
        c = F.substring(layout, i, F.lit(1))
        is_digit = c.between("0", "9")
        at = s["at"] + is_digit.cast("int")
        return F.struct(F.concat(s["out"], F.when(is_digit & (at > skip), F.substring(digits, at - skip, F.lit(1))).otherwise(c)).alias("out"), at.alias("at"))

    return F.aggregate(F.sequence(F.lit(1), F.length(layout)), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), put)["out"]


def _number(digits: Column, key: str, kind: str) -> Column:
    """Image of a string of digits among all of its length."""
    n = F.length(digits)
    high = F.floor(n / 2)
    return let(F.struct(F.pow(F.lit(10), high).cast("long").alias("a"), F.pow(F.lit(10), n - high).cast("long").alias("b")),
               lambda p: F.lpad(feistel(digits.cast("long"), p["a"], p["b"], key, kind).cast("string"), n, "0"))


def _card(m: Column, key: str) -> Column:
    def image(d: Column) -> Column:
        body = F.substring(d, F.lit(1), F.length(d) - 1)
        return F.when(check_digit(body) == F.substring(d, -1, 1), let(_number(body, key, "card"), lambda b: refill(m, F.concat(b, check_digit(b)))))

    return let(digits_of(m), image)


def _ipv4(m: Column, key: str) -> Column:
    def image(o: Column) -> Column:
        value = F.aggregate(o, _long(0), lambda s, x: s * 256 + x)
        return F.when(F.forall(o, lambda x: x <= 255), let(feistel(value, _long(65536), _long(65536), key, "ipv4"), lambda v: F.concat_ws(
            ".", *[F.shiftright(v, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])))

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), image)


def _ssn(m: Column, key: str) -> Column:
    def image(p: Column) -> Column:
        area, group, serial = (p[i].cast("long") for i in range(3))
        value = ((area - 1 - (area > 666).cast("long")) * 99 + (group - 1)) * 9999 + (serial - 1)
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)

        def text(v: Column) -> Column:
            index = _div(v, _long(989901))
            back = index + 1 + (index >= 665).cast("long")
            return F.concat_ws("-", F.lpad(back.cast("string"), 3, "0"), F.lpad((_div(v, _long(9999)) % 99 + 1).cast("string"), 2, "0"),
                               F.lpad((v % 9999 + 1).cast("string"), 4, "0"))

        return F.when(valid, let(feistel(value, _long(898), _long(989901), key, "ssn"), text))

    return let(F.split(m, "-"), image)


def _date(m: Column, key: str) -> Column:
    dashed = lambda year, month, day: F.concat_ws("-", F.substring(m, year, 4), F.substring(m, month, 2), F.substring(m, day, 2))
    month_first = dashed(7, 1, 4)
    layout = (F.when(m.rlike("^[0-9]{4}-"), "yyyy-MM-dd").when(m.contains("."), "dd.MM.yyyy")
              .when(month_first.try_cast("date").isNotNull(), "MM/dd/yyyy").otherwise("dd/MM/yyyy"))
    iso = F.when(layout == "yyyy-MM-dd", m).when(layout == "MM/dd/yyyy", month_first).otherwise(dashed(7, 4, 1))
    day = F.datediff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date")).cast("long")
    a, b = DAYS

    def text(d: Column) -> Column:
        moved = F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(d, _long(a), _long(b), key, "date").cast("int"))
        out = let(moved.cast("string"), lambda s: F.when(layout == "yyyy-MM-dd", s).when(
            layout == "MM/dd/yyyy", F.concat_ws("/", F.substring(s, 6, 2), F.substring(s, 9, 2), F.substring(s, 1, 4))).otherwise(
            F.concat(F.substring(s, 9, 2), F.substring(m, 3, 1), F.substring(s, 6, 2), F.substring(m, 3, 1), F.substring(s, 1, 4))))
        return F.when((d >= 0) & (d < a * b), out)

    return let(day, text)


def _phone(m: Column, key: str) -> Column:
    return let(digits_of(m), lambda d: F.when(F.length(d).between(7, 15), refill(m, _number(F.substring(d, F.greatest(F.lit(1), F.length(d) - 9), F.lit(10)), key, "phone"))))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("p"), F.substring(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(m)), 256), 1, 16), F.lit("@" + MAIL_DOMAIN))


REPLACE = {"email": _email, "card": _card, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone}


def pseudonym(value: Column, key: str) -> Column:
    """struct(kind, text) for a found value; kind is null and the text unchanged if no format accepts it."""
    fits = {k: value.rlike(f"^(?:{PATTERNS[k]})$") for k in KINDS}
    kind = F.coalesce(*[F.when(fits[k], F.lit(k)) for k in KINDS])

    def image(k: Column) -> Column:
        new = F.coalesce(*[F.when(k == name, fn(value, key)) for name, fn in REPLACE.items()])
        return let(F.array(new), lambda n: F.struct(F.when(n[0].isNotNull(), k).alias("kind"), F.coalesce(n[0], value).alias("text")))

    return let(kind, image)


def pseudonymise(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with their text rewritten, and pii_counts: a map from kind to the number of values replaced."""
    def rewrite(parts: Column) -> Column:
        new = F.transform(parts["values"], lambda v: pseudonym(v, key))
        return let(new, lambda n: F.struct(
            F.concat(F.array_join(F.zip_with(F.slice(parts["gaps"], 1, F.size(n)), n, lambda g, v: F.concat(g, v["text"])), ""),
                     F.element_at(parts["gaps"], -1)).alias("text"),
            F.transform(n, lambda v: v["kind"]).alias("kinds")))

    source = F.col(text)
    parts = F.struct(F.split(source, ANY_VALUE, -1).alias("gaps"), F.regexp_extract_all(source, F.lit(ANY_VALUE), F.lit(0)).alias("values"))
    found = F.when(source.rlike("[0-9@]"), let(parts, rewrite))
    rows = documents.drop("pii_counts").select(F.struct("*").alias("row"), F.explode(F.array(found)).alias("found"))
    counts = F.map_from_entries(F.array(*[F.struct(F.lit(k), F.coalesce(F.size(F.filter("found.kinds", lambda x: x == k)), F.lit(0)).cast("long")) for k in KINDS]))  # noqa: B023
    return rows.select(F.col("row").withField(text, F.coalesce("found.text", F.col("row")[text])).alias("row"), counts.alias("pii_counts")).select("row.*", "pii_counts")
