"""Name and house-number normalisation, aliases, file-name rules (Column in, Column out)."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
# Cyrillic letters that look like Latin ones in house numbers, and the Latin letter meant.
LOOKALIKE_FROM, LOOKALIKE_TO = "авекмнорстух", "abekmhopctyx"
LOCALITY_ALIAS_KEYS = (
    "name:ro", "name:ru", "name:en", "name:uk", "name:hu", "name:de",
    "alt_name", "old_name", "official_name", "short_name", "int_name",
)
STREET_ALIAS_KEYS = ("name:ru", "name:ro", "name:en", "name:uk")
SEARCH_ALIAS_KEYS = ("name:en", "name:ru")
ADMIN_PREFIXES = (
    "mun", "municipiul", "or", "oras", "orasul", "s", "sat", "satul", "c", "com", "comuna",
    "sec", "sectorul", "г", "пгт", "с",
)
CATEGORY_KINDS = {
    "charging": ("charging_station",),
    "fuel": ("fuel",),
    "parking": ("parking", "parking_space", "parking_entrance"),
    "food": ("restaurant", "fast_food", "cafe", "bar", "pub", "ice_cream", "food_court"),
    "shop": ("supermarket", "convenience", "greengrocer", "bakery", "department_store",
             "marketplace", "mall"),
    "pharmacy": ("pharmacy", "chemist"),
    "money": ("atm", "bank", "bureau_de_change"),
    "hotel": ("hotel", "motel", "guest_house", "hostel"),
    "hospital": ("hospital", "clinic", "doctors"),
    "toilets": ("toilets",),
}
# ----------------------------------------------------------------------------------------------

MAX_ALIAS_CHARS = 80
MAX_HOUSE_KEY_CHARS = 16
ADMIN_PREFIX_PATTERN = r"(?iu)^(" + "|".join(ADMIN_PREFIXES) + r")\.?\s+"


@functools.cache
def base_letter_map() -> tuple[str, str]:
    """(from, to) for ``translate``: every lower-case letter whose canonical decomposition is one
    base letter plus marks, and that base letter. Built from the Unicode tables."""
    source, target = [], []
    for code in range(0x80, 0x30000):
        letter = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF or letter.lower() != letter:
            continue
        bare = [c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"]
        if len(bare) == 1 and bare[0] != letter:
            source.append(letter)
            target.append(bare[0])
    return "".join(source), "".join(target)


@functools.cache
def marks() -> str:
    """All non-spacing marks of the Unicode tables, also those younger than the JVM's."""
    return "".join(c for c in map(chr, [*range(0x300, 0xD800), *range(0xE000, 0xE0200)]) if unicodedata.category(c) == "Mn")


SYLLABLES = "\uac00-\ud7a3"   # Hangul syllables decompose by arithmetic
LEADS, VOWELS, TAILS = ("".join(map(chr, range(first, first + n))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))


@functools.cache
def spelled_out() -> dict[str, str]:
    """Every other lower-case character whose canonical decomposition has several letters, and these letters."""
    found = {}
    for code in range(0x80, 0x30000):
        letter = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF or letter.lower() != letter:
            continue
        bare = [c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"]
        if len(bare) > 1:
            found[letter] = "".join(bare)
    return found


@functools.cache
def spelled_out_class() -> str:
    """Character class of the keys of ``spelled_out`` as ranges: a regular expression tests the members of a class one by one."""
    codes, ranges = sorted(map(ord, spelled_out())), []
    for code in codes:
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


def _decomposed(text: Column) -> Column:
    """Hangul syllables and the characters of ``spelled_out`` as their letters; texts without any are left as they are."""
    several = spelled_out()
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])

    def letters(char: Column) -> Column:
        number = F.ascii(char) - 0xAC00
        tail = F.pmod(number, F.lit(28))
        lead, vowel = F.floor(number / 588).cast("int"), F.floor(F.pmod(number, F.lit(588)) / 28).cast("int")
        hangul = F.concat(F.substring(F.lit(LEADS), lead + 1, F.lit(1)), F.substring(F.lit(VOWELS), vowel + 1, F.lit(1)),
                          F.when(tail > 0, F.substring(F.lit(TAILS), tail, F.lit(1))).otherwise(""))
        return F.when(char.between("\uac00", "\ud7a3"), hangul).otherwise(F.coalesce(F.try_element_at(table, char), char))

    chars = F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))
    least, most = min(several), max(max(several), SYLLABLES[-1])   # one range, so that most texts are told by one comparison a character
    some = text.rlike(f"[{least}-{most}]") & text.rlike(f"[{SYLLABLES}{spelled_out_class()}]")
    return F.when(some, F.array_join(F.transform(chars, letters), "")).otherwise(text)


def strip(text: Column) -> Column:
    """Without leading and trailing white space."""
    return F.btrim(text, F.lit(" \t\n\r\f\x0b"))


def fold(text: Column) -> Column:
    """Lower case without diacritics (also й→и, ё→е): the canonical decomposition without its marks."""
    source, target = base_letter_map()
    return F.translate(_decomposed(F.lower(text)), source + marks(), target)   # letters without a counterpart are dropped


def name_key(text: Column) -> Column:
    """Folded words separated by single spaces: the equality key of names and streets."""
    return F.trim(F.regexp_replace(fold(text), r"[^\p{L}\p{N}]+", " "))


street_key = name_key


def _list_parts(raw: Column) -> Column:
    return F.split(raw, "[;,]")


def _one_house_key(part: Column) -> Column:
    squeezed = F.regexp_replace(fold(part), r"\s+", "")
    return F.translate(F.replace(squeezed, F.lit("\\"), F.lit("/")), LOOKALIKE_FROM, LOOKALIKE_TO)


def _is_house_key(key: Column) -> Column:
    return key.rlike(r"\p{Nd}") & (F.length(key) <= MAX_HOUSE_KEY_CHARS)


def house_keys(raw: Column) -> Column:
    """One house-number value → its distinct keys, in order of appearance."""
    return F.array_distinct(F.filter(F.transform(_list_parts(raw), _one_house_key), _is_house_key))


def house_display(raw: Column, key: Column) -> Column:
    """The first part of ``raw`` that stands for ``key`` alone, else the key itself."""
    match = F.filter(F.transform(_list_parts(raw), strip),
                     lambda p: (_one_house_key(p) == key) & _is_house_key(key))
    return F.coalesce(F.try_element_at(match, F.lit(1)), key)


def _without_yo(text: Column) -> Column:
    return F.translate(text, "ёЁ", "еЕ")


def yo_variants(names: Column) -> Column:
    """Spellings with е of the names written with ё, unless already listed."""
    changed = F.filter(names, lambda n: _without_yo(n) != n)
    return F.array_except(F.transform(changed, _without_yo), names)


def locality_aliases(tags: Column, name: Column) -> Column:
    """Other names of a place: 11 keys, ``;`` lists, different key than the name, plus е spellings."""
    values = F.flatten(F.array(*[
        F.split(F.coalesce(tags[k], F.lit("")), ";") for k in LOCALITY_ALIAS_KEYS]))
    own = name_key(name)
    kept = F.array_distinct(F.filter(
        F.transform(values, strip),
        lambda v: (v != "") & (name_key(v) != own) & (F.length(v) <= MAX_ALIAS_CHARS)))
    return F.concat(kept, yo_variants(F.concat(F.array(name), kept)))


def search_aliases(tags: Column, name: Column) -> Column:
    """English and Russian names that differ from the name itself."""
    values = F.array(*[tags[k] for k in SEARCH_ALIAS_KEYS])
    return F.array_distinct(F.filter(
        values, lambda v: v.isNotNull() & (v != "") & (v != F.coalesce(name, F.lit("")))
        & (F.length(v) <= MAX_ALIAS_CHARS)))


def city_keys(raw: Column) -> Column:
    """Key of a city as written, then without an administrative prefix."""
    bare = name_key(F.regexp_replace(strip(raw), ADMIN_PREFIX_PATTERN, ""))
    return F.array_distinct(F.filter(F.array(name_key(raw), bare), lambda k: k != ""))


def population(raw: Column) -> Column:
    digits = F.regexp_extract(F.regexp_replace(F.coalesce(raw, F.lit("")), "[ ,]", ""), r"^(\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def commune_display(tags: Column) -> Column:
    name = tags["name"]
    official = F.nullif(strip(F.coalesce(tags["official_name"], F.lit(""))), F.lit(""))
    prefixed = F.when(tags["name:prefix"] != "",
                      F.concat_ws(" ", strip(tags["name:prefix"]), name))
    full = F.coalesce(official, prefixed, name)
    return F.concat(F.upper(F.substring(full, 1, 1)), F.substring(full, 2, 1 << 20))


def is_in_parts(raw: Column) -> Column:
    return F.array_distinct(F.filter(
        F.transform(_list_parts(F.coalesce(raw, F.lit(""))), name_key), lambda k: k != ""))


def is_in_conflict(a: Column, b: Column) -> Column:
    """Both stated and neither part set contains the other."""
    left, right = is_in_parts(a), is_in_parts(b)
    return ((F.size(left) > 0) & (F.size(right) > 0)
            & (F.size(F.array_except(left, right)) > 0) & (F.size(F.array_except(right, left)) > 0))


def category_of(kind: Column) -> Column:
    out = F.lit(None).cast("string")
    for category, kinds in CATEGORY_KINDS.items():
        out = F.when(kind.isin(*kinds), F.lit(category)).otherwise(out)
    return out


def signal_value(raw: Column) -> Column:
    return F.regexp_replace(raw, r"[^A-Za-z0-9_:.-]", "_")


def aliases_json(aliases: Column) -> Column:
    return F.when(F.size(aliases) > 0, F.to_json(aliases))


def dated_extract(url: Column, replication: Column) -> Column:
    """``…-latest.osm.pbf`` and a replication stamp → the dated file of that day, else NULL."""
    day = F.translate(F.substring(replication, 3, 8), "-", "")
    usable = url.endswith("-latest.osm.pbf") & (F.length(replication) >= 10)
    return F.when(usable, F.regexp_replace(
        url, r"-latest\.osm\.pbf", F.concat(F.lit("-"), day, F.lit(".osm.pbf"))))


def dated_name(location: Column, path: Column) -> Column:
    """Name of the dated file a redirect points to; NULL when it is not one of ``path``."""
    name = F.element_at(F.split(F.rtrim(location, F.lit("/")), "/"), -1)
    base = F.element_at(F.split(path, "/"), -1)
    good = (name.startswith(F.concat(base, F.lit("-"))) & name.endswith(".osm.pbf")
            & ~name.contains("latest"))
    return F.when(good, name)


def state_date(state_text: Column) -> Column:
    """YYMMDD from the ``timestamp=`` line of a state file, else NULL."""
    pattern = r"(?m)^timestamp=\s*(\d{4}-\d{2}-\d{2})"
    day = F.nullif(F.regexp_extract(state_text, pattern, 1), F.lit(""))
    return F.translate(F.substring(day, 3, 8), "-", "")


def md5_of(md5_text: Column, name: Column) -> Column:
    """Digest of a ``<md5> *<name>`` line that names exactly ``name``, else NULL."""
    parts = F.split(F.trim(md5_text), r"\s+")
    named = F.ltrim(F.try_element_at(parts, F.lit(2)), F.lit("*")) == name
    return F.when((F.length(parts[0]) == 32) & named, parts[0])


def tag_of(url: Column) -> Column:
    """Release tag of a download url, empty when there is none."""
    return F.regexp_extract(url, r"/download/([^/]*)", 1)


def asset_parts(name: Column) -> Column:
    """``<package>-<date>.<tar|pmtiles>`` → struct(package, date, half); NULL fields otherwise."""
    pattern = r"^(.+)-(.{4}-.{5})\.(tar|pmtiles)$"
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    return F.struct(part(1).alias("package"), part(2).alias("date"), part(3).alias("half"))


def house_sort_key(key: Column) -> list[Column]:
    """Natural order of house keys: number first, then the rest (2, 7, 7a, 10, 10/1, 10a, 11)."""
    number = F.nullif(F.regexp_extract(key, r"^(\d+)", 1), F.lit("")).try_cast("bigint")
    return [number.asc_nulls_last(), F.regexp_replace(key, r"^\d+", "").asc(), key.asc()]
