"""Text functions as Column expressions: cleaning, folding, search normal form, cities, splitting.

All of them stay in the JVM.  Case folding is ``lower``.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Text = Column | str


def _col(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


@functools.cache
def fold_tables() -> tuple[str, str]:
    """Characters of the Latin blocks and their base letters, from Unicode decompositions.

    The stroke letters have no decomposition and are added by hand.
    """
    pairs = {"đ": "d", "Đ": "D", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "ħ": "h", "ı": "i"}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            pairs[chr(code)] = base
    keys = sorted(pairs)
    return "".join(keys), "".join(pairs[k] for k in keys)


def strip_accents(x: Text) -> Column:
    """Base letters: accents, strokes and combining marks go; ligatures become two letters."""
    source, target = fold_tables()
    out = F.translate(_col(x), source, target)
    for letter, plain in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE")):
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return F.regexp_replace(out, r"\p{M}+", "")


@functools.cache
def plain_tables(marks: bool) -> tuple[str, str]:
    """``fold_tables`` with the capital sigma, whose small form would depend on its place in a word, and, if
    ``marks``, with the combining marks, which have no counterpart and go; the JVM's own list of them is older."""
    source, target = fold_tables()
    gone = (c for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] == "M") if marks else ()
    return source + "Σ" + "".join(gone), target + "σ"


def plain_form(x: Text, marks: bool = True) -> Column:
    """Lower case without accents and, if ``marks``, combining marks; only ß becomes two letters, null stays null."""
    return F.lower(F.replace(F.translate(_col(x), *plain_tables(marks)), F.lit("ß"), F.lit("ss")))


def blank_to_null(x: Text) -> Column:
    """The trimmed text, or null where nothing is left."""
    return F.nullif(F.trim(_col(x)), F.lit(""))


def visible(x: Text) -> Column:
    """No-break spaces become spaces; zero-width characters go."""
    return F.regexp_replace(F.translate(_col(x), " ", " "), "[​‌‍﻿]", "")


def clean_text(x: Text) -> Column:
    """Lines trimmed and collapsed, no space before punctuation, no blank or repeated neighbour lines.

    Null where nothing is left.
    """
    out = F.regexp_replace(visible(x), "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\n")
    for pattern, plain in (("[\t ]+", " "), (" ?\n[\n ]*", "\n"), ("^[\n ]+|[\n ]+$", ""), (" +([,.;:!?%])", "$1")):
        out = F.regexp_replace(out, pattern, plain)
    # a line goes if the one before equals it
    new = lambda line, before: F.when(~line.eqNullSafe(before), line)
    lines = once(F.split(out, "\n"), lambda x: F.array_compact(F.zip_with(x, F.slice(_shifted(x, "string"), 1, F.size(x)), new)))
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` evaluated one time, however often ``f`` names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _shifted(items: Column, kind: str) -> Column:
    """Items moved on by one.  Pairing an array with this looks back at neighbours in one pass, where
    a lambda that indexes the array would evaluate it anew for every item."""
    return F.concat(F.array(F.lit(None).cast(kind)), items)


def first_spellings(items: Column) -> Column:
    """Items without those equal to an earlier one but for case."""
    kind = "struct<l:string,i:int,s:string>"
    ranked = F.array_sort(F.transform(items, lambda s, i: F.struct(F.lower(s).alias("l"), i.cast("int").alias("i"), s.alias("s"))))
    new = lambda a, b: F.when(a.isNotNull() & ~a["l"].eqNullSafe(b["l"]), F.struct(a["i"].alias("i"), a["s"].alias("s")))
    first = once(ranked, lambda r: F.zip_with(r, _shifted(r, kind), new))
    return F.transform(F.array_sort(F.array_compact(first)), lambda x: x["s"])


def clean_items(items: Text) -> Column:
    """Cleaned items without blanks and repeats; an empty array for null."""
    cleaned = F.filter(F.transform(_col(items), clean_text), lambda s: s.isNotNull())
    return F.coalesce(once(cleaned, first_spellings), F.array().cast("array<string>"))


def split_values(x: Text, separator: str = ",") -> Column:
    return clean_items(F.split(_col(x), separator))


def join_items(items: Text, separator: str = "\n") -> Column:
    """Items as lines, or null where there is none."""
    return F.nullif(F.array_join(_col(items), separator), F.lit(""))


def without_heading(x: Text, heading: str) -> Column:
    """Cleaned text whose first line is dropped if it is the heading, in whatever case."""
    text = clean_text(x)
    lines = F.split(text, "\n")
    rest = F.array_join(F.slice(lines, 2, F.size(lines)), "\n")
    return F.when(F.lower(F.get(lines, F.lit(0))) == heading.strip().lower(), F.nullif(rest, F.lit(""))).otherwise(text)


#: (pattern, replacement) in order, on lower-cased text without accents.
TECHNOLOGY_NAMES = (
    (r"(^|[^a-z0-9_])c\+\+(?=$|[^a-z0-9_+])", "cplusplus"),
    (r"(^|[^a-z0-9_])c#(?=$|[^a-z0-9_])", "csharp"),
    (r"(^|[^a-z0-9_])\.net\b", "dotnet"),
    (r"(^|[^a-z0-9_])node\.js\b", "nodejs"),
)


def search_form(x: Text) -> Column:
    """Normal form for search: no accents, lower case, technology names as words; null becomes empty."""
    out = F.lower(strip_accents(F.coalesce(_col(x), F.lit(""))))
    for pattern, word in TECHNOLOGY_NAMES:
        out = F.regexp_replace(out, pattern, "$1" + word)
    return out


def fold_key(x: Text) -> Column:
    """Lower case, no accents, words joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(x)), r"[^\p{L}\p{N}]+", " "))


def skill_token(x: Text) -> Column:
    """Lower case with single spaces."""
    return F.lower(F.trim(F.regexp_replace(_col(x), r"\s+", " ")))


# Provinces and cities by name, as one list; names of the past are kept.
CITY_NAMES = """
Hà Nội|Hồ Chí Minh|Đà Nẵng|Hải Phòng|Cần Thơ|Huế|An Giang|Bà Rịa - Vũng Tàu|Bắc Giang|Bắc Kạn|Bạc Liêu|Bắc Ninh|
Bến Tre|Bình Định|Bình Dương|Bình Phước|Bình Thuận|Cà Mau|Cao Bằng|Đắk Lắk|Đắk Nông|Điện Biên|Đồng Nai|Đồng Tháp|
Gia Lai|Hà Giang|Hà Nam|Hà Tĩnh|Hải Dương|Hậu Giang|Hòa Bình|Hưng Yên|Khánh Hòa|Kiên Giang|Kon Tum|Lai Châu|
Lâm Đồng|Lạng Sơn|Lào Cai|Long An|Nam Định|Nghệ An|Ninh Bình|Ninh Thuận|Phú Thọ|Phú Yên|Quảng Bình|Quảng Nam|
Quảng Ngãi|Quảng Ninh|Quảng Trị|Sóc Trăng|Sơn La|Tây Ninh|Thái Bình|Thái Nguyên|Thanh Hóa|Thừa Thiên Huế|
Tiền Giang|Trà Vinh|Tuyên Quang|Vĩnh Long|Vĩnh Phúc|Yên Bái
"""
# Other spellings of cities, already folded.
CITY_SPELLINGS = {
    "hanoi": "Hà Nội", "hcm": "Hồ Chí Minh", "hcmc": "Hồ Chí Minh", "tp hcm": "Hồ Chí Minh", "tphcm": "Hồ Chí Minh",
    "saigon": "Hồ Chí Minh", "sai gon": "Hồ Chí Minh", "danang": "Đà Nẵng", "haiphong": "Hải Phòng", "cantho": "Cần Thơ",
}


@functools.cache
def city_index() -> dict[str, str]:
    """Folded spelling to city name."""
    source, target = fold_tables()
    table = str.maketrans(source, target)
    fold = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.translate(table).lower()).split())
    names = [n.strip() for n in CITY_NAMES.replace("\n", "").split("|")]
    return {fold(n): n for n in names} | CITY_SPELLINGS


def location_cities(addresses: Text) -> Column:
    """Cities named by whole components of the addresses, in order, each once.

    A component is what stands between ``,;:/|`` and line ends; leading words for city or province
    and trailing ``city`` or ``province`` are ignored.  Streets named after a city do not count.
    """
    index = F.create_map(*[F.lit(x) for pair in sorted(city_index().items()) for x in pair])
    parts = F.flatten(F.transform(_col(addresses), lambda a: F.split(a, r"[,;:\n/|]")))
    keys = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(fold_key(p), r"^(?:thanh pho|tinh|tp)\s+", ""), r"\s+(?:city|province)$", ""))
    found = F.filter(F.transform(keys, lambda k: F.element_at(index, k)), lambda c: c.isNotNull())
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def safe_name(x: Text) -> Column:
    """Letters, digits, dot, dash and underscore; all else becomes one dash."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_col(x))), r"[^a-z0-9._-]+", "-"), "^-+|-+$", "")


def page_count(x: Text, per_page: int) -> Column:
    """Pages for the first number in a text, with dots and commas between its digits; at least 1."""
    number = F.regexp_replace(F.regexp_extract(_col(x), r"(\d[\d.,]*)", 1), r"[.,]", "")
    return F.when(number != "", F.greatest(F.ceil(number.cast("long") / per_page), F.lit(1)).cast("int"))


def cut_at_heading(x: Text, headings: list[str]) -> Column:
    """Text before the first line that is one of the headings (any case, optional colon)."""
    words = "|".join(f"\\Q{h}\\E" for h in headings)
    head = F.get(F.split(_col(x), rf"(?imu)^\s*(?:{words})\s*:?\s*$", 2), F.lit(0))
    return F.nullif(F.regexp_replace(head, r"^\s+|\s+$", ""), F.lit(""))


def quote_in_any(texts: Text, quote: Column) -> Column:
    """Does a text hold the quote, white space aside?"""
    flat = lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.exists(F.coalesce(_col(texts), F.array().cast("array<string>")), lambda t: F.coalesce(F.contains(flat(t), flat(quote)), F.lit(False)))


def bare_url(url: Text, host: str | None = None, slash: bool = True) -> Column:
    """URL without query and fragment, with a fixed host and without a final slash where asked for."""
    out = F.regexp_replace(_col(url), r"[?#].*$", "")
    if host:
        out = F.regexp_replace(out, r"^[a-zA-Z]+://[^/]*", f"https://{host}")
    return out if slash else F.regexp_replace(out, r"/+$", "")


def url_number(url: Text, pattern: str) -> Column:
    """First group of the pattern in the URL's path, or null."""
    return F.nullif(F.regexp_extract(F.regexp_replace(_col(url), r"^[a-zA-Z]+://[^/]*|[?#].*$", ""), pattern, 1), F.lit(""))
