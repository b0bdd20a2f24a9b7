"""Column expressions over page text (inventory rows B1-B5, B9-B13, A16, F2, F26, I4, J2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASHES = "—–－﹣"


def rx(pattern: str) -> str:
    """A pattern with Unicode classes on, so that wide spaces and digits count as such."""
    return "(?U)" + pattern


def squash(c: Column) -> Column:
    """B2: without any white space."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), rx(r"\s+"), "")


def norm(c: Column) -> Column:
    """B1: without white space, the four dashes as a hyphen. A pattern, as translate() makes a string of each character."""
    return F.regexp_replace(squash(c), f"[{DASHES}]", "-")


def page_norm(lines: Column) -> Column:
    """norm() of a page's lines, joined without anything between: a text without white space or dashes, which one look tells, is taken as it is."""
    return let(F.coalesce(F.array_join(lines, ""), F.lit("")), lambda t: F.when(t.rlike(rx(rf"[\s{DASHES}]")), norm(t)).otherwise(t))


# What white space is to a pattern with Unicode classes on; what ends a line besides the newline (an empty line between the two of \r\n goes like all others).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BREAKS = r"[\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"


def lines_of(text: Column) -> Column:
    """Trimmed non-empty lines; positions count after empty lines are gone. Split at one plain character and trimmed by a set of characters: a split by pattern
    compiles it for every row, and a pattern that trims searches the whole line."""
    cut = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), BREAKS, "\n"), "\n")
    return F.filter(F.transform(cut, lambda x: F.btrim(x, F.lit(SPACE))), lambda x: x != "")


# The two date forms that make a dense line.
DATE = r"(?:19|20)\d{2}年(?:\d{1,2}月)?(?:\d{1,2}日)?"
DATE_DASHED = r"(?:19|20)\d{2}[-./]\d{1,2}(?:[-./]\d{1,2})?"


def dense_split(line: Column, date: str = DATE, chars: int = 120, dates: int = 2) -> Column:
    """A long line with several dates as its prefix and one segment for each date; other lines as they are."""
    cut = F.filter(F.split(F.regexp_replace(line, f"({date})", "\u0001$1"), "\u0001"), lambda x: F.trim(x) != "")
    return F.when((F.length(line) >= chars) & (F.regexp_count(line, F.lit(date)) >= dates), cut).otherwise(F.array(line))


def match_context(text: Column, found: Column, size: int = 55) -> Column:
    """The first occurrence of found with `size` characters on both sides."""
    pos = F.instr(text, found)
    start = F.greatest(F.lit(1), pos - size)
    return F.substring(text, start, pos + F.length(found) + size - start)


def clean_title(c: Column, size: int = 180) -> Column:
    """Single spaces, cut with an ellipsis."""
    one = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rx(r"\s+"), " "))
    return F.when(F.length(one) > size, F.concat(F.rtrim(F.substring(one, 1, size - 1)), F.lit("…"))).otherwise(one)


def printed_page(raw: Column) -> Column:
    """struct(prefix, number) of `12`, `1-1-37` or `第12页`."""
    flat = norm(raw)
    tail = F.regexp_extract(flat, r"(\d+)\D*$", 1)
    prefix = F.regexp_extract(flat, r"^(\d+(?:-\d+)*)-\d+$", 1)
    return F.struct(F.when(prefix != "", prefix).alias("prefix"), F.when(tail != "", tail.cast("int")).alias("number"))


def format_printed(prefix: Column, number: Column) -> Column:
    return F.concat_ws("-", prefix, number.cast("string"))


def date_key(c: Column) -> Column:
    """a partial date as YYYY[-MM[-DD]], from the form with 年月日 or with separators; other text stays."""
    flat = squash(c)
    pattern = r"^((?:19|20)\d{2})(?:年|[-./])?(?:(\d{1,2})(?:月|[-./])?)?(?:(\d{1,2})日?)?"
    y, m, d = (F.regexp_extract(flat, pattern, i) for i in (1, 2, 3))
    two = lambda x: F.when(x != "", F.lpad(x, 2, "0"))
    return F.when(y == "", flat).otherwise(F.concat_ws("-", y, two(m), F.when(m != "", two(d))))


def date_struct(key: Column) -> Column:
    """Year, month and day of a partial date key, 0 where missing; null for other text."""
    p = F.split(key, "-")
    part = lambda i: F.coalesce(F.get(p, F.lit(i)).try_cast("int"), F.lit(0))
    return F.when(key.rlike(r"^\d{4}(-\d{1,2}){0,2}$"), F.struct(part(0).alias("y"), part(1).alias("m"), part(2).alias("d")))


def parse_number(c: Column) -> Column:
    """I4: decimal(38,6), commas of both widths allowed; null if it isn't a number."""
    return F.regexp_replace(c, "[,，]", "").try_cast("decimal(38,6)")


# Unit, currency, base unit, multiplier.
UNITS = [
    ("亿元", "CNY", "元", "100000000"), ("万元", "CNY", "元", "10000"), ("元", "CNY", "元", "1"), ("亿股", None, "股", "100000000"),
    ("万股", None, "股", "10000"), ("股", None, "股", "1"), ("元/股", "CNY", "元/股", "1"), ("%", None, "%", "0.01"),
]


def chinese_number(c: Column) -> Column:
    """digits or Chinese numerals below a hundred; null otherwise."""
    ones = F.create_map(*[F.lit(x) for k, v in zip("零一二两三四五六七八九", (0, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9), strict=True) for x in (k, v)])
    one = lambda x, empty: F.when(x == "", F.lit(empty)).otherwise(ones[x])
    tens, rest = F.substring_index(c, "十", 1), F.substring_index(c, "十", -1)
    return (
        F.when(c.rlike(r"^\d+$"), c.try_cast("int"))
        .when(c.rlike("^[零一二两三四五六七八九]$"), ones[c])
        .when(c.rlike("^[一二两三四五六七八九]?十[一二三四五六七八九]?$"), one(tens, 1) * 10 + one(rest, 0))
    )


def within_tolerance(calc: Column, disclosed: Column, absolute, share) -> tuple[Column, Column, Column]:
    """(passed, absolute difference, relative difference); a disclosed zero has no relative difference."""
    diff = F.abs(calc - disclosed)
    part = F.when(disclosed != 0, diff / F.abs(disclosed))
    return (diff <= F.lit(absolute)) | F.coalesce(part <= F.lit(share), F.lit(False)), diff, part


def let(value: Column, use) -> Column:
    """use(value) with value evaluated once, where an expression would repeat it."""
    return F.transform(F.array(value), use)[0]


def fixed(df, **columns: Column):
    """df with the columns, each computed once: a generator's output isn't pushed into filters or joined with later projections."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def any_of(terms) -> str:
    """One alternation of quoted terms, longest first."""
    return "|".join(_quote(t) for t in sorted(terms, key=lambda t: (-len(t), t)))


def _quote(t: str) -> str:
    import re

    return re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", t)


def any_term(c: Column, terms) -> Column:
    return c.rlike(any_of(terms)) if terms else F.lit(False)
