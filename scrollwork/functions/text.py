"""Text as column expressions: blank tests, fallbacks, cleaning, rendering, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """No character other than white space (Unicode's); null is blank."""
    return ~F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, or the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def rendered(original: Column, text: Column) -> Column:
    """What an item shows: its original wording unless blank, else its text, else nothing."""
    return F.coalesce(F.when(~is_blank(original), original), text, F.lit(""))


def right_stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def clean_cell(c: Column) -> Column:
    """A table cell on one line: tabs and line ends become spaces, outer white space goes."""
    one_line = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "\t", " "), r"\r\n|[\n\r\u000B\u000C\u001C-\u001E\u0085  ]", " ")
    return F.regexp_replace(one_line, r"(?U)^\s+|\s+$", "")


def render_grid(grid: Column) -> Column:
    """Rows of cells as lines of tab-separated text, each line and the whole right-stripped."""
    lines = F.transform(grid, lambda row: right_stripped(F.array_join(F.transform(row, clean_cell), "\t")))
    return right_stripped(F.array_join(lines, "\n"))


def join_filled(parts: Column, separator: str = "\n") -> Column:
    return F.array_join(F.filter(parts, lambda p: p != ""), separator)


def joined_length(lengths: Column) -> Column:
    """Characters of parts joined by one separator; empty parts take none. `lengths`: array of lengths."""
    filled = F.filter(lengths, lambda n: n > 0)
    return F.aggregate(filled, F.lit(0).cast("long"), lambda s, n: s + n) + F.greatest(F.size(filled) - 1, F.lit(0))


def pages_of(pages: Column) -> Column:
    """Sorted distinct positive page numbers."""
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(pages, F.array().cast("array<int>")), lambda p: p > 0)))


def casefolded(c: Column) -> Column:
    """Lower case, and letters that differ from their lower case only at a word's end or in upper case as those they stand
    for: sharp s as ss, long s as s, final sigma as sigma."""
    return F.replace(F.translate(F.lower(c), "ſς", "sσ"), F.lit("ß"), F.lit("ss"))


def normal_role(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), r"(?U)\s+", "_")


def normal_key(c: Column) -> Column:
    """Letters of a field name, lower case."""
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def numbered(prefix: str, n: Column) -> Column:
    return F.format_string(prefix + "-%06d", n)


def id_position(item_id: Column) -> Column:
    return F.element_at(F.split(item_id, "/"), -1).cast("int")


def id_collection(item_id: Column) -> Column:
    return F.element_at(F.split(item_id, "/"), 2)


def json_string(text: Column) -> Column:
    """A string as JSON in ASCII: what is not visible ASCII is a short escape or \\u and four digits, two of these beyond
    the first 65,536 characters."""
    unit = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))

    def escaped(c: Column) -> Column:
        code = F.ascii(c)
        short = F.element_at(F.create_map(*map(F.lit, [x for pair in _ESCAPES.items() for x in pair])), c)
        pair = F.concat(unit(F.lit(0xD800) + F.shiftright(code - 0x10000, 10)), unit(F.lit(0xDC00) + (code - 0x10000) % 1024))
        return F.coalesce(short, F.when(code.between(0x20, 0x7E), c).when(code < 0x10000, unit(code)).otherwise(pair))

    plain = text.rlike(r'^[ !#-\[\]-~]*$')
    return F.when(text.isNotNull(), F.concat(F.lit('"'), F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), escaped), "")), F.lit('"')))


#: Characters with an escape of their own in JSON.
_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def json_list(values: Column) -> Column:
    """An array of strings as JSON with ', ' between."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, json_string), ", "), F.lit("]"))


def group_id(source: Column, taxonomy: Column, topic: Column, evidence: Column, context: Column) -> Column:
    """Identity of a passage group: the SHA-256 of what it is made of, as a JSON list."""
    whole = F.concat(F.lit("["), F.concat_ws(", ", *map(json_string, (source, taxonomy, topic)), *map(json_list, (evidence, context))), F.lit("]"))
    return F.concat(F.lit("passage-"), F.sha2(whole.cast("binary"), 256))


def html_safe_json(c: Column) -> Column:
    for plain, code in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c
