"""Text functions. Regular expressions here mean the same in Java, RE2 and Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters that count as white space at a text's ends (fixed values).
WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WHITE_CHARACTERS = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
#: A word of the lexical index: letters and numbers of any script, and the low line.
TOKEN = r"[\p{L}\p{N}_]+"


def strip(text: Column) -> Column:
    """text without outer white space, in one pass from either end."""
    return F.btrim(text, F.lit(WHITE_CHARACTERS))


def tokens(text: Column) -> Column:
    """The lower-cased tokens of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def default(value: Column, otherwise: str) -> Column:
    """otherwise, where value is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(otherwise))


def safe_filename(content_id: Column, longest: int = 200) -> Column:
    """A file name for an id. Different ids may share one, so it is no key."""
    safe = F.regexp_replace(content_id, "[^a-zA-Z0-9_-]", "_")
    short = F.concat(F.substring(safe, 1, 180), F.lit("__"), hash_prefix(content_id, 12))
    return F.when(F.length(safe) > longest, short).otherwise(safe)


def hash_prefix(value: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(value, 256), 1, length)


def chunk_id(content_id: Column, index: Column) -> Column:
    return F.concat_ws("::chunk", content_id, index.cast("string"))


def heading_path(*levels: Column) -> Column:
    return F.concat_ws(" > ", *(F.nullif(x, F.lit("")) for x in levels))


def titled_document(title: Column, author: Column, text: Column) -> Column:
    """The text that is embedded for a chunk."""
    return F.concat(F.lit("Title: "), title, F.lit(" | Author: "), author, F.lit("\n"), text)


def iso_date(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(""))


def human_size(n: Column) -> Column:
    """B below 1024, KB below 1024 * 1024, else MB, with one decimal."""
    scaled = lambda by: F.format_string("%.1f", F.round(n / F.lit(float(by)), 1))
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1024 * 1024, F.concat(scaled(1024), F.lit(" KB"))).otherwise(F.concat(scaled(1024 * 1024), F.lit(" MB")))


def split_combo(combo: Column) -> Column:
    """collection and strategy of "collection__strategy", split at the first double low line; anything else fails."""
    parts = F.split(combo, "__", 2)
    good = (F.size(parts) == 2) & (F.get(parts, F.lit(0)) != "") & (F.get(parts, F.lit(1)) != "")
    made = F.struct(F.get(parts, F.lit(0)).alias("collection"), F.get(parts, F.lit(1)).alias("strategy"))
    return F.when(good, made).otherwise(F.raise_error(F.concat(F.lit("no combination of collection and strategy: "), combo)).cast("struct<collection:string,strategy:string>"))
