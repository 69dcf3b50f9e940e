"""Text cleaning and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace of ECMAScript: Java's \s is ASCII only, so Unicode separators
# and the byte order mark are added.
WHITESPACE = r"[\s\p{Z}\x{FEFF}]"


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITESPACE + "+", " "))


def trim_unicode(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WHITESPACE}++|{WHITESPACE}++\z", "")


def strip_html(html: Column) -> Column:
    """Drop tags, resolve entities once, collapse whitespace.

    ``&amp;`` is resolved last, so text that becomes ``&lt;`` by it is not
    resolved again: the chain equals one pass over all entities. Texts without
    markup, the common case, skip the patterns that cannot match.
    """
    bare = F.when(F.contains(html, F.lit("<")), F.regexp_replace(html, r"<[^>]*+>", " ")).otherwise(html)
    text = F.regexp_replace(bare, r"(?i)&(?!(?:amp|lt|gt|quot);)(?:#\d+|[a-z]+);", " ")
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        text = F.regexp_replace(text, f"(?i)&{name};", char)
    return collapse_whitespace(F.when(F.contains(html, F.lit("&")), text).otherwise(bare))


def escape_markup(text: Column) -> Column:
    for char, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        text = F.replace(text, F.lit(char), F.lit(f"&{name};"))
    return text


def article_id(url: Column) -> Column:
    return F.sha2(url, 256)


def paper_url(raw_id: Column) -> Column:
    """Canonical paper address: no version suffix, https."""
    unversioned = F.regexp_replace(trim_unicode(raw_id), r"v\d+\z", "")
    return F.regexp_replace(unversioned, r"(?s)\A(.*?)http://", "$1https://")


def ordinal(source_ord: str = "source_ord", pos: str = "pos") -> Column:
    """(source_ord, pos) as one long that sorts the same way."""
    return F.shiftleft(F.col(source_ord).cast("bigint"), 60) + F.col(pos)


#: Bits for the items of a document; documents of a source type have 40.
ITEM_BITS = 20


def item_pos(doc_pos: Column, item: Column) -> Column:
    """Position of an item inside the landed document number ``doc_pos``.

    Numbers that do not fit raise instead of taking another item's position.
    """
    fits = (item < 1 << ITEM_BITS) & doc_pos.between(0, (1 << 40) - 1)
    place = F.shiftleft(doc_pos.cast("bigint"), ITEM_BITS) + item
    return F.when(fits, place).otherwise(F.raise_error(F.lit("too many documents or items for one position")).cast("bigint"))
