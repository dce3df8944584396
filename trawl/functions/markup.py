"""HTML to plain text, as one Column expression."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F


def named_references() -> dict[str, str]:
    """The named character references of HTML 4, and ``apos``; a hard space is a space."""
    names = {name: chr(code) for name, code in name2codepoint.items()}
    return names | {"apos": "'", "nbsp": " "}


def _decoded(body: Column, known: Column) -> Column:
    """What a reference's body (``eacute``, ``#233``, ``#xE9``) stands for; null for names that
    aren't known, empty for code points out of range."""
    digits = F.when(
        body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10)
    ).otherwise(F.substring(body, 2, 8))
    code = digits.try_cast("int")
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.when(
        F.startswith(body, F.lit("#")), F.when(valid, char).otherwise(F.lit(""))
    ).otherwise(F.try_element_at(known, body))


def _references(text: Column) -> Column:
    """Decode all references in one pass, so that what one yields is not decoded again."""
    known = F.create_map(*[F.lit(x) for pair in named_references().items() for x in pair])
    pieces = F.split(text, r"&(?=#[0-9]{1,7};|#[xX][0-9a-fA-F]{1,6};|[a-zA-Z][a-zA-Z0-9]{1,7};)")

    def decode(piece: Column) -> Column:
        body = F.substring_index(piece, ";", 1)
        rest = piece.substr(F.length(body) + 2, F.length(piece))
        return F.coalesce(F.concat(_decoded(body, known), rest), F.concat(F.lit("&"), piece))

    return F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decode(p))), ""
    )


def strip_html(html: Column) -> Column:
    """Drop scripts, styles, comments and tags (each becomes a space), decode entities.

    Text without markup or references is passed through untouched.
    """
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[!/]?[a-zA-Z][^>]*>", " ")
    bare = F.when(F.contains(html, F.lit("<")), bare).otherwise(html)
    # a one-element transform names the intermediate text, so it is computed once
    decoded = F.transform(
        F.array(bare), lambda t: F.when(F.contains(t, F.lit("&")), _references(t)).otherwise(t)
    )
    return F.try_element_at(decoded, F.lit(1))
