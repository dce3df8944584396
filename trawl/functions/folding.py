"""ASCII folding of Latin letters, built from Unicode decomposition."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# Letters without a decomposition, and their ASCII spelling.
LETTERS = {
    "Ð": "D", "ð": "d", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h",
    "ı": "i", "Ł": "L", "ł": "l", "Ŧ": "T", "ŧ": "t", "ĸ": "q", "Ŋ": "N", "ŋ": "n",
    "ſ": "s", "Ŀ": "L", "ŀ": "l", "⁄": "/", "‘": "'", "’": "'", "‚": "'", "‹": "'", "›": "'", "“": '"', "”": '"',
    "„": '"', "«": '"', "»": '"', "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-",
}
EXPANSIONS = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe",
    "Þ": "TH", "þ": "th", "Ĳ": "IJ", "ĳ": "ij", "ŉ": "'n",
}


# Latin letters and what is written with them: accented, phonetic modifiers, raised and lowered,
# encircled, ligatures, full width.
BLOCKS = (
    (0xB2, 0x250), (0x1D00, 0x1DC0), (0x1E00, 0x1F00), (0x2070, 0x20A0), (0x2460, 0x24F0),
    (0x2C60, 0x2C80), (0xA720, 0xA800), (0xFB00, 0xFB07), (0xFF01, 0xFF5F),
)


def foldings() -> dict[str, str]:
    """Every letter that folds to ASCII, and its spelling."""
    table = LETTERS | EXPANSIONS
    for cp in (cp for block in BLOCKS for cp in range(*block)):
        ch = chr(cp)
        base = "".join(
            c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)
        )
        if base.strip() and base.isascii():
            table.setdefault(ch, base)
    return table


def ascii_fold(text: Column) -> Column:
    """Letters beyond ASCII to their spelling; pure ASCII input is passed through."""
    table = foldings()
    single = {ch: to for ch, to in table.items() if len(to) == 1}
    longer = {ch: to for ch, to in table.items() if len(to) > 1}
    folded = F.translate(text, "".join(single), "".join(single.values()))
    spelt = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    some = f"[{''.join(longer)}]"

    def spell(piece: Column) -> Column:
        first = F.left(piece, F.lit(1))
        return F.concat(F.coalesce(F.try_element_at(spelt, first), first), F.substr(piece, F.lit(2)))

    pieces = F.split(folded, f"(?={some})")
    spelled = F.array_join(F.transform(pieces, spell), "")
    return (
        F.when(F.length(text) == F.octet_length(text), text)
        .when(text.rlike(some), spelled).otherwise(folded)
    )
