"""Default text rules.

These are fixed values: results must equal those of the engine being matched,
so the lists are stated as they are and in their usual order.
"""

from __future__ import annotations

# Default stop words.
STOPWORDS = """
stopworda stopwordb
a an and are as at be but by for if in into is it no not of on or s such t
that the their then there these they this to was will with
""".split()

# Default synonym rules, "x => y" replaces, "x,y" groups.
SYNONYMS = """
aaafoo => aaabar
bbbfoo => bbbfoo bbbbar
cccfoo => cccbar cccbaz
fooaaa,baraaa,bazaaa
GB,gib,gigabyte,gigabytes
MB,mib,megabyte,megabytes
Television, Televisions, TV, TVs
pixima => pixma
"""

# Words the stemmer must leave alone.
PROTECTED = ["dontstems", "zwhacky"]

# Fixed values: (query text, document id, excluded) pinning rules.
ELEVATION = [
    ("foo bar", "1", False),
    ("foo bar", "2", False),
    ("foo bar", "3", False),
    ("ipod", "MA147LL/A", False),
    ("ipod", "IW-02", True),
]

# Characters Java's WhitespaceTokenizer splits on.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}"
    r"\x{2028}\x{2029}\x{205f}\x{3000}"
)


def synonym_groups(text: str = SYNONYMS) -> list[tuple[list[str], list[str], bool]]:
    """Rule lines as ``(left, right, is_group)``; a group has no right side."""
    rules = []
    for line in text.splitlines():
        line = line.split("#", 1)[0].strip()
        if not line:
            continue
        left, arrow, right = line.partition("=>")
        names = [w.strip() for w in left.split(",") if w.strip()]
        if arrow:
            rules.append((names, right.replace(",", " ").split(), False))
        else:
            rules.append((names, [], True))
    return rules


def synonym_map(text: str = SYNONYMS, expand: bool = True) -> dict[str, list[str]]:
    """Lower-cased word to its replacement words (case is ignored on the left)."""
    out: dict[str, list[str]] = {}
    for names, right, is_group in synonym_groups(text):
        targets = right if not is_group else (names if expand else names[:1])
        for name in names:
            seen = out.setdefault(name.lower(), [])
            seen.extend(t.lower() for t in targets if t.lower() not in seen)
    return out
