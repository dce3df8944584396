"""SQL text for the analysis steps, written relationally (tokens as rows).

The Spark side works on arrays inside a row; these fragments number tokens with
window functions instead, so the two are independent formulations.
"""

from __future__ import annotations

from trawl.functions import rules

# Expected foldings and references of the given tables, stated apart from the engine's.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy"
SPELT = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe"}
REFERENCES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&copy;": "©",
    "&middot;": "·", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—", "&euro;": "€",
    "&auml;": "ä", "&ouml;": "ö", "&uuml;": "ü", "&szlig;": "ß", "&eacute;": "é",
}

STOPS = ", ".join(f"'{w}'" for w in rules.STOPWORDS)
WS = f"[{rules.WHITESPACE}]+"
PARTS_CASE = r"[\p{Lu}\p{Lt}]+[\p{Ll}\p{Lm}\p{Lo}\p{M}]*|[\p{Ll}\p{Lm}\p{Lo}\p{M}]+|\p{N}+"
PARTS_PLAIN = r"[\p{L}\p{M}]+|\p{N}+"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fold(expr: str) -> str:
    out = f"translate({expr}, {quote(ACCENTED)}, {quote(PLAIN)})"
    for ch, spelling in SPELT.items():
        out = f"replace({out}, {quote(ch)}, {quote(spelling)})"
    return f"CASE WHEN strlen({expr}) > length({expr}) THEN {out} ELSE {expr} END"


def strip_html(expr: str) -> str:
    out = expr
    for tag in ("script", "style"):
        out = rf"regexp_replace({out}, '(?is)<{tag}\b.*?</{tag}\s*>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?s)<!--.*?-->', ' ', 'g')"
    out = f"regexp_replace({out}, '<[!/]?[a-zA-Z][^>]*>', ' ', 'g')"
    for reference, char in REFERENCES.items():
        out = f"replace({out}, {quote(reference)}, {quote(char)})"
    return f"replace({out}, '&amp;', '&')"


def words(source: str, out: str = "tok", splitter: str | None = None) -> str:
    """CTE ``tok(field, doc_id, val_no, i, w)`` of blank-separated words."""
    split = splitter or f"list_filter(regexp_split_to_array(text, {quote(WS)}), lambda t: t <> '')"
    return f"""{out}_list AS MATERIALIZED (
  SELECT field, doc_id, val_no, {split} AS ws FROM ({source})),
{out} AS MATERIALIZED (
  SELECT field, doc_id, val_no, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM {out}_list)"""


def terms(source: str, name: str = "terms", case: bool = True, catenate: bool = True,
          parts: bool = True, finish: str = "fold", stop: bool = True) -> str:
    """CTE ``name(field, doc_id, val_no, pos, term)`` of the word-delimiter chains."""
    pattern = quote(PARTS_CASE if case else PARTS_PLAIN)
    bare = rf"regexp_replace(w, '(\p{{L}})''[sS]($|[^\p{{L}}\p{{N}}])', '\1\2', 'g')"
    lowered = {"fold": fold("lower(p)"), "lower": "lower(p)", "none": "p"}[finish]
    stopped = f"lower(w) IN ({STOPS})" if stop else "false"
    numbered = f"""{words(source, name + '_w')},
{name}_parts AS (
  SELECT field, doc_id, val_no, i,
         CASE WHEN {stopped} THEN [''] ELSE regexp_extract_all({bare}, {pattern}) END AS ps
  FROM {name}_w),
{name}_piece AS (
  SELECT field, doc_id, val_no, i, unnest(ps) AS p, generate_subscripts(ps, 1) AS j
  FROM {name}_parts),
{name}_kind AS (
  SELECT *, regexp_matches(p, '^\\p{{N}}') AS digit FROM {name}_piece),
{name}_isle AS (
  SELECT *, j - row_number() OVER (PARTITION BY field, doc_id, val_no, i, digit ORDER BY j) AS isle
  FROM {name}_kind)"""
    if parts:
        runs = f"""
  UNION ALL
  SELECT field, doc_id, val_no, max(pos) AS pos, string_agg(p, '' ORDER BY j) AS p
  FROM {name}_at WHERE p <> ''
  GROUP BY field, doc_id, val_no, i, digit, isle HAVING count(*) > 1""" if catenate else ""
        return f"""{numbered},
{name}_at AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY field, doc_id, val_no ORDER BY i, j) - 1 AS pos
  FROM {name}_isle),
{name} AS MATERIALIZED (
  SELECT field, doc_id, val_no, pos, {lowered} AS term FROM (
  SELECT field, doc_id, val_no, pos, p FROM {name}_at WHERE p <> ''{runs}) AS x)"""
    return f"""{numbered},
{name}_run AS (
  SELECT field, doc_id, val_no, i, min(j) AS j, string_agg(p, '' ORDER BY j) AS p
  FROM {name}_isle GROUP BY field, doc_id, val_no, i, digit, isle),
{name} AS MATERIALIZED (
  SELECT field, doc_id, val_no, pos, {lowered} AS term FROM (
    SELECT *, row_number() OVER (PARTITION BY field, doc_id, val_no ORDER BY i, j) - 1 AS pos
    FROM {name}_run) AS y WHERE p <> '')"""


def listing(source: str, name: str = "terms") -> str:
    """One row per document: ``doc_id, n_terms, terms`` as ``pos:term`` pairs."""
    return f"""SELECT s.doc_id, count(t.term) AS n_terms,
       coalesce(string_agg(t.pos || ':' || t.term, ' ' ORDER BY t.pos, t.term), '') AS terms
FROM ({source}) AS s LEFT JOIN {name} AS t ON t.doc_id = s.doc_id
GROUP BY s.doc_id"""


DOCUMENTS = "SELECT 'text' AS field, doc_id, 0 AS val_no, text FROM documents"
PAGES = f"SELECT 'html' AS field, page_id AS doc_id, 0 AS val_no, {strip_html('html')} AS text FROM pages"


def scored(parts: list[list[tuple[str, str, float]]], name: str = "terms") -> str:
    """CTEs up to ``hits(doc_id, score)``: every part must match.

    Each part is a list of alternatives ``(field, term, weight)``.
    """
    rows = ", ".join(
        f"({n}, {quote(f)}, {quote(t)}, CAST({w} AS DOUBLE))"
        for n, alternatives in enumerate(parts) for f, t, w in alternatives
    )
    return f"""want(part, field, term, weight) AS (VALUES {rows}),
{SCORING.format(name=name)},
hits AS (
  SELECT doc_id, round(sum(s), 6) AS score FROM piece
  GROUP BY doc_id HAVING count(DISTINCT part) = {len(parts)})"""


# lengths, frequencies and per-part scores; needs ``want`` and ``total(n)``
SCORING = """size AS (SELECT field, doc_id, count(*) AS n_terms FROM {name} GROUP BY 1, 2),
freq AS (
  SELECT t.field, t.term, t.doc_id, count(*) AS tf FROM {name} t
  WHERE EXISTS (SELECT 1 FROM want w WHERE w.field = t.field AND w.term = t.term)
  GROUP BY 1, 2, 3),
docfreq AS (SELECT field, term, count(*) AS df FROM freq GROUP BY 1, 2),
piece AS (
  SELECT w.part, f.field, f.doc_id,
         w.weight * sqrt(f.tf) * (1 + ln(total.n::DOUBLE / (d.df + 1)))
           * (1 + ln(total.n::DOUBLE / (d.df + 1))) / sqrt(z.n_terms) AS s
  FROM want w JOIN freq f USING (field, term) JOIN docfreq d USING (field, term)
  JOIN size z USING (field, doc_id), total)"""


# Stemming -------------------------------------------------------------------

_V, _C = "[aeiouy]", "[^aeiouy]"
# The suffixes of the published algorithm's steps 2 to 4, stated apart from the engine's.
SUFFIXES = (
    ("ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous"
     " ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive"
     " biliti>ble logi>log", 0),
    ("icate>ic ative> alize>al iciti>ic ical>ic ful> ness>", 0),
    ("al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>", 1),
)


def _over(expr: str, least: int) -> str:
    return f"regexp_matches({expr}, '^{_C}*({_V}+{_C}+){{{least}}}{_V}+{_C}')"


def _one(expr: str) -> str:
    return f"regexp_matches({expr}, '^{_C}*{_V}+{_C}+{_V}*$')"


def _cvc(expr: str) -> str:
    return f"regexp_matches({expr}, '{_C}{_V}[^aeiouywxY]$')"


def stems(source: str, name: str = "stems") -> str:
    """CTE ``name(term, stem)`` of the distinct terms of ``source``; a consonant y is written Y."""
    steps = [f"""{name}_0 AS (SELECT term, regexp_replace(term, '(^|[aeiouy])y', '\\1Y', 'g') AS w
  FROM (SELECT DISTINCT term FROM {source}) AS x WHERE length(term) > 2 AND term NOT IN ('dontstems', 'zwhacky'))""".replace("\\\\", "\\"),
        f"""{name}_1 AS (SELECT term, CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN w[:-3]
  WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN w[:-2] ELSE w END AS w FROM {name}_0)""",
        f"""{name}_2 AS (SELECT term, w, CASE WHEN w LIKE '%eed' THEN NULL
  WHEN w LIKE '%ed' AND regexp_matches(w[:-3], '{_V}') THEN w[:-3]
  WHEN w LIKE '%ing' AND regexp_matches(w[:-4], '{_V}') THEN w[:-4] END AS cut FROM {name}_1)""",
        f"""{name}_3 AS (SELECT term, CASE WHEN w LIKE '%eed' THEN CASE WHEN {_over('w[:-4]', 0)} THEN w[:-2] ELSE w END
  WHEN cut IS NULL THEN w WHEN regexp_matches(cut, '(at|bl|iz)$') THEN cut || 'e'
  WHEN lower(cut[-1]) = lower(cut[-2]) AND length(cut) > 1 AND regexp_matches(cut, '[^aeiouylsz]$') THEN cut[:-2]
  WHEN {_one('cut')} AND {_cvc('cut')} THEN cut || 'e' ELSE cut END AS w FROM {name}_2)""",
        f"""{name}_4 AS (SELECT term, CASE WHEN w[-1] IN ('y', 'Y') AND regexp_matches(w[:-2], '{_V}')
  THEN w[:-2] || 'i' ELSE w END AS w FROM {name}_3)"""]
    last = f"{name}_4"
    for n, (table, least) in enumerate(SUFFIXES):
        pairs = [pair.split(">") for pair in table.split()]
        found = f"regexp_extract(w, '({'|'.join(a for a, _ in pairs)})$')"
        new = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs)
        steps.append(f"""{name}_s{n} AS (SELECT *, left(w, length(w) - length(suffix)) AS stem
  FROM (SELECT term, w, {found} AS suffix FROM {last}) AS x),
{name}_t{n} AS (SELECT term, CASE WHEN suffix <> '' AND {_over('stem', least)}
  AND (suffix <> 'ion' OR regexp_matches(stem, '[st]$')) THEN stem || CASE suffix {new} END ELSE w END AS w
  FROM {name}_s{n})""")
        last = f"{name}_t{n}"
    steps.append(f"""{name}_e AS (SELECT term, CASE WHEN w LIKE '%e' AND ({_over('w[:-2]', 1)}
  OR {_one('w[:-2]')} AND NOT {_cvc('w[:-2]')}) THEN w[:-2] ELSE w END AS w FROM {last}),
{name} AS (SELECT DISTINCT x.term, coalesce(lower(CASE WHEN w LIKE '%ll' AND {_over('w', 1)} THEN w[:-2] ELSE w END), x.term) AS stem
  FROM {source} AS x LEFT JOIN {name}_e USING (term))""")
    return ",\n".join(steps)
