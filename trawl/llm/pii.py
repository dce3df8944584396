"""Personal data: fixed patterns, and identifiers found by bootstrapping from their contexts.

Base spans are e-mail and IP addresses, card and phone numbers. They are the seeds. Tokens that look
like identifiers, seeds among them, are joined with the lexical patterns around them: the two words
before, and one word on each side. Over rounds, a pattern's confidence in a kind is the sum of its
distinct instances' scores over their number (and one more), and an instance that isn't a seed
scores as its most confident pattern. A pattern counts from ``SUPPORT`` instances and ``CONFIDENCE``
on. In the end the patterns discover identifiers that no base pattern matches, next to base spans
and never over them.

The graph is kept in tables and scored by joins and sums; no pattern's or instance's links are
gathered in one place. A context is read from the 80 characters before an identifier and the 40 after
it, so a longer word there counts by its nearer part. What a text costs grows in proportion to its
length. Null texts are empty and have no spans. Rows are told apart by id and text, so
rows with equal ids keep their own spans, and equal rows have equal ones. Empty tables give no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trawl.llm.common import add_columns, saved

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 5
CONFIDENCE = 0.8
#: An identifier is a token of this many characters, with a digit or an at sign.
TOKEN_CHARS = 6

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its first digit alone: what follows it is the same from all others
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGITS = str.maketrans("", "", " ().-+")
_TOKEN = re.compile(r"[^\x00-\x20]*[0-9@][^\x00-\x20]*")
_EDGE = ".,;:!?()[]{}<>\"'|"


def emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        before = text[end:at]
        start = end + len(before.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at) if start < at else None
        end = match.end() if match else at + 1
        if match:
            yield start, end
        at = text.find("@", end)


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].translate(_NOT_DIGITS)
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(m[0].translate(_NOT_DIGITS)) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _words_before(text: str, at: int) -> list[str]:
    return [""] * 2 + [w.strip(_EDGE).lower() for w in text[max(0, at - 80):at].split()]


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Identifiers with their contexts: base spans, and tokens that overlap none."""
    found = [(a, b, kind) for kind, a, b in spans]
    if "@" in text or _DIGIT.search(text):
        begun, reach = 0, 0  # base spans that begin before the token ends, and how far they go
        for m in _TOKEN.finditer(text):
            token = m[0].strip(_EDGE)
            a = m.start() + m[0].find(token)
            b = a + len(token)
            while begun < len(spans) and spans[begun][1] < b:
                reach = max(reach, spans[begun][2])
                begun += 1
            if len(token) >= TOKEN_CHARS and _TOKEN.match(token) and reach <= a:
                found.append((a, b, None))
    out = []
    for a, b, kind in found:
        before = _words_before(text, a)
        after = [w.strip(_EDGE).lower() for w in text[b:b + 40].split()[:1]] or [""]
        out.append({"start": a, "end": b, "seed": kind, "instance": text[a:b].lower(),
                    "patterns": [f"L {before[-2]} {before[-1]}", f"M {before[-1]} _ {after[0]}"]})
    return out


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])
_CANDIDATE = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("seed", T.StringType()),
    T.StructField("instance", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType()))])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_ARROW_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.string()),
                              ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])


def _extract(rows: DataFrame) -> DataFrame:
    def start():
        def step(texts: pa.Array):
            spans, found = [], []
            for text in texts.to_pylist():
                own = base_spans(text or "")
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in own])
                found.append(candidates(text or "", own))
            return [pa.array(spans, pa.list_(_ARROW_SPAN)), pa.array(found, pa.list_(_ARROW_CANDIDATE))]

        return step

    return add_columns(rows, [T.StructField("base", T.ArrayType(_SPAN)), T.StructField("found", T.ArrayType(_CANDIDATE))],
                       ["text"], start, ("text",))


def confident_patterns(graph: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT,
                       confidence: float = CONFIDENCE) -> DataFrame:
    """``pattern``, ``kind``, ``confidence`` out of the links ``pattern``, ``instance``, ``seed``."""
    edges = saved(graph.select("pattern", "instance").distinct(), "edges")
    seeds = saved(graph.where("seed IS NOT NULL").select("instance", F.col("seed").alias("kind")).distinct()
                  .withColumn("score", F.lit(1.0)), "seeds")
    width = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    scores = seeds
    for _ in range(rounds):
        good = edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("s")) \
            .where(F.col("s") >= support).join(width, "pattern") \
            .select("pattern", "kind", (F.col("s") / (F.col("n") + 1)).alias("confidence")) \
            .where(F.col("confidence") >= confidence)
        good = saved(good, "patterns")
        unseen = edges.join(seeds.select("instance").distinct(), "instance", "left_anti").join(good, "pattern") \
            .groupBy("instance", "kind").agg(F.max("confidence").alias("score"))
        scores = seeds.unionByName(unseen)
    return good


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``more``: arrays of ``kind``, ``start`` and ``end`` (code points, end
    exclusive) of the base spans and of those the contexts discover."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    rows = saved(_extract(rows), "found")
    each = rows.where(F.size("found") > 0).select("doc_id", "h", F.explode("found").alias("c"))
    graph = saved(each.select("doc_id", "h", "c.start", "c.end", "c.seed", "c.instance", F.explode("c.patterns").alias("pattern")), "graph")
    good = confident_patterns(graph)
    hits = graph.where("seed IS NULL").join(good, "pattern").groupBy("doc_id", "h", "start", "end").agg(
        F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
    more = hits.groupBy("doc_id", "h").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")) \
        .withColumnsRenamed({"doc_id": "d2", "h": "h2"})
    empty = F.array().cast(T.ArrayType(_SPAN))
    return rows.join(more, rows["doc_id"].eqNullSafe(F.col("d2")) & (rows["h"] == F.col("h2")), "left").select(
        "doc_id", F.coalesce("base", empty).alias("base"), F.coalesce("more", empty).alias("more"))


def span_list(spans):
    """``kind:start:end`` by start, then by kind as listed, comma-joined."""
    order = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
