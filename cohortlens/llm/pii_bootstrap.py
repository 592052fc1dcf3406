"""Personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, IP addresses, card and phone numbers;
these are the seeds. The words around an identifier are lexical patterns.
Patterns and instances form a graph that Spark scores in rounds: a pattern is
as good as the share of its instances that are known for one kind, an unknown
instance as good as the best pattern that trusts it. Where a pattern of high
confidence meets something that looks like an identifier, it is a new span;
digits written in groups are one identifier.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import row_id, salted_join, slices, stage
from cohortlens.llm.spans import Covered, Span, sha256, written

KINDS = ("email", "ip", "card", "phone")
FOUND = "context"
#: A pattern counts with this confidence and this many known instances; an instance is found with this score.
CONFIDENCE, SUPPORT, ACCEPTED = 0.75, 5, 0.75
#: Confidences that rise by no more than this in a round have settled.
SETTLED = 1e-6
#: Added to a pattern's instances, so that a few alone don't make it certain.
SMOOTHING = 1
#: Digits of a candidate that has no @, in all its groups.
DIGITS = 6
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![^\s])[^\s]*[0-9@][^\s]*")
#: Groups of digits joined by single spaces, dots, hyphens or brackets.
_RUN = re.compile(r"(?<!\w)[+(\[]{0,3}+[0-9]++(?!\w)(?:(?:[)\]][\x20.-]?[(\[]?|[\x20.-][(\[]?|[(\[])[0-9]++(?!\w))*")
_AROUND = ".,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """An address starts as far left of its @ as its characters allow, but after the address before."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end(), "email"))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the four base patterns, leftmost and not overlapping within a kind; what fails a check is dropped."""
    found = emails(text) if "@" in text else []
    if not re.search("[0-9]", text):
        return found
    found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return found


def _digits(text: str) -> int:
    return sum("0" <= c <= "9" for c in text)


def _runs(text: str, low: int, high: int) -> list[tuple[int, int]]:
    """Maximal runs of digit groups between two places; a bracket that opens before the first group counts if it closes within."""
    found = []
    for m in _RUN.finditer(text, low, high):
        start = m.start()
        while text[start] in "([" and ")]"["([".index(text[start])] not in m[0]:
            start += 1
        if _digits(m[0]) >= DIGITS:
            found.append((start, m.end()))
    return found


def candidates(text: str, base: list[Span]) -> list[Span]:
    """What looks like an identifier (kind empty) and meets no base span: a
    word with an @ or DIGITS digits, and a run of digit groups with as many in
    all. A run and the words it overlaps are one candidate."""
    found, covered, free = [], Covered(base), 0
    for m in _TOKEN.finditer(text):
        word = m[0].strip(_AROUND)
        start = m.start() + m[0].find(word) if word else m.start()
        local, at, domain = word.partition("@")
        looks = any(map(str.isalnum, local)) and any(map(str.isalnum, domain)) if at else _digits(word) >= DIGITS
        if looks and not covered.meets(start, start + len(word)):
            found.append((start, start + len(word)))
        if "@" in m[0] or covered.meets(*m.span()):
            found += _runs(text, free, m.start())
            free = m.end()
    found += _runs(text, free, len(text))
    whole: list[Span] = []
    for start, end in sorted(found):
        if whole and start < whole[-1][1]:
            whole[-1] = (whole[-1][0], max(end, whole[-1][1]), "")
        else:
            whole.append((start, end, ""))
    return whole


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: the two words before it, and the one before with the one after."""
    before = text[max(0, start - 120) : start].lower().split()[-2:]
    after = text[end : end + 60].strip(_AROUND + " \t\r\n").lower().split()[:1]
    clean = lambda words: " ".join(w.strip(_AROUND) for w in words)
    return [f"{clean(before)} *"] * (len(before) == 2) + [f"{clean(before[-1:])} * {clean(after)}"] * (bool(before) and bool(after))


_ITEM = pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("instance", pa.int64()), ("mail", pa.bool_()), ("patterns", pa.list_(pa.string()))])


def _extracted(batches):
    for batch in slices(batches, 1):
        counts, bases, items = [], [], []
        for text in (t or "" for t in batch.column(1).to_pylist()):
            base = base_spans(text)
            bases.append(base)
            counts.append([sum(s[2] == k for s in base) for k in KINDS])
            near = sorted(base + candidates(text, base)) if "@" in text or re.search("[0-9]", text) else []
            items.append([{"kind": k, "first": a, "last": b, "instance": xxhash.xxh64_intdigest(text[a:b].lower()) - (1 << 63), "mail": "@" in text[a:b], "patterns": patterns(text, a, b)} for a, b, k in near])
        texts = [written(b, KINDS) for b in bases]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)], pa.array(texts, pa.string()), pa.array([sha256(t) for t in texts], pa.string()), pa.array(items, pa.list_(_ITEM))], ["doc_id", *[f"n_{k}" for k in KINDS], "base", "base_sha256", "items"])


def scored_patterns(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, confidence) of trusted patterns and (instance, kind,
    score) of found instances, from edges (pattern, instance, kind, mail:
    kind empty for instances that no base pattern knows).

    An instance keeps its best score, so confidences only rise, and stay under
    1. Rounds go on until one finds no instance and either no other pattern
    could be trusted if all that is found were certain, or nothing rises."""
    edges = stage(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.max("mail").alias("mail")), "edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    seeds = edges.where("kind <> ''").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    unknown = edges.where("kind = ''").select("pattern", "instance", "mail")
    scores, trusted, found, n_found = seeds, None, None, 0
    enough = lambda mass: (F.col(mass) / (F.col("size") + SMOOTHING) >= CONFIDENCE) & (F.col(mass) >= SUPPORT)
    while True:
        mass = edges.select("pattern", "instance").join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("most"))
        promising = stage(mass.join(sizes, "pattern").where(enough("most")).select("pattern", "kind", (F.col("mass") / (F.col("size") + SMOOTHING)).alias("confidence"), enough("mass").alias("trusted")), "trusted")
        before, trusted = trusted, promising.where("trusted").drop("trusted")
        met = salted_join(unknown, trusted.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("best")), ["pattern"], F.col("instance"))
        fitting = met.select("instance", "mail", F.col("best.kind").alias("kind"), F.col("best.confidence").alias("score")).where((F.col("kind") == "email") == F.col("mail")).drop("mail")
        found = stage((fitting if found is None else fitting.unionByName(found)).groupBy("instance", "kind").agg(F.max("score").alias("score")), "found")
        n_before, n_found = n_found, found.count()
        if n_found == n_before and (promising.where("not trusted").isEmpty() or before is not None and _rise(before, trusted) <= SETTLED):
            return trusted, found.where(F.col("score") >= ACCEPTED)
        scores = seeds.union(found.select(*seeds.columns)).groupBy("instance", "kind").agg(F.max("score").alias("score"))


def _rise(before: DataFrame, after: DataFrame) -> float:
    """The most by which a pattern's confidence rose; one that was not trusted rose from 0."""
    was = before.withColumnRenamed("confidence", "was")
    return after.join(was, ["pattern", "kind"], "left").agg(F.max(F.col("confidence") - F.coalesce("was", F.lit(0.0)))).first()[0] or 0.0


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, a count for each kind, base_sha256,
    spans (base and found, kind:start:end, comma-joined). Null texts count as
    empty; a text without spans has the empty string. What is found never
    overlaps a base span. An empty table gives an empty result."""
    only = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    item = "array<struct<kind:string,first:int,last:int,instance:long,mail:boolean,patterns:array<string>>>"
    rows = stage(only.mapInArrow(_extracted, f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base string, base_sha256 string, items {item}").withColumn("row", row_id()), "identifiers")
    items = rows.where(F.size("items") > 0).select("row", F.explode("items").alias("i")).select("row", "i.*")
    edges = items.select(F.explode("patterns").alias("pattern"), "instance", "kind", "mail")
    trusted, found = scored_patterns(edges)
    open_ = items.where("kind = ''").select("row", "first", "last", "instance", F.explode("patterns").alias("pattern"))
    spread = F.struct("row", "first")
    known = salted_join(open_, trusted.select("pattern").distinct(), ["pattern"], spread)
    kept = salted_join(known.select("row", "first", "last", "instance").distinct(), found.select("instance").distinct(), ["instance"], spread)
    extra = kept.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("extra"))
    told = rows.drop("items").join(extra, "row", "left")
    start = lambda s: F.element_at(F.split(s, ":"), 2).cast("int")
    base = F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.split("base", ","))
    more = F.transform("extra", lambda e: F.concat(F.lit(f"{FOUND}:"), e["first"].cast("string"), F.lit(":"), e["last"].cast("string")))
    by_start = F.array_sort(F.concat(base, more), lambda a, b: F.when(start(a) < start(b), -1).when(start(a) > start(b), 1).otherwise(0))
    return told.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_join(by_start, ",")).alias("spans"), F.when(F.col("extra").isNull(), 0).otherwise(F.size("extra")).cast("long").alias("n_context"))
