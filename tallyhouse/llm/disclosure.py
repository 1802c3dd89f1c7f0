"""Personal data: base patterns, and information-theoretic sanitisation of the terms that give a protected value away.

A protected entity is a value that a base pattern finds. Its information content is IC(e) = -log2 p(e), and a term that
stands near it tells PMI(e; t) = log2 (p(e, t) / (p(e) p(t))) of it, with the shares of distinct texts as probabilities. The
quotient is 1 if the term occurs with nothing else and 0 if it tells nothing. Terms beyond one threshold are generalised
and beyond a second one removed, wherever they stand in a text that holds the entity.

Two passes read the texts. The first finds entities and the terms around them; the second, where the terms that may
disclose one stand. Everything between is joins and counts of narrow rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import written

from .common import free_name

#: Kinds of base entities in their order, and the patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# What can never give characters back takes them for good, so that no text costs more than a few looks at a character.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TERM_KIND = "term"

TERM = re.compile(r"[^\W_]+")
#: Terms on each side of an entity that count as near it.
WINDOW = 10
#: Distinct texts that must hold an entity, and hold it near a term, before it says anything.
MIN_TEXTS = 3
#: Shares of the entity's information from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.9, 0.97
#: Texts whose digest begins with a byte below this give all their terms in the first pass, for lower bounds of counts.
WITNESS_BYTE = 4
#: 64-bit words of the filter of candidate terms (1 MB); beyond it more terms pass that the exact join drops.
FILTER_WORDS, FILTER_BITS = 1 << 17, 4

#: Characters of text whose terms are held at once.
PART_CHARS = 500_000

SPAN = "struct<kind:string,start:int,end:int>"
SCANNED = f"doc_id long, digest binary, base array<{SPAN}>, mentions array<struct<entity:string,terms:array<string>>>, witness array<string>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to both sides: a search from the left would read a long run of letters again from each of them."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain, start = DOMAIN.match(text, at + 1), at
        if domain:
            while start > last and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at:
                last = domain.end()
                yield start, last
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    twice = [2 * int(c) for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[::-2]) + sum(x - 9 * (x > 9) for x in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points) of the base entities, by kind and start."""
    found = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def entity_of(kind: str, value: str) -> str:
    """One name for the ways to write a value."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else NOT_DIGIT.sub('', value)}"


def free_terms(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Terms that touch no base span, lower-cased, with their places."""
    taken = sorted((a, b) for _, a, b in spans)
    k = reach = 0
    for m in TERM.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= m.start():
            yield m[0].lower(), m.start(), m.end()


def mentions_of(text: str, spans: list[tuple[str, int, int]], window: int) -> list[dict]:
    """Each entity of a text with the terms that stand near one of its mentions."""
    terms = list(free_terms(text, spans))
    starts = [start for _, start, _ in terms]
    near: dict[str, set[str]] = {}
    for kind, a, b in spans:
        before, after = bisect_left(starts, a), bisect_left(starts, b)
        around = terms[max(0, before - window) : before] + terms[after : after + window]
        near.setdefault(entity_of(kind, text[a:b]), set()).update(t for t, _, _ in around)
    return [{"entity": e, "terms": sorted(ts)} for e, ts in sorted(near.items())]


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def scan(docs: DataFrame, doc_id: str, text: str, window: int) -> DataFrame:
    """One row for each row of ``docs``, without its text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, mentions, witness = [], [], []
            for digest, body in zip(batch.column(1), batch.column(2)):
                body = body.as_py() or ""
                spans = base_spans(body)
                sampled = digest.as_py()[0] < WITNESS_BYTE
                witness.append(list({t for t, _, _ in free_terms(body, spans)}) if sampled else [])
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                mentions.append(mentions_of(body, spans, window) if spans else [])
            spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            mentions_type = pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))
            yield pa.record_batch({"doc_id": batch.column(0), "digest": batch.column(1), "base": pa.array(base, spans_type), "mentions": pa.array(mentions, mentions_type), "witness": pa.array(witness, pa.list_(pa.string()))})

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest_of(F.col(text)).alias("digest"), F.col(text).alias("text"))
    return narrow.mapInArrow(rows, SCANNED)


def filter_masks(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of the filter that each hash belongs to, and its bits there."""
    bits = [(hashes >> np.uint64(20 + 6 * i)) & np.uint64(63) for i in range(FILTER_BITS)]
    mask = np.bitwise_or.reduce([np.uint64(1) << b for b in bits])
    return (hashes % np.uint64(FILTER_WORDS)).astype(np.int64), mask


def term_filter(terms: DataFrame) -> bytes:
    """A blocked Bloom filter of the terms. Tasks fill their own; at most FILTER_WORDS words reach the driver."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_WORDS, np.uint64)
        for batch in batches:
            np.bitwise_or.at(words, *filter_masks(hashes_of(batch.column(0).to_pylist())))
        at = np.flatnonzero(words)
        yield pa.record_batch({"word": at, "bits": words[at].view(np.int64)})

    filled = np.zeros(FILTER_WORDS, np.uint64)
    parts = terms.select("term").mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled[parts["word"].to_numpy()] = parts["bits"].to_numpy().view(np.uint64)
    return filled.tobytes()


def hashes_of(terms: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.encode()) for t in terms], np.uint64)


def parts_of(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[list[bytes], list[str]]]:
    """Digests and texts of a batch, in parts of about so many characters, so that memory follows the longest text."""
    digests, bodies, size = [], [], 0
    for digest, body in zip(batch.column(0), batch.column(1)):
        digests.append(digest.as_py())
        bodies.append(body.as_py() or "")
        size += len(bodies[-1])
        if size >= chars:
            yield digests, bodies
            digests, bodies, size = [], [], 0
    if digests:
        yield digests, bodies


def places(docs: DataFrame, terms: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``digest``, ``term`` and where it stands, for each distinct text and each of the terms in it outside base spans."""
    words = np.frombuffer(term_filter(terms), np.uint64)

    def passing(texts: list[str]) -> Iterator[tuple[int, set[str]]]:
        """The place of each text that holds terms which pass, and these terms."""
        found = [set(map(str.lower, TERM.findall(body))) for body in texts]
        distinct = list(set().union(*found))
        at, mask = filter_masks(hashes_of(distinct)) if distinct else (np.zeros(0, int), np.zeros(0, np.uint64))
        chosen = {t for t, ok in zip(distinct, (words[at] & mask == mask).tolist()) if ok}
        return ((i, chosen & own) for i, own in enumerate(found) if not chosen.isdisjoint(own))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"digest": pa.binary(), "term": pa.string(), "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))}
        for batch in batches:
            for digests, bodies in parts_of(batch, PART_CHARS):
                out: dict[str, list] = {name: [] for name in types}
                for i, chosen in passing(bodies):
                    where: dict[str, list] = {}
                    for term, a, b in free_terms(bodies[i], base_spans(bodies[i])):
                        if term in chosen:
                            where.setdefault(term, []).append({"start": a, "end": b})
                    for term, spans in where.items():
                        for name, value in (("digest", digests[i]), ("term", term), ("spans", spans)):
                            out[name].append(value)
                yield pa.record_batch({name: pa.array(out[name], kind) for name, kind in types.items()})

    narrow = docs.where(F.col(text) != "").select(digest_of(F.col(text)).alias("digest"), F.col(text).alias("text"))
    hits = narrow.mapInArrow(rows, "digest binary, term string, spans array<struct<start:int,end:int>>")
    # The filter lets others pass; copies of a text say the same.
    return hits.join(terms.select(F.col("term").alias("term__")), F.col("term") == F.col("term__"), "left_semi").dropDuplicates(["digest", "term"])


def disclosing_terms(docs: DataFrame, scanned: DataFrame, doc_id: str, text: str, min_texts: int, share: float) -> DataFrame:
    """``digest``, ``term``, ``spans`` and ``share``: the terms of each distinct text that disclose at least ``share`` of an entity in it.

    A pair counts only with ``min_texts`` distinct texts. A term occurs in at least the texts that have it near an entity
    or are among those that gave all their terms, which bounds p(e | t) from above: pairs that cannot reach the share
    fall away before the second pass, and none other.
    """
    n = scanned.where(F.col("digest") != digest_of(F.lit(""))).agg(F.count_distinct("digest")).first()[0]
    held = scanned.select("digest", F.explode("mentions").alias("m")).select("digest", "m.entity", "m.terms")
    held = written(held.dropDuplicates(["digest", "entity"]), "mentions")
    entities = held.groupBy("entity").agg(F.count("*").alias("of_entity")).where((F.col("of_entity") >= min_texts) & (F.col("of_entity") < n))
    entities = written(entities, "entities")
    near = held.join(entities, "entity").select("digest", "entity", "of_entity", F.explode("terms").alias("term"))
    pairs = near.groupBy("entity", "of_entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= min_texts)
    known = held.select("digest", F.explode("terms").alias("term")).unionByName(scanned.select("digest", F.explode("witness").alias("term")))
    at_least = known.distinct().groupBy("term").agg(F.count("*").alias("at_least"))
    tells = lambda of_term: 1 + F.log2(F.col("both") / of_term) / F.log2(F.lit(n) / F.col("of_entity"))
    candidates = pairs.join(at_least, "term").where(tells(F.col("at_least")) >= share).drop("at_least")
    candidates = written(candidates, "candidate-terms")
    found = written(places(docs, candidates.select("term").distinct(), doc_id, text), "places")
    of_term = found.groupBy("term").agg(F.count("*").alias("of_term"))
    pairs = candidates.join(of_term, "term").withColumn("share", tells(F.col("of_term"))).where(F.col("share") >= share)
    here = found.join(pairs.select("term", "entity", "share"), "term").join(held.select("digest", "entity"), ["digest", "entity"])
    return here.groupBy("digest", "term").agg(F.max("share").alias("share"), F.first("spans").alias("spans"))


def find_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    min_texts: int = MIN_TEXTS,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """``doc_id``, ``digest`` (of the text), ``base`` and ``added`` spans, a row for each row of ``docs``.

    ``base`` holds kind, start and end, by kind and start; ``added`` start, end, term, share and action (``generalise`` or
    ``remove``), by start; no added span touches a base one. Null texts are empty. Repeated rows stay repeated and count as one text, as
    do all copies of a text; rows without an id stay; other columns are ignored, whatever their names; an empty
    table gives an empty result. A text without an entity gets no span. Texts are never shuffled.
    """
    scanned = written(scan(docs, doc_id, text, window), "scanned")
    terms = disclosing_terms(docs, scanned, doc_id, text, min_texts, generalise)
    action = F.when(F.col("share") >= remove, "remove").otherwise("generalise")
    each = terms.select("digest", "term", "share", action.alias("action"), F.explode("spans").alias("at"))
    span = F.struct("at.start", "at.end", "term", "share", "action")
    added = written(each.groupBy(F.col("digest").alias("of__")).agg(F.array_sort(F.collect_list(span)).alias("added")), "added")
    none = F.array().cast(added.schema["added"].dataType)
    some = F.size("base") > 0
    with_entity = scanned.where(some).join(added, F.col("digest") == F.col("of__"), "left")
    with_entity = with_entity.select("doc_id", "digest", "base", F.coalesce("added", none).alias("added"))
    return with_entity.unionByName(scanned.where(~some).select("doc_id", "digest", "base", none.alias("added")))


def joined(spans: Column, kind: Column | None = None) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"] if kind is None else kind, s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def general_form(word: str) -> str:
    """What a term is, in place of which it is."""
    return "[NUMBER]" if word.isdecimal() else "[NAME]" if word[:1].isupper() else "[WORD]"


def rewrite(text: str | None, base: list | None, added: list | None) -> str | None:
    """The text with base entities as their kind, terms to generalise as what they are, and without terms to remove."""
    if text is None or base is None:
        return text
    cuts = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base]
    cuts += [(s["start"], s["end"], "" if s["action"] == "remove" else general_form(text[s["start"] : s["end"]])) for s in added]
    out, at = [], 0
    for a, b, instead in sorted(cuts):
        if b <= at:
            continue  # within an earlier one: a card within a phone number
        out += [text[at : max(a, at)], instead if a >= at else ""]
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten by the spans that ``find_spans`` found; other columns, rows and null texts stay as they are."""
    digest, of = free_name(docs, "digest__"), free_name(docs, "of__")
    base, added = free_name(docs, "base__"), free_name(docs, "added__")
    found = spans.where(F.size("base") > 0).dropDuplicates(["digest"])
    found = found.select(F.col("digest").alias(of), F.col("base").alias(base), F.col("added").alias(added))
    both = docs.withColumn(digest, F.when(F.col(text).isNotNull(), digest_of(F.col(text)))).join(found, F.col(digest) == F.col(of), "left")
    return both.withColumn(text, F.udf(rewrite, "string", useArrow=True)(F.col(text), F.col(base), F.col(added))).select(docs.columns)
