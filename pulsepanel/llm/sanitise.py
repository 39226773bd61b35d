"""Information-theoretic sanitisation of personal data.

Protected entities are the values of base spans (emails, ip addresses, cards, phones). A term reveals an
entity as far as seeing the term makes the entity likely. With shares of documents as probabilities,

    IC(c) = -log p(c),   PMI(c; t) = log p(c, t) / (p(c) p(t)) = IC(c) - (-log p(c | t))

so PMI / IC is 1 when the term gives the entity away, 0 when it says nothing. p(c | t) is a lower bound:
Wilson's, ``z`` deviations below the share of the term's texts that hold the entity. Co-occurrence is counted over
whole texts, wherever in them entity and term stand. Terms whose share is at least ``generalise`` are replaced by a
mark, at least ``remove`` by nothing, wherever in the corpus they stand.

An entity hides in a crowd: IC(c) counts up to log ``crowd``, the information that picks one text of so many. Without
that bound the same counts would pass more easily the larger the corpus is, until every rare word near an address
goes. With it they give one share in any corpus of ``crowd`` times the entity's texts or more: two texts of two, or
four of five, are enough for a mark, one of one is not. The entity's own value is one more text for the words that
its name part spells (Zorblax of zorblax.k@x.org), so for those one other text is enough.

The counts of the terms in texts with entities come from one scan, in which each task sums its own terms; a
Bloom filter of fixed size keeps other words out. A term in more than (n + 1) crowd^(1 - g) texts cannot reach the
share g for an entity in n texts, so such pairs are never made. Entities that stand in the same texts have equal
counts with every term, so one of them stands for all; these and the remaining terms of a text are joined by its
key, in blocks of entities. A further scan gives the places of revealing terms, again behind a filter and a join.

Null and empty texts have no spans. Terms that overlap a base span are part of it. Terms are runs of ASCII
letters, digits and non-ASCII characters, A-Z in lower case, known by 64-bit hashes. Rows with one id and equal
text share their result, each row gets one. Documents are distinct texts: copies count once, in every count. An
empty table has no terms. A very long text is one row of a scan; its pairs are spread over tasks by entity.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import ROW, arrow_map, join_rows, join_table, keyed, small_or_shuffled, written
from pulsepanel.llm.decontaminate import bloom_bits, in_bloom
from pulsepanel.llm.words import alnum_hashes, word_hashes

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_SPAN = "array<struct<start: int, kind: int, end: int>>"
#: Entities of one text that are paired with its terms in one task.
BLOCK = 256
#: Places in all texts up to which they are broadcast (about 50 bytes each).
BROADCAST_PLACES = 400_000
_LETTERS = re.compile("[A-Za-z\x80-\U0010ffff]{2,}")


@dataclass(frozen=True)
class Policy:
    """What counts as disclosure."""

    z: float = 1.645
    generalise: float = 0.8
    remove: float = 0.95
    crowd: float = 100.0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from the @: linear where a plain search is not."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the base kinds, by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = (p.lstrip("0") for p in m[0].split("."))
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _entity(text: str, span: tuple[int, int, int]) -> int:
    """One number for a value, whatever its spelling."""
    value = text[span[0] : span[2]].lower()
    if span[1] >= 2:
        value = "".join(filter(str.isdigit, value))
    return xxhash.xxh3_64_intdigest(f"{span[1]}:{value}".encode()) - (1 << 63)


def _spelled(text: str, span: tuple[int, int, int]) -> list[bytes]:
    """The words of the name part of an email."""
    if span[1] != 0:
        return []
    name = text[span[0] : text.index("@", span[0])]
    return [w.encode().lower() for w in _LETTERS.findall(name)]


def _terms(text: str) -> list[tuple[int, int, bytes]]:
    return [(m.start(), m.end(), m[0].encode().lower()) for m in _WORD.finditer(text)]


def _signed(words: list[bytes]) -> list[int]:
    return word_hashes(words).view(np.int64).tolist()


def free_terms(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """The distinct terms of a text that do not overlap a span."""
    covered = np.zeros(len(text) + 1, bool)
    for start, _, end in spans:
        covered[start:end] = True
    return sorted(set(_signed([w for a, b, w in _terms(text) if not covered[a:b].any()])))


def _found(rows: DataFrame) -> DataFrame:
    """doc_id, row key, base spans and entities of every row; its terms, and which entity spells which, if it has entities."""

    def run(batch: pa.RecordBatch) -> dict:
        spans, entities, terms, spelled = [], [], [], []
        for text in batch.column(2).to_pylist():
            base = base_spans(text)
            spans.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
            entities.append(sorted({_entity(text, s) for s in base}))
            terms.append(free_terms(text, base) if base else [])
            pairs = {(_entity(text, s), w) for s in base for w in _spelled(text, s)}
            words = _signed([w for _, w in pairs]) if pairs else []
            spelled.append([{"entity": e, "term": h} for (e, _), h in zip(pairs, words)])
        return {
            "doc_id": batch.column(0), ROW: batch.column(1),
            "base": spans, "entities": entities, "terms": terms, "spelled": spelled,
        }

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(
        rows.select("doc_id", ROW, "text"),
        run,
        f"doc_id {kind}, {ROW} bigint, base {_SPAN}, entities array<bigint>, "
        "terms array<bigint>, spelled array<struct<entity: bigint, term: bigint>>",
    )


def _term_counts(rows: DataFrame, passing: np.ndarray) -> DataFrame:
    """term, texts that hold it; of the terms that pass the filter, summed in each batch."""
    shared = rows.sparkSession.sparkContext.broadcast(passing)

    def run(batch: pa.RecordBatch) -> dict:
        mine, shares = [np.empty(0, np.uint64)], [np.empty(0)]
        for blob, share in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            hashes = np.unique(alnum_hashes(blob))
            mine.append(hashes[in_bloom(hashes, shared.value)])
            shares.append(np.full(len(mine[-1]), share))
        terms, places = np.unique(np.concatenate(mine), return_inverse=True)
        sums = np.bincount(places, np.concatenate(shares), len(terms))
        return {"term": pa.array(terms.view(np.int64)), "n": pa.array(sums)}

    # each of n copies of a text is 1 / n of it; the texts themselves are not shuffled
    copies = rows.groupBy(ROW).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    each = rows.select(ROW, F.col("text").cast("binary").alias("text")).join(
        small_or_shuffled(written(copies, "copied_texts")), ROW, "left"
    )
    share = 1 / F.coalesce(F.col("copies"), F.lit(1)).cast("double")
    parts = arrow_map(each.select("text", share.alias("share")), run, "term bigint, n double")
    return parts.groupBy("term").agg(F.round(F.sum("n")).cast("bigint").alias("n_term"))


def _at_least(part: Column, whole: Column, z: float) -> Column:
    """Wilson's lower bound of a share that was seen as ``part`` of ``whole``."""
    p = F.least(part / whole, F.lit(1.0))
    spread = F.sqrt(p * (1 - p) / whole + z * z / (4 * whole * whole))
    return (p + z * z / (2 * whole) - z * spread) / (1 + z * z / whole)


def disclosed(n_both: Column, n_term: Column, n_entity: Column, n_docs: int, policy: Policy) -> Column:
    """PMI / IC of a term and an entity in ``n_both`` texts together, at least; IC of a crowd at most."""
    given = F.log(_at_least(n_both, n_term, policy.z))  # log p(c | t)
    content = F.least(F.log(F.lit(float(max(1, n_docs))) / n_entity), F.lit(math.log(policy.crowd)))
    return F.when(content > 0, 1 + given / content).otherwise(0.0)


def _one_of_equals(each: DataFrame) -> DataFrame:
    """entity, n_entity and the least entity that stands in the same texts; from text and entity."""
    bits = [F.bit_xor(F.xxhash64(F.lit(seed), ROW)).alias(f"texts_{seed}") for seed in (1, 2)]
    entities = written(each.groupBy("entity").agg(F.count("*").alias("n_entity"), *bits), "entities")
    same = ["n_entity", "texts_1", "texts_2"]
    least = entities.groupBy(*same).agg(F.min("entity").alias("one"))
    return written(entities.join(least, same).select("entity", "n_entity", "one"), "equal_entities")


def revealing_terms(rows: DataFrame, found: DataFrame, policy: Policy) -> DataFrame:
    """term, share: the largest PMI / IC over the entities it stands beside, at least ``generalise``."""
    n_docs = rows.select(ROW).distinct().count()
    beside = written(
        found.where(F.size("entities") > 0)
        .select(ROW, "entities", "terms", "spelled")
        .dropDuplicates([ROW]),
        "texts_with_entities",
    )
    each = beside.select(ROW, F.explode("entities").alias("entity"))
    entities = _one_of_equals(each)
    ones = entities.where(F.col("entity") == F.col("one")).select("entity", "n_entity")
    most = entities.agg(F.max("n_entity")).first()[0] or 0
    wider = policy.crowd ** (1 - policy.generalise) * 1.000001  # a little more, against rounding
    limit = lambda n_entity: (n_entity + 1) * F.lit(wider)

    candidates = beside.select(F.explode("terms").alias("term"))
    counts = written(
        _term_counts(rows, bloom_bits(candidates, "term")).where(
            F.col("n_term") <= limit(F.lit(float(most)))
        ),
        "term_counts",
    )
    passing = rows.sparkSession.sparkContext.broadcast(bloom_bits(counts, "term"))

    def rare(batch: pa.RecordBatch) -> dict:
        lists = batch.column(1)
        at = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        kept = in_bloom(terms.view(np.uint64), passing.value)
        return {ROW: batch.column(0).take(pa.array(at[kept])), "term": terms[kept]}

    each = written(each.join(small_or_shuffled(ones), "entity"), "entities_of_texts")
    blocks = each.groupBy(ROW).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = written(blocks.where(F.col("blocks") > 1), "blocks_of_texts")

    def in_blocks(table: DataFrame, block: Column) -> DataFrame:
        some = table.join(small_or_shuffled(blocks), ROW, "left")
        return some.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", block)

    terms = arrow_map(beside.select(ROW, "terms"), rare, f"{ROW} bigint, term bigint")
    terms = in_blocks(
        terms.join(small_or_shuffled(counts), "term"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)),
    )
    each = in_blocks(each, F.pmod(F.xxhash64("entity"), F.col("blocks")).cast("int"))
    together = (
        each.drop("blocks")
        .join(terms.drop("blocks"), [ROW, "block"])
        .where(F.col("n_term") <= limit(F.col("n_entity")))
        .select("entity", "term", "n_entity", "n_term", F.lit(1).alias("both"), F.lit(0).alias("spells"))
    )
    spelled = (
        beside.select(F.explode("spelled").alias("s"))
        .select("s.entity", "s.term")
        .distinct()
        .join(small_or_shuffled(entities.select("entity", "one")), "entity")
        .select(F.col("one").alias("entity"), "term", F.lit(0).alias("both"), F.lit(1).alias("spells"))
    )
    pairs = (
        together.unionByName(spelled, allowMissingColumns=True)
        .groupBy("entity", "term")
        .agg(
            F.max("n_entity").alias("n_entity"),
            F.max("n_term").alias("n_term"),
            F.sum("both").alias("n_both"),
            F.max("spells").alias("spells"),
        )
        .where(F.col("n_both") > 0)
    )
    share = disclosed(
        F.col("n_both") + F.col("spells"), F.col("n_term") + F.col("spells"), F.col("n_entity"), n_docs, policy
    )
    return (
        pairs.groupBy("term")
        .agg(F.max(share).alias("share"))
        .where(F.col("share") >= policy.generalise)
    )


def _places(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, row key and the places (start, end, share) of revealing terms, for rows that have some."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom_bits(terms, "term"))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("row", "term", "start", "end")}
        if shared.value.any():
            for i, text in enumerate(batch.column(2).to_pylist()):
                if not in_bloom(alnum_hashes(text.encode("utf-8", "replace")), shared.value).any():
                    continue
                words = _terms(text)
                hashes = word_hashes([w for *_, w in words])
                covered = np.zeros(len(text) + 1, bool)
                for a, _, b in base_spans(text):
                    covered[a:b] = True
                for j in np.flatnonzero(in_bloom(hashes, shared.value)).tolist():
                    a, b, _ = words[j]
                    if not covered[a:b].any():
                        for name, x in zip(out, (i, int(hashes[j].astype(np.int64)), a, b)):
                            out[name].append(x)
        rows_at = pa.array(out.pop("row"), pa.int64())
        return {"doc_id": batch.column(0).take(rows_at), ROW: batch.column(1).take(rows_at)} | out

    kind = rows.schema["doc_id"].dataType.simpleString()
    places = arrow_map(
        rows.select("doc_id", ROW, "text"),
        run,
        f"doc_id {kind}, {ROW} bigint, term bigint, start int, end int",
    )
    return (
        places.distinct()
        .join(terms, "term")
        .groupBy("doc_id", ROW)
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))
    )


def spans(
    docs: DataFrame, policy: Policy = Policy(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, row key, base spans (start, kind, end), and revealing terms (start, end, share)."""
    rows = keyed(docs, id_col, text_col)
    found = written(_found(rows), "personal_data")
    terms = written(revealing_terms(rows, found, policy), "revealing_terms")
    none = F.array().cast("array<struct<start: int, end: int, share: double>>")
    out = join_rows(found.select("doc_id", ROW, "base"), _places(rows, terms))
    return out.withColumn("terms", F.coalesce("terms", none))


def _listed(array: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of (start, kind, end), by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(F.sort_array(array), one), ",")


def report(docs: DataFrame, policy: Policy = Policy(), **columns: str) -> DataFrame:
    """doc_id, row key, counts of each base kind, digest of the base spans, all spans as text."""
    found = spans(docs, policy, **columns)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    added = F.transform(
        "terms",
        lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")),
    )
    return found.select(
        "doc_id",
        ROW,
        *counts,
        F.sha2(_listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        _listed(F.concat("base", added), (*KINDS, TERM)).alias("spans"),
    )


def replaced(text: str, terms: list[tuple[int, int, float]], remove: float) -> str:
    """The text with base spans as their kind's mark, and revealing terms as a mark or nothing."""
    marks = [(a, b, f"[{KINDS[k].upper()}]") for a, k, b in base_spans(text)]
    marks += [(a, b, "" if share >= remove else "[TERM]") for a, b, share in terms]
    out, at = [], 0
    for a, b, mark in sorted(marks):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """All rows and columns of a table with doc_id and text; texts without what reveals persons."""
    rows = keyed(docs, "doc_id", "text")
    found = written(_found(rows), "personal_data")
    terms = written(revealing_terms(rows, found, policy), "revealing_terms")
    places = written(_places(rows, terms), "revealing_places")
    n_places = places.agg(F.sum(F.size("terms") + 1)).first()[0] or 0
    marked = join_table(docs, F.broadcast(places) if n_places <= BROADCAST_PLACES else places, "left")
    at = docs.columns.index("text")
    remove = policy.remove

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lists = batch.column(batch.num_columns - 1).to_pylist()
            new = [
                t and replaced(t, [(p["start"], p["end"], p["share"]) for p in places or ()], remove)
                for t, places in zip(texts, lists)
            ]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return marked.mapInArrow(run, docs.schema)
