"""Phrases whose words stand together more often than chance, counted by FM-indexes over word ids.

Texts are cut into shards of some two million words, one language each. Three passes share the work, each of them
a shuffle of counts to buckets of keys and one of answers back to the shards:

1. a shard numbers its words; buckets sum their counts, and words below the least count become breaks
2. each shard's index extends every word to its pairs; buckets sum them, and rare pairs become breaks
3. each shard's index extends what is left to three, four and five words; buckets sum them

A phrase can't occur more often than the words and pairs in it, so a break loses nothing. What a shard sends to a
bucket is one row of packed arrays, and there are as many buckets as shards, so the largest row and the largest
bucket are about as large as a shard, however many there are.

The index of a shard is bidirectional: a BWT of the ids and one of the reversed ids, each with the mapping from a
row to that of the suffix one symbol longer. A phrase is a pair of intervals of the same size; its extensions to
one side are the distinct symbols in the interval of that side's BWT, counted for all phrases of a length at once.
Suffixes are sorted up to the longest phrase only.

Defined cases: a null text is empty, a null language ``und``; empty tables and texts give no phrases; a text of
any length is cut into shards between pieces; repeated rows count each time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from pulsepanel.llm.common import small_or_shuffled, written
from pulsepanel.llm.words import mixed, word_hashes

#: Words of a shard; a piece (text between punctuation) is never cut.
SHARD_WORDS = 1 << 21
LONGEST = 5
_IDS = [f"w{i}" for i in range(1, LONGEST + 1)]

# separators of pieces become a full stop, which then stands in no word
_BREAK = b"."
_PLAIN = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"." * 9 + b" ")

SHARDS = "shard bigint, lang string, n bigint, symbols binary, words binary, uses binary"
WORDS = "shard bigint, answer binary, lang string, word binary, word_id bigint, uses bigint"
COUNTS = "shard bigint, bucket int, counts binary, symbols binary"
_KEYS = ", ".join(f"{c} bigint" for c in _IDS)
FOUND = f"shard bigint, answer binary, {_KEYS}, uses bigint"


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case, a full stop between pieces."""
    return text.lower().translate(_PLAIN).replace(_BREAK, b" . ").split()


class _Numbers(dict):
    """Word -> number in the order of first use; 0 is the break."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


# --- the index of one shard ----------------------------------------------------------------


def _side(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """BWT of the symbols, suffixes sorted by their first ``depth``, and the row of each longer suffix."""
    rank, known = symbols.astype(np.int64), 1
    while known < depth:
        step = min(known, depth - known)
        ahead = np.zeros_like(rank)
        # ranks of `known` symbols, the second one so far ahead that both cover known + step
        ahead[: len(rank) - step] = rank[step:]
        pairs = rank * (int(rank.max()) + 1) + ahead
        rank = np.unique(pairs, return_inverse=True)[1]
        known += step
    order = np.argsort(rank, kind="stable")
    bwt = symbols[order - 1]  # the symbol before the first one is the last, a break
    longer = np.empty(len(bwt), np.int64)
    longer[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return bwt, longer


class BiIndex:
    """Bidirectional index of symbols 1, 2, ... with 0 as break; the last symbol must be a break."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.symbols, self.depth = symbols, depth

    @cached_property
    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        return _side(self.symbols, self.depth)

    @cached_property
    def backward(self) -> tuple[np.ndarray, np.ndarray]:
        # the break at the end comes last again
        return _side(np.append(self.symbols[-2::-1], np.int32(0)), self.depth)

    def words(self) -> Phrases:
        counts = np.bincount(self.symbols)
        starts = np.cumsum(counts) - counts
        used = np.flatnonzero(counts)
        used = used[used > 0]
        return Phrases(used[:, None], counts[used], starts[used], starts[used])

    def extend(self, phrases: Phrases, right: bool) -> Phrases:
        """Every phrase with every word that stands right (or left) of it."""
        bwt, longer = self.backward if right else self.forward
        mine, other = (phrases.back, phrases.front) if right else (phrases.front, phrases.back)
        total = int(phrases.uses.sum())
        owner = np.repeat(np.arange(len(phrases.uses)), phrases.uses)
        before = np.cumsum(phrases.uses) - phrases.uses
        rows = np.arange(total) - np.repeat(before - mine, phrases.uses)
        symbol = bwt[rows]
        width = int(self.symbols.max()) + 1
        extended = owner * width + symbol
        order = np.argsort(extended, kind="stable")
        owner, symbol, rows, extended = owner[order], symbol[order], rows[order], extended[order]
        first = np.flatnonzero(np.append(np.ones(min(1, total), bool), extended[1:] != extended[:-1]))
        uses = np.diff(np.append(first, total))
        owner, symbol = owner[first], symbol[first]
        # rows of one phrase and symbol follow each other: the first one leads to the new interval
        start = longer[rows[first]]
        # in the other index the new phrase comes after those with smaller symbols
        beside = other[owner] + first - before[owner]
        word = symbol > 0
        ids = phrases.ids[owner[word]]
        added = symbol[word][:, None]
        ids = np.hstack([ids, added] if right else [added, ids])
        sides = (beside[word], start[word]) if right else (start[word], beside[word])
        return Phrases(ids, uses[word], *sides)


class Phrases:
    """Phrases of one length: word ids, uses, and the start of their intervals in both indexes."""

    def __init__(self, ids: np.ndarray, uses: np.ndarray, front: np.ndarray, back: np.ndarray):
        self.ids, self.uses, self.front, self.back = ids, uses, front, back


def phrases_of(symbols: np.ndarray, longest: int) -> Iterator[Phrases]:
    """All phrases of two to ``longest`` words with their uses, by extension right, left, right, ..."""
    if not symbols.any():
        return
    index = BiIndex(symbols, longest)
    phrases = index.words()
    for length in range(2, longest + 1):
        phrases = index.extend(phrases, right=length % 2 == 0)
        if not len(phrases.uses):
            return
        yield phrases


# --- packed arrays ----------------------------------------------------------------------------


def pack(table: np.ndarray, ordered: bool = False) -> bytes:
    """A table of whole numbers, column by column in byte planes; an ordered first column as differences."""
    columns = np.array(table.T, "<i8", order="C")
    if ordered:
        columns[0] = np.diff(columns[0], prepend=0)
    planes = columns.view(np.uint8).reshape(-1, 8).T
    head = np.array([*columns.shape, ordered], "<i8")
    return zstandard.compress(head.tobytes() + planes.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    rows, length, ordered = np.frombuffer(raw, "<i8", 3).tolist()
    planes = np.frombuffer(raw, np.uint8, offset=24).reshape(8, -1)
    columns = planes.T.copy().view("<i8").reshape(rows, length)
    if ordered:
        columns[0] = columns[0].cumsum()
    return columns.T


def _pack_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b" ".join(words), 1)


def _unpack_words(blob: bytes) -> list[bytes]:
    return zstandard.decompress(blob).split()


def _buckets(values: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its hashes."""
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.unique(bucket):
        yield int(k), order[edges[k] : edges[k + 1]]


def _summed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, their sums, and where each part's rows are among them; the last column is the count."""
    rows = np.concatenate(parts)
    order = np.lexsort(rows[:, -2::-1].T)
    ordered = rows[order]
    new = np.append(True, (ordered[1:, :-1] != ordered[:-1, :-1]).any(axis=1))
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    sums = np.add.reduceat(ordered[:, -1], np.flatnonzero(new))
    return ordered[new, :-1], sums, np.split(place, np.cumsum([len(p) for p in parts])[:-1])


# --- passes over the shards ----------------------------------------------------------------


def _batch(schema: pa.Schema, rows: int = 1, **columns) -> pa.RecordBatch:
    """One batch of the given columns, the rest null; single values stand in every row."""
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if not isinstance(values, (list, np.ndarray)):
            values = [values] * rows
        arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows; a packed array becomes an object only when its row is read."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


def _mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with a function from the rows and the schema of a partition to its batches."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(lambda batches: function(_rows(batches), arrow), schema)


def _shards(docs: DataFrame, lang_col: str, text_col: str, shard_words: int) -> DataFrame:
    """A row for each shard: its words as numbers in order, its different words and their uses."""

    def run(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        open_shards: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal shard
            numbers, parts = open_shards.pop(lang)
            ids = np.concatenate(parts)
            uses = np.bincount(ids, minlength=len(numbers))[1:]
            shard += 1
            del sizes[lang]
            return _batch(
                schema, shard=shard - 1, lang=lang, n=int(uses.sum()), symbols=pack(ids[:, None]),
                words=_pack_words(list(numbers)[1:]), uses=pack(uses[:, None]),
            )

        for lang, text in rows:
            words = tokens(text)
            if not words:
                continue
            words.append(_BREAK)
            for part in _cut(words, shard_words):
                numbers, parts = open_shards.setdefault(lang, (_Numbers(), []))
                parts.append(np.fromiter(map(numbers.__getitem__, part), np.int32, len(part)))
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] >= shard_words:
                    yield closed(lang)
        for lang in list(open_shards):
            yield closed(lang)

    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return _mapped(docs.select(lang.alias("lang"), text.alias("text")), run, SHARDS)


def _cut(words: list[bytes], size: int) -> Iterator[list[bytes]]:
    """Parts of some ``size`` words, each ending with a break."""
    begin = 0
    while len(words) - begin > size:
        end = words.index(_BREAK, begin + size - 1) + 1
        yield words[begin:end]
        begin = end
    if begin < len(words):
        yield words[begin:]


def _words(shards: DataFrame, buckets: int, least: int) -> DataFrame:
    """Frequent words with their ids, and for each shard the ids of its own."""

    def deal(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for shard, lang, words, uses in rows:
            words, uses = _unpack_words(words), unpack(uses)[:, 0]
            for bucket, at in _buckets(word_hashes(words), buckets) if words else ():
                yield _batch(
                    schema, bucket=bucket, shard=shard, lang=lang,
                    words=_pack_words([words[i] for i in at]), counts=pack(np.stack([at + 1, uses[at]], axis=1), True),
                )

    def merge(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for bucket, group in groupby(rows, key=lambda row: row[0]):
            found = 0
            for lang, parts in groupby(group, key=lambda row: row[1]):
                sums: dict[bytes, int] = {}
                sent = []
                for _, _, shard, words, counts in parts:
                    words, counts = _unpack_words(words), unpack(counts)
                    for word, uses in zip(words, counts[:, 1].tolist()):
                        sums[word] = sums.get(word, 0) + uses
                    sent.append((shard, words, counts[:, 0]))
                # ids of all buckets interleave and stay small
                ids = {}
                for word in sorted(w for w, uses in sums.items() if uses >= least):
                    found += 1
                    ids[word] = found * buckets + bucket
                if not ids:
                    continue
                yield _batch(
                    schema, len(ids), lang=lang, word=list(ids), word_id=list(ids.values()),
                    uses=[sums[w] for w in ids],
                )
                for shard, words, own in sent:
                    known = np.array([ids.get(w, 0) for w in words], np.int64)
                    answer = np.stack([own, known], axis=1)[known > 0]
                    if len(answer):
                        yield _batch(schema, shard=shard, answer=pack(answer))

    parts = "bucket int, lang string, shard bigint, words binary, counts binary"
    dealt = _mapped(shards.select("shard", "lang", "words", "uses"), deal, parts)
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "lang", "shard")
    return _mapped(ordered, merge, WORDS)


def _with_answers(symbols: DataFrame, answers: DataFrame) -> DataFrame:
    """The symbols of each shard followed by the answers to it, in one task."""
    rows = symbols.select("shard", F.lit(0).alias("kind"), F.col("symbols").alias("packed"))
    more = answers.select("shard", F.lit(1).alias("kind"), F.col("answer").alias("packed"))
    return rows.unionByName(more).repartition("shard").sortWithinPartitions("shard", "kind")


def _each_shard(rows: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """shard, its symbols and all answers; shards without answers are left out."""
    for shard, group in groupby(rows, key=lambda row: row[0]):
        symbols = unpack(next(group)[2])
        answers = [unpack(packed) for _, _, packed in group]
        if answers:
            yield shard, symbols, np.concatenate(answers)


def _without_lone_words(symbols: np.ndarray) -> np.ndarray:
    """Breaks in a row become one, words between breaks go; ends with a break."""
    word = symbols > 0
    beside = np.zeros(len(symbols), bool)
    beside[1:] = word[:-1]
    beside[:-1] |= word[1:]
    kept = np.where(word & beside, symbols, 0)
    keep = kept > 0
    keep[1:] |= kept[:-1] > 0
    return np.append(kept[keep], 0).astype(symbols.dtype)


def _runs(symbols: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The symbols with breaks where neighbours are not joined; runs of less than three words go."""
    n = len(symbols)
    starts = np.flatnonzero(np.append(True, ~joined))
    lengths = np.diff(np.append(starts, n))
    long = lengths >= 3
    starts, lengths = starts[long], lengths[long]
    if not len(starts):
        return np.zeros(1, symbols.dtype)
    out = np.zeros(int((lengths + 1).sum()), symbols.dtype)
    to = np.cumsum(lengths + 1) - (lengths + 1)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(to, lengths) + within] = symbols[np.repeat(starts, lengths) + within]
    return out


def _counts(schema: pa.Schema, shard: int, keys: np.ndarray, uses: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of one shard, one row for each bucket, keys in order."""
    order = np.lexsort(keys[:, ::-1].T)
    rows = np.column_stack([keys, uses])[order]
    mix = np.zeros(len(rows), np.uint64)
    for column in rows[:, :-1].T:
        mix = mixed(mix + column.astype(np.uint64))
    for bucket, at in _buckets(mix, buckets):
        yield _batch(schema, shard=shard, bucket=bucket, counts=pack(rows[at], True))


def _pairs(shards: DataFrame, buckets: int) -> DataFrame:
    """Counts of pairs of frequent words, and the shard's text of frequent words."""

    def run(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for shard, symbols, answers in _each_shard(rows):
            known = np.zeros(int(symbols.max()) + 1, np.int32)
            known[answers[:, 0]] = np.arange(1, len(answers) + 1)
            text = _without_lone_words(known[symbols[:, 0]])
            word_id = np.append(0, answers[:, 1])
            for phrases in phrases_of(text, 2):
                yield from _counts(schema, shard, word_id[phrases.ids], phrases.uses, buckets)
                yield _batch(schema, shard=shard, symbols=pack(word_id[text][:, None]))

    return _mapped(shards, run, COUNTS)


def _longer(shards: DataFrame, longest: int, buckets: int) -> DataFrame:
    """Counts of phrases of three words and more."""

    def run(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for shard, symbols, answers in _each_shard(rows):
            word_id, text = np.unique(symbols[:, 0], return_inverse=True)  # 0 is the break
            text = text.astype(np.int32)
            width = len(word_id)
            left, right = (np.searchsorted(word_id, answers[:, i]) for i in (0, 1))
            frequent = np.sort(left * width + right)
            pairs = text[:-1].astype(np.int64) * width + text[1:]
            at = np.minimum(np.searchsorted(frequent, pairs), len(frequent) - 1)
            text = _runs(text, (frequent[at] == pairs) & (text[:-1] > 0) & (text[1:] > 0))
            for phrases in phrases_of(text, longest):
                length = phrases.ids.shape[1]
                if length > 2:
                    keys = np.zeros((len(phrases.uses), LONGEST), np.int64)
                    keys[:, :length] = word_id[phrases.ids]
                    yield from _counts(schema, shard, keys, phrases.uses, buckets)

    return _mapped(shards, run, COUNTS)


def _frequent(counts: DataFrame, least: int, answer: bool) -> DataFrame:
    """Keys with at least so many uses in all shards, and (if asked for) each shard's own among them."""

    def merge(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows, key=lambda row: row[0]):
            shards, parts = [], []
            for _, shard, packed in group:
                shards.append(shard)
                parts.append(unpack(packed))
            keys, sums, places = _summed(parts)
            often = sums >= least
            if not often.any():
                continue
            columns = {c: keys[often, i] if i < keys.shape[1] else 0 for i, c in enumerate(_IDS)}
            yield _batch(schema, int(often.sum()), uses=sums[often], **columns)
            for shard, part, place in zip(shards, parts, places) if answer else ():
                own = part[often[place], :-1]
                if len(own):
                    yield _batch(schema, shard=shard, answer=pack(own, True))

    rows = counts.select("bucket", "shard", "counts").repartition("bucket")
    return _mapped(rows.sortWithinPartitions("bucket", "shard"), merge, FOUND)


def count_phrases(
    docs: DataFrame,
    least: int = 100,
    longest: int = LONGEST,
    shard_words: int = SHARD_WORDS,
    lang_col: str = "lang",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n), words (word_id, lang, word, uses) and phrases (w1..w5, uses; 0: no word).

    Words and phrases with at least ``least`` uses in a language. Word ids differ between languages.
    """
    shards = written(_shards(docs, lang_col, text_col, shard_words), "phrase_shards")
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    buckets = max(1, shards.count())

    words = written(_words(shards, buckets, least), "phrase_words")
    asked = _with_answers(shards, words.where("answer is not null"))
    pairs = written(_pairs(asked, buckets), "phrase_pairs")
    two = written(_frequent(pairs.where("counts is not null"), least, True), "phrase_frequent_pairs")
    asked = _with_answers(pairs.where("symbols is not null"), two.where("answer is not null"))
    more = _frequent(_longer(asked, longest, buckets), least, False)
    found = two.where("answer is null").unionByName(more).select(*_IDS, "uses")
    known = words.where("answer is null").select("word_id", "lang", "word", "uses")
    return totals, known, written(found, "phrases")


# --- scores --------------------------------------------------------------------------------


def _shuffled(df: DataFrame) -> DataFrame:
    """Never a broadcast side: Catalyst sizes counts by their files, where a row takes a tenth of its memory or less."""
    return df.hint("merge")


def _part(begin: Column | int, length: Column) -> list[Column]:
    """Ids of ``length`` words from place ``begin`` (from 1) on, 0 beyond."""
    ids = F.slice(F.col("ids"), begin, length)
    return [F.coalesce(F.get(ids, F.lit(i)), F.lit(0)).cast("bigint").alias(c) for i, c in enumerate(_IDS)]


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    longest: int = LONGEST,
    shard_words: int = SHARD_WORDS,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases, a longer one of equal use before its parts.

    ``score`` is 1000 a n / (l r) of the weakest cut in whole numbers.
    """
    totals, words, phrases = count_phrases(docs, least, longest, shard_words, lang_col, text_col)
    size = sum((F.col(c) > 0).cast("int") for c in _IDS)
    sized = phrases.withColumns({"ids": F.array(*_IDS), "size": size})
    # the most frequent phrase that is one word longer, on either side
    below = F.col("size") - 1
    shorter = F.array(F.struct(*_part(1, below)), F.struct(*_part(2, below)))
    contained = (
        sized.where("size > 2")
        .select("uses", F.explode(shorter).alias("s"))
        .groupBy(*[F.col(f"s.{c}").alias(c) for c in _IDS])
        .agg(F.max("uses").alias("longer"))
    )
    kept = sized.join(_shuffled(contained), _IDS, "left").where("longer is null or longer < uses")
    # every cut: its two parts looked up by one join
    none = [F.lit(0).cast("bigint").alias(c) for c in _IDS[1:]]
    known = phrases.unionByName(words.select(F.col("word_id").alias("w1"), *none, "uses"))
    cuts = kept.select(*_IDS, "ids", "size", "uses", F.explode(F.sequence(F.lit(1), below)).alias("k"))
    sides = F.array(
        F.struct(F.lit(True).alias("is_left"), *_part(1, F.col("k"))),
        F.struct(F.lit(False).alias("is_left"), *_part(F.col("k") + 1, F.col("size") - F.col("k"))),
    )
    parts = cuts.select("ids", "size", F.col("uses").alias("a"), "k", F.explode(sides).alias("s"))
    parts = parts.select("ids", "size", "a", "k", "s.*").join(_shuffled(known), _IDS)
    found = parts.groupBy("ids", "size", "a", "k").agg(
        F.max(F.when(F.col("is_left"), F.col("uses"))).alias("l"),
        F.max(F.when(~F.col("is_left"), F.col("uses"))).alias("r"),
    )
    lang_of = words.select(F.col("word_id").alias("w1"), "lang").join(small_or_shuffled(totals), "lang")
    scored = found.withColumn("w1", F.col("ids")[0]).join(lang_of, "w1")
    exact = F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0)))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    )
    weakest = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("ids", "size", "lang", "n", "a").agg(weakest)
    best = best.select("ids", "size", "lang", "n", "a", "cut.score", "cut.l", "cut.r")
    return _top(best, words, top)


def _top(best: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The best of each language, chosen first within 64 parts of it."""
    order = [F.col("score").desc(), F.col("a").desc()]
    dealt = best.withColumn("_deal", F.pmod(F.xxhash64("ids"), F.lit(64)))
    first = dealt.withColumn("_r", F.rank().over(Window.partitionBy("lang", "_deal").orderBy(*order)))
    first = first.where(F.col("_r") <= top).drop("_r", "_deal")
    each = first.select(F.col("ids"), F.posexplode(F.slice("ids", F.lit(1), F.col("size"))).alias("at", "word_id"))
    spelled = (
        each.join(_shuffled(words.select("word_id", F.col("word").cast("string").alias("word"))), "word_id")
        .groupBy("ids")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("_w"))
        .select("ids", F.array_join("_w.word", " ").alias("phrase"))
    )
    ranked = first.join(spelled, "ids").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    )
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
