"""Benchmark decontamination by winnowing.

Every run of ``k`` words has a hash; of each ``window - k + 1`` neighbouring hashes the least is kept (the
rightmost of equals). The choice depends on those ``window`` words alone, so a document and an item that
share ``window`` words in a row keep the same hash there: no shared window is missed. Items shorter than a
window are kept whole, as one hash of all their words, and documents give the hashes of runs of those few
lengths too.

Document hashes first pass a Bloom filter of the items' hashes, of fixed size whatever the tables hold; what
passes is joined with the items' hashes on the hash. Both sides carry the words around, as far as a window
can reach, so a hit is compared word by word and extended on the spot: hashes only nominate. A hit of at
least a window of equal words counts; its words are hit.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. Null, empty and
wordless texts have no words, no window and no hit. Rows with one doc_id and equal text share their result,
each row gets one. Items with equal ids count once. Null item ids are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import ROW, arrow_map, join_rows, join_table, keyed, small_or_shuffled, written
from pulsepanel.llm.words import alnum_hashes, alnum_words, gram_hashes, mixed, word_hashes

WINDOW = 10
GRAM = 5
#: Bits of the Bloom filter: 2 MB for each task.
FILTER_BITS = 1 << 24
_PRINT = "array<struct<at: int, print: bigint, left: int, around: binary>>"


def winnow(hashes: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions of the kept k-grams of a text, from its words' hashes."""
    grams = gram_hashes(hashes, k)
    w = window - k + 1
    if len(grams) < w:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams[::-1], w)
    # the first least from the back is the rightmost
    last = len(grams) - 1 - (np.arange(len(views)) + views.argmin(axis=1))
    return np.unique(last)


def prints(hashes: np.ndarray, k: int, window: int, short: tuple[int, ...]) -> list[tuple]:
    """(position, length of the run, hash) of the kept runs, and of all runs of the short lengths.

    ``hashes``: of the words of a text.
    """
    out = []
    grams = gram_hashes(hashes, k)
    at = winnow(hashes, k, window)
    out.append((at, np.full(len(at), k), grams[at]))
    for length in short:
        grams = gram_hashes(hashes, length)
        # another hash than that of a k-gram of this length
        out.append((np.arange(len(grams)), np.full(len(grams), -length), mixed(grams + np.uint64(1))))
    return out


def _around(words: list[bytes], at: int, length: int, k: int, window: int) -> tuple[int, bytes]:
    """How many words of the context lie left of the run, and the context."""
    if length < 0:
        return 0, b" ".join(words[at : at - length])
    left = min(at, window - k)
    return left, b" ".join(words[at - left : at + window])


def _item_prints(items: DataFrame, k: int, window: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("item_id", "print", "length", "left", "around")}
        for item, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = alnum_words(blob or b"")
            short = (len(words),) if 0 < len(words) < window else ()
            for at, length, value in prints(word_hashes(words), k, window, short):
                for a, n, v in zip(at.tolist(), length.tolist(), value.view(np.int64).tolist()):
                    left, around = _around(words, a, n, k, window)
                    for name, x in zip(out, (item, v, n, left, around)):
                        out[name].append(x)
        return out

    return arrow_map(
        items, run, "item_id bigint, print bigint, length int, left int, around binary"
    )


def bloom_bits(values: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """One bit for each hash, in an array of fixed size; set words are merged before they are sent."""
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        values.select((F.shiftrightunsigned(slot, 6)).alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
    )
    out = np.zeros(bits // 64, np.int64)
    for batch in words.toArrow().to_batches():  # bits / 64 rows at most
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint64)


def in_bloom(values: np.ndarray, filter_words: np.ndarray) -> np.ndarray:
    slot = values & np.uint64(len(filter_words) * 64 - 1)
    words = filter_words[(slot >> np.uint64(6)).astype(np.int64)]
    return ((words >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def _document_prints(
    docs: DataFrame, k: int, window: int, short: tuple[int, ...], passing: np.ndarray
) -> DataFrame:
    """doc_id, row key, n_words, and the prints that may be an item's with the words around them."""
    shared = docs.sparkSession.sparkContext.broadcast(passing)

    def run(batch: pa.RecordBatch) -> dict:
        counts, kept = [], []
        for blob in batch.column(2).to_pylist():
            hashes = alnum_hashes(blob)
            counts.append(len(hashes))
            mine, words = [], []
            for at, length, value in prints(hashes, k, window, short):
                good = np.flatnonzero(in_bloom(value, shared.value))
                words = words or (alnum_words(blob) if len(good) else [])
                for i in good.tolist():
                    a, n = int(at[i]), int(length[i])
                    left, around = _around(words, a, n, k, window)
                    mine.append(
                        {"at": a, "print": int(value[i].astype(np.int64)), "left": left, "around": around}
                    )
            kept.append(mine)
        return {"doc_id": batch.column(0), ROW: batch.column(1), "n_words": counts, "prints": kept}

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", ROW, F.col("text").cast("binary"))
    return arrow_map(rows, run, f"doc_id {kind}, {ROW} bigint, n_words bigint, prints {_PRINT}")


def extend(
    words: list[bytes], left: int, other: list[bytes], other_left: int, length: int, window: int
) -> tuple[int, int] | None:
    """How far equal words reach left and right of where two runs start; None below a window."""
    if length < 0:
        return (0, -length) if words == other else None
    back = 0
    while back < min(left, other_left) and words[left - back - 1] == other[other_left - back - 1]:
        back += 1
    ahead, most = 0, min(len(words) - left, len(other) - other_left)
    while ahead < most and words[left + ahead] == other[other_left + ahead]:
        ahead += 1
    return (back, ahead) if ahead >= length and back + ahead >= window else None


def _verified(pairs: DataFrame, window: int) -> DataFrame:
    """doc_id, row key, item_id, start and end of the equal words of each pair that holds."""

    def run(batch: pa.RecordBatch) -> dict:
        columns = dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns)))
        keep, starts, ends = [], [], []
        for i, (at, length) in enumerate(zip(columns["at"], columns["length"])):
            reach = extend(
                columns["around"][i].split(b" "), columns["left"][i],
                columns["item_around"][i].split(b" "), columns["item_left"][i], length, window,
            )
            if reach:
                keep.append(i)
                starts.append(at - reach[0])
                ends.append(at + reach[1])
        rows = pa.array(keep, pa.int64())
        return {n: batch.column(n).take(rows) for n in ("doc_id", ROW, "item_id")} | {
            "from_word": starts,
            "to_word": ends,
        }

    kind = pairs.schema["doc_id"].dataType.simpleString()
    return arrow_map(
        pairs, run, f"doc_id {kind}, {ROW} bigint, item_id bigint, from_word int, to_word int"
    )


def hits(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    k: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, row key, n_words) and hits (doc_id, row key, item_id, from_word, to_word)."""
    if not 1 <= k <= window:
        raise ValueError("A gram is at most as long as a window.")
    item_rows = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("bigint"), F.col("text").cast("string").cast("binary")
    )
    item_prints = written(_item_prints(item_rows, k, window).distinct(), "item_prints")
    # at most window - 1 lengths
    short = [r.length for r in item_prints.where("length < 0").select("length").distinct().collect()]
    passing = bloom_bits(item_prints, "print")
    found = written(
        _document_prints(keyed(docs, id_col, text_col), k, window, tuple(-n for n in sorted(short)), passing),
        "document_prints",
    )
    single = found.where(F.size("prints") > 0).select("doc_id", ROW, F.inline("prints"))
    sides = item_prints.select(
        "item_id", "print", "length", F.col("left").alias("item_left"), F.col("around").alias("item_around")
    )
    pairs = single.join(sides, "print")
    return found.select("doc_id", ROW, "n_words"), _verified(pairs, window).distinct()


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, row key, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    rows, found = hits(docs, items, **options)
    found = written(found, "benchmark_hits")
    word = F.explode(F.sequence("from_word", F.col("to_word") - 1)).alias("word")
    hit = (
        found.select("doc_id", ROW, "from_word", "to_word")
        .distinct()
        .select("doc_id", ROW, word)
        .distinct()
        .groupBy("doc_id", ROW)
        .agg(F.count("*").alias("n_hit"))
    )
    named = found.select("doc_id", ROW, F.col("item_id").cast("string").alias("item")).distinct()
    by_doc = named.groupBy("doc_id", ROW).agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = join_rows(join_rows(rows, hit), by_doc)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    n_items = F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("bigint")
    return out.select(
        "doc_id",
        ROW,
        "n_words",
        n_hit.alias("n_hit"),
        n_items.alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of a table that share no window with an item, with all their columns."""
    _, found = hits(docs, items, **options)
    hit = written(found.select("doc_id", ROW).distinct(), "contaminated_rows")
    return join_table(docs, small_or_shuffled(hit), "left_anti")
