"""Exact Jaccard join of word shingles by pigeonholes over a partitioned universe.

Two sets of at most n shingles with Jaccard similarity of p percent or more differ in at most
H = 2 n (100 - p) / (100 + p) shingles. Sizes are cut into bands; a pair is looked for in the band of its
larger set, so a set near the top of its band takes part in the next one too. In a band all shingles are
dealt by hash to segments. With e segments compared whole and d segments compared up to one shingle,
e + 2 d > H, the H differences can't spoil all: the pair agrees in one of them. Sets agree in a segment
when they share its signature (the hash of their shingles there); up to one shingle when they share one of
its one-deletion signatures (the hash of all, and of all but one).

Empty segments agree in all sets and say nothing. A set whose segments of some content still outweigh the
differences it can have (e + 2 d of these alone > H, with H for its own size) leaves the signatures of empty
segments out: any linked set agrees with it in a segment of content, whose signatures all sets give out. Some
more segments than H asks for, and nearly every set can do so.

How many segments are of which kind is chosen for each band by cost: signatures written for each set, plus
unrelated sets that meet by chance in empty segments, which grow with the number of sets in the band.

Equal sets are one class before anything is compared. The least class of those that share a signature is
their hub. Each class is compared with its nearest hub first, which is linear, and components are formed of the
links that hold. Two linked classes share a signature, so they share a hub: what is left are classes of one hub
in different components. These are compared in blocks by parity sketches, whose bits differ in at most as many
places as the sets do, so no linked pair is lost; only pairs that pass are given out and compared in full. Groups
of near copies are thus never paired off. Every link is exact over the shingle hashes. Signatures that occur in
one class only (nearly all) are dropped in the aggregation that finds them.

Shingles and classes are known by 64-bit hashes. A text of fewer words than a shingle is one shingle; a text
without words is empty, and linked with nothing. Null texts are empty. Rows with equal text are one class;
repeated rows each get a result. Components are named by their least doc_id, nulls aside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsepanel.llm.common import (
    ROW, SLICE_BYTES, arrow_map, join_rows, join_table, keyed, small_or_shuffled, written,
)
from pulsepanel.llm.decontaminate import bloom_bits, in_bloom
from pulsepanel.llm.words import gram_hashes, mixed, spaced_hashes


#: What it costs to tell two unrelated sets apart by their sketches, in signatures written.
CHANCE_COST = 0.01
#: Classes of one hub that are compared in one place with as many others: by whole sets, and by sketches.
BLOCK = 1024
SKETCH_BLOCK = 4096


@dataclass(frozen=True)
class Band:
    """Sizes low to high - 1 of the larger set; ``single`` one-deletion and ``whole`` exact segments."""

    low: int
    high: int
    single: int = 0
    whole: int = 1

    @property
    def segments(self) -> int:
        return self.single + self.whole


def most_different(size: int, percent: int) -> int:
    """Shingles in which two linked sets of at most this size can differ."""
    return 2 * size * (100 - percent) // (100 + percent)


def band_edges(largest: int, percent: int) -> list[int]:
    """Lower edges of the bands: each is three times as far as a linked set can be smaller."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * (100 / percent) ** 3)))
    return edges


def bands_of(size: int, edges: list[int], percent: int) -> list[int]:
    """The bands in which a set of this size takes part: its own, and the next if it can link there."""
    own = int(np.searchsorted(edges, size, side="right")) - 1
    reaches = own + 1 < len(edges) - 1 and 100 * size >= percent * edges[own + 1]
    return [own, own + 1] if reaches else [own]


def differences(size: int, band: Band, percent: int) -> int:
    """Shingles in which a set of this size and one linked with it can differ in a band."""
    other = min(band.high - 1, 100 * size // percent)
    return (size + other) * (100 - percent) // (100 + percent)


def _at_least(mean: np.ndarray, k: int) -> np.ndarray:
    """A bound for the chance that a Poisson number with this mean is k or more."""
    if k <= 0:
        return np.ones_like(mean)
    return np.where(mean < k, np.exp(k * (1 + np.log(np.maximum(mean, 1e-300) / k)) - mean), 1.0)


def allocate(low: int, high: int, percent: int, sets: int) -> Band:
    """The cheapest numbers of one-deletion and whole segments for a band with so many sets."""
    needed = most_different(high - 1, percent) + 1
    size = (low + high) / 2
    best: tuple[float, Band] | None = None
    for spare in sorted({*range(min(24, needed) + 1), *range(24, needed // 8, 8)}):
        single = np.arange((needed + spare) // 2 + 1)
        whole = needed + spare - 2 * single
        each = size / (single + whole)
        empty = np.exp(-each)
        # the largest sets have least to spare: how many segments their empty ones cost
        each_top = (high - 1) / (single + whole)
        lost = np.exp(-each_top) * (whole + 2 * single * (1 + each_top))
        met = whole * (empty * _at_least(lost, spare)) ** 2
        met += single * (empty * (1 + each) * _at_least(lost, spare - 1)) ** 2
        cost = whole + single * (1 + each) + CHANCE_COST * sets * met
        at = int(np.argmin(cost))
        if best is None or cost[at] < best[0]:
            best = float(cost[at]), Band(low, high, int(single[at]), int(whole[at]))
    return best[1]


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    hashes = spaced_hashes(text)
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(hashes, min(k, len(hashes))))


def class_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


@lru_cache(maxsize=256)
def _names(number: int, segments: int) -> tuple[np.uint64, np.ndarray]:
    """The salt of a band, and a name for each of its segments."""
    salt = mixed(np.array([number], np.uint64))[0]
    return salt, mixed(np.arange(segments, dtype=np.uint64) * np.uint64(2) + (salt << np.uint64(1)))


def signatures(shingles: np.ndarray, number: int, band: Band, percent: int | None = None) -> np.ndarray:
    """The signatures of a set in one band; given the percentage, without those of empty segments if others do."""
    m = band.segments
    salt, names = _names(number, m)
    segment = mixed(shingles ^ salt) % np.uint64(m)
    segment = segment.astype(np.uint16 if m <= 1 << 16 else np.int64)
    values = mixed(shingles + salt)
    order = np.argsort(segment, kind="stable")  # linear for 16 bits
    segment, values = segment[order], values[order]
    sums = np.zeros(m, np.uint64)
    if len(values):
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        sums[segment[starts]] = np.add.reduceat(values, starts)
    held = np.bincount(segment, minlength=m)
    content = False
    if percent is not None:
        telling = 2 * np.count_nonzero(held[: band.single] > 1) + np.count_nonzero(held[band.single :])
        content = telling > differences(len(shingles), band, percent)
    out = mixed(sums + names)
    if content:
        out = out[held > 0]
    if band.single:
        near = segment < band.single
        if content:
            near &= held[segment] > 1
        less = mixed(sums[segment[near]] - values[near] + names[segment[near]])
        out = np.concatenate([out, less])
    return out


def _sets(rows: DataFrame, k: int) -> DataFrame:
    """doc_id, row key, class and size of every row; no class for texts without words."""

    def run(batch: pa.RecordBatch) -> dict:
        classes, sizes = [], []
        for blob in batch.column(2).to_pylist():
            shingles = shingle_set(blob, k)
            classes.append(class_id(shingles) if len(shingles) else None)
            sizes.append(len(shingles))
        return {"doc_id": batch.column(0), ROW: batch.column(1), "class": classes, "n": sizes}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(
        rows.select("doc_id", ROW, F.col("text").cast("binary")),
        run,
        f"doc_id {kind}, {ROW} bigint, class bigint, n bigint",
        SLICE_BYTES,
    )


def _signature_rows(
    rows: DataFrame, k: int, percent: int, edges: list[int], bands: list[Band], passing: np.ndarray | None
) -> DataFrame:
    """signature, class of all texts; with a Bloom filter, of the signatures that pass it."""
    shared = None if passing is None else rows.sparkSession.sparkContext.broadcast(passing)

    def run(batch: pa.RecordBatch) -> dict:
        found, classes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for blob in batch.column(0).to_pylist():
            shingles = shingle_set(blob, k)
            if not len(shingles):
                continue
            mine_id = class_id(shingles)
            for b in bands_of(len(shingles), edges, percent):
                mine = signatures(shingles, b, bands[b], percent)
                if shared is not None:
                    mine = mine[in_bloom(mine, shared.value)]
                if len(mine):
                    found.append(mine)
                    classes.append(np.full(len(mine), mine_id, np.int64))
        return {
            "signature": pa.array(np.concatenate(found).view(np.int64)),
            "class": pa.array(np.concatenate(classes)),
        }

    # some hundred signatures for each text: given out slice by slice
    return arrow_map(
        rows.select(F.col("text").cast("binary")), run, "signature bigint, class bigint", SLICE_BYTES
    )


def _of_classes(rows: DataFrame, wanted: DataFrame, schema: str, function) -> DataFrame:
    """An Arrow pass over the texts of wanted rows: doc_id, row key and more columns; one row for each."""
    keys = small_or_shuffled(wanted)
    return arrow_map(join_rows(keys, rows, "inner"), function, schema, SLICE_BYTES)


def _sketches(rows: DataFrame, wanted: DataFrame, k: int, percent: int) -> DataFrame:
    """class, n and parity sketch of the wanted classes (doc_id, row key, class)."""

    def run(batch: pa.RecordBatch) -> dict:
        at = batch.schema.names.index
        sets = [shingle_set(t.encode(), k) for t in batch.column(at("text")).to_pylist()]
        return {
            "class": batch.column(at("class")),
            "n": [len(s) for s in sets],
            "sketch": [parity_sketch(s, sketch_bits(len(s), percent)).tobytes() for s in sets],
        }

    found = _of_classes(rows, wanted, "class bigint, n int, sketch binary", run)
    return found.groupBy("class").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 |a & b| >= percent |a or b| for ascending arrays without repeats."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def parity_sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` buckets whether it holds an odd number of shingles.

    A shingle in one of two sets only flips one bit, so sketches differ in at most as many bits as the sets
    differ in shingles.
    """
    buckets = (mixed(shingles) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(buckets, minlength=bits) & 1)


def sketch_bits(size: int, percent: int) -> int:
    """A power of two, enough to tell sets of this size that differ in more than linked ones."""
    return max(512, 1 << (8 * most_different(size, percent)).bit_length())


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch with fewer bits: buckets that coincide then, combined."""
    out = np.frombuffer(sketch, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def _links(rows: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked.

    The set of each ``a`` is made from its text and sent to ``b``, whose set is sent once for each share of
    its pairs. A task reads b's set, then one other at a time.
    """
    shares = F.ceil(F.count("*") / BLOCK).alias("shares")
    hubs = pairs.groupBy("b").agg(shares)
    share = F.pmod(F.xxhash64("a"), F.col("shares"))
    sent = pairs.join(hubs, "b").select(
        F.col("a").alias("class"), F.col("b").alias("hub"), share.alias("share")
    )
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share")
    sent = sent.unionByName(hubs.select(F.col("b").alias("class"), F.col("b").alias("hub"), each))
    wanted = written(sent.join(classes.select("class", "doc_id", ROW), "class"), "sets_to_send")

    def make(batch: pa.RecordBatch) -> dict:
        at = batch.schema.names.index
        texts = batch.column(at("text")).to_pylist()
        return {c: batch.column(at(c)) for c in ("hub", "share", "class")} | {
            "shingles": [shingle_set(t.encode(), k).tobytes() for t in texts]
        }

    schema = "hub bigint, share bigint, class bigint, shingles binary"
    sets = _of_classes(rows, wanted, schema, make)
    ordered = (
        sets.withColumn("other", F.col("class") != F.col("hub"))
        .repartition("hub", "share")
        .sortWithinPartitions("hub", "share", "other")
        .select("hub", "share", "class", "shingles")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = its = None
        for batch in batches:
            found = []
            for of, share, one, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if one == of:
                    hub, its = (of, share), np.frombuffer(shingles, np.uint64)
                elif hub == (of, share) and linked(np.frombuffer(shingles, np.uint64), its, percent):
                    found.append((one, of))
            if found:
                sides = [pa.array(side, pa.int64()) for side in zip(*found)]
                yield pa.RecordBatch.from_arrays(sides, names=["a", "b"])

    return ordered.mapInArrow(compare, "a bigint, b bigint")


def close_pairs(
    classes: np.ndarray,
    labels: np.ndarray,
    sizes: np.ndarray,
    sketches: np.ndarray,
    first: np.ndarray,
    second: np.ndarray,
    percent: int,
    forest: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, one of each side, of different labels that their sketches allow to be linked.

    With ``forest`` only as many, nearest first, as connect the labels that all of them connect.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    words = sketches.view(np.uint64)
    rows = max(1, (1 << 21) // max(1, len(second) * words.shape[1]))
    for at in range(0, len(first), rows):
        some = first[at : at + rows]
        changed = words[some][:, None, :] ^ words[second][None, :, :]
        differ = np.bitwise_count(changed).sum(axis=2, dtype=np.int64)
        total = sizes[some][:, None] + sizes[second][None, :]
        good = (100 + percent) * differ <= (100 - percent) * total
        good &= labels[some][:, None] != labels[second][None, :]
        x, y = np.nonzero(good)
        found.append((some[x], second[y], differ[x, y]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x, y, far = (np.concatenate(side) for side in zip(*found))
    if forest:
        kept = _forest(labels, x, y, far)
        x, y = x[kept], y[kept]
    return np.minimum(classes[x], classes[y]), np.maximum(classes[x], classes[y])


def _forest(labels: np.ndarray, x: np.ndarray, y: np.ndarray, far: np.ndarray) -> list[int]:
    """Places of the pairs (x, y) that join two labels not joined by nearer ones."""
    parent = {label: label for label in labels.tolist()}
    of = labels.tolist()

    def root(label: int) -> int:
        while parent[label] != label:
            parent[label] = parent[parent[label]]
            label = parent[label]
        return label

    kept, left = [], len(parent) - 1
    order = np.argsort(far, kind="stable")
    for i, p, q in zip(order.tolist(), x[order].tolist(), y[order].tolist()):
        a, b = root(of[p]), root(of[q])
        if a != b:
            parent[a] = b
            kept.append(i)
            left -= 1
            if not left:
                break
    return kept


def _nearest(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with that of its hubs whose sketch is nearest, if it may be linked."""
    its = sketches.select(
        F.col("class").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch")
    )
    sides = members.where("class <> hub").join(its, "hub")

    def run(batch: pa.RecordBatch) -> dict:
        at = batch.schema.names.index
        column = lambda c: batch.column(at(c)).to_pylist()
        far = []
        for x, y, n, m in zip(column("sketch"), column("hub_sketch"), column("n"), column("hub_n")):
            size = min(len(x), len(y))
            differ = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())
            far.append(differ if (100 + percent) * differ <= (100 - percent) * (n + m) else None)
        return {"a": batch.column(at("class")), "b": batch.column(at("hub")), "far": far}

    near = arrow_map(sides, run, "a bigint, b bigint, far int").where("far is not null")
    return near.groupBy("a").agg(F.min(F.struct("far", "b"))["b"].alias("b"))


def _apart(members: DataFrame, percent: int, forest: bool, block: int = SKETCH_BLOCK) -> DataFrame:
    """Pairs (a, b) of classes of a hub in different components that may be linked.

    ``members``: hub, class, label, n, sketch. The classes of a hub are dealt to blocks; each two blocks meet
    in one place, two blocks at a time, where sketches are compared and only what passes is given out. The
    classes of a hub's largest component have blocks of their own, which never meet each other: a group of any
    size with a few strays is read once, and the strays once for each of its blocks.
    """
    labels = members.groupBy("hub", "label").agg(F.count("*").alias("n"))
    several = (
        labels.groupBy("hub")
        .agg(
            F.sum("n").alias("all"),
            F.count("*").alias("labels"),
            F.max(F.struct("n", "label")).alias("top"),
        )
        .where("labels > 1")
        .withColumn("tops", F.when(F.col("top.n") > block, F.ceil(F.col("top.n") / block)).otherwise(0))
        .withColumn("rest", F.col("all") - F.when(F.col("tops") > 0, F.col("top.n")).otherwise(0))
        .select("hub", F.col("top.label").alias("top"), "tops", F.ceil(F.col("rest") / block).alias("blocks"))
    )
    in_top = (F.col("tops") > 0) & (F.col("label") == F.col("top"))
    hashed = F.xxhash64("class")
    # blocks of the largest component count down from -1
    own = F.when(in_top, -1 - F.pmod(hashed, F.col("tops"))).otherwise(F.pmod(hashed, F.col("blocks")))
    rest = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    tops = F.when(F.col("tops") > 0, F.sequence(-F.col("tops"), F.lit(-1).cast("bigint")))
    met = F.when(in_top | tops.isNull(), rest).otherwise(F.concat(rest, tops))
    dealt = (
        members.join(several, "hub")
        .withColumn("block", own)
        .select("hub", "class", "label", "n", "sketch", "block", F.explode(met).alias("other"))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .repartition("hub", "low", "high")
        .sortWithinPartitions("hub", "low", "high")
        .select("hub", "low", "high", "class", "label", "n", "sketch", "block")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for (_, low, high), group in groupby(rows, key=lambda row: row[:3]):
            _, _, _, classes, labels, sizes, sketches, blocks = zip(*group)
            if len(set(labels)) == 1:
                continue
            blocks = np.array(blocks)
            size = min(map(len, sketches))
            held.append(
                close_pairs(
                    np.array(classes, np.int64), np.array(labels, np.int64), np.array(sizes, np.int64),
                    np.stack([folded(x, size) for x in sketches]),
                    np.flatnonzero(blocks == low), np.flatnonzero(blocks == high), percent, forest,
                )
            )
            if sum(len(a) for a, _ in held) >= 1 << 16:
                yield _pair_batch(held)
                held = []
        if held:
            yield _pair_batch(held)

    return dealt.mapInArrow(run, "a bigint, b bigint").where("a < b").distinct()


def _pair_batch(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (pa.array(np.concatenate(side)) for side in zip(*held))
    return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """class, label: the least class reachable by links (a, b), for all linked classes.

    Alternating stars: each class hands its least neighbour to its larger, then to its smaller
    neighbours, until nothing changes. Minima are summed in each task; each round is written, so a lost
    executor costs one round at most.
    """

    def state(edges: DataFrame) -> tuple:
        # the edges are distinct, so equal sums of 128 bits mean equal tables
        whole = [F.sum(F.xxhash64(F.lit(salt), "u", "v").cast("decimal(38,0)")) for salt in (1, 2)]
        return tuple(edges.agg(F.count("*"), *whole).first())

    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        "links",
    )
    before = state(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = written(small.where("u <> v").distinct(), "stars")
        now = state(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("Components did not settle.")
    stars = edges.select(F.col("u").alias("class"), F.col("v").alias("label"))
    return stars.unionByName(edges.select(F.col("v").alias("class"), F.col("v").alias("label")).distinct())


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    joined = members.join(labels, "class", "left")
    return joined.withColumn("label", F.coalesce("label", "class"))


def class_components(rows: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their classes (doc_id, row key, class, n), and the label of each class with its
    component's least doc_id."""
    found = written(_sets(rows, k), "shingle_sets")
    classes = written(
        found.where("class is not null")
        .groupBy("class", "n")
        .agg(F.min(F.struct("doc_id", ROW)).alias("one"), F.min("doc_id").alias("least"))
        .select("class", "n", "one.*", "least"),
        "classes",
    )
    largest = classes.agg(F.max("n")).first()[0] or 0
    edges = band_edges(largest, percent)
    # as many rows as bands: a few dozen
    own = F.expr(f"size(filter(array({', '.join(f'{e}L' for e in edges)}), x -> x <= n)) - 1")
    sizes = dict(classes.groupBy(own.alias("band")).count().collect()) if largest else {}
    bands = [
        allocate(low, high, percent, sizes.get(b, 0) + sizes.get(b - 1, 0))
        for b, (low, high) in enumerate(zip(edges, edges[1:]))
    ]
    shared = (
        _signature_rows(rows, k, percent, edges, bands, None)
        .groupBy("signature")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("signature", "low")
    )
    shared = written(shared, "shared_signatures")
    passing = bloom_bits(shared, "signature")
    members = written(
        _signature_rows(rows, k, percent, edges, bands, passing)
        .join(shared, "signature")
        .select("class", "low")
        .distinct(),
        "signature_members",
    )
    wanted = classes.select("class", "doc_id", ROW).join(members.select("class").distinct(), "class")
    sketches = written(_sketches(rows, wanted, k, percent), "class_sketches")
    members = written(members.withColumnRenamed("low", "hub").join(sketches, "class"), "hub_members")
    nearest = _nearest(members, sketches, percent)
    links = written(_links(rows, classes, nearest, k, percent), "hub_links")
    labels = components(links)
    # what is still apart around a hub: first what would connect it, then whatever is left
    for forest in (True, False):
        pairs = written(_apart(_labelled(members, labels), percent, forest), "close_pairs")
        more = written(_links(rows, classes, pairs, k, percent), "further_links")
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = components(links)
    joined = _labelled(classes.select("class", "least"), labels)
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    return found, joined.join(least, "label").select("class", "label", "component_id")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, row key, n_shingles, component_id for every row."""
    if not 0 < percent <= 100 or k < 1:
        raise ValueError("A similarity is 1 to 100 percent, a shingle has a word at least.")
    found, of_class = class_components(keyed(docs, id_col, text_col), k, percent)
    out = found.join(of_class, "class", "left")
    return out.select(
        "doc_id",
        ROW,
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: that with the least doc_id, of equals the one with the least key.

    All columns of the table are kept. Texts without words are no copies of anything and stay, but of
    repeated rows with one id and text one stays.
    """
    found, of_class = class_components(keyed(docs, "doc_id", "text"), k, percent)
    near = (
        found.join(of_class, "class", "left")
        .groupBy("doc_id", ROW)
        .agg(F.count("*").alias("rows"), F.min("label").alias("label"))
    )
    one = F.struct("doc_id", ROW)
    near = near.withColumn("alone", F.when(F.col("label").isNull(), one))
    first = near.groupBy("label", "alone").agg(F.min(one).alias("one"))
    kept = first.select(F.col("one.doc_id").alias("doc_id"), F.col(f"one.{ROW}").alias(ROW))
    near = written(join_rows(near, kept.withColumn("kept", F.lit(True))), "near_duplicate_rows")
    # most rows stay: those that go, or stay once of several, are the smaller side
    special = near.where("kept is null or rows > 1").select("doc_id", ROW)
    out = join_table(docs, small_or_shuffled(special), "left_anti")
    several = near.where("kept and rows > 1").select("doc_id", ROW)
    if several.limit(1).count():
        once = join_table(docs, small_or_shuffled(several), "left_semi")
        out = out.unionByName(once.dropDuplicates(["doc_id", "text"]))
    return out
