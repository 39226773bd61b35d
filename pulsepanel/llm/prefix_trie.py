"""Trie of conversation beginnings: what conversations share from their first turn on.

Every conversation is rebuilt: the first h turns of the first conversation of its hundred, then its own turns
after its first h; h is its id's checksum modulo 6. A node is a distinct sequence of turns. Its totals come
from its children, by time-forward processing:

1. Turns stream by hundred and conversation; each row is a turn of a rebuilt conversation with the digests of
   its node and its parent, and the conversation's path (the beginnings of its first turns' digests).
2. Rows are dealt into shards by split points of (path, conversation, depth), so a shard is a stretch of the
   trie in depth-first order and no node, turn or conversation has to fit into one. A node whose turns may lie
   in several shards has a path that begins a split point's path: it is *open*.
3. A shard sorts its rows by reverse level order (Spark's external sort) and reads them once: at each node the
   messages of its children are taken from a priority queue that spills sorted runs, and its totals are sent
   to its parent through the same queue. Open nodes give partial totals.
4. Partial totals of open nodes are summed and go through the same process, across the shards' roots. The root
   of the trie is summed from the nodes of the first turn.

Defined cases: turns are ordered by turn (null first), ties by role, then by MD5 of the turn; equal rows are turns of
their own. Null roles and texts are empty. Rows without a conv_id belong to no conversation. ``c - c % 100`` takes
the sign of c. Texts of any length are read once for their digest and length; other columns are not read. Without
conversations there are no nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import struct
import tempfile
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from pulsepanel.llm.common import small_or_shuffled, written

#: Turns that a conversation takes from another at most.
MOST_TAKEN = 5
#: Turns of a conversation's path, and bytes of each turn's digest in it.
PATH_TURNS, PATH_BYTES = 12, 8
#: Turns of a shard, the most shards, and the turns looked at for each split point.
SHARD_TURNS, MOST_SHARDS, SAMPLED = 200_000, 4096, 32
#: Messages of a queue in memory.
QUEUED = 200_000
BATCH_ROWS = 1 << 15

_TWO = ">qq"
_ID = "a bigint, b bigint, pa bigint, pb bigint"
TURNS = f"path binary, conv_id bigint, depth bigint, {_ID}, chars bigint, is_end boolean"
#: Totals so far: members, children, childless nodes and savings below.
SUMS = "n bigint, children bigint, leaves bigint, saved bigint"
STATES = f"is_open boolean, path binary, depth bigint, {_ID}, conv_id bigint, chars bigint, {SUMS}, is_end boolean"
#: ``state``: 0 a node without its parent's conv_id, 1 a whole node, 2 partial totals of an open node.
NODES = (
    f"state int, path binary, depth bigint, {_ID}, conv_id bigint, chars bigint, {SUMS}, ends string, parent_conv_id bigint"
)
_EMPTY = hashlib.sha256().hexdigest()


def rebuilt_head(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first one of its hundred."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_TAKEN + 1)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


# --- 1: rebuilt conversations -----------------------------------------------------------------


def _rebuilt(base: list[tuple], head: int, own: Iterator[tuple]) -> Iterator[tuple]:
    yield from base[:head]
    for place, turn in enumerate(own):
        if place >= head:
            yield turn


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """A row for each turn of the rebuilt conversations, and one of depth 0 for each conversation.

    Five turns of the first conversation of a hundred are held, and the beginning of one conversation.
    """
    schema = to_arrow_schema(_parse_datatype_string(TURNS))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv_id = F.col("conv_id").cast("bigint")
    turns = (
        conversations.where("conv_id is not null")
        .select(
            conv_id.alias("conv_id"),
            (conv_id - conv_id % 100).alias("base"),
            rebuilt_head(conv_id).cast("int").alias("head"),
            F.col("turn").cast("bigint").alias("turn"),
            role.alias("role"),
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
            F.length(text).cast("bigint").alias("chars"),
        )
        .withColumn("later", F.col("conv_id") != F.col("base"))
        .repartition("base")
        .sortWithinPartitions("base", "later", "conv_id", F.col("turn").asc_nulls_first(), "role", "key")
        .select("base", "conv_id", "head", "key", "chars")
    )

    def conversation(conv_id: int, turns: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []
        path, node, parent = b"", bytes(16), bytes(16)
        last = (conv_id, 0, 0, 0, 0, 0, 0)
        for depth, (key, chars) in enumerate(turns, 1):
            if depth <= PATH_TURNS:
                held.append(last)
                path += key[:PATH_BYTES]
            else:
                yield from ((path, *row, False) for row in held)
                held = [last]
            parent, node = node, hashlib.md5(node + key).digest()
            last = (conv_id, depth, *struct.unpack(_TWO, node), *struct.unpack(_TWO, parent), chars)
        yield from ((path, *row, False) for row in held)
        yield (path, *last, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for base_id, hundred in groupby(_rows(batches), key=lambda row: row[0]):
                base: list[tuple] = []
                for (conv_id, head), rows in groupby(hundred, key=lambda row: row[1:3]):
                    own = (row[3:] for row in rows)
                    if conv_id == base_id:
                        yield from conversation(conv_id, _keep_first(own, base))
                    else:
                        yield from conversation(conv_id, _rebuilt(base, head, own))

        yield from _batches(each(), schema)

    return turns.mapInArrow(run, TURNS)


def _keep_first(turns: Iterator[tuple], kept: list[tuple]) -> Iterator[tuple]:
    """The turns; as many as others can take are also added to ``kept``."""
    for turn in turns:
        if len(kept) < MOST_TAKEN:
            kept.append(turn)
        yield turn


# --- 2: shards --------------------------------------------------------------------------------


def split_points(turns: DataFrame, shard_turns: int, most: int = MOST_SHARDS) -> list[tuple[bytes, int, int]]:
    """Keys (path, conv_id, depth) at which shards begin, from a sample that hashes choose.

    At most ``most`` shards and ``SAMPLED`` sampled rows for each come to the driver.
    """
    shards = min(most, -(-turns.count() // shard_turns))
    if shards < 2:
        return []
    key = ["path", "conv_id", "depth"]
    sampled = turns.select(*key).orderBy(F.xxhash64(*key), *key).limit(shards * SAMPLED).collect()
    keys = sorted({(bytes(r.path), r.conv_id, r.depth) for r in sampled})
    return sorted({keys[i * len(keys) // shards] for i in range(1, shards)})


def _begins(paths: list[bytes], path: bytes, depth: int) -> bool:
    """Whether a node's path begins one of the sorted paths."""
    prefix = path[: min(depth, PATH_TURNS) * PATH_BYTES]
    at = bisect_left(paths, prefix)
    return at < len(paths) and paths[at].startswith(prefix)


def _dealt(turns: DataFrame, splits: list[tuple[bytes, int, int]]) -> DataFrame:
    """Turns as states of single members with their shard and whether their node is open."""
    schema = to_arrow_schema(_parse_datatype_string(f"shard int, {STATES}"))
    paths = sorted({path for path, _, _ in splits})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for path, conv_id, depth, a, b, pa_, pb, chars, is_end in _rows(batches):
                shard = bisect_left(splits, (path, conv_id, depth))
                is_open = _begins(paths, path, depth)
                yield (
                    shard, is_open, path if is_open else None, depth, a, b, pa_, pb, conv_id, chars,
                    1, 0, 0, 0, is_end,
                )

        yield from _batches(each(), schema)

    return turns.where("depth > 0").mapInArrow(run, f"shard int, {STATES}")


# --- 3: time-forward processing ---------------------------------------------------------------


class SpillingQueue:
    """Smallest first. Beyond ``most`` messages the larger half goes to a sorted run on disk.

    A run is a nameless file of the task, read in blocks; nothing is left of it when the task ends.
    """

    def __init__(self, most: int = QUEUED, block: int = 4096):
        self.most, self.block = most, block
        self.heap: list = []
        self.runs: list = []  # (next message, number, rest of the run)
        self.spilled = 0

    def push(self, message) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        file = tempfile.TemporaryFile()
        for begin in range(half, len(self.heap), self.block):
            pickle.dump(self.heap[begin : begin + self.block], file)
        del self.heap[half:]
        self.spilled += 1
        self._next(self.spilled, self._read(file))

    @staticmethod
    def _read(file) -> Iterator:
        with file:
            file.seek(0)
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _next(self, number: int, rest: Iterator) -> None:
        for message in rest:
            heapq.heappush(self.runs, (message, number, rest))
            return

    def first(self):
        """The smallest message, or None."""
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self):
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            message, number, rest = heapq.heappop(self.runs)
            self._next(number, rest)
            return message
        return heapq.heappop(self.heap)


def time_forward(states: Iterator[tuple], across: bool = False, queued: int = QUEUED) -> Iterator[tuple]:
    """Rows of NODES from rows of STATES in reverse level order: depth falling, then node, then conv_id.

    Within a shard (``across`` false) open nodes give partial totals; across shards every node is whole.
    A message is (its parent's place in the order, the child's finished row).
    """
    queue = SpillingQueue(queued)
    for (depth, a, b), rows in groupby(states, key=lambda row: (row[2], row[3], row[4])):
        n = children = leaves = saved = 0
        smallest, ends = None, None
        for is_open, path, _, _, _, pa_, pb, conv_id, chars, *sums, is_end in rows:
            n, children, leaves, saved = n + sums[0], children + sums[1], leaves + sums[2], saved + sums[3]
            smallest = conv_id if smallest is None else min(smallest, conv_id)
            if is_end and not is_open:
                # members come in the order of their ids
                if ends is None:
                    ends = hashlib.sha256(str(conv_id).encode())
                else:
                    ends.update(f",{conv_id}".encode())
        whole = across or not is_open
        place = (-depth, a, b)
        while (message := queue.first()) is not None and message[:3] == place:
            child = queue.pop()[3]
            children, leaves, saved = children + 1, leaves + child[11], saved + child[12]
            yield (1, *child[1:-1], smallest) if whole else child
        digest = ends.hexdigest() if ends else _EMPTY
        if whole:
            leaves = leaves or 1
            saved += (n - 1) * chars
        found = (
            0 if whole else 2, path, depth, a, b, pa_, pb, smallest, chars, n, children, leaves, saved, digest, None,
        )
        if whole and depth > 1:
            queue.push((1 - depth, pa_, pb, found))
        else:
            yield found
    if queue.first() is not None:
        raise ValueError("A message for a node that isn't there.")


def _processed(states: DataFrame, across: bool, key: list) -> DataFrame:
    schema = to_arrow_schema(_parse_datatype_string(NODES))
    names = [f.name for f in _parse_datatype_string(STATES).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # children before parents; totals are sent ahead by a queue that spills
        yield from _batches(time_forward(_rows(batches), across), schema)

    dealt = states.repartition(*key).select(*names)
    ordered = dealt.sortWithinPartitions(F.col("depth").desc(), "a", "b", "conv_id")
    return ordered.mapInArrow(run, NODES)


def _end_digests(ends: DataFrame) -> DataFrame:
    """a, b, ends of nodes whose members lie in several shards, from (a, b, conv_id) of conversations that end there.

    Ids are sorted and joined to pieces of text over all tasks; a digest reads the pieces of its node in order.
    """
    pieces_schema = to_arrow_schema(_parse_datatype_string("a bigint, b bigint, first bigint, piece string"))
    digest_schema = to_arrow_schema(_parse_datatype_string("a bigint, b bigint, ends string"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for (a, b), rows in groupby(_rows(batches), key=lambda row: row[:2]):
                held: list[int] = []
                for _, _, conv_id in rows:
                    held.append(conv_id)
                    if len(held) == 4096:
                        yield a, b, held[0], ",".join(map(str, held))
                        held = []
                if held:
                    yield a, b, held[0], ",".join(map(str, held))

        yield from _batches(pieces(), pieces_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for (a, b), rows in groupby(_rows(batches), key=lambda row: row[:2]):
                found = None
                for *_, piece in rows:
                    if found is None:
                        found = hashlib.sha256(piece.encode())
                    else:
                        found.update(f",{piece}".encode())
                yield a, b, found.hexdigest()

        yield from _batches(digests(), digest_schema)

    pieces = (
        ends.repartitionByRange("a", "b", "conv_id")
        .sortWithinPartitions("a", "b", "conv_id")
        .mapInArrow(join, "a bigint, b bigint, first bigint, piece string")
    )
    return (
        pieces.repartition("a", "b")
        .sortWithinPartitions("a", "b", "first")
        .mapInArrow(digest, "a bigint, b bigint, ends string")
    )


# --- 4: across shards -------------------------------------------------------------------------

RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def _result(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns = written(rebuilt_turns(conversations), "trie_turns")
    dealt = _dealt(turns, split_points(turns, shard_turns))
    within = written(_processed(dealt, False, ["shard"]), "trie_shards")

    # totals of open nodes from all shards, their ends, and the same process across shards
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    is_open = F.lit(True).alias("is_open")
    merged = (
        within.where("state = 2")
        .groupBy("depth", "a", "b", "pa", "pb", "chars")
        .agg(F.min("path").alias("path"), F.min("conv_id").alias("conv_id"), *sums)
        .select("*", is_open, F.lit(False).alias("is_end"), F.substring("path", 1, PATH_BYTES).alias("root"))
    )
    across = written(_processed(merged, True, ["root"]), "trie_across")
    digests = _end_digests(dealt.where("is_open and is_end").select("a", "b", "conv_id"))
    known = across.drop("ends").join(digests, ["a", "b"], "left")
    opened = written(known.withColumn("ends", F.coalesce("ends", F.lit(_EMPTY))), "trie_open")

    # children of open nodes and of the root
    parents = opened.select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("found_conv_id")
    )
    waiting = within.where("state = 0 and depth > 1").join(small_or_shuffled(parents), ["pa", "pb"])
    waiting = waiting.withColumn("parent_conv_id", F.col("found_conv_id"))
    first = within.where("state = 0 and depth = 1").unionByName(opened.where("depth = 1"))
    root, root_conv_id = _root(turns, first)
    first = first.withColumn("parent_conv_id", F.lit(root_conv_id).cast("bigint"))
    done = within.where("state = 1").unionByName(opened.where("depth > 1"))
    nodes = [_result(x) for x in (done, waiting, first)]
    return nodes[0].unionByName(nodes[1]).unionByName(nodes[2]).unionByName(root)


def _root(turns: DataFrame, first: DataFrame) -> tuple[DataFrame, int | None]:
    """The root as a table of one row (none without conversations), and its conv_id."""
    spark = turns.sparkSession
    starts = turns.where("depth = 0")
    total = starts.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).collect()[0]
    below = first.agg(F.count("*").alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).collect()[0]
    empty = _end_digests(
        starts.where("is_end").select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "conv_id")
    ).collect()
    schema = (
        "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    )
    row = (
        total.conv_id, 0, None, total.n, below.n, below.leaves or 1, below.saved or 0,
        empty[0].ends if empty else _EMPTY,
    )
    return spark.createDataFrame([row] if total.n else [], schema), total.conv_id
