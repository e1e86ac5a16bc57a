"""The prefix trie of conversations, with totals over subtrees.

A node is a distinct sequence of first turns; its members are the conversations that begin
with it.  Every turn of a conversation is a row, and a row's node is known by sums of hashes of
(depth, role, text) over the turns up to it.  Sums can be formed block by block, so the
conversation that holds a third of all turns is no task of its own.

Totals over subtrees are found by time-forward processing: nodes are sorted by reverse level
order (the sort is Spark's and spills), and each node takes the messages of its children from
a priority queue, adds itself, and sends its totals forward to its parent, whose turn comes
later.  The queue keeps a bounded number of messages in memory and sorted runs of the others
in Spark's scratch folder of that task.

* A node with one member is the top or part of a branch without forks, whose totals are plain.
* Nodes with more than ``LIGHT`` members (or a 2^20th of all rows, if that is more) are heavy;
  so there are fewer than 2^20 of them, and the root, however large the input.
* A light node below a heavy one is a shard root.  Shards hold at most that many members, and
  are dealt over the tasks by their roots; each task runs the pass over its shards.
* The totals of the shard roots are summed by parent, and a last pass takes them through the
  heavy nodes, in one task.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.session import stage

FAMILY = 100  # conversations c and c - c % FAMILY share their first turns
MOST_SHARED = 6  # the number of them is a checksum of c, modulo this
BLOCK = 1024
LIGHT = 256
HEAVY_SHARE = 20  # bits
QUEUE_LIMIT = 200_000
RUN_ROWS = 4096
CHUNK_IDS = 8192

ROOT = hashlib.md5(b"0:0:0:0:0").hexdigest()
_SLOT_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these


def _earlier(by: str, order: str):
    return Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _ranked(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their ``rank`` (from 1) in their conversation, and the conversations' numbers of turns.

    Rows are ranged over the whole order, so that a long conversation is cut into many parts;
    a row's rank is its place in its part and the sizes of the parts before.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "salt"]
    ranged = stage(narrow, "trie-turns").repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "salt")
    placed = stage(ranged.withColumn("slot", F.monotonically_increasing_id()), "trie-ordered")
    part = F.shiftright("slot", _SLOT_BITS)
    parts = placed.groupBy("conv_id", part.alias("part")).agg(F.count("*").alias("n"), F.min("slot").alias("low"))
    parts = stage(
        parts.withColumn("before", F.coalesce(F.sum("n").over(_earlier("conv_id", "part")), F.lit(0))), "trie-parts"
    )
    ranked = (
        placed.withColumn("part", part)
        .join(parts, ["conv_id", "part"])
        .select("conv_id", (F.col("slot") - F.col("low") + F.col("before") + 1).alias("rank"), "digest", "chars")
    )
    return ranked, parts.groupBy("conv_id").agg(F.sum("n").alias("turns"))


def _rebuilt(ranked: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as rebuilt: turns (``conv_id``, ``depth``, ``length``, ``digest``, ``chars``), and one row each."""
    convs = sizes.select(
        "conv_id",
        "turns",
        (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    shared = F.least("h", F.coalesce("base_turns", F.lit(0)))
    length = F.col("shared") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))
    convs = convs.join(bases, "base", "left").withColumn("shared", shared).withColumn("length", length)
    convs = stage(convs.select("conv_id", "base", "h", "shared", "length"), "trie-conversations")
    own = (
        ranked.join(convs, "conv_id")
        .where("rank > h")
        .select("conv_id", (F.col("shared") + F.col("rank") - F.col("h")).alias("depth"), "length", "digest", "chars")
    )
    heads = ranked.where((F.col("conv_id") % FAMILY == 0) & (F.col("rank") < MOST_SHARED)).select(
        F.col("conv_id").alias("base"), F.col("rank").alias("depth"), "digest", "chars"
    )
    borrowed = (
        convs.join(heads, "base").where("depth <= h").select("conv_id", "depth", "length", "digest", "chars")
    )
    return stage(own.unionByName(borrowed), "trie-rebuilt"), convs


def _paths(turns: DataFrame) -> DataFrame:
    """``turns`` with the ``key`` of their node and of its parent."""
    low = lambda c: c.bitwiseAND(0xFFFFFFFF)
    lanes = []
    for seed in (1, 2):
        both = F.xxhash64(F.lit(seed), "depth", "digest")
        lanes += [F.shiftrightunsigned(both, 32), low(both)]
    names = [f"lane{i}" for i in range(len(lanes))]
    hashed = turns.select(
        "conv_id",
        "depth",
        "length",
        "chars",
        F.floor((F.col("depth") - 1) / BLOCK).alias("block"),
        *[lane.alias(n) for n, lane in zip(names, lanes, strict=True)],
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    blocks = hashed.where(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in names])
    before = blocks.select(
        "conv_id", "block", *[F.sum(n).over(_earlier("conv_id", "block")).alias(f"{n}_before") for n in names]
    ).where("block > 0")
    summed = hashed.select("*", *[F.sum(n).over(inside).alias(f"{n}_in") for n in names]).join(
        before, ["conv_id", "block"], "left"
    )
    sums = [F.col(f"{n}_in") + F.coalesce(f"{n}_before", F.lit(0)) for n in names]

    def key(depth: Column, values: list[Column]) -> Column:
        return F.md5(F.concat_ws(":", depth.cast("string"), *[v.cast("string") for v in values]))

    above = [s - F.col(n) for s, n in zip(sums, names, strict=True)]
    return stage(
        summed.select(
            "conv_id",
            "depth",
            "length",
            "chars",
            key(F.col("depth"), sums).alias("key"),
            key(F.col("depth") - 1, above).alias("parent_key"),
        ),
        "trie-paths",
    )


def _nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    counts = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("length").alias("longest")]
    below = paths.groupBy("key", "parent_key", "depth", "chars").agg(*counts)
    root = (
        convs.agg(*counts)
        .where("n_convs > 0")
        .select(
            F.lit(ROOT).alias("key"),
            F.lit(None).cast("string").alias("parent_key"),
            F.lit(0).cast("long").alias("depth"),
            F.lit(0).cast("long").alias("chars"),
            "conv_id",
            "n_convs",
            "longest",
        )
    )
    return stage(below.unionByName(root), "trie-nodes")


class SpillingQueue:
    """Messages by place, smallest first; no more than ``limit`` of them, and a few of each run, in memory."""

    def __init__(self, limit: int = QUEUE_LIMIT, folder: str | None = None):
        self.limit = limit
        self.folder = folder or os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # next message of each run, and the run
        self.runs: list[Iterator[tuple]] = []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile(dir=self.folder)
        run = sorted(self.heap)
        for at in range(0, len(run), RUN_ROWS):
            pickle.dump(run[at : at + RUN_ROWS], file)
        file.seek(0)
        self.heap = []
        self.runs.append(self._read(file))
        self._next(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _next(self, run: int) -> None:
        message = next(self.runs[run], None)
        if message is not None:
            heapq.heappush(self.heads, (message, run))

    def take(self, place: tuple) -> Iterator[tuple]:
        """Remove and return the messages for ``place``, which are the smallest left."""
        size = len(place)
        while self.heap and self.heap[0][:size] == place:
            yield heapq.heappop(self.heap)[size:]
        while self.heads and self.heads[0][0][:size] == place:
            message, run = heapq.heappop(self.heads)
            self._next(run)
            yield message[size:]

    def __len__(self) -> int:
        return len(self.heap) + len(self.heads)


def totals(nodes: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple[int, int, int]]:
    """Children, leaves and saved tokens of each node, in reverse level order of (depth, key).

    A node is (depth, key, parent key or None if its parent is not among the nodes, children,
    leaves, saved tokens), where the last three are what it holds by itself.
    """
    for depth, key, parent, children, leaves, saved in nodes:
        for more_children, more_leaves, more_saved in queue.take((-depth, key)):
            children += more_children
            leaves += more_leaves
            saved += more_saved
        leaves = leaves or 1
        if parent is not None:
            queue.push((1 - depth, parent, 1, leaves, saved))
        yield children, leaves, saved


_GIVEN = ["key", "parent_key", "depth", "conv_id", "n_convs"]
_PASSED = "key string, parent_key string, depth long, conv_id long, n_convs long, top boolean, n_children long, n_leaves long, saved_tokens long"


def _passed(nodes: DataFrame, limit: int) -> DataFrame:
    """Time-forward pass over each partition of ``nodes``, which hold whole shards."""
    names = [*_GIVEN, "top", "n_children", "n_leaves", "saved_tokens"]

    def run(batches):
        queue = SpillingQueue(limit)
        for batch in batches:
            column = {n: batch.column(i).to_pylist() for i, n in enumerate(names)}
            parents = [None if top else p for p, top in zip(column["parent_key"], column["top"], strict=True)]
            rows = zip(
                column["depth"], column["key"], parents, *[column[n] for n in names[-3:]], strict=True
            )
            found = list(zip(*totals(rows, queue), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(_GIVEN) + 1], *[pa.array(f, pa.int64()) for f in found]], names
            )

    order = [F.desc("depth"), "key"]
    return nodes.sortWithinPartitions(*order).select(*names).mapInArrow(run, _PASSED)


def _digests(ended: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256`` of the ids that end at each node, however many.

    Tasks over ranges of (node, id) write the ids out in chunks, and one pass by node hashes the
    chunks in their order.
    """

    def chunks(batches):
        key, held = None, []

        def flush():
            return [key, held[0], ",".join(map(str, held))]

        for batch in batches:
            found = []
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (k != key or len(held) == CHUNK_IDS):
                    found.append(flush())
                    held = []
                key = k
                held.append(c)
            if found:
                yield table(found)
        if held:
            yield table([flush()])

    def table(found):
        columns = zip(*found, strict=True)
        types = (pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "first", "ids"])

    def hashes(batches):
        key, digest = None, None
        names = ["key", "ends_sha256"]

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found, strict=True)], names)

        for batch in batches:
            found = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        found.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(ids.encode())
            if found:
                yield rows(found)
        if key is not None:
            yield rows([(key, digest.hexdigest())])

    chunked = (
        ended.repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(chunks, "key string, first long, ids string")
    )
    return (
        chunked.repartition("key")
        .sortWithinPartitions("key", "first")
        .select("key", "ids")
        .mapInArrow(hashes, "key string, ends_sha256 string")
    )


def trie(conversations: DataFrame, light: int = LIGHT, queue_limit: int = QUEUE_LIMIT) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    Turns are ordered by ``turn``, null first; turns that tie, by the hash of role and text.
    Repeated rows are turns of their own.  Null roles and texts are empty.  Rows without
    ``conv_id`` belong to no conversation and are left out.  Remainders have the sign of the id.
    A conversation c is rebuilt from the first h turns of conversation c - c % 100 and its own
    turns after its first h, where h is the checksum of its decimal id modulo 6; it may be left
    without turns, and then is a member of the root alone.  An empty table has no node.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes of its subtree), ``saved_tokens`` (over its
    subtree, code points of each node's last text for every member but one) and
    ``ends_sha256`` (of the comma-joined ids of the members that end here).
    """
    ranked, sizes = _ranked(conversations)
    turns, convs = _rebuilt(ranked, sizes)
    paths = _paths(turns)
    nodes = _nodes(paths, convs)
    most = max(light, paths.count() >> HEAVY_SHARE)

    # Branches of one member: only their tops have a parent with more of them.
    lone = nodes.where("n_convs = 1 and depth > 0")
    tops = lone.groupBy("conv_id").agg(F.min("depth").alias("depth"))
    direct = lone.join(tops, ["conv_id", "depth"]).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("lone"))
    shared = stage(
        nodes.where("n_convs > 1 or depth = 0")
        .join(direct, "key", "left")
        .select(
            *_GIVEN,
            (F.col("n_convs") > most) | (F.col("depth") == 0),
            F.coalesce("lone", F.lit(0)).alias("lone"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        )
        .toDF(*_GIVEN, "heavy", "lone", "saved_tokens"),
        "trie-shared",
    )
    heavy, inner = shared.where("heavy"), shared.where("not heavy")

    entries = inner.join(heavy.select(F.col("key").alias("parent_key")), "parent_key", "left_semi").select("key")
    shard_of = paths.join(entries, "key").select("conv_id", F.col("key").alias("shard"))
    sharded = inner.join(shard_of, "conv_id").select(
        "*", (F.col("key") == F.col("shard")).alias("top"), F.col("lone").alias("n_children"), F.col("lone").alias("n_leaves")
    )
    inner_done = stage(_passed(sharded.repartition("shard"), queue_limit), "trie-shards")

    raised = (
        inner_done.where("top")
        .groupBy(F.col("parent_key").alias("key"))
        .agg(F.count("*").alias("up_children"), F.sum("n_leaves").alias("up_leaves"), F.sum("saved_tokens").alias("up_saved"))
    )
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    across = heavy.join(raised, "key", "left").select(
        *_GIVEN,
        F.col("parent_key").isNull().alias("top"),
        plus("lone", "up_children").alias("n_children"),
        plus("lone", "up_leaves").alias("n_leaves"),
        plus("saved_tokens", "up_saved").alias("saved_tokens"),
    )
    heavy_done = _passed(across.repartition(1), queue_limit)  # fewer than 2^20 nodes and the root

    empty = F.sha2(F.lit(""), 256)
    alone = lone.select(
        *_GIVEN,
        F.lit(True).alias("top"),
        (F.col("depth") < F.col("longest")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == F.col("longest"), F.sha2(F.col("conv_id").cast("string"), 256)).alias("own_end"),
    )
    ended = (
        paths.where("depth = length")
        .select("key", "conv_id")
        .union(convs.where("length = 0").select(F.lit(ROOT), "conv_id"))
        .join(shared.select("key"), "key", "left_semi")
    )
    no_end = F.lit(None).cast("string").alias("own_end")
    everything = alone.unionByName(inner_done.select("*", no_end)).unionByName(heavy_done.select("*", no_end))
    above = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    parent = F.when(F.col("parent_key").isNotNull(), F.coalesce("above", "conv_id"))
    return (
        everything.join(above, "parent_key", "left")
        .join(stage(_digests(ended), "trie-ends"), "key", "left")
        .select(
            "conv_id",
            "depth",
            parent.alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("own_end", "ends_sha256", empty).alias("ends_sha256"),
        )
    )
