"""A prefix trie of conversations, built as ternary search trees over ranges of turn sequences.

Turns ``(role, text)`` are numbered by a dictionary in their own order, so that
sequences of numbers sort as sequences of turns do. Conversations of one
sequence are one weighted row. Rows are sorted into range shards; a shard is cut
wherever its size says, also inside a hot prefix. Each shard inserts its
sequences into a ternary search tree, medians first, which keeps every level's
search tree balanced, and an iterative traversal adds up members, leaves and
savings from the leaves to the top.

A prefix that neighbouring shards share is a boundary node: the first sequence of
a shard shares as many turns with the last one of the shard before it as both
begin with. These nodes come out as parts; the parts of a node are added, then
each node's sum goes to its ancestors. Their number follows the number of
shards, not of conversations.

Conversations are ordered by ``turn`` (null first), turns of equal number by role,
then text; null role and text are empty. Rows without a ``conv_id`` belong to no
conversation and are left out. Rows that repeat are turns of their own. Roles
and texts meet as SHA-256 of both. A conversation's numbers (16 bytes a turn) are
held whole, its texts are not. The digest of a node's ids is sequential by its
nature: sorted ids are joined in parts, and one task passes over the parts of a node.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.session import written

SHARD_TURNS = 100_000
PART_IDS = 5_000
_EMPTY = hashlib.sha256(b"").hexdigest()

_NODES = (
    "shared boolean, prefix array<long>, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, code long, words long, ends_sha256 string"
)


def coded_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``conv, turns``: per conversation its turns in order as ``(code, words)``; and the dictionary."""
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    key = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    keyed = rows.withColumn("key", F.unhex(key))
    distinct = keyed.groupBy("key").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    dictionary = written(
        distinct.repartitionByRange("role", "text")
        .sortWithinPartitions("role", "text")
        .select(
            "key", F.monotonically_increasing_id().alias("code"), "role", "text",
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        ),
        "trie-dictionary",
    )
    coded = (
        keyed.select("conv", "turn", "key")
        .join(dictionary.select("key", "code", "words"), "key")
        .groupBy("conv")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("set"), "turn", "code", "words"))).alias("t"))
        .select("conv", F.transform("t", lambda x: F.struct(x["code"].alias("code"), x["words"].alias("words"))).alias("turns"))
    )
    return coded, dictionary


def rebuilt(coded: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first ``crc32(conv) % most`` turns of conversation ``conv - conv % every``."""
    donors = coded.where(F.col("conv") % every == 0).select(F.col("conv").alias("donor"), F.slice("turns", 1, most - 1).alias("given"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    rows = coded.withColumn("h", h).withColumn("donor", F.col("conv") - F.col("conv") % every).join(donors, "donor", "left")
    given = F.coalesce(F.slice("given", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("conv", F.concat(given, own).alias("turns"))


def ends(named: DataFrame) -> DataFrame:
    """``name, conv, n, digest``: per sequence its least conversation, their number, and the digest of their sorted ids."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, out = None, [], []
        for batch in batches:
            for n, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != name or len(ids) == PART_IDS:
                    if ids:
                        out.append((name, ids[0], len(ids), ",".join(map(str, ids))))
                    name, ids = n, []
                ids.append(i)
            if out:
                yield parts_batch(out)
                out = []
        if ids:
            yield parts_batch([(name, ids[0], len(ids), ",".join(map(str, ids)))])

    def parts_batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["name", "conv", "n", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, n, running, out = None, None, 0, None, []
        for batch in batches:
            for key, conv, count, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != name:
                    if name is not None:
                        out.append((name, first, n, running.hexdigest()))
                    name, first, n, running = key, conv, 0, hashlib.sha256()
                else:
                    running.update(b",")
                n += count
                running.update(ids.encode())
            if out:
                yield digests_batch(out)
                out = []
        if name is not None:
            yield digests_batch([(name, first, n, running.hexdigest())])

    def digests_batch(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["name", "conv", "n", "digest"])

    rows = named.select("name", "conv").repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    parts = rows.mapInArrow(part, "name string, conv long, n long, ids string")
    ordered = parts.repartition("name").sortWithinPartitions("name", "conv")
    return ordered.mapInArrow(digest, "name string, conv long, n long, digest string")


def _common(a: str, b: str) -> Column:
    """How many turns two different sequences share at their beginning."""
    differs = f"array_position(zip_with({a}, {b}, (x, y) -> x <=> y), false)"
    return F.expr(f"CAST({differs} - 1 AS INT)")


def shards_of(sequences: DataFrame) -> DataFrame:
    """The sequences in range shards, ``shard, left, right`` added.

    ``left`` and ``right`` are the numbers of turns shared with the shards before and
    after, -1 where there is none. The shards' bounds are one row per partition.
    """
    size = sequences.agg(F.sum(F.size("codes") + 1)).first()[0] or 0
    parts = max(1, -(-size // SHARD_TURNS))
    ranged = written(
        sequences.repartitionByRange(parts, "codes").withColumn("shard", F.spark_partition_id()), "trie-ranges"
    )
    bounds = ranged.groupBy("shard").agg(F.min("codes").alias("first"), F.max("codes").alias("last"))
    after = F.expr("lead(first) OVER (ORDER BY shard)")  # one row per shard
    joined = bounds.withColumn("next", after)
    right = joined.select("shard", F.coalesce(_common("last", "next"), F.lit(-1)).alias("right"))
    edges = written(
        right.withColumn("left", F.expr("coalesce(lag(right) OVER (ORDER BY shard), -1)")), "trie-edges"
    )
    return ranged.join(F.broadcast(edges), "shard")  # a few bytes per shard


class ShardTrie:
    """A ternary search tree over the sorted distinct ``(codes, words, …)`` of one shard.

    ``low`` and ``high`` lead to other turns at the same place, ``down`` to the next
    turn; 0 is none. Node 0 stands for the empty prefix.
    """

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        self.code, self.words, self.low, self.high, self.down = [None], [0], [0], [0], [0]
        self.end: list[int | None] = [None]  # the row that ends with this turn
        pending = [(0, len(rows))]
        while pending:
            first, after = pending.pop()
            if first < after:
                middle = (first + after) // 2
                self._insert(middle)
                pending += [(middle + 1, after), (first, middle)]

    def _insert(self, number: int) -> None:
        above = 0
        for code, words in zip(*self.rows[number][:2]):
            links, at = self.down, above
            here = links[at]
            while here and self.code[here] != code:
                links, at = (self.low if code < self.code[here] else self.high), here
                here = links[at]
            if not here:
                here = links[at] = len(self.code)
                self.code.append(code)
                self.words.append(words)
                self.end.append(None)
                for column in (self.low, self.high, self.down):
                    column.append(0)
            above = here
        self.end[above] = number

    def visits(self) -> Iterator[tuple[int, int, bool]]:
        """``(node, depth, closing)`` in the order of sequences, each node before and after what is below it."""
        yield 0, 0, False
        pending = [(self.down[0], 1, 0)]
        while pending:
            node, depth, step = pending.pop()
            if not node:
                continue
            if step == 0:
                pending += [(node, depth, 1), (self.low[node], depth, 0)]
            elif step == 1:
                yield node, depth, False
                pending += [(node, depth, 2), (self.down[node], depth + 1, 0)]
            else:
                yield node, depth, True
                pending.append((self.high[node], depth, 0))
        yield 0, 0, True


class OpenNode:
    """A node of the path that the traversal is on, with what is known of its subtree."""

    __slots__ = ("code", "words", "n", "least", "digest", "children", "leaves", "saved", "on_first", "on_last", "shared", "below")

    def __init__(self, trie: ShardTrie, node: int, on_first: bool, on_last: bool, shared: bool):
        end = trie.rows[trie.end[node]] if trie.end[node] is not None else (None, None, None, 0, None)
        self.code, self.words = trie.code[node], trie.words[node]
        self.least, self.n, self.digest = end[2:]
        self.children = self.leaves = self.saved = 0
        self.on_first, self.on_last, self.shared = on_first, on_last, shared
        self.below: list[tuple] = []  # closed children, until the least id of this node is known


def shard_nodes(rows: list[tuple], left: int, right: int) -> Iterator[tuple]:
    """The nodes of a shard, as rows of ``_NODES``, from its sorted ``(codes, words, conv, n, digest)``.

    A shared node comes as its part: members, and the children, leaves and savings
    of those below it that no other shard has. Children of shared nodes carry
    the prefix of their parent.
    """
    trie = ShardTrie(rows)
    first, last = rows[0][0], rows[-1][0]
    path: list[OpenNode] = []
    for node, depth, closing in trie.visits():
        if not closing:
            code, above = trie.code[node], path[-1] if path else None
            on_first = above is None or (above.on_first and depth <= len(first) and first[depth - 1] == code)
            on_last = above is None or (above.on_last and depth <= len(last) and last[depth - 1] == code)
            shared = (on_first and depth <= left) or (on_last and depth <= right)
            path.append(OpenNode(trie, node, on_first, on_last, shared))
            continue
        done = path.pop()
        if path:
            above = path[-1]
            above.n += done.n
            above.least = done.least if above.least is None else min(above.least, done.least)
        if done.shared:
            prefix = [p.code for p in path[1:]] + ([done.code] if depth else [])
            yield (
                True, prefix, done.least, depth, None, done.n, done.children, done.leaves, done.saved, done.code,
                done.words, done.digest,
            )
            for least, *rest in done.below:
                yield False, prefix, least, depth + 1, None, *rest
            continue
        for least, *rest in done.below:
            yield False, None, least, depth + 1, done.least, *rest
        leaves, saved = done.leaves or 1, done.saved + (done.n - 1) * done.words
        row = (done.least, done.n, done.children, leaves, saved, done.code, done.words, done.digest)
        if path:
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
            above.below.append(row)
        else:
            yield False, None, row[0], 0, None, *row[1:]


def _in_shards(sharded: DataFrame) -> DataFrame:
    def batch_of(out: list) -> pa.RecordBatch:
        kinds = [pa.bool_(), pa.list_(pa.int64()), *[pa.int64()] * 9, pa.string()]
        names = [c.split()[0] for c in _NODES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows = None, []

        def close() -> Iterator[pa.RecordBatch]:
            out = []
            for row in shard_nodes(rows, *place[1:]) if rows else ():
                out.append(row)
                if len(out) == 20_000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

        for batch in batches:
            for shard, left, right, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if place != (shard, left, right):
                    yield from close()
                    place, rows = (shard, left, right), []
                rows.append(row)
        yield from close()

    rows = sharded.select("shard", "left", "right", "codes", "words", "conv", "n", "digest")
    return rows.repartition("shard").sortWithinPartitions("shard", "codes").mapInArrow(run, _NODES)


def _merged(nodes: DataFrame) -> DataFrame:
    """Closed nodes with the ids of shared parents, and shared nodes made whole."""
    above = F.when(F.col("depth") > 0, F.slice("prefix", F.lit(1), F.greatest(F.col("depth") - 1, F.lit(0)).cast("int")))
    parts = (
        nodes.where("shared")
        .groupBy("prefix", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"), F.max("code").alias("code"), F.max("ends_sha256").alias("ends_sha256"),
            F.max("words").alias("words"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        )
        .withColumn("above", above)
    )
    parts = written(parts, "trie-shared")
    inner = parts.groupBy("above").agg(F.count(F.lit(1)).alias("inner")).where("above IS NOT NULL").withColumnRenamed("above", "prefix")
    whole = parts.join(inner, "prefix", "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0)))
    own = whole.select(
        "prefix", "depth", (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("l"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("s"),
    )
    sums = (
        own.select(F.explode(F.sequence(F.lit(0), F.col("depth").cast("int"))).alias("d"), "prefix", "l", "s")
        .groupBy(F.expr("slice(prefix, 1, d)").alias("prefix"))
        .agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    )
    ids = parts.select(F.col("prefix").alias("above"), F.col("conv_id").alias("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "code", "ends_sha256"]
    shared = whole.drop("n_leaves", "saved_tokens").join(sums, "prefix").join(ids, "above", "left").withColumn("parent_conv_id", F.col("parent"))
    under = nodes.where("NOT shared AND prefix IS NOT NULL").drop("parent_conv_id").withColumnRenamed("prefix", "above")
    under = under.join(ids, "above").withColumnRenamed("parent", "parent_conv_id")
    closed = nodes.where("NOT shared AND prefix IS NULL")
    both = closed.select(*columns).unionByName(under.select(*columns)).unionByName(shared.select(*columns))
    return both.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))


@dataclass(frozen=True)
class TurnTrie:
    """``nodes``: a row per distinct prefix, ``code`` naming its last turn; ``dictionary``: ``code, role, text, words``."""

    nodes: DataFrame
    dictionary: DataFrame


def trie(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> TurnTrie:
    """The prefix trie of the rebuilt conversations. Writes and runs jobs when called."""
    coded, dictionary = coded_turns(turns, conv_id, turn, role, text)
    name = F.sha2(F.array_join(F.transform("turns", lambda x: x["code"].cast("string")), ",").cast("binary"), 256)
    named = written(rebuilt(written(coded, "trie-coded")).withColumn("name", name), "trie-named")
    last = written(ends(named), "trie-ends")
    sequences = named.select("conv", F.col("turns.code").alias("codes"), F.col("turns.words").alias("words")).join(
        last.select("conv", "n", "digest"), "conv"
    )
    nodes = written(_in_shards(shards_of(sequences)), "trie-nodes")
    return TurnTrie(_merged(nodes), dictionary)
