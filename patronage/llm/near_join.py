"""N-gram Jaccard join by T-occurrence search (DivideSkip), for link components.

A document's set holds the 64-bit values of its distinct 5-word shingles, cut to
their upper 48 bits. Documents with one set form a class; the join runs over
classes. Two sets with a Jaccard index of 0.8 share at least ``ceil(0.8 n)``
shingles, ``n`` the size of the larger. A class posts its lowest
``n - ceil(0.8 n) + 1 + slack(n)`` shingle values to inverted lists; then two
linked classes meet in at least ``1 + slack`` lists (``slack`` of 0.8 of the
query's size), which is the query's required overlap T.

DivideSkip. Lists longer than ``LONG_LIST`` are put aside. A query merges its
short lists with a heap and keeps the classes that occur ``T - L`` times or
more, ``L`` the number of its long lists; these candidates are then probed by
binary search in the sorted sets. A query with ``L >= T`` could miss partners
that share long lists only. Such classes ("laden") are joined among themselves
once more over the exact order of rising list length: their lists are now those
of their rarest shingles, and where one is still long, its members are near
copies of one another in the main. There each is probed against at most ``HUBS``
first members of its lists first; what then is of one component needs no more probing, and pairs
of different components in one list are all probed. No link is lost.

Null and empty texts have empty sets, are in no class and link with nothing: each
is its own component. Equal ``doc_id`` values are one document for the component
id, which is null if a class has no other than null ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.textbatch import LOWER, blocks, gather, hashes, lists, mix, words
from patronage.operators.linkage.components import connected_components
from patronage.session import remove, written, written_at

WORDS = 5
PERCENT = 80
LONG_LIST = 24
HUBS = 8
TILE = 4096
NEAREST = 4
SIGNATURE_BITS = 512
FILTER_BITS = 1 << 26

_ODD = np.uint64(0x9E3779B97F4A7C15)
_DROP = np.uint64(16)


def least_overlap(n):
    """``ceil(0.8 n)``: what a linked partner shares at least with a set of ``n``."""
    return -(-PERCENT * n // 100)


def slack(n):
    return n // 10 + 1


def shingle_sets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle values of all rows of a block, and how many each row has."""
    rows = len(starts) - 1
    data = LOWER[data]
    begin, end, owner = words(data, starts)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    value = hashes(data, begin, end)
    count = np.bincount(owner, minlength=rows)
    first = np.cumsum(count) - count
    # A row of fewer words than a shingle has one shingle of all of them.
    number = np.where(count >= WORDS, count - WORDS + 1, (count > 0).astype(np.int64))
    at = gather(first, number)
    row = np.repeat(np.arange(rows), number)
    short = count[row] < WORDS
    shingle = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        there = np.minimum(at + k, len(value) - 1)
        part = mix(value[there] + np.uint64(k))
        shingle = np.where(short & (k >= count[row]), shingle, mix(shingle * _ODD + part))
    shingle = mix(shingle + np.minimum(count[row], WORDS).astype(np.uint64)) >> _DROP
    order = np.lexsort((shingle, row))
    shingle, row = shingle[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (row[1:] != row[:-1])
    return shingle[new], np.bincount(row[new], minlength=rows)


def set_names(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 63-bit names of every set."""
    ends = np.cumsum(counts)
    names = []
    for salt in (1, 2):
        spread = mix(values * _ODD + np.uint64(salt)) * _ODD
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(spread), dtype=np.uint64)])
        names.append(mix(total[ends] - total[ends - counts] + counts.astype(np.uint64)) >> np.uint64(1))
    return names[0].astype(np.int64), names[1].astype(np.int64)


def sketches(docs: DataFrame, doc_id: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc, n, k1, k2, posted, keep`` of every row: set size, set names, and the shingles to post."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"), F.struct(F.lit(0), *keep).alias("keep"))
    schema = T.StructType(
        [
            T.StructField("doc", T.LongType()), T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()),
            T.StructField("k2", T.LongType()), T.StructField("posted", T.ArrayType(T.LongType())), rows.schema["keep"],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, starts in blocks(batch.column(1)):
                values, counts = shingle_sets(data, starts)
                k1, k2 = set_names(values, counts)
                posts = np.where(counts > 0, np.minimum(counts, counts - least_overlap(counts) + 1 + slack(counts)), 0)
                posted = values[gather(np.cumsum(counts) - counts, posts)].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(counts)), pa.array(counts, pa.int64()),
                        pa.array(k1), pa.array(k2), lists(posted, posts, pa.int64()),
                        batch.column(2).slice(row, len(counts)),
                    ],
                    names=["doc", "n", "k1", "k2", "posted", "keep"],
                )

    return rows.mapInArrow(run, schema)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows of sorted batches, one batch of Python values at a time."""
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def list_rows(posts: DataFrame) -> DataFrame:
    """Inverted lists from ``token, id, n``: for each member of a list, ``id, n, others``.

    ``others`` are the list's later members of a size that can be linked; null in
    a long list. Lists come sorted by id; a list is seen member by member, and
    no more than ``LONG_LIST`` of it are held. Lists of one member give nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, members, long, out = None, [], False, []

        def close() -> None:
            if not long and len(members) > 1:
                for i, (a, n) in enumerate(members):
                    near = [b for b, m in members[i + 1 :] if b != a and 100 * min(n, m) >= PERCENT * max(n, m)]
                    if near:
                        out.append((a, n, near))

        for t, i, n in _grouped(batches):
            if t != token:
                close()
                token, members, long = t, [], False
            if members and members[-1][0] == i:
                continue
            if long:
                members[0] = (i, n)
                out.append((i, n, None))
            else:
                members.append((i, n))
                if len(members) > LONG_LIST:
                    out.extend((a, m, None) for a, m in members)
                    long, members = True, [(i, n)]
            if len(out) > 20_000:
                yield _lists_batch(out)
                out = []
        close()
        if out:
            yield _lists_batch(out)

    def _lists_batch(out: list) -> pa.RecordBatch:
        a, n, near = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(near, pa.list_(pa.int64()))],
            names=["id", "n", "others"],
        )

    rows = posts.select("token", "id", "n").repartition("token").sortWithinPartitions("token", "id")
    return rows.mapInArrow(run, "id long, n long, others array<long>")


def merge_lists(rows: DataFrame) -> DataFrame:
    """T-occurrence search of every query over its short lists: ``a, b`` of candidates, ``a, null`` of laden queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, size, short, aside, out = None, 0, [], 0, []

        def close() -> None:
            if query is None:
                return
            required = 1 + slack(least_overlap(size))
            if aside >= required:
                out.append((query, None))
            least, seen, times = max(1, required - aside), None, 0
            for b in heapq.merge(*short):
                if b == seen:
                    times += 1
                else:
                    if times >= least:
                        out.append((query, seen))
                    seen, times = b, 1
            if times >= least:
                out.append((query, seen))

        for i, n, near in _grouped(batches):
            if i != query:
                close()
                query, size, short, aside = i, n, [], 0
            if near is None:
                aside += 1
            else:
                short.append(near)
            if len(out) > 20_000:
                yield _pairs_batch(out)
                out = []
        close()
        if out:
            yield _pairs_batch(out)

    rows = rows.repartition("id").sortWithinPartitions("id")
    return rows.mapInArrow(run, "a long, b long")


def _pairs_batch(out: list) -> pa.RecordBatch:
    a, b = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def signatures(items: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``SIGNATURE_BITS`` parities of each set: two sets differ in as many items at least as in bits."""
    slot = (mix(items * _ODD) >> np.uint64(64 - SIGNATURE_BITS.bit_length() + 1)).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    odd = np.bincount(row * SIGNATURE_BITS + slot, minlength=len(counts) * SIGNATURE_BITS) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(len(counts), SIGNATURE_BITS), axis=1)
    return pa.array([row.tobytes() for row in packed], pa.binary())


def sets_of(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``k1, k2, n, items, signature``: the sorted sets of the classes in ``ids``, one row per class.

    The sets are made from the texts again, for the classes that a candidate
    names. A bitmap of ``FILTER_BITS`` over the ids, of fixed size, keeps most other
    sets from leaving their task; the join decides.
    """
    bit = F.col("id").bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = (
        ids.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
    )
    packed = parts.toPandas()  # at most FILTER_BITS / 64 rows
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[packed["word"].to_numpy(np.int64)] = packed["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.tobytes())
    rows = docs.select(F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for _, data, starts in blocks(batch.column(0)):
                values, counts = shingle_sets(data, starts)
                k1, k2 = set_names(values, counts)
                slot = k1 & (FILTER_BITS - 1)
                kept = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                kept = kept[counts[kept] > 0]
                if not len(kept):
                    continue
                # Copies within a block give one row.
                _, once = np.unique(k1[kept], return_index=True)
                kept = kept[once]
                items = values[gather((np.cumsum(counts) - counts)[kept], counts[kept])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(k1[kept]), pa.array(k2[kept]), pa.array(counts[kept]),
                        lists(items.astype(np.int64), counts[kept], pa.int64()), signatures(items, counts[kept]),
                    ],
                    names=["k1", "k2", "n", "items", "signature"],
                )

    found = rows.mapInArrow(run, "k1 long, k2 long, n long, items array<long>, signature binary")
    wanted = ids.select(F.col("id").alias("k1")).distinct()
    return found.dropDuplicates(["k1", "k2"]).join(wanted, "k1", "left_semi")


def probed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of linked sets: shared items by binary search of one sorted set in the other."""
    left = sets.select(F.col("k1").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("k1").alias("b"), F.col("items").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            xs, ys = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                x, y = (v[i].values.to_numpy(zero_copy_only=False) for v in (xs, ys))
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < PERCENT * len(y):
                    continue
                place = np.searchsorted(y, x)
                shared = int((y[np.minimum(place, len(y) - 1)] == x).sum())
                if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a long, b long")


def laden_posts(sets: DataFrame, laden: DataFrame) -> DataFrame:
    """``token, id, n`` of the rarest shingles of laden classes, as many as make a prefix."""
    mine = sets.join(laden, sets.k1 == laden.id, "left_semi")
    items = written(mine.select(F.col("k1").alias("id"), "n", F.explode("items").alias("token")), "near-laden-items")
    often = written(items.groupBy("token").agg(F.count(F.lit(1)).alias("length")), "near-laden-lengths")
    ranked = items.join(often, "token").groupBy("id", "n").agg(
        F.array_sort(F.collect_list(F.struct("length", "token"))).alias("order")  # one set, of its own size
    )
    prefix = F.expr(f"slice(order, 1, CAST(n - ceil({PERCENT} * n / 100) + 1 AS INT))")
    return (
        ranked.select("id", "n", F.explode(prefix).alias("p"))
        .where("p.length > 1")
        .select(F.col("p.token").alias("token"), "id", "n")
    )


def _to_hubs(posts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a member and at most ``HUBS`` hubs: the first members of its lists.

    A list's hub comes from partial aggregates, so no list meets in one task, and a member names its
    hubs once over all its lists.
    """
    first = written(posts.groupBy("token").agg(F.min(F.struct("id", "n")).alias("hub")), "near-laden-hubs")
    near = PERCENT * F.greatest("n", "hub.n") <= 100 * F.least("n", "hub.n")
    named = posts.join(first, "token").where((F.col("hub.id") != F.col("id")) & near)
    chosen = named.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("hub.id")), 1, HUBS).alias("hubs"))
    pairs = chosen.select("id", F.explode("hubs").alias("hub"))
    return pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def _across(lists_: DataFrame, nearest: int | None) -> DataFrame:
    """Pairs of different components in one list, ``token, i, j, side, component, id, n, signature``.

    A list comes in pairs of tiles (``i, j``) of about ``TILE`` members, so that is
    what a task holds. Only pairs that size and signature allow are named; with
    ``nearest`` no more than that many of them for each member, the closest signatures first.
    """

    def pairs(rows: list, same: bool) -> list[tuple[int, int]]:
        left = [r for r in rows if same or not r[0]]
        right = left if same else [r for r in rows if r[0]]
        if not left or not right:
            return []
        comp, ids, n = (np.array([r[k] for r in right], np.int64) for k in (1, 2, 3))
        bits = np.frombuffer(b"".join(r[4] for r in right), np.uint64).reshape(len(right), -1)
        out = []
        for _, c, i, m, signature in left:
            apart = np.bitwise_count(bits ^ np.frombuffer(signature, np.uint64)).sum(axis=1, dtype=np.int64)
            # Linked sets differ in at most (100 - PERCENT) / (100 + PERCENT) of their sizes' sum.
            near = (100 + PERCENT) * apart <= (100 - PERCENT) * (n + m)
            near &= (comp != c) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
            at = np.flatnonzero(near)
            if nearest is not None and len(at) > nearest:
                at = at[np.argsort(apart[at], kind="stable")[:nearest]]
            out.extend((min(i, j), max(i, j)) for j in ids[at].tolist())
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rows, out = None, [], set()
        for token, i, j, *row in _grouped(batches):
            if place != (token, i, j):
                out.update(pairs(rows, place is not None and place[1] == place[2]))
                place, rows = (token, i, j), []
            rows.append(row)
            if len(out) > 100_000:
                yield _pairs_batch(sorted(out))
                out = set()
        out.update(pairs(rows, place is not None and place[1] == place[2]))
        if out:
            yield _pairs_batch(sorted(out))

    rows = lists_.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "side", "id")
    return rows.mapInArrow(run, "a long, b long").distinct()


def _open_lists(marked: DataFrame) -> DataFrame:
    """The lists with members of several components, cut to pairs of tiles."""
    mixed = written(
        marked.groupBy("token")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("size"))
        .where("x <> y")
        .select("token", F.ceil(F.col("size") / TILE).cast("int").alias("tiles")),
        "near-laden-mixed",
    )
    own = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    return (
        marked.join(mixed, "token")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).alias("side"), "component", "id", "n", "signature",
        )
    )


def class_components(docs: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``rec_id, component_id``: the component of every class that links with another."""
    posts = classes.select(F.col("k1").alias("id"), "n", F.explode("posted").alias("token"))
    merged = written(merge_lists(list_rows(posts)), "near-candidates")
    pairs = merged.where("b IS NOT NULL")
    laden = merged.where("b IS NULL").select(F.col("a").alias("id")).distinct()
    ids = written(
        pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(laden).distinct(), "near-candidate-ids"
    )
    sets = written(sets_of(docs, ids, doc_id, text), "near-candidate-sets")
    links = written(probed(pairs, sets), "near-links")
    if laden.isEmpty():
        return _parts(links)
    heavy = written(laden_posts(sets, laden), "near-laden-posts")
    starred = written(probed(_to_hubs(heavy), sets), "near-laden-links")
    links = links.union(starred)
    signed = written(heavy.join(sets.select(F.col("k1").alias("id"), "signature"), "id"), "near-laden-signed")
    parts, nearest, lists_ = _parts(links), NEAREST, None
    while True:
        if lists_ is None:
            marked = signed.join(parts.withColumnRenamed("rec_id", "id"), "id", "left").select(
                "token", F.coalesce("component_id", "id").alias("component"), "id", "n", "signature"
            )
            lists_ = _open_lists(written(marked, "near-laden-marked"))
        across = written(probed(_across(lists_, nearest), sets), "near-laden-across")
        if not across.isEmpty():
            # As long as closest pairs join components, the pairs that are left to probe become fewer.
            links = links.union(across)
            parts, lists_ = _parts(links), None
        if nearest is None:
            return parts
        if across.isEmpty():
            nearest = None


def _parts(links: DataFrame) -> DataFrame:
    return written(connected_components(links, "a", "b"), "near-components")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` and the columns ``keep`` of every row of ``docs``."""
    posted, path = written_at(sketches(docs, doc_id, text, keep), "near-posted")
    classes = written(
        posted.where("n > 0").groupBy("k1", "k2").agg(
            F.min("doc").alias("least"), F.min("n").alias("n"), F.first("posted").alias("posted")
        ),
        "near-classes",
    )
    rows = written(posted.drop("posted"), "near-sketches")
    remove(docs.sparkSession, path)
    labels = class_components(docs, classes, doc_id, text)
    linked = classes.select("k1", "k2", "least").join(labels.withColumnRenamed("rec_id", "k1"), "k1", "left")
    group = F.coalesce("component_id", "k1")
    named = written(linked.select("k1", "k2", group.alias("part"), "least"), "near-parts")
    least = written(named.groupBy("part").agg(F.min("least").alias("component")), "near-names")
    result = written(named.join(least, "part").select("k1", "k2", "component"), "near-result")
    own = F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component"))
    return rows.join(result, ["k1", "k2"], "left").select(
        F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), own.alias("component_id"),
        *[F.col(f"keep.{c}").alias(c) for c in keep],
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without linked documents other than their component's smallest ``doc_id``.

    Rows without an id or without words stay. Of rows that repeat an id, the one
    with the least hash of its text stays, and of equal rows one.
    """
    key = F.xxhash64(doc_id, text)
    named = components(docs.withColumn("key_nj", key), doc_id, text, keep=("key_nj",))
    found = written(named.where("n_shingles > 0 AND component_id IS NOT NULL"), "near-named")
    stays = written(
        found.where(F.col(doc_id) == F.col("component_id"))
        .groupBy("component_id")
        .agg(F.min("key_nj").alias("stays")),
        "near-stays",
    )
    goes = found.join(stays, "component_id").where("key_nj <> stays").select("key_nj").distinct()
    left = docs.withColumn("key_nj", key).join(written(goes, "near-goes"), "key_nj", "left_anti")
    again = written(found.groupBy("key_nj").count().where("count > 1").select("key_nj"), "near-repeated")
    if not again.isEmpty():  # equal rows, which nothing tells apart
        left = left.join(again, "key_nj", "left_anti").unionByName(
            left.join(again, "key_nj", "left_semi").dropDuplicates(["key_nj"])
        )
    return left.drop("key_nj")
