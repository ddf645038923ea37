"""Candidate pairs, their features, scores and labels.

A block (equal first letter of the name, or another configured field) may hold a third of all records, so
comparing everybody within it is out of the question at scale. What can reach a
wanted score is narrower, and follows from the weights:

* above ``best_without_email`` the emails must agree;
* at ``best_without_email``, either the emails agree or names and phones are
  both identical (the similarity is 1 only for identical, non-empty text);
* below it anything in the block could qualify: such pairs are counted, never listed.

Each case is a set of equality keys, so candidates come from equi-joins. How
many other pairs a block has is known from its size alone (:func:`pair_counts`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.order import numbered
from patronage.functions.text import (
    FEW,
    SHORT,
    Compared,
    Matches,
    Picked,
    coded,
    jaro_winkler,
    out_of_order,
    outcomes,
    similarity_ceiling,
)
from patronage.operators.linkage.normalise import block_columns, forms_of, members, profiles
from patronage.operators.linkage.rules import MatchRules
from patronage.session import written

# A key group is cut into tiles of about this many rows before it meets itself.
TILE_ROWS = 4096
MOST_TASKS = 50_000

FEATURES = ["name_similarity", "email_match", "phone_similarity"]


def tiled_self_join(
    df: DataFrame, keys: list[str], id_col: str, condition: Column | None = None, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Every unordered pair of rows that agree on ``keys`` and pass ``condition``, once.

    Columns other than the keys come out as ``l_…`` and ``r_…``; ``l_`` has the
    larger id. Groups of one row drop out before the join. A group of n rows is
    cut into t = ceil(n / tile_rows) tiles by a hash of the id; tile a meets
    tile b in cell (min, max), which is part of the join key, so the work of a
    large group spreads over t (t + 1) / 2 cells of bounded size.
    ``condition`` is part of the join: pairs failing it are never emitted.
    """
    # A join with an aggregate is not split at run time when a key is hot; with a table it is.
    sizes = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "sizes")
    tiled = df.join(sizes, keys).select(
        *df.columns, F.ceil(F.col("_n") / F.lit(float(tile_rows))).cast("int").alias("_t")
    )
    tiled = tiled.withColumn("_a", F.pmod(F.xxhash64(id_col), F.col("_t")).cast("int"))
    rest = [c for c in df.columns if c not in keys]

    def side(prefix: str, cells: Column, row: Column, column: Column) -> DataFrame:
        return tiled.select(
            *keys, *[F.col(c).alias(prefix + c) for c in rest], "_a", "_t", F.explode(cells).alias("_other")
        ).select(
            *keys, row.alias("_i"), column.alias("_j"), *[prefix + c for c in rest]
        )

    a, other = F.col("_a"), F.col("_other")
    lower = side("x_", F.sequence(a, F.col("_t") - 1), a, other)
    upper = side("y_", F.sequence(F.lit(0), a), other, a)
    met = (F.col("_i") < F.col("_j")) | (F.col(f"x_{id_col}") > F.col(f"y_{id_col}"))
    if condition is not None:
        met = met & condition
    # The work of a cell grows with the square of its rows, so the cells are dealt out by
    # number: merged by size in bytes, as is done at run time otherwise, few tasks would get all.
    # Each further cell of a large group is a task's worth of work.
    cell = [*keys, "_i", "_j"]
    tiles = F.ceil(F.col("_n") / F.lit(float(tile_rows)))
    more = sizes.where(F.col("_n") > tile_rows).agg(F.sum(tiles * (tiles + 1) / 2 - 1).alias("n")).first()["n"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(parts + int(more or 0), MOST_TASKS)
    both = lower.repartition(parts, *cell).join(upper.repartition(parts, *cell), cell).where(met)
    x_first = F.col(f"x_{id_col}") > F.col(f"y_{id_col}")
    return both.select(
        *keys,
        *[F.when(x_first, F.col(f"x_{c}")).otherwise(F.col(f"y_{c}")).alias(f"l_{c}") for c in rest],
        *[F.when(x_first, F.col(f"y_{c}")).otherwise(F.col(f"x_{c}")).alias(f"r_{c}") for c in rest],
    )


def _within_reach(rules: MatchRules, min_score: float, same_name: bool, email: float | None) -> Column:
    """Whether a pair could still score ``min_score``, judged by text lengths only."""
    name = F.lit(1.0) if same_name else similarity_ceiling(F.col("x_name_lower"), F.col("y_name_lower"))
    phone = similarity_ceiling(F.col("x_phone_normalized"), F.col("y_phone_normalized"))
    return rules.score(name, F.lit(1.0 if email is None else email), phone) >= min_score - 1e-9


def profile_pairs(
    distinct: DataFrame, rules: MatchRules = MatchRules(), floor: float | None = None
) -> DataFrame:
    """Scored pairs of different profiles scoring ``floor`` or more.

    ``(left_id, right_id, features, score, weight)`` with ``left_id`` the larger
    profile id and ``weight`` the number of record pairs it stands for. The
    floor defaults to the uncertain threshold; one below ``best_without_email``
    would list whole blocks and is an error.
    """
    floor = rules.uncertain_threshold if floor is None else floor
    if floor < rules.best_without_email - 1e-9:
        raise ValueError(f"pairs below {rules.best_without_email} are counted, not listed")
    mailed = distinct if rules.blank_emails_agree else distinct.where("email_normalized <> ''")
    # A row without a name or phone can't score above what is left.
    name, phone = ((F.col(c) != "").cast("double") for c in ("name_lower", "phone_normalized"))
    mailed = mailed.where(rules.score(name, F.lit(1.0), phone) >= floor - 1e-9)
    reach = _within_reach(rules, floor, False, 1.0)
    parts = [
        tiled_self_join(
            mailed.where(F.col(block).isNotNull()), [block, "email_normalized"], "profile_id", reach & owned
        ).select(
            F.col("l_profile_id").alias("left_id"),
            F.col("r_profile_id").alias("right_id"),
            jaro_winkler("l_name_lower", "r_name_lower").alias("name_similarity"),
            F.lit(1.0).alias("email_match"),
            jaro_winkler("l_phone_normalized", "r_phone_normalized").alias("phone_similarity"),
            (F.col("l_copies") * F.col("r_copies")).alias("weight"),
        )
        for block, owned in _owners(rules)
    ]
    if floor <= rules.best_without_email:
        # Different profiles of one block letter, name and phone have different emails; with more blocks they need not.
        several = len(rules.blocking) > 1
        named = distinct.where("phone_normalized <> ''")
        named = named if several else named.drop("email_normalized")
        for block, owned in _owners(rules):
            if several:
                owned = owned & ~rules.emails_agree(F.col("x_email_normalized"), F.col("y_email_normalized"))
            keys = list(dict.fromkeys([block, "name_lower", "phone_normalized"]))
            alike = tiled_self_join(
                named.where(F.col(block).isNotNull() & (F.col("name_lower") != "")), keys, "profile_id", owned
            )
            parts.append(
                alike.select(
                    F.col("l_profile_id").alias("left_id"),
                    F.col("r_profile_id").alias("right_id"),
                    F.lit(1.0).alias("name_similarity"),
                    F.lit(0.0).alias("email_match"),
                    F.lit(1.0).alias("phone_similarity"),
                    (F.col("l_copies") * F.col("r_copies")).alias("weight"),
                )
            )
    return _scored(reduce(DataFrame.unionByName, parts), rules).where(F.col("score") >= floor)


def _owners(rules: MatchRules) -> list[tuple[str, Column]]:
    """The blocks, and which pairs each one makes: those that agree in none of the blocks before it.

    So a pair that shares several blocks is made once, under the first, without a distinct.
    """
    columns = block_columns(rules.blocking)
    owned, before = [], F.lit(True)
    for column in columns:
        owned.append((column, before))
        before = before & ~F.coalesce(F.col(f"x_{column}") == F.col(f"y_{column}"), F.lit(False))
    return owned


def copy_scores(distinct: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """For each profile with copies, the features and score of any two of them."""
    blank_email = F.lit(rules.blank_emails_agree) | (F.col("email_normalized") != "")
    rows = distinct.where("copies > 1").select(
        "profile_id",
        "copies",
        (F.col("name_lower") != "").cast("double").alias("name_similarity"),
        blank_email.cast("double").alias("email_match"),
        (F.col("phone_normalized") != "").cast("double").alias("phone_similarity"),
        F.expr("copies * (copies - 1) DIV 2").alias("weight"),
    )
    return _scored(rows, rules)


def _scored(pairs: DataFrame, rules: MatchRules) -> DataFrame:
    return pairs.withColumn("score", rules.score(*[F.col(c) for c in FEATURES]))


def record_pairs(
    records: DataFrame, rules: MatchRules = MatchRules(), floor: float | None = None
) -> DataFrame:
    """Scored and labelled record pairs at or above ``floor``, ``left_id`` the larger ``rec_id``.

    The listing form of :func:`profile_pairs` and :func:`copy_scores`; its size
    is the number of record pairs that score ``floor`` or more.
    """
    floor = rules.uncertain_threshold if floor is None else floor
    forms = written(forms_of(records, rules.blocking), "forms")
    distinct = written(profiles(forms), "profiles")
    owner = written(members(forms, distinct), "members")
    left = owner.select(F.col("profile_id").alias("left_id"), F.col("rec_id").alias("a"))
    right = owner.select(F.col("profile_id").alias("right_id"), F.col("rec_id").alias("b"))
    apart = (
        profile_pairs(distinct, rules, floor)
        .join(left, "left_id")
        .join(right, "right_id")
        .select(
            F.greatest("a", "b").alias("left_id"),
            F.least("a", "b").alias("right_id"),
            *FEATURES,
            "score",
        )
    )
    alike = copy_scores(distinct, rules).where(F.col("score") >= floor).drop("copies", "weight")
    copies = tiled_self_join(owner.join(alike, "profile_id"), ["profile_id"], "rec_id").select(
        F.col("l_rec_id").alias("left_id"),
        F.col("r_rec_id").alias("right_id"),
        *[F.col(f"l_{c}").alias(c) for c in (*FEATURES, "score")],
    )
    return apart.unionByName(copies).withColumn("label", rules.label(F.col("score")))


def block_sizes(records: DataFrame) -> DataFrame:
    """Records and pairs per block; the pairs are counted, not formed."""
    return (
        forms_of(records)
        .groupBy("first_letter")
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumn("candidate_pairs", F.expr("records * (records - 1) DIV 2"))
    )


def _weighed(distinct: DataFrame, rules: MatchRules) -> DataFrame:
    """``score, weight`` of the pairs from the uncertain threshold on."""
    return (
        profile_pairs(distinct, rules)
        .select("score", "weight")
        .unionByName(copy_scores(distinct, rules).select("score", "weight"))
        .where(F.col("score") >= rules.uncertain_threshold)
    )


def _all_pairs(distinct: DataFrame, rules: MatchRules) -> DataFrame:
    """One row ``all_pairs``: pairs that agree on any block, from the blocks' sizes, in integers.

    With several blocks, by inclusion and exclusion over the sizes of their combinations.
    """
    pairs = F.expr("CAST(CAST(n AS DECIMAL(19,0)) * (n - 1) / 2 AS DECIMAL(38,0))")
    columns = block_columns(rules.blocking)
    parts = []
    for size in range(1, len(columns) + 1):
        for chosen in combinations(columns, size):
            sizes = distinct.dropna(subset=list(chosen)).groupBy(*chosen).agg(F.sum("copies").alias("n"))
            parts.append(sizes.select((pairs * (1 if size % 2 else -1)).alias("pairs")))
    return reduce(DataFrame.unionByName, parts).agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("all_pairs"))


def pair_counts(records: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """``(label, pairs)`` over all pairs of all blocks.

    Matches and uncertain pairs are added up from weighted profile pairs; the
    others are what is left of the block sizes.
    """
    distinct = written(profiles(forms_of(records, rules.blocking)), "profiles")
    label = rules.label(F.col("score"))
    sums = [F.coalesce(F.sum(F.when(label == x, F.col("weight"))), F.lit(0)) for x in ("match", "uncertain")]
    row = _weighed(distinct, rules).agg(sums[0].alias("m"), sums[1].alias("u"))
    counts = row.select("m", "u", _all_pairs(distinct, rules).scalar().alias("t"))
    rows = [("match", F.col("m")), ("uncertain", F.col("u")), ("non_match", F.col("t") - F.col("m") - F.col("u"))]
    return counts.select(F.inline(F.array(*[F.struct(F.lit(x).alias("label"), n.alias("pairs")) for x, n in rows])))


def score_histogram(records: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """``(bin, pairs)`` over all pairs of all blocks: the two upper fifths of the scores, and the rest.

    Pairs of at most ``best_without_email`` are never formed, so what lies
    below the upper bins is one bin: all pairs of the blocks but those above it.
    """
    distinct = written(profiles(forms_of(records, rules.blocking)), "profiles")
    score, weight = F.col("score"), F.col("weight")
    upper = _weighed(distinct, rules).agg(
        F.coalesce(F.sum(F.when((score > 0.6) & (score <= 0.8), weight)), F.lit(0)).alias("b"),
        F.coalesce(F.sum(F.when(score > 0.8, weight)), F.lit(0)).alias("c"),
    )
    counts = upper.select("b", "c", _all_pairs(distinct, rules).scalar().alias("t"))
    rows = [("[0, 0.6]", F.col("t") - F.col("b") - F.col("c")), ("(0.6, 0.8]", F.col("b")), ("(0.8, 1.0]", F.col("c"))]
    return counts.select(F.inline(F.array(*[F.struct(F.lit(x).alias("bin"), n.alias("pairs")) for x, n in rows])))


# Upper edges of the five score bins and the labels they are known by.
SCORE_BINS = {0.2: "(-0.001, 0.2]", 0.4: "(0.2, 0.4]", 0.6: "(0.4, 0.6]", 0.8: "(0.6, 0.8]", 1.0: "(0.8, 1.0]"}


def full_histogram(records: DataFrame, rules: MatchRules = MatchRules(), tile_rows: int | None = None) -> DataFrame:
    """``(bin, pairs)`` in five bins of the score over all pairs of all blocks.

    The inner edges lie where most pairs score, and no bound from lengths or letters tells
    on which side of them a pair is, so every two profiles of a block are compared: the work
    grows with the square of a block's distinct profiles, unlike :func:`score_histogram`. No pair becomes a row:
    profiles are copied to cells of two tiles each, a task holds one cell, and gives back five counts. Tiles go by
    name, and a cell compares its distinct names and phones, each one with all of the other side at once; a large one
    counts most pairs by the number of characters that their phones match.
    """
    distinct = written(profiles(forms_of(records, rules.blocking)), "profiles")
    own, before = [], {}
    for column in block_columns(rules.blocking):
        own.append(_cell_counts(distinct, column, list(before), rules, tile_rows or CELL_ROWS))
        before[column] = True
    score = copy_scores(distinct, rules)
    bins = F.lit(len(SCORE_BINS) - 1)
    for i, edge in reversed(list(enumerate(SCORE_BINS))[:-1]):
        bins = F.when(F.col("score") <= edge, i).otherwise(bins)
    own.append(score.select(bins.cast("int").alias("i"), F.col("weight").alias("pairs")))
    found = reduce(DataFrame.unionByName, own).groupBy("i").agg(F.sum("pairs").alias("pairs"))
    names = distinct.sparkSession.createDataFrame(list(enumerate(SCORE_BINS.values())), "i int, bin string")
    return names.join(found, "i", "left").select("bin", F.coalesce("pairs", F.lit(0)).cast("long").alias("pairs"))


def _cell_counts(distinct: DataFrame, block: str, before: list[str], rules: MatchRules, tile_rows: int) -> DataFrame:
    """``(i, pairs)``: weighted pairs of different profiles per bin, of those that agree on ``block`` and on none of ``before``."""
    rows = distinct.where(F.col(block).isNotNull())
    sizes = written(rows.groupBy(block).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "sizes")
    # By length and name, so that equal names, and names of one length, are in few tiles.
    by_name = F.struct(F.length("name_lower").alias("length"), "name_lower", "profile_id")
    placed = numbered(rows.join(sizes, block).withColumn("_by", by_name), block, "_by").drop("_by")
    tiled = placed.withColumn("_t", F.ceil(F.col("_n") / F.lit(float(tile_rows))).cast("int"))
    tiled = tiled.withColumn("_a", F.floor((F.col("position") - 1) / F.lit(float(tile_rows))).cast("int"))
    cells = tiled.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_t") - 1)))
    texts = ["name_lower", "email_normalized", "phone_normalized"]
    dealt = cells.select(
        F.col(block).alias("_block"), F.least("_a", "_o").alias("_i"), F.greatest("_a", "_o").alias("_j"),
        (F.col("_a") > F.col("_o")).alias("_right"), "copies", *texts,
        F.array(*[F.col(c).cast("string") for c in before]).alias("_before"),
    )
    tiles = F.ceil(F.col("_n") / F.lit(float(tile_rows)))
    more = sizes.where(F.col("_n") > tile_rows).agg(F.sum(tiles * (tiles + 1) / 2 - 1).alias("n")).first()["n"]
    parts = min(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")) + int(more or 0), MOST_TASKS)

    def counted(cell: pd.DataFrame, same: bool) -> np.ndarray:
        left = cell if same else cell[~cell["_right"]]
        right = cell if same else cell[cell["_right"]]
        return _cell_weights(left, right, same, len(before), rules)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held = None, []

        def closed() -> Iterator[pd.DataFrame]:
            if held:
                total = counted(pd.concat(held, ignore_index=True), place[1] == place[2])
                yield pd.DataFrame({"i": range(len(total)), "pairs": total.astype("int64")})

        for batch in batches:
            for here, part in batch.groupby(["_block", "_i", "_j"], sort=False):
                if here != place:
                    yield from closed()
                    place, held = here, []
                held.append(part)
        yield from closed()

    dealt = dealt.repartition(parts, "_block", "_i", "_j").sortWithinPartitions("_block", "_i", "_j")
    return dealt.mapInPandas(run, "i int, pairs long")


# Rows of a tile of a block, where all pairs are counted, and from so many on a cell is counted by matches.
CELL_ROWS = 1 << 14
LARGE_ROWS = 8192


def _cell_weights(left: pd.DataFrame, right: pd.DataFrame, same: bool, before: int, rules: MatchRules) -> np.ndarray:
    """As :func:`_bin_weights`, for sides of any size."""
    if min(len(left), len(right)) >= LARGE_ROWS:
        return _large_weights(left, right, same, before, rules)
    # In tables of bounded size; by name, so that equal names are in few.
    left, right = (x.iloc[np.lexsort((pd.factorize(x["name_lower"], sort=True)[0], x["name_lower"].str.len()))] for x in (left, right))
    total = np.zeros(len(SCORE_BINS), object)
    for a in range(0, len(left), TILE_ROWS):
        for b in range(a if same else 0, len(right), TILE_ROWS):
            some = left.iloc[a : a + TILE_ROWS], right.iloc[b : b + TILE_ROWS]
            total += _bin_weights(*some, same and a == b, before, rules)
    return total


# Left rows of a cell whose names and phones are compared at once, and pairs scored at once.
STRIP_ROWS = 256
SCORED_PAIRS = 1 << 16


def _bin_weights(left: pd.DataFrame, right: pd.DataFrame, same: bool, before: int, rules: MatchRules) -> np.ndarray:
    """Weighted pairs per bin of ``left`` and ``right`` rows; with ``same``, of each two rows of one side once."""
    edges, total = list(SCORE_BINS)[:-1], np.zeros(len(SCORE_BINS), object)
    names, phones = (_Side(left[c], right[c]) for c in ("name_lower", "phone_normalized"))
    mail_left, mail_right = _codes(left["email_normalized"], right["email_normalized"], None if rules.blank_emails_agree else "")
    shared = [_codes(left["_before"].str[k], right["_before"].str[k], None) for k in range(before)]
    copies_left, copies_right = left["copies"].to_numpy(), right["copies"].to_numpy()
    for top in range(0, len(left), STRIP_ROWS):
        strip = slice(top, top + STRIP_ROWS)
        name, phone = names.weighted(strip, rules.name_weight), phones.weighted(strip, rules.phone_weight)
        step = max(1, SCORED_PAIRS // max(1, len(right)))
        for at in range(top, min(top + STRIP_ROWS, len(left)), step):
            some = slice(at, min(at + step, top + STRIP_ROWS, len(left)))
            score = name(some)
            mail = mail_left[some, None] == mail_right
            if mail.any():
                score = score + mail.astype(float) * rules.email_weight
            score = score + phone(some)
            keep = None
            if same:
                keep = np.arange(some.start, some.stop)[:, None] < np.arange(len(right))
            for x, y in shared:
                met = x[some, None] != y
                keep = met if keep is None else keep & met
            below = 0
            for i in range(len(total)):
                if i < len(edges):
                    under = score <= edges[i]
                    under = under if keep is None else under & keep
                else:
                    under = np.ones(score.shape, bool) if keep is None else keep
                upto = _weight(under, copies_left[some], copies_right)
                total[i] += upto - below
                below = upto
    return total


class _Side:
    """One text column of a cell: its distinct texts, each compared once with those of a strip."""

    def __init__(self, left: pd.Series, right: pd.Series):
        self.left = left.to_numpy(object)
        texts, self.right_at = _distinct(right.to_numpy(object))
        self.right = Compared(texts)

    def weighted(self, strip: slice, weight: float) -> Callable[[slice], np.ndarray]:
        """For rows of the strip, the weighted similarity to every right row."""
        texts, at = _distinct(self.left[strip])
        table = self.right.with_all(texts) * weight
        wide = len(self.right_at) > len(self.right.texts) or not np.array_equal(self.right_at, np.arange(len(self.right_at)))

        def of(rows: slice) -> np.ndarray:
            chosen = table[at[rows.start - strip.start : rows.stop - strip.start]]
            return np.take(chosen, self.right_at, axis=1, mode="clip") if wide else chosen

        return of


# Rows of a cell that are compared with one another at once, names compared at once, and pairs looked at one by one at once.
CHUNK_ROWS = 1 << 14
STRIP_ROWS = 1 << 14
STRIP_NAMES = 256
DOUBTFUL_PAIRS = 1 << 14


def _large_weights(left: pd.DataFrame, right: pd.DataFrame, same: bool, before: int, rules: MatchRules) -> np.ndarray:
    """As :func:`_bin_weights`, quicker for many rows.

    The similarity of two phones lies between bounds that the number of matched characters sets. Where the score is on one
    side of an edge with both, the pair is counted by that number; the order of the characters is looked at in the others.
    """
    letters = np.array(sorted(set("".join(left["phone_normalized"])) | set("".join(right["phone_normalized"]))), dtype=str)
    left, right = (_by_phone(side, len(letters)) for side in (left, right))
    mail = _codes(left["email_normalized"], right["email_normalized"], None if rules.blank_emails_agree else "")
    shared = [_codes(left["_before"].str[k], right["_before"].str[k], None) for k in range(before)]
    under, total = [0] * (len(SCORE_BINS) - 1), 0
    for rows in _runs(right["_long"].to_numpy(), CHUNK_ROWS):
        chunk = _Chunk(right, rows, mail, shared, letters, rules)
        for across in _runs(left["_wide"].to_numpy(), STRIP_ROWS):
            if same:
                across = slice(across.start, min(across.stop, rows.stop))
            if across.start < across.stop:
                more, pairs = chunk.met(left, across, same)
                under = [a + b for a, b in zip(under, more)]
                total += pairs
    upto = [*under, total]
    return np.array([b - a for a, b in zip([0, *upto], upto)], dtype=object)


def _by_phone(side: pd.DataFrame, letters: int) -> pd.DataFrame:
    """Rows by the length of their phone, and those of one name in a row."""
    wide = side["phone_normalized"].str.len().astype("int64")
    side = side.assign(_wide=wide, _long=(wide > SHORT) | (letters > FEW))
    return side.iloc[np.lexsort((pd.factorize(side["name_lower"])[0], wide.to_numpy()))]


def _runs(values: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of equal values, of ``most`` or fewer."""
    ends = [*(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    for start, stop in zip([0, *ends], ends):
        yield from (slice(a, min(a + most, stop)) for a in range(start, stop, most))


class _Chunk:
    """Right rows, and how many of their pairs with left rows score up to each edge."""

    def __init__(self, right: pd.DataFrame, rows: slice, mail: tuple, shared: list, letters: np.ndarray, rules: MatchRules):
        self.rules, self.rows, self.letters = rules, rows, letters
        side = right.iloc[rows]
        names, self.name_at = _distinct(side["name_lower"].to_numpy(object))
        self.names = Compared(names, coded=True)
        self.phones = side["phone_normalized"].to_numpy(object)
        self.wide = side["_wide"].to_numpy()
        self.short = not side["_long"].iloc[0]
        if self.short:
            self.codes = coded(self.phones, self.wide, letters)
            self.matches, self.picked = Matches(self.codes, self.wide, len(letters)), Picked(self.codes)
            self.widths, self.width_at = np.unique(self.wide, return_inverse=True)
            self.place = self.width_at * len(names) + self.name_at
        self.copies = side["copies"].to_numpy()
        self.copied = np.flatnonzero(self.copies > 1)
        self.extra = self.copies[self.copied] - 1
        self.upto = [0, *np.cumsum(self.copies).tolist()]
        # Rows by email, for the rows of the left that share one.
        self.mail_left, mail_right = mail[0], mail[1][rows]
        self.by_mail = np.argsort(mail_right, kind="stable")
        self.mails = mail_right[self.by_mail]
        self.shared = [(x, y[rows]) for x, y in shared]
        self.edges = list(SCORE_BINS)[:-1]

    def met(self, left: pd.DataFrame, across: slice, same: bool) -> tuple[list[int], int]:
        """Weights of the pairs with the left rows ``across`` that score up to each edge, and of all pairs."""
        side = left.iloc[across]
        phones, copies, names = side["phone_normalized"].to_numpy(object), side["copies"].tolist(), side["name_lower"].to_numpy(object)
        doubts = phone_table = None
        if self.short and not side["_long"].iloc[0]:
            doubts = _Doubts(self, coded(phones, side["_wide"].to_numpy(), self.letters))
            table, counts, chosen = self.matches.rows(doubts.left, doubts.left.shape[1])
        else:
            phone_table = Compared(self.phones)
        first, last = (np.searchsorted(self.mails, self.mail_left[across], to).tolist() for to in ("left", "right"))
        under, total, n = [0] * len(self.edges), 0, len(self.phones)
        none, m_all = np.zeros(n, np.uint8), np.empty(n, np.uint8)
        low_all, doubt_all = np.empty(n, bool), np.empty(n, bool)
        groups = list(_runs(pd.factorize(names)[0], STRIP_NAMES))
        for g, group in enumerate(groups):
            if g % STRIP_NAMES == 0:
                strip = self.names.with_all(names[[x.start for x in groups[g : g + STRIP_NAMES]]])
                base = np.array(self.names.values) * self.rules.name_weight
                if doubts:
                    doubts.settle()
                    doubts.base = base
                bounds = doubts.bounds() if doubts else []
            codes = strip[g % STRIP_NAMES]
            sure, open_edges = [], []
            worth = base[codes]
            for e, (least, most, limits) in enumerate(bounds):
                if worth.max() + doubts.weighted.max() <= self.edges[e]:
                    sure.append(e)
                elif worth.min() + doubts.weighted.min() <= self.edges[e]:
                    lows, highs = least.take(codes, axis=1), most.take(codes, axis=1)
                    open_edges.append((e, lows.ravel().take(self.place), highs.ravel().take(self.place), limits))
            if phone_table:
                phone_rows = phone_table.with_all(phones[group]) * self.rules.phone_weight
                scored = base[codes].take(self.name_at)
            for i in range(group.start, group.stop):
                start = max(0, across.start + i + 1 - self.rows.start) if same else 0
                if start >= n:
                    continue
                weight, keep = copies[i], None
                for x, y in self.shared:
                    apart = y[start:] != x[across.start + i]
                    keep = apart if keep is None else keep & apart
                pairs = weight * (self.upto[-1] - self.upto[start] if keep is None else self.weigh(keep, start))
                total += pairs
                mailed = none[:0]
                if first[i] < last[i]:
                    mailed = self.by_mail[first[i] : last[i]]
                    mailed = mailed[mailed >= start]
                    if keep is not None:
                        mailed = mailed[keep[mailed - start]]
                if phone_table:
                    phone = phone_rows[i - group.start]
                    score = scored + phone
                    if len(mailed):
                        score[mailed] = (scored[mailed] + self.rules.email_weight) + phone[mailed]
                    for e, edge in enumerate(self.edges):
                        low = score[start:] <= edge
                        under[e] += weight * self.weigh(low if keep is None else low & keep, start)
                    continue
                for e in sure:
                    under[e] += pairs
                rows = chosen[i]
                m = none[start:]
                if len(rows) == 1:
                    m = counts[rows[0], start:]
                elif rows:
                    m = np.add(counts[rows[0], start:], counts[rows[1], start:], out=m_all[start:])
                    for r in rows[2:]:
                        np.add(m, counts[r, start:], out=m)
                for e, lows, highs, limits in open_edges:
                    low = np.less(m, lows[start:], out=low_all[start:])
                    doubt = np.less(m, highs[start:], out=doubt_all[start:])
                    np.not_equal(doubt, low, out=doubt)
                    if keep is not None:
                        low &= keep
                        doubt &= keep
                    under[e] += weight * self.weigh(low, start)
                    at = doubt.nonzero()[0]
                    if len(at):
                        at += start
                        doubts.add(e, i, weight, at, limits[self.width_at.take(at), codes.take(self.name_at.take(at))], codes, table, rows)
                if len(mailed):
                    doubts.add("mail", i, weight, mailed, mailed, codes, table, rows)
        if doubts:
            doubts.settle()
            under = [a + b for a, b in zip(under, doubts.under)]
        return under, total

    def weigh(self, chosen: np.ndarray, start: int) -> int:
        """The sum of the copies of the chosen rows from ``start`` on; most have one copy, and are only counted."""
        weight = int(np.count_nonzero(chosen))
        if len(self.copied):
            k = int(np.searchsorted(self.copied, start))
            weight += int(self.extra[k:] @ chosen[self.copied[k:] - start])
        return weight


class _Doubts:
    """Pairs of left rows and a chunk that the number of matches in their phones doesn't settle."""

    def __init__(self, chunk: _Chunk, left: np.ndarray):
        self.chunk, self.left = chunk, left
        self.picked = Picked(left)
        # By length of the right phone, matches, places out of order and equal first characters.
        self.weighted = np.zeros((len(chunk.widths), SHORT + 1, SHORT // 2 + 1, 5))
        for k, wide in enumerate(chunk.widths.tolist()):
            known = outcomes(left.shape[1], wide) * chunk.rules.phone_weight
            self.weighted[k, : known.shape[0], : known.shape[1]] = known
        self.found = self._none(0)
        self.under = [0] * len(chunk.edges)
        self.held: dict = {}
        self.size = 0

    def _none(self, values: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        shape = len(self.chunk.widths), values
        return [tuple(np.zeros(shape, kind) for kind in (np.uint8, np.uint8, np.uint64)) for _ in self.chunk.edges]

    def bounds(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per edge, by length of the right phone and value of the name's part: with fewer matches than the first number
        a pair surely scores up to the edge (255: always), from the second on it surely scores more. Between, it scores up to
        the edge from so many places out of order on, four bits per number of matches (``_HEADS``: the first characters matter).
        """
        # Values are only ever added to those of earlier names.
        base = self.base[self.found[0][0].shape[1] :]
        if not len(base):
            return self.found
        more = self._none(len(base))
        for k, wide in enumerate(self.chunk.widths.tolist()):
            most = min(self.left.shape[1], wide) + 1
            each = [self.weighted[k, m, : m // 2 + 1] for m in range(most)]
            lowest = np.minimum.accumulate([x.min() for x in each[::-1]])[::-1]  # of so many matches or more
            highest = np.maximum.accumulate([x.max() for x in each])  # of so many or fewer
            for edge, found in zip(self.chunk.edges, more):
                for bound, phones in zip(found, (highest, lowest)):
                    upto = (base[:, None] + phones <= edge).sum(axis=1)
                    bound[k] = np.where(upto == most, 255, upto)
                for m, x in enumerate(each):
                    # The similarity falls with the places out of order, and rises with equal first characters.
                    over = (base[:, None, None] + x[:, [0, 4]] > edge).sum(axis=1)
                    over = np.where(over[:, 0] != over[:, 1], _HEADS, over[:, 0])
                    found[2][k] |= over.astype(np.uint64) << np.uint64(4 * m)
        self.found = [tuple(np.concatenate(both, axis=1) for both in zip(*pair)) for pair in zip(self.found, more)]
        return self.found

    def add(
        self, kind: int | str, i: int, weight: int, at: np.ndarray, limit: np.ndarray, codes: np.ndarray, table: np.ndarray,
        rows: list[int],
    ) -> None:
        """Note pairs of left row ``i``: for an edge, or (``"mail"``) those of equal emails, that were counted without."""
        matched = np.zeros(len(at), np.uint32)
        for r in rows:
            matched += table[r].take(at, mode="clip")
        self.held.setdefault(kind, []).append((i, weight, at, limit, matched, codes))
        self.size += len(at)
        if self.size >= DOUBTFUL_PAIRS:
            self.settle()

    def settle(self) -> None:
        """Score the pairs held."""
        bits = (1 << SHORT) - 1
        for kind, held in self.held.items():
            lengths = [len(x[2]) for x in held]
            i = np.repeat(np.array([x[0] for x in held]), lengths)
            at, limit, matched = (np.concatenate([x[k] for x in held]) for k in (2, 3, 4))
            matched = matched.astype(np.int64)
            weight = None
            if len(self.chunk.copied) or max(x[1] for x in held) > 1:
                weight = np.repeat(np.array([x[1] for x in held]), lengths) * self.chunk.copies[at]
            number = matched >> 2 * SHORT
            first, second = self.picked.at(i, (matched >> SHORT) & bits), self.chunk.picked.at(at, matched & bits)
            swapped = out_of_order(first, second)
            if kind != "mail":
                limit >>= (number << 2).view(np.uint64)
                limit &= np.uint64(15)
                low = swapped >= limit
                some = (limit == _HEADS).nonzero()[0]
                if len(some):
                    codes = np.concatenate([x[5][self.chunk.name_at[x[2]]] for x in held])[some]
                    phone = self._phones(i[some], at[some], number[some], swapped[some])
                    low[some] = self.base[codes] + phone <= self.chunk.edges[kind]
                self.under[kind] += _sum(low, weight)
                continue
            base = self.base[np.concatenate([x[5][self.chunk.name_at[x[2]]] for x in held])]
            phone = self._phones(i, at, number, swapped)
            for e, edge in enumerate(self.chunk.edges):
                self.under[e] += _sum((base + self.chunk.rules.email_weight) + phone <= edge, weight)
                self.under[e] -= _sum(base + phone <= edge, weight)
        self.held, self.size = {}, 0

    def _phones(self, i: np.ndarray, at: np.ndarray, number: np.ndarray, swapped: np.ndarray) -> np.ndarray:
        """The weighted similarity of the phones of left rows and rows of the chunk, by what matches in them."""
        alike, same = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for k in range(min(4, self.left.shape[1], self.chunk.codes.shape[1])):
            same &= (self.left[i, k] == self.chunk.codes[at, k]) & (self.chunk.wide[at] > k)
            alike += same
        return self.weighted[self.chunk.width_at[at], number, swapped, alike]


# A limit on places out of order that stands for one that depends on the first characters.
_HEADS = 15


def _sum(chosen: np.ndarray, weight: np.ndarray | None) -> int:
    return int(np.count_nonzero(chosen) if weight is None else weight[chosen].sum())


def _distinct(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct texts by length, and the number of each row's text among them."""
    at, found = pd.factorize(texts)
    order = np.argsort(np.fromiter(map(len, found), dtype=np.int64, count=len(found)), kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return found[order], place[at]


def _codes(left: pd.Series, right: pd.Series, never: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the values are; nulls and ``never`` equal nothing."""
    both = np.concatenate([left.to_numpy(object), right.to_numpy(object)])
    codes, _ = pd.factorize(both)
    codes = codes.astype(np.int32)
    if never is not None:
        codes[both == never] = -1
    x, y = codes[: len(left)].copy(), codes[len(left) :].copy()
    y[y < 0] = -2
    return x, y


def _weight(chosen: np.ndarray, left: np.ndarray, right: np.ndarray) -> int:
    """The sum of the products of copies over the chosen pairs; most rows have one copy, and are only counted."""
    more_left, more_right = np.flatnonzero(left > 1), np.flatnonzero(right > 1)
    extra = right[more_right] - 1
    added = int(np.count_nonzero(chosen))
    if len(more_right):
        added += int(np.count_nonzero(chosen[:, more_right], axis=0) @ extra)
    if len(more_left):
        rows = chosen[more_left]
        each = np.count_nonzero(rows, axis=1) + rows[:, more_right].astype(np.int64) @ extra
        added += int(each @ (left[more_left] - 1))
    return added


def review_candidates(pairs: DataFrame) -> DataFrame:
    """Uncertain pairs with their score and the compared fields as a map."""
    details = F.create_map(*[x for c in FEATURES for x in (F.lit(c), F.col(c))])
    return pairs.where("label = 'uncertain'").select(
        F.col("left_id").alias("record_id_1"),
        F.col("right_id").alias("record_id_2"),
        F.col("score").alias("confidence_score"),
        details.alias("comparison_details"),
    )
