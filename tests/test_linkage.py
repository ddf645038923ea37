import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patronage.operators.linkage import components, normalise, pairs, report, survive
from patronage.operators.linkage.rules import MatchRules
from patronage.sources import exports

COLUMNS = "rec_id long, customer_id string, name string, email string, phone string"


def people(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def messy(spark):
    """Few names, emails and phones, many blanks and copies: every kind of hot group."""
    rng = random.Random(5)
    names = ["Ann Lee", "ann lee ", "Anna Li", "Al", "Bob Stone", "Bo Stone", "Cy", "", None, "Ann-Lee", "Abe Leeds"]
    emails = [None, None, "a@x.com", "A@x.com ", "b@x.com", "c @x.com", "none"]
    phones = [None, "555-1234", "5551234", "(555) 1299", "777", "12345678901"]
    rows = [
        (i, f"C{i}", rng.choice(names), rng.choice(emails), rng.choice(phones)) for i in range(150)
    ]
    rows += [(1000 + i, f"K{i}", "Ann Lee", "copy@x.com", "999-1") for i in range(60)]
    return people(spark, rows)


def brute(records, rules=MatchRules()):
    """All pairs of all blocks, with the similarities from DuckDB."""
    forms = normalise.normalise(records).toPandas()  # noqa: F841 - read by the statement
    found = duckdb.sql(
        """
        SELECT l.rec_id AS l, r.rec_id AS r, l.email_normalized AS email,
          l.email_normalized = r.email_normalized AS same,
          CASE WHEN l.name_lower = '' OR r.name_lower = '' THEN 0.0
               ELSE jaro_winkler_similarity(l.name_lower, r.name_lower) END AS name,
          CASE WHEN l.phone_normalized = '' OR r.phone_normalized = '' THEN 0.0
               ELSE jaro_winkler_similarity(l.phone_normalized, r.phone_normalized) END AS phone
        FROM forms l JOIN forms r ON l.first_letter = r.first_letter AND l.rec_id > r.rec_id"""
    ).fetchall()
    out = []
    for left, right, mail, same, name, phone in found:
        same = same and (rules.blank_emails_agree or mail != "")
        score = name * rules.name_weight + float(same) * rules.email_weight + phone * rules.phone_weight
        label = (
            "match"
            if score >= rules.match_threshold
            else "uncertain" if score >= rules.uncertain_threshold else "non_match"
        )
        out.append((left, right, label, round(score, 9)))
    return out


def listed(frame):
    return sorted((r.left_id, r.right_id, r.label, round(r.score, 9)) for r in frame.collect())


@pytest.mark.parametrize(
    "rules",
    [
        MatchRules(),
        MatchRules(blank_emails_agree=True),
        MatchRules(uncertain_threshold=0.65),
        MatchRules(match_threshold=0.9, uncertain_threshold=0.7),
    ],
)
def test_pairs_equal_brute_force(messy, rules):
    want = brute(messy, rules)
    kept = sorted(p for p in want if p[2] != "non_match")
    assert listed(pairs.record_pairs(messy, rules)) == kept
    counts = {r.label: r.pairs for r in pairs.pair_counts(messy, rules).collect()}
    assert counts == {label: sum(p[2] == label for p in want) for label in ("match", "uncertain", "non_match")}


@pytest.mark.parametrize("blocking", [("first_letter", "zip_code"), ("zip_code", "first_letter"), ("zip_code",)])
@pytest.mark.parametrize("blank", [False, True])
def test_pairs_of_several_blocks_are_made_once(spark, messy, blocking, blank):
    zips = F.when(F.col("rec_id") % 7 < 5, F.concat(F.lit("1000"), (F.col("rec_id") % 4).cast("string"))).when(F.col("rec_id") % 7 == 5, F.lit(" "))
    people_with_zips = messy.withColumn("zip_code", zips)
    forms = normalise.normalise(people_with_zips).toPandas()  # noqa: F841 - read by the statement
    either = {"first_letter": "l.first_letter = r.first_letter", "zip_code": "(l.zip_code = r.zip_code AND trim(l.zip_code) <> '')"}
    found = duckdb.sql(
        f"""
        SELECT l.rec_id, r.rec_id, CASE WHEN l.name_lower = '' OR r.name_lower = '' THEN 0.0
               ELSE jaro_winkler_similarity(l.name_lower, r.name_lower) END * 0.4::DOUBLE
          + (l.email_normalized = r.email_normalized AND (l.email_normalized <> '' OR {blank}))::INT::DOUBLE * 0.4::DOUBLE
          + CASE WHEN l.phone_normalized = '' OR r.phone_normalized = '' THEN 0.0
               ELSE jaro_winkler_similarity(l.phone_normalized, r.phone_normalized) END * 0.2::DOUBLE
        FROM forms l JOIN forms r ON ({" OR ".join(either[b] for b in blocking)}) AND l.rec_id > r.rec_id"""
    ).fetchall()
    rules = MatchRules(blocking=blocking, blank_emails_agree=blank)
    kept = [(a, b, round(s, 9)) for a, b, s in found if s >= 0.6]
    got = [(r.left_id, r.right_id, round(r.score, 9)) for r in pairs.record_pairs(people_with_zips, rules).collect()]
    assert sorted(got) == sorted(kept)
    counts = {r.label: r.pairs for r in pairs.pair_counts(people_with_zips, rules).collect()}
    assert counts["match"] + counts["uncertain"] == len(kept) and sum(counts.values()) == len(found)


def test_an_unknown_block_is_an_error(messy):
    with pytest.raises(ValueError, match="city"):
        pairs.record_pairs(messy, MatchRules(blocking=("city",)))


@pytest.mark.parametrize("rules", [MatchRules(), MatchRules(blank_emails_agree=True)])
def test_histogram_covers_every_pair_of_every_block(messy, rules):
    want = [p[3] for p in brute(messy, rules)]
    found = {r.bin: r.pairs for r in pairs.score_histogram(messy, rules).collect()}
    edge = 0.6 - 1e-9  # 0.4 + 0.2 is above 0.6 in doubles
    assert found == {
        "[0, 0.6]": sum(x <= edge for x in want),
        "(0.6, 0.8]": sum(edge < x <= 0.8 + 1e-9 for x in want),
        "(0.8, 1.0]": sum(x > 0.8 + 1e-9 for x in want),
    }


@pytest.mark.parametrize("tile_rows", [3, 1024])
@pytest.mark.parametrize("rules", [MatchRules(), MatchRules(blank_emails_agree=True)])
def test_five_bins_equal_brute_force(messy, rules, tile_rows):
    want = [p[3] for p in brute(messy, rules)]
    found = {r.bin: r.pairs for r in pairs.full_histogram(messy, rules, tile_rows).collect()}
    edges = [-1.0, 0.2 + 1e-9, 0.4 + 1e-9, 0.6 - 1e-9, 0.8 + 1e-9, 2.0]  # 0.4 + 0.2 is above 0.6 in doubles
    assert [found[b] for b in pairs.SCORE_BINS.values()] == [sum(a < x <= b for x in want) for a, b in zip(edges, edges[1:])]


def test_a_cell_compares_each_distinct_name_once(monkeypatch):
    rows = pd.DataFrame({"name_lower": ["ann", "bob", "ann", "ann"] * 200, "email_normalized": "", "copies": 1})
    rows["phone_normalized"] = [str(k) for k in range(800)]
    rows.loc[::50, "copies"] = 3
    compared = []
    with_all = pairs.Compared.with_all

    def noted(self, left):
        compared.append(len(left) * len(self.texts))
        return with_all(self, left)

    monkeypatch.setattr(pairs.Compared, "with_all", noted)
    total = pairs._bin_weights(rows, rows, True, 0, MatchRules())
    assert sum(compared) <= 800 * 800 + 4 * 2 * 2
    weight = int(rows["copies"].sum())
    assert sum(total) == (weight**2 - int((rows["copies"] ** 2).sum())) // 2


@pytest.mark.parametrize("rules", [MatchRules(), MatchRules(blank_emails_agree=True), MatchRules(0.3, 0.2, 0.5)])
@pytest.mark.parametrize("before", [0, 1])
def test_large_cells_count_as_tables_do(rules, before, monkeypatch):
    rng = random.Random(before)
    monkeypatch.setattr(pairs, "CHUNK_ROWS", 100)
    monkeypatch.setattr(pairs, "STRIP_ROWS", 70)

    def side(n):
        phones = ["".join(rng.choice("0123456789"[: rng.choice([3, 10])]) for _ in range(rng.choice([0, 2, 7, 10, 10, 11, 12, 14, 18]))) for _ in range(n)]
        return pd.DataFrame(
            {
                "name_lower": [rng.choice(["", "ann lee", "ann li", "al", "abe leeds", f"ann {rng.randrange(99)}"]) for _ in range(n)],
                "email_normalized": [rng.choice(["", "a@x", f"a{rng.randrange(n)}@x"]) for _ in range(n)],
                "phone_normalized": [rng.choice([p, phones[0]]) if rng.random() < 0.1 else p for p in phones],
                "copies": [rng.choice([1, 1, 1, 2, 5]) for _ in range(n)],
                "_before": [[rng.choice([None, "a", "b"])] for _ in range(n)],
            }
        )

    left, right = side(230), side(170)
    for pair, same in (((left, right), False), ((left, left), True)):
        assert list(pairs._large_weights(*pair, same, before, rules)) == list(pairs._bin_weights(*pair, same, before, rules))


def test_large_cells_leave_the_order_of_characters_to_doubtful_pairs(monkeypatch):
    rng = random.Random(3)
    rows = pd.DataFrame({"name_lower": [f"red {rng.choice(['bolt', 'gear'])} {k % 50:03d}" for k in range(1000)], "email_normalized": "", "copies": 1})
    rows["phone_normalized"] = [str(rng.randrange(10**9, 10**10)) for _ in range(1000)]
    looked_at, settled = [], pairs.out_of_order
    monkeypatch.setattr(pairs, "out_of_order", lambda a, b: looked_at.append(len(a)) or settled(a, b))
    monkeypatch.setattr(pairs, "LARGE_ROWS", 500)
    assert sum(pairs._cell_weights(rows, rows, True, 0, MatchRules())) == 1000 * 999 // 2
    assert 0 < sum(looked_at) < 1000 * 999 // 2 // 2


def test_five_bins_of_several_blocks(messy):
    zips = messy.withColumn("zip_code", F.when(F.col("rec_id") % 3 > 0, (F.col("rec_id") % 5).cast("string")))
    rules = MatchRules(blocking=("zip_code", "first_letter"))
    found = {r.bin: r.pairs for r in pairs.full_histogram(zips, rules, 20).collect()}
    counts = {r.label: r.pairs for r in pairs.pair_counts(zips, rules).collect()}
    assert sum(found.values()) == sum(counts.values())
    assert found["(0.6, 0.8]"] + found["(0.8, 1.0]"] == counts["match"] + counts["uncertain"]


def test_a_floor_that_would_list_whole_blocks_is_an_error(messy):
    with pytest.raises(ValueError, match="counted"):
        pairs.record_pairs(messy, floor=0.3)


def test_pairs_of_large_blocks_are_counted_in_integers(spark):
    n = 150_000_003
    profile = spark.createDataFrame([(0, "a", "ann", "", "1", n)], "profile_id long, first_letter string, name_lower string, email_normalized string, phone_normalized string, copies long")
    assert pairs._all_pairs(profile, MatchRules()).first().all_pairs == n * (n - 1) // 2
    assert pairs.copy_scores(profile).first().weight == n * (n - 1) // 2


def test_profile_pairs_weigh_as_record_pairs(messy):
    distinct = normalise.profiles(normalise.forms_of(messy))
    weighed = pairs.profile_pairs(distinct).agg(F.sum("weight")).first()[0]
    copies = pairs.copy_scores(distinct).where("score >= 0.6").agg(F.sum("weight")).first()[0]
    assert weighed + copies == pairs.record_pairs(messy).count()


@pytest.mark.parametrize("tile_rows", [1, 3, 7, 1000])
def test_tiles_cover_each_pair_once(spark, tile_rows):
    df = spark.createDataFrame([("x", i) for i in range(40)] + [("y", 100), ("z", 7), ("z", 8)], "k string, id long")
    got = pairs.tiled_self_join(df, ["k"], "id", tile_rows=tile_rows).collect()
    want = {("x", b, a) for a in range(40) for b in range(a + 1, 40)} | {("z", 8, 7)}
    assert len(got) == len(want) and {(r.k, r.l_id, r.r_id) for r in got} == want


def test_block_sizes(messy):
    sizes = {r.first_letter: (r.records, r.candidate_pairs) for r in pairs.block_sizes(messy).collect()}
    assert sum(p for _, p in sizes.values()) == len(brute(messy))
    assert all(p == n * (n - 1) // 2 for n, p in sizes.values())


def test_different_first_letters_are_not_compared(spark):
    same_person = people(
        spark, [(0, "1", "Robert Smith", "r@t.com", "123"), (1, "2", "Bob Smith", "r@t.com", "123")]
    )
    assert pairs.record_pairs(same_person).count() == 0 and pairs.block_sizes(same_person).agg({"candidate_pairs": "sum"}).first()[0] == 0


def test_review_queue_details(messy):
    scored = pairs.record_pairs(messy)
    queue = pairs.review_candidates(scored)
    assert queue.count() == scored.where("label = 'uncertain'").count()
    row = queue.first()
    assert set(row.comparison_details) == set(pairs.FEATURES)


def union_find(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(90)]  # a chain
    edges += [(5000, 5001 + i) for i in range(60)]  # a hub
    df = spark.createDataFrame(edges, "left_id long, right_id long")
    got = {r.rec_id: r.component_id for r in components.connected_components(df).collect()}
    assert got == union_find([e for e in edges if e[0] != e[1]])


def test_no_edges_no_components(spark):
    assert components.connected_components(spark.createDataFrame([], "left_id long, right_id long")).count() == 0


def test_match_clusters_equal_components_of_all_pairs(messy):
    want = union_find([(p[0], p[1]) for p in brute(messy) if p[2] == "match"])
    got = {r.rec_id: r.component_id for r in components.match_clusters(messy).collect()}
    assert got == want


@pytest.fixture(scope="module")
def crew(spark):
    return people(
        spark,
        [
            (3, "M-17", "Oluwaseun Adeyemi", "seun@harbour.example", "(020) 7946 0018"),
            (5, "M-20", "Ingrid Vass", "ingrid@quay.example", "0161 496 0007"),
            (8, "M-17b", "O. Adeyemi", "seun@harbour.example", "02079460018"),
            (11, "M-31", "Tomas Brandt", None, "0191 498 0100"),
        ],
    )


def one_cluster(spark, members):
    return spark.createDataFrame([(m, min(members)) for m in members], "rec_id long, component_id long")


def test_golden_records(spark, crew):
    golden = {r.unified_id: r for r in survive.golden_records(crew, one_cluster(spark, [3, 8])).collect()}
    assert set(golden) == {"GOLD_000003", "GOLD_000005", "GOLD_000011"}
    merged = golden["GOLD_000003"]
    assert (merged.name, merged.email, merged.phone) == ("Oluwaseun Adeyemi", "seun@harbour.example", "(020) 7946 0018")
    assert merged.record_count == 2 and golden["GOLD_000011"].email is None


def test_best_values_prefer_the_first_on_ties(spark):
    rows = [
        (4, "d", "Xy Z", "plain", None),
        (7, "a", "Abcd", "q@x", "12-34"),
        (9, "b", None, "p@x", "1234"),
        (12345678, "c", "Ab", None, "(9)"),
    ]
    golden = survive.golden_records(people(spark, rows), one_cluster(spark, [4, 7, 9, 12345678])).first()
    assert (golden.name, golden.email, golden.phone) == ("Xy Z", "q@x", "12-34")
    lonely = survive.golden_records(
        people(spark, [(12345678, "c", None, None, None)]), spark.createDataFrame([], "rec_id long, component_id long")
    ).first()
    assert lonely.unified_id == "GOLD_12345678" and lonely.name is None and lonely.email is None


def test_lineage_has_every_member_in_order(spark, crew):
    members = survive.lineage(crew, one_cluster(spark, [3, 5, 8]))
    got = sorted((r.unified_id, r.position, r.rec_id, r.customer_id) for r in members.collect())
    assert got == [
        ("GOLD_000003", 1, 3, "M-17"), ("GOLD_000003", 2, 5, "M-20"), ("GOLD_000003", 3, 8, "M-17b"),
        ("GOLD_000011", 1, 11, "M-31"),
    ]


def test_lists_of_a_large_cluster_lose_no_id(spark):
    records = people(spark, [(i, f"C{i}", "n", None, None) for i in range(500)])
    members = survive.lineage(records, one_cluster(spark, list(range(500)))).cache()
    assert sorted((r.position, r.rec_id) for r in members.collect()) == [(i + 1, i) for i in range(500)]
    lists = survive.source_id_lists(members, per_list=64)
    assert lists.count() == 8 and lists.where("part = 1").first().source_ids.startswith("C64,C65,")
    assert sorted(r.customer_id for r in survive.split_source_ids(lists).collect()) == sorted(f"C{i}" for i in range(500))


def test_source_ids_split_back(spark):
    golden = spark.createDataFrame([("G1", "a, b,,c"), ("G2", None)], "unified_id string, source_ids string")
    assert sorted(tuple(r) for r in survive.split_source_ids(golden).collect()) == [
        ("a", "G1"),
        ("b", "G1"),
        ("c", "G1"),
    ]


def test_match_report(spark):
    records = spark.range(10).withColumnRenamed("id", "rec_id")
    counts = spark.createDataFrame([("match", 1), ("uncertain", 1), ("non_match", 5)], "label string, pairs long")
    row = report.match_report(records, counts, one_cluster(spark, [0, 1])).first()
    assert (row.total_records, row.total_matches, row.total_clusters) == (10, 1, 1)
    assert (row.match_rate, row.uncertain_count, row.unmatched_count, row.avg_cluster_size) == (0.2, 1, 8, 2.0)


def test_match_report_of_nothing(spark):
    nothing = spark.createDataFrame([], "rec_id long, component_id long")
    row = report.match_report(nothing, spark.createDataFrame([], "label string, pairs long"), nothing).first()
    assert (row.total_matches, row.match_rate, row.avg_cluster_size) == (0, 0.0, 0.0)



def test_review_rows_and_csv(spark, tmp_path):
    records = people(spark, [(0, "A", 'Al "Ace", Jr', None, None), (1, "B", "Bob", None, None)])
    scored = spark.createDataFrame(
        [(1, 0, 0.7, 0.8, 0.0, 0.6, "uncertain"), (9, 0, 0.65, None, 1.0, 0.1, "uncertain"), (1, 0, 0.9, 1.0, 1.0, 1.0, "match")],
        "left_id long, right_id long, score double, name_similarity double, email_match double, phone_similarity double, label string",
    )
    rows = report.review_rows(scored, records)
    out = str(tmp_path / "review")
    exports.write_csv(rows, out)
    back = spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(out)
    got = sorted(tuple(r) for r in back.collect())
    assert got == [
        ("9", "A", None, 'Al "Ace", Jr', 0.65, 0.0, 1.0, 0.1),
        ("B", "A", "Bob", 'Al "Ace", Jr', 0.7, 0.8, 0.0, 0.6),
    ]
