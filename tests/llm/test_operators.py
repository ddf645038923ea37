"""Each operator next to a brute-force version, with odd rows: nulls, empty and long texts, ties, repeats, clashing names."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from patronage.llm import (
    exact_dedup, fingerprints, language, lattice_lm, mixing, near_join, pieces, quality, toxicity,
)
from patronage.llm.registry import TARGET_WEIGHTS

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = "[\x20\x09-\x0d]+"
LOWER = {k: k + 32 for k in range(65, 91)}


def docs_of(spark, texts, extra=""):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "same text here", "en", "a", 14),
        (4, "same text here", "en", "a", 14), (5, "same  text\there", "en", "b", 15), (None, "same text here", "de", "b", 14),
        (6, "one", "de", None, 3), (7, "word " * 50_000, "en", "b", 250_000), (8, "é" * 3000, "fr", "c", 3000),
        (9, "Straße über über", "de", "c", 16), (9, "another text of the same id", "en", "c", 27),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return [w for w in re.split(SPACE, (text or "").translate(LOWER)) if w]


# --- exact duplicates


def duplicates(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(SPACE, "", r.text or "")].append(r)
    best = {}
    for key, group in groups.items():
        best[key] = min(group, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
    return [
        (r.doc_id, best[k].doc_id, len(groups[k]), hashlib.sha256(k.encode()).hexdigest())
        for r in rows
        for k in [re.sub(SPACE, "", r.text or "")]
    ]


@pytest.mark.parametrize("bits, bucket_rows", [(64, 1000), (2, 1), (64, 1)])
def test_exact_duplicates(spark, bits, bucket_rows):
    docs = odd_rows(spark)
    found = exact_dedup.exact_duplicates(docs, bits=bits, bucket_rows=bucket_rows, max_depth=6).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    assert sorted(got, key=repr) == sorted(duplicates(docs.collect()), key=repr)
    kept = collections.Counter(r.text_sha256 for r in found if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {r.text_sha256 for r in found}


def test_exact_duplicates_splits_buckets(spark):
    docs = docs_of(spark, [f"text {i}" for i in range(300)] + ["hot"] * 200)
    index = exact_dedup.build_index(docs, "text", 64, 20, 12)
    rows = index.collect()
    sizes = collections.Counter((r.depth_hx, r.bucket_hx) for r in rows)
    assert len(rows) == 301 and max(sizes.values()) <= 20 and max(r.depth_hx for r in rows) >= 4
    assert max(r.rows_hx for r in rows) == 200
    assert all((r.key_hx % 2**64) >> (64 - r.depth_hx) == r.bucket_hx for r in rows)


def test_exact_duplicates_carries_columns_and_takes_no_rows(spark):
    docs = docs_of(spark, ["a", "a"]).withColumnRenamed("source", "kept_source")
    assert "kept_source" in exact_dedup.exact_duplicates(docs, keep=("kept_source", "lang")).columns
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


# --- mixing


@pytest.mark.parametrize("weights", [{"a": 0.7, "b": 0.3}, {"a": 5.0, "b": 0.37, "c": 1.3}, {"a": 1 / 3}])
def test_mixture_keeps_every_window(spark, weights):
    sizes = {"a": 900, "b": 333, "c": 41, None: 17}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = mixing.mix(docs, weights, block_rows=5, chunk_slots=16).collect()
    assert sorted(r.doc_id for r in out) == [i for i, _ in rows]
    slots = {r.slot: (r.source, r.block, r.release, r.deadline) for r in out}
    assert sorted(slots) == list(range(len(slots)))
    assert all(release <= slot < deadline for slot, (_, _, release, deadline) in slots.items())
    # Less than one block from the fluid schedule at every slot.
    blocks = {s: math.ceil(n / 5) for s, n in sizes.items()}
    w = {s: weights.get(s, 1.0) for s in sizes}
    done, run, left = dict.fromkeys(sizes, 0.0), collections.Counter(), set(sizes)
    for slot in range(len(slots)):
        part = 1.0
        while part > 1e-12 and left:  # fluid progress of one slot, source by source running out
            total = sum(w[s] for s in left)
            step = min(part, min((blocks[s] - done[s]) * total / w[s] for s in left))
            for s in left:
                done[s] += step * w[s] / total
            part -= step
            left = {s for s in left if done[s] < blocks[s] - 1e-9}
        run[slots[slot][0]] += 1
        assert all(abs(run[s] - done[s]) < 1 + 1e-5 for s in sizes)


def slots_of(spark, mixture, chunk_slots=mixing.CHUNK_SLOTS):
    """The schedule of ``(weight, blocks)`` per source, each block within its window and each slot taken once."""
    rows = [(f"s{k}", False, float(w), n) for k, (w, n) in enumerate(mixture)]
    sources = spark.createDataFrame(rows, "source_mx string, null_mx boolean, weight double, blocks long")
    out = mixing.schedule(sources, chunk_slots).collect()
    assert sorted((r.source_mx, r.block) for r in out) == sorted((f"s{k}", j + 1) for k, (_, n) in enumerate(mixture) for j in range(n))
    assert sorted(r.slot for r in out) == list(range(len(out)))
    assert all(r.release <= r.slot < r.deadline for r in out)
    return out


def test_mixing_keeps_blocks_released_just_before_a_border(spark):
    rng = np.random.default_rng(5)
    mixtures = [
        [(2, 8), (2, 13), (5, 17), (5, 27), (0.5, 33), (0.5, 2), (4, 6)],
        [(0.5, 9), (0.5, 10), (1, 17), (4, 44), (2, 26), (2, 3)],
        [(3, 42), (0.5, 10), (3, 47), (0.5, 14)],
    ]
    for _ in range(20):
        weights = rng.choice([0.5, 1, 2, 3, 4, 5], rng.integers(2, 9)) if rng.random() < 0.7 else rng.uniform(0.2, 5, 5)
        mixtures.append([(w, int(rng.integers(1, 60))) for w in weights.tolist()])
    for mixture in mixtures:
        slots_of(spark, mixture, chunk_slots=8)
    # The weights of production, 20 sources of 10,000 rows: src0 and src1 meet in the last slot before 4864.
    slots_of(spark, [(TARGET_WEIGHTS.get(f"src{k}", 1.0), 625) for k in range(20)])


def test_mixing_odd_input(spark):
    docs = odd_rows(spark).withColumnRenamed("n_chars", "slot")
    out = mixing.mix(docs, {}, block_rows=2)
    assert out.count() == docs.count() and out.columns.count("slot") == 1
    assert mixing.mix(docs.limit(0), {}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0.0})
    assert [r.slot for r in mixing.in_order(out).collect()] == sorted(r.slot for r in out.collect())


def test_mixed_rows_keep_all_rows(spark):
    docs = odd_rows(spark)
    out = mixing.mixed_rows(docs, {"a": 2.0}, block_rows=2)
    assert sorted(map(repr, out.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    places = [(r.slot, r.in_block) for r in out.collect()]
    assert places == sorted(places) and len(set(places)) == len(places)
    assert mixing.mixed_rows(docs.limit(0), {}).count() == 0


# --- fingerprints


def test_fingerprints(spark):
    docs = odd_rows(spark)
    out = fingerprints.compare_neighbours(docs).collect()
    rows = docs.collect()
    assert len(out) == len(rows)
    texts = collections.defaultdict(set)
    for r in rows:
        texts[r.doc_id].add(r.text or "")
    sets = lambda t: set(re.findall(r"[^\n]{1,128}", t))
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    ids = [8, 7, 6, 5]  # unique ids, whose next is the id below
    for r in out:
        if r.doc_id in ids:
            (own,), nexts = texts[r.doc_id], texts[r.doc_id - 1]
            half = len(own) // 2
            for following in nexts:
                edited = own[: len(own) - half] + following[:half]
                if hashlib.sha256(edited.encode()).hexdigest() == r.edited_sha256:
                    assert r.n_chars == len(own)
                    assert math.isclose(r.near_edited, like(sets(own), sets(edited)))
                    assert math.isclose(r.near_next, like(sets(own), sets(following)))
                    break
            else:
                raise AssertionError(r)
    by = collections.defaultdict(set)
    for r in out:
        by[r.doc_id].add(r.fingerprint)
    assert len(by[4]) == 1 and by[1] == by[2]  # equal texts, equal fingerprints; null is empty
    assert fingerprints.compare_neighbours(docs.limit(0)).count() == 0
    one = fingerprints.compare_neighbours(docs_of(spark, ["abcd"])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0


def test_differences_are_recovered_with_retries(spark):
    rows = [(i, list(range(i * 100, i * 100 + a)), list(range(i * 100 + 3, i * 100 + b))) for i, (a, b) in enumerate([(5, 5), (60, 90), (0, 40), (500, 4)])]
    pairs = spark.createDataFrame(rows, "pair long, x array<long>, y array<long>")
    found = {r.pair: r for r in fingerprints.differences(pairs, ["pair"], "x", "y", cells=6).collect()}
    for i, x, y in rows:
        assert set(found[i].gone) == set(x) - set(y) and set(found[i].new) == set(y) - set(x)


# --- language


def test_language_odd_input_and_spans(spark):
    words_of = {"en": "the of and with under house water", "de": "und der nicht über schön straße", "ru": "привет мир дом вода"}
    rows = [(i, " ".join(words_of[lang].split()[k % 4 :] * 6), lang) for i, (lang, k) in enumerate((la, k) for la in words_of for k in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.names == ("de", "en", "ru")
    mixed = "the house under water the house and water " + "привет мир дом " * 4
    odd = [(1, mixed, 0.5), (2, None, 1.0), (3, "", 1.0), (4, "123 !?", 0.0), (5, "x" * 200_000, 0.0), (6, "дом", 0.0)]
    odd_docs = spark.createDataFrame(odd, "doc_id long, text string, score double")
    out = {r.doc_id: r for r in language.label(odd_docs, model).collect()}
    assert [out[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and out[6].lang_pred == "ru"
    spans = out[1].spans
    assert [s.lang for s in spans] == ["en", "ru"]
    data = mixed.encode()
    assert data[spans[0].start : spans[0].end].decode() == mixed[:41].rstrip() and "привет" in data[spans[1].start :].decode()
    assert all(0 <= r.score <= 1 for r in out.values())
    accuracy = [r.lang_pred == rows[r.doc_id][2] for r in language.predict(docs).collect()]
    assert sum(accuracy) / len(accuracy) > 0.97
    none = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.label(odd_docs, none).collect()} == {"und"}
    assert language.predict(docs.limit(0)).count() == 0


def test_viterbi_by_brute_force():
    rng = np.random.default_rng(5)
    counts = np.array([7, 0, 3, 5])
    scores = rng.normal(0, 12, (int(counts.sum()), 3)).astype(np.float32)
    state = language.viterbi(scores, counts)
    at = 0
    for n in counts:
        part = scores[at : at + n].astype(float)
        best = max(
            (sum(part[i, s] for i, s in enumerate(path)) - language.SWITCH_PENALTY * sum(a != b for a, b in zip(path, path[1:])), path)
            for path in np.ndindex(*[3] * n)
        )
        path = state[at : at + n]
        value = part[np.arange(n), path].sum() - language.SWITCH_PENALTY * (path[1:] != path[:-1]).sum()
        assert n == 0 or abs(value - best[0]) < 1e-3
        at += n


# --- toxicity


def test_toxicity_on_held_out_documents(spark):
    rng = np.random.default_rng(1)
    syllables = ["ta", "re", "mon", "li", "ko", "sha", "nu", "per", "dis", "vel"]
    plain = lambda n: ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)]
    rows, labels = [], []
    for i in range(600):
        text = plain(int(rng.integers(20, 120)))
        if i % 6 == 0:
            for _ in range(3):
                text.insert(int(rng.integers(len(text))), str(rng.choice(["blockhead", "nincompoop", "Scoundrel!"])))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "blockhead nincompoop blockhead")], "doc_id long, text string")
    given = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.predict(docs, given).collect()}
    held = [r for r in out.values() if r.held_out and r.doc_id is not None and r.doc_id < 600]
    right = [r.predicted == (r.doc_id % 6 == 0) for r in held]
    assert sum(right) / len(right) > 0.97 and all(0 <= r.score <= 1 for r in out.values())
    assert out[1000].score == out[1001].score and out[1000].predicted == 0 and not out[None].held_out
    assert toxicity.predict(docs.limit(0), given).count() == 0
    assert {r.score for r in toxicity.predict(docs, given.where("toxic = 0")).collect()} == {0.0}


def test_toxicity_replaces_a_column_of_its_name(spark):
    model = toxicity.ToxicityModel(b"", b"", (*[0.0] * len(toxicity.GAINS), -500.0))
    docs = spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, score string")
    assert toxicity.score(docs, model).dtypes[-1] == ("score", "double")


# --- language model


def test_lattice_by_brute_force(spark):
    table = pieces.load_pieces(MODEL)
    start = lattice_lm.prior(table)
    assert math.isclose(start.sum(), 1.0)
    logs = np.log(np.maximum(start, 1e-300))
    by_text = collections.defaultdict(float)
    for i, t in enumerate(table.texts):
        by_text[t] += start[i] if t else 0
    column = pa.array(["a", "the", "straße", "ab1", "日x"])
    lattice = pieces.Lattice(*lattice_lm._marked(column))
    alpha = lattice_lm.forward(table, logs, lattice)
    got = np.empty(len(column))
    got[lattice.order] = alpha[lattice.slot + lattice.length]
    for word, value in zip(column.to_pylist(), got):
        data = (" " + word).encode()
        total = [0.0] * len(data) + [1.0]
        for i in range(len(data) - 1, -1, -1):
            total[i] = sum(by_text.get(data[i:j], 0.0) * total[j] for j in range(i + 1, len(data) + 1))
        assert math.isclose(value, math.log(total[0]), rel_tol=1e-9)
    uses = lattice_lm.expected_uses(table, logs, lattice)
    sizes = np.array([len(t) for t in table.texts])
    assert math.isclose((uses * sizes).sum(), sum(len(w.as_py().encode()) + 1 for w in column), rel_tol=1e-9)


def test_language_model_figures(spark):
    docs = odd_rows(spark).unionByName(docs_of(spark, [f"alpha beta w{i % 7} gamma" for i in range(60)]))
    out = lattice_lm.score(docs, MODEL).collect()
    rows = docs.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = collections.Counter(w for r in rows if not held(r.doc_id) for w in [*words(r.text), None])
    n, v = sum(c.values()), len(c)
    want = sorted(
        (
            str(r.doc_id), held(r.doc_id), len(words(r.text)) + 1, sum(c[w] > 0 for w in [*words(r.text), None]), n,
            round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(r.text), None]), 5),
        )
        for r in rows
    )
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out)
    assert got == want and all(r.score < 0 and math.isfinite(r.score) for r in out)
    assert lattice_lm.score(docs.limit(0), MODEL).count() == 0


# --- quality


def test_quality_shrinks_sites(spark):
    rows = [(i, "a fine text of words", "h1" if i < 200 else "h2", "p") for i in range(400)]
    rows += [(1000, None, None, None), (1001, "", "h1", "q"), (None, "x", "h3", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, site string, path string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0 if i < 200 else i % 10 == 0)) for i in range(400)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    out = {r.doc_id: r for r in quality.score(docs, labels, F.col("site"), F.col("path")).collect()}
    assert len(out) == 403 and out[1000].host == ""
    good, bad = out[5], out[205]
    assert good.score > 0.6 > 0.4 > bad.score and good.host_posterior > 0.7 > 0.3 > bad.host_posterior
    # A site without other documents has its parent's rate.
    assert abs(out[None].path_posterior - out[None].host_posterior) < 1e-9
    assert all(0 <= r.score <= 1 for r in out.values())
    assert quality.score(docs.limit(0), labels, F.col("site"), F.col("path")).count() == 0
    unknown = quality.score(docs, labels.limit(0), F.col("site"), F.col("path")).collect()
    assert {round(r.evidence, 9) for r in unknown} == {0.5}


# --- near duplicates


def linked(rows):
    sets, owner = [], []
    for doc, text in rows:
        w = words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
        owner.append(doc)
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                part[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(owner):
        known = [x for x in (least.get(root(i)), doc) if x is not None]
        least[root(i)] = min(known) if known else None
    return sorted(((str(d), len(s), str(least[root(i)] if s else d)) for i, (d, s) in enumerate(zip(owner, sets))))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_join_with_a_large_group_and_a_common_passage(spark, seed):
    rng = np.random.default_rng(seed)
    word = lambda: "w" + str(rng.integers(5000))
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(70)]
    texts = []
    for _ in range(80):  # near copies around the threshold, far more than a short list holds
        text = list(base)
        for _ in range(int(rng.integers(0, 4))):
            text[int(rng.integers(len(text)))] = word()
        texts.append(" ".join(text))
    for _ in range(60):  # unrelated texts, mostly made of one passage
        texts.append(" ".join([word() for _ in range(int(rng.integers(3, 30)))] + passage))
    texts += [" ".join(word() for _ in range(int(rng.integers(1, 90)))) for _ in range(60)]
    texts += [None, "", "one two", "One TWO", "a b c d", "  ", texts[0], texts[0].upper(), "z " * 30_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "lonely text"), (None, texts[0]), (3, texts[3]), (3, "other words")]
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, component_id int").repartition(5)
    out = near_join.components(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == linked(rows)
    kept = near_join.one_of_each(docs).collect()
    groups = collections.Counter(c for d, n, c in linked(rows) if n and c != "None")
    single = [r for r in kept if words(r.text) and r.doc_id is not None]
    assert len(single) >= len(groups) and {str(r.doc_id) for r in single} == set(groups)
    assert len([r for r in kept if not words(r.text)]) == 3


def test_near_join_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_join.components(empty).count() == 0 and near_join.one_of_each(empty).count() == 0
