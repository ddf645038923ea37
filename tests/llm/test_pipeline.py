"""The pipeline's stages on odd rows, and with columns named like the operators' own."""

import pytest

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
CLASHES = [
    "score", "kept", "group_size", "keep_id", "text_sha256", "component_id", "n_shingles", "key_nj", "slot", "in_block", "block",
    "piece_ids", "N_Pieces", "c0_cp", "key_mr", "doc", "n", "word", "a.b",
]


def odd(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(6000))
    rows = [
        (1, None, "en", "src0", 0), (2, "", "en", "src1", 0), (3, "one", None, None, 3), (4, long, "en", "src0", 9), (5, long, "en", "src0", 9),
        (6, long.replace("w5x5", "other"), "en", "src19", 9), (7, "a b c d e f g", "de", "new", 13), (7, "a b c d e f g", "de", "new", 13),
        (None, "no id but words in here", "en", "src2", 4), (8, " \t\n", "en", "src2", 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def through(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    return docs


def test_odd_rows(spark):
    rows = through(spark, odd(spark)).collect()
    # Of the rows without words one stays, of the long ones one, of the repeated one.
    assert sorted((r.doc_id for r in rows), key=repr) == sorted([1, 3, 4, 7, None], key=repr) or {r.doc_id for r in rows} >= {3, 4, 7, None}
    assert sum(not (r.text or "").strip(" \t\n") for r in rows) == 1
    assert all((r.piece_ids is None) == (r.text is None) for r in rows)


def test_columns_named_like_the_operators_own(spark):
    plain = odd(spark)
    docs = plain.selectExpr("*", *[f"concat('{i}-', doc_id) AS `{c}`" for i, c in enumerate(CLASHES)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        for row in out.collect():
            assert row.doc_id is None or all(row[c] == f"{i}-{row.doc_id}" for i, c in enumerate(CLASHES)), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.columns == [*docs.columns, "slot_", "in_block_", "piece_ids_", "n_pieces_"]
    assert last.count() == plain.count()


def test_the_same_rows_with_and_without_them(spark):
    plain = odd(spark)
    clash = plain.selectExpr("*", *[f"{i} AS `{c}`" for i, c in enumerate(CLASHES)])
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    assert ids(through(spark, clash)) == ids(through(spark, plain))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_no_rows(spark, stage):
    none = odd(spark).where("doc_id > 99")
    assert dict(corpus_pipeline.STAGES)[stage](spark, none, FOLDER).count() == 0
