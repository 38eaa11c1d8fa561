"""Every stage of the corpus pipeline on edge rows, with clashing extra columns, and on no rows."""

import pytest
from edge_rows import EDGE, LONG

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, kept string, spans int, ids string, component_id int, chunk int, bucket int")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, "en", "src", len(t or ""), 0.5, "k", 1, "x", 2, 3, 4) for i, t in EDGE], SCHEMA)


def found(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_near_copies_stay_once(spark, rows):
    out = P.drop_near_copies(spark, rows, SF)
    assert tuple(out.columns) == P.COLUMNS
    kept = [i for i, _ in found(out)]
    assert sorted(i for i in kept if i) == [1, 2, 3, 4, 6, 8, 9, 11] and kept.count(None) == 1


def test_repeats_are_cut(spark, rows):
    out = P.cut_repeats(spark, rows, SF)
    assert tuple(out.columns) == P.COLUMNS
    got = found(out)
    assert sorted(got, key=repr) == sorted(((i, "" if i == 7 else t) for i, t in EDGE), key=repr)
    assert {r["n_chars"] for r in out.where("doc_id IN (1, 2, 7)").collect()} == {0}
    assert out.where("doc_id = 6").first()["n_chars"] == len(LONG)


def test_clean_rows_pass_decontamination(spark, rows):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    bad = spark.createDataFrame([(50, item, "en", "src", 1), (51, "before " + item + " after", None, None, None)], rows.schema[:5])
    out = P.drop_contaminated(spark, rows.select(*P.COLUMNS).unionByName(bad), SF)
    assert tuple(out.columns) == P.COLUMNS and found(out) == sorted(EDGE, key=repr)


def test_every_row_is_tokenized(spark, rows):
    out = P.tokenize(spark, rows, SF).collect()
    assert len(out) == len(EDGE) and all(r["exact"] for r in out)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (1, 2)} == {0}


def test_no_rows(spark, rows):
    for name, stage in P.STAGES:
        assert stage(spark, rows.where("false"), SF).count() == 0, name
