import duckdb
import public_tokenizers
import pytest

import corpus_pipeline as cp
from tests.llm import test_line_dedup, test_near_dedup, test_sentencepiece
from trendspark.llm import decontaminate as dc
from trendspark.llm import sentencepiece as sp
from trendspark.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in bad]
    rows = [(i, t) for i, gone, t in test_line_dedup.brute(rows) if not gone or (t or "").split()]
    kept = test_near_dedup.brute(rows)
    rows = [(i, t) for i, t in rows if kept[i][1] == i]
    con = duckdb.connect()
    con.register("docs", spark.createDataFrame(rows, "doc_id long, text string").toPandas())
    con.execute(f"create view items as select * from '{SF}/benchmark.parquet'")
    leaks = {r[0] for r in con.execute(dc.oracle("docs", "items")).fetchall() if r[1]}
    p = sp.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: None if t is None else test_sentencepiece.brute(p, t) for i, t in rows if i not in leaks}
    out = cp.run(spark, SF).collect()
    assert len(out) == len(want) < docs.count() and len(bad) and len(leaks)
    assert {r.doc_id: None if r.ids is None else list(r.ids) for r in out} == want
    assert all(r.round_trip for r in out)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, k):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a line", None, "s", 6), (3, "Some  text.\nMore", "en", None, 16)]
    name, stage = cp.STAGES[k]
    for some in (rows, []):
        df = spark.createDataFrame(some, schema)
        out = stage(spark, df, SF)
        assert k == 4 or out.schema.names == schema.names
        assert len(out.collect()) == len(some)


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_of_any_name_repeated_rows_and_long_texts(spark, k):
    """Columns named like those that the operators make, equal rows, two rows of one id, a very long text, a null id."""
    base = spark.read.parquet(f"{SF}/documents.parquet").schema
    odd = ["score", "items", "contaminated", "h", "kept", "component", "node", "__x", "lines_removed", "bucket", "text2"]
    rows = [(1, "One  line here, rather long for its kind.\nMore", "en", "s", 16), (2, "word " * 60_000, "en", "s", 300_000), (3, "same id", "en", "s", 7),
            (3, "other text", "en", "s", 10), (4, "alone in the world", "en", "s", 18), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, base).selectExpr("*", *[f"concat('own ', doc_id) as `{c}`" for c in odd])
    name, stage = cp.STAGES[k]
    out = stage(spark, df, SF)
    assert out.columns == df.columns
    got = out.collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, None} and len(got) == len(rows)
    assert all(r[c] == (None if r.doc_id is None else f"own {r.doc_id}") for r in got for c in odd)
    twice = stage(spark, df.union(df), SF).collect()
    assert {r.doc_id for r in twice} == {1, 2, 3, 4, None}


def test_near_stage_takes_pairs_from_four_fifths(spark):
    """9 of 11 shingles are shared (0.82): below op4's 0.85, above the stage's 0.8; 7 of 9 (0.78) is below both."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = []
    for first, n, name in ((1, 14, "w"), (11, 12, "v")):
        words = [f"{name}{i}" for i in range(n)]
        rows += [(first, " ".join(words), "en", "s", 0), (first + 1, " ".join(words[:-1] + ["other"]), "en", "s", 0)]
    want = test_near_dedup.brute([r[:2] for r in rows], num=80)
    out = cp.near(spark, spark.createDataFrame(rows, schema), SF)
    assert {r.doc_id for r in out.collect()} == {i for i, (_, c) in want.items() if i == c} == {1, 11, 12}
