import duckdb
import pytest

from trendspark.llm import decontaminate as dc

ITEMS = [
    (1, "A train leaves Boston at 60 km per hour and reaches Denver after 12 hours. How far from Boston is Denver?"),
    (2, "Which quiet river crosses the old valley before it meets the wide grey sea at dawn"),
    (3, "too short here"), (4, None), (5, "1 2 3 4 5 6 7 8"), (None, "which quiet river crosses the old valley before it meets"),
    (6, "Compute 5 plus 5 minus 3 and then divide the whole result by 5 please"),
    (8, "What is 12 + 7 - 3 * 4 / 2 ?"), (9, "Anna Bert Carl Dora Emil Frida Gustav"), (10, "Name the six moons known here"), (11, ""),
]
DOCS = [
    (1, "noise " * 30 + ITEMS[0][1] + " noise" * 30, [1]),  # as it is
    (2, "Intro. A train leaves Paris at 95 miles per hour and reaches Rome after 7 minutes. How far from Paris is Rome?", [1]),
    (3, "Intro. A train leaves Paris at 95 km per hour and reaches Rome after 7 hours. How far from Milan is Rome?", [1]),  # Boston met two names, once
    (16, "A train leaves Paris at 95 km and a bus leaves Oslo at 9 km per hour. How far is it from Milan?", []),
    (4, "text and Which QUIET river,crosses the (old) valley -- before it\nmeets the wide grey  sea at dawn.", []),  # joined words: other windows
    (5, "text and Which QUIET river crosses the (old) valley -- before it\nmeets the wide grey  sea at dawn.", [2]),
    (6, "which quiet river crosses the old valley", []),  # too little of it
    (7, None, []), (8, "", []), (9, " \n\t", []), (10, "It is too short here, he said", [3]), (11, "first 1 2 3 4 5 6 7 8 9", [5]),
    (17, "11 12 13 14 15 16 17 18", []), (18, "too shortly here", []), (19, "What is 12 + 7 - 3 * 4 / 2 ? he asked", [8]), (20, "What is 12 + 8 - 3 * 4 / 2 ?", [8]),
    (21, "What is 13 + 8 - 1 * 5 / 9 ?", []), (22, "seen were Anna Bert Carl Dora Emil Frida Gustav", [9]),
    (23, "which quiet river crosses the old meadow before it meets the wide grey sea at dawn", [2]),  # one word changed
    (24, "which quiet river crosses the old valley then before it meets the wide grey sea at dawn", [2]),  # one put in
    (25, "which quiet river crosses the old before it meets the wide grey sea at dawn", [2]),  # one left out
    (26, "which quiet river crosses the new meadow under it meets the wide red sea at dawn", []),
    (27, "name the six moons known here", [10]), (28, "name the six suns known here", [10]), (29, "name a six suns known here", []),
    (12, ("the old valley before it meets " * 500), []),
    (13, "Compute 8 plus 8 minus 4 and then divide the whole result by 8 please", [6]),
    (14, "Compute 8 plus 9 minus 4 and then divide the whole result by 8 please", []),
    (15, ITEMS[1][1] + ". " + ITEMS[0][1], [1, 2]),
]


def test_cases_and_oracle(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in DOCS] + [(None, ITEMS[1][1])], "doc_id long, text string").selectExpr("*", "1 as h", "2 as items")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "3 as doc_id")
    out = dc.decontaminate(docs, items)
    assert out.columns == ["doc_id", "text", "h", "items", "contaminated"]
    got = {r.doc_id: list(r["items"]) for r in out.collect()}
    assert got == {i: want for i, _, want in DOCS} | {None: []}
    con = duckdb.connect()
    for name, df in (("documents", docs), ("benchmark", items)):
        con.register(name, df.select(df.columns[0], "text").toPandas().astype({df.columns[0]: "Int64"}))
    assert {r[0]: r[2] for r in con.execute(dc.oracle()).fetchall()} == got
    assert all(r[1] == bool(r[2]) for r in con.execute(dc.oracle()).fetchall())


def test_no_cut_at_any_length(spark):
    """Every item with one word changed, its first 60 % (13 words or more of it), its copy; a corpus without them stays clean."""
    b = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items, docs = {r.item_id: r.text for r in b.collect()}, []
    want = {}
    for i, text in items.items():
        w = text.split()
        for k, changed in enumerate((w[:len(w) // 2] + ["zzyzx"] + w[len(w) // 2 + 1:], w[:-(-6 * len(w) // 10)], w)):
            docs.append((10 * i + k, "Some words before it and " + " ".join(changed) + " and some words behind it."))
            want[10 * i + k] = k != 1 or len(changed) > 15
    out = {r.doc_id: (r.contaminated, list(r["items"])) for r in
           dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), b).collect()}
    assert all(i // 10 in out[i][1] for i, found in want.items() if found)
    clean = [(i, " ".join(reversed(t.split()))) for i, t in items.items()]
    out = dc.decontaminate(spark.createDataFrame(clean, "doc_id long, text string"), b)
    assert out.where("contaminated").count() == 0


def test_repeated_ids_and_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(1, ITEMS[1][1]), (1, "clean"), (2, "clean")], "doc_id long, text string")
    assert sorted((r.doc_id, r.contaminated) for r in dc.decontaminate(docs, items).collect()) == [(1, True), (1, True), (2, False)]
    assert dc.decontaminate(docs.limit(0), items).collect() == []
    assert {r.contaminated for r in dc.decontaminate(docs, items.limit(0)).collect()} == {False}


@pytest.mark.parametrize("joined", [True, False])
def test_plan_is_native_and_has_no_cross_join(spark, joined, capsys, monkeypatch):
    if not joined:
        monkeypatch.setattr(dc, "fits", lambda *a, **k: False)
    docs = spark.createDataFrame([(i, t) for i, t, _ in DOCS], "doc_id long, text string")
    out = dc.decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    out.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert {r.doc_id for r in out.where("contaminated").collect()} == {i for i, _, want in DOCS if want}
