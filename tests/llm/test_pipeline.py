import corpus_pipeline as pipeline
from ordermill.llm.base import stage

from test_leaks import brute
from test_simhash import fingerprint, groups


def test_stages_are_those_of_the_pipeline():
    assert [s[1].__name__ for s in pipeline.STAGES] == ["identified", "of_quality", "unlike", "unleaked", "encoded"]


def test_each_stage_on_its_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = {}
    for name, step in pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf), "test")
        assert docs.columns == list(pipeline.COLUMNS)
        rows[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    start = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows["language"]) >= 0.99 * len(start)
    assert not any(labels.get(d) == 0 for d in rows["quality"]) and all(d in rows["quality"] for d in rows["language"] if labels.get(d) == 1)
    given = sorted(rows["quality"].items())
    prints = [fingerprint(t) for _, t in given]
    assert set(rows["near_duplicates"]) == {given[i][0] for i, g in enumerate(groups(prints)) if g == i}
    leaked = brute(rows["near_duplicates"].items(), bench)
    assert set(rows["decontamination"]) == {d for d, items in leaked.items() if not items}
    last = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in last} == set(rows["decontamination"])
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in last)


def test_one_row_of_a_class_stays(spark, docs):
    text = "one two three four five six seven"
    rows = docs((4, text), (2, text), (2, text), (2, text.upper()), (None, text), (7, "quite another text it is this time"), (None, "nothing like the others at all here"), (None, "nothing like the others at all here"))
    kept = sorted((str(r["doc_id"]), r["text"].lower()) for r in pipeline.unlike(spark, rows, "").collect())
    assert kept == [("2", text), ("7", "quite another text it is this time"), ("None", "nothing like the others at all here")]
    assert pipeline.unlike(spark, rows.limit(0), "").count() == 0


def test_every_class_keeps_one_row_whatever_its_ids(spark, docs):
    texts = ["first text with some words of its own", "second one that says other things", "third of them and unlike both"]
    rows = docs(*[(None, t) for t in texts], (3, "copied here and there in the rows"), (5, "copied here and there in the rows"), (5, "what only this row of five has"))
    kept = sorted((str(r["doc_id"]), r["text"]) for r in pipeline.unlike(spark, rows, "").collect())
    assert kept == sorted([("None", t) for t in texts] + [("3", "copied here and there in the rows"), ("5", "what only this row of five has")])


def test_the_leak_index_is_fitted_on_all_documents(spark, docs, sf, monkeypatch):
    from ordermill.llm import leaks

    whole, fitted = leaks._gram, []

    def gram(some, *rest):
        fitted.append(some.count())
        return whole(some, *rest)

    monkeypatch.setattr(leaks, "_gram", gram)
    pipeline.unleaked(spark, docs(*((i, f"a b c {i}") for i in range(1600))), sf)
    assert fitted and all(n == 1600 for n in fitted)
