import duckdb
import pytest
from corpus import clashing, empty, frame, rows, same

from sensorlake.llm.mixture import emit, mix_sources
from sensorlake.llm.oracle import mix_sql


@pytest.fixture(scope="module")
def mixed(spark):
    return mix_sources(clashing(frame(spark), "size", "target", "pad")).cache()


def test_mix_matches_sql(spark, mixed):
    import pandas as pd

    docs = pd.DataFrame(rows(), columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("docs", docs)
    want = con.execute(f"WITH {mix_sql('docs')} SELECT doc_id, size, source_size, target, size * copies FROM mixed").fetchall()
    got = mixed.select("doc_id", "size", "source_size", "target", "taken").collect()
    rounded = lambda rs: [(*r[:3], round(r[3], 6), r[4]) for r in rs]
    same(rounded(got), rounded(want))


def test_targets_are_capped_and_use_the_whole_share(mixed):
    per = {r["source"]: (r["source_size"], r["target"]) for r in mixed.collect()}
    sizes = sum(s for s, _ in per.values())
    assert all(t <= 2 * s + 1e-9 for s, t in per.values())
    assert sum(t for _, t in per.values()) == pytest.approx(1.5 * sizes)
    assert all(r["taken"] <= 2 * r["size"] for r in mixed.collect())


def test_taken_words_come_near_the_target(spark):
    docs = [(i, "w " * (20 + i % 30), "en", f"s{i % 4}", 1) for i in range(4000)]
    df = mix_sources(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"))
    for r in df.groupBy("source", "target").agg({"taken": "sum"}).collect():
        assert r["sum(taken)"] == pytest.approx(r["target"], rel=0.06)


def test_emit_repeats_documents(mixed):
    copies = {}
    for r in emit(mixed).collect():
        copies[(r["doc_id"], r["text"])] = copies.get((r["doc_id"], r["text"]), 0) + 1
    want = {}
    for r in mixed.collect():
        if r["copies"]:
            want[(r["doc_id"], r["text"])] = want.get((r["doc_id"], r["text"]), 0) + r["copies"]
    assert copies == want


def test_empty(spark):
    assert mix_sources(empty(spark)).count() == 0
