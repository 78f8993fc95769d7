"""Every stage against brute force on its own input, and run() against the
stages."""

import hashlib

import duckdb
import pandas as pd
import pytest
from corpus import SCHEMA, empty, frame, same

import corpus_pipeline
from sensorlake.llm import toxicity
from sensorlake.llm.oracle import hits_sql, mix_sql
from test_jaccard_join import brute as brute_groups
from test_substring_dedup import brute as brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        new = f(spark, docs, SF).cache()
        out.append((name, docs, new))
        docs = new
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_are_as_listed(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "mixture"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_toxicity_drops_what_the_machine_rejects(spark, stages):
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(~toxicity.held_out("doc_id", 5, 0))
    machine = toxicity.fit(before, labels)
    keep = [r for r in rows(before) if machine.probability(toxicity.features(r[1])) < 0.5]
    same(rows(after), keep)


def test_one_of_each_group(stages):
    _, before, after = stages[1]
    data = rows(before)
    keep = [r for r, (i, n, c) in zip(data, brute_groups(data)) if not n or i == c]
    same(rows(after), keep)


def test_repeats_are_cut(stages):
    _, before, after = stages[2]
    want = {r[0]: r for r in brute_spans(rows(before))}
    texts = {r[0]: r for r in rows(before)}
    got = rows(after)
    assert len(got) == len(texts)
    for r in got:
        kept = " ".join((r[1] or "").encode().decode().split()).encode()
        assert hashlib.sha256(kept).hexdigest() == want[r[0]][3]
        if want[r[0]][2]:
            assert r[4] == len(r[1])
        else:
            assert r == texts[r[0]]


def test_contaminated_documents_go(stages):
    _, before, after = stages[3]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    data = rows(before)
    con.register("docs", pd.DataFrame([(n, r[0], r[1]) for n, r in enumerate(data)], columns=["n", "doc_id", "text"]))
    hit = {n for (n,) in con.execute(f"WITH {hits_sql('docs')} SELECT n FROM judged WHERE n_hit > 0").fetchall()}
    same(rows(after), [r for n, r in enumerate(data) if n not in hit])


def test_mixture_takes_copies(stages):
    _, before, after = stages[4]
    con = duckdb.connect()
    con.register("docs", pd.DataFrame(rows(before), columns=["doc_id", "text", "lang", "source", "n_chars"]))
    want = con.execute(f"WITH {mix_sql('docs')} SELECT doc_id, unnest(range(1, copies + 1)) FROM mixed").fetchall()
    same([(r["doc_id"], r["copy"]) for r in after.collect()], want)


def test_run_applies_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    same(rows(got), rows(stages[-1][2]))


def test_awkward_and_empty_documents(spark):
    for docs in (frame(spark), empty(spark)):
        for _, f in corpus_pipeline.STAGES:
            before, docs = docs, f(spark, docs, SF).cache()
            assert docs.columns[:5] == before.columns[:5] == [c.split()[0] for c in SCHEMA.split(", ")]
    assert docs.count() == 0
