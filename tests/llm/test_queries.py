"""The registered queries with SQL against DuckDB, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from rateweave.llm import containment_search, pii_surrogates, quality_ftrl, queries, simhash_ball
from tests.conftest import SF001, SF01
from tests.llm.test_simhash_ball import brute_components, brute_fingerprint
from tests.test_oracle import _canon


def test_every_operator_is_registered():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF01}/{table}.parquet')")
    df = queries.QUERIES[name](spark, SF01)
    cur = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(cur.fetchall(), columns)


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    model = quality_ftrl.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    kept = [i for i, r in sorted(rows.items()) if model.score(quality_ftrl.features(r["text"])) >= 0.5]
    roots = brute_components([brute_fingerprint(rows[i]["text"]) for i in kept], simhash_ball.MAX_DISTANCE)
    kept = [i for at, i in enumerate(kept) if roots[at] == at]
    items = [containment_search.shingle_set(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    clean = []
    for i in kept:
        own = containment_search.shingle_set(rows[i]["text"])
        if not any(len(s & own) >= 0.8 * len(s) for s in items):
            clean.append(i)
    got = {r["doc_id"]: r.asDict() for r in corpus_pipeline.run(spark, SF001).collect()}
    assert sorted(got) == clean and 0 < len(clean) < len(kept) < len(rows)
    for i, r in got.items():
        entities = pii_surrogates.detect(rows[i]["text"])
        assert (r["text"] == rows[i]["text"]) == (not entities)
        assert r["n_chars"] == len(r["text"]) and r["parity"] and r["round_trip"] and r["n_tokens"] == len(r["token_ids"])
        assert (r["lang"], r["source"]) == (rows[i]["lang"], rows[i]["source"])


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, SF001)
        assert done.count() == 0 and (n == 4 or done.columns == docs.columns)


def test_stages_on_odd_rows(spark, docs_of, tmp_path):
    """Nulls, repeated rows, empty and long texts, columns with names used inside: every stage keeps
    what it should, whole."""
    prose = "some plain words of prose that stand here for a good text and mean little"
    leak = "this very item of a benchmark must never be seen in a training text at all"
    rows = [(1, None), (2, ""), (None, prose), (None, prose), (3, prose), (4, prose), (4, prose), (5, "x " * 70_000)]
    rows += [(6, f"before {leak.upper()}! after"), (7, "mail jo@ex.org please, or not at all if you like that better")]
    docs = docs_of(rows)
    spark.createDataFrame([(1, leak), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0), (6, 1, None), (2, None, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    def texts(df):
        return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)

    assert texts(stages[0](spark, docs, str(tmp_path))) == sorted(rows, key=repr)  # no label 0: all are good
    deduped = stages[1](spark, docs, str(tmp_path))
    assert texts(deduped) == sorted([(1, None), (3, prose), *rows[7:]], key=repr)
    assert texts(stages[2](spark, docs, str(tmp_path))) == sorted(rows[:8] + rows[9:], key=repr)
    replaced = stages[3](spark, docs, str(tmp_path))
    assert {r[1] for r in texts(replaced)} - {r[1] for r in rows} == {next(t for i, t in texts(replaced) if i == 7)}
    assert all(r["n_chars"] == len(r["text"] or "") for r in replaced.collect())
    for df in (deduped, replaced):
        assert df.columns == docs.columns and df.select("fp", "_id", "codes").distinct().collect() == [(7, 7, 7)]
    coded = {r["doc_id"]: r for r in stages[4](spark, docs, str(tmp_path)).collect()}
    assert coded[1]["n_tokens"] == coded[2]["n_tokens"] == 0 and all(r["round_trip"] for r in coded.values())
