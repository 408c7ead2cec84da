"""The pipeline, stage by stage, and the registered queries."""

import collections
import pathlib

import __spark_entry__ as entry
import corpus_pipeline
from edge import SF, documents, edge_docs
from test_free import alike, bag, hits
import duckdb
from encore.session import checkpoint_dir


def test_stages_against_brute_force(spark):
    rows = documents()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    names, kept = [], {}
    for name, stage in corpus_pipeline.STAGES:
        names.append(name)
        docs_out = stage(spark, docs, SF)
        if name != "token_records":
            assert docs_out.columns == docs.columns
        docs = corpus_pipeline.cut(docs_out, f"test-{name}")
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    text = {d: t for d, t, _, _ in rows}
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "token_records"]
    toxic = duckdb.sql(f"select doc_id from '{SF}/labels.parquet' where toxic = 0").fetchall()
    assert {d for d, in toxic} <= set(kept["toxicity"])  # clean documents stay
    bags = {d: bag(text[d]) for d in kept["toxicity"]}
    left = set(kept["near_dedup"])
    for d in kept["toxicity"]:
        near = [e for e in left if e != d and alike(bags[d], bags[e]) >= 0.8]
        assert bool(near) != (d in left) or not near and d in left
    assert set(kept["decontamination"]) == {d for d in left if not hits(text[d], items, 10)[-1]}
    assert set(kept["mixing"]) <= set(kept["decontamination"])
    assert collections.Counter(kept["token_records"]) == collections.Counter(kept["mixing"])
    got = sorted(tuple(r) for r in docs.collect())
    assert [r[1] for r in sorted(got, key=lambda r: r[1])][0] == 0


def test_run_gives_the_last_stage(spark):
    folder = pathlib.Path(checkpoint_dir(spark)) / "llm"
    before = set(folder.iterdir()) if folder.exists() else set()
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and rows.count() > 0
    stages = {f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES}
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert left & stages == {"pipeline-token_records"} and len(left) == 1  # nothing else is left behind


def test_stages_take_odd_rows(spark):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= 1, name
        assert stage(spark, edge_docs(spark, []), SF).count() == 0, name


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
