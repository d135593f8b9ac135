"""The pipeline's stages against the operators' own verdicts, and the registered text queries."""

import os
from types import SimpleNamespace

import duckdb
import pyarrow as pa
import pytest
from brute import brute_matches, jaccard_roots

import __spark_entry__
import corpus_pipeline
from gridlake.llm import queries, quality_rules, suffixes
from gridlake.llm.runtime import documents

TABLES = "documents benchmark labels conversations embeddings"


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark, sf):
    docs = documents(spark, sf)
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, sf)
    assert ids(good) == ids(quality_rules.quality_report(docs).where("kept"))
    single = stages["simhash_near_dedup"](spark, good, sf)
    kept = sorted((r["doc_id"], r["text"]) for r in good.select("doc_id", "text").collect())
    assert ids(single) == {kept[k][0] for k in jaccard_roots([t for _, t in kept])}
    clean = stages["benchmark_decontamination"](spark, single, sf)
    texts, items = ([tuple(r) for r in df.collect()] for df in (single.select("doc_id", "text"), documents(spark, sf, "benchmark").select("item_id", "text")))
    assert ids(clean) == {r[0] for r in brute_matches(texts, items) if not r[-1]}
    safe = stages["secret_scan"](spark, clean, sf)
    assert ids(safe) == ids(clean) and all(df.columns == docs.columns for df in (good, single, clean, safe))
    assert stages["byte_bpe"](spark, safe, sf).count() == safe.count()


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() <= documents(spark, sf).count()
    assert out.where("octet_length(ids) <> 4 * n_tokens").count() == 0


def test_stages_take_an_empty_table(spark, sf):
    docs = documents(spark, sf).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_stages_on_awkward_rows(spark, sf):
    """Null, empty, very long and repeated texts, null ids and columns whose names the stages use themselves."""
    long = "word " * 20_000 + "token = 'abcdef123456'"
    rows = [(1, None), (2, ""), (3, "some words that are said here"), (3, "some words that are said here"), (4, long), (5, long + " and"), (None, "no id but words enough to be a text"), (6, " \n\t "), (7, "secret: hunter22 and more"), (8, "Ünï¢ødé 漢字 🎉")]
    clash = {"lang": "en", "source": "s", "n_chars": 5, "node": 1, "root": 2, "keys": "k", "fingerprint": 3, "spans": "x", "base": "b", "found": 4, "n_words": 6, "kept": False, "ids": "i", "own_id": 7, "is_first": True, "text_hash": 8}
    docs = spark.createDataFrame([(*r, *clash.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, node int, root int, keys string, fingerprint int, spans string, base string, found int, n_words int, kept boolean, ids string, own_id int, is_first boolean, text_hash int")
    out = {name: stage(spark, docs, sf) for name, stage in corpus_pipeline.STAGES}
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert out[name].columns == docs.columns, name
        assert {tuple(r)[2:4] for r in out[name].collect()} <= {("en", "s")}
    assert ids(out["quality_rules"]) <= {3, 4, 5, 7, 8, None}
    near = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out["simhash_near_dedup"].collect())
    assert near == [(False, i) for i in (1, 3, 4, 7, 8)] + [(True, 0)]
    assert len(out["benchmark_decontamination"].collect()) == len(rows)
    cut = {r["doc_id"]: r for r in out["secret_scan"].collect()}
    assert cut[4]["text"] == "word " * 20_000 + "[SECRET]'" and cut[7]["text"] == "[SECRET] and more" and cut[1]["text"] is None
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in cut.values())
    coded = [r for r in out["byte_bpe"].collect()]
    assert len(coded) == len(rows) and {r["n_tokens"] for r in coded if r["doc_id"] in (1, 2)} == {0}


def test_rated_sample_needs_no_python_worker(spark, sf):
    """The sample that rules are rated on is a table of the JVM: pickled rows start Python workers on the executors."""
    plans = []

    def rated(sample, rules):
        plans.append(sample._jdf.queryExecution().toString())
        return [quality_rules.Rating(r, 0.5, 1.0) for r in rules]

    quality_rules.cascade_order(documents(spark, sf), quality_rules.BASE_RULES, rated=rated)
    assert len(plans) == 1 and "LocalTableScan" in plans[0] and "ExistingRDD" not in plans[0]


def test_decontamination_puts_out_little_text_at_once(spark, sf):
    """However many rows Spark sends at once, a task looks at and gives back half a megabyte of text."""
    docs = SimpleNamespace(schema=None, mapInArrow=lambda cleaned, schema: cleaned)
    cleaned = suffixes.decontaminated(docs, documents(spark, sf, "benchmark"))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": ["word " * 2000] * 300})
    parts = list(cleaned([batch]))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and max(p.nbytes for p in parts) < 1 << 20


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twins(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES.split():
        files = f"{sf}/{table}.parquet"
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{files}{'/*.parquet' if os.path.isdir(files) else ''}')")
    found, twin = queries.QUERIES[name](spark, sf), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(twin.columns)
    assert sorted(map(str, ([r[c] for c in columns] for r in found.collect()))) == sorted(map(str, map(list, twin.select(*columns).fetchall())))


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
