"""The corpus pipeline: every stage's contract on the smallest tables, and the registered queries."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_frame, words
from tidemart.llm.queries import ORACLE, QUERIES
from tools.oracle_check import TABLES, rows_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_all_queries_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got, want = QUERIES[name](spark, SF_SMALL).toPandas(), duck.sql(ORACLE[name]).df()
    assert rows_of(got) == rows_of(want)


def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.collect()
        seen[name] = rows
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r.n_chars == len(r.text) for r in rows if name in ("quality_rules", "line_dedup"))
            docs = spark.createDataFrame(rows, out.schema)
    ids = {k: [r.doc_id for r in v] for k, v in seen.items()}
    assert set(ids["line_dedup"]) == set(ids["quality_rules"]) and len(ids["line_dedup"]) == len(ids["quality_rules"])
    assert set(ids["simhash_near_dedup"]) <= set(ids["line_dedup"])
    assert len(set(ids["simhash_near_dedup"])) == len(ids["simhash_near_dedup"])
    assert set(ids["mixing"]) <= set(ids["simhash_near_dedup"])
    assert max(ids["mixing"].count(i) for i in set(ids["mixing"])) <= 3
    assert sorted(i for i in ids["mixing"]) == sorted(r.doc_id for r in seen["best_fit_packing"] if r.piece == 0)


def test_run_equals_its_stages(spark):
    """The rows of ``run`` are those of the stages applied by hand, each on all that the one before it kept."""
    out = corpus_pipeline.run(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        last = stage(spark, docs, SF_SMALL)
        docs = spark.createDataFrame(last.collect(), last.schema)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]  # where a piece lies may differ from run to run
    got, want = (sorted(map(tuple, d.select(*pieces).collect())) for d in (out, docs))
    assert got == want and got
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text + " more", None), (4, "z " * 30_000)]
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs_frame(spark, rows), SF_SMALL)
    got = out.collect()
    if name == "quality_rules":
        assert sorted(len(words(r.text)) for r in got) == [80, 80, 81]
    elif name == "line_dedup":
        assert len(got) == len(rows)
    elif name == "simhash_near_dedup":
        assert len([r for r in got if r.doc_id == 1]) == 1
    assert out.columns == docs_frame(spark, rows).columns or name == "best_fit_packing"
    assert stage(spark, docs_frame(spark, []), SF_SMALL).collect() == []
