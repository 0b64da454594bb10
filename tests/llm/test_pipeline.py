"""The pipeline and the registered queries with SQL."""

import pytest
from check_oracles import compare, connect
from helpers import HARD, documents, prose

import __spark_entry__ as contract
import corpus_pipeline
from twinloom.llm import language, near_dedup, queries


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_gives_what_its_sql_gives(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir).execute(queries.ORACLES[name])) is None


def test_stages_one_after_the_other(spark, tmp_path):
    """Each stage is held against what it should do with its own input."""
    rows = [(k, "the and of " + prose(k, 60, "aeinorst"), "en") for k in range(40)]
    rows += [(100 + k, rows[k][1], "en") for k in range(10)] + [(200 + k, rows[k][1] + " more", "en") for k in range(5)]
    rows += [(300 + k, "der die das " + prose(k, 60, "äöüwkzchs"), "de") for k in range(20)]
    docs = documents(spark, [*rows, *HARD])
    spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(300 + k, 0, 0) for k in range(10)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    current = docs
    for name, stage in corpus_pipeline.STAGES:
        before = current.collect()
        current = stage(spark, current, str(tmp_path))
        after = current.collect()
        if name != "pieces":
            assert current.columns == docs.columns
        if name == "language":
            learned = language.learn_dictionaries(docs.filter(~queries.held_out()))
            clear = docs.select("doc_id", language.language_of(docs["text"], learned)["rejected"].alias("r")).collect()
            assert sorted(repr(r.doc_id) for r in clear if not r.r) == sorted(repr(r.doc_id) for r in after)
            assert {r.doc_id for r in after} >= {r[0] for r in rows}
        elif name == "exact_dedup":
            assert sorted(r.text for r in after) == sorted({r.text for r in before})
        elif name == "near_dedup":
            groups = near_dedup.near_duplicates(documents(spark, [(r.doc_id, r.text) for r in before])).collect()
            assert {r.doc_id for r in after} == {r.component_id for r in groups}
        elif name == "mixing":
            assert {r.text for r in after} <= {r.text for r in before}
            assert {r.doc_id for r in after} >= {r.doc_id for r in before if r.doc_id is not None and r.doc_id < 300 and r.lang == "en"}
        else:
            assert len(after) == len(before) and all(r.n_ids == len(r.ids) for r in after)
        current = documents(spark, [(r.doc_id, r.text, r.lang) for r in after]) if name != "pieces" else None


def test_stages_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), str(tmp_path)).collect() == []
