"""The registered queries against DuckDB, and the pipeline against a plain version of its stages."""

import hashlib
import os
import struct

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from adspend.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return c


def test_one_query_for_each_operator():
    names = __spark_entry__.queries()
    assert "pipeline" in names and set(QUERIES) < set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    expected = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected.select(
        *(f'"{c}"' for c in got.columns)).fetchall()))


def test_pipeline_against_plain_stages(spark, con):
    import sentencepiece
    from test_decontaminate import plain as hits
    from test_exact_dedup import plain as copies
    from test_near_dedup import plain as near

    from adspend.llm.queries import piece_model

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in QUERIES["op3_quality_classifier"](spark, SF).collect() if r.kept}
    one = [r[0] for r in copies([(i, text[i]) for i in sorted(good)]) if r[3]]
    two = [r[0] for r in near([(i, text[i]) for i in sorted(one)], corpus_pipeline.NEAR_PERCENT) if r[3]]
    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    three = [r[0] for r in hits([(i, text[i]) for i in two], items) if not r[-1]]
    sp = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    expected = []
    for i in three:
        ids = sp.encode(text[i] or "", add_bos=True, add_eos=True)
        expected.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(expected)
    assert 0 < len(expected) < len(good) < len(text)
