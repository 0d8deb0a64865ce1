import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

REPO = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, REPO)

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(autouse=True)
def _workers_import(spark):
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [REPO, env.get("PYTHONPATH")]))


@pytest.fixture()
def docs(spark):
    """Makes a documents table of (doc_id, text[, lang]) rows."""
    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, (rest or [lang])[0], "s", None if t is None else len(t))
                                      for i, t, *rest in rows], DOC).repartition(3)
    return make


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


@pytest.fixture()
def sorted_rows():
    return rows
