"""Every registered corpus query against its SQL, and the contracts they share."""

import pytest

from stackweave.llm import common, queries
from tests import compare
from tests.llm import helpers


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", list(queries.STATEMENTS))
def test_query_equals_sql(spark, small, con, name):
    assert compare.difference(queries.QUERIES[name](spark, small), con, queries.STATEMENTS[name]) is None


def test_every_statement_belongs_to_a_query():
    assert set(queries.STATEMENTS) <= set(queries.QUERIES)


def test_words_of_the_contract(spark):
    docs = spark.createDataFrame([("a b c\x0bd\x0c e\r\n",), (" ",), ("",), (None,)], "text string")
    found = docs.select(common.words(docs.text), common.word_count(docs.text)).collect()
    assert [list(r[0]) for r in found] == [["a b", "c", "d", "e"], [], [], []]
    assert [r[1] for r in found] == [4, 0, 0, 0]


def test_training_rows(spark):
    import zlib

    df = spark.range(50).toDF("doc_id")
    found = {r[0]: r[1] for r in df.select("doc_id", common.in_training(df.doc_id)).collect()}
    assert found == {k: zlib.crc32(str(k).encode()) % 3 != 1 for k in range(50)}
    assert helpers.rows(spark.sql("select cast(null as long) as doc_id").select(common.in_training(common.F.col("doc_id")).alias("x")), "x") == [(True,)]
