"""Hand-checkable cases of the library, and every catalog query against its SQL."""

import glob
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from omenflow.functions import text as tx
from omenflow.operators import agreement, rows
from omenflow.plans import catalog
from omenflow.sources import readers, writers
from omenflow.streaming import events

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(catalog.sql()[name]).df()
    got = catalog.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b)
    for c in cols:
        assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x"))).first()[0]


def test_cleaning(spark):
    assert one(spark, "a<b>c http://x y", tx.without_markup_and_urls) == "a c  y"
    assert one(spark, "a  b   c", tx.single_spaces) == "a b c"
    assert one(spark, "I'm here", lambda c: tx.expand(c, {"I'm": "I am"})) == "I am here"
    assert one(spark, None, tx.clean) is None
    assert one(spark, "Hello2024", tx.shape) == "Xxxxxdddd"
    assert one(spark, 'noise {"label": 1, "reasoning": "x"} noise', tx.response_fields).asDict() == {"label": 1, "reasoning": "x"}
    assert one(spark, "no object", tx.response_fields) is None
    assert one(spark, "T3: On 2024, x", tx.template_number) == 3
    assert one(spark, "T9: x", tx.template_number) is None


def test_entity_labels(spark):
    cases = [("LOC_1", "x", "GPE"), ("FAC", "x", "PERSON"), ("CARDINAL", "15 November 2021", "DATE"), ("CARDINAL", "20°C", "TEMPERATURE"), ("ORG", "x", "ORG")]
    for label, text, want in cases:
        got = spark.createDataFrame([(label, text)], "l string, t string").select(tx.corrected_entity(F.col("l"), F.col("t"))).first()[0]
        assert got == want


def test_majority_takes_the_smallest_of_equals(spark):
    r = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "a", 1), (2, "b", 1)], "subject int, rater string, value int")
    assert {x.subject: x.vote for x in agreement.majority(r).collect()} == {1: 0, 2: 1}


def test_islands_keep_the_last_block(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, ""), (1, 3, "b"), (1, 4, "c")], "g int, i int, x string")
    assert sorted((r.i, r.block) for r in rows.islands(df, "g", ["i"], F.col("x") == "").collect()) == [(1, 0), (3, 1), (4, 1)]


def test_balanced_rejects_other_methods(spark):
    with pytest.raises(ValueError):
        rows.balanced(spark.range(2), "id", "id", "other")


def test_versions_and_readers(spark):
    names = spark.createDataFrame([("run-v1.csv",), ("run-v12.csv",), ("other-v40.csv",)], "name string")
    assert writers.next_version(names, "run").first()[0] == 13
    folder = tempfile.mkdtemp(prefix="spark-")
    with open(f"{folder}/tags", "w") as f:
        f.write("0\tAnn\tB-p_s\n1\tsays\tO\n\n0\tBob\tB-p_s\n")
    got = readers.tagged_tokens(spark, f"{folder}/tags").orderBy("line").collect()
    assert [(r.sentence, r.term, r.tag) for r in got] == [(0, "Ann", "B-p_s"), (0, "says", "O"), (1, "Bob", "B-p_s")]


def test_stream_equals_batch(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.write.mode("overwrite").parquet(f"{folder}/in")
    schema = ", ".join(f"{n} {t}" for n, t in e.dtypes)
    q = events.windowed_counts(events.event_stream(spark, f"{folder}/in", schema)).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{folder}/cp").start()
    q.awaitTermination()
    want = events.windowed_counts(e)
    assert spark.table("counts").exceptAll(want).count() == 0 and want.exceptAll(spark.table("counts")).count() == 0
