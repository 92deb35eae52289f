"""What the physical plans must and must not have."""

import os
import re

import pytest
from pyspark.sql import functions as F

from shotline.operators import metrics, relational as R, sequence as S, timeline as T
from shotline.plans import queries, search

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")
#: Queries that may compare a row with one row of statistics, and those whose single partition holds counts of partitions.
PYTHON = {"corrected_lines", "keep_last_similarity", "keep_last_scores", "near_dup_reuse", "line_matching", "keyframe_extraction"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cartesian_product_and_little_python(spark, name):
    p = plan(queries.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert (name in PYTHON) == bool(re.search("Python|Pandas|Arrow", p))


def test_search_is_one_scan(spark):
    p = plan(queries.vector_topk(spark, SF))
    assert "TakeOrderedAndProject" in p and "Exchange" not in p
    assert re.search(r"ReadSchema: struct<vec_id:bigint,embedding:array<float>,label:int>", p)


def test_filters_and_columns_reach_the_scan(spark):
    orders = queries.table(spark, SF, "orders")
    p = plan(R.in_frames(orders, [1, 2, 3], "o_orderkey").select("o_orderkey", "o_orderstatus"))
    assert "PushedFilters: [In(o_orderkey, [1,2,3])]" in p and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p
    p = plan(T.frame_range(orders.withColumnRenamed("o_orderkey", "frame_idx"), "frame_idx", 5, 9).select("frame_idx"))
    assert "GreaterThanOrEqual(o_orderkey,5)" in p and "LessThanOrEqual(o_orderkey,9)" in p


def test_windows_share_an_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id", F.rand(1).alias("size"))
    s = df.withColumn("s", S.steepness("size", ["k"], ["id"]))
    s = s.withColumn("m", S.moving_average(F.col("s"), ["k"], ["id"]))
    assert plan(S.candidates(s, ["k"], "id", "m")).count("Exchange hashpartitioning") == 1


def test_diversity_makes_no_pairs(spark):
    p = plan(metrics.diversity(queries.table(spark, SF, "embeddings"), "label", "embedding"))
    assert "Join" not in p and "partial_sum" in p


def test_top_k_is_monotone_and_filters_shrink(spark):
    emb = queries.table(spark, SF, "embeddings")
    q = queries._query_vector(emb)
    few, many = (search.vector_search(emb, q, k, key="vec_id").collect() for k in (5, 50))
    assert few == many[:5]
    docs = search.TextSearch(queries.table(spark, SF, "documents"), "doc_id", {"text": F.col("text")})
    everything = {r["doc_id"]: r["score"] for r in docs.search("the of", 10_000).collect()}
    some = {r["doc_id"]: r["score"] for r in docs.search("the of", 10_000, where=F.col("source") == "src1").collect()}
    assert some.items() <= everything.items() and len(some) < len(everything)
