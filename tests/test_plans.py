"""Physical-plan properties the scale design relies on."""

from lexiscope.plans.queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_tagging_plan(spark, sf):
    p = plan(QUERIES["lexicon_signals"](spark, sf))
    assert "BroadcastHashJoin" in p and "posexplode" in p
    assert p.count("Exchange hashpartitioning") == 1  # the per-document aggregate only
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_shuffled_lookup_has_no_hot_key(spark, sf):
    p = plan(QUERIES["lexicon_signals_shuffled"](spark, sf))
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    dealt = [x for x in p.splitlines() if "Exchange hashpartitioning(_" in x]
    assert dealt and all("_k#" in x and "_s#" in x for x in dealt)  # by word and salt
    below = p[p.index(dealt[0]):]
    assert "length(token" in below  # pieces that are no word stay behind the exchange


def test_rouge_n_moves_pairs_once(spark):
    from lexiscope.operators.rouge import rouge_n
    df = spark.createDataFrame([(1, "a b", "a c")], "k int, p string, r string")
    assert plan(rouge_n(df, ["k"], "p", "r")).count("Exchange") == 1


def test_rowwise_shape_has_no_exchange(spark, sf):
    p = plan(QUERIES["lexicon_signals_rowwise"](spark, sf))
    assert "Exchange" not in p and "Join" not in p


def test_cleaning_evaluated_once_per_source(spark, sf):
    p = plan(QUERIES["stitched"](spark, sf))
    assert p.count("ArrowEvalPython") == 2  # one per source, not re-evaluated in a filter


def test_seeded_subset_is_topk(spark, sf):
    p = plan(QUERIES["seeded_subset"](spark, sf))
    assert "TakeOrderedAndProject" in p


def test_report_stream_rowwise_is_stateless(spark, sf):
    from lexiscope import fixtures
    from lexiscope.operators import lexicon as lx
    from lexiscope.operators import report as rp
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    p = plan(rp.report_table_rowwise(docs, lx.prepare_lookup(fixtures.fixture_dictionary(spark))))
    assert "Exchange" not in p and "Aggregate" not in p


def test_bucketed_corpus_needs_no_shuffle(spark, sf):
    from lexiscope import fixtures
    from lexiscope.operators import lexicon as lx
    from lexiscope.operators import report as rp
    from lexiscope.sources.sinks import write_bucketed_table
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    write_bucketed_table(docs, "docs_bucketed", "doc_id", buckets=8)
    lk = lx.prepare_lookup(fixtures.fixture_dictionary(spark))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a corpus too big to broadcast
    try:
        p = plan(rp.report_table(spark.table("docs_bucketed"), lk))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" in p
    assert p.count("BroadcastExchange") == 1  # the size-checked lookup only
