"""The spark-submit jobs on small inputs."""

import json
import os
import tempfile

from lexiscope import fixtures
from lexiscope import jobs


def test_report_job_text_corpus(spark):
    d = tempfile.mkdtemp()
    os.makedirs(f"{d}/in")
    texts = {"a": "The firm tion ther gain. Outlook ou la anon.", "b": "  ", "c": "Er des than licensed st."}
    for k, v in texts.items():
        with open(f"{d}/in/{k}.txt", "w") as f:
            f.write(v)
    with open(f"{d}/dict.csv", "w") as f:
        f.write(fixtures.fixture_dictionary_csv_text())
    jobs.main(["report", "--input", f"{d}/in", "--dictionary", f"{d}/dict.csv",
               "--output", f"{d}/out", "--rejected", f"{d}/rej"])
    rows = [json.loads(r.value) for r in spark.read.text(f"{d}/out").collect()]
    assert len(rows) == 2
    for r in rows:
        assert r["report"]["reliability"] in ("high", "medium", "low")
    assert spark.read.parquet(f"{d}/rej").count() == 1


def test_standardise_and_tag_list_jobs(spark):
    d = tempfile.mkdtemp()
    os.makedirs(f"{d}/raw/FPB_a")
    with open(f"{d}/raw/FPB_a/raw.csv", "w") as f:
        f.write("positive,It's up\nnegative,Down?\nnegative,Down?\n")
    jobs.main(["standardise", "--raw", f"{d}/raw", "--output", f"{d}/std"])
    got = sorted((r.data, r.sentiment) for r in spark.read.parquet(f"{d}/std").collect())
    assert got == [("down", "negative"), ("it is up", "positive")]
    os.makedirs(f"{d}/in")
    with open(f"{d}/in/x.txt", "w") as f:
        f.write("tion er zz")
    jobs.main(["tag-lists", "--input", f"{d}/in", "--output", f"{d}/tl"])
    assert spark.read.parquet(f"{d}/tl").first().sentiment_list == ["positive", "negative", "cns"]


def test_rouge_job(spark):
    d = tempfile.mkdtemp()
    spark.createDataFrame([(1, "a b c d", "a b c d"), (2, "x y", "y z")],
                          "k int, prediction string, reference string").write.parquet(f"{d}/pairs")
    jobs.main(["rouge", "--input", f"{d}/pairs", "--keys", "k", "--output", f"{d}/out"])
    per = {r.k: r for r in spark.read.parquet(f"{d}/out/per_pair").collect()}
    assert per[1].rouge1_f == 1.0 and per[1].rougeL_f == 1.0
    corpus = spark.read.parquet(f"{d}/out/corpus").first()
    assert 0.0 < corpus.rouge1 <= 1.0


def test_rouge_job_on_stems_with_intervals(spark):
    d = tempfile.mkdtemp()
    spark.createDataFrame([(1, "hopping ponies", "hop pony"), (2, "x y", "y z")],
                          "k int, prediction string, reference string").write.parquet(f"{d}/pairs")
    jobs.main(["rouge", "--input", f"{d}/pairs", "--keys", "k", "--output", f"{d}/out", "--stem", "--replicates", "64"])
    per = {r.k: r for r in spark.read.parquet(f"{d}/out/per_pair").collect()}
    assert per[1].rouge1_f == 1.0 and per[2].rouge1_f == 0.5
    marks = {r.metric: r for r in spark.read.parquet(f"{d}/out/bootstrap").collect()}
    assert set(marks) == {"rouge1", "rouge2", "rougeL", "rougeLsum"} and marks["rouge1"].low <= 0.75 <= marks["rouge1"].high


def test_sources_before_cleaning(spark):
    d = tempfile.mkdtemp()
    os.makedirs(f"{d}/raw/FPB_a")
    with open(f"{d}/raw/FPB_a/raw.csv", "w") as f:
        f.write("positive,It's up\nnegative,\n")
    jobs.main(["standardise", "--raw", f"{d}/raw", "--output", f"{d}/std", "--per-source", f"{d}/each"])
    assert [(r.data, r.datatype, r.sentiment) for r in spark.read.parquet(f"{d}/each/FPB_a").collect()] == [
        ("It's up", "sentence", "positive")]
    assert spark.read.parquet(f"{d}/std").first().data == "it is up"


def test_pairs_job(spark):
    d = tempfile.mkdtemp()
    for split in ("train", "test"):
        with open(f"{d}/{split}.csv", "w") as f:
            f.write(f"article,summary\n  A {split} text? ,Short.\n,nothing\n")
    jobs.main(["pairs", "--input", d, "--output", f"{d}/out", "--mode", "strip"])
    got = sorted((r.split, r.article, r.summary) for r in spark.read.parquet(f"{d}/out").collect())
    assert got == [("test", "A test text?", "Short."), ("train", "A train text?", "Short.")]
    with open(f"{d}/one.csv", "w") as f:
        f.write("ctext,text\nLong?,Brief\n")
    jobs.main(["pairs", "--input", f"{d}/one.csv", "--output", f"{d}/one"])
    assert [tuple(r) for r in spark.read.parquet(f"{d}/one").collect()] == [("Long", "Brief")]


def test_evaluate_job(spark):
    d = tempfile.mkdtemp()
    spark.createDataFrame([("tion tion er", "sentence", " Positive "), ("er er", "sentence", "negative"), ("zz", "headline", "positive"),
                           (None, "headline", "neutral"), ("tion", "headline", None)],
                          "data string, datatype string, sentiment string").write.parquet(f"{d}/in")
    jobs.main(["evaluate", "--input", f"{d}/in", "--output", f"{d}/out"])
    per = sorted((r.label, r.pred) for r in spark.read.parquet(f"{d}/out/per_row").collect())
    assert per == [("negative", "negative"), ("positive", "neutral"), ("positive", "positive")]
    assert abs(spark.read.parquet(f"{d}/out/metrics").first().accuracy - 2 / 3) < 1e-4
    assert spark.read.parquet(f"{d}/out/tag_lists").count() == 3
    cells = spark.read.parquet(f"{d}/out/confusion").collect()
    assert len(cells) == 9 and sum(r.n for r in cells) == 3
