"""Sources and sinks on small files written by the tests."""

import json
import os
import tempfile
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.operators import lexicon as lx
from lexiscope.sources import readers as rd
from lexiscope.sources import sinks as sk


def tmpdir():
    return tempfile.mkdtemp(prefix="lexiscope-test-")


def test_headerless_latin1_and_headed(spark):
    d = tmpdir()
    os.makedirs(f"{d}/FPB_x")
    os.makedirs(f"{d}/FMB_y")
    with open(f"{d}/FPB_x/raw.csv", "wb") as f:
        f.write('positive,"Caf\xe9 ""quoted""\nline"\nneutral,plain\n'.encode("latin-1"))
    with open(f"{d}/FMB_y/raw.csv", "w") as f:
        f.write("Title,Global Sentiment,Other\nUp,1,x\nDown,-1.0,y\nOdd,abc,z\n")
    found = rd.discover_labelled_sources(spark, d)
    assert set(found) == {"sentence", "headline"}
    s = rd.read_headerless_labelled(spark, found["sentence"][0], encoding=rd.LATIN1).collect()
    assert s[0].data == 'Café "quoted"\nline' and s[1].sentiment == "neutral"
    h = rd.read_headed_labelled(spark, found["headline"][0]).collect()
    # One cell that is no number makes the column text, as in the reference.
    assert [r["Global Sentiment"] for r in h] == ["1", "-1.0", "abc"]


def test_pairs_missing_and_split(spark):
    d = tmpdir()
    assert rd.read_pairs_file(spark, f"{d}/nope.csv") is None
    with open(f"{d}/train.csv", "w") as f:
        f.write("article,highlights\nA,a\n")
    with open(f"{d}/test.csv", "w") as f:
        f.write("article,highlights\nB,b\n")
    df = rd.read_pairs_by_split(spark, d)
    rows = sorted((r.article, r.split) for r in df.collect())
    assert rows == [("A", "train"), ("B", "test")]


def test_dictionary_csv(spark):
    d = tmpdir()
    with open(f"{d}/dict.csv", "w") as f:
        f.write(fixtures.fixture_dictionary_csv_text())
    proj = rd.read_dictionary(spark, f"{d}/dict.csv")
    assert proj.columns == ["word"] + list(lx.CATEGORIES)
    lk = lx.prepare_lookup(proj)
    assert lk.rows == lx.prepare_lookup(fixtures.fixture_dictionary(spark)).rows
    full = rd.read_full_dictionary(spark, f"{d}/dict.csv")
    assert lx.dictionary_profile(full).first().n_words == len(fixtures.fixture_dictionary_rows())
    try:
        rd.read_dictionary(spark, f"{d}/missing.csv")
        raise AssertionError("missing dictionary must fail")
    except FileNotFoundError:
        pass


def test_tag_list_text_and_parquet(spark):
    d = tmpdir()
    df = spark.createDataFrame([("t1", " Positive ", ["cns", "positive"]), ("t2", None, ["cns"])],
                               "data string, sentiment string, sentiment_list array<string>")
    sk.write_table(df, f"{d}/pq")
    sk.write_table(df.withColumn("sentiment_list", sk.tag_list_literal(F.col("sentiment_list"))),
                   f"{d}/csv", fmt="csv")
    for path, fmt in ((f"{d}/pq", "parquet"), (f"{d}/csv", "csv")):
        rows = rd.read_tag_lists(spark, path, fmt=fmt).collect()
        assert [(r.sentiment, r.sentiment_list) for r in rows] == [("positive", ["cns", "positive"])]


def test_text_corpus(spark):
    d = tmpdir()
    for i, t in enumerate(["Français\nline two", "second"]):
        with open(f"{d}/a{i}.txt", "w", encoding="utf-8") as f:
            f.write(t)
    with open(f"{d}/skip.md", "w") as f:
        f.write("no")
    rows = sorted(r.text for r in rd.read_text_corpus(spark, d).collect())
    assert rows == ["Français\nline two", "second"]


def test_run_metrics_files(spark):
    d = tmpdir()
    docs = {"cnn_dm": {"test": {"final_test_rougeL": 0.3}}, "ns": {"test": {"final_test_rougeL": 0.4}},
            "bad": {"validation": {}}}
    for k, v in docs.items():
        with open(f"{d}/final_metrics_{k}.json", "w") as f:
            json.dump(v, f, indent=2)
    got = {r.run: r.score for r in rd.read_run_metrics(spark, d).collect()}
    assert got == {"cnn_dm": 0.3, "ns": 0.4, "bad": None}


def test_newest_trainer_state(spark):
    d = tmpdir()
    for i, loss in enumerate([1.0, 2.0]):
        os.makedirs(f"{d}/checkpoint-{i}")
        with open(f"{d}/checkpoint-{i}/trainer_state.json", "w") as f:
            json.dump({"log_history": [{"step": 1, "epoch": 0.5, "loss": loss},
                                       {"step": 2, "epoch": 1.0, "eval_loss": loss + 1}]}, f)
        time.sleep(0.05)
        os.utime(f"{d}/checkpoint-{i}/trainer_state.json", (1000 + i, 1000 + i))
    rows = rd.read_training_log(spark, d).orderBy("step").collect()
    assert rows[0].loss == 2.0 and rows[1].eval_loss == 3.0


def test_run_metrics_sink_roundtrip(spark):
    d = tmpdir()
    m = spark.createDataFrame([("a", 0.2), ("b", None)], "run string, s double").select(
        "run", F.struct(F.col("s").alias("final_test_rougeL")).alias("test"))
    sk.write_run_metrics(m, f"{d}/m")
    got = {r.run: r.score for r in rd.read_run_metrics(spark, f"{d}/m", multi_line=False).collect()}
    assert got == {"a": 0.2, "b": None}


def test_headed_source_keeps_string_labels(spark, tmp_path):
    from lexiscope.operators.standardize import normalise_label
    (tmp_path / "words.csv").write_text("Title,Global Sentiment\na,positive\nb,\nc, Negative\n")
    (tmp_path / "numbers.csv").write_text("Title,Global Sentiment\na,0.5\nb,\nc,-1\n")
    for name in ("words", "numbers"):
        df = rd.read_headed_labelled(spark, str(tmp_path / f"{name}.csv"))
        got = {r["Title"]: r["x"] for r in df.select("Title", normalise_label(df, "Global Sentiment").alias("x")).collect()}
        assert got == {"a": "positive", "b": None, "c": "negative"}


def test_one_bad_metrics_file_leaves_the_others(spark, tmp_path):
    (tmp_path / "final_metrics_good.json").write_text('{"test": {"final_test_rougeL": 0.5}}')
    (tmp_path / "final_metrics_text.json").write_text('{"test": {"final_test_rougeL": "n/a"}}')
    (tmp_path / "final_metrics_flat.json").write_text('{"test": "failed"}')
    (tmp_path / "final_metrics_none.json").write_text('{"other": 1}')
    got = {r["run"]: r["score"] for r in rd.read_run_metrics(spark, str(tmp_path)).collect()}
    assert got == {"good": 0.5, "text": None, "flat": None, "none": None}


def test_dictionary_years_written_as_floats(spark, tmp_path):
    from lexiscope.operators import lexicon as lx
    rows = spark.createDataFrame([("good", "2009.0"), ("plain", None)], "Word string, Positive string")
    for c in lx.CATEGORIES:
        if c != "positive":
            rows = rows.selectExpr("*", f"cast(0 as int) as {c}")
    got = {r["word"]: r["positive"] for r in lx.project_dictionary(rows).collect()}
    assert got == {"GOOD": 2009, "PLAIN": 0}


def test_highlights_pairs(spark):
    from lexiscope.operators import standardize as sd
    df = spark.createDataFrame([("An article.", "Its highlights.")], "article string, highlights string")
    assert sd.prepare_pairs(df).count() == 1


LITERALS = [
    "['cns', 'positive']", "[]", " [ 'a' , \"b\" , ] ", "[\"it's\", 'say \"x\"', 'both \\' and \"']", r"['a\\b', 'c\nd\te', '\x41é\U0001f600', '\101\0']",
    r"['\q keeps', '\\', '', '\\\'']", "['comma, [bracket]', \"', '\"]", "['" + "x" * 50_000 + r"\n" * 5_000 + "']", "['é中\U0001f600']",
    "['line\\\njoined']",
    "['open", "['a' 'b' 'c'", "nothing", "", "['a',, 'b']", "[a]", "['a'] tail", "[1, 2]"]


def test_list_literals_as_python_reads_them(spark):
    import ast

    def want(text):
        try:
            return ast.literal_eval(text.strip())
        except (SyntaxError, ValueError):
            return None

    df = spark.createDataFrame([(i, x) for i, x in enumerate(LITERALS)], "i int, x string")
    got = {r.i: r.l for r in df.select("i", rd.parse_tag_list(F.col("x")).alias("l")).collect()}
    for i, text in enumerate(LITERALS):
        value = want(text)
        strings = value if isinstance(value, list) and all(isinstance(v, str) for v in value) else None
        assert got[i] == strings, text[:60]
    assert spark.createDataFrame([(None,)], "x string").select(rd.parse_tag_list(F.col("x")).alias("l")).first().l is None


def test_list_literals_round_trip(spark):
    import ast
    lists = [["a", "it's", 'say "x"', "both ' and \"", "back\\slash\\n", "two\nlines\r\t", "", "é\U0001f600"], []]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, l array<string>")
    rows = df.select("i", sk.tag_list_literal(F.col("l")).alias("t")).withColumn("back", rd.parse_tag_list(F.col("t"))).collect()
    for r in rows:
        assert r.back == lists[r.i] == ast.literal_eval(r.t)


def run_folder(records_of, root, stamp):
    import os
    for path, text in records_of.items():
        full = f"{root}/{path}"
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w") as f:
            f.write(text)
        os.utime(full, (stamp[path], stamp[path]))


def test_newest_checkpoint_of_many_runs(spark, tmp_path):
    import json
    log = lambda *steps: json.dumps({"log_history": [{"step": s, "loss": s / 4, "other": "x"} for s in steps], "best": 1}, indent=2)
    files = {"a/checkpoint-10/trainer_state.json": log(1, 2), "a/checkpoint-9/trainer_state.json": log(3),
             "b/checkpoint-1/trainer_state.json": log(4), "b/checkpoint-2/trainer_state.json": log(5, 6),
             "c/checkpoint-7/trainer_state.json": "{ broken", "d/checkpoint-3/trainer_state.json": log()}
    # Run a: the lower number is newer.  Run b: equal times, the greater number counts.
    stamp = dict(zip(files, (1000, 2000, 3000, 3000, 4000, 5000)))
    run_folder(files, tmp_path, stamp)
    got = spark_rows(rd.read_training_logs(spark, str(tmp_path)))
    assert got == [("a", 9, 3, 0.75), ("b", 2, 5, 1.25), ("b", 2, 6, 1.5)]
    named = {r.run: r.checkpoint for r in rd.newest_checkpoints(spark, str(tmp_path)).collect()}
    assert named == {"a": 9, "b": 2, "c": 7, "d": 3}


def spark_rows(df):
    return sorted((r.run, r.checkpoint, r.step, r.loss) for r in df.collect())


def test_training_logs_of_lines(spark, tmp_path):
    import time
    log = spark.createDataFrame([("r1", 1, 0.5), ("r1", 2, 0.25), ("r2", 1, None)], "run string, step long, loss double")
    sk.write_training_log(log, str(tmp_path), "run", 1)
    time.sleep(0.05)
    sk.write_training_log(log.where("run = 'r1'").withColumn("step", F.col("step") + 10), str(tmp_path), "run", 2)
    got = spark_rows(rd.read_training_logs(spark, str(tmp_path), lines=True))
    assert got == [("r1", 2, 11, 0.5), ("r1", 2, 12, 0.25), ("r2", 1, 1, None)]


def test_training_logs_of_many_runs_share_files(spark, tmp_path):
    """Files follow the tasks, not the runs; a run's newest checkpoint follows file times, also for a null run."""
    import os
    names = [f"r:{i}/x" for i in range(200)] + [None]
    log = spark.createDataFrame([(n, 1, 0.5) for n in names], "run string, step long, loss double").coalesce(2)
    sk.write_training_log(log, str(tmp_path), "run", 3)
    sk.write_training_log(log.where("run is null or run < 'r:2'").withColumn("step", F.lit(2).cast("long")), str(tmp_path), "run", 1)
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path) for f in fs if f.startswith("part-")]
    assert len(files) <= 4
    for f in files:  # the lower number is newer
        os.utime(f, (2000, 2000) if "checkpoint=1" in f else (1000, 1000))
    got = {r["run"]: (r["checkpoint"], r["step"], r["loss"]) for r in rd.read_training_logs(spark, str(tmp_path), lines=True).collect()}
    assert got == {n: (1, 2, 0.5) if n is None or n < "r:2" else (3, 1, 0.5) for n in names}


def test_training_log_lines_in_a_folder_for_each_run(spark, tmp_path):
    files = {"a/checkpoint-1/log.json": '{"step": 1, "loss": 0.5}\n', "a/checkpoint-2/log.json": '{"step": 2, "loss": 0.25}\n{ broken\n',
             "run=b/checkpoint=1/part-0": '{"step": 3, "loss": 1.0}\n'}
    run_folder(files, tmp_path, dict(zip(files, (1000, 2000, 3000))))
    assert spark_rows(rd.read_training_logs(spark, str(tmp_path), lines=True)) == [("a", 2, 2, 0.25), ("b", 1, 3, 1.0)]


def test_text_corpus_keeps_ids_in_few_folders(spark):
    """More documents than folders, over several tasks; line ends, empty and null texts; a folder gives no id."""
    import os
    import tempfile

    from lexiscope.sources import readers as rd
    from lexiscope.sources import sinks as sk
    path = tempfile.mkdtemp()
    texts = {i: f"text {i}\n\nof {'x' * (i % 7)} \u4e2d\n" for i in range(40)} | {40: "", 41: None, -5: "minus"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    manifest = sk.write_text_corpus(docs, path, folders=3)
    back = rd.read_text_corpus(spark, f"{path}/files")
    got = {r["doc_id"]: r["text"] for r in back.select(*rd.corpus_places(), "text").join(
        manifest, ["part", "number"]).collect()}
    assert back.count() == manifest.count() == len(texts)
    assert got == {i: (t or "") + "\n" for i, t in texts.items()}
    assert {r["doc_id"]: r["n_bytes"] for r in manifest.collect()} == {i: len((t or "").encode()) for i, t in texts.items()}
    assert len([f for f in os.listdir(f"{path}/files") if f.startswith("folder=")]) <= 3


def test_empty_text_corpus(spark):
    import tempfile

    from lexiscope.sources import sinks as sk
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sk.write_text_corpus(empty, tempfile.mkdtemp()).count() == 0


def corpus_back(spark, path, docs, **how):
    """A corpus written and read again: ``{doc_id: text}``."""
    from lexiscope.sources import readers as rd
    from lexiscope.sources import sinks as sk
    manifest = sk.write_text_corpus(docs, path, **how)
    back = rd.read_text_corpus(spark, f"{path}/files", rd.corpus_tasks(manifest))
    return {r["doc_id"]: r["text"] for r in back.select(*rd.corpus_places(), "text").join(manifest, ["part", "number"]).collect()}


def test_text_corpus_creates_its_files_and_no_others(spark, tmp_path):
    """One file system entry for each text: no sidecar (each costs processes of its own), nothing begun and left.  A
    second corpus at the same path replaces the first; keys may repeat or be null."""
    for n in (30, 12):
        texts = [(i, f"text {i} \u4e2d\r\n") for i in range(n)] + [(3, None), (None, "no id")]
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
        got = corpus_back(spark, str(tmp_path), docs, folders=3)
        names = [f.name for f in (tmp_path / "files").rglob("*") if f.is_file()]
        assert len(names) == len(texts) and all(name.endswith(".txt") for name in names)
        assert got.pop(3) in ("\n", "text 3 \u4e2d\r\n\n") and got.pop(None) == "no id\n"
        assert got == {i: f"text {i} \u4e2d\r\n\n" for i in range(n) if i != 3}


def test_text_corpus_in_a_store_that_only_spark_opens(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.corpus.link./c", tmp_path.as_uri())
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string").repartition(3)
    assert corpus_back(spark, "viewfs://corpus/c/x", docs) == {i: f"text {i}\n" for i in range(9)}


def test_small_files_share_a_task(spark, tmp_path):
    """The tasks that read a corpus follow its bytes, not one task for every 32 files."""
    from lexiscope.sources import readers as rd
    from lexiscope.sources import sinks as sk
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).repartition(2)
    tasks = rd.corpus_tasks(sk.write_text_corpus(docs, str(tmp_path)))
    back = rd.read_text_corpus(spark, f"{tmp_path}/files", tasks)
    assert tasks == max(2, spark.sparkContext.defaultParallelism) and back.count() == 1200
    assert back.rdd.getNumPartitions() == tasks < rd.read_text_corpus(spark, f"{tmp_path}/files").rdd.getNumPartitions()
    wide = spark.createDataFrame([(200 << 20,)], "n_bytes long")
    assert rd.corpus_tasks(spark.range(100).crossJoin(wide)) == 313  # 200 MB and 64 kB each, 64 MB a task


def corpus_files(tmp_path):
    """Files that are articles and files that are none, in folders of several levels."""
    names = ["a.txt", "b%20 c.txt", "x=1/[d]#?+.txt", "x=1/y z/\u00e9\u4e2d\u3000\u0085.txt", "_k=2/e.txt", "deep/er/still/f.txt", "_metadata/g.txt"]
    none = [".h.txt", "_i.txt", "_hidden/j.txt", ".dot/k.txt", "l.text", "m.txt._COPYING_", "_metadata.txt", "N.TXT"]
    for name in names + none:
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode() + b"\r\n\xff\n")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere")
    return names


def test_text_corpus_is_read_as_spark_sees_it(spark, tmp_path):
    """The same files, paths and bytes as Spark's own binary source, for a folder, a glob and a single file."""
    names = corpus_files(tmp_path)
    for path, n in ((tmp_path, len(names)), (tmp_path / "*" / "*", 7), (tmp_path / "a.txt", 1), (tmp_path / "l.text", 0), (tmp_path / "empty.txt", 0)):
        got = rd.read_text_corpus(spark, str(path), 3).select("doc_id", F.col("text").cast("binary")).collect()
        own = spark.read.format("binaryFile").load(str(path), pathGlobFilter="*.txt", recursiveFileLookup=True)
        assert sorted(map(tuple, got)) == sorted(map(tuple, own.select("_metadata.file_path", "content").collect()))
        assert len(got) == n
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        rd.read_text_corpus(spark, str(tmp_path / "none"))


def test_the_driver_lists_no_file_of_a_corpus(spark, tmp_path):
    """The plan has no file index (which holds the name of every file) and the files are dealt out by their number."""
    for i in range(40):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    back = rd.read_text_corpus(spark, tmp_path.as_uri(), 4)
    assert back.inputFiles() == [] and "binaryFile" not in back._jdf.queryExecution().toString()
    assert back.rdd.getNumPartitions() == 4 and back.count() == 40


def test_files_are_passed_on_in_batches_of_bounded_size(tmp_path):
    import pyarrow as pa
    sizes = [3, 4, 5, 50, 1, 1, 1]
    for i, n in enumerate(sizes):
        (tmp_path / f"{i}.txt").write_bytes(b"x" * n)
    paths = pa.RecordBatch.from_arrays([pa.array([str(tmp_path / f"{i}.txt") for i in range(len(sizes))])], ["path"])
    out = list(rd._file_reader(10)(iter([paths])))
    assert [[len(x) for x in b["content"].to_pylist()] for b in out] == [[3, 4], [5], [50], [1, 1, 1]]
