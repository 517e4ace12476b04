"""Batch jobs for ``spark-submit`` (the corpus-scale form of the reference's CLI).

    spark-submit --py-files lexiscope.zip lexiscope/jobs.py report \
        --input <corpus> --dictionary <csv> --output <dir>
    python -m lexiscope.jobs standardise --raw <folder> --output <dir>   # local

``report``: a folder of ``*.txt`` articles (or a parquet table with ``doc_id,
text``) -> one JSON report per article (K2).  ``standardise``: labelled raw
folders (S3 routing) -> stitched, cleaned table (U2).  ``tag-lists``: corpus ->
ordered tag list per document (L4).  ``rouge``: prediction/reference pairs ->
per-pair and corpus ROUGE-1/2/L/Lsum (A7/A8), on stems and with bootstrap intervals if asked.  ``pairs``: article/summary
CSV -> prepared pairs (U3).  ``evaluate``: labelled texts -> tag lists, rule-based labels, metrics.  Every step is a Spark job;
nothing is collected to the driver.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope import fixtures
from lexiscope.functions import text as tx
from lexiscope.operators import evaluate as ev
from lexiscope.operators import lexicon as lx
from lexiscope.operators import report as rp
from lexiscope.operators import standardize as sd
from lexiscope.session import build_session, cut_lineage
from lexiscope.sources import readers as rd
from lexiscope.sources import sinks as sk


def _corpus(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "text":
        return rd.read_text_corpus(spark, path).select(
            "doc_id", tx.py_strip(F.col("text")).alias("text"))
    return spark.read.format(fmt).load(path).select(
        F.col("doc_id"), F.col("text").cast("string"))


def _lookup(spark: SparkSession, dictionary: str | None, mode: str) -> lx.Lookup:
    d = rd.read_dictionary(spark, dictionary) if dictionary else fixtures.fixture_dictionary(spark)
    return lx.prepare_lookup(d, stopword_mode=mode)


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    docs = _corpus(spark, args.input, args.format)
    accepted, rejected = sd.guard_nonempty(docs)  # P8: empty articles are errors
    flat = rp.report_table(accepted, _lookup(spark, args.dictionary, "before_lookup"),
                           keep_positions=True, prompt=args.prompt, unique_ids=True)
    # One line per article: the report text exactly as the reference prints it,
    # under the article's id.
    lines = rp.report_json_python(flat).select(F.concat(
        F.lit('{"doc_id": '), rp.json_string(F.col("doc_id").cast("string")),
        F.lit(', "report": '), F.col("json"), F.lit("}")).alias("value"))
    lines.write.mode("overwrite").text(args.output)
    if args.rejected:
        sk.write_table(rejected.select("doc_id"), args.rejected)


def run_standardise(spark: SparkSession, args: argparse.Namespace) -> None:
    found = rd.discover_labelled_sources(spark, args.raw)
    parts = []
    for path in found.get("sentence", []):
        parts.append((rd.read_headerless_labelled(spark, path, encoding=args.encoding),
                      "data", "sentiment", "sentence"))
    for path in found.get("headline", []):
        parts.append((rd.read_headed_labelled(spark, path, encoding=args.encoding),
                      "Title", "Global Sentiment", "headline"))
    if not parts:
        raise SystemExit(f"no labelled sources under {args.raw}")
    standard = [sd.standardise(df, data, label, kind) for df, data, label, kind in parts]
    if args.per_source:  # before cleaning, one table a source, named by its folder
        names = [path.rsplit("/", 2)[-2] for kind in ("sentence", "headline") for path in found.get(kind, [])]
        for name, table in zip(names, standard):
            sk.write_table(table, f"{args.per_source.rstrip('/')}/{name}", fmt=args.output_format)
    sk.write_table(sd.stitch([sd.clean_standardised(t) for t in standard]), args.output, fmt=args.output_format)


def run_pairs(spark: SparkSession, args: argparse.Namespace) -> None:
    """S4 (one file) or S5 (a folder of splits) -> U3 -> one table a split."""
    if args.input.endswith(".csv"):
        pairs = rd.read_pairs_file(spark, args.input, encoding=args.encoding)
    else:
        pairs = rd.read_pairs_by_split(spark, args.input, encoding=args.encoding)
    if pairs is None:
        raise SystemExit(f"no pairs at {args.input}")
    ready = sd.drop_incomplete_pairs(sd.prepare_pairs(pairs, mode=args.mode))
    sk.write_table(ready, args.output, partition_by=["split"] if "split" in ready.columns else None)


def run_evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Labelled sentences -> tag lists -> vote -> three classes -> metrics and confusion matrix."""
    given = spark.read.format(args.format).load(args.input).select(
        F.col("data").alias("text"), F.lower(tx.py_strip(F.col("sentiment"))).alias("label"))
    # Numbered once: every branch reads the same ids.
    rows = cut_lineage(given.dropna().withColumn("doc_id", F.monotonically_increasing_id()))
    lookup = _lookup(spark, args.dictionary, "in_dictionary")
    out = args.output.rstrip("/")
    sk.write_table(lx.tag_lists(rows, lookup).join(rows, "doc_id").select(
        F.col("text").alias("data"), F.col("label").alias("sentiment"), "sentiment_list"), f"{out}/tag_lists")
    signals = lx.lexicon_signals(rows, lookup, litigious=args.litigious)
    judged = cut_lineage(signals.select("doc_id", F.col("lexicon_label").alias("pred")).join(
        rows.select("doc_id", "label"), "doc_id"))
    sk.write_table(judged, f"{out}/per_row")
    sk.write_table(ev.classification_metrics(judged, "label", "pred"), f"{out}/metrics")
    sk.write_table(ev.confusion_matrix(spark, judged, "label", "pred"), f"{out}/confusion")


def run_tag_lists(spark: SparkSession, args: argparse.Namespace) -> None:
    docs = _corpus(spark, args.input, args.format)
    tl = lx.tag_lists(docs, _lookup(spark, args.dictionary, "in_dictionary"))
    sk.write_table(tl, args.output)


def run_rouge(spark: SparkSession, args: argparse.Namespace) -> None:
    from lexiscope.operators import rouge as rg
    pairs = spark.read.format(args.format).load(args.input)
    keys = args.keys.split(",")
    if args.stem:
        pairs = cut_lineage(rg.stemmed(pairs, keys, [args.pred_col, args.ref_col]))
    per_n = rg.rouge_n(pairs, keys, args.pred_col, args.ref_col)
    per_l = rg.rouge_l(pairs, keys, args.pred_col, args.ref_col)
    per_pair = per_n.join(per_l, keys)
    out = args.output.rstrip("/")
    sk.write_table(per_pair, f"{out}/per_pair")
    done = spark.read.parquet(f"{out}/per_pair")
    scores = ["rouge1_f", "rouge2_f", "rougeL_f", "rougeLsum_f"]
    sk.write_table(rg.mean_scores(done, scores), f"{out}/corpus")
    if args.replicates:
        sk.write_table(rg.bootstrap(done, keys, scores, args.replicates), f"{out}/bootstrap")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexiscope.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    r = sub.add_parser("report", help="corpus -> JSON reliability reports")
    r.add_argument("--input", required=True)
    r.add_argument("--format", default="text", help="text (folder of .txt) or a Spark format")
    r.add_argument("--dictionary", help="dictionary CSV (default: fixture dictionary)")
    r.add_argument("--output", required=True)
    r.add_argument("--rejected", help="where to write ids of empty articles")
    r.add_argument("--prompt", action="store_true", help="put the summary instruction in front of articles")
    s = sub.add_parser("standardise", help="raw labelled folders -> stitched table")
    s.add_argument("--raw", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--encoding", default="UTF-8")
    s.add_argument("--output-format", default="parquet")
    s.add_argument("--per-source", help="where to write each source's table before cleaning")
    q = sub.add_parser("pairs", help="article/summary CSV (file or folder of splits) -> prepared pairs")
    q.add_argument("--input", required=True)
    q.add_argument("--output", required=True)
    q.add_argument("--encoding", default="UTF-8")
    q.add_argument("--mode", choices=("light", "strip"), default="light")
    e = sub.add_parser("evaluate", help="labelled texts -> tag lists, rule-based labels, metrics")
    e.add_argument("--input", required=True)
    e.add_argument("--format", default="parquet")
    e.add_argument("--dictionary")
    e.add_argument("--litigious", choices=("negative", "drop"), default="negative")
    e.add_argument("--output", required=True)
    t = sub.add_parser("tag-lists", help="corpus -> ordered tag list per document")
    t.add_argument("--input", required=True)
    t.add_argument("--format", default="text")
    t.add_argument("--dictionary")
    t.add_argument("--output", required=True)
    g = sub.add_parser("rouge", help="prediction/reference pairs -> ROUGE-1/2/L/Lsum")
    g.add_argument("--input", required=True)
    g.add_argument("--format", default="parquet")
    g.add_argument("--keys", required=True, help="comma-separated key columns of a pair")
    g.add_argument("--pred-col", default="prediction")
    g.add_argument("--ref-col", default="reference")
    g.add_argument("--stem", action="store_true", help="score Porter stems, as the reference does")
    g.add_argument("--replicates", type=int, default=0, help="bootstrap replicates (0: means only)")
    g.add_argument("--output", required=True)
    args = p.parse_args(argv)
    spark = build_session()
    {"report": run_report, "standardise": run_standardise, "tag-lists": run_tag_lists,
     "rouge": run_rouge, "pairs": run_pairs, "evaluate": run_evaluate}[args.job](spark, args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
