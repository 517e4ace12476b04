"""lexiscope: sentiment and reliability jobs for text corpora on Spark.

Main entry points (all ``DataFrame -> DataFrame``):

* :func:`prepare_lookup` + :func:`lexicon_signals` - tag, vote and bias per document
* :func:`report_table` / :func:`nested_report` - the per-document reliability report
* :func:`standardise_job` - standardise, clean and stitch labelled sources
* :func:`clean_text` - the text-cleaning column function
* :func:`rouge_n`, :func:`rouge_l`, :func:`classification_metrics`,
  :func:`confusion_matrix`, :func:`stratified_split` - evaluation helpers
"""

from lexiscope.functions.text import clean_text, light_clean, tokenize
from lexiscope.operators.evaluate import classification_metrics, confusion_matrix
from lexiscope.operators.lexicon import (lexicon_signals, lexicon_signals_rowwise,
                                         prepare_lookup, tag_lists, token_tags)
from lexiscope.operators.report import (model_classifier, nested_report, report_json,
                                        report_json_python, report_table, report_table_rowwise)
from lexiscope.operators.rouge import rouge_l, rouge_n, summary_checks
from lexiscope.operators.sampling import seeded_shuffle, stratified_split, train_test
from lexiscope.operators.standardize import standardise, standardise_job
from lexiscope.session import build_session

__all__ = [
    "build_session", "clean_text", "light_clean", "tokenize", "prepare_lookup",
    "lexicon_signals", "lexicon_signals_rowwise", "token_tags", "tag_lists",
    "report_table", "report_table_rowwise", "nested_report", "report_json", "report_json_python",
    "model_classifier", "standardise", "standardise_job", "rouge_n", "rouge_l",
    "summary_checks", "classification_metrics", "confusion_matrix", "seeded_shuffle",
    "stratified_split", "train_test",
]
