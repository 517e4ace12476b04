"""DuckDB oracle SQL for the registered queries (same column names and types)."""

from __future__ import annotations

from lexiscope.operators import lexicon as lx
from lexiscope.functions.hashing import seeded_hash_sql
from lexiscope.operators import evaluate as ev
from lexiscope.functions import stems
from lexiscope.operators import rouge as rg
from lexiscope.operators import sampling as sm
from lexiscope.plans import sql as s

CATS = lx.CATEGORIES
SERIES = ("loss", "eval_loss", "eval_accuracy", "eval_rougeL")


def lexicon_signals() -> str:
    return s.signals_query()


def lexicon_signals_derived() -> str:
    return s.signals_query(derived=True)


def report_flat(with_positions: bool = False, derived: bool = False) -> str:
    """The flat report; ``with_positions`` keeps the first position of each tag
    and the reasons as a list (for the reference-format JSON)."""
    ns = ", ".join(f"g.n_{c}" for c in CATS)
    label, conf = s.letter_softmax_sql("d.text")
    g_firsts = "".join(f", g.first_{c}" for c in CATS) if with_positions else ""
    firsts = "".join(f", first_{c}" for c in CATS) if with_positions else ""
    reasons = "rs" if with_positions else "array_to_string(rs, ',') AS reasons"
    return (
        f"WITH g AS ({s.signals_query(with_positions=with_positions, derived=derived)}), "
        f"r AS (SELECT g.doc_id, {s.lead_summary_sql('d.text')} AS summary, "
        f"{label} AS finbert_label, {conf} AS finbert_confidence, g.lexicon_label, {ns}, "
        f"g.n_cns, g.n_tags, g.uncertainty, g.litigious, g.constraining, g.bias_score, g.bias_flag{g_firsts} "
        f"FROM g JOIN documents d ON d.doc_id = g.doc_id), "
        f"r2 AS (SELECT *, (finbert_label = lexicon_label) AS agreement, "
        f"list_filter([CASE WHEN finbert_label <> lexicon_label THEN 'model_lexicon_disagreement' END, "
        f"CASE WHEN finbert_confidence < 0.55 THEN 'low_finbert_confidence' END, "
        f"CASE WHEN bias_flag OR bias_score > 0.15 THEN 'high_lexicon_bias' END], lambda x: x IS NOT NULL) AS rs "
        f"FROM r) "
        f"SELECT doc_id, summary, finbert_label, finbert_confidence, lexicon_label, "
        f"{', '.join('n_' + c for c in CATS)}, n_cns, n_tags, uncertainty, litigious, constraining, "
        f"bias_score, bias_flag, agreement, "
        f"CASE WHEN len(rs) >= 2 THEN 'low' WHEN len(rs) = 1 THEN 'medium' ELSE 'high' END AS reliability, "
        f"{reasons}{firsts} FROM r2"
    )


def report_checks() -> str:
    unit = lambda c: f"(NOT ({c} BETWEEN 0.0 AND 1.0) OR {c} IS NULL)"
    labels = "('positive', 'negative', 'neutral')"
    return (
        f"SELECT count(*) AS n_reports, count(*) FILTER (WHERE {unit('finbert_confidence')}) AS bad_confidence, "
        f"count(*) FILTER (WHERE {unit('uncertainty')} OR {unit('litigious')} OR {unit('constraining')}) AS bad_shares, "
        f"count(*) FILTER (WHERE {unit('bias_score')}) AS bad_score, "
        f"count(*) FILTER (WHERE finbert_label NOT IN {labels} OR finbert_label IS NULL) AS bad_finbert_label, "
        f"count(*) FILTER (WHERE lexicon_label NOT IN {labels} OR lexicon_label IS NULL) AS bad_lexicon_label, "
        f"count(*) FILTER (WHERE reliability NOT IN ('high', 'medium', 'low')) AS bad_tier "
        f"FROM ({report_flat()})"
    )


def report_nested_json() -> str:
    counts = ", ".join(f"CASE WHEN n_{c} > 0 THEN {{'p': first_{c}, 'key': '{c}', "
                       f"'value': CAST(n_{c} AS INTEGER)}} END" for c in CATS)
    return (
        f"WITH f AS ({report_flat(with_positions=True)}) SELECT doc_id, CAST(json_object("
        f"'summary', summary, "
        f"'finbert', json_object('label', finbert_label, 'confidence', finbert_confidence), "
        f"'lexicon', json_object('label', lexicon_label, 'counts', "
        f"map_from_entries(list_transform(list_sort(list_filter([{counts}], lambda e: e IS NOT NULL)), "
        f"lambda e: {{'key': e.key, 'value': e.value}}))), "
        f"'bias', json_object('uncertainty', uncertainty, 'litigious', litigious, 'constraining', constraining, "
        f"'score', bias_score, 'flag', bias_flag), "
        f"'agreement', agreement, 'reliability', reliability, "
        f"'reasons', rs) AS VARCHAR) AS json "
        f"FROM f")


def report_json_text() -> str:
    flat = report_flat(with_positions=True)
    lit = s.q  # SQL literal of a piece of JSON text

    def obj(*pairs: tuple[str, str]) -> str:
        parts = []
        for k, (key, value) in enumerate(pairs):
            parts.append(lit(("" if k == 0 else ", ") + '"' + key + '": '))
            parts.append(value)
        return " || ".join([lit("{")] + parts + [lit("}")])

    firsts = ", ".join(f"CASE WHEN n_{c} > 0 THEN {{'p': first_{c}, 'tag': '{c}', 'n': n_{c}}} END"
                       for c in CATS)
    entry = f"{lit(chr(34))} || e.tag || {lit(chr(34) + ': ')} || CAST(e.n AS VARCHAR)"
    counts = (f"{lit('{')} || array_to_string(list_transform(list_sort(list_filter([{firsts}], "
              f"lambda e: e IS NOT NULL)), lambda e: {entry}), ', ') || {lit('}')}")
    reasons = (f"{lit('[')} || array_to_string(list_transform(rs, lambda r: {s.json_string_sql('r')}), "
               f"', ') || {lit(']')}")
    body = obj(
        ("summary", s.json_string_sql("summary")),
        ("finbert", obj(("label", s.json_string_sql("finbert_label")),
                        ("confidence", s.json_number4_sql("finbert_confidence")))),
        ("lexicon", obj(("label", s.json_string_sql("lexicon_label")), ("counts", counts))),
        ("bias", obj(*[(c, s.json_number4_sql(c)) for c in lx.BIAS_CATEGORIES],
                     ("score", s.json_number4_sql("bias_score")),
                     ("flag", s.json_bool_sql("bias_flag")))),
        ("agreement", s.json_bool_sql("agreement")),
        ("reliability", s.json_string_sql("reliability")),
        ("reasons", reasons))
    return f"SELECT doc_id, {body} AS json FROM ({flat})"


def token_tags() -> str:
    names = "['cns', " + ", ".join(s.q(c) for c in CATS) + "]"
    tag_sql = s.tagged_cte("documents").replace(
        "tagged0 AS (SELECT t.id, t.pos,", "tagged0 AS (SELECT t.id, t.pos, t.token,")
    return (f"WITH {s.lookup_cte()}, {tag_sql} "
            f"SELECT id AS doc_id, pos, token, ({names})[code + 1] AS tag FROM tagged")


def tag_lists() -> str:
    names = "['cns', " + ", ".join(s.q(c) for c in CATS) + "]"
    return (f"WITH {s.lookup_cte()}, {s.tagged_cte('documents')}, "
            f"agg AS (SELECT id, string_agg(({names})[code + 1], ',' ORDER BY pos) AS l FROM tagged GROUP BY id) "
            f"SELECT d.doc_id, coalesce(agg.l, '') AS sentiment_list FROM documents d LEFT JOIN agg ON d.doc_id = agg.id")


def rule_based_labels() -> str:
    return (f"SELECT doc_id, n_cns, n_tags, lexicon_tag, lexicon_label FROM "
            f"({s.signals_query(stopword_mode='in_dictionary', litigious='drop')})")


def dictionary_profile() -> str:
    cats = ", ".join(f"count(*) FILTER (WHERE {c} <> 0) AS n_{c}" for c in CATS + ('complexity',))
    return (f"WITH {s.derived_dictionary_cte()} "
            f"SELECT count(*) AS n_words, {cats}, CAST(sum(doc_count) AS BIGINT) AS total_documents, "
            f"count(*) FILTER (WHERE dict.word IN ({s.STOPWORDS_SQL})) AS n_stopwords "
            f"FROM dict")


def dictionary_log() -> str:
    def grouped(x: str) -> str:
        return f"format('{{:,}}', {x})"
    lines = [f"'    ' || {grouped('n_words')} || ' words loaded in master_dictionary.'",
             "'    Sentiment:'"]
    lines += [f"printf('      %-13s: %8s', '{c}', {grouped('n_' + c)})" for c in lx.LOG_CATEGORIES]
    rows = " UNION ALL ".join(f"SELECT {i} AS line_no, {ln} AS line FROM p" for i, ln in enumerate(lines))
    return f"WITH p AS ({dictionary_profile()}) {rows}"


def bias_flag_rate() -> str:
    return (f"SELECT flagged, total, round(CASE WHEN total > 0 THEN CAST(flagged AS DOUBLE) * 100.0 / total END, 1) "
            f"AS percent FROM (SELECT count(*) FILTER (WHERE bias_flag) AS flagged, count(*) AS total "
            f"FROM ({s.signals_query()}))")


# ---- standardise / clean ------------------------------------------------------


def _std_parts() -> str:
    sent = (f"SELECT {s.py_strip_sql('data')} AS data, 'sentence' AS datatype, "
            f"{s.string_label_sql('sentiment')} AS sentiment FROM sentences")
    head = (f"SELECT {s.py_strip_sql('title')} AS data, 'headline' AS datatype, "
            f"{s.numeric_label_sql('gs')} AS sentiment FROM headlines")
    return (f"WITH {s.labelled_sources_ctes()}, "
            f"std AS (SELECT * FROM ({sent}) WHERE data IS NOT NULL AND sentiment IS NOT NULL AND data <> '' "
            f"UNION ALL SELECT * FROM ({head}) WHERE data IS NOT NULL AND sentiment IS NOT NULL AND data <> '')")


def standardised_sources() -> str:
    return f"{_std_parts()} SELECT data, datatype, sentiment FROM std"


def stitched() -> str:
    return (f"{_std_parts()} SELECT DISTINCT data, datatype, sentiment FROM "
            f"(SELECT {s.clean_text_sql('data')} AS data, datatype, sentiment FROM std) WHERE data <> ''")


def clean_pages() -> str:
    return f"SELECT page_id, {s.clean_text_sql('html')} AS clean FROM pages"


def strip_markup_pages() -> str:
    return f"SELECT page_id, {s.markup_sql('html')} AS stripped FROM pages"


def ascii_fold_documents() -> str:
    return f"SELECT doc_id, {s.fold_sql('text')} AS folded FROM documents"


def pairs_light_clean() -> str:
    return (f"SELECT u.conv_id, u.turn, {s.light_clean_sql('u.text')} AS article, "
            f"{s.light_clean_sql('a.text')} AS summary FROM conversations u JOIN conversations a "
            f"ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'")


def label_codes() -> str:
    return (f"WITH {s.labelled_sources_ctes()}, both_l AS ("
            f"SELECT doc_id, {s.string_label_sql('sentiment')} AS label FROM sentences UNION ALL "
            f"SELECT doc_id, {s.numeric_label_sql('gs')} AS label FROM headlines) "
            f"SELECT doc_id, label, CASE label WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 "
            f"WHEN 'neutral' THEN 2 END AS label_index, CASE label WHEN 'positive' THEN 1 "
            f"WHEN 'negative' THEN -1 WHEN 'neutral' THEN 0 END AS label_sign FROM both_l")


def input_guard() -> str:
    return (f"WITH {s.labelled_sources_ctes()}, arts AS (SELECT doc_id, data AS text FROM sentences "
            f"UNION ALL SELECT doc_id, title AS text FROM headlines) "
            f"SELECT doc_id, (text IS NOT NULL AND {s.py_strip_sql('text')} <> '') AS accepted, "
            f"CASE WHEN text IS NOT NULL AND {s.py_strip_sql('text')} <> '' "
            f"THEN CAST(length({s.py_strip_sql('text')}) AS BIGINT) END AS n_chars FROM arts")


def prompted_articles() -> str:
    from lexiscope.functions.text import NEUTRAL_PROMPT_PREFIX
    p = f"({s.q(NEUTRAL_PROMPT_PREFIX)} || text)"
    return f"SELECT doc_id, md5({p}) AS prompt_md5, CAST(length({p}) AS BIGINT) AS prompt_chars FROM documents"


# ---- sampling / splits ----------------------------------------------------------

TRUTH = ("truth AS (SELECT doc_id, CASE WHEN quality - toxic > 0 THEN 'positive' "
         "WHEN quality - toxic < 0 THEN 'negative' WHEN quality - toxic = 0 THEN 'neutral' END "
         "AS label FROM labels)")


def _u(key: str) -> str:
    return f"(CAST({seeded_hash_sql(key)} AS DOUBLE) / 4294967296.0)"


def _threshold_case(key: str, weights: dict) -> str:
    parts = []
    for split, bound in sm.thresholds(weights):
        parts.append(f"ELSE {s.q(split)}" if bound is None
                     else f"WHEN {_u(key)} < {bound!r} THEN {s.q(split)}")
    return "CASE " + " ".join(parts) + " END"


def seeded_shuffle() -> str:
    return f"SELECT doc_id, {seeded_hash_sql('doc_id')} AS h FROM documents"


def seeded_subset() -> str:
    return f"SELECT doc_id, {seeded_hash_sql('doc_id')} AS h FROM documents ORDER BY h, doc_id LIMIT 1500"


def fraction_sample() -> str:
    return f"WITH {TRUTH} SELECT doc_id, label FROM truth WHERE {_u('doc_id')} < 0.5"


def train_test_split() -> str:
    return f"WITH {TRUTH} SELECT doc_id, label, {_threshold_case('doc_id', sm.TRAIN_TEST)} AS split FROM truth"


def train_val_test_split() -> str:
    return f"SELECT doc_id, {_threshold_case('doc_id', sm.TRAIN_VAL_TEST)} AS split FROM documents"


def _strat_cte() -> str:
    return (f"{TRUTH}, hr AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY "
            f"{seeded_hash_sql('doc_id')}, doc_id) - 1 AS r, count(*) OVER (PARTITION BY label) AS n_c FROM truth), "
            f"qt AS (SELECT *, CAST(ceil(n_c * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_test FROM hr), "
            f"strat AS (SELECT doc_id, label, CASE WHEN r < n_test THEN 'test' WHEN r < n_test + "
            f"CAST(ceil((n_c - n_test) * CAST(0.2 AS DOUBLE)) AS BIGINT) THEN 'validation' ELSE 'train' END AS split FROM qt)")


def stratified_split() -> str:
    return f"WITH {_strat_cte()} SELECT doc_id, label, split FROM strat"


# ---- evaluation ---------------------------------------------------------------


def split_counts() -> str:
    return f"WITH {_strat_cte()} SELECT split, count(*) AS n FROM strat GROUP BY split"


def class_weights() -> str:
    return (f"WITH {_strat_cte()}, c AS (SELECT label, count(*) AS n_c FROM strat WHERE split = 'train' "
            f"AND label IS NOT NULL GROUP BY label) SELECT label, n_c, CAST(sum(n_c) OVER () AS DOUBLE) / "
            f"(count(*) OVER () * n_c) AS weight FROM c")


def _rule_pairs() -> str:
    return (f"pairs AS (SELECT t.label AS true_label, g.lexicon_label AS pred_label FROM truth t JOIN "
            f"({s.signals_query(stopword_mode='in_dictionary', litigious='drop')}) g ON t.doc_id = g.doc_id "
            f"WHERE t.label IS NOT NULL AND g.lexicon_label IS NOT NULL), "
            f"pc AS (SELECT true_label, pred_label, count(*) AS n FROM pairs GROUP BY ALL)")


def confusion_matrix() -> str:
    labels = ev.LABELS
    grid = ", ".join(f"({s.q(t)}, {s.q(p)}, {i * 3 + j})" for i, t in enumerate(labels)
                     for j, p in enumerate(labels))
    return (f"WITH {TRUTH}, {_rule_pairs()}, grid(true_label, pred_label, cell) AS (VALUES {grid}) "
            f"SELECT g.true_label, g.pred_label, coalesce(pc.n, 0) AS n, g.cell FROM grid g LEFT JOIN pc "
            f"ON g.true_label = pc.true_label AND g.pred_label = pc.pred_label")


def classification_metrics() -> str:
    return (f"WITH {TRUTH}, {_rule_pairs()}, "
            f"sup AS (SELECT true_label AS label, sum(n) AS support FROM pc GROUP BY 1), "
            f"prd AS (SELECT pred_label AS label, sum(n) AS predicted FROM pc GROUP BY 1), "
            f"tp AS (SELECT true_label AS label, n AS tp FROM pc WHERE true_label = pred_label), "
            f"per AS (SELECT coalesce(sup.label, prd.label) AS label, coalesce(support, 0) AS support, "
            f"coalesce(predicted, 0) AS predicted FROM sup FULL JOIN prd ON sup.label = prd.label), "
            f"per2 AS (SELECT per.*, coalesce(tp.tp, 0) AS tp FROM per LEFT JOIN tp ON per.label = tp.label), "
            f"m AS (SELECT support, tp, "
            f"CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS p, "
            f"CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS r, "
            f"CASE WHEN 2 * tp + (predicted - tp) + (support - tp) > 0 THEN CAST(2 * tp AS DOUBLE) / "
            f"(2 * tp + (predicted - tp) + (support - tp)) ELSE 0.0 END AS f FROM per2) "
            f"SELECT CAST(sum(support) AS BIGINT) AS n, round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy, "
            f"round(sum(p * support) / sum(support), 6) AS precision, round(sum(r * support) / sum(support), 6) AS recall, "
            f"round(sum(f * support) / sum(support), 6) AS f1 FROM m")


def per_row_results() -> str:
    return (f"WITH {_strat_cte()}, rep AS ({report_flat()}) "
            f"SELECT r.doc_id, r.finbert_label AS sentiment, r.finbert_confidence AS confidence, r.uncertainty, "
            f"r.litigious, r.constraining, r.bias_score, r.bias_flag, st.label AS true_sentiment "
            f"FROM rep r JOIN strat st ON r.doc_id = st.doc_id WHERE st.split = 'test'")


# ---- summaries and ROUGE ---------------------------------------------------------

PAIRS = ("pairs AS (SELECT u.conv_id, u.turn, u.text AS article, a.text AS summary FROM conversations u "
         "JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 "
         "WHERE u.role = 'user' AND a.role = 'assistant')")


def _rtok(x: str) -> str:
    return (f"list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), "
            f"lambda t: t <> '')")


def _big(x: str) -> str:
    return f"list_transform(range(1, len({x})), lambda i: {x}[i] || ' ' || {x}[i + 1])"


def _rouge_n_cte(pairs: str = PAIRS) -> str:
    g = " UNION ALL ".join(
        f"SELECT conv_id, turn, {n} AS n, '{side}' AS side, unnest({expr}) AS g FROM tk"
        for n, side, expr in ((1, "p", "tp"), (1, "r", "tr"), (2, "p", _big("tp")), (2, "r", _big("tr"))))
    sums = ", ".join(f"sum(CASE WHEN n = {n} THEN least(cp, cr) END) AS o{n}, "
                     f"sum(CASE WHEN n = {n} THEN cp END) AS np{n}, sum(CASE WHEN n = {n} THEN cr END) AS nr{n}"
                     for n in (1, 2))
    cols = []
    for n in (1, 2):
        o = f"CAST(coalesce(pp.o{n}, 0) AS DOUBLE)"
        p = f"({o} / greatest(coalesce(pp.np{n}, 0), 1))"
        r = f"({o} / greatest(coalesce(pp.nr{n}, 0), 1))"
        cols += [f"{p} AS rouge{n}_p", f"{r} AS rouge{n}_r",
                 f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END AS rouge{n}_f"]
    return (f"{pairs}, tk AS (SELECT conv_id, turn, {_rtok('summary')} AS tp, {_rtok('article')} AS tr FROM pairs), "
            f"g AS ({g}), pg AS (SELECT conv_id, turn, n, g, count(*) FILTER (WHERE side = 'p') AS cp, "
            f"count(*) FILTER (WHERE side = 'r') AS cr FROM g GROUP BY ALL), "
            f"pp AS (SELECT conv_id, turn, {sums} FROM pg GROUP BY ALL), "
            f"rn AS (SELECT k.conv_id, k.turn, {', '.join(cols)} FROM pairs k LEFT JOIN pp "
            f"ON k.conv_id = pp.conv_id AND k.turn = pp.turn)")


def rouge_n_pairs() -> str:
    return f"WITH {_rouge_n_cte()} SELECT * FROM rn"


def rouge_n_mean() -> str:
    return f"WITH {_rouge_n_cte()} SELECT round(avg(rouge1_f), 3) AS rouge1, round(avg(rouge2_f), 3) AS rouge2 FROM rn"


def _lines(x: str) -> str:
    return f"string_split(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9\\n]+', ' ', 'g'), chr(10))"


def _rouge_l_cte() -> str:
    """ROUGE-L and Lsum of ``pairs`` from whole DP tables, one recursion step per candidate token, and a step-by-step
    walk back through those of sentence pairs; needs ``tk``."""
    key = "conv_id, turn, rs, cs"

    def sentences(side: str, col: str) -> str:
        return (f"{side} AS (SELECT conv_id, turn, s, {_rtok('line')} AS t FROM (SELECT conv_id, turn, "
                f"unnest({_lines(col)}) AS line, generate_subscripts({_lines(col)}, 1) AS s FROM pairs))")

    return (f"{sentences('rsent', 'article')}, {sentences('csent', 'summary')}, "
            f"u AS (SELECT * FROM (SELECT conv_id, turn, 0 AS rs, 0 AS cs, tr AS r, tp AS c FROM tk UNION ALL "
            f"SELECT a.conv_id, a.turn, a.s, b.s, a.t, b.t FROM rsent a JOIN csent b ON a.conv_id = b.conv_id "
            f"AND a.turn = b.turn) WHERE len(r) > 0 AND len(c) > 0), "
            f"cell AS (SELECT {key}, 0::BIGINT AS j, unnest(range(0, len(r) + 1)) AS i, 0::BIGINT AS v FROM u UNION ALL "
            f"SELECT {key}, j, i, max(x) OVER (PARTITION BY {key} ORDER BY i) AS v FROM ("
            f"SELECT k.conv_id, k.turn, k.rs, k.cs, k.j + 1 AS j, k.i, CASE WHEN k.i > 0 AND u.r[k.i] = u.c[k.j + 1] "
            f"THEN lag(k.v) OVER (PARTITION BY k.conv_id, k.turn, k.rs, k.cs ORDER BY k.i) + 1 ELSE k.v END AS x "
            f"FROM cell k JOIN u ON k.conv_id = u.conv_id AND k.turn = u.turn AND k.rs = u.rs AND k.cs = u.cs "
            f"WHERE k.j < len(u.c))), "
            f"sc AS MATERIALIZED (SELECT * FROM cell WHERE rs > 0), "
            f"walk AS (SELECT {key}, len(r)::BIGINT AS i, len(c)::BIGINT AS j, NULL::BIGINT AS hit FROM u WHERE rs > 0 UNION ALL "
            f"SELECT w.conv_id, w.turn, w.rs, w.cs, "
            f"CASE WHEN u.r[w.i] = u.c[w.j] OR a.v <= b.v THEN w.i - 1 ELSE w.i END, "
            f"CASE WHEN u.r[w.i] = u.c[w.j] OR a.v > b.v THEN w.j - 1 ELSE w.j END, "
            f"CASE WHEN u.r[w.i] = u.c[w.j] THEN w.i END "
            f"FROM walk w JOIN u ON w.conv_id = u.conv_id AND w.turn = u.turn AND w.rs = u.rs AND w.cs = u.cs "
            f"JOIN sc a ON a.conv_id = w.conv_id AND a.turn = w.turn AND a.rs = w.rs AND a.cs = w.cs AND a.i = w.i AND a.j = w.j - 1 "
            f"JOIN sc b ON b.conv_id = w.conv_id AND b.turn = w.turn AND b.rs = w.rs AND b.cs = w.cs AND b.i = w.i - 1 AND b.j = w.j "
            f"WHERE w.i > 0 AND w.j > 0), "
            f"found AS (SELECT h.conv_id, h.turn, s.t[h.hit] AS tok, count(*) AS n FROM (SELECT DISTINCT conv_id, turn, rs, hit "
            f"FROM walk WHERE hit IS NOT NULL) h JOIN rsent s ON s.conv_id = h.conv_id AND s.turn = h.turn AND s.s = h.rs GROUP BY ALL), "
            f"has AS (SELECT conv_id, turn, tok, count(*) AS n FROM (SELECT conv_id, turn, unnest(t) AS tok FROM csent) GROUP BY ALL), "
            f"hits AS (SELECT f.conv_id, f.turn, sum(least(f.n, has.n)) AS hits FROM found f JOIN has ON f.conv_id = has.conv_id "
            f"AND f.turn = has.turn AND f.tok = has.tok GROUP BY ALL), "
            f"lcs AS (SELECT conv_id, turn, max(v) AS lcs FROM cell WHERE rs = 0 GROUP BY ALL), "
            f"rl AS (SELECT tk.conv_id, tk.turn, {_f_sql('lcs')} AS rougeL_f, {_f_sql('hits')} AS rougeLsum_f FROM tk "
            f"LEFT JOIN lcs ON lcs.conv_id = tk.conv_id AND lcs.turn = tk.turn "
            f"LEFT JOIN hits ON hits.conv_id = tk.conv_id AND hits.turn = tk.turn)")


def _f_sql(x: str) -> str:
    p, r = (f"(CAST(coalesce({x}, 0) AS DOUBLE) / greatest(len({side}), 1))" for side in ("tp", "tr"))
    return f"CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


def rouge_l_pairs() -> str:
    return (f"WITH RECURSIVE {PAIRS}, tk AS (SELECT conv_id, turn, {_rtok('summary')} AS tp, {_rtok('article')} AS tr "
            f"FROM pairs), {_rouge_l_cte()} SELECT * FROM rl")


def _stemmed_pairs() -> str:
    """``pairs`` with both texts as lines of stems."""
    raw = PAIRS.replace("pairs AS", "raw AS", 1)
    lines = " UNION ALL ".join(
        f"SELECT conv_id, turn, '{col}' AS side, unnest({_lines(col)}) AS line, generate_subscripts({_lines(col)}, 1) AS s FROM raw"
        for col in ("article", "summary"))
    steps = ", ".join(f"p{i + 1} AS (SELECT word, {stage} AS w FROM p{i})"
                      for i, stage in enumerate(stems.stages("regexp_matches")))
    whole = ", ".join(f"coalesce(string_agg(line, chr(10) ORDER BY s) FILTER (WHERE side = '{c}'), '') AS {c}"
                      for c in ("article", "summary"))
    return (f"{raw}, li AS ({lines}), wo AS (SELECT conv_id, turn, side, s, unnest({_rtok('line')}) AS word, "
            f"generate_subscripts({_rtok('line')}, 1) AS pos FROM li), p0 AS (SELECT DISTINCT word, word AS w FROM wo), {steps}, "
            f"st AS (SELECT word, CASE WHEN length(word) > {stems.SHORT} THEN w ELSE word END AS stem "
            f"FROM p{len(stems.stages())}), "
            f"sl AS (SELECT conv_id, turn, side, s, string_agg(stem, ' ' ORDER BY pos) AS line FROM wo JOIN st "
            f"ON wo.word = st.word GROUP BY ALL), "
            f"sp AS (SELECT conv_id, turn, {whole} FROM sl GROUP BY conv_id, turn), "
            f"pairs AS (SELECT raw.conv_id, raw.turn, coalesce(sp.article, '') AS article, coalesce(sp.summary, '') AS summary "
            f"FROM raw LEFT JOIN sp ON raw.conv_id = sp.conv_id AND raw.turn = sp.turn)")


def _stemmed_scores() -> str:
    return (f"{_rouge_n_cte(_stemmed_pairs())}, {_rouge_l_cte()}, scores AS (SELECT rn.conv_id, rn.turn, rouge1_f, rouge2_f, "
            f"rougeL_f, rougeLsum_f FROM rn JOIN rl ON rn.conv_id = rl.conv_id AND rn.turn = rl.turn)")


def rouge_stemmed() -> str:
    return f"WITH RECURSIVE {_stemmed_scores()} SELECT * FROM scores"


def rouge_bootstrap() -> str:
    cols = ("rouge1_f", "rouge2_f", "rougeL_f", "rougeLsum_f")
    units = ", ".join(f"CAST(round({c} * {rg.SCORE_UNITS}) AS BIGINT) AS {c}" for c in cols)
    draw = " + ".join(f"(u >= {t})::INT" for t in rg.poisson_steps())
    draws = " UNION ALL ".join(
        f"SELECT block, {i} AS i, CAST(('0x' || substr(h, {4 * i + 1}, 4))::UBIGINT AS BIGINT) AS u, {', '.join(cols)} FROM e"
        for i in range(rg.PER_HASH))
    means = " UNION ALL ".join(
        f"SELECT '{c.removesuffix('_f')}' AS metric, sum(w * {c}) / sum(w) / {rg.SCORE_UNITS} AS mean FROM d "
        f"GROUP BY block, i HAVING sum(w) > 0" for c in cols)
    tail = (1 - rg.CONFIDENCE) / 2
    marks = ", ".join(f"round(quantile_cont(mean, {p!r}), 6) AS {n}"
                      for n, p in (("low", tail), ("mid", 0.5), ("high", 1 - tail)))
    blocks = -(-rg.REPLICATES // rg.PER_HASH)
    return (f"WITH RECURSIVE {_stemmed_scores()}, e AS (SELECT block, md5('42:' || block || ':' || conv_id || ':' || turn) AS h, "
            f"{units} FROM scores, range({blocks}) t(block)), d AS (SELECT *, {draw} AS w FROM ({draws})), "
            f"m AS ({means}) SELECT metric, {marks} FROM m GROUP BY metric")


def _wc(x: str) -> str:
    return (f"len(list_filter(regexp_split_to_array(coalesce({x}, ''), '[ \\t\\n\\r\\f\\x0B]+'), "
            f"lambda t: t <> ''))")


def summary_checks() -> str:
    sw, aw = _wc("p.summary"), _wc("p.article")
    return (f"WITH {_rouge_n_cte()}, j AS (SELECT p.*, rn.rouge1_f, rn.rouge2_f FROM pairs p LEFT JOIN rn "
            f"ON p.conv_id = rn.conv_id AND p.turn = rn.turn) "
            f"SELECT count(*) AS n, count(*) FILTER (WHERE trim(coalesce(summary, '')) = '') AS n_empty, "
            f"count(*) FILTER (WHERE {sw.replace('p.', '')} < 8) AS n_too_short, "
            f"count(*) FILTER (WHERE {sw.replace('p.', '')} > 142) AS n_too_long, "
            f"count(*) FILTER (WHERE CAST({sw.replace('p.', '')} AS DOUBLE) / greatest({aw.replace('p.', '')}, 1) >= 0.85) "
            f"AS n_not_compressed, count(DISTINCT summary) AS n_distinct, "
            f"round(avg(rouge1_f), 3) AS rouge1, round(avg(rouge2_f), 3) AS rouge2, "
            f"count(DISTINCT summary) = count(*) AS all_distinct, "
            f"(round(avg(rouge1_f), 3) > 0.2 AND round(avg(rouge2_f), 3) > 0.05) AS rouge_floor_ok FROM j")


def stub_summaries() -> str:
    return f"SELECT doc_id, {s.lead_summary_sql('text')} AS summary FROM documents"


def summary_stability() -> str:
    return (f"WITH a AS ({stub_summaries()}), b AS ({stub_summaries()}) SELECT count(*) AS n, "
            f"count(*) FILTER (WHERE a.summary IS DISTINCT FROM b.summary) AS n_changed "
            f"FROM a JOIN b ON a.doc_id = b.doc_id")


# ---- training curves ---------------------------------------------------------------

LOG = ("log AS (SELECT user_id AS run, ts, event_id, "
       "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 86400000000.0 AS epoch, "
       "CASE WHEN event_type <> 'error' THEN value END AS loss, "
       "CASE WHEN event_type = 'error' THEN value END AS eval_loss, "
       "CASE WHEN event_type = 'error' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 END AS eval_accuracy, "
       "CASE WHEN event_type = 'signup' THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 END AS \"eval_rougeL\" "
       "FROM events), "
       "steps AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ts, event_id) AS step FROM log)")


def log_series() -> str:
    return f"WITH {LOG} " + " UNION ALL ".join(
        f"SELECT run, step, '{c}' AS series, \"{c}\" AS value FROM steps WHERE \"{c}\" IS NOT NULL" for c in SERIES)


def loss_moving_average() -> str:
    return (f"WITH {LOG}, tr AS (SELECT run, step, loss, row_number() OVER (PARTITION BY run ORDER BY step) - 1 AS i, "
            f"greatest(1, count(*) OVER (PARTITION BY run) // 100) AS w FROM steps "
            f"WHERE loss IS NOT NULL AND eval_loss IS NULL AND epoch IS NOT NULL) "
            f"SELECT a.run, a.step, a.loss, CAST(a.w AS INTEGER) AS window, round(avg(b.loss), 6) AS smoothed "
            f"FROM tr a JOIN tr b ON a.run = b.run AND b.i BETWEEN a.i - a.w AND a.i GROUP BY a.run, a.step, a.loss, a.w")


def newest_training_logs() -> str:
    return (f"WITH e AS (SELECT user_id AS run, event_id AS step, event_type, value, epoch_us(ts) AS us FROM events), "
            f"k AS (SELECT *, 1 + (us - (SELECT min(us) FROM e)) * 3 // (SELECT max(us) - min(us) + 1 FROM e) AS checkpoint FROM e) "
            f"SELECT run, CAST(checkpoint AS BIGINT) AS checkpoint, step, CASE WHEN event_type <> 'error' THEN value END AS loss, "
            f"CASE WHEN event_type = 'error' THEN value END AS eval_loss FROM k "
            f"QUALIFY checkpoint = max(checkpoint) OVER (PARTITION BY run)")


def epoch_mean_loss() -> str:
    return (f"WITH {LOG} SELECT run, CAST(ceil(epoch) AS INTEGER) AS epoch, round(avg(loss), 6) AS mean_loss "
            f"FROM log WHERE loss IS NOT NULL AND eval_loss IS NULL AND epoch IS NOT NULL GROUP BY ALL")


def epoch_last_eval() -> str:
    return (f"WITH {LOG} SELECT run, CAST(round_even(epoch, 0) AS INTEGER) AS epoch, "
            f"arg_max(eval_loss, {{'t': ts, 'e': event_id}}) AS eval_loss FROM log WHERE eval_loss IS NOT NULL AND epoch IS NOT NULL GROUP BY ALL")


def best_run() -> str:
    return ("SELECT CAST(run AS VARCHAR) AS run, score FROM (SELECT user_id AS run, "
            "avg(CASE WHEN event_type = 'purchase' THEN value END) AS score FROM events GROUP BY user_id) "
            "ORDER BY score DESC NULLS LAST, run LIMIT 1")


# ---- statistical model -------------------------------------------------------------


def tfidf_features() -> str:
    from lexiscope.operators.models import MAX_FEATURES, TOKEN_PATTERN
    split = _threshold_case("t.doc_id", sm.TRAIN_TEST)
    return (
        f"WITH {TRUTH}, data AS (SELECT t.doc_id, d.text, {split} AS split FROM truth t JOIN documents d "
        f"ON t.doc_id = d.doc_id), "
        f"tt AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN}')) AS term FROM data "
        f"WHERE split = 'train'), "
        f"pd AS (SELECT doc_id, term, count(*) AS tf FROM tt GROUP BY ALL), "
        f"st AS (SELECT term, sum(tf) AS tf_total, count(*) AS df FROM pd GROUP BY term), "
        f"vocab AS (SELECT * FROM st ORDER BY tf_total DESC, term LIMIT {MAX_FEATURES}), "
        f"n AS (SELECT count(DISTINCT doc_id) AS n FROM data WHERE split = 'train'), "
        f"idf AS (SELECT term, ln((1.0 + n.n) / (1.0 + df)) + 1.0 AS idf FROM vocab, n), "
        f"dt AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN_PATTERN}')) AS term FROM data), "
        f"w AS (SELECT dt.doc_id, dt.term, count(*) * any_value(idf.idf) AS w FROM dt JOIN idf ON dt.term = idf.term "
        f"GROUP BY dt.doc_id, dt.term), "
        f"nm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id) "
        f"SELECT w.doc_id, w.term, round(w.w / nm.norm, 9) AS weight FROM w JOIN nm ON w.doc_id = nm.doc_id")


def rff_features() -> str:
    from lexiscope.operators.models import HASH_UNITS
    from lexiscope.plans.queries import RFF_COMPONENTS as n
    hexed = lambda h, at: f"CAST(('0x' || substr({h}, {at}, 12))::UBIGINT AS DOUBLE)"
    split = _threshold_case("doc_id", sm.TRAIN_TEST)
    radius = f"sqrt(-2.0 * ln(({hexed('h', 1)} + 1) / {HASH_UNITS}))"
    angle = f"2 * pi() * ({hexed('h', 13)} / {HASH_UNITS})"
    return (
        f"WITH x AS ({tfidf_features()}), tr AS (SELECT doc_id FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) "
        f"AND quality IS NOT NULL AND toxic IS NOT NULL AND {split} = 'train'), "
        f"size AS (SELECT (SELECT count(*) FROM tr) AS rows, (SELECT count(DISTINCT term) FROM x) AS cols, "
        f"sum(weight) AS s, sum(weight * weight) AS q FROM x WHERE doc_id IN (SELECT doc_id FROM tr)), "
        f"g AS (SELECT 1.0 / (cols * (q / (rows * cols) - (s / (rows * cols)) * (s / (rows * cols)))) AS gamma FROM size), "
        f"k AS (SELECT term, k, md5('42:' || k || ':' || term) AS h FROM (SELECT DISTINCT term FROM x), range({n // 2}) t(k)), "
        f"w AS (SELECT term, 2 * k AS component, {radius} * cos({angle}) AS w FROM k UNION ALL "
        f"SELECT term, 2 * k + 1, {radius} * sin({angle}) FROM k), "
        f"z AS (SELECT doc_id, component, sum(weight * w) AS z FROM x JOIN w ON x.term = w.term GROUP BY ALL), "
        f"p AS (SELECT c AS component, 2 * pi() * ({hexed(chr(39).join(['md5(', '42:phase:', ' || c)']), 13)} / {HASH_UNITS}) AS b "
        f"FROM range({n}) t(c)) "
        f"SELECT doc_id, CAST(z.component AS INTEGER) AS component, "
        f"round(sqrt(2.0 / {n}) * cos(sqrt(2.0 * gamma) * z + b), 6) AS value FROM z JOIN p ON z.component = p.component, g")


# ---- sources and sinks (round trips) -------------------------------------------------


def csv_pairs_by_split() -> str:
    split = _threshold_case("conv_id", sm.TRAIN_VAL_TEST)
    return (f"WITH {PAIRS} SELECT {s.py_strip_sql('article')} AS article, {s.py_strip_sql('summary')} AS summary, "
            f"{split} AS split FROM pairs")


def tag_list_text_roundtrip() -> str:
    return (f"WITH {TRUTH}, tl AS ({tag_lists()}) SELECT tl.doc_id, t.label AS sentiment, tl.sentiment_list "
            f"FROM tl JOIN truth t ON tl.doc_id = t.doc_id JOIN documents d ON d.doc_id = tl.doc_id")


def reports_json_roundtrip() -> str:
    return (f"SELECT doc_id, summary, finbert_label, finbert_confidence, lexicon_label, bias_score, bias_flag, "
            f"agreement, reliability, reasons FROM ({report_flat()})")


def csv_pair_file() -> str:
    return (f"WITH {PAIRS} SELECT {s.light_clean_sql('article')} AS article, "
            f"{s.light_clean_sql('summary')} AS summary FROM pairs")


def dictionary_csv_profile() -> str:
    cats = ", ".join(f"count(*) FILTER (WHERE {c} <> 0) AS n_{c}" for c in CATS + ('complexity',))
    kept = " OR ".join(f"{c} > 0" for c in CATS)
    return (f"WITH {s.derived_dictionary_cte()} "
            f"SELECT count(*) AS n_words, {cats}, CAST(sum(doc_count) AS BIGINT) AS total_documents, "
            f"count(*) FILTER (WHERE dict.word IN ({s.STOPWORDS_SQL})) AS n_stopwords, "
            f"count(*) FILTER (WHERE ({kept}) OR dict.word IN ({s.STOPWORDS_SQL})) AS lookup_rows "
            f"FROM dict")


def text_corpus_reports() -> str:
    return f"SELECT doc_id, lexicon_label, n_tags, bias_score, reliability FROM ({report_flat()})"


def report_stream_versioned() -> str:
    even = "coalesce(doc_id % 2 = 0, false)"
    return (f"SELECT *, CAST(1 AS BIGINT) AS dictionary_version FROM ({report_flat()}) WHERE {even} UNION ALL BY NAME "
            f"SELECT *, CAST(2 AS BIGINT) AS dictionary_version FROM ({report_flat(derived=True)}) WHERE NOT {even}")


def softmax_from_counts() -> str:
    z = "[CAST(n_positive AS DOUBLE), CAST(n_negative AS DOUBLE), CAST(n_uncertainty AS DOUBLE)]"
    return (f"WITH g AS ({s.signals_query()}), e AS (SELECT doc_id, list_transform({z}, "
            f"lambda x: exp(x - list_max({z}))) AS ex FROM g), "
            f"p AS (SELECT doc_id, list_transform(ex, lambda x: x / list_sum(ex)) AS pr FROM e) "
            f"SELECT doc_id, (['positive', 'negative', 'neutral'])[list_position(pr, list_max(pr))] AS label, "
            f"round(pr[list_position(pr, list_max(pr))], 4) AS confidence FROM p")


ORACLES = {
    "lexicon_signals": lexicon_signals,
    "report_flat": report_flat,
    "lexicon_signals_shuffled": lexicon_signals,
    "lexicon_signals_derived": lexicon_signals_derived,
    "lexicon_signals_rowwise": lexicon_signals,
    "report_checks": report_checks,
    "report_nested_json": report_nested_json,
    "report_json_text": report_json_text,
    "token_tags": token_tags,
    "tag_lists": tag_lists,
    "rule_based_labels": rule_based_labels,
    "dictionary_profile": dictionary_profile,
    "dictionary_log": dictionary_log,
    "bias_flag_rate": bias_flag_rate,
    "standardised_sources": standardised_sources,
    "stitched": stitched,
    "clean_pages": clean_pages,
    "strip_markup_pages": strip_markup_pages,
    "ascii_fold_documents": ascii_fold_documents,
    "pairs_light_clean": pairs_light_clean,
    "label_codes": label_codes,
    "input_guard": input_guard,
    "prompted_articles": prompted_articles,
    "seeded_shuffle": seeded_shuffle,
    "seeded_subset": seeded_subset,
    "fraction_sample": fraction_sample,
    "train_test_split": train_test_split,
    "train_val_test_split": train_val_test_split,
    "stratified_split": stratified_split,
    "split_counts": split_counts,
    "class_weights": class_weights,
    "confusion_matrix": confusion_matrix,
    "classification_metrics": classification_metrics,
    "per_row_results": per_row_results,
    "rouge_n_pairs": rouge_n_pairs,
    "rouge_n_mean": rouge_n_mean,
    "rouge_l_pairs": rouge_l_pairs,
    "rouge_stemmed": rouge_stemmed,
    "rouge_bootstrap": rouge_bootstrap,
    "summary_checks": summary_checks,
    "stub_summaries": stub_summaries,
    "summary_stability": summary_stability,
    "log_series": log_series,
    "loss_moving_average": loss_moving_average,
    "epoch_mean_loss": epoch_mean_loss,
    "newest_training_logs": newest_training_logs,
    "report_flat_bucketed": report_flat,
    "report_stream_derived": lambda: report_flat(derived=True),
    "epoch_last_eval": epoch_last_eval,
    "best_run": best_run,
    "tfidf_features": tfidf_features,
    "rff_features": rff_features,
    "softmax_from_counts": softmax_from_counts,
    "csv_sources_stitched": stitched,
    "csv_pairs_by_split": csv_pairs_by_split,
    "tag_list_text_roundtrip": tag_list_text_roundtrip,
    "reports_json_roundtrip": reports_json_roundtrip,
    "run_metrics_roundtrip": best_run,
    "csv_pair_file": csv_pair_file,
    "dictionary_csv_profile": dictionary_csv_profile,
    "text_corpus_reports": text_corpus_reports,
    "report_stream": report_flat,
    "report_stream_rowwise": report_flat,
    "report_stream_versioned": report_stream_versioned,
}
