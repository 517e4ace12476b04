"""DuckDB spellings shared by the oracle queries (independent of the Spark code)."""

from __future__ import annotations

from lexiscope import fixtures
from lexiscope.functions import text as tx
from lexiscope.operators import lexicon as lx
from lexiscope.operators import standardize as sd


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


TOKEN_SPLIT_RE2 = "[" + tx.re2_class(tx.TOKEN_SPLIT_PUNCT + tx.PY_WHITESPACE) + "]"
STOPWORDS_SQL = ", ".join(q(w) for w in tx.STOPWORDS)
CATS = lx.CATEGORIES


def dictionary_values() -> str:
    """The fixture dictionary (word + the 7 categories + complexity + doc_count) as VALUES."""
    rows = []
    for r in fixtures.fixture_dictionary_rows():
        d = dict(zip(fixtures.DICTIONARY_COLUMNS, r))
        vals = [q(d["word"])] + [str(d[c]) for c in CATS] + [str(d["complexity"]), str(d["doc_count"])]
        rows.append("(" + ", ".join(vals) + ")")
    cols = ", ".join(("word",) + CATS + ("complexity", "doc_count"))
    return f"dict({cols}) AS (VALUES {', '.join(rows)})"


def derived_dictionary_cte() -> str:
    """The dictionary derived from the corpus vocabulary (same rule as Spark)."""
    cats = {}
    for b, names in fixtures.DERIVED_RULE.items():
        for n in names:
            cats.setdefault(n, []).append(b)
    h = "CAST(('0x' || substr(md5(word), 1, 8))::UBIGINT AS BIGINT)"
    cols = ", ".join(
        f"CASE WHEN {h} % {fixtures.DERIVED_BUCKETS} IN ({', '.join(map(str, cats.get(c, [-99])))}) "
        f"THEN {fixtures.FIXTURE_YEAR} ELSE 0 END AS {c}" for c in CATS + ("complexity",))
    return (f"dwords AS (SELECT word, count(DISTINCT doc_id) AS doc_count FROM (SELECT doc_id, "
            f"{py_upper_sql('t')} AS word FROM (SELECT doc_id, unnest(string_split_regex(text, "
            f"'{TOKEN_SPLIT_RE2}')) AS t FROM documents) WHERE length(t) > 1) GROUP BY word), "
            f"dict AS (SELECT word, doc_count, {cols} FROM dwords)")


def lookup_cte(stopword_mode: str = "before_lookup", derived: bool = False) -> str:
    """``lex(word, code)``: tag code per dictionary word (-1 = stopword drop, null = untagged)."""
    case = "CASE " + " ".join(f"WHEN {c} > 0 THEN {i + 1}" for i, c in enumerate(CATS)) + " END"
    return (f"{derived_dictionary_cte() if derived else dictionary_values()}, "
            f"lex AS (SELECT upper(word) AS word, "
            f"CASE WHEN upper(word) IN ({STOPWORDS_SQL}) THEN -1 ELSE {case} END AS code FROM dict)")


def py_upper_sql(x: str) -> str:
    """Upper case as Python/Spark do it: DuckDB maps ß to ẞ, Python to SS."""
    return f"upper(replace({x}, 'ß', 'SS'))"


def tagged_cte(source: str, id_col: str = "doc_id", text_col: str = "text",
               stopword_mode: str = "before_lookup") -> str:
    """``tagged(id, pos, code)``: one row per kept token; code 0 = cns."""
    stop = (f"WHEN upper(t.token) IN ({STOPWORDS_SQL}) THEN NULL "
            if stopword_mode == "before_lookup" else "")
    return (
        f"toks AS (SELECT {id_col} AS id, unnest(l) AS token, unnest(range(len(l))) AS pos "
        f"FROM (SELECT {id_col}, string_split_regex({text_col}, '{TOKEN_SPLIT_RE2}') AS l FROM {source})), "
        f"tagged0 AS (SELECT t.id, t.pos, CASE WHEN length(t.token) <= 1 THEN NULL {stop}"
        f"WHEN lex.code = -1 THEN NULL ELSE coalesce(lex.code, 0) END AS code "
        f"FROM toks t LEFT JOIN lex ON {py_upper_sql('t.token')} = lex.word), "
        f"tagged AS (SELECT * FROM tagged0 WHERE code IS NOT NULL)"
    )


def counts_cte(source: str, id_col: str = "doc_id") -> str:
    """``counts(id, n_*, first_*)`` with a row for every source row."""
    n = ", ".join(f"coalesce(count(*) FILTER (WHERE code = {i + 1}), 0) AS n_{c}"
                  for i, c in enumerate(CATS))
    f = ", ".join(f"min(pos) FILTER (WHERE code = {i + 1}) AS first_{c}" for i, c in enumerate(CATS))
    per = f"SELECT id, {n}, count(*) FILTER (WHERE code = 0) AS n_cns, {f} FROM tagged GROUP BY id"
    ncols = ", ".join(f"coalesce(p.n_{c}, 0) AS n_{c}" for c in CATS)
    fcols = ", ".join(f"p.first_{c}" for c in CATS)
    return (f"per AS ({per}), "
            f"counts AS (SELECT s.{id_col} AS id, {ncols}, coalesce(p.n_cns, 0) AS n_cns, {fcols} "
            f"FROM {source} s LEFT JOIN per p ON s.{id_col} = p.id)")


def vote_cte() -> str:
    """``vote(id, top_tag)``: most frequent tag, ties to the first seen."""
    parts = " UNION ALL ".join(
        f"SELECT id, '{c}' AS tag, n_{c} AS n, first_{c} AS f FROM counts WHERE n_{c} > 0" for c in CATS)
    return (f"cand AS ({parts}), "
            f"vote AS (SELECT id, tag AS top_tag FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY id ORDER BY n DESC, f ASC) AS rn FROM cand) WHERE rn = 1)")


def tri_class_sql(tag: str, litigious: str = "negative") -> str:
    whens = []
    for t, cls in lx.TAG_TO_CLASS.items():
        val = "NULL" if (t == "litigious" and litigious == "drop") else q(cls)
        whens.append(f"WHEN {tag} = {q(t)} THEN {val}")
    return f"(CASE WHEN {tag} IS NULL THEN 'neutral' {' '.join(whens)} END)"


def signals_select(litigious: str = "negative", with_positions: bool = False) -> str:
    """Columns of the lexicon signal, over ``counts c LEFT JOIN vote v``."""
    total = " + ".join(f"c.n_{c}" for c in CATS)
    share = {c: f"(CASE WHEN ({total}) > 0 THEN CAST(c.n_{c} AS DOUBLE) / ({total}) ELSE 0.0 END)"
             for c in lx.BIAS_CATEGORIES}
    score = f"((({share['uncertainty']} + {share['litigious']}) + {share['constraining']}) / 3.0)"
    ns = ", ".join(f"c.n_{c}" for c in CATS)
    return (f"c.id AS doc_id, {ns}, c.n_cns, CAST({total} AS BIGINT) AS n_tags, "
            f"v.top_tag AS lexicon_tag, {tri_class_sql('v.top_tag', litigious)} AS lexicon_label, "
            + ", ".join(f"round({share[c]}, 4) AS {c}" for c in lx.BIAS_CATEGORIES)
            + f", round({score}, 4) AS bias_score, ({score} > {lx.BIAS_THRESHOLD}) AS bias_flag"
            + ("".join(f", c.first_{c} AS first_{c}" for c in CATS) if with_positions else ""))


def signals_query(source: str = "documents", id_col: str = "doc_id", text_col: str = "text",
                  stopword_mode: str = "before_lookup", litigious: str = "negative",
                  derived: bool = False, with_positions: bool = False) -> str:
    return (f"WITH {lookup_cte(stopword_mode, derived)}, {tagged_cte(source, id_col, text_col, stopword_mode)}, "
            f"{counts_cte(source, id_col)}, {vote_cte()} "
            f"SELECT {signals_select(litigious, with_positions)} FROM counts c LEFT JOIN vote v ON c.id = v.id")


def letter_softmax_sql(text: str) -> tuple[str, str]:
    """Label and confidence of the stand-in classifier (letter counts of the whole text)."""
    low = f"lower(coalesce({text}, ''))"
    n = [f"CAST(length({low}) - length(replace({low}, {q(x)}, '')) AS DOUBLE)" for x in fixtures.CLASSIFIER_LETTERS]
    total = f"greatest({' + '.join(n)}, 1.0)"
    z = f"[{', '.join(f'CAST(4.0 AS DOUBLE) * {x} / {total}' for x in n)}]"
    p = (f"list_transform([{z}], lambda l: list_transform(l, lambda x: exp(x - list_max(l)) / "
         f"list_sum(list_transform(l, lambda y: exp(y - list_max(l))))))[1]")
    label = f"(['positive', 'negative', 'neutral'])[list_position({p}, list_max({p}))]"
    return label, f"round(list_max({p}), 4)"


def lead_summary_sql(text: str) -> str:
    joined = (f"array_to_string(list_filter(list_transform(string_split({text}, chr(10)), "
              f"lambda p: trim(regexp_extract(p, '^[^.!?]*[.!?]?', 0))), lambda s: s <> ''), ' ')")
    return py_strip_sql(joined)


# ---- text cleaning (T1-T6) ----------------------------------------------------

WS_RE2 = tx.re2_class(tx.PY_WHITESPACE)
ASCII_WS_RE2 = tx.re2_class("".join(c for c in tx.PY_WHITESPACE if ord(c) < 128))


def py_strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g')"


def fold_sql(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7f]', '', 'g')"


def markup_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '&[a-z]+;', ' ', 'g')"


def contractions_sql(x: str) -> str:
    for pat, rep in tx.CONTRACTIONS:
        x = f"regexp_replace({x}, {q('(?i)' + pat)}, {q(rep)}, 'g')"
    return x


def case_space_sql(x: str) -> str:
    collapsed = f"regexp_replace(lower({x}), '[{ASCII_WS_RE2}]+', ' ', 'g')"
    return f"trim(replace({collapsed}, '?', ''), ' ')"


def clean_text_sql(x: str) -> str:
    return case_space_sql(contractions_sql(markup_sql(fold_sql(x))))


def light_clean_sql(x: str) -> str:
    return py_strip_sql(f"replace(replace(replace({x}, chr(10), ' '), chr(13), ' '), '?', '')")


def string_label_sql(x: str) -> str:
    k = f"lower({py_strip_sql(x)})"
    whens = " ".join(f"WHEN {k} = {q(a)} THEN {q(b)}" for a, b in sd.STRING_LABELS.items())
    return f"(CASE {whens} END)"


def numeric_label_sql(x: str) -> str:
    return (f"(CASE WHEN {x} > 0 THEN 'positive' WHEN {x} < 0 THEN 'negative' "
            f"WHEN {x} = 0 THEN 'neutral' END)")


NOISY_PREFIX_SQL = q(fixtures.NOISY_PREFIX)


def labelled_sources_ctes() -> str:
    """``lab``, ``sentences(doc_id, sentiment, data)``, ``headlines(doc_id, title, gs)``."""
    noisy = f"{NOISY_PREFIX_SQL} || d.text"
    label = "CAST(sign(l.quality - l.toxic) AS DOUBLE) AS label_num, d.doc_id % 2 = 0 AS even"
    src = "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
    return (
        f"lab AS (SELECT d.doc_id, {noisy} AS text, FALSE AS unknown, {label} {src} "
        f"UNION ALL SELECT -1 - 3 * d.doc_id, NULL, FALSE, {label} {src} WHERE d.doc_id % 17 = 0 "
        f"UNION ALL SELECT -2 - 3 * d.doc_id, '   ', FALSE, {label} {src} WHERE d.doc_id % 19 = 0 "
        f"UNION ALL SELECT -3 - 3 * d.doc_id, {noisy}, TRUE, {label} {src} WHERE d.doc_id % 23 = 0), "
        f"sentences AS (SELECT doc_id, CASE WHEN unknown THEN 'unknown' "
        f"WHEN label_num > 0 THEN ' Positive ' WHEN label_num < 0 THEN '-1' ELSE 'neutral' END AS sentiment, "
        f"text AS data FROM lab WHERE even), "
        f"headlines AS (SELECT doc_id, text AS title, CASE WHEN NOT unknown THEN label_num END AS gs "
        f"FROM lab WHERE NOT even)"
    )


def json_string_sql(x: str) -> str:
    """JSON string literal as Python json.dumps(ensure_ascii=False): lower-case hex escapes."""
    out = f"CASE WHEN {x} IS NULL THEN 'null' ELSE CAST(to_json({x}) AS VARCHAR) END"
    for cp in range(0x20):
        up = f"\\u{cp:04X}"
        if up != up.lower():
            out = f"replace({out}, '{up}', '{up.lower()}')"
    return out


def json_number4_sql(x: str) -> str:
    f = f"regexp_replace(printf('%.4f', {x}), '0+$', '')"
    return f"(CASE WHEN {x} IS NULL THEN 'null' WHEN {f} LIKE '%.' THEN {f} || '0' ELSE {f} END)"


def json_bool_sql(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN 'null' WHEN {x} THEN 'true' ELSE 'false' END)"
