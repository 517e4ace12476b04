"""Secret scan: regular expressions behind a trigram index.

Each rule's regular expression is parsed once into a Boolean query over trigrams (of
the ASCII-lowered text) that every match must contain.  The documents of a partition are
scanned in segments; each segment gets an inverted index from trigram to postings
(ordinals of its documents) for the trigrams that the rules ask for.  A query is
answered by intersecting and uniting postings, and the regular expression runs on the
remaining candidates only.  A rule without a mandatory trigram scans every document.

An index is as large as its segment and is built where the text is read, so nothing
is shuffled, whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import ready

SEGMENT_DOCS = 2_000


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``least``: shortest accepted group ``group`` (0: the whole match)."""
    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self):
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The base rules of the contract, then the further kinds that this operator finds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}", True),
)
RULES = BASE + FURTHER

#: More exact strings than this are no longer multiplied out.
MAX_EXACT = 64
#: Character classes of more characters are not spelt out.
MAX_CLASS = 8


def lowered(s: str) -> str:
    """ASCII letters in lower case, code points kept in place."""
    return s.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def _every(*queries):
    """Conjunction; None asks for nothing."""
    parts = frozenset(q for q in queries if q is not None)
    return None if not parts else next(iter(parts)) if len(parts) == 1 else ("and", parts)


def _some(queries):
    """Disjunction; a branch that asks for nothing makes it ask for nothing."""
    queries = list(queries)
    if not queries or any(q is None for q in queries):
        return None
    parts = frozenset(queries)
    return next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _of_strings(strings):
    return _some(_every(*(lowered(s)[i:i + 3] for i in range(len(s) - 2))) for s in strings)


def trigram_query(pattern: str, flags: int = 0):
    """Trigrams that every match contains: a trigram, ("and" | "or", queries), or None (no demand)."""
    from re import _constants as c
    from re import _parser as parser

    def walk(items):
        """Query and, if they are few, the exact strings of a sequence of parsed items."""
        query, exact = None, {""}
        whole = True

        def flush():
            nonlocal query, exact, whole
            query, exact, whole = _every(query, _of_strings(exact)), {""}, False

        for op, arg in items:
            strings, sub = None, None
            if op is c.LITERAL:
                strings = {chr(arg)}
            elif op is c.IN and len(arg) <= MAX_CLASS and all(x[0] is c.LITERAL for x in arg):
                strings = {chr(x[1]) for x in arg}
            elif op is c.SUBPATTERN:
                sub, strings = walk(arg[3])
            elif op is c.BRANCH:
                found = [walk(x) for x in arg[1]]
                sub = _some(_every(q, _of_strings(s) if s else None) for q, s in found)
                if all(s for _, s in found) and all(q is None for q, _ in found):
                    strings = set().union(*(s for _, s in found))
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
                low, high, inner = arg
                inner_query, inner_strings = walk(inner)
                if (low, high) == (0, 1) and inner_strings:
                    strings = inner_strings | {""}
                elif low >= 1:
                    sub = _every(inner_query, _of_strings(inner_strings) if inner_strings else None)
            elif op is c.AT:
                continue
            if strings is not None and len(exact) * len(strings) <= MAX_EXACT:
                exact = {a + b for a in exact for b in strings}
            else:
                flush()
                query = _every(query, sub, _of_strings(strings) if strings else None)
        if whole:
            return query, exact
        return _every(query, _of_strings(exact)), None

    query, strings = walk(parser.parse(pattern, flags))
    return _every(query, _of_strings(strings) if strings else None)


def trigrams_in(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams_in(q) for q in query[1]))


def answer(query, postings: dict[str, set[int]]) -> set[int]:
    """Documents that satisfy a query (which asks for something)."""
    if isinstance(query, str):
        return postings.get(query, set())
    found = sorted((answer(q, postings) for q in query[1]), key=len)
    return set.intersection(*found) if query[0] == "and" else set.union(*found)


def spans_of(rule: Rule, regex, text: str) -> list[tuple[int, int]]:
    """Accepted matches, leftmost and non-overlapping."""
    out = []
    for m in regex.finditer(text):
        a, b = m.span(rule.group)
        if b - a >= rule.least:
            out.append(m.span())
    return out


def scan_texts(texts: list[str], rules) -> list[list[tuple[int, int, int]]]:
    """Spans ``(start, rule number, end)`` of each text of a segment, in order."""
    compiled = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
    wanted = {t: t.encode() for t in set().union(*(trigrams_in(q) for _, _, q in compiled))}
    postings: dict[str, set[int]] = {t: set() for t in wanted}
    for i, text in enumerate(texts):
        low = text.encode().lower()  # ASCII letters only
        for t, code in wanted.items():
            if code in low:
                postings[t].add(i)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, regex, query) in enumerate(compiled):
        for i in range(len(texts)) if query is None else answer(query, postings):
            out[i] += [(a, k, b) for a, b in spans_of(rule, regex, texts[i])]
    for spans in out:
        spans.sort()
    return out


def _scan(rules, segment: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, segment):
                part = batch.slice(at, segment)
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                found = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in s]
                         for s in scan_texts(texts, rules)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(part.num_columns)), pa.array(found, SPANS)],
                    [*part.schema.names, "secret_spans_"])
    return run


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, rules=RULES, segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """Per row ``doc_id, text, spans``: all spans ``(kind, start, end)`` by start, then rule order,
    in code points, end exclusive.

    A null text counts as empty (``text`` is then the empty string) and has no span; every row
    gives a row, whatever its id; other columns are ignored; an empty table gives no row.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(
        _scan(rules, segment_docs),
        "doc_id long, text string, secret_spans_ array<struct<kind: string, start: long, end: long>>",
    ).withColumnRenamed("secret_spans_", "spans")


def redact(docs: DataFrame, rules=RULES, segment_docs: int = SEGMENT_DOCS, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by ``mask`` in ``text``.

    All columns and all rows stay; texts without a span, and nulls, stay as they are.
    """
    ready(docs.sparkSession)
    names = docs.columns

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, segment_docs):
                part = batch.slice(at, segment_docs)
                texts = part.column(names.index("text")).to_pylist()
                out = []
                for text, spans in zip(texts, scan_texts([t or "" for t in texts], rules)):
                    if spans:
                        merged = []
                        for a, _, b in spans:
                            if merged and a < merged[-1][1]:
                                merged[-1][1] = max(b, merged[-1][1])
                            else:
                                merged.append([a, b])
                        for a, b in reversed(merged):
                            text = text[:a] + mask + text[b:]
                    out.append(text)
                cols = [pa.array(out, pa.string()) if n == "text" else part.column(i) for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(cols, names)
    return docs.mapInArrow(run, docs.schema)


def joined(spans) -> str:
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def digests(found: DataFrame) -> DataFrame:
    """The digest columns of the spans: counts per base kind, hash of the base spans, all spans."""
    base = {r.kind for r in BASE}
    kinds = ", ".join(f"'{k}'" for k in sorted(base))

    def text_of(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"

    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}")
          for k in ("assign", "access", "hex")],
        F.expr(f"sha2({text_of(f'filter(spans, s -> s.kind in ({kinds}))')}, 256)").alias("base_sha256"),
        F.expr(text_of("spans")).alias("spans"))


def sha256_of(spans) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
