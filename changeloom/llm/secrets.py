"""Secret scans: an inverted index of trigrams decides which documents a rule has to be run on.

Each rule's regular expression is read once into a Boolean query: which trigrams any match must hold,
joined by AND along the expression and by OR over its alternatives. Documents come in blocks; a
block's index has a posting for every trigram that some rule asks for, the postings are intersected,
and only the documents left are searched with the expression itself. A rule from which no trigram
follows is run on every document. The index belongs to its block and lives where the text is, so
nothing is shuffled; trigrams are of bytes with A-Z folded, which can only let too many documents by.

Defined results: a null text is an empty one without spans; repeated rows give repeated results; an
empty table gives an empty table; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product
from re import _parser as parser  # the parse tree of an expression; in the standard library

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import bounded, documents, narrow, raw

MOST_STRINGS = 64  # alternatives followed at once
ANY = ("any",)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = field(default=lambda m: True)


# The three base rules.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# From BEGIN to END, whatever is between; without END over header lines and all base64 that follows. Lines may
# be quoted, indented, joined by blanks or by written-out line ends.
_GAP = r"""(?:\\[rn]|[\s"',>#*|;])+"""
_BASE64 = r"""(?:[A-Za-z0-9+/]{16,}={0,2}|[A-Za-z0-9+/]+={0,2}(?=[\x20\t"',]*(?:[\r\n]|\\[rn]|\Z)))"""
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:"
    r"(?:[^-]|-(?!----(?:BEGIN|END) ))*-----END [A-Z ]{0,40}PRIVATE KEY-----"
    rf"|(?:{_GAP}[A-Z][A-Za-z-]{{1,40}}:[^\r\n\\]*)*(?:{_GAP}{_BASE64})+)?"
)
MORE = (
    Rule("private_key", PRIVATE_KEY),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{16,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("url_login", r"[a-z]{2,12}://[^\s/:@]{1,64}:[^\s/:@]{3,128}@"),
)
RULES = BASE + MORE


def _both(a, b):
    return b if a == ANY else a if b == ANY else ("and", a, b)


def _one_of(queries):
    queries = list(queries)
    return ANY if ANY in queries else queries[0] if len(queries) == 1 else ("or", *queries)


def _holds(strings: set[str]):
    """Any match holds one of these strings."""
    def each(s: str):
        data = s.encode().lower()
        grams = dict.fromkeys(data[i : i + 3] for i in range(len(data) - 2))
        found = ANY
        for g in grams:
            found = _both(found, ("has", g))
        return found

    return _one_of(map(each, sorted(strings)))


def _exact(op, value) -> set[str] | None:
    """All strings a node can match with letters folded, if they are few; None if not."""
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name in ("AT", "ASSERT", "ASSERT_NOT"):
        return {""}  # no width; ignoring what it demands lets more documents by
    if name == "IN":
        chars = set()
        for kind, what in value:
            if str(kind) == "LITERAL":
                chars.add(chr(what).lower())
            elif str(kind) == "RANGE" and what[1] - what[0] < MOST_STRINGS:
                chars.update(chr(c).lower() for c in range(what[0], what[1] + 1))
            else:
                return None
        return chars if len(chars) <= 8 else None
    if name == "SUBPATTERN":
        strings, query = _sequence(value[-1])
        return strings if query is None else None
    if name == "BRANCH":
        parts = [_sequence(branch) for branch in value[1]]
        if all(query is None for _, query in parts):
            found = set().union(*(strings for strings, _ in parts))
            return found if len(found) <= MOST_STRINGS else None
    if name in ("MAX_REPEAT", "MIN_REPEAT") and value[1] == 1 and len(value[2]) == 1:
        found = _exact(*value[2][0])
        return found if found is None or value[0] else found | {""}
    return None


def _inside(op, value):
    """What must hold for a node whose strings are too many."""
    name = str(op)
    if name == "SUBPATTERN":
        return _query(value[-1])
    if name == "BRANCH":
        return _one_of(_query(branch) for branch in value[1])
    if name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
        return _query(value[2])
    return ANY


def _sequence(nodes) -> tuple[set[str], tuple | None]:
    """All strings of a sequence and no query, or else its query."""
    run, query, exact = {""}, ANY, True
    for op, value in nodes:
        strings = _exact(op, value)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        exact = False
        query = _both(query, _holds(run))
        run = {""}
        if strings is None:
            query = _both(query, _inside(op, value))
        else:
            run = strings
    return (run, None) if exact else (set(), _both(query, _holds(run)))


def _query(nodes):
    strings, query = _sequence(nodes)
    return _holds(strings) if query is None else query


def trigram_query(pattern: str):
    """('any',), ('has', trigram), ('and', ...) or ('or', ...): true of every text with a match."""
    return _query(parser.parse(pattern))


def _grams(query) -> set[bytes]:
    return {query[1]} if query[0] == "has" else set().union(*map(_grams, query[1:])) if len(query) > 1 else set()


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [trigram_query(rule.pattern) for rule in rules]
        self.patterns = [re.compile(rule.pattern, re.ASCII) for rule in rules]
        self.grams = {g: i + 1 for i, g in enumerate(sorted(set().union(*map(_grams, self.queries))))}
        self.table = np.zeros(1 << 24, np.uint16)
        for gram, i in self.grams.items():
            self.table[int.from_bytes(gram, "big")] = i

    def index(self, texts: list[bytes]) -> np.ndarray:
        """Postings of a block as a matrix: trigram by document."""
        data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8).astype(np.uint32)
        held = np.zeros((len(self.grams) + 1, len(texts)), bool)
        if len(data) > 2:
            code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
            gram = self.table[code]
            at = np.flatnonzero(gram)
            ends = np.cumsum([len(t) + 1 for t in texts])
            held[gram[at], np.searchsorted(ends, at, side="right")] = True
        return held

    def candidates(self, query, held: np.ndarray) -> np.ndarray:
        if query == ANY:
            return np.ones(held.shape[1], bool)
        if query[0] == "has":
            return held[self.grams[query[1]]]
        parts = [self.candidates(q, held) for q in query[1:]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text (start, rule number, end) in code points, by start and then by rule."""
        held, plain = self.index(texts), [t.decode() for t in texts]
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for n, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries, strict=True)):
            for i in np.flatnonzero(self.candidates(query, held)):
                found[i] += [(m.start(), n, m.end()) for m in pattern.finditer(plain[i]) if rule.accept(m)]
        return [sorted(spans) for spans in found]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and its spans: an array of (kind, start, finish), ends exclusive, in code points."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("finish", pa.int64())])

    def run(batches):
        scanner = Scanner(rules)
        for batch in bounded(batches):
            found = [
                [{"kind": rules[n].kind, "start": a, "finish": b} for a, n, b in spans]
                for spans in scanner.spans(raw(batch.column("text")))
            ]
            columns = [batch.column("doc_id"), pa.array(found, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans"])

    return narrow(docs).mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, finish long>>")


def redact(docs: DataFrame, mark: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced; a null text stays null."""

    def run(batches):
        scanner = Scanner(rules)
        for batch in bounded(batches):
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(scanner.spans(raw(batch.column("text")))):
                parts, done = [], 0
                for start, _, finish in spans:
                    if start >= done:
                        parts += [texts[i][done:start], mark]
                    done = max(done, finish)
                if spans:
                    texts[i] = "".join(parts) + texts[i][done:]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    line = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["finish"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(rule.kind) for rule in BASE),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )
