"""Secret scans: patterns, and assignments read as name-literal pairs.

The base patterns find assignments to telling names, access keys and long hex
strings. The method adds string literals: around each `=` and `:` a small lexer
reads a name on the left and a literal or another name on the right. The name may be
quoted, a subscript (`config["password"] = `) or followed by a type (`pwd: str = `,
`var pwd string = `); a value without quotes ends at white space and is a literal too,
unless it is a known name, itself a telling name, a dotted path of names or code. A name that
stands for a literal passes it on (`key = "x"`, `password = key`), through any number of
names. A literal is scored by the most telling name it reaches and by its own
form; above the limit it is a secret.

One Arrow stage, no shuffle; every text is read whole, in time linear in its
length: names are taken whole, and no scan to the left crosses another operator twice.
Defined results: a null text is empty and has no span; an empty table gives no
rows; repeated rows are scanned alike; spans count code points, end exclusive;
an added span never overlaps a base span. Other columns pass through `redact`.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced

KINDS = ("assign", "access", "hex", "literal")
LEAST_SCORE = 0.6

# --- Fixed values: the base patterns, telling words in names with their weight, and what stands in for secrets ---
_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passwort": 1.0, "secret": 1.0, "secrets": 1.0,
    "token": 0.9, "apikey": 0.9, "bearer": 0.9, "credential": 0.9, "credentials": 0.9, "privatekey": 1.0,
    "accesskey": 0.9, "signature": 0.6, "auth": 0.8, "authorization": 0.8, "cookie": 0.6, "salt": 0.6, "key": 0.5,
}
KEY_QUALIFIERS = ("api", "access", "private", "signing", "encryption", "master", "secret", "shared", "account")
PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|changeme|example.*|placeholder.*|your.*|test|dummy|none|null|true|false|todo)$")
# ------------------------------------------------------------------------------------------------------------------

_OPERATOR = re.compile(r"[:=]")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")
_NO_START = "0123456789.-"
_RIGHT = re.compile(r"""[=>]?[ \t]*(?:"([^"\n]+)"|'([^'\n]+)'|(?=[^\s"'`,;&=:]))""")
_BARE = re.compile(r"""[^\s"'`,;&]+""")
_TYPED = re.compile(r"[ \t]*=(?!=)")
_WHOLE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
_PATH = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)+")
_CODE = re.compile(r"[({\[<$]|[A-Za-z_][A-Za-z0-9_.]*[({\[<]")
_DECLARES = ("var", "const", "let", "val")
_NAME_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and not overlapping per kind."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in _ASSIGN_HINTS):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    """How telling a name is, from its words."""
    parts = [w.lower() for w in _NAME_WORDS.findall(name)]
    best = max((NAME_WEIGHTS.get(w, 0.0) for w in [*parts, *map("".join, zip(parts, parts[1:]))]), default=0.0)
    if "key" in parts and any(q in parts for q in KEY_QUALIFIERS):
        best = max(best, 0.9)
    return best


def literal_score(value: str, phrase: bool = False) -> float:
    """How much a literal looks like a secret: 0 for stand-ins, near 1 for dense strings of 8 and more.

    Prose is 0.3, unless it may be a pass phrase.
    """
    if len(value) < 8 or PLACEHOLDER.match(value) or value.startswith(("${", "<", "{{", "http://", "https://")):
        return 0.0
    if value.count(" ") > 2 and not phrase:
        return 0.3
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    kinds = sum(map(bool, (re.search("[a-z]", value), re.search("[A-Z]", value), re.search("[0-9]", value))))
    return min(1.0, 0.35 + 0.12 * kinds + 0.12 * entropy)


def _blanks_before(text: str, end: int) -> int:
    while end and text[end - 1] in " \t":
        end -= 1
    return end


def _word_before(text: str, end: int) -> tuple[str, int]:
    """The name that ends here, and its start; empty if there is none."""
    start = end
    while start and text[start - 1] in _NAME:
        start -= 1
    name = text[start:end].lstrip(_NO_START)
    return name, end - len(name)


def _name_before(text: str, end: int) -> tuple[str, int]:
    """The name before blanks, in quotes or not, or the innermost subscript."""
    end = _blanks_before(text, end)
    if end and text[end - 1] == "]":
        end = inner = _blanks_before(text, end - 1)
        while inner and text[inner - 1] in "0123456789 \t":
            inner -= 1
        if inner and text[inner - 1] == "[":
            return _word_before(text, inner - 1)
    quote = text[end - 1 : end] if end and text[end - 1] in "\"'" else ""
    name, start = _word_before(text, end - len(quote))
    if quote:
        return (name, start - 1) if start and text[start - 1] == quote else ("", end)
    return name, start


def _typed_before(text: str, end: int) -> str:
    """The name that a type follows, as `name: type` or `var name type`, where the type ends here."""
    at = _blanks_before(text, end)
    while at and text[at - 1] not in "=:\n,;(){}\"' \t":
        if text[at - 1] == "]":  # the parameters of a type may hold commas and blanks
            depth = 0
            while at and text[at - 1] not in "=:\n":
                depth += (text[at - 1] == "]") - (text[at - 1] == "[")
                at -= 1
                if not depth:
                    break
            if depth:
                return ""
        else:
            at -= 1
        before = _blanks_before(text, at)
        if before and text[before - 1] == "|":
            at = _blanks_before(text, before - 1)
    before = _blanks_before(text, at)
    if text[before - 1 : before] == ":" and before and before < end:
        return _name_before(text, before - 1)[0]
    name, start = _word_before(text, before)
    word, _ = _word_before(text, _blanks_before(text, start))
    return name if word in _DECLARES and before < at else ""


def pairs(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(name, start, end, quoted) of each assignment: the span of its literal, or of its value without quotes."""
    run, free = 0, 0  # the end of the run of characters read last, and of the last value of a telling name
    for operator in _OPERATOR.finditer(text):
        at, end = operator.span()
        colon = text[at] == ":"
        if at < free or (text[at - 1 : at] if not colon else text[end : end + 1]) == ":" and at:
            continue  # `:=` and `::` are read at their last colon
        left = at
        while left and text[left - 1] == ":":
            left -= 1
        name = (not colon and _typed_before(text, at)) or _name_before(text, left)[0]
        right = _RIGHT.match(text, end) if name else None
        if not right:
            continue
        group = next((g for g in (1, 2) if right.group(g) is not None), 0)
        if group:
            yield name, *right.span(group), True
            continue
        start = right.end()
        if start >= run:
            run = _BARE.match(text, start).end()
        if colon and _TYPED.match(text, run):
            continue
        if name_score(name):
            free = run
        yield name, start, run, False


def _refers(text: str, start: int, end: int) -> str | None:
    """The name that a value without quotes is, if it can be one."""
    return text[start:end] if _WHOLE_NAME.match(text, start, end) else None


def literal_spans(text: str, taken: list[tuple[int, int, str]], least: float = LEAST_SCORE) -> list[tuple[int, int, str]]:
    """Literals that reach a telling name, apart from spans already taken."""
    stands_for: dict[str, tuple[int, int]] = {}
    best: dict[tuple[int, int], float] = {}
    for name, start, end, quoted in pairs(text):
        literal: tuple[int, int] | None = (start, end)
        if not quoted:
            other = _refers(text, start, end)
            if other in stands_for:
                literal = stands_for[other]
            elif _CODE.match(text, start, end) or (other and (_PATH.fullmatch(other) or other.isidentifier() and name_score(other))):
                literal = None
        if literal is None:
            stands_for.pop(name, None)
            continue
        stands_for[name] = literal
        best[literal] = max(best.get(literal, 0.0), name_score(name))
    found = [
        (*span, "literal")
        for span, score in best.items()
        if score and score * literal_score(text[span[0] : span[1]], phrase=score >= 1.0) >= least
    ]
    taken = sorted(taken)
    starts, ends = [t[0] for t in taken], [0, *accumulate((t[1] for t in taken), max)]
    # Of the spans that start before a literal ends, none may end after it starts.
    return [s for s in found if ends[bisect_left(starts, s[1])] <= s[0]]


def spans_of(text: str | None) -> list[tuple[int, int, str]]:
    """All spans, by start and then kind."""
    if not text:
        return []
    base = base_spans(text)
    return sorted([*base, *literal_spans(text, base)], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each run of overlapping spans replaced by its first kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
SPANS_TYPE = "array<struct<start:bigint,end:bigint,kind:string>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and `spans` (start, end, kind) of every row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [
                [dict(zip(("start", "end", "kind"), span)) for span in spans_of(text)] for text in batch.column(1).to_pylist()
            ]
            yield pa.record_batch([batch.column(0), pa.array(found, _SPANS)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id long, spans {SPANS_TYPE}")


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets replaced in `text`; a changed text gets its own length as n_chars."""
    at = docs.columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t and redacted(t, spans_of(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    changed = docs.mapInArrow(replace, docs.schema)
    if "n_chars" not in docs.columns:
        return changed
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
