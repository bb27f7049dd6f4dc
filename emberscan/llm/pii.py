"""Personal data: patterns, and terms that disclose them by co-occurrence in the corpus.

The base patterns find e-mail addresses, addresses of machines, cards and telephone
numbers. Each different value is a protected entity c. A term t standing in its documents tells of it as much as
their pointwise mutual information, PMI(c; t) = log p(c, t) / (p(c) p(t)), out of all there is to know,
IC(c) = -log p(c). Terms whose share PMI / IC reaches `GENERALISE` are replaced by their form, those that
reach `REMOVE` are taken out: wherever they stand, beside the entity or not, and in texts without it as well.
Probabilities are shares of documents: p(c, t) counts documents that hold both, t outside all entities, p(t) those
with t anywhere.
All pairs are scored. A rare pair is judged by chance, not by a count: were c and t independent, n_c n_t / n
documents would hold both, and a pair is evidence if as many as seen come by chance with at most `CHANCE`.

Python reads texts (Arrow batches) for spans, for their different terms, and for places of telling terms; all
counting is joins and aggregates with partial sums, so an entity in a third of all documents is a few counts per
task. Terms too frequent to reach the threshold with any entity of a document leave before pairs are made.

Defined results: a null text is empty; repeated rows count as documents of their own; an empty table
gives no rows; spans count code points, end exclusive; added spans never overlap base spans.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.guards import broadcast_if_small
from .shared import keep

KINDS = ("email", "ip", "card", "phone")
CHANCE = 0.1  # probability of as many common documents by chance, above which a pair is no evidence
GENERALISE = 0.9
REMOVE = 0.999

# --- Fixed values: patterns ---------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Three or more letters, marks and digits of any script, or two where a character is a syllable or word.
_SYLLABLES = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff"
_LETTERS = "".join(c for c in map(chr, range(0x10000)) if unicodedata.category(c)[0] in "LMN")
_ASTRAL = "\U00010000-\U0001efff\U00020000-\U0003ffff"
TERM = f"[{_LETTERS}{_ASTRAL}]{{3,}}|[{_SYLLABLES}]{{2,}}"
# ------------------------------------------------------------------------------------
_TERM = re.compile(TERM)
_ASCII_LOWER = {upper: upper + 32 for upper in range(65, 91)}


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each `@` with the run of local characters before it, in time linear in the text."""
    free, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            free = domain.end()
            yield start, free
            sign = text.find("@", free)
        else:
            free, sign = sign + 1, text.find("@", sign + 1)


def _luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + at % 2) for at, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and not overlapping per kind, by start and kind."""
    found = [(*span, "email") for span in _emails(text)]
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match.groups()]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((*match.span(), "ip"))
    for match in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", match.group())
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((*match.span(), "card"))
    for match in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
            found.append((*match.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def entity_of(kind: str, value: str) -> str:
    """One name for all spellings of a value."""
    plain = value.translate(_ASCII_LOWER) if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
    return f"{kind}:{plain}"


def free_terms(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of each term that overlaps none of the spans, which are sorted by start."""
    at, covered = 0, 0
    for match in _TERM.finditer(text):
        start, end = match.span()
        while at < len(spans) and spans[at][0] < end:
            covered, at = max(covered, spans[at][1]), at + 1
        if covered <= start:
            yield match.group().casefold(), start, end


def near_terms(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of all pairs within one text, as `disclosures` counts them."""
    entities = {entity_of(kind, text[start:end]) for start, end, kind in spans}
    return sorted((entity, *term) for entity in entities for term in free_terms(text, spans))


_BASE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
_PLACES = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("term", pa.string()), ("share", pa.float64())])
)
_FOUND = "doc_id long, key long, base array<struct<start:bigint,end:bigint,kind:string>>, entities array<string>, own array<string>"
_TERMS = "array<struct<start:bigint,end:bigint,term:string,share:double>>"


def find(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash of the text), base spans, entities and, if there are any, the terms outside of them, of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, entities, terms = [], [], []
            for text in batch.column(2).to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("start", "end", "kind"), s)) for s in spans])
                entities.append(sorted({entity_of(k, text[s:e]) for s, e, k in spans}))
                terms.append(sorted({t for t, _, _ in free_terms(text, spans)}) if spans else [])
            strings = pa.list_(pa.string())
            columns = [pa.array(base, _BASE), pa.array(entities, strings), pa.array(terms, strings)]
            names = ["doc_id", "key", "base", "entities", "own"]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], names=names)

    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(scan, _FOUND)


def own_terms(docs: DataFrame) -> DataFrame:
    """(key, term) of each different term of every row."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [list({t.casefold() for t in set(_TERM.findall(text or ""))}) for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(own, pa.list_(pa.string()))], names=["key", "own"])

    split_up = docs.select(F.xxhash64("text"), "text").mapInArrow(split, "key long, own array<string>")
    return split_up.select("key", F.explode("own").alias("term"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """In how many documents each of the given terms, all different, stands. Counts meet the terms, not every word of every text."""
    counts = own_terms(docs).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    # An inner join: a semi join would be pushed below the counts, to every word of every text.
    return counts.join(broadcast_if_small(terms), "term").select("term", "n_t")


def disclosures(found: DataFrame, docs: DataFrame, chance: float = CHANCE, least: float = GENERALISE) -> DataFrame:
    """(entity, term, share) of the pairs whose share of information reaches the threshold.

    As n_ct <= n_c, no pair of a share of `least` has log n_t above least log n_c + (1 - least) log n.
    """
    some = found.where(F.size("entities") > 0).withColumn("_row", F.monotonically_increasing_id())
    some = keep(some.select("_row", "entities", "own"))
    total = F.broadcast(found.agg(F.count(F.lit(1)).cast("double").alias("n")))
    by_entity = some.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    bound = least * F.log("n_c") + (1 - least) * F.log("n") + 1e-9
    by_entity = keep(by_entity.join(total).withColumn("most", bound))
    reach = F.broadcast(by_entity.agg(F.max("most").alias("reach")))
    by_term = term_counts(docs, keep(some.select(F.explode("own").alias("term")).distinct()))
    by_term = keep(by_term.join(reach).where(F.log("n_t") <= F.col("reach")).drop("reach"))
    entities = some.select("_row", F.explode("entities").alias("entity")).join(broadcast_if_small(by_entity), "entity")
    terms = some.select("_row", F.explode("own").alias("term")).join(broadcast_if_small(by_term), "term")
    together = (
        entities.join(terms, (entities["_row"] == terms["_row"]) & (F.log("n_t") <= F.col("most")))
        .groupBy("entity", "term", "n_c", "n_t", "n").agg(F.count(F.lit(1)).alias("n_ct"))
    )
    information = F.log(F.col("n") / F.col("n_c"))
    share = F.log(F.col("n_ct") * F.col("n") / (F.col("n_c") * F.col("n_t"))) / F.nullif(information, F.lit(0.0))
    evident = _log_chance(F.col("n_ct"), F.col("n_c") * F.col("n_t") / F.col("n")) <= F.log(F.lit(float(chance)))
    return together.where(evident).select("entity", "term", share.alias("share")).where(F.col("share") >= least)


def _log_chance(seen: Column, expected: Column) -> Column:
    """Upper bound of the log-probability of `seen` or more events where `expected` come by chance (Markov, Chernoff)."""
    ratio = F.log(expected / seen)
    chernoff = F.when(seen > expected, seen - expected + seen * ratio).otherwise(F.lit(0.0))
    return F.least(ratio, chernoff, F.lit(0.0))


def places(docs: DataFrame, telling: DataFrame) -> DataFrame:
    """doc_id, key, terms (start, end, term, share) of the rows that hold a telling term, of equal rows once."""
    held = own_terms(docs).join(broadcast_if_small(telling), "term")
    held = keep(held.groupBy("key").agg(F.collect_set(F.struct("term", "share")).alias("telling")))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = []
            for text, terms in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                share = {t["term"]: t["share"] for t in terms}
                found = [p for p in free_terms(text or "", base_spans(text or "")) if p[0] in share]
                marked.append([{"start": a, "end": b, "term": t, "share": share[t]} for t, a, b in found])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(marked, _PLACES)], names=["doc_id", "key", "terms"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), "text").join(broadcast_if_small(held), "key")
    marked = texts.select("doc_id", "key", "text", "telling").mapInArrow(mark, f"doc_id long, key long, terms {_TERMS}")
    return marked.groupBy("doc_id", "key").agg(F.first("terms").alias("terms"))


def spans(docs: DataFrame, chance: float = CHANCE, least: float = GENERALISE) -> DataFrame:
    """doc_id, key, base (start, end, kind) and terms (start, end, term, share) of every row."""
    found = keep(find(docs))
    telling = keep(disclosures(found, docs, chance, least).groupBy("term").agg(F.max("share").alias("share")))
    marked = broadcast_if_small(keep(places(docs, telling).withColumnsRenamed({"doc_id": "_id", "key": "_key"})))
    same = found["doc_id"].eqNullSafe(marked["_id"]) & (found["key"] == marked["_key"])
    terms = F.coalesce("terms", F.array().cast(_TERMS)).alias("terms")
    return found.join(marked, same, "left").select("doc_id", "key", "base", terms)


def _cut(text: str | None, cuts: list[dict] | None) -> str | None:
    if not text or not cuts:
        return text
    out, at = [], 0
    for cut in cuts:
        if cut["start"] >= at:
            out += [text[at : cut["start"]], cut["by"]]
        at = max(at, cut["end"])
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, chance: float = CHANCE, least: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """The same rows and columns with base values replaced by their kind, and telling terms by `[word]` or nothing.

    Rows meet their spans by id and text; only rows with spans take part in that join's other side.
    """
    at = docs.columns.index("text")

    def cut(s: Column, by: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), by.alias("by"))

    base = F.transform("base", lambda s: cut(s, F.concat(F.lit("<"), s["kind"], F.lit(">"))))
    terms = F.transform("terms", lambda s: cut(s, F.when(s["share"] >= remove, F.lit("")).otherwise(F.lit("[word]"))))
    marked = spans(docs, chance, least).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.sort_array(F.concat(base, terms)).alias("_cuts")
    )
    some = marked.where(F.size("_cuts") > 0).dropDuplicates(["_id", "_key"])
    same = docs["doc_id"].eqNullSafe(some["_id"]) & (F.xxhash64(docs["text"]) == some["_key"])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, kept = batch.column(batch.num_columns - 1).to_pylist(), batch.select(list(range(batch.num_columns - 1)))
            texts = [_cut(text, c) for text, c in zip(batch.column(at).to_pylist(), cuts)]
            yield kept.set_column(at, kept.schema.field(at), pa.array(texts, kept.schema.field(at).type))

    joined = docs.join(some, same, "left").select(*[docs[name] for name in docs.columns], some["_cuts"])
    return joined.mapInArrow(replace, docs.schema)
