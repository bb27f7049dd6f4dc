"""Best-fit packing of token sequences, planned over the histogram of lengths.

1. `pieces` tokenises every document once (Arrow batches, one task at a time),
   ends it with the end id and cuts what is longer than the capacity. All pieces
   of a cut document are full but the first.
2. `plan` runs best-fit decreasing over the counts of the at most `capacity`
   different lengths: bins filled alike are one row with a count, so the driver
   handles a table bounded by the capacity, whatever the number of documents.
3. `place` ranks pieces within their length and joins rank to planned slot. Ranks
   are dealt without gathering a length in one task: pieces fall into many
   buckets by a hash, a bucket's first rank comes from the counts of those before
   it, and only within a bucket are rows numbered.
4. `assemble` concatenates pieces into sequences.

Defined results: a null text is an empty one, whose document is the end id
alone; repeated rows are packed once each; an empty table gives no rows; columns
of the input other than id and text are not carried.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep, sliced

CAPACITY = 1024
END_ID = 2
BUCKET_ROWS = 50_000  # pieces numbered by one window group, on average
PIECES_AT_ONCE = 500  # pieces that a Python worker gathers before it sends them on
CACHE_WORDS = 150_000  # different words whose ids a Python worker remembers
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's only added token, which texts may spell out.
ADDED_TOKENS = {"<|endoftext|>": 50256}

# A space between two other non-spaces begins a token by the vocabulary's pattern,
# so texts can be encoded word by word where all spaces are of that kind.
_ODD_SPACE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit integers, remembering those of words."""

    _open: dict[str, WordEncoder] = {}

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED_TOKENS
        )
        self._encode = encoding.encode_ordinary
        self._encode_added = partial(encoding.encode, allowed_special="all")
        encode = self._packed

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = encode(" " + word)
                if len(self) < CACHE_WORDS:
                    self[word] = ids
                return ids

        self._word = Words().__getitem__

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """One encoder per Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _packed(self, text: str) -> bytes:
        ids = array("I", self._encode(text))
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        if any(token in text for token in ADDED_TOKENS):
            return array("I", self._encode_added(text)).tobytes()
        words = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        first = words[0]
        if len(words) > 1 and first == "":  # the text begins with a space
            return self._packed(text) if len(words) == 2 else self._packed(" " + words[1]) + self._rest(words[2:])
        return self._packed(first) + self._rest(words[1:])

    def _rest(self, words: list[str]) -> bytes:
        return b"".join(map(self._word, words))


def pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, row, piece, start, length, and `ids` (binary, little-endian unsigned 32-bit).

    `row` tells repeated documents apart: it is unique per input row of one run.
    """
    slim = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return slim.mapInArrow(
        cutter(vocabulary or vocabulary_path(), capacity, end_id),
        "doc_id long, row long, piece int, start long, length long, ids binary",
    )


def cutter(path: str, capacity: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does: (doc_id, row, text) to pieces, a few texts and a few pieces at a time."""
    ending = array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for batch in sliced(batches):
            out: list[tuple] = []
            for doc, row, text in zip(*(column.to_pylist() for column in batch.columns)):
                ids = encoder.encode(text or "") + ending
                total, at, number = len(ids) // 4, 0, 0
                while at < total:
                    to = at + ((total - at) % capacity or capacity) if at == 0 else at + capacity
                    out.append((doc, row, number, at, to - at, ids[4 * at : 4 * to]))
                    at, number = to, number + 1
                if len(out) > PIECES_AT_ONCE:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = ("doc_id", "row", "piece", "start", "length", "ids")
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))

    return cut


# --- the plan ------------------------------------------------------------------


@dataclass
class _Bins:
    """`count` bins filled alike: (length, how many of it) in order, `free` tokens left."""

    count: int
    free: int
    slots: list[tuple[int, int]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int, int]]:
    """Slots as rows (length, first_rank, bins, each, first_sequence, offset, last_rank).

    Ranks first_rank..last_rank of a length go `each` to a bin, to sequences
    first_sequence and on, from `offset` on. Longest lengths first; each goes where it leaves the
    least room, which is decided once for all bins filled alike. A length splits at most
    one row of bins and opens at most two, so the plan is bounded by the capacity.
    """
    open_bins: dict[int, list[_Bins]] = {}
    done: list[_Bins] = []

    def put(bins: _Bins) -> None:
        (open_bins.setdefault(bins.free, []) if bins.free else done).append(bins)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for free in sorted(f for f in open_bins if f >= length):
            each = free // length
            stack = open_bins.pop(free)
            while stack and left >= each:
                bins = stack.pop()
                take = min(bins.count, left // each)
                if take < bins.count:
                    stack.append(_Bins(bins.count - take, free, bins.slots))
                put(_Bins(take, free - take_length(each, length), [*bins.slots, (length, each)]))
                left -= take * each
                if take < bins.count:
                    break
            if stack and 0 < left < each:
                bins = stack.pop()
                if bins.count > 1:
                    stack.append(_Bins(bins.count - 1, free, bins.slots))
                put(_Bins(1, free - take_length(left, length), [*bins.slots, (length, left)]))
                left = 0
            if stack:
                open_bins.setdefault(free, []).extend(stack)
            if not left:
                break
        each = capacity // length
        if left // each:
            put(_Bins(left // each, capacity - take_length(each, length), [(length, each)]))
            left %= each
        if left:
            put(_Bins(1, capacity - take_length(left, length), [(length, left)]))
    rows, next_rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for bins in [*done, *(b for stack in open_bins.values() for b in stack)]:
        offset = 0
        for length, each in bins.slots:
            first = next_rank[length]
            next_rank[length] = first + bins.count * each
            rows.append((length, first, bins.count, each, sequence, offset, next_rank[length] - 1))
            offset += length * each
        sequence += bins.count
    return rows


def take_length(each: int, length: int) -> int:
    return each * length


SLOT = ("length", "first_rank", "bins", "each", "first_sequence", "first_offset", "last_rank")

# --- placing --------------------------------------------------------------------


def ranked(cut: DataFrame) -> DataFrame:
    """Pieces with `rank`, from 0 within their length, and a histogram-friendly bucket."""
    total = cut.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    placed = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(buckets)).cast("int"))
    counts = placed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "row", "piece")
    return (
        placed.withColumn("_at", F.row_number().over(within) - 1)
        .join(firsts, ["length", "_bucket"])
        .withColumn("rank", F.col("_first") + F.col("_at"))
        .drop("_bucket", "_at", "_first")
    )


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with sequence_id and offset. `cut` is read several times: pass a saved frame."""
    spark = cut.sparkSession
    histogram = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # As an Arrow table: rows in a list would be read by Python workers of their own on the executors.
    columns = zip(*plan(histogram, capacity)) if histogram else [()] * len(SLOT)
    slots = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=list(SLOT)))
    at = F.col("rank") - F.col("first_rank")
    found = ranked(cut).join(
        F.broadcast(slots.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank")),
    )
    return found.select(
        *cut.columns,
        (F.col("first_sequence") + F.floor(at / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("first_offset") + at % F.col("each") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Whole packing with the ids of every piece: doc_id, row, piece, start, length, sequence_id, offset, ids.

    Pieces are placed without their ids, which move once, to their places.
    """
    cut = keep(pieces(docs, vocabulary, capacity, end_id))
    placed = place(keep(cut.drop("ids")), capacity)
    return placed.join(cut.select("row", "piece", "ids"), ["row", "piece"]).select(*placed.columns, "ids")


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids (binary): the sequences themselves. A sequence gathers at most `capacity` pieces."""
    gathered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), gathered.alias("_parts")).select(
        "sequence_id",
        "length",
        F.aggregate("_parts", F.lit(b"").cast("binary"), lambda acc, part: F.concat(acc, part["ids"])).alias("ids"),
    )
