"""Packing, token counts and mixing against brute force."""

import random
import tracemalloc
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emberscan.llm import mixing, packing, queries, token_counts

from ..conftest import SMALL
from ..plans import explained
from .tables import documents, odd_documents


@pytest.fixture(scope="module")
def plain_encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def encoded(text):
    ids = array("I")
    ids.frombytes(packing.WordEncoder.of(packing.vocabulary_path()).encode(text))
    return list(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cd.\n\t 'sé1\u00a0\u2003\x1c<|>", max_size=40))
def test_word_by_word_ids(plain_encode, text):
    assert encoded(text) == plain_encode(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", " ", "  ", "a", "b c", "\n", "'s", "1"]), max_size=12))
def test_texts_that_spell_an_added_token(plain_encode, parts):
    """The vocabulary's added token is one id wherever a text spells it, as its tokenizer has it."""
    assert encoded("".join(parts)) == plain_encode("".join(parts))


def test_ids_of_documents(spark, plain_encode):
    for row in documents(spark).select("text").collect():
        assert encoded(row["text"]) == plain_encode(row["text"])


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plans_hold_everything_once(histogram):
    placed, taken = defaultdict(list), Counter()
    for length, first, bins, each, sequence, offset, last in packing.plan(histogram, 64):
        assert last - first + 1 == bins * each
        for rank in range(first, last + 1):
            at = rank - first
            placed[sequence + at // each].append((offset + at % each * length, length))
            taken[length, rank] += 1
    assert taken == Counter((n, r) for n, count in histogram.items() for r in range(count))
    for slots in placed.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 64
    first_fit = 0  # best fit decreasing, one by one
    free = []
    for length in sorted(Counter(histogram).elements(), reverse=True):
        fitting = [f for f in free if f >= length]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - length)
        else:
            first_fit += 1
            free.append(64 - length)
    assert len(placed) == first_fit


def check_packed(rows, ids_of):
    by_document, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for slots in sequences.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 1024
    for doc, ids in ids_of.items():
        at = 0
        for number, r in enumerate(sorted(by_document.pop(doc), key=lambda r: r["piece"])):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"], len(part)) == (number, at, r["length"])
            assert zlib.crc32(array("I", part).tobytes()) == r["ids_crc32"]
            assert r["length"] == 1024 or number == 0
            at += r["length"]
        assert at == len(ids)
    assert not by_document
    return len(sequences)


def test_packing_of_whole_table(spark, plain_encode):
    ids_of = {r["doc_id"]: [*plain_encode(r["text"]), 2] for r in documents(spark).collect()}
    count = check_packed(queries.op6_packing(spark, SMALL).collect(), ids_of)
    total = sum(map(len, ids_of.values()))
    assert count <= 1.05 * -(-total // 1024)


def test_packing_odd_rows(spark, folder, plain_encode):
    rows = [(1, None), (2, ""), (3, " lead"), (4, "x  y"), (5, "long " * 3000), (6, "a")]
    odd_documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    check_packed(queries.op6_packing(spark, folder).collect(), {i: [*plain_encode(t or ""), 2] for i, t in rows})
    assert packing.pack(odd_documents(spark, [(1, "a"), (1, "a")])).count() == 2
    assert packing.pack(odd_documents(spark, [])).count() == 0


def test_a_worker_holds_few_texts_at_once(spark):
    """However many rows a batch has: what a worker once took it keeps, beside the JVM, for every later stage."""
    rows = 10_000
    text = "some words of a text " * 100
    batch = pa.record_batch(
        [pa.array(range(rows)), pa.array(range(rows)), pa.array([text] * rows)], names=["doc_id", "row", "text"]
    )
    cut = packing.cutter(packing.vocabulary_path(), 1024, 2)
    list(cut(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    pieces = sum(made.num_rows for made in cut(iter([batch])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert pieces >= rows and peak < 4e6


def test_the_plan_needs_no_python_workers(spark):
    cut = packing.pieces(odd_documents(spark, [(1, "a"), (2, "b c")]))
    placed = packing.place(cut.drop("ids").localCheckpoint())
    assert "Scan ExistingRDD" not in explained(placed).replace("Scan ExistingRDD[doc_id", "")


def test_assembled_sequences(spark):
    packed = packing.pack(odd_documents(spark, [(i, "some words " * (i * 40)) for i in range(30)]))
    made = packing.assemble(packed).collect()
    assert sum(r["length"] for r in made) == sum(r["length"] for r in packed.collect())
    assert all(len(r["ids"]) == 4 * r["length"] <= 4096 for r in made)


def test_rollup_equals_direct_count(spark, plain_encode):
    first = {}
    for r in sorted(documents(spark).collect(), key=lambda r: r["doc_id"]):
        first.setdefault(r["text"], r)
    expected = defaultdict(lambda: [0, 0, 0])
    for r in first.values():
        sums = expected[r["source"], r["lang"], token_counts.BYTES]
        for at, n in enumerate((1, len(plain_encode(r["text"])), len(r["text"]))):
            sums[at] += n
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in queries.op3_token_counts(spark, SMALL).collect()}
    assert got == dict(expected)


def test_rollup_commits_once(spark, folder):
    docs = token_counts.counted(odd_documents(spark, [(1, "a b"), (2, None), (2, None)]))
    rollup = token_counts.Rollup(spark, folder)
    assert rollup.totals().count() == 0
    assert rollup.commit("one", token_counts.inserts(docs, "w", "n_words"))
    assert not rollup.commit("one", token_counts.inserts(docs, "w", "n_words"))
    assert sum(r["n_docs"] for r in rollup.totals().collect()) == 3
    half = f"{folder}/batch=two"
    docs.select("source").write.parquet(half)
    (spark.sparkContext._jvm.java.io.File(f"{half}/_SUCCESS")).delete()
    assert sum(r["n_docs"] for r in rollup.totals().collect()) == 3
    assert rollup.commit("two", token_counts.deletes(docs, "w", "n_words"))
    assert rollup.totals().count() == 0
    folded = rollup.compacted(f"{folder}-folded")
    assert folded.totals().count() == 0
    # A retry after folding is still a retry, also when folded again.
    assert not folded.commit("one", token_counts.inserts(docs, "w", "n_words"))
    assert folded.commit("three", token_counts.inserts(docs, "w", "n_words"))
    again = folded.compacted(f"{folder}-again")
    assert again.batches() == ["one", "three", "two"]
    assert not any(again.commit(name, token_counts.inserts(docs, "w", "n_words")) for name in ("one", "two", "three"))
    assert sum(r["n_docs"] for r in again.totals().collect()) == 3


def test_copies_follow_the_quantile(spark):
    import hashlib
    import math

    random.seed(4)
    docs = odd_documents(spark, [(i, "t" * random.randint(0, 50)) for i in range(200)] + [(None, None)])
    volume = Counter()
    for r in docs.collect():
        volume[r["source"]] += len(r["text"] or "") + 1
    roots = {s: v**0.5 for s, v in volume.items()}
    expected = Counter()
    for r in docs.collect():
        rate = roots[r["source"]] / sum(roots.values()) * sum(volume.values()) / volume[r["source"]]
        name = "" if r["doc_id"] is None else str(r["doc_id"])
        u = int(hashlib.md5(f"{mixing.SEED}:{name}".encode()).hexdigest()[:13], 16) / 2**52
        k, reached = 0, math.exp(-rate)
        while reached <= u:
            k += 1
            reached += math.exp(-rate) * rate**k / math.factorial(k)
        expected[r["doc_id"]] += k
    got = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert got == +expected


def test_given_weights(spark):
    docs = odd_documents(spark, [(i, "some text") for i in range(4000)])
    mixed = mixing.mix(docs, {"s0": 3.0, "s1": 1.0})
    count = Counter(r["source"] for r in mixed.collect())
    assert 2.7 < count["s0"] / count["s1"] < 3.3
    assert mixing.mix(docs, {"s0": 1.0}).where("source = 's1'").count() == 0
    assert mixing.mix(odd_documents(spark, [])).count() == 0
    large = mixing.copies(docs.where("doc_id < 50"), {"s0": 1.0}, repetition=1000.0).count()
    assert 49_000 < large < 51_000


def test_order_is_shuffled(spark):
    docs = odd_documents(spark, [(i, "t") for i in range(1000)])
    keys = [r["mix_key"] for r in mixing.mix(docs).coalesce(1).collect()]
    ids = [r["doc_id"] for r in mixing.mix(docs).collect()]
    assert len(keys) == len(ids) and ids != sorted(ids)
