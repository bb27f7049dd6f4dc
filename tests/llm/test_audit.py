"""Filter audit, passages and clustering against brute force."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberscan.llm import centroids, filter_audit, passages

from .tables import documents, odd_documents

WORD = r"[^\x20\x09-\x0D]+"


# --- filter audit -------------------------------------------------------------


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_positional_popcount(values):
    found = filter_audit.positional_popcount(np.array(values, dtype=np.uint32))
    assert found.tolist() == [sum(v >> bit & 1 for v in values) for bit in range(32)]


def plain_audit(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic)."""
    judged = []
    for i, text, source in rows:
        text = text or ""
        found = re.findall(WORD, text)
        fails = set()
        fails |= {"A"} if len(found) < 50 else set()
        fails |= {"B"} if 100 * len(set(found)) < 65 * len(found) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        twin = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        fails |= {"E"} if twin else set()
        mine = [(q, x) for j, q, x in labels if j is not None and j == i]
        judged.append((source or "", fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    out = {}
    for part in {p for p, *_ in judged}:
        here = [row for row in judged if row[0] == part]
        shares = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = here
            for step, letter in enumerate(order, 1):
                gone = [row for row in left if letter in row[1]]
                left = [row for row in left if letter not in row[1]]
                failing = sum(letter in row[1] for row in here)
                shares[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(row[1] == {letter} for row in here),
                    sum(row[2] for row in gone), sum(row[3] for row in gone), letter,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = shares[row[6]]
    return out


def test_audit_equals_brute_force(spark):
    random.seed(4)
    texts = [None, "", "  \n", "Same TEXT", "one # two", "w " * 60, " ".join(f"w{n}" for n in range(70)), "\U0001f642 " * 3, "A" + "é" * 30]
    texts += [" ".join(f"w{n}" for n in range(60)) + tail for tail in (" #", " ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")]
    rows = [(random.choice([None, *range(40)]), random.choice(texts), random.choice([None, "", "a", "b|c"])) for _ in range(150)]
    labels = [(random.choice([None, *range(40)]), random.choice([None, 0, 1]), random.choice([None, 0, 1])) for _ in range(60)]
    docs = spark.createDataFrame([(*row, "p", 1) for row in rows], "doc_id long, text string, source string, part string, failed long")
    marks = spark.createDataFrame([(*row, "x") for row in labels], "doc_id long, quality int, toxic int, label string")
    found = {tuple(r[:3]): list(r[3:]) for r in filter_audit.audit(docs.repartition(3), marks).collect()}
    assert found == plain_audit(rows, labels)


def test_audit_of_nothing(spark):
    empty = documents(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).collect() == []
    one = odd_documents(spark, [(1, None)])
    assert filter_audit.audit(one, labels).count() == 600


def test_many_parts_leave_tasks_in_portions(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 2)
    rows = [(n, "w" * n, f"s{n % 7}") for n in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int")
    found = {tuple(r[:3]): list(r[3:]) for r in filter_audit.audit(docs, labels).collect()}
    assert found == plain_audit(rows, [(3, 1, 1)])


# --- passages -------------------------------------------------------------------


def plain_passages(rows, window):
    cut = [(i, re.findall(WORD, text or "")) for i, text in rows]
    firsts = {}
    for i, found in cut:
        if i is not None:
            for at in range(len(found) - window + 1):
                key = tuple(found[at : at + window])
                firsts[key] = min(i, firsts.get(key, i))
    out = []
    for i, found in cut:
        gone = set()
        for at in range(len(found) - window + 1) if i is not None else ():
            if firsts[tuple(found[at : at + window])] < i:
                gone |= set(range(at, at + window))
        kept = " ".join(w for n, w in enumerate(found) if n not in gone)
        out.append((i, len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passage_rows(seed, count=60):
    """Texts glued from shared passages of many lengths, with repeats inside, odd white space and copies."""
    random.seed(seed)
    stock = [" ".join(random.choice("abcdefgh") + str(random.randint(0, 30)) for _ in range(random.choice([3, 9, 12, 20, 60]))) for _ in range(9)]
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, stock[0]), (3, stock[0] + " " + stock[8])]
    for n in range(count):
        parts = [random.choice(stock) if random.random() < 0.6 else f"own{n} own{random.randint(0, 9)}" for _ in range(random.randint(1, 6))]
        rows.append((random.choice([None, *range(80)]), random.choice([" ", "\n", " \x0b\x0c"]).join(parts)))
    return rows + rows[-3:]


@pytest.mark.parametrize("held, block", [(1_000_000, 200_000), (40, 15)])
def test_passages_equal_brute_force(spark, monkeypatch, held, block):
    monkeypatch.setattr(passages, "HELD", held)
    monkeypatch.setattr(passages, "BLOCK", block)
    rows = passage_rows(held)
    docs = odd_documents(spark, rows).repartition(3)
    cut = passages.without_repeats(docs, window=10, gram=3)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in cut.collect()]
    assert sorted(got, key=repr) == plain_passages(rows, 10)
    assert {"class", "row", "_words"} <= set(cut.columns)


def test_factors_copy_their_sources(spark):
    """Every factor's words stand at its source, in a document with a smaller id, and factors are maximal runs of one source."""
    rows = [(n, t) for n, (_, t) in enumerate(passage_rows(5)) if t]
    found = passages.factors(odd_documents(spark, rows), window=10, gram=3).collect()
    words = {i: re.findall(WORD, t) for i, t in rows}
    assert found
    for f in found:
        assert f["source"] < f["doc_id"] and f["length"] >= 10
        assert words[f["doc_id"]][f["start"] :][: f["length"]] == words[f["source"]][f["source_start"] :][: f["length"]]


def test_passage_edges(spark):
    """A repeat of 50 words goes whole, one of 49 stays, and a passage from two sources is found across their border."""
    shared = [f"s{n}" for n in range(120)]
    rows = [
        (5, " ".join(shared[:60])), (6, " ".join(["x", *shared[60:]])), (9, " ".join([*shared[:50], "end"])), (10, " ".join([*shared[:49], "end2"])),
        (8, " ".join([*shared[:40], "mid", *shared[60:115], "tail"])), (7, " ".join(shared)), (20, "long " * 3 + "word " * 40_000),
    ]
    found = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in passages.digests(odd_documents(spark, rows)).collect()}
    # Each word of 7 lies in one of two sources; what lies across their border is in none.
    assert found == {5: (60, 0), 6: (61, 0), 7: (120, 120), 8: (97, 55), 9: (51, 50), 10: (50, 0), 20: (40_003, 0)}


def test_no_passages(spark):
    assert passages.digests(documents(spark).limit(0)).collect() == []


# --- clustering -----------------------------------------------------------------


def plain_clusters(rows, clusters, rounds, scale):
    kept = [(i, tuple(int(np.floor(scale * float(x))) for x in v)) for i, v in rows]
    hashed = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in kept)
    at = [v for _, v in hashed[:clusters]]

    def place():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at)))
        return out

    for _ in range(rounds):
        placed = place()
        for n in range(len(at)):
            mine = [v for (_, v), (_, c) in zip(kept, placed) if c == n]
            if mine:
                at[n] = tuple(sum(col) // len(mine) for col in zip(*mine))
    placed = place()
    whole = sum(d for d, _ in placed)
    return sorted(
        (
            (i, c, d, sum(e for e, b in placed if b == c), whole, hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest())
            for (i, _), (d, c) in zip(kept, placed)
        ),
        key=repr,
    )


@pytest.mark.parametrize("width", [2, 3, 5, 100])
def test_clusters_equal_brute_force(spark, width):
    random.seed(width)
    sound = [(random.choice([None, *range(60)]), [random.choice([-1.5, 0.0, 0.25, 3.7]) + random.random() for _ in range(5)]) for _ in range(70)]
    sound += sound[:6]
    bad = [(100, None), (101, []), (102, [1.0] * 4), (103, [1.0] * 6), (104, [1.0, None, 1.0, 1.0, 1.0]), (105, [float("nan")] * 5), (106, [float("inf")] * 5), (107, [1e30] * 5)]
    vectors = spark.createDataFrame([(i, v, 1, "r", 2) for i, v in sound + bad], "vec_id long, embedding array<double>, cluster int, row string, v int")
    got = centroids.cluster(vectors.repartition(3), clusters=4, rounds=3, dimensions=5, scale=8, width=width)
    got = [(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got.collect()]
    assert sorted(got, key=repr) == plain_clusters(sound, 4, 3, 8)


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(1, [0.5, -0.5]), (2, [4.0, 4.0])], "vec_id long, embedding array<float>")
    assert {r["distance"] for r in centroids.cluster(few, 16, 2, 2, 64).collect()} == {0}
    none = centroids.cluster(few.limit(0), 16, 2, 2, 64)
    assert none.collect() == [] and none.columns[:2] == ["vec_id", "cluster"]
