"""N-gram join, components and embeddings against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberscan.llm import embedding_dedup, ngram_join
from emberscan.llm.components import components

from .tables import odd_documents


def reach(nodes, links):
    least = {n: n for n in nodes}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        least[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def gram_set(text, n):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = ["".join(c.lower() if c.isascii() else c for c in w) for w in found]
    if not found:
        return frozenset()
    n = min(n, len(found))
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def plain_components(rows, n, percent):
    sets = {i: gram_set(t, n) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in reach(ids, links).items()}


def varied_documents(seed, families=12, copies=9):
    """Families of edited copies, of many lengths, so that similarities fall on both sides of any limit."""
    random.seed(seed)
    rows, number = [], 0
    for _ in range(families):
        base = [f"w{random.randint(0, 400)}" for _ in range(random.choice([1, 2, 3, 5, 8, 12, 30, 60, 150, 400]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(random.randint(0, max(1, len(words) // 15))):
                at = random.randrange(len(words))
                words[at : at + random.choice([0, 1])] = random.choice([[], ["X"], [f"y{random.randint(0, 99)}"]])
            rows.append((number, " ".join(words)))
            number += 1
    return rows


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 5, 80)])
def test_components_equal_brute_force(spark, seed, n, percent):
    rows = [*varied_documents(seed), (1000, None), (1001, ""), (1002, " \t "), (1003, "WORD"), (1004, "word"), (1005, "É"), (1006, "é")]
    got = ngram_join.join_components(odd_documents(spark, rows), n, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_components(rows, n, percent)


@pytest.mark.parametrize(("bound", "value"), [("BLOCK", 4), ("BLOCK_ELEMENTS", 200), ("SKETCH_BLOCK", 3), ("TIES", 40)])
def test_blocks_lose_nothing(spark, monkeypatch, bound, value):
    monkeypatch.setattr(ngram_join, bound, value)
    rows = varied_documents(3, families=3, copies=30)
    got = ngram_join.join_components(odd_documents(spark, rows), 3, 90).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_components(rows, 3, 90)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9), st.integers(0, 1)), min_size=1, max_size=40))
def test_stars_connect_the_same(ties):
    star = ngram_join._star(*(np.array(c) for c in zip(*ties))).to_pylist()
    edges = {((a, band), (b, band)) for a, b, band in ties if a != b}
    expected = {}
    for node in {n for edge in edges for n in edge}:
        seen, todo = {node}, [node]
        while todo:
            at = todo.pop()
            new = {b if a == at else a for a, b in edges if at in (a, b)} - seen
            seen |= new
            todo += new
        if min(seen) != node:
            expected[node] = min(seen)
    assert {(r["class"], r["band"]): (r["least"], r["band"]) for r in star} == expected


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 120), st.integers(0, 10_000), st.sampled_from([80, 90]), st.sampled_from([(0, 1), (1, 2), (1, 3), (2, 4)]))
def test_similar_sets_share_a_signature(size, seed, percent, scheme):
    random = np.random.default_rng(seed)
    a = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
    for removed in range(len(a)):
        added = random.integers(0, 2**63, int(random.integers(0, 8)), dtype=np.uint64)
        b = np.unique(np.concatenate([random.permutation(a)[removed:], added]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common):
            shared = np.intersect1d(ngram_join.signatures(a, percent, *scheme), ngram_join.signatures(b, percent, *scheme))
            assert len(shared)
        else:
            break


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.integers(0, 10_000), st.sampled_from([80, 90]))
def test_sketches_never_differ_more_than_sets(size, seed, percent):
    random = np.random.default_rng(seed)
    a = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
    b = np.unique(np.concatenate([random.permutation(a)[int(random.integers(0, size // 8 + 1)) :], random.integers(0, 2**63, int(random.integers(0, size // 8 + 2)), dtype=np.uint64)]))
    high = max(ngram_join.band_of(len(s), percent)[1] for s in (a, b))
    differing = np.bitwise_count(ngram_join.sketch(a, high) ^ ngram_join.sketch(b, high)).sum()
    assert differing <= len(np.setxor1d(a, b))


def test_sketches_keep_strangers_apart():
    """Documents that share half their shingles are tied by signatures, not by sketches."""
    random = np.random.default_rng(1)
    shared = random.integers(0, 2**63, 150, dtype=np.uint64)
    made = [np.unique(np.concatenate([shared, random.integers(0, 2**63, 150, dtype=np.uint64)])) for _ in range(30)]
    high = ngram_join.band_of(300, 80)[1]
    rows = [np.concatenate([np.array([len(m)], dtype=np.uint64), ngram_join.sketch(m, high)]) for m in made]
    assert ngram_join._near_sketches(rows, None, 80) == []


def test_one_signature_of_a_task(spark):
    """However many classes of a task share a signature, one row of it is shuffled; the rest are tied in the task."""
    rows = [(i, " ".join(f"w{n}" for n in range(40)) + f" end{i}") for i in range(50)]
    found = ngram_join.signature_rows(odd_documents(spark, rows).coalesce(1), 3, 90).collect()
    sent = [r["signature"] for r in found if r["signature"] is not None]
    assert len(sent) == len(set(sent)) and sum(r["signature"] is None for r in found) >= 49


def test_one_of_each(spark):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (9, "other words stand in this one"), (10, None), (None, "x y")]
    kept = ngram_join.one_of_each(odd_documents(spark, rows), 5, 80)
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 9, 10]
    assert kept.columns == odd_documents(spark, []).columns


def test_one_of_each_with_repeated_and_null_ids(spark):
    """Rows, not ids, are kept or dropped."""
    copied, alone, near = "a b c d e f g", "a clean text that stands nowhere else", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"
    rows = [(1, "equal rows are one document"), (1, "equal rows are one document"), (1, "equal rows are one document"),
            (2, copied), (3, copied), (3, alone), (4, near), (4, near.upper()),
            (None, copied), (None, "copies without any id"), (None, "copies without any id"), (None, None), (None, None)]
    kept = ngram_join.one_of_each(odd_documents(spark, rows), 5, 80).collect()
    assert sorted(((r["doc_id"] or 0), r["text"] or "") for r in kept) == sorted(
        [(1, "equal rows are one document"), (2, copied), (3, alone), (4, near.upper()), (0, "copies without any id"), (0, ""), (0, "")]
    )


def test_empty_tables(spark):
    assert ngram_join.join_components(odd_documents(spark, []), 3, 90).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_components_of_random_edges(spark, seed):
    random.seed(seed)
    nodes = range(300)
    chain = [(i, i + 1) for i in range(0, 60)]
    edges = chain + [(random.choice(nodes), random.choice(nodes)) for _ in range(120)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = reach(nodes, edges)
    assert {r["node"]: r["component"] for r in got} == {n: expected[n] for e in edges for n in e if e[0] != e[1] or any(
        n in f and f[0] != f[1] for f in edges)}


def vector_rows(seed, groups=20, copies=12, size=16):
    random = np.random.default_rng(seed)
    rows, number = [], 0
    for _ in range(groups):
        centre = random.standard_normal(size)
        for _ in range(copies):
            noise = random.standard_normal(size) * random.choice([0, 0.02, 0.1])
            rows.append((number, [float(x) for x in np.float32(centre + noise)], int(random.integers(0, 2))))
            number += 1
    nan = float("nan")
    odd = [None, [0.0] * size, [nan] * size, [float("inf")] + [1.0] * (size - 1), [], [None, 1.0], [1.0], [2.0], [1e-30] * 3]
    rows += [(number + at, v, 0) for at, v in enumerate(odd)]
    return [*rows, (9000, rows[0][1], None), (9001, rows[0][1], None), (9002, rows[0][1], 7), (9002, rows[0][1], 7)]


def plain_links(rows):
    def usable(v):
        return v and None not in v and np.isfinite(v).all() and any(v)

    links = []
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if label is not None and label == rows[j][2] and usable(v) and usable(w) and len(v) == len(w):
                v1, w1 = np.array(v), np.array(w)
                if v1 @ w1 / np.sqrt((v1 @ v1) * (w1 @ w1)) >= 0.98:
                    links.append((i, j))
    return links


@pytest.mark.parametrize("block", [512, 3])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vector_rows(5)
    links = plain_links(rows)
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    least = reach(range(len(rows)), links)
    expected = []
    for at, (name, _, _) in enumerate(rows):
        group = min(rows[i][0] for i in range(len(rows)) if least[i] == least[at])
        expected.append((name, sum(at in link for link in links), group, name == group))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_recall_at_the_limit():
    """Pairs right at cosine 0.98 share a key nearly always."""
    random = np.random.default_rng(3)
    a = random.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    other = random.standard_normal((4000, 64))
    other -= (other * a).sum(axis=1, keepdims=True) * a
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * other
    options = (embedding_dedup.TABLES, embedding_dedup.PROJECTIONS, embedding_dedup.WIDTH, embedding_dedup.SEED)
    meet = (embedding_dedup.table_keys(a, *options) == embedding_dedup.table_keys(b, *options)).any(axis=1)
    assert meet.mean() > 0.995
