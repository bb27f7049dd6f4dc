"""Quality rules, URL filters, chat formatting, and the pipeline."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
import corpus_pipeline
from emberscan.llm import chat, oracles, quality, queries, urls

from ..compare import connect, difference
from ..conftest import SMALL
from ..plans import explained
from .tables import documents, odd_documents


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_same_result_as_duckdb(spark, duck, name):
    assert difference(queries.REGISTRY[name](spark, SMALL), duck, oracles.oracle_sql()[name]) is None


def test_all_are_registered():
    names = set(queries.REGISTRY)
    assert {int(re.match(r"op(\d+)_", n).group(1)) for n in names} == set(range(1, 11))
    assert names | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_url_filters", "op4_mixing", "op9_chat_formatting"])
def test_native_plans(spark, name):
    plan = explained(queries.REGISTRY[name](spark, SMALL))
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct"):
        assert word not in plan


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


TEXTS = st.lists(
    st.sampled_from(["a", "b", "ab", " ", "  ", "\n", "\t", "#", "é", "a b a b a b a b a b a b\n", "\x85", "line one\n"]), max_size=30
).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXTS, max_size=40))
def test_counts_equal_brute_force(spark, texts):
    rows = [*enumerate(texts), (900, None), (901, ""), (902, "w " * 30_000)]
    got = quality.measures(odd_documents(spark, rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {i: plain_counts(t) for i, t in rows}


def test_rules_agree_with_labels(spark):
    """Nearly all labelled junk goes, nearly all labelled good documents of 20 words and more stay."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").select("quality", "kept", "base_failed").collect()
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert sum(junk) <= 0.05 * len(junk) and sum(good) >= 0.99 * len(good)


def test_kept_columns(spark):
    assert quality.keep_good(odd_documents(spark, [(1, "x")])).columns == odd_documents(spark, []).columns
    assert quality.judge(odd_documents(spark, [])).count() == 0


URLS = [
    (1, "http://A.Example.org/es/x?y#z", "a.example.org", "/es/x", "example.org/es/", "block"),
    (2, "https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "x://b.org/", "b.org", "/", "org/", "allow"),
    (4, "x://b.org", "b.org", "", None, "allow"),
    (5, "x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (6, "http://s.com/de/1", "s.com", "/de/1", "com/de/", "block"),
    (7, None, "", "", None, "allow"),
    (8, "no scheme", "", "", None, "allow"),
    (9, "a://b://c/d", "b:", "//c/d", None, "allow"),
    (10, "a://É.COM/fr/", "É.com", "/fr/", "com/fr/", "allow"),
    (11, "http://\n.org/a\nb?", "\n.org", "/a\nb", "org/", "allow"),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u, *_ in URLS], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = urls.judge(pages, labels).select("page_id", "url", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted(URLS)
    assert urls.allowed(pages, labels).columns == pages.columns


def test_bad_hosts_are_blocked_and_small_ones_shrunk(spark):
    rows = [(i, f"http://bad.x.net/{i}") for i in range(60)] + [(i + 100, f"http://good.x.net/{i}") for i in range(60)]
    rows += [(i + 200, f"http://h{i}.y.net/") for i in range(60)] + [(500, "http://new.z.net/")]
    labels = [(i, 0, 0) for i in range(55)] + [(i, 1, 0) for i in range(55, 60)] + [(i + 100, 1, 0) for i in range(60)]
    labels += [(200, 0, 0), (None, 0, 0), (201, None, None)] + [(i + 200, 1, 0) for i in range(2, 60)]
    judged = urls.judge(
        spark.createDataFrame(rows, "page_id long, url string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).collect()
    verdict = {r["host"]: r["verdict"] for r in judged}
    assert verdict["bad.x.net"] == "block" and verdict["good.x.net"] == "allow"
    assert verdict["h0.y.net"] == "allow" and verdict["new.z.net"] == "allow"


TURNS = st.lists(
    st.tuples(
        st.sampled_from(["user", "assistant", "sys>\n\\g", None]),
        st.lists(st.sampled_from(["<", "\\", "/turn", "turn", ">", "\n", "</turn>\n", "<turn user>\n", "|", "<|", "x", "é"]), max_size=8).map("".join),
    ),
    min_size=1,
    max_size=6,
)


@settings(max_examples=8, deadline=None)
@given(st.lists(TURNS, min_size=1, max_size=25))
def test_every_text_comes_back(spark, conversations):
    rows = [(c, t, role, text) for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
    rows.append((-1, None, "assistant", None))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(frame).collect()
    back = {r["conv_id"]: r for r in chat.read_back(chat.render(frame)).collect()}
    for c, turns in enumerate(conversations):
        assert [tuple(t) for t in back[c]["turns"]] == [(role or "", text) for role, text in turns]
        assert "".join(back[c]["trained"]) == "".join(text for role, text in turns if role == "assistant")
    for r in rendered:
        assert sum(sum(run) for run in r["loss_runs"]) == len(r["formatted"])


PIECES = st.sampled_from(["<", "\\", "/turn", "turn", ">", "\n", "</turn>\n", "<turn assistant>\n", "|", "<|", "|>", ":1", "x", "é"])
HOSTILE = st.lists(PIECES, max_size=5).map("".join)
PARTS = st.lists(st.tuples(st.one_of(st.sampled_from(["text", "text", "image", None]), HOSTILE), HOSTILE), max_size=6)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), PARTS), min_size=1, max_size=4), min_size=1, max_size=20))
def test_no_part_breaks_out_of_the_template(spark, conversations):
    """Hostile texts, side by side or not, and hostile kinds: turns, parts and mask come back."""
    rows = [
        (c, t, role, [(kind, text, "r", 1) for kind, text in parts])
        for c, turns in enumerate(conversations) for t, (role, parts) in enumerate(turns)
    ]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS_TYPE}")
    rendered = {r["conv_id"]: r for r in chat.render(frame).collect()}
    back = {r["conv_id"]: r for r in chat.read_back(chat.render(frame)).collect()}
    for c, turns in enumerate(conversations):
        assert [t["role"] for t in back[c]["turns"]] == [role for role, _ in turns]
        attached = []
        for at, ((_, parts), found) in enumerate(zip(turns, back[c]["parts"])):
            want = []
            for number, (kind, text) in enumerate(parts):
                if kind not in ("text", None):
                    want.append((kind, number, None))
                    attached.append((at, number, kind))
                elif text:
                    joined = want and want[-1][0] == "text" and want[-1][1] is None
                    want[-1:] = [("text", None, want[-1][2] + text)] if joined else [*want[-1:], ("text", None, text)]
            assert [tuple(p) for p in found] == want
        assert [(a["turn_at"], a["part"]["number"], a["part"]["kind"]) for a in rendered[c]["attachments"]] == attached
        assert sum(sum(run) for run in rendered[c]["loss_runs"]) == len(rendered[c]["formatted"])
        assert ["assistant" if run["under"] else None for run in rendered[c]["loss_runs"]].count("assistant") <= sum(r == "assistant" for r, _ in turns)


def test_parts_become_placeholders(spark):
    parts = [("text", "see ", None, None), ("image", None, "s3://a", 1000), ("text", " <|image:1|>", None, None), ("audio", None, "b", None)]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PARTS_TYPE}")
    row = chat.render(frame).first()
    assert row["formatted"] == "<turn user>\nsee <|image:1|> <\\|image:1|><|audio:3|></turn>\n<turn assistant>\n</turn>\n"
    assert [(a["turn_at"], a["part"]["number"], a["part"]["kind"], a["part"]["ref"], a["part"]["tokens"]) for a in row["attachments"]] == [
        (0, 1, "image", "s3://a", 91), (0, 3, "audio", "b", 8)]
    assert row["n_tokens_attached"] == 99
    assert chat.render(frame.where("conv_id = 5")).count() == 0


def test_pipeline_stages(spark, folder):
    from emberscan.llm import mixing, ngram_join, secret_scan

    from .test_joins import plain_components
    from .test_spans import plain_secrets

    docs = documents(spark)
    last = None
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name == "quality_rules":
            assert 0.7 * len(given) < docs.count() < len(given)
        elif name == "ngram_join":
            expected = plain_components([(r["doc_id"], r["text"]) for r in given], 5, 80)
            assert {r["doc_id"] for r in docs.collect()} == {i for i, (_, c) in expected.items() if i == c}
        elif name == "secret_scans":
            assert docs.count() == len(given)
            assert not any(plain_secrets(r["text"]) for r in docs.collect())
        elif name == "mixing":
            assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in given}
        if name != "packing":
            assert docs.columns == documents(spark).columns
            last = docs
    assert docs.select("doc_id").distinct().count() == last.select("doc_id").distinct().count()
    assert {"sequence_id", "offset", "length", "doc_id"} <= set(docs.columns)
    assert ngram_join and mixing and secret_scan


def test_pipeline_of_an_empty_table(spark, folder):
    documents(spark).limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
