"""Span scans against brute force: personal data and secrets."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberscan.llm import pii, secret_scan

from .tables import documents, odd_documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def _digits(text):
    return [int(c) for c in text if c in "0123456789"]


def _luhn(digits):
    total = 0
    for at, d in enumerate(reversed(digits)):
        d = d * 2 if at % 2 else d
        total += d // 10 + d % 10
    return total % 10 == 0


def plain_pii(text):
    found = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and _luhn(d):
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def plain_secrets(text):
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab.@-+_%09 1(\n5é", max_size=60))
def test_personal_data_patterns(text):
    assert pii.base_spans(text) == plain_pii(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="0123456789. +-()", max_size=80))
def test_number_patterns(text):
    assert pii.base_spans(text) == plain_pii(text)


PIECES = st.sampled_from(
    ["token", "PassWord", "api_key", "apikey", "ſecret", "=", ":", " ", "'", '"', "abcdefgh", "abc", "AKIA", "ABCDEFGHIJKL",
     "0123456789abcdef0123456789abcdef", "é", "\n", "secret", "=x", "deadbeef"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_secret_patterns(text):
    assert sorted(secret_scan.base_spans(text)) == plain_secrets(text)


def test_long_runs_take_linear_time():
    pii.base_spans("a" * 400_000 + "@" + "b" * 400_000)
    pii.base_spans("1" * 400_000 + ".")
    secret_scan.spans_of("=" * 200_000 + "a" * 200_000)


def test_many_spans_and_long_numbers():
    """Time is linear in the spans of a text; a part of thousands of zeros is a number too."""
    assert pii.base_spans("0" * 6000 + "1.2.3.4") == [(0, 6007, "ip")]
    text = "from ab@cd.ef to " * 20_000
    assert len(pii.near_terms(text, pii.base_spans(text))) == 20_000  # "to" is too short for a term
    config = 'token = abcdefgh12\ndb_secret_name = "kf8 Jd9s0Qw2z!"\n' * 20_000
    found = secret_scan.spans_of(config)
    assert sum(kind == "assign" for _, _, kind in found) == 20_000


def test_constants_reach_names():
    text = 'first = "kf8Jd9s0Qw2z"\nsecond = first\ndb_password = second\ntitle = "a quiet afternoon walk"\n'
    assert secret_scan.literal_spans(text, []) == [(9, 21, "literal")]
    assert secret_scan.literal_spans('password = "changeme"', []) == []
    assert secret_scan.literal_spans('x = "kf8Jd9s0Qw2z"\nx = other\npassword = x\n', []) == []
    assert secret_scan.spans_of(None) == [] == secret_scan.spans_of("")


@pytest.mark.parametrize(
    "text",
    ["db_pwd=§Xk29fjQ0aa71§\nhost=db", "passphrase: §9f8aQx71kkPz§\n", "private_key = §Xk29fjQ0aa71§",
     "--db-pwd=§Xk29fjQ0aa71§ --verbose", 'pwd: str = "§kf8Jd9s0Qw2z§"', 'pwd: Optional[str] = "§kf8Jd9s0Qw2z§"',
     'pwd: str | None = "§kf8Jd9s0Qw2z§"', 'var pwd string = "§kf8Jd9s0Qw2z§"', 'const pwd: string = "§kf8Jd9s0Qw2z§"',
     'config["db_pwd"] = "§kf8Jd9s0Qw2z§"', "config['a'][ 'db_pwd' ] = '§kf8Jd9s0Qw2z§'", 'char pwd[16] = "§kf8Jd9s0Qw2z§"',
     'passphrase = "§correct horse battery staple§"', f'pwd_{"of_a_long_name_" * 9}x = "§kf8Jd9s0Qw2z§"',
     "first=§Xk29fjQ0aa71§\npwd=first"],
)
def test_syntaxes_of_assignments(text):
    before, value, _ = text.split("§")
    assert secret_scan.literal_spans(text.replace("§", ""), []) == [(len(before), len(before) + len(value), "literal")]


@pytest.mark.parametrize(
    "text",
    ["pwd = get_current_value()", "pwd = config.database.pwd", "pwd: SecretStr = Field(1)", "pwd = os.environ[name]",
     "pwd = stored_password", 'title: "a walk", pwd = x', 'note = "correct horse battery staple"'],
)
def test_code_and_names_are_no_literals(text):
    assert secret_scan.literal_spans(text, []) == []


def test_names_take_linear_time():
    for text in ("a" * 400_000 + '="', "[" * 200_000 + "]" * 200_000 + "=x", "a]=" * 100_000, ":" * 200_000 + "=x", "| " * 200_000 + "=x",
                 "[a] " * 100_000 + "=x", "pwd: a[b, c] = " * 50_000, " " * 400_000 + "=x", "x |" * 100_000 + "=y"):
        secret_scan.spans_of(text)


def test_redaction(spark):
    docs = odd_documents(spark, [(1, "my token = abcdefgh123 ok"), (2, "plain"), (3, None)])
    rows = {r["doc_id"]: r for r in secret_scan.redact(docs).collect()}
    assert rows[1]["text"] == "my <assign> ok" and rows[1]["n_chars"] == 14
    assert rows[2]["text"] == "plain" and rows[3]["text"] is None
    assert secret_scan.redact(docs).columns == docs.columns


def test_scan_of_whole_table(spark):
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in secret_scan.scan(docs).collect():
        base = sorted(tuple(s) for s in row["spans"] if s["kind"] != "literal")
        assert base == plain_secrets(texts[row["doc_id"]] or "")


@pytest.fixture(scope="module")
def telling(spark):
    """Ten documents tell of one address by a rare word; the word 'common' stands everywhere."""
    rows = [(i, f"common words here zyxwort mail me@site.org for common things {i}") for i in range(10)]
    rows += [(i, f"common words here and nothing else {i}") for i in range(10, 60)]
    return odd_documents(spark, [*rows, (60, None), (61, ""), (1, "again common me@site.org zyxwort")])


def test_terms_that_disclose(telling):
    found = pii.spans(telling).collect()
    terms = {t["term"] for row in found for t in row["terms"]}
    assert "zyxwort" in terms and "common" not in terms
    assert len(found) == telling.count()
    assert all(not row["terms"] for row in found if not row["base"])


def test_shares_equal_brute_force(spark, telling):
    import math

    found = pii.find(telling)
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosures(found, telling, 1, -99.0).collect()}
    texts = [r["text"] or "" for r in telling.collect()]
    own = [set(re.findall(pii.TERM, t.lower())) for t in texts]
    n = len(texts)
    near = [{(e, t) for e, t, _, _ in pii.near_terms(t, pii.base_spans(t))} for t in texts]
    holds = [{pii.entity_of(k, t[s:e]) for s, e, k in pii.base_spans(t)} for t in texts]
    for entity, term in set().union(*near):
        n_ct = sum((entity, term) in x for x in near)
        n_c, n_t = sum(entity in x for x in holds), sum(term in x for x in own)
        expected = math.log(n_ct * n / (n_c * n_t)) / math.log(n / n_c)
        assert got[entity, term] == pytest.approx(expected)
    assert len(got) == len(set().union(*near))


def test_rare_pairs_are_judged_by_chance(spark):
    """A rare name beside an entity that occurs once discloses it; a stray word beside a frequent entity does not."""
    rows = [(i, f"ordinary words of a letter {'to all@site.org' if i % 3 else 'to nobody'}") for i in range(60)]
    rows += [(60, "ordinary words by Quillfeather at one@site.org"), (61, "ordinary stray words to all@site.org")]
    found = {row["doc_id"]: [t["term"] for t in row["terms"]] for row in pii.spans(odd_documents(spark, rows)).collect()}
    assert found[60] == ["quillfeather"] and found[61] == [] and found[1] == []


def test_telling_terms_far_from_their_entity(spark):
    """Pairs are of whole documents, letters of any script, and a telling term is marked wherever it stands."""
    names = ["Quillfeather", "Παπαδόπουλος", "Щербаков", "张伟", "mk7731"]
    rows = [(i, f"ordinary words of a letter {'x' * (i % 5)}") for i in range(2000)]
    rows += [(2000 + i, f"words by {name}. {'ordinary words of a letter ' * 200} to one{i}@site.org") for i, name in enumerate(names)]
    rows += [(3000, "words of a letter by QUILLFEATHER and of щербаков, quillfeathers")]
    docs = odd_documents(spark, rows)
    found = {row["doc_id"]: [(t["term"], t["start"]) for t in row["terms"]] for row in pii.spans(docs).collect()}
    for i, name in enumerate(names):
        assert found[2000 + i] == [(name.casefold(), 9)]
    assert found[3000] == [("quillfeather", 21), ("щербаков", 41)]
    assert all(not found[i] for i in range(2000))
    sanitised = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "QUILL" not in sanitised[3000] and "щерб" not in sanitised[3000] and len(sanitised) == len(rows)


def test_sanitised_texts(telling):
    rows = pii.sanitise(telling).collect()
    assert all("@" not in (r["text"] or "") and "zyxwort" not in (r["text"] or "") for r in rows)
    assert sum(r["text"] is None for r in rows) == 1
    assert pii.sanitise(telling).columns == telling.columns


def test_empty_tables(spark):
    none = odd_documents(spark, [])
    assert pii.spans(none).count() == 0 and secret_scan.scan(none).count() == 0
    assert pii.sanitise(none).count() == 0 and secret_scan.redact(none).count() == 0
