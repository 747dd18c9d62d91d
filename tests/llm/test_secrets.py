"""Secret spans against Python's own regular expressions."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postlake.llm.queries import QUERIES
from postlake.llm.secret_scan import RULES, Rule, find_secrets, span_text, trigram_query, without_secrets

FOLDER = "/root/testdata/sf0.01"
ASSIGN = re.compile(
    r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|(?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:d|D)"""
    r"""|(?:s|S)(?:e|E)(?:c|C)(?:r|R)(?:e|E)(?:t|T)|(?:t|T)(?:o|O)(?:k|K)(?:e|E)(?:n|N)"""
    r"""|(?:a|A)(?:p|P)(?:i|I)_?(?:k|K)(?:e|E)(?:y|Y))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def loop_base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def digest(spans):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def test_registered_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        base = loop_base(r.text)
        want[r.doc_id] = (*[sum(k == n for _, k, _ in base) for n in range(3)], digest(base))
    got = QUERIES["op9_secrets"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got} == want
    assert len(got) == len(rows) and any(v[0] for v in want.values())


def test_awkward_texts(spark):
    pem = "-----BEGIN RSA PRIVATE KEY-----"
    texts = [
        None, "", "é😀 token = 'abcdefghijklmnop' end", "token: password: abcdefghijklmnop", "API_KEY=AKIA" + "B" * 16,
        "apikey = short", "AKIA" + "C" * 13, "AKIAAKIA" + "D" * 12, "deadbeef" * 40_000, "0123456789abcdef", f"x {pem} y",
        "secret='" + "a" * 300_000, "gho_" + "a1" * 18, "token=" + "x" * 11 + " token=" + "x" * 12, "PassWord = ABCDEFGHIJKL",
        "toKen = abcdefghijklmnop", "0123456789ABCDEF", "token=secret=abcdefghijkl", "same token=abcdefghijkl",
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "token=abcdefghijkl", "s"), (18, texts[18], "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    found = find_secrets(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(s) for s in r.spans if s.place < 3] == loop_base(r.row.text or ""), r.row.doc_id
    kinds = {RULES[s.place].kind for r in found for s in r.spans}
    assert kinds == {"assign", "access", "hex", "private_key", "github"}
    clean = {r.row.doc_id: r.text for r in without_secrets(docs).collect()}
    assert clean[0] is None and clean[2] == "é😀 [SECRET]' end" and clean[4] == "[SECRET]" and clean[8] == "[SECRET]"
    assert clean[5] == texts[5] and clean[10] == "x [SECRET] y"
    assert find_secrets(docs.limit(0)).collect() == []


def test_rules_without_trigrams_scan_all(spark):
    docs = spark.createDataFrame([(1, "ab 123456 cd"), (2, "nothing")], "doc_id bigint, text string")
    rules = [Rule("digits", "[0-9]+", least=6)]
    got = find_secrets(docs, rules).select("row.doc_id", span_text("spans", rules).alias("s")).collect()
    assert {tuple(r) for r in got} == {(1, "digits:3:9"), (2, "")}


def test_trigram_queries():
    sets = lambda *words: [frozenset(w[i : i + 3] for i in range(len(w) - 2)) for w in words]
    assert trigram_query("abcde") == [sets("abcde")]
    assert trigram_query("(foo|bar)x?[0-9]+quux") == [sorted(sets("foo", "bar"), key=sorted), sets("quux")]
    assert trigram_query("(ab|foo).*") == [] and trigram_query("[0-9a-f]{16,}") == []
    assert trigram_query("(?:abc)+d") == [sets("abc")]
    assert trigram_query("x[yz]w") == [sorted(sets("xyw", "xzw"), key=sorted)]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(RULES), st.data())
def test_every_match_meets_its_query(rule, data):
    text = data.draw(st.from_regex(re.compile(rule.pattern, re.ASCII)))
    held = {text.lower()[i : i + 3] for i in range(len(text) - 2)}
    assert all(any(option <= held for option in term) for term in trigram_query(rule.pattern))


@pytest.mark.parametrize("name", ["op9_secrets"])
def test_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
