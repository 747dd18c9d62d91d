"""Fill-in-the-middle against a loop over the units."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from postlake.llm.middle_fill import UNIT, fill_in_middle, restored
from postlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def loop(key, text, seed=42, changed=50, first=80):
    """What one row becomes, unit by unit."""
    text = text or ""
    units = re.findall(UNIT, text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i * 8 : i * 8 + 8], 16) for i in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= changed:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_registered_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for doc_id, text in docs:
        n, form, low, middle, output = loop(doc_id, text)
        want[doc_id] = (n, form, low, middle, sha(output), sha(text or ""))
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op12_middle_fill"](spark, FOLDER).collect()}
    assert got == want
    assert {w[1] for w in want.values()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize(("changed", "first"), [(100, 0), (100, 100), (60, 50)])
def test_odd_rows(spark, changed, first):
    draw = random.Random(changed + first)
    odd = [None, "", " ", "\n\t", "one", " one", "one ", "a\x0bb\x0c c\r\n", "é 😀 x", "a <P> b", "x<S>", "<M", "< P >", "<S <P <M>"]
    odd += ["".join(draw.choice("ab é\t\n<>SPM😀") for _ in range(draw.randint(1, 60))) for _ in range(150)]
    rows = [(i, t, i, "x", t) for i, t in enumerate(odd)]
    rows += [(None, "no id at all here", 1, "y", None), (None, "no id at all here", 1, "y", None), (3, "\n\t", 3, "x", "")]
    rows += [(900, "many words and more " * 60_000, 0, None, None), (901, "x" * 1_000_000, 0, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n bigint, form string, `row` string")
    made = fill_in_middle(docs, 7, changed=changed, suffix_first=first)
    got = made.select("row.*", "fim", restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    assert len(got) == len(rows)
    assert all(r.back == (r.text or "") for r in got)
    want = sorted((repr(tuple(r)), repr(loop(r[0], r[1], 7, changed, first))) for r in rows)
    assert sorted((repr(tuple(r[:5])), repr(tuple(r.fim))) for r in got) == want
    assert fill_in_middle(docs.limit(0)).collect() == []
