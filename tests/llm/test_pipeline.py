"""The pipeline's stages on planted cases, and its run over the tables."""

import corpus_pipeline
import numpy as np
import pytest
from test_simhash import loop_components, loop_fingerprint
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from postlake.llm.queries import WORD_TOKENIZER
from postlake.llm.tokens import vocabulary

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STAGES = dict(corpus_pipeline.STAGES)


def prose(seed, sentences=20):
    draw = np.random.default_rng(seed)
    return " ".join(" ".join(f"w{x}" for x in draw.integers(0, 5000, 12)).capitalize() + "." for _ in range(sentences))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "src1", len(t) if t is not None else None) for i, t in texts], SCHEMA)


def test_run_and_registration(spark):
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    total = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0.7 * total < len({r.doc_id for r in rows}) < total
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in held) <= 4096 for held in used.values())


def test_stages_by_steps(spark):
    """Each stage against its predecessor's rows, by plain means."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = STAGES["toxicity"](spark, docs, FOLDER)
    assert clean.columns == COLUMNS
    kept = {r.doc_id: r.text for r in clean.collect()}
    all_texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 1").collect()}
    fine = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 0").collect()}
    assert len(fine & kept.keys()) >= 0.97 * len(fine & all_texts.keys())
    assert len(toxic & kept.keys()) <= 0.2 * len(toxic)
    assert all(all_texts[i] == t for i, t in kept.items())


def test_copies(spark):
    base = [prose(i) for i in range(20)]
    near = [t.replace(t.split()[100], "other", 1) for t in base]
    texts = [(i, t) for i, t in enumerate(base)] + [(100 + i, t) for i, t in enumerate(base)] + [(200 + i, t) for i, t in enumerate(near)]
    texts += [(300, None), (301, ""), (302, "short one"), (303, "another short one"), (5, prose(77)), (5, prose(77)), (None, base[3])]
    group = loop_components(list(range(len(texts))), [loop_fingerprint(t) for _, t in texts])
    kept = STAGES["simhash"](spark, frame(spark, texts), FOLDER)
    assert kept.columns == COLUMNS
    want = [texts[g] for g in sorted(set(group))]
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == sorted(w for w in want if w[1])
    assert len(want) < 20 + 20 + 4 and kept.count() == len(want)


def test_passages(spark):
    shared = prose(999, 6)
    texts = [(i, prose(i) + "\n" + shared + "\n" + prose(1000 + i)) for i in range(10)] + [(50, shared), (51, prose(51)), (52, None)]
    got = {r.doc_id: r for r in STAGES["substrings"](spark, frame(spark, texts), FOLDER).collect()}
    assert set(got) == {*range(10), 51, 52}
    assert got[0].text == texts[0][1] and got[51].text == texts[11][1] and got[52].text is None
    assert all(shared not in got[i].text and prose(i) in got[i].text and prose(1000 + i) in got[i].text for i in range(1, 10))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())


def test_secrets(spark):
    texts = [(1, "x token = abcdefghijklmnop y"), (2, "clean text"), (3, None), (4, "")]
    got = {r.doc_id: r for r in STAGES["secrets"](spark, frame(spark, texts), FOLDER).collect()}
    assert got[1].text == "x [SECRET] y" and got[1].n_chars == 12
    assert got[2].text == "clean text" and got[3].text is None and got[3].n_chars is None and got[4].n_chars == 0


def test_packing(spark):
    library = Tokenizer.from_file(vocabulary(WORD_TOKENIZER))
    texts = [(i, prose(i, 1 + i % 30)) for i in range(60)]
    rows = STAGES["packing"](spark, frame(spark, texts), FOLDER).collect()
    want = sum(len(library.encode(t).ids) + 1 for _, t in texts)
    assert sum(r.length for r in rows) == want
    assert len({r.sequence_id for r in rows}) <= -(-want // 4096) + 1


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, name):
    assert STAGES[name](spark, frame(spark, [(1, "x")]).limit(0), FOLDER).count() == 0


def test_short_passages(spark):
    """Two repeated sentences go however short they are, but for runs of two words."""
    shared = "Send it back soon. We wait here."
    texts = [(i, f"{prose(i, 3)}\n{shared}\n{prose(100 + i, 3)}\nYes. No.") for i in range(5)]
    got = {r.doc_id: r.text for r in STAGES["substrings"](spark, frame(spark, texts), FOLDER).collect()}
    assert shared in got[0]
    assert all(shared not in got[i] and prose(i, 3) in got[i] and got[i].endswith("Yes. No.") for i in range(1, 5))
