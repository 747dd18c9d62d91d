"""Documents cut into many splits against the reader of whole files, and written documents against the JSON parser."""

import json
import random
import re
from pathlib import Path

import pytest
from test_sources import post

from postlake import sources
from postlake.session import shared_folder
from postlake.sources.large_documents import _pieces, _post_texts, _with_state, read_large_posts, write_large_document


@pytest.fixture
def splits(spark):
    """Reads files in splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def of(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")

    yield of
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def awkward(rng, i):
    bits = ["}", "{", "[", "]", '"', "\\", "\\\\", "\n", '"posts": [{', '}, {"id": "x"}', "é", "😀", "\\\"}", ",", ":", "text " * rng.randint(0, 9)]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    more = {}
    if rng.random() < 0.5:
        more = {"body": text(), "comments": [{"author": text(), "replies": [{"body": text(), "replies": []}]} for _ in range(rng.randint(0, 3))]}
    return post(i) | {"title": text(), "author": rng.choice([None, text()]), "description": text()} | more


def rows_of(frame):
    fields = [c for c in frame.columns if c != "comments"]
    texts = frame.selectExpr(*fields, "to_json(comments) AS comments").collect()
    return sorted((tuple(r) for r in texts), key=repr)


SHAPES = [
    lambda posts: posts,
    lambda posts: {"metadata": {"n": 1}, "posts": posts},
    lambda posts: {"posts": posts},
    lambda posts: {
        "enrichment_summary": {"ids": ["}", "a"], "deep": {"posts": [{"id": "no post"}]}},
        "metadata": {"queries": [{"q": "x"}, {"q": '"posts": [{'}], "posts": [{"id": "no post"}, {"a": {}}]},
        "posts": posts,
        "after": [{"id": "no post"}, {"posts": [{"id": "no post"}]}], "tail": "}]",
    },
    lambda posts: {"queries": [{"q": "x"}, {"q": "y"}], "posts": posts, "posts_": [{"id": "no post"}]},
    lambda posts: {"metadata": None, "list": ["posts", ["posts"]], "posts": posts},
]


@pytest.mark.parametrize(
    ("shape", "size", "indent"),
    [(0, 199, None), (1, 1 << 20, 4), (2, 211, 2), (3, 97, None), (3, 1 << 20, 2), (4, 307, None), (5, 307, 2)],
)
def test_same_as_whole_files(spark, splits, tmp_path, shape, size, indent):
    rng = random.Random(shape * 100 + size)
    folder = tmp_path / "docs"
    folder.mkdir()
    for name, count in (("a", 12), ("b", 0), ("c", 1)):
        document = SHAPES[shape]([awkward(rng, i) for i in range(count)])
        tail = rng.choice(["", "\n", " \n\n"])
        (folder / f"{name}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=rng.random() < 0.5) + tail)
    want = rows_of(sources.read_posts(spark, str(folder)))
    assert len(want) == 13
    splits(size)
    if size < 1000:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
    assert rows_of(read_large_posts(spark, str(folder))) == want


def test_broken_documents(spark, tmp_path):
    for i, text in enumerate(['[{"id": "a"}', '{"posts": [{"id": "a"}]', '[{"id": "a"}]]', '[{"id": "a" "b"}]']):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="not a whole JSON document|MALFORMED|FAILFAST"):
            read_large_posts(spark, str(path)).collect()


@pytest.mark.parametrize("count", [0, 1, 57])
def test_one_document_from_many_files(spark, splits, tmp_path, many_partitions, count):
    from test_sources import sources_schema

    rng = random.Random(count)
    rows = [{k: v for k, v in awkward(rng, i).items() if k not in ("body", "comments")} for i in range(count)]
    posts = spark.createDataFrame(rows, sources_schema()).repartition(5)
    out = str(tmp_path / "out")
    write_large_document(posts, out, ["score"], metadata_json='{"source": "x"}', summary_json='{"total": %d}' % count)
    parts = sorted(Path(out).glob("part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert list(document) == ["enrichment_summary", "metadata", "posts"] and document["enrichment_summary"] == {"total": count}
    assert document["posts"] == sorted(rows, key=lambda r: r["score"])
    assert len(parts) > 4 or count < 57
    splits(1000)
    back = read_large_posts(spark, out, whole=True)
    assert sorted(r["score"] for r in back.collect()) == list(range(count))
    assert {r["title"] for r in back.collect()} == {r["title"] for r in rows}
    write_large_document(posts, out, ["score"])
    assert json.loads("".join(p.read_text() for p in sorted(Path(out).glob("part-*")))) == document["posts"]


def test_no_task_gets_a_whole_document(spark, tmp_path, capsys):
    """Text is shuffled to its split or its post, never by file or document only, which may be the whole input."""
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps([post(i)]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [_with_state(_pieces(spark, str(tmp_path), False)), _post_texts(spark, str(tmp_path), False)]
        capsys.readouterr()
        for frame in frames:
            frame.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = re.findall(r"Exchange *\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((.*?), \d+\)", capsys.readouterr().out)
    keys = [re.findall(r"(\w+)#", by) for columns, by in found if re.search(r"\b(text|_pieces)#|collect_list", columns) or "buf#" in columns]
    assert ["doc", "file", "block"] in keys
    assert all(by not in (["doc"], ["file"]) for by in keys)


def test_documents_of_many_chunks_in_a_split(spark, tmp_path):
    """Lists that look like posts lie before and behind the posts, in the same chunk and in later ones."""
    rng = random.Random(5)
    posts = [awkward(rng, i) | {"title": rng.choice('ab"}]\\') * rng.randint(0, 30_000)} for i in range(150)]
    other = [{"id": "no post", "posts": [{"id": "no post", "title": "}]" * 20_000}]} for _ in range(40)]
    documents = {
        "long": {"metadata": {"a": other}, "posts": posts, "after": other}, "short": {"posts": posts[:3], "after": other},
        "bare": posts, "none": {"metadata": {"a": other}, "posts": [], "after": other},
    }
    for name, document in documents.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document))
    assert _pieces(spark, str(tmp_path), False).filter("file LIKE '%long.json'").count() > 3
    want = rows_of(sources.read_posts(spark, str(tmp_path)))
    assert len(want) == 303
    assert rows_of(read_large_posts(spark, str(tmp_path))) == want


def test_texts_are_kept_once(spark, tmp_path):
    """Behind a round trip the disk holds the document and its posts; only what chunks cut off is left to be shuffled."""
    from test_sources import sources_schema

    kept = Path(shared_folder(spark, "x")).parent
    before = set(kept.iterdir()) if kept.exists() else set()
    rows = [post(i) | {"title": "title " * 1000} for i in range(500)]
    out = str(tmp_path / "out")
    write_large_document(spark.createDataFrame(rows, sources_schema()), out, ["score"])
    texts = _post_texts(spark, out, True)
    assert texts.count() == 500
    folders = [f for f in kept.iterdir() if f not in before]
    with_text = [f.name for f in folders if {"text", "_json"} & set(spark.read.parquet(str(f)).columns)]
    assert [name.rsplit("-", 1)[0] for name in with_text] == ["document-parts"]
    parts = spark.read.parquet(str(next(f for f in folders if f.name in with_text)))
    assert parts.filter("lone").count() > 450
