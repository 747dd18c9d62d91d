"""Worklist, join and summary on small tables."""

from postlake.operators import enrichment

POSTS = "id string, permalink string, body string, n_comments bigint, has_details boolean"


def known(spark):
    return spark.createDataFrame(
        [("/a/", "text a", 2), ("/b/", "", 0), ("/c/", "", 3), ("", "never", 1)],
        "permalink string, body string, n_comments bigint",
    )


def posts(spark):
    return spark.createDataFrame(
        [
            ("1", "/a/", None, None, False),
            ("2", "/a/", None, None, False),
            ("3", "/b/", None, None, False),
            ("4", "/c/", None, None, None),
            ("5", "/x/", None, None, False),
            ("6", "", None, None, False),
            (None, None, None, None, False),
            ("8", "/a/", "old text", 9, True),
        ],
        POSTS,
    )


def test_enrich(spark):
    rows = enrichment.enrich_posts(posts(spark), known(spark)).collect()
    got = {r["id"]: (r["body"], r["n_comments"], r["has_details"]) for r in rows}
    assert len(rows) == 8
    assert got["1"] == got["2"] == ("text a", 2, True)
    assert got["3"] == ("", 0, True)
    assert got["5"] == got["6"] == got[None] == (None, None, False)
    assert got["8"] == ("old text", 9, True)


def test_summary_and_failures(spark):
    enriched = enrichment.enrich_posts(posts(spark), known(spark))
    summary = enrichment.enrichment_summary(enriched).first()
    assert tuple(summary) == (8, 4, 4)
    assert {r["id"] for r in enrichment.failed_posts(enriched).collect()} == {"3", "5", "6", "unknown"}


def test_worklist(spark):
    left = enrichment.detail_worklist(posts(spark), known(spark), host="https://h").collect()
    assert [(r["id"], r["detail_url"]) for r in left] == [("5", "https://h/x/.json")]


def test_latest_capture_wins(spark):
    text = lambda body: '[{"data":{"children":[{"data":{"title":"t","selftext":"%s"}}]}},{"data":{"children":[]}}]' % body
    captured = spark.createDataFrame(
        [("/a/", text("old"), 1), ("/a/", text("new"), 2), ("/a/", '{"error": 1}', 3), ("/b/", text("only"), 1),
         ("/c/", "broken", 1), ("", text("x"), 1)],
        "permalink string, payload string, fetched_at int",
    )
    found = enrichment.latest_details(captured)
    assert {(r["permalink"], r["body"]) for r in found.collect()} == {("/a/", "new"), ("/b/", "only")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan[: plan.index("Exchange")]


def test_posts_without_permalink_get_spread_join_keys(spark):
    many = spark.range(0, 1000, 1, 8).selectExpr("cast(id as string) AS id", "'' AS permalink")
    enriched = enrichment.enrich_posts(many, known(spark))
    assert enriched.filter("NOT has_details").count() == 1000
