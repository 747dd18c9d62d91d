"""Writers for runs, post documents, endpoint lists and ledgers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.posts import POST_FIELDS

_KEEP_NULLS = {"ignoreNullFields": "false"}


ROWS_PER_DOCUMENT = 1000


def _joined(texts: DataFrame, opening: str, closing: str, rows: int) -> DataFrame:
    """Join up to ``rows`` JSON texts at a time into one document per line; nothing is shuffled for it."""

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [batch["value"].iloc[i : i + rows] for i in range(0, len(batch), rows)]
            yield pd.DataFrame({"value": [opening + ",".join(part) + closing for part in parts]}, dtype=object)

    return texts.mapInPandas(joined, "value string")


def brackets(metadata_json: str | None, summary_json: str | None) -> tuple[str, str]:
    """What goes around the posts: summary first, then metadata; a bare list without either."""
    parts = (("enrichment_summary", summary_json), ("metadata", metadata_json))
    head = "".join(f'"{name}":{text},' for name, text in parts if text)
    return ("{" + head + '"posts":[', "]}") if head else ("[", "]")


def write_run(posts: DataFrame, manifest: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Posts and manifest of a run under ``posts/run_id=…`` and ``runs/run_id=…``; a rerun replaces both.

    A run without posts leaves a file with the columns.
    """
    for name, frame in (("posts", posts), ("runs", manifest)):
        writer = frame.write.mode("overwrite")
        if fmt == "json":
            writer = writer.options(**_KEEP_NULLS)
        writer.format(fmt).save(f"{path}/{name}/run_id={run_id}")


def write_documents(
    posts: DataFrame,
    path: str,
    metadata_json: str | None = None,
    summary_json: str | None = None,
    rows: int = ROWS_PER_DOCUMENT,
) -> None:
    """Posts as JSON documents, one per line: ``{summary, metadata, posts}``, or a bare list without either."""
    texts = posts.select(post_json(posts.columns).alias("value"))
    _joined(texts, *brackets(metadata_json, summary_json), rows).write.mode("overwrite").text(path)


def post_json(fields: Sequence[str]) -> Column:
    return F.to_json(F.struct(*fields), _KEEP_NULLS)


def enriched_json(enriched: DataFrame) -> Column:
    """The post fields as JSON, with ``body`` and ``comments`` where there are details."""
    base = F.to_json(F.struct(*POST_FIELDS), _KEEP_NULLS)
    body = F.to_json(F.struct("body"), _KEEP_NULLS)
    inside = lambda text: F.substring(text, F.lit(2), F.length(text) - 2)
    comments = F.coalesce("comments_json", F.lit("[]")) if "comments_json" in enriched.columns else F.lit("[]")
    details = F.concat(F.lit(","), inside(body), F.lit(',"comments":'), comments)
    tail = F.when(F.coalesce("has_details", F.lit(False)), details).otherwise("")
    return F.concat(F.lit("{"), inside(base), tail, F.lit("}"))


def write_enriched(
    enriched: DataFrame,
    path: str,
    metadata_json: str | None = None,
    summary_json: str | None = None,
    rows: int = ROWS_PER_DOCUMENT,
) -> None:
    """Enriched posts as documents in a new path; ``body`` and ``comments`` only where there are details.

    ``comments_json`` (nested text) is written as the ``comments`` array.
    """
    texts = enriched.select(enriched_json(enriched).alias("value"))
    _joined(texts, *brackets(metadata_json, summary_json), rows).write.mode("overwrite").text(path)


def write_endpoints(endpoints: DataFrame, path: str) -> None:
    """Endpoint list, one per line; part files follow each other in list order."""
    ordered = endpoints.orderBy("pos").select(F.col("endpoint").alias("value"))
    ordered.write.mode("overwrite").text(path)


def write_ledger(ledger: DataFrame, path: str, rows: int = ROWS_PER_DOCUMENT) -> None:
    """Ledger as JSON maps keyed by endpoint, one per line, times in whole seconds."""
    seconds = F.unix_seconds("last_ok") if dict(ledger.dtypes)["last_ok"].startswith("timestamp") else F.col("last_ok")
    state = F.to_json(F.struct(seconds.alias("last_ok"), "ok_streak", "fail_streak"), _KEEP_NULLS)
    key = F.to_json(F.struct(F.col("endpoint").alias("k")))
    quoted = F.substring(key, F.lit(6), F.length(key) - 6)
    texts = ledger.select(F.concat(quoted, F.lit(":"), state).alias("value"))
    _joined(texts, "{", "}", rows).write.mode("overwrite").text(path)
