"""The operators of this subpackage as queries over the given tables, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import secret_scan
from postlake.llm.common import table
from postlake.llm.embedding_links import embedding_links
from postlake.llm.manifest import build_manifest, digest_of, fold
from postlake.llm.middle_fill import fill_in_middle, restored
from postlake.llm.oracle import ORACLE  # noqa: F401
from postlake.llm.packing import pack
from postlake.llm.phrase_index import build_index, contamination, phrases_of
from postlake.llm.piece_codec import decode_pieces, encode_pieces
from postlake.llm.sharding import sharded
from postlake.llm.simhash import hexadecimal, near_duplicates
from postlake.llm.spans import without_repeated_spans
from postlake.llm.token_files import read_tokens, write_tokens
from postlake.llm.tokens import ids_crc32, vocabulary
from postlake.llm.top_scores import top_scores
from postlake.llm.toxicity import toxicity, train_severity
from postlake.session import shared_folder

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Encode with dropout, decode from the ids, and compare."""
    docs = table(spark, folder, "documents")
    model = vocabulary(PIECE_MODEL)
    coded = encode_pieces(docs, model)
    back = coded.select("doc_id", F.size("ids").alias("n_ids"), ids_crc32(F.col("ids")).alias("ids_crc32"),
                        F.crc32(decode_pieces(F.col("ids"), model).cast("binary")).alias("text_crc32"))
    return back


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity(docs, train_severity(docs, table(spark, folder, "labels")))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    write_tokens(table(spark, folder, "documents"), path, vocabulary(WORD_TOKENIZER))
    read = read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", ids_crc32(F.col("ids")).alias("ids_crc32"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("row.text", F.lit(""))
    return sharded(table(spark, folder, "documents")).select(
        "row.doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary(WORD_TOKENIZER), with_ids=False)


def op7_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links(table(spark, folder, "embeddings"))


def op8_repeated_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeated_spans(table(spark, folder, "documents"))
    return found.select("row.doc_id", "clean.text", "clean.n_sentences", "clean.n_removed")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    rules = secret_scan.RULES
    base = F.filter("spans", lambda s: s["place"] < len(secret_scan.BASE_RULES))
    found = secret_scan.find_secrets(table(spark, folder, "documents"), rules)
    return found.select(
        "row.doc_id",
        *[secret_scan.count_of(F.col("spans"), i).alias(f"n_{r.kind}") for i, r in enumerate(secret_scan.BASE_RULES)],
        F.sha2(secret_scan.span_text(base, rules), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans"), rules).alias("spans"),
    )


def op10_top_scores(spark: SparkSession, folder: str) -> DataFrame:
    return top_scores(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A tree per language over all rows; some rows are replaced by ones with another ``n_chars``.

    Rows without an id come first and are not replaced; rows that share an id are ordered by their digests.
    """
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda n_chars: F.unhex(digest_of([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = leaf(F.col("n_chars").cast("decimal(20,0)") + 1)
    leaves = docs.select(
        "doc_id",
        F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), "lang")).alias("tree"),
        leaf(F.col("n_chars")).alias("digest"),
        F.when(chosen & F.col("n_chars").isNotNull(), tampered).alias("tampered"),
    )
    folded = fold(build_manifest(leaves, ["doc_id"]), "tampered")
    return folded.select(
        "doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_middle_fill(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    back = restored(F.col("fim.output"), F.col("fim.form"))
    return made.select(
        "row.doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def op13_contamination(spark: SparkSession, folder: str) -> DataFrame:
    index = build_index(table(spark, folder, "documents"))
    return contamination(index, phrases_of(table(spark, folder, "benchmark")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_simhash, op3_toxicity, op4_token_files, op5_sharding, op6_packing,
        op7_embedding_links, op8_repeated_spans, op9_secrets, op10_top_scores,
        op11_manifest, op12_middle_fill, op13_contamination,
    )
}
