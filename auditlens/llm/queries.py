"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.llm import bpe, conversations, decontaminate, fingerprints, lexical, near_dup, packing, ppm, quality, substring_dedup, token_files, url_rules, warc
from auditlens.llm.shared import crc_of_id


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_bpe_multi() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, sf_dir, "documents"), byte_bpe())
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("n_tiles", F.size("tiles")).drop("tiles")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of_id("doc_id") % 4 == 2
    weights = quality.fit(docs, labels.where(~held_out))
    return quality.score(docs.select("doc_id", "text"), weights).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_token_files(table(spark, sf_dir, "documents"), byte_bpe())
    return token_files.read_token_files(spark, folder, with_ids=False)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of_id("doc_id") % 7 == 2
    return ppm.score(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: The rules that op7_url_rules applies (fixed values).
RULES = (
    url_rules.Rule("allow", "org", "/"),
    url_rules.Rule("block", "example.org", "/es/"),
    url_rules.Rule("block", "example.org", "/en/1"),
    url_rules.Rule("allow", "com", "/fr/"),
    url_rules.Rule("block", "com", "/de/"),
)


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(spark, warc.archive(table(spark, sf_dir, "pages")))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.report(conversations.repair(rows))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = byte_bpe_multi()
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.decode(encoded, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                            F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_token_files": op4_token_files,
    "op5_fingerprints": op5_fingerprints,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_url_rules": op7_url_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_lm_scores": op9_lm_scores,
    "op10_warc": op10_warc,
    "op11_conversations": op11_conversations,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_lexical_search": op13_lexical_search,
}
ORACLE_SQL: dict[str, str] = {
    "op7_url_rules": url_rules.oracle(RULES),
    "op10_warc": warc.ORACLE_SQL,
}
