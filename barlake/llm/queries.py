"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import textwrap

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import bpe, chat, decontaminate, language, lexical, licenses, line_dedup, neardup, repetition, secrets, spelling, url_filter, word_bpe

TOKENIZER_FILE = "word_bpe_49k.json"
RANK_FILE = "byte_bpe_50k.tiktoken"
TRIAL = "</s>[INST] ok [/INST]"  # text of the conversation that op8 adds


def tokenizer_path() -> str:
    """The public tokenizer file; ``bpe`` takes any path."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def rank_path() -> str:
    """The public rank file; ``word_bpe`` takes any path."""
    import public_tokenizers

    return public_tokenizers.path(RANK_FILE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = repetition.repetition_rules(docs)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "covered_tokens",
        "base_failed", "kept",
    )


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.fit_profiles(docs.where(~held_out()))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "longest_match", "contaminated",
    )


def _span_text(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in secrets.KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_span_text("base"), 256).alias("base_sha256"), _span_text("spans").alias("spans"),
    )


def license_trial() -> str:
    """The document that op6 adds, because the table may hold no entire licence text: MIT in short lines."""
    paragraphs = next(text for name, text in licenses.full_texts() if name == "MIT").split("\n\n")
    return "\n\n".join(["The MIT License (MIT)", "Copyright (c) 2020 Some One", *(textwrap.fill(p, 45) for p in paragraphs)])


def op6_license_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.union(spark.range(1).select(F.lit(-1).cast(docs.schema["doc_id"].dataType), F.lit(license_trial())))
    known = licenses.known_licenses(spark)
    # The key is taken before the join, so that no text is shuffled.
    rows = licenses.license_scan(docs.withColumn("key", F.md5("text")), known).select("doc_id", "key", "digest", "license_id")
    notices = licenses.notice_scan(docs, known).select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "notices")
    out = rows.join(notices, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    return out.select("doc_id", "digest", "license_id", F.coalesce(F.array_join("notices", ","), F.lit("")).alias("notices"))


def op7_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", TRIAL), (-1, 1, "assistant", TRIAL)], "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.format_windows(rows.unionByName(extra))).drop("n_windows")


def op9_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(bpe.decode(bpe.encode(docs, path), path))


def token_digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("tokens", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _number(text: Column, digits: int, modulus: int) -> Column:
    """Number from a text's md5, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("int") % modulus


def op10_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: a fetch time within 2024 follows from the page id."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=(F.col("page_id") * 7919 % 31_536_000).cast("decimal(18,6)"))
    return pages.select("page_id", "url", at.alias("fetched_at"))


def op10_events(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' hosts: half of them are listed, two thirds of these
    unlisted later and a third of those listed again; some parent domains are allowed."""
    hosts = pages.select(url_filter.host(F.col("url")).alias("entry")).where("entry IS NOT NULL").distinct()
    day = lambda n: F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=n)
    start = _number(F.col("entry"), 6, 200)
    first = hosts.where(_number(F.concat("entry", F.lit("/l")), 6, 2) == 0).select(
        "entry", start.alias("d"), _number(F.concat("entry", F.lit("/r")), 6, 3).alias("r")
    )
    block = [
        first.select("entry", F.lit("block").alias("action"), F.lit("add").alias("op"), day(F.col("d")).alias("at")),
        first.where("r > 0").select("entry", F.lit("block"), F.lit("remove"), day(F.col("d") + 60)),
        first.where("r = 2").select("entry", F.lit("block"), F.lit("add"), day(F.col("d") + 90)),
    ]
    parents = hosts.select(F.regexp_replace("entry", r"^[^.]*\.", "").alias("entry")).where("entry LIKE '%.%'").distinct()
    allow = parents.where(_number(F.col("entry"), 6, 2) == 0).select("entry", F.lit("allow"), F.lit("add"), day(_number(F.col("entry"), 6, 100)))
    return block[0].union(block[1]).union(block[2]).union(allow)


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filter.filter_urls(op10_captures(pages), op10_events(pages))
    return out.select("page_id", "blocked", "entry", "action", F.date_format("listed_since", "yyyy-MM-dd").alias("listed_since"))


def op11_word_shuffle_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = word_bpe.encode(docs, rank_path(), public_tokenizers.PATTERN)
    return token_digests(word_bpe.decode(coded, rank_path()))


def op12_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.rank_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_repetition_rules": op1_repetition_rules,
    "op2_language_id": op2_language_id,
    "op3_weighted_minhash": op3_weighted_minhash,
    "op4_suffix_decontamination": op4_suffix_decontamination,
    "op5_secret_scan": op5_secret_scan,
    "op6_license_lookup": op6_license_lookup,
    "op7_line_windows": op7_line_windows,
    "op8_chat_windows": op8_chat_windows,
    "op9_bpe_tokens": op9_bpe_tokens,
    "op10_url_lists": op10_url_lists,
    "op11_word_shuffle_bpe": op11_word_shuffle_bpe,
    "op12_fp_tree_search": op12_fp_tree_search,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": pipeline,
}
