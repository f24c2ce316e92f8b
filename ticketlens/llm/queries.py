"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import (
    bpe_codec,
    chat_windows,
    conversation_repair,
    divergence_rules,
    exact_dedup,
    fill_middle,
    katz_lm,
    language_id,
    near_dedup,
    packing,
    rans_output,
    secret_links,
    substring_dedup,
)
from ticketlens.llm.oracles import oracle_sql  # noqa: F401
from ticketlens.llm.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; the files belong to the installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_rans_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "rans").path("corpus")
    rans_output.write_ids(
        _table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=2
    )
    return rans_output.read_ids(spark, path).drop("ids")


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    windows = Scratch(spark, "chat").write(
        chat_windows.format_windows(turns.unionByName(extra)), "windows"
    )
    read = chat_windows.read_windows(windows)
    spoken = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"), 5)
    found = language_id.predict(docs, language_id.fit(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op5_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return katz_lm.score(docs, language_id.held_out(F.col("doc_id"), 10))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_exact(_table(spark, sf_dir, "documents"))


def op7_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules.judge(_table(spark, sf_dir, "documents"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    coded = bpe_codec.encode_decode(docs, vocabulary("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(_table(spark, sf_dir, "documents"), width=2).drop("text_key")


def op10_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_links.find_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_links.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def digest(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secret_links.BASE],
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(_table(spark, sf_dir, "documents"))
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    report, edits = conversation_repair.repair(conversation_repair.damage(turns))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = turns.select("conv_id").unionByName(report, allowMissingColumns=True)
    parts = parts.unionByName(conversation_repair.digest(edits), allowMissingColumns=True)
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def queries() -> dict[str, Query]:
    found = (
        op1_rans_output,
        op2_chat_windows,
        op3_packing,
        op4_language_id,
        op5_katz_lm,
        op6_exact_dedup,
        op7_divergence_rules,
        op8_bpe_codec,
        op9_near_dedup,
        op10_secret_links,
        op11_substring_dedup,
        op12_fill_middle,
        op13_conversation_repair,
    )
    return {query.__name__: query for query in found}
