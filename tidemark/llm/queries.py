"""The registered queries of this subpackage: ``QUERIES`` and ``ORACLES``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (embeddings, extraction, language, line_dedup, merkle, mixing, negatives, packing, quality_model,
                          quality_rules, secret_scan, simhash, url_rules)
from tidemark.llm.common import settle, table, word_count
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.session import scratch_dir


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


def word_bpe() -> str:
    """Path of the tokenizer file, the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), word_bpe())
    digest = packed.pieces.select("key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digest.join(packed.places, "key").drop("key")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring_lines(docs)


def crc_mod(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    ratio = quality_rules.weights(quality_rules.train(docs, labels.where("quality = 1").select("doc_id")))
    measured = settle(quality_rules.measure_rules(docs, ratio).drop("text"))
    return quality_rules.apply_rules(measured, quality_rules.threshold(measured, labels))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(5) == 0
    model = quality_model.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return quality_model.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    size = word_count(F.col("text"))
    return mixing.mix_copies(docs).select("doc_id", size.alias("size"), "source_size", "target",
                                          (size * F.col("copies")).alias("taken"))


#: Host and path rules of the url filter.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # the number in a url's path names the document that the page shows
    number = F.try_to_number(F.regexp_extract(url_rules.path_of(F.col("url")), "/([0-9]{1,18})", 1), F.lit("9" * 18))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id"), bad.alias("verdict"))
    labelled = pages.withColumn("doc_id", number.cast("long")).join(labels, "doc_id")
    return url_rules.judge(pages, URL_RULES, url_rules.mine(labelled)).select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(4) == 2
    profiles = language.train(docs.where(~held_out))
    return language.predict(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = extraction.main_text(pages, extraction.fit(pages))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a ledger of its own for each run: what is returned does not depend on earlier ones
    ledger = secret_scan.Ledger(spark, scratch_dir(spark, "ledger"))
    out = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ledger)
    kinds = [r.kind for r in secret_scan.BASE]

    def of(*wanted: str):
        return F.filter("findings", lambda s: s["kind"].isin(*wanted))

    return out.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
                      F.sha2(secret_scan.digest(of(*kinds)), 256).alias("base_sha256"),
                      secret_scan.digest(F.col("findings")).alias("spans"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    # the largest long has a successor too
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = [more if c == "n_chars" else F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.when(crc_mod(7) == 0, merkle.digest(tampered))
    proofs = merkle.manifest(docs, "doc_id", "lang", fields, changed).proofs()
    return proofs.withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_model": op5_quality_model,
    "op6_mixing": op6_mixing,
    "op7_url_rules": op7_url_rules,
    "op8_language_id": op8_language_id,
    "op9_simhash": op9_simhash,
    "op10_extraction": op10_extraction,
    "op11_negatives": op11_negatives,
    "op12_secrets": op12_secrets,
    "op13_merkle": op13_merkle,
}
