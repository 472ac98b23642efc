"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from twinline.llm import cover_tree, infill, mixing, odd_sketch, ordinal, packing, secrets, sharding, superkmers, text_density, topk, url_trees, whitening
from twinline.llm.oracles import ORACLES  # noqa: F401
from twinline.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_vector_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = sharding.pack_shards(load(spark, sf, "documents"), 40)
    return packed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def labelled_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses that are known: label 1 where a rule blocks, or the document that the path's last number names is labelled bad."""
    url = F.col("url")
    pages = load(spark, sf, "pages").select(url, F.regexp_extract(url_trees.path(url), r"(\d{1,18})\D*$", 1).alias("number"))
    named = pages.withColumn("doc_id", F.when(F.col("number") != "", F.col("number").cast("bigint")))
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = load(spark, sf, "labels").select("doc_id", bad.cast("int").alias("bad"))
    verdict = url_trees.rule(url_trees.host(url), url_trees.path(url), URL_RULES)["verdict"]
    both = named.join(labels, "doc_id", "left").withColumn("verdict", verdict)
    return both.select("url", F.coalesce((F.col("verdict") == "block").cast("int"), "bad").alias("label"))


def op2_boosted_urls(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_trees.judge(load(spark, sf, "pages").select("page_id", "url"), URL_RULES, labelled_urls(spark, sf))
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad")


def op3_norm_sorted_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.exact_topk(load(spark, sf, "embeddings"), "vec_id % 20 = 0", k=20, scale=64)


def op4_text_density(spark: SparkSession, sf: str) -> DataFrame:
    return text_density.extract(load(spark, sf, "pages"))


def grades(spark: SparkSession, sf: str) -> DataFrame:
    """Graded ratings: 0 toxic, 1 of low quality, 2 neither."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return load(spark, sf, "labels").select("doc_id", grade.alias("grade"))


def op5_ordinal_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    return ordinal.rate(docs, ordinal.fit(docs, grades(spark, sf)))


def op6_ownership_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(load(spark, sf, "documents")))


def op7_cover_tree(spark: SparkSession, sf: str) -> DataFrame:
    return cover_tree.link_counts(load(spark, sf, "embeddings"), cosine=0.9)


def op8_odd_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return odd_sketch.near_duplicates(load(spark, sf, "documents"), width=3, percent=85)


def op9_retrieval_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(load(spark, sf, "documents"), tokenizer_path())


def op10_entropy_balancing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(load(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op11_superkmer_repeats(spark: SparkSession, sf: str) -> DataFrame:
    kept = superkmers.remove_repeats(load(spark, sf, "documents"), width=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_qd_whitening(spark: SparkSession, sf: str) -> DataFrame:
    rows = whitening.per_component(whitening.whiten(load(spark, sf, "embeddings"), components=16, scale=64, offset=1_000_000))
    # null where a long can't hold the exact sum
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_skip_list_infill(spark: SparkSession, sf: str) -> DataFrame:
    done = infill.infill(load(spark, sf, "documents"), seed=1, plain_percent=10, spm_percent=20)
    digests = {
        "output_sha256": F.sha2("output", 256),
        "restored_sha256": F.sha2(infill.restored(F.col("output"), F.col("form")), 256),
    }
    return done.withColumns(digests).drop("text", "output")


QUERIES: dict[str, Query] = {
    "op1_vector_packing": op1_vector_packing,
    "op2_boosted_urls": op2_boosted_urls,
    "op3_norm_sorted_topk": op3_norm_sorted_topk,
    "op4_text_density": op4_text_density,
    "op5_ordinal_quality": op5_ordinal_quality,
    "op6_ownership_secrets": op6_ownership_secrets,
    "op7_cover_tree": op7_cover_tree,
    "op8_odd_sketch": op8_odd_sketch,
    "op9_retrieval_packing": op9_retrieval_packing,
    "op10_entropy_balancing": op10_entropy_balancing,
    "op11_superkmer_repeats": op11_superkmer_repeats,
    "op12_qd_whitening": op12_qd_whitening,
    "op13_skip_list_infill": op13_skip_list_infill,
}
