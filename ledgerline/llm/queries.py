"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, html_extract, oracles, quality, spelling, toxicity
from ledgerline.llm.divergence import divergences
from ledgerline.llm.fingerprint import edited_fingerprints
from ledgerline.llm.jaccard_join import similar_classes
from ledgerline.llm.mixing import mix
from ledgerline.llm.ship import ship
from ledgerline.llm.simhash import near_classes
from ledgerline.llm.suffix_dedup import remove_repeats
from ledgerline.llm.topk_search import top_k
from ledgerline.llm.unit_dedup import remove_repeated_units


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of each document once lines that an earlier place of the corpus has, and passages of sentences, are removed."""
    out = remove_repeated_units(read(spark, sf_dir, "documents"), unit="line+sentence")
    return out.select("doc_id", "n_bytes", "n_units", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the rows that are not held out."""
    return toxicity.fit(docs.filter(~held_out("doc_id")), labels)


def held_out(column: str) -> Column:
    """The third of ids that labels are not learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a third of the ids is held out from learning."""
    docs = read(spark, sf_dir, "documents")
    model = toxic_model(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, and its length in code points."""
    pages = read(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20, by integer inner product."""
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of each document once 50-byte windows of earlier documents are removed."""
    out = remove_repeats(read(spark, sf_dir, "documents"), depth=50)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150% of all words, weighted 3, 1, 2 by source, takes of each document."""
    return mix(read(spark, sf_dir, "documents"), [3, 1, 2]).select("doc_id", "size", "source_size", "target", "taken")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled fingerprints of each document and its edited version, and their likeness."""
    return edited_fingerprints(read(spark, sf_dir, "documents"), with_text=False)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from heuristic labellers alone."""
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs)).select(
        "doc_id", "posterior", "score", (F.col("score") >= 0.5).cast("int").alias("keep"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each document, and of the bytes they decode to."""
    import public_tokenizers as vocabularies
    out = bpe.encode(read(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_multi_50k.tiktoken"),
                     vocabularies.PATTERN, decoded=True)
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents with 5-word shingle Jaccard of 0.8 or more."""
    return similar_classes(read(spark, sf_dir, "documents"))


def with_typos(docs: DataFrame, min_chars: int) -> DataFrame:
    """(word) of every lower-cased run of the texts; a run in 31, by a hash of it and its document, lacks a code point."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                      F.explode(spelling.runs(F.col("text"), min_chars)).alias("run")).withColumn("run", spelling.lowered(F.col("run")))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    hashed = run.select("run", h.alias("h")).withColumn("k", (F.col("h") % F.char_length("run")).cast("int"))
    return hashed.select(F.when(F.col("h") % 31 == 0, F.concat(F.expr("substring(run, 1, k)"), F.expr("substring(run, k + 2)")))
                         .otherwise(F.col("run")).alias("word"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 7 or more letters with their near words, their far more frequent form and the end of its chain."""
    words = with_typos(read(spark, sf_dir, "documents"), min_chars=7)
    return spelling.variant_groups(spelling.vocabulary(words, min_chars=7, min_count=2), ratio=10)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the term use of each source lies from the other sources of its language, and by which terms from all of it."""
    return divergences(read(spark, sf_dir, "documents"), min_docs=3, top=200)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 3-word shingles, and the classes of those at most two bits apart."""
    return near_classes(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_near")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_html_extract": op3_html_extract,
    "op4_topk_search": op4_topk_search,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_fingerprints": op7_fingerprints,
    "op8_quality": op8_quality,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_source_divergence": op12_source_divergence,
    "op13_simhash": op13_simhash,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": oracles.UNIT_DEDUP,
    "op4_topk_search": oracles.TOP_K,
    "op5_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op6_mix_sources": oracles.MIX,
    "op10_ngram_jaccard": oracles.JACCARD,
    "op11_spelling_variants": oracles.SPELLING,
    "op12_source_divergence": oracles.DIVERGENCE,
}
