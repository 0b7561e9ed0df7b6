"""A training-corpus pipeline over ``documents``: clean, deduplicate, mix, tokenise.

Five stages, each by one operator of ``ledgerline.llm``. A stage gets all rows that the one before it
kept, and all but the last return the columns of ``documents``:

1. toxicity: documents with a toxicity score of 0.7 or more go; labels come from the ``labels`` table.
2. n-gram Jaccard join: of documents linked by 5-word shingles at 0.8 or more, the smallest (id, text digest) stays.
3. suffix-array dedup: bytes of 50-byte windows of earlier documents are cut out of the texts.
4. mixing: sources are mixed to 150 % of all words by the weights 3, 1, 2; whole epochs repeat a
   document, and the document at a source's cut keeps the words that are left of the budget.
5. byte-level BPE: token ids of each text, and the digest of the bytes they decode to.

Rows: null and empty texts score as any other text (by the bias), are similar to nothing, lose nothing, hold
no words, so the mix doesn't take them, and would have no tokens. Of repeated rows one stays at stage 2; rows
without an id are in no class and stay, match nothing at stage 3, and share what their places take at stage 4.
Null languages, sources and lengths pass through; a null source is a source. Extra columns end at stage 3. An
empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, toxicity
from ledgerline.llm.jaccard_join import similar_classes, text_digest
from ledgerline.llm.mixing import WORD, mix
from ledgerline.llm.queries import read
from ledgerline.llm.scratch import Scratch
from ledgerline.llm.ship import ship
from ledgerline.llm.suffix_dedup import remove_repeats

TOXIC = 0.7
WEIGHTS = [3, 1, 2]
DIGEST = "_text_digest"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, with their columns."""
    ship(spark)
    return toxicity.keep_clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), TOXIC)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones, the smallest by (id, digest of its text).

    Documents without an id are in no class and stay; dissimilar texts under one id are documents of their own.
    """
    ship(spark)
    classes = similar_classes(docs, keyed=True).filter(F.col("doc_id") == F.col("component_id"))
    # texts without shingles are classes of their own
    blank = F.when(F.col("class").isNull(), F.col("digest"))
    stay = classes.groupBy("doc_id", "class", blank.alias("blank")).agg(F.min("digest").alias(DIGEST)).select("doc_id", DIGEST)
    named = docs.withColumn(DIGEST, text_digest("text")).join(stay, ["doc_id", DIGEST], "left_semi").dropDuplicates(
        ["doc_id", DIGEST]).select(*docs.columns)
    return named.unionByName(docs.filter(F.col("doc_id").isNull()))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of earlier documents; bytes left over from a cut character go too."""
    ship(spark)
    kept = remove_repeats(docs, depth=50, carry=["lang", "source"])
    return kept.withColumn("text", F.col("kept_text")).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last one of a source may be cut to its first words."""
    ship(spark)
    taken = mix(docs, WEIGHTS).filter("taken > 0").groupBy("doc_id", "digest", "size").agg(
        F.floor(F.sum("taken") / F.count(F.lit(1))).alias("taken"))           # equal rows share what they take
    named = docs.withColumn("digest", F.md5("text"))
    both = named.alias("d").join(taken.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (
        F.col("d.digest") == F.col("t.digest"))).select("d.*", "t.size", "t.taken")
    whole = F.floor(F.col("taken") / F.col("size"))
    rest = F.col("taken") - whole * F.col("size")
    words = F.array_repeat(F.col("size"), whole.cast("int"))
    copies = F.when(rest > 0, F.concat(words, F.array(rest))).otherwise(words)
    out = both.withColumn("words", F.explode(copies))
    head = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(F.array_join(
        F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), 1, F.greatest(F.col("words"), F.lit(1)).cast("int")), " "))
    return out.withColumn("text", head).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of each row, and the digest of what they decode to."""
    import public_tokenizers as vocabularies
    ship(spark)
    out = bpe.encode(docs, vocabularies.path(VOCABULARY), vocabularies.PATTERN, decoded=True)
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_similar), ("suffix_dedup", cut_repeats),
          ("mixing", mix_sources), ("byte_bpe", tokenise)]

# fitting a model, joining by similarity and cutting windows are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
