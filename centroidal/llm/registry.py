"""Queries of the subpackage, one per operator, and their DuckDB statements where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.llm.chat import perspectives
from centroidal.llm.decontaminate import find_leaks, n_hit
from centroidal.llm.embeddings import near_duplicates
from centroidal.llm.frames import crc_mod, table
from centroidal.llm.jaccard import jaccard_components
from centroidal.llm.language import fit_languages, identify_languages, training_rows
from centroidal.llm.licences import scan_licences
from centroidal.llm.packing import pack_documents
from centroidal.llm.pages import extract_pages, fit_page_weights
from centroidal.llm.pii import pii_spans
from centroidal.llm.quality import fit_quality, score_quality
from centroidal.llm.sentencepieces import encode_texts
from centroidal.llm.statements import OP1_SQL, OP2_SQL, OP6_SQL, OP12_SQL
from centroidal.llm.trie import prefix_trie, turn_sequences, with_borrowed_heads
from centroidal.llm.whitening import whiten

#: The tokenizer model; its place is a parameter of the operator.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Tokenizer file and end id of packed sequences.
PACK_TOKENIZER, PACK_END = "/opt/tokenizers/word_bpe_49k.json", 2


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every participant's rendering of every conversation with its mask. The mask's spans are given as
    text ``start-end`` joined by commas. A part too large for a row is several rows, its pieces, numbered
    from 0."""
    out = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select("conv_id", "perspective", "part", "piece", "n_turns", "rendered", spans.alias("mask_spans"), "n_masked")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under word-5-gram Jaccard similarity of 0.8 or more."""
    out = jaccard_components(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places, labels and score of every document."""
    out = scan_licences(table(spark, sf_dir, "documents"))
    return out.withColumn("expressions", F.array_join("expressions", "; "))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii_spans(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = identify_languages(docs, fit_languages(training_rows(docs)))
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, with the longest verbatim match and its place."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    f = F.col("found")
    items = F.array_join(f["items"], ",")
    return found.select("doc_id", f["n_words"].alias("n_words"), n_hit(f).alias("n_hit"),
                        F.size(f["items"]).cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"),
                        (F.size(f["hits"]) > 0).alias("contaminated"), f["longest"].alias("longest"),
                        f["longest_start"].alias("longest_start"), f["longest_item"].alias("longest_item"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract_pages(pages, fit_page_weights(pages))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and whether decoding them gives the text back."""
    return encode_texts(table(spark, sf_dir, "documents"), MODEL_PATH)


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of equal label with cosine 0.93 or more."""
    out = near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; trained on the rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs.filter(crc_mod("doc_id", 5) != 0), labels)
    out = score_quality(docs, model)
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding, fitted on the distinct vectors in steps of 1/256. ``deviation``
    is null where it does not fit into a long; ``deviation_exact`` has it as text."""
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                      "explained", "identity_error", F.col("deviation").cast("string").alias("deviation_exact"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations: the first turns are those of the conversation whose
    id is the next lower multiple of five, as many as the id's checksum says."""
    own = turn_sequences(table(spark, sf_dir, "conversations"))
    rebuilt = with_borrowed_heads(own, F.col("id") - F.col("id") % 5, crc_mod("id", 9), longest=8)
    return prefix_trie(rebuilt).select(
        F.col("id").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_id").alias("parent_conv_id"),
        F.col("n_members").alias("n_convs"), "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"), "ends_sha256")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence, its tier and its step group."""
    out = pack_documents(table(spark, sf_dir, "documents"), PACK_TOKENIZER, PACK_END)
    return out.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset", "tier", "step_group")


QUERIES = {f.__name__: f for f in (
    op1_chat, op2_jaccard, op3_licences, op4_pii, op5_language, op6_decontaminate, op7_main_text, op8_pieces,
    op9_embeddings, op10_quality, op11_whitening,
    op12_prefix_trie, op13_packing)}
ORACLES = {"op1_chat": OP1_SQL, "op2_jaccard": OP2_SQL, "op6_decontaminate": OP6_SQL,
           "op12_prefix_trie": OP12_SQL}
