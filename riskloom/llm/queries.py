"""The queries of this folder's operators: production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.common import table


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the written store."""
    from riskloom.llm.idstore import scan_store, write_store

    return scan_store(*write_store(table(spark, sf_dir, "documents"), word_bpe(), end_id=1))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of the base secrets and of the added rules in every document."""
    from riskloom.llm.secrets import digest, secret_spans

    return digest(secret_spans(table(spark, sf_dir, "documents")))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edit, with their likeness."""
    from riskloom.llm.sketch import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    import public_tokenizers

    from riskloom.llm.tokencount import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in a document: doc_id, item_id, similarity, position, found_by."""
    from riskloom.llm.decontam import passages

    return passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The pseudonym key of the registered query; a real run passes its own secret.
DEMO_SECRET = "demonstration only"


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data under format-preserving pseudonyms, and their counts."""
    from riskloom.llm.pii import key_of, pseudonymise

    return pseudonymise(table(spark, sf_dir, "documents"), key_of(DEMO_SECRET))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    from riskloom.llm.langid import identified, learn_by_id

    docs = table(spark, sf_dir, "documents")
    return identified(docs, learn_by_id(docs)).selectExpr("doc_id", "held_out", "lang_pred", "score", "size(spans) as n_spans")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages, read back from normalised archives."""
    from riskloom.llm.warc import normalise, read_records, write_archives

    uri, archives = write_archives(table(spark, sf_dir, "pages"))
    return read_records(uri, normalise(uri, archives))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces and their places in sequences of 2048 tokens."""
    from riskloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), word_bpe(), end_id=0)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with three-word shingle sets of Jaccard similarity 0.9 or more."""
    from riskloom.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, every 97th run a code point short, grouped by spelling."""
    from riskloom.llm.variants import CORRUPTED, spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"), corrupted=CORRUPTED)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep, remove and share in every part, for every order and step."""
    from riskloom.llm.audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    from riskloom.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), byte_bpe())


QUERIES = {
    "op1_id_store": op1_id_store,
    "op2_secret_scan": op2_secret_scan,
    "op3_fingerprints": op3_fingerprints,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_language_id": op7_language_id,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_jaccard": op10_jaccard,
    "op11_variants": op11_variants,
    "op12_filter_audit": op12_filter_audit,
    "op13_byte_bpe": op13_byte_bpe,
}
