"""Registered queries of the subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from pointtally.llm import collocations, decontaminate, fingerprints, html_text, jaccard, merkle, packing, preferences, quality, thresholds, token_files, urls, warc


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op2_token_files(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.read_tokens(token_files.write_tokens(_table(spark, sf_dir, "documents"), path))


def op3_packing(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer=path)


def op4_decontaminate(spark, sf_dir):
    return decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    ).drop("spans")


def op5_html_text(spark, sf_dir):
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op6_warc(spark, sf_dir):
    index = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(index, with_payload=False).drop("url", "payload")


def op7_url_filters(spark, sf_dir):
    return urls.filter_urls(_table(spark, sf_dir, "pages"))


def op8_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_preferences(spark, sf_dir):
    return preferences.format_preferences(_table(spark, sf_dir, "conversations"))


def op10_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_thresholds(spark, sf_dir):
    return thresholds.judge(_table(spark, sf_dir, "documents")).drop("limits_of")


def op13_merkle(spark, sf_dir):
    return merkle.document_manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_jaccard": op1_jaccard,
    "op2_token_files": op2_token_files,
    "op3_packing": op3_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_html_text": op5_html_text,
    "op6_warc": op6_warc,
    "op7_url_filters": op7_url_filters,
    "op8_quality": op8_quality,
    "op9_preferences": op9_preferences,
    "op10_fingerprints": op10_fingerprints,
    "op11_collocations": op11_collocations,
    "op12_thresholds": op12_thresholds,
    "op13_merkle": op13_merkle,
}

ORACLE = {
    "op1_jaccard": jaccard.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op6_warc": warc.ORACLE,
    "op7_url_filters": urls.oracle(),
    "op9_preferences": preferences.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_thresholds": thresholds.oracle(),
    "op13_merkle": merkle.ORACLE,
}
