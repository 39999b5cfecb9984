"""Driver queries of the corpus operators, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers

from . import (byte_bpe, decontaminate, divergence, embed_dedup, fill_middle, jaccard_join, license_scan, packing,
               quality, secret_scan, suffix_dedup, url_rules, warc_fixity)
from .common import table

RANKS = "byte_bpe_50k.tiktoken"
WORDS = "word_bpe_49k.json"


def op1_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.NOTICES)


def op2_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip_digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_url_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op5_embed_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_warc_fixity(spark, sf_dir):
    return warc_fixity.report(table(spark, sf_dir, "pages"))


def op7_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                      whole=True)


def op8_secrets(spark, sf_dir):
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op11_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_packing(spark, sf_dir):
    return packing.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op13_fill_middle(spark, sf_dir):
    return fill_middle.digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_byte_bpe, op3_quality, op4_url_rules, op5_embed_dedup, op6_warc_fixity, op7_decontaminate,
    op8_secrets, op9_jaccard_join, op10_suffix_dedup, op11_divergence, op12_packing, op13_fill_middle)}

ORACLE: dict[str, str] = {"op6_warc_fixity": warc_fixity.ORACLE, "op8_secrets": secret_scan.ORACLE,
                          "op9_jaccard_join": jaccard_join.ORACLE, "op11_divergence": divergence.ORACLE,
                          "op13_fill_middle": fill_middle.ORACLE}
