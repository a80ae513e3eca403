"""Queries of the training-data operators over whole tables, and their SQL where it can express them."""

import corpus_pipeline

from . import decontaminate, htmltext, langid, minhash, mixing, negatives, phrases, pii, quality, sharding, simhash, substring, warc

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_mixing": mixing.query,
    "op2_sharding": sharding.query,
    "op3_pii": pii.query,
    "op4_html": htmltext.query,
    "op5_langid": langid.query,
    "op6_decontaminate": decontaminate.query,
    "op7_simhash": simhash.query,
    "op8_substring": substring.query,
    "op9_quality": quality.query,
    "op10_warc": warc.query,
    "op11_phrases": phrases.query,
    "op12_negatives": negatives.query,
    "op13_minhash": minhash.query,
}
ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op8_substring": substring.ORACLE,
    "op9_quality": quality.ORACLE,
    "op10_warc": warc.ORACLE,
    "op11_phrases": phrases.ORACLE,
    "op12_negatives": negatives.ORACLE,
    "op13_minhash": minhash.ORACLE,
}
