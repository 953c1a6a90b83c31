"""Registered queries of the operators, and the SQL of those that SQL can express."""

from . import decontaminate, exact_dedup, langid, line_dedup, merkle, mixing, ngram_join, periodic, pii, quality, suffix_dedup, vector_codes, warc

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_pii": pii.query,
    "op3_quality": quality.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_merkle": merkle.query,
    "op6_langid": langid.query,
    "op7_warc": warc.query,
    "op8_ngram_join": ngram_join.query,
    "op9_line_dedup": line_dedup.query,
    "op10_mixing": mixing.query,
    "op11_exact_dedup": exact_dedup.query,
    "op12_periodic_runs": periodic.query,
    "op13_vector_codes": vector_codes.query,
}

ORACLE = {
    "op7_warc": warc.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
