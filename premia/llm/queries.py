"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from premia.llm import bpe, exact, langid, lines, merkle, mixing, quality, repeats, secrets, simhash, spelling, token_files, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_language": langid.op2_language,
    "op3_exact": exact.op3_exact,
    "op4_bpe": bpe.op4_bpe,
    "op5_repeats": repeats.op5_repeats,
    "op6_tokens": token_files.op6_tokens,
    "op7_simhash": simhash.op7_simhash,
    "op8_secrets": secrets.op8_secrets,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_spelling": spelling.op11_spelling,
    "op12_merkle": merkle.op12_merkle,
    "op13_lines": lines.op13_lines,
}

ORACLES = {"op3_exact": exact.ORACLE, "op11_spelling": spelling.ORACLE, "op12_merkle": merkle.ORACLE, "op13_lines": lines.ORACLE}
