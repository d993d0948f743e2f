"""The numbered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tessera.llm import (chat, chosenpath, decontaminate, language, licenses, passages, pieces, quality, resample, runs, simhash, topk,
                         toxicity)

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_passages": passages.op2_passages,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_chat": chat.op4_chat,
    "op5_topk": topk.op5_topk,
    "op6_pieces": pieces.op6_pieces,
    "op7_licenses": licenses.op7_licenses,
    "op8_simhash": simhash.op8_simhash,
    "op9_language": language.op9_language,
    "op10_quality": quality.op10_quality,
    "op11_minhash": chosenpath.op11_minhash,
    "op12_resampling": resample.op12_resampling,
    "op13_runs": runs.op13_runs,
}
SQL = {"op1_decontaminate": decontaminate.SQL_DECONTAMINATE, "op4_chat": chat.SQL_CHAT, "op5_topk": topk.SQL_TOPK,
       "op11_minhash": chosenpath.op11_minhash,
    "op12_resampling": resample.SQL_RESAMPLING}
