"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from voxloom.llm import decontam, dualtree, htmltext, langid, lexical, minhash, packing, pii, quality, substring, topk, urlfilter, warc

QUERIES = {
    "op1_decontam": decontam.op1_decontam,
    "op2_substring": substring.op2_substring,
    "op3_warc": warc.op3_warc,
    "op4_packing": packing.op4_packing,
    "op5_urlfilter": urlfilter.op5_urlfilter,
    "op6_neardup": minhash.op6_neardup,
    "op7_pii": pii.op7_pii,
    "op8_quality": quality.op8_quality,
    "op9_topk": topk.op9_topk,
    "op10_langid": langid.op10_langid,
    "op11_lexical": lexical.op11_lexical,
    "op12_cluster": dualtree.op12_cluster,
    "op13_htmltext": htmltext.op13_htmltext,
}
ORACLES = {"op1_decontam": decontam.ORACLE_SQL, "op2_substring": substring.ORACLE_SQL, "op3_warc": warc.ORACLE_SQL, "op9_topk": topk.ORACLE_SQL, "op11_lexical": lexical.ORACLE_SQL, "op12_cluster": dualtree.ORACLE_SQL}
