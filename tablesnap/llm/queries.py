"""The registered queries of this subpackage, and the SQL twin of each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesnap.llm import merkle
from tablesnap.llm.alignment import op12_token_alignment
from tablesnap.llm.bpe import op6_bpe_codec
from tablesnap.llm.curves import op4_curve_neighbours
from tablesnap.llm.html_text import op5_page_text
from tablesnap.llm.language import op3_language_id
from tablesnap.llm.licenses import op11_license_notices
from tablesnap.llm.merkle import op13_merkle_manifest
from tablesnap.llm.multiset import op9_multiset_fingerprints
from tablesnap.llm.packing import op1_pack_documents
from tablesnap.llm.quality import op7_quality_scores
from tablesnap.llm.repeats import op8_repeated_passages
from tablesnap.llm.secret_scan import op2_secret_spans
from tablesnap.llm.simhash import op10_simhash_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack_documents": op1_pack_documents,
    "op2_secret_spans": op2_secret_spans,
    "op3_language_id": op3_language_id,
    "op4_curve_neighbours": op4_curve_neighbours,
    "op5_page_text": op5_page_text,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_quality_scores": op7_quality_scores,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_multiset_fingerprints": op9_multiset_fingerprints,
    "op10_simhash_components": op10_simhash_components,
    "op11_license_notices": op11_license_notices,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {"op13_merkle_manifest": merkle.ORACLE}
