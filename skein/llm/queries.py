"""The queries of this subpackage and, where SQL can express them, the SQL that checks them."""

from __future__ import annotations

from skein.llm import checks, minhash
from skein.llm.bpe import op7_byte_bpe
from skein.llm.chunk_dedup import op9_chunk_dedup
from skein.llm.langid import op3_language_id
from skein.llm.media import op6_wav_fingerprints
from skein.llm.minhash import op1_dart_minhash
from skein.llm.packing import op8_ga_packing
from skein.llm.quality_knn import op4_quality_votes
from skein.llm.quality_rules import op2_quality_rules
from skein.llm.secret_scan import op10_secret_scan
from skein.llm.suffix_dedup import op5_suffix_dedup

QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_quality_votes": op4_quality_votes,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_wav_fingerprints": op6_wav_fingerprints,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_ga_packing": op8_ga_packing,
    "op9_chunk_dedup": op9_chunk_dedup,
    "op10_secret_scan": op10_secret_scan,
} | checks.QUERIES
ORACLES: dict[str, str] = {"op1_dart_minhash": minhash.ORACLE_SQL} | checks.ORACLES
