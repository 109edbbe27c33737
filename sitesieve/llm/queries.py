"""The queries of this folder's operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from sitesieve.llm.decontaminate import op4_decontaminate
from sitesieve.llm.kneser_ney import op6_kneser_ney
from sitesieve.llm.language import op9_language_id
from sitesieve.llm.license_scan import op7_license_scan
from sitesieve.llm.packing import op2_packing
from sitesieve.llm.quality import op3_quality_classifier
from sitesieve.llm.simhash import op5_simhash_dedup
from sitesieve.llm.substring_dedup import op10_substring_dedup
from sitesieve.llm.topk import ORACLE_SQL as TOPK_SQL
from sitesieve.llm.topk import op1_exact_topk
from sitesieve.llm.warc import ORACLE_SQL as WARC_SQL
from sitesieve.llm.warc import op8_warc_derivatives

QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_topk, op2_packing, op3_quality_classifier, op4_decontaminate, op5_simhash_dedup,
        op6_kneser_ney, op7_license_scan, op8_warc_derivatives, op9_language_id, op10_substring_dedup,
    )
}
ORACLES = {"op1_exact_topk": TOPK_SQL, "op8_warc_derivatives": WARC_SQL}
