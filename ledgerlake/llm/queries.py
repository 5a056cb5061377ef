"""Registered queries of the subpackage and their DuckDB SQL, where SQL can say them."""

from __future__ import annotations

from . import license_scan, source_divergence
from .bbit_minhash import op12_bbit_minhash
from .decontaminate import op7_decontaminate
from .html_extract import op3_html_extract
from .importance import op13_importance
from .language_id import op10_language_id
from .license_scan import op4_license_scan
from .line_quality import op8_line_quality
from .mixing import op2_entropy_mix
from .quality_rules import op1_quality_rules
from .secret_scan import op9_secret_scan
from .simhash import op5_simhash
from .source_divergence import op11_source_divergence
from .token_output import op6_token_output

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_entropy_mix": op2_entropy_mix,
    "op3_html_extract": op3_html_extract,
    "op4_license_scan": op4_license_scan,
    "op5_simhash": op5_simhash,
    "op6_token_output": op6_token_output,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_quality": op8_line_quality,
    "op9_secret_scan": op9_secret_scan,
    "op10_language_id": op10_language_id,
    "op11_source_divergence": op11_source_divergence,
    "op12_bbit_minhash": op12_bbit_minhash,
    "op13_importance": op13_importance,
}

ORACLE: dict[str, str] = {
    "op4_license_scan": license_scan.ORACLE_SQL,
    "op11_source_divergence": source_divergence.ORACLE_SQL,
}
