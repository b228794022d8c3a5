"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, langid, line_quality, minhash, nn_descent, packing, pii, secrets_scan, substring, url_filter

QUERIES = {
    "op1_line_quality": line_quality.op1_line_quality,
    "op2_substring": substring.op2_substring,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_langid": langid.op4_langid,
    "op5_packing": packing.op5_packing,
    "op6_pii": pii.op6_pii,
    "op7_nn_descent": nn_descent.op7_nn_descent,
    "op8_secrets": secrets_scan.op8_secrets,
    "op9_minhash": minhash.op9_minhash,
    "op10_bpe": bpe.op10_bpe,
    "pages_language": langid.pages_language,
}

ORACLE_SQL = {
    "op1_line_quality": line_quality.op1_sql(),
    "op2_substring": substring.op2_sql(),
    "op3_url_filter": url_filter.op3_sql(),
    "op7_nn_descent": nn_descent.op7_sql(),
    "op9_minhash": minhash.op9_sql(),
}
