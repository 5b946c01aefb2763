"""The queries of this package by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from vocalstat.llm.cascade import OP11_SQL, op11_rule_cascade
from vocalstat.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from vocalstat.llm.fim import OP13_SQL, op13_fill_in_middle
from vocalstat.llm.fingerprint import op1_fingerprints
from vocalstat.llm.langid import op6_language_id
from vocalstat.llm.merkle import OP12_SQL, op12_merkle_manifest
from vocalstat.llm.mixing import op5_mixing
from vocalstat.llm.packing import op3_packing
from vocalstat.llm.pii import op7_pii
from vocalstat.llm.quality import op9_quality
from vocalstat.llm.secret_scan import op4_secret_scan
from vocalstat.llm.simhash import op2_simhash_pivots
from vocalstat.llm.warc import op8_warc

QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_simhash_pivots, op3_packing, op4_secret_scan, op5_mixing,
    op6_language_id, op7_pii, op8_warc, op9_quality, op10_exact_dedup,
    op11_rule_cascade, op12_merkle_manifest, op13_fill_in_middle)}

ORACLE_SQL = {"op10_exact_dedup": OP10_SQL, "op11_rule_cascade": OP11_SQL,
              "op12_merkle_manifest": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
