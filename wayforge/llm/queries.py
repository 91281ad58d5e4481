"""The registered queries of this package: (spark, sf_dir) to DataFrame, and DuckDB SQL where it can express them."""

from __future__ import annotations

from wayforge.llm.collocations import OP11_SQL, op11_collocations
from wayforge.llm.decontamination import op1_decontamination
from wayforge.llm.language_id import op6_language_id
from wayforge.llm.license_scan import op4_license_scan
from wayforge.llm.lm_scoring import op5_lm_scores
from wayforge.llm.local_descriptors import op9_local_descriptors
from wayforge.llm.mixing import op3_mixing
from wayforge.llm.ngram_join import op10_ngram_jaccard
from wayforge.llm.periodic_runs import op13_periodic_runs
from wayforge.llm.quality import op8_quality
from wayforge.llm.resharding import op2_resharding
from wayforge.llm.simhash import op12_simhash
from wayforge.llm.warc import op7_warc

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_resharding": op2_resharding,
    "op3_mixing": op3_mixing,
    "op4_license_scan": op4_license_scan,
    "op5_lm_scores": op5_lm_scores,
    "op6_language_id": op6_language_id,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_local_descriptors": op9_local_descriptors,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op7_warc": """
        WITH made AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), seen AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM made)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM seen
    """,
    "op11_collocations": OP11_SQL,
}
