"""The registered query of every operator here, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from tempora.llm.bpe import op6_bpe
from tempora.llm.conversations import op13_conversations
from tempora.llm.crf import op7_quality
from tempora.llm.lines import op12_lines
from tempora.llm.media import op2_media
from tempora.llm.mixing import op9_mixing
from tempora.llm.negatives import op11_negatives
from tempora.llm.pii import op5_pii
from tempora.llm.rules import op8_rules
from tempora.llm.secrets import op10_secrets
from tempora.llm.simhash import op3_simhash
from tempora.llm.sql import OP11_SQL, OP12_SQL, OP13_SQL
from tempora.llm.suffixes import op4_suffixes
from tempora.llm.tokenstore import op1_tokenstore

QUERIES = {
    "op1_tokenstore": op1_tokenstore,
    "op2_media": op2_media,
    "op3_simhash": op3_simhash,
    "op4_suffixes": op4_suffixes,
    "op5_pii": op5_pii,
    "op6_bpe": op6_bpe,
    "op7_quality": op7_quality,
    "op8_rules": op8_rules,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_negatives": op11_negatives,
    "op12_lines": op12_lines,
    "op13_conversations": op13_conversations,
}

SPANS_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({raw}),
pieces AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM raw WHERE len(hits) > 0),
spans AS (SELECT doc_id, kind, rank, hits[i] AS hit,
                 list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS s
          FROM pieces),
kept AS (SELECT doc_id, kind, rank, CAST(s AS BIGINT) AS s, CAST(s + length(hit) AS BIGINT) AS e FROM spans WHERE {keep})
"""


def _raw(kind: str, rank: int, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS gaps FROM d"


_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""".replace("'", "''")

OP10_SQL = (
    SPANS_SQL.format(
        raw=" UNION ALL ".join([_raw("assign", 0, _ASSIGN), _raw("access", 1, "AKIA[A-Z0-9]+"), _raw("hex", 2, "[0-9a-f]{16,}")]),
        keep=f"CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '{_VALUE}', 1)) >= 12 WHEN 'access' THEN length(hit) >= 18 ELSE true END",
    )
    + """, found AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
       count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex
       FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM d LEFT JOIN found USING (doc_id)
"""
)

ORACLES = {
    "op10_secrets": OP10_SQL,
    "op11_negatives": OP11_SQL,
    "op12_lines": OP12_SQL,
    "op13_conversations": OP13_SQL,
}
