"""The results of ``docindex.queries`` in DuckDB SQL over the same tables.

Each text stands on its own: the base relations are spelled out as CTEs, without
a detour over the operators they check.
"""

from __future__ import annotations


def _normalized(text: str) -> str:
    return f"lower(trim(regexp_replace(nfc_normalize({text}), '[ \\t\\x0B\\f\\r\\n]+', ' ', 'g')))"


def _html_text(html: str) -> str:
    out = html
    for pattern in (
        "(?is)<(script|style)[^>]*>.*?</(script|style)>",
        "(?s)<!--.*?-->",
        "<[^>]*>",
    ):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "''"),
        ("&nbsp;", " "),
        ("&amp;", "&"),
    ):
        out = f"replace({out}, '{entity}', '{char}')"
    return _normalized(out)


def _chunks(docs: str, size: int = 1000, overlap: int = 100) -> str:
    return f"""
SELECT docId,
       sha256(docId || '_' || s || '_' || e) AS chunkId,
       substring(text, s + 1, {size}) AS chunkText,
       CAST(s AS INTEGER) AS startOffset,
       CAST(e AS INTEGER) AS endOffset,
       sha256(substring(text, s + 1, {size})) AS chunkContentHash
FROM (SELECT docId, text, s, least(s + {size}, length(text)) AS e
      FROM (SELECT docId, text, unnest(range(0, length(text), {size - overlap})) AS s
            FROM {docs}))"""


_CODES = (
    "array_to_string(list_transform(range(0, 8), lambda i: "
    "CAST('0x' || substring(sha256({text}), CAST(i * 4 + 1 AS INTEGER), 4) AS INTEGER)), ',')"
)


def _vectors(chunks: str, version: str) -> str:
    return f"""
SELECT chunkId, docId, chunkContentHash, {_CODES.format(text="chunkText")} AS vector,
       'stub' AS embedder, '{version}' AS embedderVersion
FROM {chunks}"""


_CTES = {
    "norm": f"""
SELECT doc_id, 'doc://' || source || '/' || doc_id AS uri, {_normalized("text")} AS text
FROM documents""",
    "cur": """
SELECT doc_id, uri, text, sha256(uri) AS docId, sha256(text) AS contentHash
FROM norm WHERE text <> ''""",
    "prev": """
SELECT uri, text, sha256(uri) AS docId, sha256(text) AS contentHash FROM (
  SELECT uri, CASE doc_id % 10 WHEN 1 THEN text || ' superseded revision'
                               WHEN 3 THEN '#' || substring(text, 2)
                               ELSE text END AS text
  FROM cur WHERE doc_id % 10 <> 0
  UNION ALL
  SELECT 'doc://gone/' || doc_id, text FROM cur WHERE doc_id % 10 = 2)""",
    "cur_chunks": _chunks("cur"),
    "prev_chunks": _chunks("prev"),
    "prev_vectors": _vectors("prev_chunks", "1"),
    "cur_vectors": _vectors("cur_chunks", "1"),
    "next_vectors": _vectors("cur_chunks", "2"),
    "touched": """
SELECT * FROM cur c WHERE NOT EXISTS (
  SELECT 1 FROM prev p WHERE p.docId = c.docId AND p.contentHash = c.contentHash)""",
    "gone": """
SELECT * FROM prev p WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.docId = p.docId)""",
    "touched_chunks": _chunks("touched"),
    "backlog": """
SELECT * FROM cur_chunks c WHERE NOT EXISTS (
  SELECT 1 FROM prev_chunks p
  WHERE p.chunkId = c.chunkId AND p.chunkContentHash = c.chunkContentHash)""",
    "backlog_vectors": _vectors("backlog", "1"),
    "status": """
SELECT coalesce(c.docId, p.docId) AS docId, coalesce(c.uri, p.uri) AS uri,
       CASE WHEN p.docId IS NULL THEN 'new'
            WHEN c.docId IS NULL THEN 'deleted'
            WHEN c.contentHash = p.contentHash THEN 'unchanged'
            ELSE 'changed' END AS status
FROM cur c FULL JOIN prev p ON c.docId = p.docId""",
}

# Which CTEs each one reads.
_USES = {
    "norm": (),
    "cur": ("norm",),
    "prev": ("cur",),
    "cur_chunks": ("cur",),
    "prev_chunks": ("prev",),
    "prev_vectors": ("prev_chunks",),
    "cur_vectors": ("cur_chunks",),
    "next_vectors": ("cur_chunks",),
    "touched": ("cur", "prev"),
    "gone": ("cur", "prev"),
    "touched_chunks": ("touched",),
    "backlog": ("cur_chunks", "prev_chunks"),
    "backlog_vectors": ("backlog",),
    "status": ("cur", "prev"),
}


def _with(names: str, body: str) -> str:
    """``body`` after the CTEs it names and those they use."""
    needed: list[str] = []

    def add(name: str) -> None:
        for used in _USES[name]:
            add(used)
        if name not in needed:
            needed.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({_CTES[name]})" for name in needed)
    return f"WITH {ctes}\n{body.strip()}"


_INDEX_COLUMNS = """c.docId, d.uri, c.chunkId, c.chunkText, c.startOffset, c.endOffset,
       v.vector, v.embedder, v.embedderVersion"""

_REBUILT_INDEX = _with(
    "cur cur_chunks cur_vectors",
    f"""
SELECT {_INDEX_COLUMNS}
FROM cur d JOIN cur_chunks c ON c.docId = d.docId JOIN cur_vectors v ON v.chunkId = c.chunkId""",
)

_COUNTS = """
SELECT count(*) FILTER (status IN ('new', 'changed', 'unchanged')) AS total,
       count(*) FILTER (status = 'new') AS n_new,
       count(*) FILTER (status = 'changed') AS n_changed,
       count(*) FILTER (status = 'deleted') AS n_deleted,
       count(*) FILTER (status IN ('new', 'changed')) AS n_touched
FROM status"""

_MERGED_DOCS = _with(
    "cur prev",
    """
SELECT coalesce(p.docId, c.docId) AS docId,
       CASE WHEN p.docId IS NULL OR p.contentHash <> c.contentHash THEN c.uri ELSE p.uri END AS uri,
       CASE WHEN p.docId IS NULL OR p.contentHash <> c.contentHash THEN c.text ELSE p.text END AS text,
       CASE WHEN p.docId IS NULL OR p.contentHash <> c.contentHash
            THEN c.contentHash ELSE p.contentHash END AS contentHash
FROM prev p FULL JOIN cur c ON p.docId = c.docId""",
)

ORACLES: dict[str, str] = {
    "extract_text": f"SELECT url AS uri, {_html_text('html')} AS text FROM pages",
    "extract_with_failures": f"""
SELECT url AS uri, sha256(url) AS docId, sha256({_html_text("html")}) AS contentHash
FROM pages WHERE NOT contains(html, 'lang="fr"') AND {_html_text("html")} <> ''""",
    "normalize_text": f"SELECT doc_id, {_normalized('text')} AS text FROM documents",
    "normalize_text_arrow": f"SELECT doc_id, {_normalized('text')} AS text FROM documents",
    "normalize_composed_text": "SELECT doc_id, "
    + _normalized(
        "chr(13) || chr(10) || chr(11) || replace(replace(text, 'é', 'e' || chr(769)), ' ', ' ' || chr(9))"
        " || ' ' || chr(12) || chr(10)"
    )
    + " AS text FROM documents",
    "normalize_docs": _with(
        "norm",
        "SELECT uri, text, sha256(uri) AS docId, sha256(text) AS contentHash FROM norm",
    ),
    "drop_empty_docs": _with("cur", "SELECT uri, docId FROM cur"),
    "detect_new_or_changed": _with("touched", "SELECT docId, contentHash, uri FROM touched"),
    "detect_deleted": _with("gone", "SELECT docId, uri FROM gone"),
    "classify_changes": _with("status", "SELECT docId, uri, status FROM status"),
    "chunk_docs": _with("cur_chunks", "SELECT * FROM cur_chunks"),
    "chunk_docs_small": _with("cur", _chunks("cur", 50, 20)),
    "cascade_delete_docs": _with(
        "prev gone", "SELECT docId, uri FROM prev WHERE docId NOT IN (SELECT docId FROM gone)"
    ),
    "cascade_delete_chunks": _with(
        "prev_chunks gone",
        "SELECT docId, chunkId FROM prev_chunks WHERE docId NOT IN (SELECT docId FROM gone)",
    ),
    "cascade_delete_embeddings": _with(
        "prev_vectors gone",
        """
SELECT docId, chunkId, embedder, embedderVersion FROM prev_vectors
WHERE docId NOT IN (SELECT docId FROM gone)""",
    ),
    "merge_docs": _MERGED_DOCS,
    "merge_all_docs": _MERGED_DOCS,
    "merge_chunks": _with(
        "prev_chunks touched_chunks",
        """
SELECT coalesce(s.docId, t.docId) AS docId,
       coalesce(s.chunkId, t.chunkId) AS chunkId,
       coalesce(s.chunkText, t.chunkText) AS chunkText,
       coalesce(s.startOffset, t.startOffset) AS startOffset,
       coalesce(s.endOffset, t.endOffset) AS endOffset,
       coalesce(s.chunkContentHash, t.chunkContentHash) AS chunkContentHash
FROM prev_chunks t FULL JOIN touched_chunks s ON s.chunkId = t.chunkId""",
    ),
    "merge_embeddings": _with(
        "prev_vectors backlog_vectors",
        """
SELECT coalesce(t.chunkId, s.chunkId) AS chunkId,
       coalesce(s.docId, t.docId) AS docId,
       coalesce(s.chunkContentHash, t.chunkContentHash) AS chunkContentHash,
       coalesce(s.vector, t.vector) AS vector,
       coalesce(t.embedder, s.embedder) AS embedder,
       coalesce(t.embedderVersion, s.embedderVersion) AS embedderVersion
FROM prev_vectors t FULL JOIN backlog_vectors s
  ON s.chunkId = t.chunkId AND s.embedder = t.embedder
 AND s.embedderVersion = t.embedderVersion""",
    ),
    "replace_changed_chunks": _with(
        "prev_chunks touched touched_chunks",
        """
SELECT * FROM prev_chunks WHERE docId NOT IN (SELECT docId FROM touched)
UNION ALL SELECT * FROM touched_chunks""",
    ),
    "purge_orphan_embeddings": _with(
        "prev_vectors cur_chunks",
        """
SELECT chunkId, chunkContentHash, embedderVersion FROM prev_vectors v WHERE EXISTS (
  SELECT 1 FROM cur_chunks c
  WHERE c.chunkId = v.chunkId AND c.chunkContentHash = v.chunkContentHash)""",
    ),
    "embed_backlog_by_id": _with(
        "touched_chunks prev_chunks",
        """
SELECT chunkId, docId FROM touched_chunks
WHERE chunkId NOT IN (SELECT chunkId FROM prev_chunks)""",
    ),
    "embed_backlog_by_content": _with("backlog", "SELECT chunkId, docId FROM backlog"),
    "embed_backlog_version_bump": _with("cur_chunks", "SELECT chunkId, docId FROM cur_chunks"),
    "embed_chunks": _with("cur_vectors", "SELECT * FROM cur_vectors"),
    "embed_errors": _with(
        "cur_chunks",
        """
SELECT chunkId, substring(chunkText, 1, 50) AS textPrefix,
       CASE substring(chunkContentHash, 1, 1)
         WHEN '0' THEN 'empty vector' ELSE 'TimeoutError: no answer' END AS error
FROM cur_chunks WHERE substring(chunkContentHash, 1, 1) IN ('0', '1')""",
    ),
    "embeddings_current_version": _with("next_vectors", "SELECT * FROM next_vectors"),
    "embeddings_multi_version": _with(
        "prev_vectors next_vectors",
        """
SELECT chunkId, count(*) AS versions FROM (
  SELECT chunkId FROM prev_vectors UNION ALL SELECT chunkId FROM next_vectors)
GROUP BY chunkId""",
    ),
    "vector_dim_check": """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, len(embedding) = 64 AS ok
FROM embeddings""",
    "vector_check_failures": """
SELECT vec_id, kind, kind = 'whole' AND len(embedding) = 64 AS ok
FROM embeddings, (SELECT unnest(['whole', 'short', 'nan', 'missing']) AS kind)""",
    "retrieval_index_by_id": _with(
        "cur cur_chunks prev_vectors",
        f"""
SELECT {_INDEX_COLUMNS}
FROM cur d JOIN cur_chunks c ON c.docId = d.docId JOIN prev_vectors v ON v.chunkId = c.chunkId""",
    ),
    "retrieval_index": _with(
        "cur cur_chunks prev_vectors",
        f"""
SELECT {_INDEX_COLUMNS}
FROM cur d JOIN cur_chunks c ON c.docId = d.docId
JOIN prev_vectors v ON v.chunkId = c.chunkId AND v.chunkContentHash = c.chunkContentHash""",
    ),
    "noop_gate": _with(
        "status backlog",
        f"""
SELECT 'earlier' AS stored, n_touched AS newOrChanged, n_deleted AS deletedDocs,
       (SELECT count(*) FROM backlog) AS backlog,
       n_touched > 0 OR n_deleted > 0 OR (SELECT count(*) FROM backlog) > 0 AS rebuild
FROM ({_COUNTS})
UNION ALL SELECT 'equal', 0, 0, 0, false""",
    ),
    "run_metrics": _with(
        "status backlog",
        f"""
SELECT total AS totalDocs, n_new AS newDocs, n_changed AS changedDocs, n_deleted AS deletedDocs,
       CAST(0 AS BIGINT) AS failedDocs, total - n_touched AS docsSkipped,
       CASE WHEN total > 0 THEN CAST(n_touched AS DOUBLE) / total * 100.0 ELSE 0.0 END AS freshnessPct,
       CASE WHEN total > 0 THEN CAST(total - n_touched AS DOUBLE) / total * 100.0 ELSE 0.0 END AS dedupPct,
       (SELECT count(*) FROM backlog) AS chunksEmbedded
FROM ({_COUNTS})""",
    ),
    "stored_merge_docs": _with("cur", "SELECT uri, text, docId, contentHash FROM cur"),
    "stored_merge_embeddings": _with(
        "prev_vectors touched touched_chunks gone",
        f"""
SELECT * FROM (SELECT chunkId, docId, chunkContentHash, vector, embedder, embedderVersion FROM prev_vectors
  UNION ALL SELECT * FROM ({_vectors("touched_chunks", "2")}))
WHERE docId NOT IN (SELECT docId FROM gone)""",
    ),
    "stored_added_column": _with(
        "cur prev touched",
        """
SELECT docId, contentHash, CAST(NULL AS INTEGER) AS nChars FROM prev
WHERE docId NOT IN (SELECT docId FROM touched)
UNION ALL SELECT docId, contentHash, CAST(length(text) AS INTEGER) FROM touched""",
    ),
    "merge_all_docs_narrow": _with(
        "cur prev touched",
        """
SELECT docId, uri, contentHash FROM prev WHERE docId NOT IN (SELECT docId FROM touched)
UNION ALL SELECT docId, uri, contentHash FROM touched
UNION ALL SELECT NULL, uri, contentHash FROM cur WHERE contentHash < '1'""",
    ),
    "incremental_files": "SELECT sha256(html) AS hash, CAST(0 AS BIGINT) AS filesReadAgain FROM pages",
    "extract_errors": """
SELECT url AS uri, 'ValueError: French' AS error FROM pages WHERE contains(html, 'lang="fr"')""",
    "binary_scan": "SELECT url, sha256(html) AS html_sha256 FROM pages",
    "store_bootstrap": _with("cur", "SELECT uri, text, docId, contentHash FROM cur"),
    "incremental_index": _REBUILT_INDEX,
    "incremental_embeddings": _with("cur_vectors", "SELECT * FROM cur_vectors"),
    "incremental_outage": _with(
        "cur prev cur_chunks prev_chunks cur_vectors prev_vectors backlog status",
        f"""
SELECT {_INDEX_COLUMNS}
FROM cur d JOIN cur_chunks c ON c.docId = d.docId JOIN cur_vectors v ON v.chunkId = c.chunkId
WHERE d.docId NOT IN (SELECT docId FROM lost)
  AND c.chunkId NOT IN (SELECT chunkId FROM backlog WHERE chunkContentHash LIKE '0%')
UNION ALL
SELECT {_INDEX_COLUMNS}
FROM prev d JOIN prev_chunks c ON c.docId = d.docId JOIN prev_vectors v ON v.chunkId = c.chunkId
WHERE d.docId IN (SELECT docId FROM lost)""".replace(
            "(SELECT docId FROM lost)",
            """(
  SELECT b.docId FROM backlog b JOIN status s ON s.docId = b.docId
  WHERE s.status = 'changed' AND b.chunkContentHash LIKE '0%')""",
        ),
    ),
    "publish_roundtrip": _REBUILT_INDEX,
    "run_history": _with(
        "prev prev_chunks status touched_chunks backlog",
        f"""
SELECT CAST(1 AS INTEGER) AS run, d AS liveDocs, d AS totalDocs, d AS newDocs,
       CAST(0 AS BIGINT) AS changedDocs, CAST(0 AS BIGINT) AS deletedDocs,
       CAST(0 AS BIGINT) AS docsSkipped,
       CASE WHEN d > 0 THEN 100.0 ELSE 0.0 END AS freshnessPct, CAST(0.0 AS DOUBLE) AS dedupPct,
       c AS chunksWritten, c AS chunksEmbedded, CAST(0 AS BIGINT) AS chunksReused,
       c AS indexRowsWritten
FROM (SELECT (SELECT count(*) FROM prev) AS d, (SELECT count(*) FROM prev_chunks) AS c)
UNION ALL
SELECT 2, total, total, n_new, n_changed, n_deleted, total - n_touched,
       CASE WHEN total > 0 THEN CAST(n_touched AS DOUBLE) / total * 100.0 ELSE 0.0 END,
       CASE WHEN total > 0 THEN CAST(total - n_touched AS DOUBLE) / total * 100.0 ELSE 0.0 END,
       w, b, w - b, w
FROM ({_COUNTS}), (SELECT (SELECT count(*) FROM touched_chunks) AS w,
                          (SELECT count(*) FROM backlog) AS b)""",
    ),
}
