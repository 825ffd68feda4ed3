"""SQL giving the same rows as each query, for DuckDB over the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# -- building blocks: common table expressions ----------------------------------

RECORDS = """records AS (
  SELECT d.doc_id, d.doc_id::varchar id, e.embedding, d.lang, d.source, d.n_chars, d.text
  FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id)"""

POINTS = """points AS (
  SELECT v.event_id, v.event_id::varchar id, e.embedding, v.event_type, v.user_id,
         json_extract_string(v.props, '$.k')::int k
  FROM events v JOIN embeddings e ON e.vec_id = v.event_id % (SELECT count(*) FROM embeddings))"""

MIXED = """mixed AS (
  SELECT r.doc_id, CASE WHEN r.source <> 'src0' THEN r.id END id,
         CASE WHEN r.source = 'src0' THEN 'missing_id'
              WHEN r.embedding IS NULL THEN 'missing_embedding'
              WHEN r.lang = 'de' THEN 'bad_dimension'
              WHEN l.toxic = 1 THEN 'bad_payload'
              ELSE 'ok' END reason
  FROM records r LEFT JOIN labels l ON r.doc_id = l.doc_id)"""

TOKENS = r"""tokens AS (
  SELECT doc_id, tok FROM (
    SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) tok FROM documents)
  WHERE tok <> '')"""

FREQUENCIES = TOKENS + """, freq AS (
  SELECT doc_id, ('0x' || substr(md5(tok), 1, 7))::bigint idx, count(*) tf FROM tokens GROUP BY 1, 2),
lengths AS (SELECT doc_id, sum(tf)::bigint dl FROM freq GROUP BY 1)"""

BATCHED = """batched AS (
  SELECT doc_id, reason,
    ('0x' || substr(md5(doc_id::varchar), 1, 7))::bigint
      % (SELECT ceil(count(*) / 100)::bigint FROM documents) batch_id
  FROM mixed)"""


def _dense(column: str) -> str:
    return (
        f"len({column})::int dim, "
        f"round(list_sum(list_transform({column}, lambda x: x::double)), 4) dense_sum"
    )


def _weights(average: str) -> str:
    return FREQUENCIES + f""", weights AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY idx)::int - 1 pos, idx,
    round(tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * dl / {average})), 6) weight
  FROM freq JOIN lengths USING (doc_id))"""


FIXED = _weights("200.0::double")
CORPUS = _weights("(SELECT avg(coalesce(dl, 0)) FROM documents LEFT JOIN lengths USING (doc_id))::double")

HYBRID_TERMS = f"""WITH {RECORDS}, {FIXED}
SELECT r.id, len(r.embedding)::int dim, w.pos, w.idx, w.weight
FROM records r JOIN weights w USING (doc_id) WHERE r.embedding IS NOT NULL"""

# -- sources ------------------------------------------------------------------

ORACLES["src_field_records"] = f"""WITH {RECORDS}, flat AS (
  SELECT id, {_dense('embedding')}, lang, source, n_chars, text FROM records)
SELECT id, dim, dense_sum, 'lang' key, lang value FROM flat
UNION ALL SELECT id, dim, dense_sum, 'source', source FROM flat
UNION ALL SELECT id, dim, dense_sum, 'n_chars', n_chars::varchar FROM flat
UNION ALL SELECT id, dim, dense_sum, 'text', text FROM flat"""

ORACLES["src_points_unnamed"] = f"""WITH {POINTS}
SELECT id, {_dense('embedding')}, event_type, k FROM points"""

ORACLES["src_points_named"] = f"""WITH {RECORDS}, {FREQUENCIES}, s AS (
  SELECT doc_id, count(*) terms, min(idx) first_idx, max(idx) last_idx FROM freq GROUP BY 1)
SELECT id, {_dense('embedding')}, terms::int terms, first_idx, last_idx, lang
FROM records LEFT JOIN s USING (doc_id)"""

ORACLES["src_columnar_pages"] = f"""WITH {RECORDS}
SELECT id, {_dense('embedding')}, lang, text document FROM records"""

ORACLES["src_paged"] = "SELECT event_id, user_id, event_type, value, props FROM events"

ORACLES["src_count"] = "SELECT count(*) AS rows FROM documents"

# -- target -------------------------------------------------------------------

ORACLES["index_config"] = """SELECT 'embeddings' collection, max(len(embedding))::int dimension,
  'cosine' space_type, 'int16' AS precision, 16 m, 128 ef_con, true is_hybrid, 'default' sparse_model
FROM embeddings"""

ORACLES["upsert_last_write_wins"] = """SELECT user_id::varchar id, event_id seq, event_type, value, props
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""

_LAST_TURN = """SELECT conv_id::varchar id, turn seq, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"""

ORACLES["upsert_idempotent"] = _LAST_TURN
ORACLES["compact_collection"] = _LAST_TURN

ORACLES["chunk_layout"] = """WITH p AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 pos FROM documents)
SELECT doc_id, pos, pos // 1000 batch_id, (pos % 1000) // 100 chunk_id FROM p"""

ORACLES["sink_record"] = f"""WITH {RECORDS}, {FREQUENCIES}, s AS (
  SELECT doc_id, count(*)::int terms FROM freq GROUP BY 1)
SELECT id, len(embedding)::int dim, terms, lang, source, n_chars, text
FROM records LEFT JOIN s USING (doc_id) WHERE embedding IS NOT NULL"""

# -- detection ----------------------------------------------------------------

ORACLES["detect_dimension"] = f"""WITH {RECORDS}
SELECT min(len(embedding))::int min_dimension, max(len(embedding))::int max_dimension,
  count(*) AS rows, count(*) FILTER (embedding IS NULL) missing FROM records"""

ORACLES["payload_key_profile"] = """WITH kv AS (
  SELECT 'event_type' key, event_type value FROM events
  UNION ALL SELECT 'user_id', user_id::varchar FROM events
  UNION ALL SELECT unnest(json_keys(props)), json_extract_string(props, '$.' || unnest(json_keys(props)))
  FROM events)
SELECT key, count(*) AS rows, min(value) min_value, max(value) max_value FROM kv GROUP BY key"""

ORACLES["payload_types"] = """WITH j AS (
  SELECT to_json({'event_type': event_type, 'user_id': user_id,
                  'k': json_extract_string(props, '$.k')::int}) j FROM events),
kv AS (SELECT j, unnest(json_keys(j)) key FROM j)
SELECT key, max(CASE json_type(j, '$.' || key) WHEN 'VARCHAR' THEN 'STRING' ELSE 'BIGINT' END) AS type
FROM kv GROUP BY key"""

# -- normalisation --------------------------------------------------------------

ORACLES["norm_id"] = "SELECT event_id, event_id::varchar id FROM events"

ORACLES["norm_dense"] = f"""SELECT vec_id, {_dense('embedding')},
  round(list_sum(list_transform(embedding, lambda x: x::double * x::double)), 4) squared_norm
FROM embeddings"""

ORACLES["sparse_from_map"] = f"WITH {FIXED} SELECT doc_id, pos, idx, weight FROM weights"
ORACLES["sparse_from_struct"] = ORACLES["sparse_from_map"]

_LABELLED = "documents d LEFT JOIN labels l USING (doc_id)"

ORACLES["payload_bundle"] = f"""SELECT doc_id, 'lang' key, lang value FROM {_LABELLED}
UNION ALL SELECT doc_id, 'source', source FROM {_LABELLED}
UNION ALL SELECT doc_id, 'n_chars', n_chars::varchar FROM {_LABELLED}
UNION ALL SELECT doc_id, 'text', text FROM {_LABELLED}
UNION ALL SELECT doc_id, 'quality', quality::varchar FROM {_LABELLED}"""

ORACLES["payload_default"] = f"""SELECT doc_id,
  coalesce('{{"quality":' || quality || ',"toxic":' || toxic || '}}', '{{}}') payload FROM {_LABELLED}"""

ORACLES["document_in_payload"] = """SELECT doc_id, 'document' key, text value FROM documents
UNION ALL SELECT doc_id, 'source', source FROM documents"""

ORACLES["hybrid_row_counts"] = r"""SELECT role = 'user' AND regexp_matches(text, '[\p{L}\p{N}]') is_hybrid,
  count(*) AS rows FROM conversations GROUP BY 1"""

_EVENT_KEYS = """kv AS (
  SELECT event_id, 'event_type' key, event_type value FROM events
  UNION ALL SELECT event_id, 'user_id', user_id::varchar FROM events
  UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events)"""

ORACLES["filter_meta_split"] = f"""WITH {_EVENT_KEYS}
SELECT event_id, CASE WHEN key IN ('event_type', 'k') THEN 'filter' ELSE 'meta' END slot, key, value FROM kv"""

ORACLES["filter_meta_split_empty"] = f"""WITH {_EVENT_KEYS}
SELECT event_id, 'meta' slot, key, value FROM kv"""

ORACLES["typed_payload_filter"] = """SELECT user_id, count(*) n, sum(json_extract_string(props, '$.k')::bigint)::bigint sum_k
FROM events WHERE event_type = 'click' GROUP BY user_id"""

ORACLES["typed_payload_rows"] = ORACLES["filter_meta_split"]

ORACLES["typed_field_split"] = """SELECT doc_id, 'filter' slot, 'lang' key, lang value FROM documents
UNION ALL SELECT doc_id, 'meta', 'source', source FROM documents
UNION ALL SELECT doc_id, 'meta', 'n_chars', n_chars::varchar FROM documents
UNION ALL SELECT doc_id, 'meta', 'text', text FROM documents"""

# -- quality ------------------------------------------------------------------

ORACLES["invalid_filter_fields"] = """WITH requested AS (
  SELECT unnest(['lang', 'quality', 'source', 'toxic']) field),
known AS (SELECT DISTINCT unnest(json_keys(to_json(
  {'lang': lang, 'source': source, 'n_chars': n_chars, 'text': text}))) field FROM documents)
SELECT field FROM requested WHERE field NOT IN (SELECT field FROM known)"""

ORACLES["text_coverage"] = """SELECT count(*) AS rows,
  count(*) FILTER (role = 'assistant' AND text <> '') rows_with_text FROM conversations"""

ORACLES["empty_text_batches"] = """SELECT conv_id batch_id, count(*) AS rows FROM conversations GROUP BY 1
HAVING count(*) FILTER (role = 'assistant' AND text <> '') = 0"""

ORACLES["skip_missing_embedding"] = f"""WITH {RECORDS}
SELECT id, {_dense('embedding')} FROM records WHERE embedding IS NOT NULL"""

ORACLES["quarantine_counts"] = f"""WITH {RECORDS}, {MIXED}
SELECT reason, count(*) AS rows FROM mixed GROUP BY 1"""

ORACLES["quarantine_rows"] = f"WITH {RECORDS}, {MIXED} SELECT id, reason FROM mixed"

# -- sparse encoding ------------------------------------------------------------

ORACLES["token_counts"] = f"""WITH {TOKENS}
SELECT doc_id, tok AS token, count(*)::int tf FROM tokens GROUP BY 1, 2"""

ORACLES["doc_lengths"] = f"""WITH {FREQUENCIES}
SELECT doc_id, coalesce(dl, 0) dl FROM documents LEFT JOIN lengths USING (doc_id)"""

ORACLES["bm25_sparse"] = f"WITH {CORPUS} SELECT doc_id, pos, idx, weight FROM weights"

ORACLES["idf_table"] = f"""WITH {FREQUENCIES}, n AS (SELECT count(*) n FROM documents),
f AS (SELECT idx, count(DISTINCT doc_id) df FROM freq GROUP BY 1)
SELECT idx, df, round(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)), 6) idf FROM f, n"""

ORACLES["encoder_custom_udf"] = """SELECT doc_id, 0 pos, 0::bigint idx, length(text)::double weight FROM documents
UNION ALL SELECT doc_id, 1, 1, (length(text) - length(replace(text, ' ', '')))::double FROM documents
UNION ALL SELECT doc_id, 2, 2, (length(text) - length(replace(text, chr(10), '')))::double FROM documents"""

ORACLES["dense_to_hybrid"] = HYBRID_TERMS

ORACLES["attach_sparse"] = f"""WITH {RECORDS}, {FIXED}
SELECT r.id, len(r.embedding)::int dim, w.pos, w.idx, w.weight FROM records r JOIN weights w USING (doc_id)"""

# -- batches and resuming --------------------------------------------------------

ORACLES["hash_batches"] = """SELECT doc_id, ('0x' || substr(md5(doc_id::varchar), 1, 7))::bigint
  % (SELECT ceil(count(*) / 100)::bigint FROM documents) batch_id FROM documents"""

ORACLES["positional_batches"] = """WITH p AS (
  SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 pos FROM events)
SELECT event_id, user_id, pos, pos // 1000 batch_id FROM p"""

ORACLES["resume_offset"] = """WITH p AS (
  SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 pos FROM documents)
SELECT doc_id, lang, pos FROM p WHERE pos >= (SELECT count(*) // 3 FROM documents)"""

ORACLES["resume_keyset"] = """SELECT doc_id, lang FROM documents
WHERE doc_id > (SELECT floor(avg(doc_id)) FROM documents)"""

ORACLES["keyset_page"] = """SELECT event_id, event_type FROM events
WHERE event_id > (SELECT floor(avg(event_id)) FROM events) ORDER BY event_id LIMIT 1000"""

ORACLES["resume_ledger"] = f"""WITH {RECORDS}, {MIXED}, {BATCHED}
SELECT doc_id, batch_id FROM batched
WHERE batch_id >= (SELECT ceil(count(*) / 100)::bigint FROM documents) // 2"""

ORACLES["resume_completed"] = f"""WITH {RECORDS}
SELECT 2::bigint batches, count(*) fetched, count(embedding) upserted,
  count(*) - count(embedding) quarantined, true completed,
  CASE WHEN count(*) > count(embedding) THEN 'completed with errors' ELSE 'completed' END status
FROM records"""

ORACLES["stream_resume"] = f"""WITH {RECORDS}
SELECT id, {_dense('embedding')}, lang FROM records WHERE embedding IS NOT NULL"""

ORACLES["stream_migrate"] = HYBRID_TERMS

# -- whole migrations -------------------------------------------------------------

ORACLES["migrate_fields"] = f"""WITH {RECORDS}
SELECT id, {_dense('embedding')}, lang, source, n_chars FROM records WHERE embedding IS NOT NULL"""

ORACLES["migrate_points"] = ORACLES["src_points_unnamed"]

ORACLES["migrate_pages"] = HYBRID_TERMS

ORACLES["verify_migration"] = f"""WITH {RECORDS}
SELECT 'same' status, count(embedding) AS rows FROM records"""

# -- reports ------------------------------------------------------------------

ORACLES["run_report"] = f"""WITH {RECORDS}, {MIXED}, {BATCHED}
SELECT 'run' run_id, count(DISTINCT batch_id) batches, count(*) fetched,
  count(*) FILTER (reason = 'ok') upserted, count(*) FILTER (reason <> 'ok') quarantined,
  false completed, 'interrupted' status FROM batched"""

ORACLES["batch_report"] = f"""WITH {RECORDS}, {MIXED}, {BATCHED}
SELECT 'run' run_id, batch_id, count(*) fetched, count(*) FILTER (reason = 'ok') upserted,
  count(*) FILTER (reason <> 'ok') quarantined FROM batched GROUP BY batch_id"""

ORACLES["reconcile"] = """SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN e.vec_id IS NULL THEN 'extra'
  WHEN e.label = l.quality THEN 'same' ELSE 'changed' END status, count(*) AS rows
FROM embeddings e FULL OUTER JOIN labels l ON e.vec_id = l.doc_id GROUP BY 1"""

# -- updates, pages and batches ------------------------------------------------

ORACLES["upsert_updates"] = f"""
SELECT vec_id::varchar id, {_dense('embedding')}, CASE WHEN vec_id < 10 THEN label + 100 ELSE label END AS label
FROM embeddings
UNION ALL SELECT 'new', {_dense('embedding')}, label + 100 FROM embeddings WHERE vec_id = 0"""

ORACLES["quarantine_pages"] = f"""WITH {RECORDS}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS i FROM records)
SELECT id, CASE WHEN embedding IS NULL THEN 'missing_embedding' ELSE 'bad_payload' END AS reason,
  CASE WHEN embedding IS NOT NULL THEN '{{"lang":"' || lang || '","source":"' || source || '"' END AS payload
FROM placed WHERE embedding IS NULL OR i % 3 = 0"""

ORACLES["pages_duplicate_ids"] = """SELECT (doc_id % 100 % 40 + doc_id % 3 * 1000)::varchar id, max(doc_id) doc_id
FROM documents GROUP BY 1"""

ORACLES["migrate_batches"] = f"""WITH {RECORDS}, {CORPUS}
SELECT r.id, len(r.embedding)::int dim, w.pos, w.idx, w.weight
FROM records r JOIN weights w USING (doc_id) WHERE r.embedding IS NOT NULL"""


# -- further operators of the same data ------------------------------------------

ORACLES["sink_connector"] = ORACLES["sink_record"]
ORACLES["observed_quarantine"] = ORACLES["quarantine_counts"]
ORACLES["reconcile_by_tree"] = ORACLES["reconcile"]
ORACLES["keyset_layout"] = ORACLES["keyset_page"]
ORACLES["idf_incremental"] = ORACLES["idf_table"]
ORACLES["encoder_loads"] = """SELECT 1::bigint loads_per_task, count(*) AS rows, sum(length(text))::bigint chars
  FROM documents WHERE text <> ''"""
ORACLES["payload_key_sketches"] = f"SELECT *, true distinct_is_near FROM ({ORACLES['payload_key_profile']})"
ORACLES["resume_migration"] = f"""WITH {RECORDS}, n AS (SELECT ceil(count(*) / 100)::bigint n FROM records), placed AS (
  SELECT embedding, n, ('0x' || substr(md5(id), 1, 7))::bigint % n batch_id FROM records, n)
SELECT batch_id, count(*) fetched, count(embedding) upserted, count(*) - count(embedding) quarantined,
  batch_id >= n // 2 resumed FROM placed GROUP BY batch_id, n"""
