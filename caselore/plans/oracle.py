"""The same results as DuckDB SQL over the sample tables, written apart from the operators.

VIEWS are common table expressions with the views they need; ORACLES are the final selects.
"""

from __future__ import annotations

from caselore.functions import vocabulary as V

VIEWS: dict[str, tuple[str, str]] = {}
ORACLES: dict[str, tuple[str, str]] = {}


def view(name: str, needs: str, sql: str) -> None:
    VIEWS[name] = (needs, sql)


def oracle(name: str, needs: str, sql: str) -> None:
    ORACLES[name] = (needs, sql)


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _hash(col: str) -> str:
    return f"to_base64(unhex(sha256({col})))"


NL = "chr(10)"
AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"

# --- cases ----------------------------------------------------------------------------------

view("area_dim", "", r"""
SELECT n_nationkey AS sap_key, r_name AS product_name, 'P' || n_regionkey AS product_id,
       r_name || '\' || n_name AS sap_path,
       CASE WHEN n_nationkey % 4 = 0 THEN r_name ELSE r_name || '\' || n_name || '\topic' END AS topic
FROM nation JOIN region ON n_regionkey = r_regionkey""")

view("cases", "area_dim", rf"""
SELECT 'SR' || o_orderkey AS case_id, a.product_id, a.product_name,
  o_orderdate AS created_ts, l.closed_ts, c_name AS sr_owner, 'Closed' AS sr_status,
  o_orderstatus AS service_request_status, substr(o_orderpriority, 1, 1) AS sr_severity,
  CASE WHEN o_totalprice > 400000 THEN '1' ELSE substr(o_orderpriority, 1, 1) END AS sr_max_severity,
  CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE c_mktsegment || ' ' || o_orderpriority END AS internal_title,
  o_orderdate + INTERVAL 1 DAY AS first_assignment_ts,
  (o_orderkey % 30)::INT AS case_idle_days, (o_custkey % 15)::INT AS communication_idle_days,
  c_acctbal > 9000 AS is_s500, coalesce(l.tasks, 0)::INT AS collaboration_tasks,
  (o_orderkey % 4)::INT AS phone_interactions, coalesce(m.mails, 0)::INT AS email_interactions,
  c_mktsegment AS ir_status, o_orderkey % 7 = 0 AS is_transferred, a.sap_path,
  a.topic AS support_topic_id,
  CASE WHEN instr(a.topic, '\') > 0 THEN substr(a.topic, 1, instr(a.topic, '\') - 1) ELSE a.topic END AS support_topic_l2,
  CASE WHEN instr(a.topic, '\') > 0 THEN substr(a.topic, instr(a.topic, '\') + 1, 1000) ELSE '' END AS support_topic_l3,
  date_diff('day', o_orderdate, {AS_OF})::INT AS case_age
FROM orders
JOIN customer ON c_custkey = o_custkey
JOIN area_dim a ON a.sap_key = c_nationkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS closed_ts, count(*) AS tasks FROM lineitem GROUP BY 1) l ON l.l_orderkey = o_orderkey
LEFT JOIN (SELECT conv_id, count(*) AS mails FROM conversations WHERE role = 'user' GROUP BY 1) m ON m.conv_id = o_orderkey
WHERE o_orderstatus = 'F'""")

CASE_OUT = (f"SELECT * REPLACE ({_stamp('created_ts')} AS created_ts, {_stamp('closed_ts')} AS closed_ts, "
            f"{_stamp('first_assignment_ts')} AS first_assignment_ts) FROM ")
oracle("closed_cases", "cases", CASE_OUT + "cases")
oracle("closed_cases_filtered", "cases", CASE_OUT + "cases WHERE product_id = 'P1' AND case_age <= 1500")
oracle("cases_of_area", "cases", CASE_OUT + r"cases WHERE sap_path = 'ASIA\NATION_17'")
for _name, _n in (("newest_n_per_product", 10), ("newest_many_per_product", 1001)):
    oracle(_name, "cases", CASE_OUT + f"""(SELECT * FROM cases QUALIFY row_number() OVER (
        PARTITION BY product_id ORDER BY created_ts DESC, case_id) <= {_n})""")

# --- threads --------------------------------------------------------------------------------

view("emails", "", """
SELECT 'SR' || conv_id AS ticket_number, TIMESTAMP '2024-01-01' + to_hours(turn) AS created_ts,
  CASE (conv_id + turn) % 10 WHEN 0 THEN 'New File Uploaded for x' WHEN 1 THEN 'Automatic reply: x'
    WHEN 2 THEN NULL WHEN 3 THEN 'a {CREDITCARDPII} b' ELSE 'Re: case ' || conv_id END AS subject,
  CASE (conv_id + turn) % 4 WHEN 1 THEN '<a href="x">' || text || '</a>'
    WHEN 2 THEN 'head From: a To: b ' || text WHEN 3 THEN '<img src=x> ' || text || chr(9) ELSE text END AS description
FROM conversations WHERE role = 'user'""")

view("emails_kept", "emails", "SELECT * FROM emails WHERE " + " AND ".join(
    f"subject NOT LIKE {_quote('%' + t + '%')}" for t in V.EMAIL_SUBJECT_EXCLUSIONS))

view("email_lines", "emails_kept", rf"""
SELECT ticket_number AS case_id, created_ts,
  'Subject: ' || subject || '; Created On: ' || {_stamp('created_ts')} || '; Message: ' ||
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    replace(replace(replace(description, chr(9), ''), chr(10), ''), chr(13), ''),
    'From:(.+?)To:(.+)', '', 'g'), '<img(.+?)>', '', 'g'), '<a(.*?)>', '', 'g'),
    '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS text
FROM emails_kept""")

_THREAD = ("SELECT case_id, 0 AS part_no, string_agg(text, chr(10) || '----' || chr(10) ORDER BY created_ts, text) AS thread "
           "FROM {} GROUP BY case_id")
view("email_threads", "email_lines", _THREAD.format("email_lines"))
oracle("email_filter", "emails_kept", f"SELECT ticket_number, {_stamp('created_ts')} AS created_ts, subject FROM emails_kept")
oracle("email_clean", "email_lines cases", f"""SELECT case_id, {_stamp('created_ts')} AS created_ts, text FROM email_lines
    WHERE case_id IN (SELECT case_id FROM cases)""")
oracle("email_threads", "email_threads", "SELECT * FROM email_threads")
oracle("email_first_k", "email_lines", """SELECT case_id, 0 AS part_no, string_agg(text, '|' ORDER BY created_ts, text) AS pieces
    FROM (SELECT * FROM email_lines QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY created_ts, text) <= 2) GROUP BY case_id""")

view("notes_raw", "", f"""
SELECT 'SR' || conv_id AS ticket_number, TIMESTAMP '2024-01-01' + to_hours(turn) + to_days(day::INT) AS created_ts,
  text || CASE turn % 5 WHEN 0 THEN ' NAMEPII' WHEN 1 THEN ' {{EMAILPII}}' WHEN 2 THEN ' NAME+EMAILPII'
    WHEN 3 THEN ' {'=' * 46}' ELSE '' END AS note_text
FROM conversations, (VALUES (0), (1)) v(day) WHERE role = 'assistant' AND (day = 0 OR turn % 3 = 1)""")
view("notes_latest", "notes_raw", """
SELECT ticket_number AS case_id, note_text, created_ts FROM notes_raw
QUALIFY row_number() OVER (PARTITION BY ticket_number, note_text ORDER BY created_ts DESC) = 1""")


def _scrubbed() -> str:
    out = "note_text"
    for pattern in V.NOTE_PATTERNS:
        out = f"replace({out}, {_quote(pattern)}, '')"
    return out


_COPIES = " || ".join(f"replace(note_text, {_quote(p)}, '')" for p in V.NOTE_PATTERNS)
view("note_lines", "notes_latest",
     f"SELECT case_id, created_ts, {_stamp('created_ts')} || ' | ' || {_scrubbed()} AS text FROM notes_latest")
view("note_threads", "note_lines", _THREAD.format("note_lines"))
oracle("note_latest", "notes_latest", f"SELECT case_id, note_text, {_stamp('created_ts')} AS created_ts FROM notes_latest")
oracle("note_scrub_sequential", "note_lines", f"SELECT case_id, {_stamp('created_ts')} AS created_ts, text FROM note_lines")
oracle("note_scrub_literal", "notes_latest",
       f"SELECT case_id, {_stamp('created_ts')} AS created_ts, {_stamp('created_ts')} || ' | ' || {_COPIES} AS text FROM notes_latest")
oracle("note_threads", "note_threads", "SELECT * FROM note_threads")

_SEP, _PIECE = "chr(10) || '----' || chr(10)", "chr(10) || '---' || chr(10)"
view("docs", "cases email_threads note_threads", f"""
SELECT product_id, c.case_id, 0 AS part_no,
  {NL} || '=== SUPPORT CASE: ' || c.case_id || ' ===' || {NL} || 'Product: ' || product_name || {NL} || 'Area: ' || sap_path
  || {NL} || 'Title: ' || internal_title || {NL} || 'Severity: ' || sr_severity || ' (Max: ' || sr_max_severity || ')'
  || {NL} || 'Resolution Time: ' || case_age || ' days' || {NL} || 'Customer Interactions: ' || email_interactions
  || ' emails, ' || phone_interactions || ' calls' || {NL} || 'Case Age: ' || case_age || ' days' || {NL}
  || 'Idle Days: ' || case_idle_days || ' case, ' || communication_idle_days || ' communication' || {NL} || {NL}
  || '=== CUSTOMER PROBLEM ===' || {NL}
  || coalesce('CUSTOMER COMMUNICATIONS:' || {NL} || replace(e.thread, {_SEP}, {_PIECE}) || {NL} || {NL}, '')
  || coalesce('=== RESOLUTION STEPS ===' || {NL} || replace(n.thread, {_SEP}, {_PIECE}) || {NL}, '') AS content
FROM cases c LEFT JOIN email_threads e ON e.case_id = c.case_id LEFT JOIN note_threads n ON n.case_id = c.case_id""")
oracle("case_documents", "docs", "SELECT * FROM docs")

# --- changes --------------------------------------------------------------------------------

view("corpus", "docs", f"""
SELECT product_id, case_id, part_no, content, {_hash('content')} AS content_hash FROM (
  SELECT product_id, case_id, part_no,
    CASE WHEN product_id <> 'P2' AND substr(case_id, 3)::BIGINT % 3 = 2 THEN content || ' old' ELSE content END AS content
  FROM docs WHERE product_id <> 'P4' AND (product_id = 'P2' OR substr(case_id, 3)::BIGINT % 3 <> 0))""")
view("changes", "docs corpus", f"""
SELECT d.product_id, d.case_id,
  CASE WHEN c.case_id IS NULL THEN 'New' WHEN c.content <> d.content THEN 'Updated' ELSE 'Unchanged' END AS change_type,
  c.content_hash AS old_hash, CASE WHEN c.case_id IS NOT NULL THEN {_hash('d.content')} END AS new_hash
FROM docs d LEFT JOIN corpus c ON c.product_id = d.product_id AND c.case_id = d.case_id""")
view("stats", "changes corpus", """
SELECT p.product_id, coalesce(requested, 0) AS requested, coalesce(new_cases, 0) AS new_cases,
  coalesce(updated_cases, 0) AS updated_cases, coalesce(unchanged_cases, 0) AS unchanged_cases,
  coalesce(existing_cases, 0) AS existing_cases
FROM (SELECT 'P' || r_regionkey AS product_id FROM region) p
LEFT JOIN (SELECT product_id, count(*) AS requested, count(*) FILTER (change_type = 'New') AS new_cases,
    count(*) FILTER (change_type = 'Updated') AS updated_cases, count(*) FILTER (change_type = 'Unchanged') AS unchanged_cases
  FROM changes GROUP BY 1) s USING (product_id)
LEFT JOIN (SELECT product_id, count(*) AS existing_cases FROM corpus GROUP BY 1) e USING (product_id)""")
oracle("content_hash", "", f"SELECT doc_id, {_hash('text')} AS content_hash FROM documents")
oracle("stable_hash", "docs cases", f"""
SELECT d.product_id, d.case_id, part_no, {_hash("replace(replace(content, 'Resolution Time: ' || case_age || ' days' || chr(10), ''), 'Case Age: ' || case_age || ' days' || chr(10), '')")}
  AS content_hash FROM docs d JOIN cases c ON c.case_id = d.case_id""")
oracle("classify_changes", "changes", "SELECT * FROM changes")
oracle("change_stats", "stats", "SELECT * FROM stats")
oracle("work_set_new_only", "docs corpus", "SELECT * FROM docs d WHERE case_id NOT IN (SELECT case_id FROM corpus)")
oracle("work_set_new_or_updated", "docs changes",
       "SELECT d.* FROM docs d WHERE case_id NOT IN (SELECT case_id FROM changes WHERE change_type = 'Unchanged')")
oracle("removed_cases", "corpus cases", """SELECT product_id, case_id FROM corpus
    WHERE case_id NOT IN (SELECT case_id FROM cases WHERE case_age <= 1500)""")
oracle("corpus_upsert", "docs corpus", f"""SELECT * FROM corpus UNION ALL
    SELECT *, {_hash('content')} AS content_hash FROM docs WHERE case_id NOT IN (SELECT case_id FROM corpus)""")
for _name in ("sink_cases", "stream_cases"):
    oracle(_name, "docs", f"SELECT product_id, case_id, part_no, {_hash('content')} AS content_hash FROM docs")

# --- self-help ------------------------------------------------------------------------------

view("products", "", "SELECT 'P' || r_regionkey AS product_id FROM region")
view("sh_files", "", """
SELECT doc_id, 'P' || doc_id % 4 AS product_id, 'P' || doc_id % 4 || '_' || source || '_' || doc_id || '.txt' AS file_name,
  text AS content, TIMESTAMP '2024-01-01' + to_hours(doc_id) AS modified_ts FROM documents""")
view("sh_track", "sh_files", """
SELECT product_id, file_name, CASE k WHEN 1 THEN content WHEN 2 THEN substr(content, 1, length(content) // 2)
    ELSE 'changed ' || content END AS processed_content, TIMESTAMP '2023-12-01' AS last_processed
FROM (SELECT *, CASE WHEN product_id = 'P2' THEN 1 ELSE (doc_id // 4) % 4 END AS k FROM sh_files) WHERE k <> 0""")
view("sh_diff", "sh_files sh_track", r"""
SELECT product_id, file_name, modified_ts, content, last_processed, new_content,
  CASE WHEN prior IS NULL THEN 'new' WHEN regexp_matches(new_content, '[^\s\p{Z}]') THEN 'incremental' ELSE 'unchanged' END AS status
FROM (SELECT f.*, t.processed_content AS prior, t.last_processed,
        CASE WHEN t.processed_content IS NULL THEN f.content WHEN t.processed_content = f.content THEN ''
          WHEN starts_with(f.content, t.processed_content) THEN substr(f.content, length(t.processed_content) + 1)
          ELSE f.content END AS new_content
      FROM sh_files f LEFT JOIN sh_track t ON t.file_name = f.file_name
      WHERE regexp_matches(f.content, '[^\s\p{Z}]'))""")
view("sh_sections", "sh_diff", f"""
SELECT product_id, file_name, status, {NL} || {NL} || '=== SELF-HELP CONTENT UPDATE: ' || title || ' (ProductId: ' || product_id || ') ==='
  || {NL} || 'Source File: ' || file_name || {NL} || 'Update Type: ' || CASE status WHEN 'new' THEN 'NEW FILE' ELSE 'INCREMENTAL UPDATE' END
  || {NL} || 'New Content Length: ' || length(new_content) || ' characters' || {NL} || 'Last Updated: ' || {_stamp('modified_ts')}
  || {NL} || {NL} || new_content || {NL} || {NL} || '=== END ' || title || ' UPDATE ===' || {NL} AS section
FROM (SELECT *, replace(replace(file_name, product_id || '_', ''), '.txt', '') AS title FROM sh_diff WHERE status <> 'unchanged')""")
view("sh_changed", "products sh_files sh_track", """
SELECT product_id, product_id NOT IN (SELECT product_id FROM sh_track) OR product_id IN (
    SELECT f.product_id FROM sh_files f LEFT JOIN sh_track t ON t.file_name = f.file_name
    WHERE t.processed_content IS DISTINCT FROM f.content) AS selfhelp_changed FROM products""")
view("sh_corpus", "products sh_files sh_sections", rf"""
WITH state AS (
  SELECT p.product_id, f.n_files, s.first_file,
    CASE WHEN substr(p.product_id, 2)::INT % 2 = 1 THEN 'stored text of ' || r_name || ' ' || {NL} || {NL} END AS stored
  FROM products p JOIN region ON 'P' || r_regionkey = p.product_id
  LEFT JOIN (SELECT product_id, count(*) AS n_files FROM sh_files GROUP BY 1) f USING (product_id)
  LEFT JOIN (SELECT product_id, min(file_name) AS first_file FROM sh_sections GROUP BY 1) s USING (product_id))
SELECT product_id, 'selfhelp' AS doc_kind, 0 AS part, '' AS file_name,
  CASE WHEN first_file IS NULL THEN stored ELSE rtrim(stored, ' ' || {NL}) END AS content FROM state WHERE stored IS NOT NULL
UNION ALL SELECT product_id, 'selfhelp', 0, '', '=== EXISTING SELF-HELP DOCUMENTATION FOR PRODUCT ' || product_id || ' ===' || {NL} || {NL}
  || 'Product ID: ' || product_id || {NL} || 'Content Type: Self-Help Documentation (Content-Diff Tracking)' || {NL}
  || 'Total Files Monitored: ' || n_files || {NL} || 'Last Updated: 2002-01-01 00:00:00' || {NL} || {NL}
  FROM state WHERE stored IS NULL AND first_file IS NOT NULL
UNION ALL SELECT product_id, 'selfhelp', 2, '', CASE WHEN stored IS NULL
    THEN {NL} || '=== END ALL SELF-HELP CONTENT FOR PRODUCT ' || product_id || ' ==='
    ELSE {NL} || '=== CONTENT-DIFF UPDATE COMPLETED: 2002-01-01 00:00:00 ===' END
  FROM state WHERE first_file IS NOT NULL
UNION ALL SELECT product_id, 'placeholder', 0, '', '=== NO EXISTING SELF-HELP CONTENT FOUND FOR PRODUCT ' || product_id || ' ===' || {NL} || {NL}
  || 'Product ID: ' || product_id || {NL} || 'Expected File Pattern: Selfhelp\' || product_id || '_*.txt' || {NL}
  || 'Status: No existing self-help content found' || {NL} || {NL}
  || 'This indicates there may be limited or no existing self-help documentation for this product.' || {NL}
  || 'analysis should focus on identifying the most critical content gaps.' FROM state WHERE n_files IS NULL
UNION ALL SELECT product_id, 'selfhelp', 1, file_name, section || {NL} FROM sh_sections""")
oracle("selfhelp_changed", "sh_changed", "SELECT * FROM sh_changed")
oracle("selfhelp_diff", "sh_diff", "SELECT product_id, file_name, status, new_content FROM sh_diff")
oracle("selfhelp_sections", "sh_sections", "SELECT * FROM sh_sections")
for _name in ("selfhelp_tracking_after", "sink_tracking"):
    oracle(_name, "sh_diff sh_track", f"""
SELECT product_id, file_name, processed_content, {_stamp('last_processed')} AS last_processed, length(processed_content)::INT AS content_length
FROM (SELECT * FROM sh_track WHERE product_id NOT IN (SELECT product_id FROM sh_diff WHERE status <> 'unchanged')
  UNION ALL SELECT product_id, file_name, content, CASE status WHEN 'unchanged' THEN last_processed ELSE {AS_OF} END
  FROM sh_diff WHERE product_id IN (SELECT product_id FROM sh_diff WHERE status <> 'unchanged'))""")
oracle("selfhelp_corpus", "sh_corpus", "SELECT * FROM sh_corpus")
oracle("sink_selfhelp", "sh_corpus",
       f"SELECT product_id, doc_kind, part, file_name, {_hash('content')} AS content_hash FROM sh_corpus")
oracle("corpus_union", "sh_corpus corpus", f"""
SELECT product_id, 'case' AS doc_kind, case_id AS doc_key, part_no AS part, content_hash FROM corpus
UNION ALL SELECT product_id, doc_kind, file_name, part, {_hash('content')} FROM sh_corpus""")
oracle("tracking_maps", "sh_track", f"""SELECT product_id, file_name, processed_content, {_stamp('last_processed')} AS last_processed,
    length(processed_content)::INT AS content_length FROM sh_track""")
oracle("stream_selfhelp", "sh_track sh_files", rf"""
WITH steps AS (
  SELECT f.product_id, f.file_name, t.processed_content AS new_content, 'new' AS status, t.last_processed AS seen_at
  FROM sh_files f JOIN sh_track t ON t.file_name = f.file_name WHERE regexp_matches(t.processed_content, '[^\s\p{{Z}}]')
  UNION ALL
  SELECT f.product_id, f.file_name, CASE WHEN starts_with(f.content, t.processed_content)
      THEN substr(f.content, length(t.processed_content) + 1) ELSE f.content END,
    CASE WHEN t.file_name IS NULL OR NOT regexp_matches(t.processed_content, '[^\s\p{{Z}}]') THEN 'new' ELSE 'incremental' END, f.modified_ts
  FROM sh_files f LEFT JOIN sh_track t ON t.file_name = f.file_name
  WHERE regexp_matches(f.content, '[^\s\p{{Z}}]') AND t.processed_content IS DISTINCT FROM f.content),
named AS (SELECT *, replace(replace(file_name, product_id || '_', ''), '.txt', '') AS title FROM steps
  WHERE regexp_matches(new_content, '[^\s\p{{Z}}]'))
SELECT product_id, file_name, status, {_hash(f"""{NL} || {NL} || '=== SELF-HELP CONTENT UPDATE: ' || title || ' (ProductId: ' || product_id || ') ==='
  || {NL} || 'Source File: ' || file_name || {NL} || 'Update Type: ' || CASE status WHEN 'new' THEN 'NEW FILE' ELSE 'INCREMENTAL UPDATE' END
  || {NL} || 'New Content Length: ' || length(new_content) || ' characters' || {NL} || 'Last Updated: ' || {_stamp('seen_at')}
  || {NL} || {NL} || new_content || {NL} || {NL} || '=== END ' || title || ' UPDATE ===' || {NL}""")} AS section_hash FROM named""")

# --- decisions ------------------------------------------------------------------------------

view("index_track", "", f"""
SELECT 'P' || r_regionkey AS product_id, CASE WHEN r_regionkey <> 4 THEN {AS_OF} - to_days((3 * r_regionkey)::INT) END AS last_full,
  4 * r_regionkey AS increments FROM region""")


def _decision(forced: bool) -> str:
    idle = "FALSE" if forced else "existing_cases > 0 AND new_cases = 0 AND updated_cases = 0 AND NOT selfhelp_changed"
    other = "'Force reindex requested by user'" if forced else """'Changes detected: ' || concat_ws(', ',
        CASE WHEN new_cases > 0 THEN new_cases || ' new cases' END, CASE WHEN updated_cases > 0 THEN updated_cases || ' updated cases' END,
        CASE WHEN selfhelp_changed THEN 'self-help content changed' END)"""
    return f"""
SELECT product_id, requested, new_cases, updated_cases, unchanged_cases, existing_cases, selfhelp_changed,
  NOT idle AS should_process, CASE WHEN idle THEN 'UseExisting' ELSE 'Process' END AS decision,
  CASE WHEN existing_cases = 0 THEN 'First time processing - no existing data found'
    WHEN idle THEN 'No changes detected - all ' || requested || ' cases and self-help content unchanged since last processing'
    ELSE {other} END AS reason,
  CASE WHEN idle THEN concat_ws('|', 'No new cases found (analyzed ' || requested || ' cases, all ' || unchanged_cases || ' unchanged)',
    'No case content updates detected', 'Self-help content unchanged',
    'Last processed: ' || {_stamp('last_full')} || ' (' || printf('%.1f', date_diff('second', last_full, {AS_OF}) / 3600.0) || ' hours ago)',
    'Using existing index from: run_' || strftime(last_full, '%Y%m%d')) ELSE '' END AS skip_reasons
FROM (SELECT *, {idle} AS idle FROM stats JOIN sh_changed USING (product_id) JOIN index_track USING (product_id))"""


view("decisions", "stats sh_changed index_track", _decision(False))
oracle("processing_decision", "decisions", "SELECT * FROM decisions")
oracle("processing_decision_forced", "stats sh_changed index_track", _decision(True))
oracle("reindex_policy", "index_track", f"""
SELECT product_id, last_full IS NULL OR increments > 10 OR date_diff('second', last_full, {AS_OF}) > 604800 AS full_reindex,
  CASE WHEN last_full IS NULL THEN 'First time indexing' WHEN increments > 10 THEN 'Too many incremental updates'
    WHEN date_diff('second', last_full, {AS_OF}) > 604800 THEN 'Weekly reindex schedule' ELSE 'Requested full reindex' END AS reason
FROM index_track""")

# --- answers --------------------------------------------------------------------------------

view("parts", "", """
SELECT *, p_partkey // 40 AS a, 'A' || p_partkey // 40 AS analysis_id, 'P' || (p_partkey // 40) % 5 AS product_id,
  (p_partkey % 40) // 10 + 1 AS question, (p_partkey % 10)::INT AS slot, upper(p_type || ' ' || p_name) AS problem,
  upper(p_brand) AS failure_mode, substr(p_brand, 7)::INT AS brand_no, 'TOPIC ' || p_size % 12 AS topic FROM part""")
view("gaps", "parts", r"""
SELECT analysis_id, product_id, question::INT AS query_no, slot AS item_no,
  substr(sha256(analysis_id || '|' || question || '|' || slot), 1, 32) AS gap_id, problem AS problem_area, p_brand AS issue_category,
  CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE coalesce(n, 0) END::INT AS frequency,
  p_partkey % 7 <> 0 AND p_partkey % 2 = 0 AS customer_solvable, p_name AS suggested_title,
  CASE WHEN p_partkey % 7 = 0 THEN 5 ELSE 1 + p_size % 10 END::INT AS impact,
  coalesce(cited, []) AS related, CASE WHEN p_partkey % 2 = 0 THEN 'Area\' || p_type ELSE '' END AS related_paths
FROM parts
LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) c ON c.l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey, list('SR' || l_orderkey ORDER BY l_orderkey) AS cited FROM (
    SELECT DISTINCT l_partkey, l_orderkey FROM lineitem) GROUP BY 1) r ON r.l_partkey = p_partkey
WHERE (a * 8 + question) % 13 <> 0 AND (a * 8 + question) % 11 <> 0""")
view("modes", "parts", """
SELECT *, (severity * occurrence * detectability)::INT AS rpn FROM (
  SELECT analysis_id, product_id, (question + 4)::INT AS query_no, slot AS item_no, failure_mode, p_type || ' cause' AS failure_cause,
    p_type || ' effect' AS failure_effect,
    CASE WHEN p_partkey % 7 = 0 THEN 5 ELSE 1 + p_size % 10 END::INT AS severity,
    CASE WHEN p_partkey % 7 = 0 THEN 5 ELSE 1 + p_partkey % 10 END::INT AS occurrence,
    CASE WHEN p_partkey % 7 = 0 THEN 5 ELSE 1 + (p_partkey // 10) % 10 END::INT AS detectability,
    CASE WHEN p_size % 2 = 0 THEN 'control ' || p_size ELSE '' END AS existing_controls,
    CASE WHEN p_partkey % 3 <> 0 THEN 'inspect ' || p_name || '|replace ' || p_type ELSE '' END AS recommended_actions
  FROM parts WHERE (a * 8 + question + 4) % 13 <> 0 AND (a * 8 + question + 4) % 11 <> 0)""")
view("prevention", "parts", """
SELECT analysis_id, product_id, (question + 4)::INT AS query_no,
  (row_number() OVER (PARTITION BY analysis_id, question ORDER BY slot) - 1)::INT AS item_no, failure_mode,
  p_type AS prevention_type, 'check ' || p_name AS recommended_control, p_partkey % 20 <> 0 AND p_partkey % 8 = 0 AS customer_actionable,
  CASE WHEN p_partkey % 12 = 0 THEN p_name ELSE '' END AS content_needed
FROM parts WHERE p_partkey % 4 = 0 AND (a * 8 + question + 4) % 13 <> 0 AND (a * 8 + question + 4) % 11 <> 0""")
view("risks", "modes", """
SELECT analysis_id, product_id, query_no, item_no, failure_mode, rpn, CASE WHEN rpn > 200 THEN 'Critical' ELSE 'High' END AS risk_level,
  CASE WHEN recommended_actions = '' THEN 'Review and assess' ELSE split_part(recommended_actions, '|', 1) END AS immediate_action
FROM modes WHERE rpn > 100""")
_PLACE = "row_number() OVER (PARTITION BY analysis_id ORDER BY query_no, item_no)::INT"
view("recs", "gaps risks", f"""
SELECT *, substr(sha256(analysis_id || '|' || seq), 1, 32) AS recommendation_id FROM (
  SELECT analysis_id, product_id, seq, 'Self-Help Content Creation' AS category, 'Create ' || suggested_title AS title,
    'Address ' || problem_area || ' issues that appear in ' || frequency || ' cases' AS description,
    CASE WHEN impact > 7 THEN 'High' WHEN impact > 4 THEN 'Medium' ELSE 'Low' END AS priority, impact, 'Content Team' AS action_owner,
    'Reduce support cases for ' || problem_area || ' by enabling customer self-service' AS expected_outcome
  FROM (SELECT *, {_PLACE} AS seq FROM gaps WHERE customer_solvable) WHERE seq <= 5
  UNION ALL
  SELECT analysis_id, product_id, seq + 5, 'Risk Mitigation', 'Implement controls for ' || failure_mode, immediate_action, risk_level,
    (rpn // 100)::INT, 'Engineering Team', 'Reduce occurrence and impact of ' || failure_mode
  FROM (SELECT *, {_PLACE} AS seq FROM risks) WHERE seq <= 3)""")
oracle("parse_gaps", "gaps", "SELECT * EXCLUDE (related), array_to_string(related, '|') AS related_cases FROM gaps")
oracle("parse_fmea", "modes", "SELECT * FROM modes")
oracle("prevention_opportunities", "prevention", "SELECT * FROM prevention")
_QUESTIONS = "[" + ", ".join(_quote(q) for q in V.GAP_QUESTIONS + V.FMEA_QUESTIONS) + "]"
oracle("answer_failures", "parts", f"""
SELECT DISTINCT analysis_id, product_id, q::INT AS query_no, {_QUESTIONS}[q] AS query FROM (
  SELECT *, unnest([question, question + 4]) AS q FROM parts) WHERE (a * 8 + q) % 13 <> 0 AND (a * 8 + q) % 11 = 0""")
oracle("high_risk", "risks", "SELECT * FROM risks")
oracle("recommendations", "recs", "SELECT * FROM recs")
oracle("gap_top5", "gaps", f"""SELECT analysis_id, place, suggested_title, frequency, impact FROM (SELECT *, {_PLACE} AS place FROM gaps)
    WHERE place <= 5""")
oracle("risk_top5", "risks", f"""SELECT analysis_id, place, failure_mode, rpn, risk_level FROM (SELECT *, {_PLACE} AS place FROM risks)
    WHERE place <= 5""")
oracle("recs_by_category", "recs", """SELECT analysis_id, category, min(seq) AS group_seq, count(*) AS n, max(impact) AS top_impact
    FROM recs GROUP BY 1, 2""")

# --- graph inputs ---------------------------------------------------------------------------

view("lp", "parts", "SELECT * FROM lineitem JOIN parts ON l_partkey = p_partkey")
view("ents", "lp parts", """
SELECT analysis_id, 'SR' || l_orderkey AS case_id, 'CASE_PROBLEM' AS type, problem AS name FROM lp
UNION ALL SELECT analysis_id, 'SR' || l_orderkey, 'FAILURE_MODE', failure_mode FROM lp
UNION ALL SELECT analysis_id, 'SR' || l_orderkey, 'FAILURE_CAUSE', 'S' || l_suppkey FROM lp
UNION ALL SELECT analysis_id, NULL, 'SELFHELP_TOPIC', topic FROM parts WHERE p_type IN ('PROMO', 'SMALL', 'LARGE')""")
view("rels", "lp parts", """
SELECT analysis_id, 'S' || l_suppkey AS source, failure_mode AS target, 'TRIGGERS' AS type, (1 + l_linenumber % 10)::INT AS strength FROM lp
UNION ALL SELECT analysis_id, failure_mode, l_returnflag || l_linestatus, 'RESULTS_IN', (1 + l_linenumber % 10)::INT FROM lp
UNION ALL SELECT analysis_id, 'PC ' || failure_mode, failure_mode, 'PREVENTS', 5 FROM parts WHERE (brand_no + a) % 2 = 0
UNION ALL SELECT analysis_id, 'DC ' || failure_mode, failure_mode, 'DETECTS', 6 FROM parts WHERE (brand_no + a) % 3 = 0
UNION ALL SELECT analysis_id, failure_mode, 'CUSTOMER', 'PREVENTABLE_BY_CUSTOMER', 7 FROM parts WHERE (brand_no + a) % 4 = 1
UNION ALL SELECT analysis_id, problem, topic, 'COVERED_BY', 9 FROM parts WHERE p_type IN ('PROMO', 'SMALL')
UNION ALL SELECT analysis_id, problem, topic, 'PARTIALLY_COVERED_BY', 7 FROM parts
  WHERE p_type = 'LARGE' OR (p_type = 'SMALL' AND p_size % 5 = 0)""")
view("problems", "ents", "SELECT DISTINCT analysis_id, name AS problem FROM ents WHERE type = 'CASE_PROBLEM'")
view("uncovered", "problems rels", """
SELECT * FROM problems p WHERE NOT EXISTS (SELECT 1 FROM rels r WHERE r.analysis_id = p.analysis_id AND r.source = p.problem
  AND r.type IN ('COVERED_BY', 'PARTIALLY_COVERED_BY'))""")
view("scores", "problems rels", """
SELECT p.analysis_id, count(*) AS n_problems,
  round(sum(CASE WHEN s.ful THEN 1.0::DOUBLE WHEN NOT s.ful THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) / count(*), 6) AS coverage_score
FROM problems p LEFT JOIN (SELECT analysis_id, source, bool_or(type = 'COVERED_BY') AS ful FROM rels
  WHERE type IN ('COVERED_BY', 'PARTIALLY_COVERED_BY') GROUP BY 1, 2) s ON s.analysis_id = p.analysis_id AND s.source = p.problem
GROUP BY 1""")
view("risk_scores", "parts modes", """
SELECT analysis_id, coalesce((20 * sum(rpn)::BIGINT + count(rpn)) // nullif(2 * count(rpn), 0) / 100.0::DOUBLE, 0.0) AS risk_score FROM (SELECT DISTINCT analysis_id FROM parts)
LEFT JOIN modes USING (analysis_id) GROUP BY 1""")
view("freq", "ents", "SELECT analysis_id, name AS problem, count(DISTINCT case_id) AS cases FROM ents WHERE type = 'CASE_PROBLEM' GROUP BY 1, 2")
view("rolled", "rels", "SELECT analysis_id, source, target, type, max(strength) AS strength, count(*) AS mentions FROM rels GROUP BY ALL")
view("dist", "ents", "SELECT analysis_id, type, count(*) AS mentions FROM ents GROUP BY 1, 2")

oracle("coverage", "rels", """
SELECT analysis_id, target AS topic, string_agg(DISTINCT source, '|' ORDER BY source) AS covered_issues,
  bool_or(type = 'PARTIALLY_COVERED_BY') AS needs_update,
  CASE WHEN bool_or(type = 'PARTIALLY_COVERED_BY') THEN 'Partial' ELSE 'Full' END AS quality
FROM rels WHERE type IN ('COVERED_BY', 'PARTIALLY_COVERED_BY') GROUP BY 1, 2""")
oracle("coverage_score", "scores", "SELECT * FROM scores")
oracle("uncovered_problems", "uncovered", "SELECT * FROM uncovered")
oracle("high_priority_needs", "gaps", "SELECT analysis_id, query_no, item_no, suggested_title FROM gaps WHERE impact > 7")
oracle("detection_gaps", "modes rels", """
SELECT DISTINCT analysis_id, failure_mode, '' AS current_method, 'No detection control' AS recommendation FROM modes m
WHERE NOT EXISTS (SELECT 1 FROM rels r WHERE r.type = 'DETECTS' AND r.analysis_id = m.analysis_id AND r.target = m.failure_mode)""")
oracle("control_gaps", "rels", """
SELECT DISTINCT analysis_id, source AS failure_mode, EXISTS (SELECT 1 FROM rels c WHERE c.type = 'PREVENTABLE_BY_CUSTOMER'
    AND c.analysis_id = e.analysis_id AND c.source = e.source) AS preventable_by_customer
FROM rels e WHERE type = 'RESULTS_IN' AND NOT EXISTS (SELECT 1 FROM rels p WHERE p.type = 'PREVENTS'
    AND p.analysis_id = e.analysis_id AND p.target = e.source)""")
oracle("risk_score", "risk_scores", "SELECT * FROM risk_scores")
oracle("gap_case_check", "gaps cases", """
SELECT analysis_id, gap_id, count(ref)::INT AS cited, count(c.case_id)::INT AS found, coalesce(min(c.sr_severity), '') AS severity_level,
  count(c.case_id) >= 2 AS confirmed
FROM (SELECT analysis_id, gap_id, unnest(CASE WHEN len(related) = 0 THEN [NULL] ELSE related END) AS ref FROM gaps)
LEFT JOIN cases c ON c.case_id = ref GROUP BY 1, 2""")
oracle("type_distribution", "dist", "SELECT * FROM dist")
oracle("issue_distribution", "gaps", "SELECT analysis_id, issue_category, sum(frequency)::BIGINT AS cases FROM gaps GROUP BY 1, 2")
oracle("problem_frequency", "freq", "SELECT * FROM freq")
for _name in ("relationship_insights", "graph_merge_relations"):
    oracle(_name, "rolled", "SELECT * FROM rolled")
oracle("graph_csv", "rolled", """SELECT analysis_id || ' "x"' || chr(10) || source AS source, target, type, strength FROM rolled""")
oracle("failure_chains", "rolled", """
SELECT t.analysis_id, t.source AS cause, t.target AS failure_mode, r.target AS effect, least(t.strength, r.strength) AS strength
FROM rolled t JOIN rolled r ON r.analysis_id = t.analysis_id AND r.source = t.target WHERE t.type = 'TRIGGERS' AND r.type = 'RESULTS_IN'""")
oracle("gap_ranking", "freq uncovered gaps", """
SELECT analysis_id, row_number() OVER (PARTITION BY analysis_id ORDER BY score DESC, problem)::INT AS rank, problem, cases, score
FROM (SELECT analysis_id, problem, cases, cases * impact AS score FROM freq JOIN uncovered USING (analysis_id, problem)
  JOIN (SELECT analysis_id, upper(problem_area) AS problem, max(impact) AS impact FROM gaps GROUP BY 1, 2 HAVING bool_or(customer_solvable)) g
  USING (analysis_id, problem) WHERE cases >= 2)
QUALIFY rank <= 5""")

# --- chunks, records, mentions --------------------------------------------------------------

view("chunked", "", r"""
SELECT doc_id, (s // 1100)::INT AS chunk_no, len(tokens[s + 1 : s + 1200])::INT AS n_tokens,
  array_to_string(tokens[s + 1 : s + 1200], ' ') AS text
FROM (SELECT doc_id, tokens, unnest(range(0, greatest(len(tokens) - 101, 0) + 1, 1100)) AS s FROM (
  SELECT doc_id, regexp_split_to_array(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+') AS tokens FROM documents
  WHERE regexp_matches(text, '\S')))""")
oracle("chunks", "chunked", "SELECT * FROM chunked")
view("rec_rels", "lp", """
SELECT analysis_id, 'SR' || l_orderkey AS doc_id, CASE WHEN l_linenumber = 4 THEN problem ELSE 'S' || l_suppkey END AS source,
  failure_mode AS target, CASE WHEN l_linenumber = 6 THEN NULL ELSE 'TRIGGERS' END AS type,
  CASE WHEN l_linenumber = 6 THEN 'CAUSES' ELSE 'TRIGGERS' END || ': cause of the mode' AS description,
  (1 + (l_linenumber + l_suppkey) % 11)::DOUBLE AS strength
FROM lp WHERE (l_orderkey + l_linenumber) % 10 <> 0""")
view("rec_ents", "lp", """
SELECT analysis_id, 'SR' || l_orderkey AS doc_id, problem AS name, CASE WHEN l_linenumber = 7 THEN 'WIDGET' ELSE 'CASE_PROBLEM' END AS type,
  'CASE_SOURCE problem in SR' || l_orderkey AS description, 'CASE_SOURCE' AS marker FROM lp
UNION ALL SELECT analysis_id, 'SR' || l_orderkey, failure_mode, 'FAILURE_MODE', 'CASE_SOURCE mode', 'CASE_SOURCE' FROM lp
UNION ALL SELECT analysis_id, 'SR' || l_orderkey, 'S' || l_suppkey, 'FAILURE_CAUSE', 'no marker', NULL FROM lp""")
oracle("record_entities", "rec_ents", "SELECT * FROM rec_ents")
oracle("record_relations", "rec_rels", "SELECT * FROM rec_rels")
oracle("malformed_records", "lp", """SELECT analysis_id, count(*) FILTER ((l_orderkey + l_linenumber) % 10 = 0) AS malformed,
    count(*) * 4 AS records FROM lp GROUP BY 1""")
oracle("vocabulary_violations", "rec_ents rec_rels", """
SELECT analysis_id, doc_id, 'entity type' AS violation, name AS subject FROM rec_ents WHERE type = 'WIDGET'
UNION ALL SELECT analysis_id, doc_id, 'relation type', source || ' -> ' || target FROM rec_rels WHERE type IS NULL
UNION ALL SELECT analysis_id, doc_id, 'strength', source || ' -> ' || target FROM rec_rels WHERE type IS NOT NULL AND strength > 10
UNION ALL SELECT analysis_id, doc_id, 'source type', source || ' -> ' || target FROM rec_rels r WHERE type IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM rec_ents e WHERE e.analysis_id = r.analysis_id AND e.name = r.source AND e.type = 'FAILURE_CAUSE')
UNION ALL SELECT analysis_id, doc_id, 'target type', source || ' -> ' || target FROM rec_rels r WHERE type IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM rec_ents e WHERE e.analysis_id = r.analysis_id AND e.name = r.target AND e.type = 'FAILURE_MODE')""")

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda w: w <> '')"
_TYPES = "[" + ", ".join(_quote(t) for t in V.ENTITY_TYPES) + "]"
view("lexicon", "", f"""
SELECT DISTINCT term, {_TYPES}[length(term) % 23 + 1] AS type FROM (
  SELECT unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS term
  FROM (SELECT {_WORDS} AS words FROM benchmark))""")
view("tokens", "chunked", f"""
SELECT doc_id, chunk_no, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM (
  SELECT doc_id, chunk_no, {_WORDS} AS words FROM chunked)""")
view("ment", "tokens lexicon", """
SELECT doc_id, chunk_no, term, type, count(*) AS n FROM (
  SELECT doc_id, chunk_no, unnest([w, w || ' ' || lead(w, 1) OVER p]) AS term
  FROM tokens WINDOW p AS (PARTITION BY doc_id, chunk_no ORDER BY pos)) JOIN lexicon USING (term) GROUP BY ALL""")
view("cooc", "ment", """
SELECT x.term AS source, y.term AS target, count(*) AS shared, least(count(*), 10)::INT AS strength
FROM ment x JOIN ment y ON x.doc_id = y.doc_id AND x.chunk_no = y.chunk_no AND x.term < y.term GROUP BY 1, 2""")
oracle("mentions", "ment", "SELECT * FROM ment")
oracle("cooccurrence", "cooc", "SELECT * FROM cooc")
oracle("entity_insights", "ment cooc", """
SELECT type, term AS name, frequency, related FROM (SELECT type, term, count(*) AS frequency FROM ment GROUP BY 1, 2)
LEFT JOIN (SELECT source AS name, target AS related FROM cooc UNION SELECT target, source FROM cooc) r ON r.name = term""")

# --- components -----------------------------------------------------------------------------

view("edges", "parts", "SELECT analysis_id, analysis_id || '/' || problem AS src, analysis_id || '/' || failure_mode AS dst FROM parts")


def _components(edges: str) -> str:
    return f"""
WITH RECURSIVE both_ways AS (SELECT src AS x, dst AS y FROM {edges} UNION SELECT dst, src FROM {edges}),
reach AS (SELECT x AS node, x AS other FROM both_ways UNION SELECT r.node, b.y FROM reach r JOIN both_ways b ON b.x = r.other)
SELECT node, min(other) AS component FROM reach GROUP BY 1"""


view("comps", "edges", f"SELECT split_part(node, '/', 1) AS analysis_id, node, component FROM ({_components('edges')})")
oracle("components", "comps", "SELECT * FROM comps")
oracle("community_stats", "comps edges problems uncovered modes", """
SELECT analysis_id, component, count(*) AS nodes, coalesce(sum(e.n), 0)::BIGINT AS edges, count(p.problem) AS case_problems,
  count(u.problem) AS uncovered, coalesce(max(m.rpn), 0) AS max_rpn, round(coalesce(max(m.rpn), 0) / 100.0::DOUBLE, 1) AS priority
FROM comps c
LEFT JOIN (SELECT src, count(DISTINCT dst) AS n FROM edges GROUP BY 1) e ON e.src = c.node
LEFT JOIN problems p ON p.analysis_id || '/' || p.problem = c.node
LEFT JOIN uncovered u ON u.analysis_id || '/' || u.problem = c.node
LEFT JOIN (SELECT analysis_id || '/' || failure_mode AS node, max(rpn) AS rpn FROM modes GROUP BY 1) m ON m.node = c.node
GROUP BY c.analysis_id, component""".replace("SELECT analysis_id, component,", "SELECT c.analysis_id, component,", 1))
oracle("community_reports", "comps", """
SELECT component, component AS title, 'size ' || n AS description, CASE WHEN n % 12 <= 10 THEN (n % 12)::DOUBLE END AS rating,
  array_to_string(list_transform(range(1, least(n, 3) + 1), lambda i: 'finding ' || i), '|') AS key_findings,
  array_to_string(list_transform(range(1, least(n, 3) + 1), lambda i: 'do ' || i), '|') AS actions
FROM (SELECT component, count(*) AS n FROM comps GROUP BY 1)""")
view("returned", "lp", """SELECT analysis_id, problem AS name, count(*) FILTER (l_returnflag = 'R') AS r,
    count(*) FILTER (l_returnflag <> 'R') AS k FROM lp GROUP BY 1, 2""")
oracle("graph_merge_entities", "returned", """SELECT analysis_id, 'CASE_PROBLEM' AS type, name,
    CASE WHEN r > 0 THEN 'new ' || r ELSE 'old ' || k END AS description FROM returned""")
view("half_edges", "edges", "SELECT * FROM edges WHERE src < split_part(src, '/', 1) || '/M'")
oracle("graph_merge_embeddings", "", """SELECT CASE k WHEN 2 THEN -vec_id - 1 ELSE vec_id END AS vec_id,
  CASE k WHEN 0 THEN 'first' ELSE 'second' END AS run, len(embedding)::INT AS dims,
  (CASE k WHEN 0 THEN embedding[1] ELSE embedding[-1] END)::DOUBLE AS first,
  (CASE k WHEN 0 THEN embedding[-1] ELSE embedding[1] END)::DOUBLE AS last
FROM (SELECT *, unnest(CASE WHEN vec_id % 6 = 0 THEN [1, 2] WHEN vec_id % 3 = 0 THEN [1] ELSE [0] END) AS k FROM embeddings)""")
oracle("graph_merge_components", "comps half_edges", f"""SELECT node, c.component, o.component AS old_component FROM comps c
    LEFT JOIN ({_components('half_edges')}) o USING (node)""")

# --- retrieval ------------------------------------------------------------------------------

oracle("knn_cosine", "", """
WITH means AS (SELECT label, list(m ORDER BY i) AS vector FROM (
    SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY 1, 2) GROUP BY 1),
scored AS (SELECT m.label::BIGINT AS query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], vector), 6) AS score
  FROM embeddings, means m)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5""")
oracle("knn_index", "", """
WITH scored AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score
  FROM embeddings v JOIN embeddings q ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5""")


def _ranking(asked: str) -> str:
    return f"""
WITH asked AS ({asked}),
tf AS (SELECT doc_id, chunk_no, w AS term, count(*) AS tf FROM tokens GROUP BY ALL),
idf AS (SELECT term, ln(((SELECT count(*) FROM chunked) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM tf GROUP BY 1),
scored AS (SELECT question_id, doc_id, chunk_no, round(sum(tf * idf), 6) AS score FROM tf JOIN idf USING (term) JOIN asked USING (term)
  GROUP BY ALL)
SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id, chunk_no)::INT AS rank, doc_id, chunk_no, score
FROM scored QUALIFY rank <= 5"""


_FIXED = ", ".join(f"({i}, {_quote(q)})" for i, q in enumerate(V.GAP_QUESTIONS + V.FMEA_QUESTIONS + V.FOLLOW_UP_QUESTIONS, 1))
oracle("question_ranking", "chunked tokens", _ranking(f"SELECT DISTINCT item_id AS question_id, unnest({_WORDS}) AS term FROM benchmark"))
oracle("fixed_question_ranking", "chunked tokens", _ranking(
    f"SELECT DISTINCT question_id::BIGINT AS question_id, unnest({_WORDS}) AS term FROM (VALUES {_FIXED}) v(question_id, text)"))

# --- reports and records --------------------------------------------------------------------

view("analyses", "parts", "SELECT DISTINCT analysis_id, product_id FROM parts")
view("counts", "analyses gaps risks recs cases scores", """
SELECT a.*, (SELECT count(*) FROM cases c WHERE c.product_id = a.product_id) AS n_cases,
  (SELECT count(*) FROM gaps g WHERE g.analysis_id = a.analysis_id) AS n_gaps,
  (SELECT count(*) FROM risks r WHERE r.analysis_id = a.analysis_id) AS n_risks,
  (SELECT count(*) FROM recs r WHERE r.analysis_id = a.analysis_id) AS n_recs,
  coalesce(s.coverage_score, 0) AS coverage_score
FROM analyses a LEFT JOIN scores s ON s.analysis_id = a.analysis_id""")
view("metric", "analyses ents rels lp", """
SELECT analysis_id, coalesce(e.n, 0) AS n_entities, coalesce(r.n, 0) AS n_relations, coalesce(t.n * 6, 0)::DOUBLE / 60 AS minutes FROM analyses
LEFT JOIN (SELECT analysis_id, count(*) AS n FROM lp GROUP BY 1) t USING (analysis_id)
LEFT JOIN (SELECT analysis_id, count(*) AS n FROM (SELECT DISTINCT analysis_id, type, name FROM ents) GROUP BY 1) e USING (analysis_id)
LEFT JOIN (SELECT analysis_id, count(*) AS n FROM (SELECT DISTINCT analysis_id, source, target, type FROM rels) GROUP BY 1) r USING (analysis_id)""")
oracle("result_counts", "counts metric", """SELECT analysis_id, product_id, n_gaps, n_risks, n_recs, n_entities, n_relations
    FROM counts JOIN metric USING (analysis_id)""")


def _lines(report: str, rows: str, section: str, texts: list[str], rank: str = "0", query: str = "0", item: str = "0") -> str:
    listed = ", ".join(f"({t})" for t in texts)
    return f"""SELECT analysis_id, '{report}' AS report, section_no::INT AS section_no, rank_key::BIGINT AS rank_key, query_no::INT AS query_no,
  item_no::INT AS item_no, (generate_subscripts(lines, 1) - 1)::INT AS line_no, unnest(lines) AS text FROM (
  SELECT analysis_id, {section} AS section_no, {rank} AS rank_key, {query} AS query_no, {item} AS item_no,
    list_filter([{listed}], lambda x: x IS NOT NULL) AS lines FROM {rows})"""


_ITEM = {"query": "query_no", "item": "item_no"}
view("rp1", "counts gaps risks", "\nUNION ALL ".join([
    _lines("executive_summary", "counts", "0", [
        "'# Executive Summary - Analysis'", "'**Product ID:** ' || product_id", "'**Analysis Date:** 2002-01-01 00:00:00'",
        "'**Cases Analyzed:** ' || n_cases", "''", "'## Key Findings'", "'- **Self-Help Gaps Identified:** ' || n_gaps",
        "'- **High-Risk Failure Modes:** ' || n_risks", "'- **Actionable Recommendations:** ' || n_recs",
        "'- **Overall Coverage Score:** ' || printf('%.1f', coverage_score * 100) || '%'", "''", "'## Top 5 Self-Help Content Gaps'"]),
    _lines("executive_summary", f"(SELECT * FROM gaps QUALIFY {_PLACE} <= 5)", "1",
           ["'1. **' || suggested_title || '** - ' || frequency || ' cases, Impact: ' || impact || '/10'"], **_ITEM),
    _lines("executive_summary", "counts", "2", ["''", "'## Top 5 High-Risk Failure Modes'"]),
    _lines("executive_summary", f"(SELECT * FROM risks QUALIFY {_PLACE} <= 5)", "3",
           ["'1. **' || failure_mode || '** - RPN: ' || rpn || ', Risk: ' || risk_level"], **_ITEM)]))
view("rp2", "analyses gaps", "\nUNION ALL ".join([
    _lines("selfhelp_gaps", "analyses", "0", ["'# Self-Help Gap Analysis Report'", "''", "'## Identified Gaps'"]),
    _lines("selfhelp_gaps", "gaps", "1", [
        "'### ' || suggested_title", "'- **Problem Area:** ' || problem_area", "'- **Category:** ' || issue_category",
        "'- **Frequency:** ' || frequency || ' cases'", "'- **Customer Solvable:** ' || CASE WHEN customer_solvable THEN 'Yes' ELSE 'No' END",
        "'- **Estimated Impact:** ' || impact || '/10'",
        "CASE WHEN len(related) > 0 THEN '- **Related Cases:** ' || array_to_string(related[1:5], ', ') END",
        "CASE WHEN related_paths <> '' THEN '- **SAP Paths:** ' || related_paths END", "''"], "-impact", **_ITEM)]))
view("rp3", "analyses risks prevention", "\nUNION ALL ".join([
    _lines("fmea_analysis", "analyses", "0", ["'# FMEA Analysis Report'", "''", "'## High-Risk Items'"]),
    _lines("fmea_analysis", "risks", "1", [
        "'### ' || failure_mode", "'- **Risk Priority Number:** ' || rpn", "'- **Risk Level:** ' || risk_level",
        "'- **Immediate Action:** ' || immediate_action", "''"], "-rpn", **_ITEM),
    _lines("fmea_analysis", "analyses", "2", ["'## Prevention Opportunities'"]),
    _lines("fmea_analysis", "prevention", "3", [
        "'### ' || failure_mode", "'- **Prevention Type:** ' || prevention_type", "'- **Recommended Control:** ' || recommended_control",
        "'- **Customer Actionable:** ' || CASE WHEN customer_actionable THEN 'Yes' ELSE 'No' END",
        "CASE WHEN content_needed <> '' THEN '- **Self-Help Content Needed:** ' || content_needed END", "''"], **_ITEM)]))
view("rp4", "analyses recs", "\nUNION ALL ".join([
    _lines("actionable_recommendations", "analyses", "0", ["'# Actionable Recommendations Report'", "''"]),
    _lines("actionable_recommendations", "(SELECT analysis_id, category, min(seq) AS g FROM recs GROUP BY 1, 2)", "g * 2", ["'## ' || category"]),
    _lines("actionable_recommendations", "(SELECT *, min(seq) OVER (PARTITION BY analysis_id, category) AS g FROM recs)", "g * 2 + 1", [
        "'### ' || title", "'- **Priority:** ' || priority", "'- **Estimated Impact:** ' || impact || '/10'",
        "'- **Description:** ' || description", "'- **Expected Outcome:** ' || expected_outcome", "''"], "-impact", "0", "seq")]))
view("full_metric", "metric comps", """SELECT *, (SELECT count(DISTINCT component) FROM comps c WHERE c.analysis_id = m.analysis_id)
    AS n_communities FROM metric m""")
oracle("report_executive", "rp1", "SELECT * FROM rp1")
oracle("report_gaps", "rp2", "SELECT * FROM rp2")
oracle("report_fmea", "rp3", "SELECT * FROM rp3")
oracle("report_recommendations", "rp4", "SELECT * FROM rp4")
view("rp5", "full_metric dist", "\nUNION ALL ".join([
    _lines("detailed_analysis", "full_metric", "0", [
        "'# Detailed Analysis Report'", "''", "'## Processing Metrics'", "'- **Total Processing Time:** ' || printf('%.1f', minutes) || ' minutes'",
        "'- **Entities Extracted:** ' || n_entities", "'- **Relationships Found:** ' || n_relations",
        "'- **Communities Identified:** ' || n_communities", "''", "'## Entity Distribution'"]),
    _lines("detailed_analysis", "dist", "1", ["'- **' || type || ':** ' || mentions"], "-mentions")]))
oracle("report_detail", "rp5", "SELECT * FROM rp5")
oracle("sink_reports", "rp1 rp2 rp3 rp4 rp5", """SELECT analysis_id, report, (row_number() OVER (PARTITION BY analysis_id, report
    ORDER BY section_no NULLS FIRST, rank_key NULLS FIRST, query_no NULLS FIRST, item_no NULLS FIRST, line_no, text))::INT AS line_no, text
  FROM (SELECT * FROM rp1 UNION ALL SELECT * FROM rp2 UNION ALL SELECT * FROM rp3 UNION ALL SELECT * FROM rp4 UNION ALL SELECT * FROM rp5)""")
_ARRIVAL = "ORDER BY query_no, item_no"
oracle("document_record", "counts gaps risks recs metric", f"""
SELECT c.analysis_id AS id, product_id AS "productId", '2002-01-01 00:00:00' AS "analysisTimestamp", n_cases AS "totalCasesAnalyzed",
  coalesce((SELECT string_agg(suggested_title, '|' {_ARRIVAL}) FROM gaps g WHERE g.analysis_id = c.analysis_id), '') AS gap_titles,
  coalesce((SELECT string_agg(impact::VARCHAR, '|' {_ARRIVAL}) FROM gaps g WHERE g.analysis_id = c.analysis_id), '') AS gap_impacts,
  coalesce((SELECT string_agg(rpn::VARCHAR, '|' {_ARRIVAL}) FROM risks r WHERE r.analysis_id = c.analysis_id), '') AS risk_rpns,
  coalesce((SELECT string_agg(title, '|' ORDER BY seq) FROM recs r WHERE r.analysis_id = c.analysis_id), '') AS rec_titles,
  n_entities, n_relations, minutes, 31536000 AS ttl
FROM counts c JOIN metric m ON m.analysis_id = c.analysis_id""")
for _name in ("metrics_record", "sink_metrics"):
    oracle(_name, "counts metric risk_scores", """
SELECT analysis_id, product_id, '2002-01-01 00:00:00' AS analysis_timestamp, n_cases AS total_cases, n_entities AS total_entities,
  n_relations AS total_relationships, minutes AS processing_minutes, coverage_score, risk_score
FROM counts JOIN metric USING (analysis_id) JOIN risk_scores USING (analysis_id)""")
view("callback", "counts gaps risks", f"""
SELECT 'Success' AS status, analysis_id, product_id, n_cases AS total_cases,
  coalesce((SELECT string_agg(suggested_title, '|' {_ARRIVAL}) FROM (SELECT * FROM gaps QUALIFY {_PLACE} <= 5) g
    WHERE g.analysis_id = c.analysis_id), '') AS top_gaps,
  coalesce((SELECT string_agg(failure_mode, '|' {_ARRIVAL}) FROM (SELECT * FROM risks QUALIFY {_PLACE} <= 5) r
    WHERE r.analysis_id = c.analysis_id), '') AS top_risks, n_recs AS recommendations FROM counts c""")
oracle("callback_summary", "callback", "SELECT * FROM callback")
oracle("existing_result", "decisions analyses", """SELECT product_id, 'analysis_result_20240102_000000' AS run, analysis_id, reason,
    TRUE AS processing_skipped, skip_reasons FROM decisions JOIN analyses USING (product_id) WHERE decision = 'UseExisting'""")
view("covered_topics", "rels", """
SELECT analysis_id, target AS topic, string_agg(DISTINCT source, ',' ORDER BY source) AS issues,
  CASE WHEN bool_or(type = 'PARTIALLY_COVERED_BY') THEN 'Partial' ELSE 'Full' END AS quality
FROM rels WHERE type IN ('COVERED_BY', 'PARTIALLY_COVERED_BY') GROUP BY 1, 2""")
view("checked", "gaps cases", """
SELECT analysis_id, gap_id, coalesce(min(c.sr_severity), '') AS severity_level
FROM (SELECT analysis_id, gap_id, unnest(CASE WHEN len(related) = 0 THEN [NULL] ELSE related END) AS ref FROM gaps)
LEFT JOIN cases c ON c.case_id = ref GROUP BY 1, 2""")
view("undetected", "modes rels", """
SELECT DISTINCT analysis_id, failure_mode FROM modes m
WHERE NOT EXISTS (SELECT 1 FROM rels r WHERE r.type = 'DETECTS' AND r.analysis_id = m.analysis_id AND r.target = m.failure_mode)""")
view("results", "counts gaps modes risks prevention recs full_metric dist covered_topics checked undetected risk_scores scores", f"""
SELECT c.analysis_id, product_id, n_cases,
  coalesce((SELECT string_agg(concat_ws(':', gap_id, severity_level, impact::VARCHAR), '|' {_ARRIVAL})
    FROM (SELECT * FROM gaps JOIN checked USING (analysis_id, gap_id)) g WHERE g.analysis_id = c.analysis_id), '') AS gaps,
  coalesce((SELECT string_agg(topic || ':' || quality || ':' || issues, '|' ORDER BY topic) FROM covered_topics t
    WHERE t.analysis_id = c.analysis_id), '') AS coverage,
  coalesce((SELECT string_agg(coalesce(suggested_title, '-'), '|' {_ARRIVAL}) FROM gaps g WHERE g.analysis_id = c.analysis_id AND impact > 7), '') AS needs,
  c.coverage_score,
  coalesce((SELECT string_agg(concat_ws(':', failure_mode, rpn::VARCHAR), '|' {_ARRIVAL}) FROM modes x WHERE x.analysis_id = c.analysis_id), '') AS modes,
  coalesce((SELECT string_agg(concat_ws(':', failure_mode, risk_level), '|' {_ARRIVAL}) FROM risks x WHERE x.analysis_id = c.analysis_id), '') AS risks,
  (SELECT count(*) FROM prevention x WHERE x.analysis_id = c.analysis_id)::INT AS n_prevention,
  coalesce((SELECT string_agg(failure_mode, '|' ORDER BY failure_mode) FROM undetected x WHERE x.analysis_id = c.analysis_id), '') AS detection_gaps,
  (SELECT risk_score FROM risk_scores x WHERE x.analysis_id = c.analysis_id) AS risk_score,
  coalesce((SELECT string_agg(concat_ws(':', priority, title), '|' ORDER BY seq) FROM recs x WHERE x.analysis_id = c.analysis_id), '') AS recommendations,
  n_communities, minutes,
  (SELECT string_agg(type || '=' || mentions, '|' ORDER BY type) FROM dist d WHERE d.analysis_id = c.analysis_id) AS entity_types,
  coalesce((SELECT string_agg(issue_category || '=' || n, '|' ORDER BY issue_category) FROM (
    SELECT analysis_id, issue_category, sum(frequency)::BIGINT AS n FROM gaps GROUP BY 1, 2) i WHERE i.analysis_id = c.analysis_id), '') AS issues
FROM counts c JOIN full_metric m ON m.analysis_id = c.analysis_id""")
oracle("analysis_result", "results", "SELECT * FROM results")
oracle("sink_result_json", "results", "SELECT *, 'analysis_result_20240102_000000' AS run FROM results")


def _needed(needs: str, seen: dict[str, None]) -> None:
    for name in needs.split():
        if name not in seen:
            _needed(VIEWS[name][0], seen)
            seen[name] = None


def oracle_text(name: str) -> str:
    needs, sql = ORACLES[name]
    seen: dict[str, None] = {}
    _needed(needs, seen)
    if not seen:
        return sql.strip()
    views = ",\n".join(f"{v} AS ({VIEWS[v][1].strip()})" for v in seen)
    return f"WITH RECURSIVE {views}\n SELECT * FROM ({sql.strip()})"


def oracles() -> dict[str, str]:
    return {name: oracle_text(name) for name in ORACLES}
