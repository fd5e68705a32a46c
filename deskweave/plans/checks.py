"""SQL for DuckDB that gives the same result as each registered query.

Written from the meaning of the operators, not from the Spark plans: window functions
where Spark aggregates, list functions where Spark explodes.
"""

from __future__ import annotations

from . import catalog
from .desk_tables import BASE_URL

# Fixed values, written down here a second time so that a wrong pattern of the engine shows:
# (entity, pattern, score) and (pattern, replacement).
ENTITIES = (
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", 1.0),
    (
        "PHONE_NUMBER",
        r"\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9](?:[ .\-]?[0-9]){5,11}",
        0.4,
    ),
    ("IBAN_CODE", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}", 0.6),
    ("IT_FISCAL_CODE", r"[A-Z]{6}[0-9]{2}[ABCDEHLMPRST][0-9]{2}[A-Z][0-9]{3}[A-Z]", 0.8),
)
CONNECTION = (
    r"\b([A-Za-z0-9_.$#]+)/[^/@\s]+@([A-Za-z0-9_.\-]+(?::\d+)?(?:/[A-Za-z0-9_.\-]+)?)",
    r"\1/[REDACTED]@\2",
)
IDENTIFIED = (
    r"(IDENTIFIED\s+BY\s+)(?:VALUES\s+)?(?:'[^']*'|\"[^\"]*\"|[^\s;]+)",
    r"\1[REDACTED]",
)
PASSWORD = (
    r"\b(pass(?:word)?|pwd)\b\s*[:=]\s*(?:'[^']*'|\"[^\"]*\"|\S+)",
    r"\1=[REDACTED]",
)
RULES = (CONNECTION, IDENTIFIED, PASSWORD)

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


INCIDENT = """
incident AS (
  SELECT d.doc_id,
    md5(CAST(d.doc_id AS VARCHAR)) AS sys_id,
    CASE WHEN d.doc_id % 50 = 7 THEN printf('INC/%07d A', d.doc_id)
         ELSE printf('INC%07d', d.doc_id) END AS number,
    'Report from ' || d.source || ' in ' || d.lang AS short_description,
    d.text || CASE d.doc_id % 4
      WHEN 0 THEN ' password=P' || d.doc_id
      WHEN 1 THEN ' IDENTIFIED BY Pw' || d.doc_id || ';'
      WHEN 2 THEN ' scott/Tiger' || d.doc_id || '@db:1521/SALES'
      ELSE '' END AS description,
    d.source AS assignment_group,
    'HD ' || d.source AS assignment_group_name,
    CASE o.o_orderstatus WHEN 'F' THEN '6' WHEN 'P' THEN '7'
         ELSE CASE WHEN o.o_orderkey IS NOT NULL THEN '2' END END AS state,
    o.o_orderpriority AS priority,
    'ci' || CAST(o.o_custkey % 10 AS VARCHAR) AS cmdb_ci,
    e.event_type AS impact,
    CASE WHEN e.value < 10 THEN '1 - High' WHEN e.value < 50 THEN '2 - Medium'
         WHEN e.event_id IS NOT NULL THEN '3 - Low' END AS urgency,
    CASE WHEN e.event_id % 97 = 5 THEN 'not-a-date' WHEN e.event_id % 97 = 6 THEN ''
         ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS closed_at,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS resolved_at,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS sys_updated_on,
    e.ts AS updated_at,
    c.close_notes, c.work_notes, c.comments
  FROM documents d
  LEFT JOIN (
    SELECT * FROM (SELECT *, o_orderkey % (SELECT count(*) FROM documents) AS ticket FROM orders)
    QUALIFY row_number() OVER (
      PARTITION BY ticket ORDER BY o_totalprice DESC NULLS LAST, o_orderkey DESC) = 1
  ) o ON o.ticket = d.doc_id
  LEFT JOIN (
    SELECT * FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS ticket FROM events)
    QUALIFY row_number() OVER (
      PARTITION BY ticket ORDER BY value DESC NULLS LAST, event_id DESC) = 1
  ) e ON e.ticket = d.doc_id
  LEFT JOIN (
    SELECT conv_id,
      arg_max(text, turn) FILTER (WHERE role = 'assistant') AS close_notes,
      coalesce(string_agg(text, '|' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')
        AS work_notes,
      coalesce(string_agg(text, '|' ORDER BY turn, text) FILTER (WHERE role = 'user'), '')
        AS comments
    FROM conversations GROUP BY conv_id
  ) c ON c.conv_id = d.doc_id % (SELECT count(DISTINCT conv_id) FROM conversations)
)"""

DOC_GROUPS = """
desk_group AS (
  SELECT DISTINCT source AS sys_id, 'HD ' || source AS name,
         source NOT LIKE '%5%' AS active
  FROM documents
)"""


def strip(x: str) -> str:
    return f"trim(coalesce({x}, ''), {BLANKS})"


def key(x: str) -> str:
    return rf"regexp_replace({strip(x)}, '[^A-Za-z0-9_\-=]', '_', 'g')"


def closed(x: str) -> str:
    return f"try_strptime({x}, '%Y-%m-%d %H:%M:%S')"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%SZ')"


def apply_rule(x: str, rule) -> str:
    return f"regexp_replace({x}, {_text(rule[0])}, {_text(rule[1])}, 'gi')"


def redacted(x: str, rules=RULES) -> str:
    for rule in rules:
        x = apply_rule(x, rule)
    return x


def cut_bytes(x: str, n: int) -> str:
    cuts = ", ".join(f"try(decode(encode({x})[1:{n - k}]))" for k in range(4))
    return f"CASE WHEN strlen({x}) <= {n} THEN {x} ELSE coalesce({cuts}) END"


def document_ctes(source: str, prefix: str = "") -> str:
    """CTEs that turn a ticket relation into <prefix>document."""
    free = {
        "short_description": "short_description",
        "description": "description",
        "resolution": "close_notes",
        "work_notes": "work_notes",
        "comments": "comments",
    }
    texts = ",\n    ".join(f"{redacted(strip(src))} AS {name}" for name, src in free.items())
    plain = ", ".join(
        f"{strip(c)} AS {c}"
        for c in (
            "number",
            "sys_id",
            "assignment_group",
            "assignment_group_name",
            "priority",
            "impact",
            "urgency",
        )
    )
    return rf"""
{prefix}clean AS (
  SELECT {plain},
    {texts},
    {closed("closed_at")} AS closed_at, updated_at, doc_id,
    '{BASE_URL}/nav_to.do?uri=incident.do?sys_id=' || sys_id AS url
  FROM {source}
),
{prefix}whole AS (
  SELECT *,
    {strip('''concat_ws(chr(10) || chr(10),
      concat_ws(' | ', 'Ticket ' || number, 'Gruppo: ' || assignment_group_name,
        'Chiuso: ' || strftime(closed_at, '%Y-%m-%d'), 'Link: ' || url),
      CASE WHEN short_description <> '' THEN 'Problema: ' || short_description END,
      CASE WHEN description <> '' THEN 'Descrizione: ' || description END,
      CASE WHEN resolution <> '' THEN 'Risoluzione: ' || resolution END,
      CASE WHEN work_notes <> '' THEN 'Note di lavorazione: ' || work_notes END,
      CASE WHEN comments <> '' THEN 'Commenti: ' || comments END)''')} AS content
  FROM {prefix}clean
),
{prefix}document AS (
  SELECT {key("number")} AS id, number, url, short_description, description, resolution, work_notes, comments, content,
    assignment_group, assignment_group_name, priority, impact, urgency, closed_at,
    updated_at, doc_id
  FROM {prefix}whole
)"""


CLOSED_INCIDENT = "closed_incident AS (SELECT * FROM incident WHERE state IN ('6', '7'))"
IN_GROUPS = f"assignment_group IN {_in(catalog.GROUPS)}"
SINCE = f"updated_at >= TIMESTAMP '{catalog.MARK}'"
SINCE_OVERLAP = f"updated_at >= TIMESTAMP '{catalog.MARK}' - INTERVAL 15 MINUTE"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


DOCUMENTS = (INCIDENT, CLOSED_INCIDENT, document_ctes("closed_incident"))
SUMMARY = f"""SELECT id, number, priority, {iso("closed_at")} AS closed_at,
  md5(content) AS content_md5, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated"""

# both deliveries of the upsert and stream queries; kind 3 are new tickets
SECOND = """
second AS (
  SELECT * REPLACE (
    CASE WHEN doc_id % 4 = 3 THEN number || '-N' ELSE number END AS number,
    'second ' || (doc_id % 4) AS priority,
    '' AS closed_at,
    CASE doc_id % 4 WHEN 0 THEN updated_at + INTERVAL 1 DAY
      WHEN 1 THEN updated_at - INTERVAL 1 DAY WHEN 3 THEN updated_at END AS updated_at)
  FROM incident
)"""


def _merged(condition: str, columns: str = SUMMARY, then: str = "") -> str:
    """First delivery unless the second one is dated and not older.

    With `then`, a query over the merged rows as `document`.
    """
    merged = (
        f"{columns} FROM a_document WHERE doc_id % 4 <> 0 UNION ALL "
        f"{columns} FROM b_document WHERE doc_id % 4 IN (0, 3)"
    )
    return _with(
        INCIDENT,
        SECOND,
        f"first_kept AS (SELECT * FROM incident WHERE {condition})",
        f"second_kept AS (SELECT * FROM second WHERE {condition})",
        document_ctes("first_kept", "a_"),
        document_ctes("second_kept", "b_"),
        *([f"document AS ({merged})"] if then else []),
    ) + (then or merged)


def _detected(x: str) -> str:
    """List of all pattern hits of a text."""
    return "list_concat(" + ", ".join(
        f"regexp_extract_all({x}, {_text(regex)})" for _, regex, _ in ENTITIES
    ) + ")"


def _mask_ctes(source: str, doc_key: str, column: str) -> str:
    """masked(doc_key, before, text, n): values replaced longest first."""
    return f"""
found AS (
  SELECT {doc_key}, {column} AS before, list_distinct({_detected(column)}) AS vals FROM {source}
),
ordered AS (
  SELECT {doc_key}, before, vals,
    list_transform(list_sort(list_transform(vals,
      lambda v: {{'k': -length(v), 'v': v}})), lambda s: s.v) AS sorted
  FROM found
),
masked AS (
  SELECT {doc_key}, before, len(vals) AS n,
    list_reduce(list_prepend(before, sorted), lambda a, v: replace(a, v, '[PII]')) AS text
  FROM ordered
),
counted AS (
  SELECT *, CAST((length(replace(text, '[PII]', '[PII]+')) - length(text))
    - (length(replace(before, '[PII]', '[PII]+')) - length(before)) AS BIGINT) AS occurrences
  FROM masked
)"""


SEARCHED = (
    "number",
    "short_description",
    "description",
    "resolution",
    "work_notes",
    "comments",
    "content",
    "assignment_group_name",
)
# redacted documents of all tickets with masked content
MASKED_DOCUMENTS = (
    INCIDENT,
    document_ctes("incident"),
    _mask_ctes("document", "id", "content"),
    "searched AS (SELECT d.* REPLACE (m.text AS content) FROM document d JOIN masked m USING (id))",
)


def _bm25(questions: str, k: int) -> str:
    parts = " UNION ALL ".join(
        f"SELECT id, '{f}' AS field, list_filter(regexp_split_to_array(lower({f}), "
        rf"'[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS tokens FROM searched"
        for f in SEARCHED
    )
    return _with(
        *MASKED_DOCUMENTS,
        f"part AS ({parts})",
        "stat AS (SELECT field, count(*) AS n_docs, avg(len(tokens)) AS avg_dl "
        "FROM part GROUP BY field)",
        "word AS (SELECT id, field, len(tokens) AS dl, unnest(tokens) AS term FROM part)",
        f"question AS ({questions})",
        r"asked AS (SELECT qid, unnest(list_distinct(list_filter(regexp_split_to_array("
        r"lower(question), '[^\p{L}\p{N}]+'), lambda t: t <> ''))) AS term FROM question)",
        "freq AS (SELECT id, field, dl, term, count(*) AS tf FROM word "
        "WHERE term IN (SELECT term FROM asked) GROUP BY ALL)",
        "docfreq AS (SELECT field, term, count(*) AS df FROM freq GROUP BY ALL)",
        """scored AS (
  SELECT qid, id, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (0.25 + 0.75 * dl / avg_dl))), 6) AS score
  FROM freq JOIN docfreq USING (field, term) JOIN stat USING (field) JOIN asked USING (term)
  GROUP BY qid, id
)""",
        f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
  FROM scored QUALIFY rank <= {k}
)""",
    )


BENCHMARK = "SELECT item_id AS qid, text AS question FROM benchmark"
PROFILED = [c for c in catalog._record_columns() if c != "updated_at"]


JOURNALS = ("short_description", "description", "close_notes", "work_notes", "comments")
# fields of the extended list that the pages hold, as label or else value
CELLS = {
    "number": "number",
    **{c: strip(c) for c in JOURNALS},
    "cmdb_ci": "'an item'",
    "assignment_group": "assignment_group_name",
    **{c: f"upper({c})" for c in ("priority", "urgency", "impact")},
    "resolved_at": "resolved_at",
    **{c: "'local time'" for c in ("closed_at", "sys_updated_on")},
}
# The extended field list.
PROFILED_CELLS = (
    "number short_description description close_notes comments work_notes "
    "comments_and_work_notes category subcategory u_category cmdb_ci business_service "
    "service_offering assignment_group assigned_to priority severity urgency impact "
    "contact_type resolved_at closed_at opened_at sys_created_on sys_updated_on resolved_by "
    "closed_by caller_id company location"
).split()


def _profile(field: str, shown: str | None = None, source: str = "incident") -> str:
    value = f"translate(coalesce({shown or field}, ''), chr(13) || chr(10), '  ')"
    short = f"CASE WHEN length(t) > 80 THEN substr(t, 1, 80) || ' […]' ELSE t END"
    return f"""SELECT '{field}' AS field, count(*) AS records,
  count(*) FILTER (WHERE p) AS present, count(*) FILTER (WHERE t <> '') AS filled,
  max(length(t)) AS max_length, round(avg(length(t)), 6) AS avg_length,
  min({short}) FILTER (WHERE t <> '') AS example
FROM (SELECT {"TRUE" if shown else f"{field} IS NOT NULL"} AS p, {value} AS t FROM {source})"""


# field -> (searchable, filterable, retrievable)
REPORTED = {
    "id": (False, True, True),
    "number": (True, True, True),
    "url": (False, False, True),
    "short_description": (True, False, True),
    "description": (True, False, False),
    "resolution": (True, False, False),
    "work_notes": (True, False, False),
    "comments": (True, False, False),
    "content": (True, False, True),
    "assignment_group": (False, True, True),
    "assignment_group_name": (True, True, True),
    "priority": (False, True, True),
    "impact": (False, True, True),
    "urgency": (False, True, True),
    "closed_at": (False, True, True),
}


def _field_report() -> list[str]:
    parts = []
    for field, (searchable, filterable, retrievable) in REPORTED.items():
        is_time = field == "closed_at"
        shown = "strftime(closed_at, '%Y-%m-%d %H:%M:%S')" if is_time else field
        parts.append(
            f"SELECT '{field}' AS field, '{'timestamp_ntz' if is_time else 'string'}' AS type, "
            f"{searchable} AS searchable, {filterable} AS filterable, "
            f"{retrievable} AS retrievable, count(nullif({shown}, '')) AS filled, "
            f"max(length({shown})) AS max_length FROM document"
        )
    return parts


def all_checks() -> dict[str, str]:
    number_iso = f"SELECT number, closed_at, {iso(closed('closed_at'))} AS closed_iso"
    base = f"'{BASE_URL}"
    email = apply_rule(
        "description",
        (r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+", "[REDACTED]"),
    )
    one_line = "translate(text, chr(13) || chr(10), '  ')"
    in_scope_docs = _with(
        INCIDENT,
        f"chosen AS (SELECT * FROM incident WHERE state IN ('6','7') AND {IN_GROUPS} "
        f"AND {SINCE_OVERLAP})",
        document_ctes("chosen"),
    )
    delta_docs = _with(
        INCIDENT,
        f"chosen AS (SELECT * FROM incident WHERE state IN ('6','7') AND {SINCE_OVERLAP})",
        document_ctes("chosen"),
        _mask_ctes("document", "id", "content"),
    )
    emails = _text(ENTITIES[0][1])
    mask_emails = (
        f"list_reduce(list_prepend(text, list_transform(list_sort(list_transform("
        f"list_distinct(regexp_extract_all(text, {emails})), "
        f"lambda v: {{'k': -length(v), 'v': v}})), lambda s: s.v)), "
        f"lambda a, v: replace(a, v, '[PII]'))"
    )
    mark_count = "(length(replace({0}, '[PII]', '[PII]+')) - length({0}))"
    return {
        "group_priority_rollup": in_scope_docs
        + f"""SELECT assignment_group_name, priority, count(*) AS tickets,
  count(*) FILTER (WHERE contains(content, '[REDACTED]')) AS tickets_masked,
  CAST(sum(length(content)) AS BIGINT) AS content_chars, {iso("max(closed_at)")} AS last_closed
FROM document GROUP BY 1, 2""",
        "scope_filter": _with(INCIDENT)
        + f"SELECT sys_id, number, state, assignment_group FROM incident "
        f"WHERE state IN ('6','7') AND {IN_GROUPS}",
        "item_scope": _with(INCIDENT)
        + f"SELECT number, state, assignment_group, cmdb_ci FROM incident "
        f"WHERE state IN ('6','7') AND {IN_GROUPS} AND cmdb_ci IN {_in(catalog.ITEMS)}",
        "delta_scan": _with(INCIDENT)
        + f"SELECT number, state, sys_updated_on FROM incident "
        f"WHERE state IN ('6','7') AND {SINCE_OVERLAP}",
        "scope_count": _with(INCIDENT)
        + f"SELECT count(*) AS documents FROM incident WHERE state IN ('6','7') AND {SINCE}",
        "first_n_by_update": _with(INCIDENT)
        + "SELECT number, sys_id, sys_updated_on FROM incident "
        f"ORDER BY updated_at NULLS FIRST, sys_id, number LIMIT {catalog.FIRST_ROWS}",
        "sample_summary": _with(INCIDENT)
        + "SELECT count(*) AS records, strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') "
        "AS last_update FROM (SELECT updated_at FROM incident WHERE state IN ('6','7') "
        f"ORDER BY updated_at NULLS FIRST, sys_id LIMIT {catalog.FIRST_ROWS})",
        "group_scope_semi": _with(INCIDENT, DOC_GROUPS)
        + "SELECT i.assignment_group, i.number, g.name AS group_label FROM incident i "
        "JOIN desk_group g ON g.sys_id = i.assignment_group WHERE g.active",
        "group_search": _with(DOC_GROUPS)
        + "SELECT sys_id, name FROM desk_group WHERE active "
        "AND (name LIKE '%src1%' OR name LIKE '%8%')",
        "group_search_all": _with(DOC_GROUPS)
        + "SELECT sys_id, name FROM desk_group WHERE active",
        "page_cells": _with(INCIDENT)
        + f"""SELECT number, sys_id, {", ".join(f"{strip(c)} AS {c}" for c in JOURNALS)},
  assignment_group, assignment_group_name, upper(priority) AS priority, upper(impact) AS impact,
  upper(urgency) AS urgency, coalesce(closed_at, '') AS closed_at, resolved_at, sys_updated_on,
  state, cmdb_ci, strptime(sys_updated_on, '%Y-%m-%d %H:%M:%S') AS updated_at FROM incident""",
        "field_profile_cells": _with(INCIDENT)
        + " UNION ALL ".join(
            _profile(f, CELLS[f]) if f in CELLS
            else f"SELECT '{f}', count(*), 0, 0, 0, 0.0, NULL FROM incident"
            for f in PROFILED_CELLS
        ),
        "other_table_scan": """SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_acctbal < 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')""",
        "landed_pages": _with(INCIDENT)
        + f"""SELECT number, {strip("description")} AS description,
  upper(priority) AS priority, CAST(updated_at AS DATE) AS updated_day FROM incident
WHERE date_trunc('second', updated_at) >= TIMESTAMP '{catalog.MARK}' - INTERVAL 15 MINUTE""",
        "group_file_scope": _with(INCIDENT, DOC_GROUPS)
        + "SELECT name AS group_label, count(*) AS tickets FROM incident i "
        "JOIN desk_group g ON g.sys_id = i.assignment_group WHERE active GROUP BY name",
        "evaluation_file": """SELECT '"' || text || '",' || chr(10) || item_id AS question,
  'answer, ' || item_id AS expected_response FROM benchmark""",
        "cell_fallback": """WITH c AS (
  SELECT doc_id,
    CASE WHEN doc_id % 5 = 0 OR doc_id % 2 = 0 THEN source ELSE '' END AS value,
    CASE WHEN doc_id % 5 = 0 THEN source WHEN doc_id % 3 = 0 THEN lang ELSE '' END AS label
  FROM documents)
SELECT doc_id, value, label, coalesce(nullif(value, ''), label) AS value_first,
  coalesce(nullif(label, ''), value) AS label_first FROM c""",
        "eval_limits": """SELECT count(*) AS questions, max(length(text)) AS longest,
  count(*) FILTER (WHERE length(text) > 500) AS too_long,
  count(*) <= 100 AND count(*) FILTER (WHERE length(text) > 500) = 0 AS within_limits
FROM benchmark""",
        "doc_id_clean": _with(INCIDENT) + f"SELECT number, {key('number')} AS id FROM incident",
        "iso_dates": _with(INCIDENT) + number_iso + " FROM incident",
        "ticket_url": _with(INCIDENT)
        + f"""SELECT doc_id, CASE
  WHEN doc_id % 3 <> 0 THEN {base}/nav_to.do?uri=incident.do?sys_id=' || sys_id
  WHEN doc_id % 6 <> 0 THEN {base}/incident.do?sysparm_query=number=' || number
  ELSE '' END AS url, '' AS url_without_base FROM incident""",
        "header": _with(INCIDENT)
        + f"""SELECT number, 'Ticket ' || number
  || CASE WHEN doc_id % 4 = 1 THEN '' ELSE ' | Gruppo: ' || assignment_group_name END
  || coalesce(' | Chiuso: ' || strftime({closed("closed_at")}, '%Y-%m-%d'), '')
  || ' | Link: {BASE_URL}/nav_to.do?uri=incident.do?sys_id=' || sys_id AS header
FROM incident""",
        "content": _with(INCIDENT)
        + f"""SELECT doc_id, {strip('''concat_ws(chr(10) || chr(10),
  CASE WHEN doc_id % 5 <> 0 THEN number END, 'Problema: ' || short_description,
  'Descrizione: ' || description, 'Risoluzione: ' || nullif(close_notes, ''),
  CASE WHEN doc_id % 3 <> 0 THEN 'Note di lavorazione: ' || nullif(work_notes, '') END,
  'Commenti: ' || nullif(comments, ''))''')} AS content FROM incident""",
        "documents_basic": _with(*DOCUMENTS)
        + f"SELECT * EXCLUDE (updated_at, doc_id) REPLACE ({iso('closed_at')} AS closed_at) "
        "FROM document",
        "byte_truncate": f"SELECT doc_id, {cut_bytes('text', 30000)} AS field_text, "
        f"{cut_bytes('text', 1001)} AS small_text FROM documents",
        "char_truncate": r"""WITH t AS (
  SELECT doc_id, text, regexp_split_to_array(text, '\s+') AS tokens FROM documents)
SELECT doc_id, substr(text, 1, 24000) AS by_chars,
  CASE WHEN len(tokens) > 50 THEN array_to_string(tokens[1:50], ' ') ELSE text END AS by_tokens
FROM t""",
        "preview": f"""WITH t AS (SELECT doc_id, {one_line} AS line FROM documents)
SELECT doc_id,
  CASE WHEN length(line) > 80 THEN substr(line, 1, 80) || ' […]' ELSE line END AS short_preview,
  CASE WHEN length(line) > 600 THEN substr(line, 1, 600) || ' […]' ELSE line END AS long_preview
FROM t""",
        **{
            name: _with(INCIDENT)
            + f"SELECT number, {redacted('description', rules)} AS redacted FROM incident"
            for name, rules in {
                "redact_connstr": (CONNECTION,),
                "redact_identified": (IDENTIFIED,),
                "redact_password": (PASSWORD,),
                "redact_chain": RULES,
            }.items()
        },
        "redact_custom_email": _with(INCIDENT)
        + f"SELECT number, {email} AS redacted FROM incident",
        "redact_then_mask": _with(
            INCIDENT,
            f"r AS (SELECT number, {redacted('description')} AS body FROM incident)",
            _mask_ctes("r", "number", "body"),
        )
        + "SELECT number, text AS redacted FROM masked",
        "pii_detect": "WITH s AS ("
        + " UNION ALL ".join(
            f"SELECT doc_id, '{entity}' AS type, CAST({score} AS DOUBLE) AS score, "
            f"unnest(regexp_extract_all(text, {_text(regex)})) AS value FROM documents"
            for entity, regex, score in ENTITIES
            if score >= {"EMAIL_ADDRESS": 0.9, "PHONE_NUMBER": 0.5, "IBAN_CODE": 0.6}.get(entity, 0.5)
        )
        + ") SELECT doc_id, type, value, count(*) AS hits, max(score) AS score FROM s "
        "GROUP BY doc_id, type, value",
        "pii_mask": _with(_mask_ctes("documents", "doc_id", "text"))
        + "SELECT doc_id, text, n AS value_count, occurrences FROM counted",
        "pii_counts": _with(_mask_ctes("documents", "doc_id", "text"))
        + """SELECT CAST(sum(n) AS BIGINT) AS pii_values_masked,
  CAST(sum(occurrences) AS BIGINT) AS pii_occurrences_masked,
  count(*) FILTER (WHERE occurrences > 0) AS pii_docs_with_pii,
  CAST(0 AS BIGINT) AS pii_failures FROM counted""",
        "pii_json_values": """WITH v AS (SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN [source, lang]
    WHEN 1 THEN [CASE WHEN doc_id % 8 = 1 THEN source ELSE lang END]
    ELSE [] END AS vals FROM documents)
SELECT doc_id, CAST(len(vals) AS BIGINT) AS value_count,
  array_to_string(vals, '|') AS reply_values FROM v""",
        "lang_route": """SELECT lang, CASE WHEN lang IN ('es', 'en') THEN lang ELSE 'es' END
  AS routed, count(*) AS documents FROM documents GROUP BY 1, 2""",
        "mask_with_detector": f"""WITH m AS (SELECT doc_id, text AS before,
  {mask_emails} AS masked FROM documents)
SELECT doc_id, masked AS text, CAST({mark_count.format("masked")}
  - {mark_count.format("before")} AS BIGINT) AS occurrences FROM m""",
        "mask_failures": f"""WITH m AS (
  SELECT NOT contains(text, '{catalog.SECRET_WORD}') AS masked_ok, text AS before,
    CASE WHEN contains(text, '{catalog.SECRET_WORD}') THEN text ELSE {mask_emails} END AS masked
  FROM documents)
SELECT masked_ok, count(*) AS documents, CAST(sum({mark_count.format("masked")}
  - {mark_count.format("before")}) AS BIGINT) AS occurrences,
  CAST(sum(length(masked)) AS BIGINT) AS chars FROM m GROUP BY masked_ok""",
        "quarantine_redrive": _with(*DOCUMENTS)
        + f""", m AS (SELECT id, {mask_emails} AS masked FROM (SELECT id, content AS text FROM document))
SELECT id, length(masked) AS chars, md5(masked) AS content_md5, TRUE AS some_failed,
  CAST(0 AS BIGINT) AS held FROM m""",
        "latest_version": _with(INCIDENT)
        + f"""SELECT {key("number")} AS id,
  CASE WHEN doc_id % 3 = 0 THEN 'newer' ELSE priority END AS priority,
  strftime(CASE WHEN doc_id % 3 = 0 THEN updated_at + INTERVAL 1 DAY ELSE updated_at END,
    '%Y-%m-%d %H:%M:%S') AS updated FROM incident""",
        "number_collisions": _with(INCIDENT)
        + f"""SELECT {key("number")} AS id, CAST(2 AS BIGINT) AS numbers,
  least(number, replace(replace(number, '/', '_'), ' ', '.')) AS first_number
FROM incident WHERE doc_id % 50 = 7""",
        "upsert_snapshot": _merged("TRUE"),
        "stream_upsert_final_state": _merged("state IN ('6', '7')"),
        "stream_changed_versions": _merged("state IN ('6', '7')"),
        "kept_facets": _merged(
            "TRUE",
            "SELECT *",
            " UNION ALL ".join(
                f"SELECT '{f}' AS facet, {f} AS value, count(*) AS documents FROM document GROUP BY {f}"
                for f in ("assignment_group_name", "priority", "impact", "urgency")
            ),
        ),
        "kept_profile": _merged(
            "TRUE",
            f"SELECT {', '.join(catalog.KEPT_FIELDS)}",
            " UNION ALL ".join(_profile(f, source="document") for f in catalog.KEPT_FIELDS),
        ),
        "merge_columns": _with(INCIDENT)
        + f"""SELECT {key("number")} AS id, number, short_description,
  CASE WHEN {IN_GROUPS} THEN 'changed' ELSE priority END AS priority,
  CASE WHEN {IN_GROUPS} THEN NULL ELSE closed_at END AS closed_at FROM incident""",
        "evolve_add_column": _with(INCIDENT)
        + f"""SELECT {key("number")} AS id, number,
  CASE WHEN state IN ('6','7') AND {IN_GROUPS}
    THEN {base}/nav_to.do?uri=incident.do?sys_id=' || sys_id END AS url FROM incident""",
        "recreate_corpus": _with(
            INCIDENT,
            f"chosen AS (SELECT * FROM incident WHERE {IN_GROUPS})",
            document_ctes("chosen"),
        )
        + f"{SUMMARY} FROM document",
        "schema_report": _with(*DOCUMENTS) + " UNION ALL ".join(_field_report()),
        "high_water_mark": _with(INCIDENT)
        + """SELECT strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS mark,
  strftime(greatest(max(updated_at), TIMESTAMP '2020-01-01'), '%Y-%m-%d %H:%M:%S')
    AS after_earlier,
  strftime(greatest(max(updated_at), TIMESTAMP '2030-01-01'), '%Y-%m-%d %H:%M:%S')
    AS after_later,
  strftime(max(updated_at) - INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS read_from
FROM incident WHERE state IN ('6','7')""",
        "run_stats": delta_docs
        + f"""SELECT 'delta' AS mode, count(*) AS read, count(*) AS transformed,
  CAST(0 AS BIGINT) AS skipped_empty, count(*) AS written,
  '{catalog.MARK}' AS previous_watermark,
  (SELECT strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') FROM chosen) AS new_watermark,
  CAST(sum(occurrences) AS BIGINT) AS pii_occurrences_masked,
  CAST(sum(n) AS BIGINT) AS pii_values_masked,
  count(*) FILTER (WHERE occurrences > 0) AS pii_docs_with_pii,
  CAST(0 AS BIGINT) AS pii_failures, CAST(0 AS BIGINT) AS undated FROM counted""",
        "stream_restart_state": _merged("state IN ('6', '7')"),
        "pages_to_corpus": _with(
            INCIDENT,
            """imperfect AS (SELECT * REPLACE (
  CASE WHEN blank THEN NULL ELSE number END AS number, CASE WHEN blank THEN NULL ELSE sys_id END AS sys_id,
  CASE WHEN blank THEN NULL ELSE short_description END AS short_description,
  CASE WHEN blank THEN NULL ELSE description END AS description,
  CASE WHEN blank THEN NULL ELSE close_notes END AS close_notes,
  CASE WHEN blank THEN NULL ELSE work_notes END AS work_notes,
  CASE WHEN blank THEN NULL ELSE comments END AS comments,
  CASE WHEN blank THEN NULL ELSE assignment_group_name END AS assignment_group_name,
  CASE WHEN blank THEN NULL ELSE closed_at END AS closed_at,
  CASE WHEN doc_id % 50 = 3 THEN NULL ELSE date_trunc('second', updated_at) END AS updated_at)
  FROM (SELECT *, doc_id % 40 = 5 AS blank FROM incident) WHERE state IN ('6', '7'))""",
            "kept AS (SELECT * FROM imperfect WHERE NOT blank)",
            document_ctes("kept"),
            f"""refused AS (SELECT id, content AS before, contains(content, '{catalog.SECRET_WORD}') AS bad,
  CASE WHEN bad THEN [] ELSE list_distinct(regexp_extract_all(content, {emails})) END AS vals FROM document)""",
            """masked AS (SELECT *, list_reduce(list_prepend(before, list_transform(list_sort(list_transform(
  vals, lambda v: {'k': -length(v), 'v': v})), lambda s: s.v)), lambda a, v: replace(a, v, '[PII]')) AS after
  FROM refused)""",
            """counted AS (SELECT *, (length(replace(after, '[PII]', '[PII]+')) - length(after))
  - (length(replace(before, '[PII]', '[PII]+')) - length(before)) AS occurrences FROM masked)""",
        )
        + """SELECT 'full' AS mode, (SELECT count(*) FROM imperfect) AS read, count(*) AS transformed,
  (SELECT count(*) FROM imperfect WHERE blank) AS skipped_empty, count(*) AS written,
  CAST(NULL AS VARCHAR) AS previous_watermark,
  (SELECT strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') FROM imperfect) AS new_watermark,
  CAST(sum(occurrences) AS BIGINT) AS pii_occurrences_masked,
  CAST(sum(len(vals)) AS BIGINT) AS pii_values_masked,
  count(*) FILTER (WHERE occurrences > 0) AS pii_docs_with_pii, count(*) FILTER (WHERE bad) AS pii_failures,
  (SELECT count(*) FROM imperfect WHERE updated_at IS NULL) AS undated, count(*) AS documents,
  count(*) AS vectors, count(*) FILTER (WHERE bad) AS unmasked, CAST(sum(length(after)) AS BIGINT) AS chars,
  (SELECT strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') FROM imperfect) AS saved_mark FROM counted""",
        "full_mode": _with(INCIDENT)
        + f"""SELECT count(*) AS documents, 'full' AS mode,
  strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS saved_mark
FROM incident WHERE state IN ('6','7') AND {IN_GROUPS}""",
        "backfill_mode": _with(INCIDENT)
        + f"""SELECT count(*) AS documents, 'backfill' AS mode, '{catalog.MARK}' AS saved_mark,
  strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS seen_mark
FROM incident WHERE state IN ('6','7') AND updated_at >= TIMESTAMP '{catalog.BACKFILL_DAY}'""",
        "delta_equals_full": _with(*DOCUMENTS) + f"{SUMMARY} FROM document",
        "hash_vector_check": r"""SELECT doc_id AS id, CAST(256 AS BIGINT) AS dimensions,
  CAST(1.0 AS DOUBLE) AS norm FROM documents WHERE regexp_matches(text, '[\p{L}\p{N}]')""",
        "hash_vectors": r"""WITH word AS (
  SELECT doc_id AS id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
    lambda t: t <> '')) AS w FROM documents),
counted AS (
  SELECT id, ('0x' || substr(md5(w), 1, 6))::INT % 256 AS place, count(*) AS n FROM word GROUP BY ALL)
SELECT id, CAST(place AS INTEGER) AS place,
  round(n / sqrt(sum(n * n) OVER (PARTITION BY id)), 4) AS value FROM counted""",
        "model_vectors": """WITH part AS (
  SELECT doc_id, substr(text, s::BIGINT, 24000) AS p, length(text) AS n
  FROM documents, unnest(range(1, length(text) + 1, 24000)) AS t(s)
  WHERE lang <> 'fr' AND text <> ''),
mean AS (
  SELECT doc_id, count(*) AS parts, sum(length(p) * length(p)) / max(n) AS a,
    sum(length(p) * (length(p) - length(replace(p, ' ', '')))) / max(n) AS b,
    sum(length(p) * (length(p) - length(replace(p, 'e', '')))) / max(n) AS c
  FROM part GROUP BY doc_id),
scaled AS (SELECT *, CASE WHEN parts = 1 THEN 1 ELSE sqrt(a * a + b * b + c * c) END AS z FROM mean)
SELECT doc_id, round(a / z, 4) AS chars, round(b / z, 4) AS blanks, round(c / z, 4) AS letters_e
FROM scaled""",
        "person_detect": r"""WITH name AS (
  SELECT regexp_extract(text, '^[A-Za-z]+') AS value, max(0.3 + (item_id % 3) * 0.1) AS score
  FROM benchmark GROUP BY 1 HAVING value <> '' AND score >= 0.4),
word AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS value FROM documents)
SELECT doc_id, value, count(*) AS hits, round(CAST(any_value(score) AS DOUBLE), 6) AS score
FROM word JOIN name USING (value) GROUP BY doc_id, value""",
        "person_names": r"""WITH RECURSIVE listed AS (
  SELECT regexp_replace(CASE item_id % 4
      WHEN 0 THEN regexp_extract(text, '^[\p{L}\p{N}]+')
      WHEN 1 THEN regexp_extract(text, '^[\p{L}\p{N}]+(?:[^\p{L}\p{N}]+[\p{L}\p{N}]+){1}')
      WHEN 2 THEN regexp_extract(text, '^[\p{L}\p{N}]+(?:[^\p{L}\p{N}]+[\p{L}\p{N}]+){2}')
      ELSE regexp_extract(text, '^[\p{L}\p{N}]+(?:[^\p{L}\p{N}]+[\p{L}\p{N}]+){3}')
    END, '[ \t\n\x0B\f\r]+', ' ', 'g') AS value, max(0.3 + (item_id % 5) * 0.1) AS score
  FROM benchmark GROUP BY 1 HAVING value <> '' AND score >= 0.4),
token AS (SELECT doc_id, length(text) AS n,
  regexp_extract_all(text, '[\p{L}\p{N}]+[^\p{L}\p{N}]*') AS t FROM documents),
word AS (SELECT doc_id, n, unnest(t) AS w, unnest(range(len(t))) AS i FROM token),
placed AS (SELECT doc_id, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3,
  n - sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS start_at
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT doc_id, start_at, unnest([w, w || w1, w || w1 || w2, w || w1 || w2 || w3]) AS raw FROM placed),
core AS (SELECT doc_id, start_at, regexp_extract(raw, '(?s)^.*[\p{L}\p{N}]') AS core FROM run
  WHERE raw IS NOT NULL),
hit AS (SELECT doc_id, start_at, start_at + length(core) AS end_at, value, score
  FROM core JOIN listed ON value = regexp_replace(core, '[ \t\n\x0B\f\r]+', ' ', 'g')),
longest AS (SELECT * FROM hit
  QUALIFY row_number() OVER (PARTITION BY doc_id, start_at ORDER BY end_at DESC) = 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start_at) AS k FROM longest),
scan AS (
  SELECT doc_id, k, end_at AS reach, true AS kept FROM numbered WHERE k = 1
  UNION ALL
  SELECT m.doc_id, m.k, CASE WHEN m.start_at >= s.reach THEN m.end_at ELSE s.reach END, m.start_at >= s.reach
  FROM scan s JOIN numbered m ON m.doc_id = s.doc_id AND m.k = s.k + 1)
SELECT doc_id, value, CAST(start_at AS BIGINT) AS start_at, CAST(end_at AS BIGINT) AS end_at,
  round(CAST(score AS DOUBLE), 6) AS score
FROM numbered JOIN scan USING (doc_id, k) WHERE kept""",
        "content_filter": """SELECT count(*) AS documents,
  CAST(sum(length(text)) AS BIGINT) AS chars FROM documents
WHERE lang <> 'de' AND text <> ''""",
        "vector_dims": """SELECT count(*) AS documents, count(*) AS vectors,
  count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_length,
  min(len(embedding)) AS min_length, max(len(embedding)) AS max_length FROM embeddings""",
        "cosine_topk": f"""SELECT vec_id, label, round(list_cosine_similarity(
    CAST(embedding AS DOUBLE[]),
    (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS score
FROM embeddings ORDER BY score DESC, vec_id LIMIT {catalog.TOP_DOCUMENTS}""",
        "fulltext_topk": _bm25(
            f"SELECT 0 AS qid, {_text(catalog.SEARCH_TEXT)} AS question", catalog.TOP_DOCUMENTS
        )
        + "SELECT CAST(rank AS INTEGER) AS rank, id, number, short_description, "
        "assignment_group_name, score FROM ranked JOIN searched USING (id)",
        "batch_retrieval": _bm25(BENCHMARK, 5)
        + "SELECT qid, id, score, CAST(rank AS INTEGER) AS rank FROM ranked",
        "indexed_batch_retrieval": _bm25(BENCHMARK, 5)
        + "SELECT qid, id, score, CAST(rank AS INTEGER) AS rank FROM ranked",
        "index_upkeep_search": _bm25(
            f"SELECT 0 AS qid, {_text(catalog.SEARCH_TEXT)} AS question", catalog.TOP_DOCUMENTS
        )
        + "SELECT CAST(rank AS INTEGER) AS rank, id, number, short_description, "
        "assignment_group_name, score FROM ranked JOIN searched USING (id)",
        "vector_batch_topk": f"""WITH pair AS (
  SELECT q.vec_id AS qid, e.vec_id, round(list_cosine_similarity(
    CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score
  FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0)
SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM pair WHERE score IS NOT NULL QUALIFY rank <= {catalog.TOP_DOCUMENTS}""",
        "vector_text_topk": _with(*MASKED_DOCUMENTS)
        + rf""", question AS (SELECT '' AS id, {_text(catalog.SEARCH_TEXT)} AS content),
word AS (
  SELECT id, unnest(list_filter(regexp_split_to_array(lower(content), '[^\p{{L}}\p{{N}}]+'),
    lambda t: t <> '')) AS w FROM (SELECT id, content FROM searched UNION ALL FROM question)),
tally AS (
  SELECT id, ('0x' || substr(md5(w), 1, 6))::INT % 256 AS place, count(*) AS n FROM word GROUP BY ALL),
unit AS (SELECT id, place, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS x FROM tally)
SELECT d.id, any_value(number) AS number, round(sum(d.x * q.x), 6) AS score
FROM unit d JOIN unit q ON d.place = q.place AND q.id = '' JOIN searched s ON s.id = d.id
GROUP BY d.id ORDER BY score DESC, d.id LIMIT {catalog.TOP_DOCUMENTS}""",
        "doc_count": "SELECT count(*) AS documents FROM documents",
        "facets": _with(INCIDENT)
        + " UNION ALL ".join(
            f"SELECT '{f}' AS facet, {f} AS value, count(*) AS documents FROM incident GROUP BY {f}"
            for f in ("assignment_group_name", "priority", "impact", "urgency")
        ),
        "visible_columns": _with(*DOCUMENTS)
        + f"""SELECT id, number, url, short_description, content, assignment_group,
  assignment_group_name, priority, impact, urgency, {iso("closed_at")} AS closed_at
FROM document""",
        "point_lookup": _with(
            INCIDENT,
            "one AS (SELECT * FROM incident WHERE number = 'INC/0000007 A')",
            document_ctes("one"),
        )
        + "SELECT id, number, url, content FROM document",
        "filtered_sorted": _with(*DOCUMENTS)
        + f"""SELECT id, urgency, {iso("closed_at")} AS closed_at FROM document
WHERE urgency IN ('1 - High', '2 - Medium') AND {IN_GROUPS}
  AND closed_at >= TIMESTAMP '2024-01-02'""",
        "field_profile": _with(INCIDENT)
        + " UNION ALL ".join(_profile(f) for f in PROFILED)
        + " UNION ALL SELECT 'category', count(*), 0, 0, 0, 0.0, NULL FROM incident",
    }
