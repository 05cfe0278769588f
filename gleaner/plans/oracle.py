"""SQL twins of the stand-in tables (for the DuckDB correctness oracle).

Each constant is one common-table-expression that derives a reference-shaped
table from the driver views exactly as :mod:`gleaner.sources.standins` does
in Spark. ``with_ctes`` assembles the ones a query needs.
"""

from __future__ import annotations

CTE = {
    "docs": """docs AS (
  SELECT doc_id, source, lang, sha256(text) AS resource FROM documents)""",
    "pair": """pair AS (
  SELECT DISTINCT source AS dataset, resource FROM docs)""",
    "old_resource": """old_resource AS (
  SELECT d.doc_id AS seq, d.resource AS old_resource,
         CASE WHEN l.toxic = 1 THEN (CASE WHEN d.lang = 'en' THEN '' ELSE NULL END)
              ELSE f.first_resource END AS resource,
         CASE WHEN l.toxic = 1 THEN '410' ELSE '301' END AS status
  FROM docs d
  JOIN labels l ON l.doc_id = d.doc_id
  JOIN (SELECT source, arg_min(resource, doc_id) AS first_resource
        FROM docs GROUP BY source) f ON f.source = d.source
  WHERE l.toxic = 1 OR l.quality = 0)""",
    "version_log": """version_log AS (
  SELECT d.source AS dataset, d.resource,
         CASE WHEN r.run = 0 AND d.lang = 'es' THEN NULL ELSE '0.1.0' END AS code_version,
         CASE WHEN (r.run = 0 AND d.lang = 'de') OR r.run = 2 THEN 'stale' ELSE 'config-1' END AS config_hash,
         'specification-1' AS specification_hash,
         CASE r.run WHEN 0 THEN '2024-03-01' WHEN 1 THEN '2024-02-01' ELSE '2024-01-01' END AS entry_date
  FROM docs d JOIN labels l ON l.doc_id = d.doc_id JOIN (VALUES (0), (1), (2)) r(run)
    ON r.run = 0 OR (r.run = 1 AND d.doc_id % 3 = 0) OR (r.run = 2 AND d.doc_id % 5 = 0))""",
    "current": """current_pairs AS (
  SELECT dataset, resource FROM (
    SELECT *, rank() OVER (PARTITION BY dataset, resource ORDER BY entry_date DESC) AS place FROM version_log)
  WHERE place = 1 GROUP BY dataset, resource
  HAVING bool_and(code_version IS NOT DISTINCT FROM '0.1.0' AND config_hash IS NOT DISTINCT FROM 'config-1'
                  AND specification_hash IS NOT DISTINCT FROM 'specification-1'))""",
    "clog": """clog AS (
  SELECT 'ep-' || CAST(e.user_id AS VARCHAR) AS endpoint,
         CASE WHEN e.event_type = 'error' THEN NULL ELSE d.resource END AS resource,
         CAST(e.ts AS DATE) AS entry_date,
         CASE WHEN e.event_type = 'error' THEN '500' ELSE '200' END AS status
  FROM events e LEFT JOIN docs d ON e.event_id = d.doc_id)""",
    "src": """src AS (
  SELECT 'src-' || CAST(c_custkey AS VARCHAR) AS source,
         'org-' || CAST(c_nationkey AS VARCHAR) AS organisation,
         'ep-' || CAST(c_custkey AS VARCHAR) AS endpoint,
         lower(c_mktsegment) AS collection,
         lower(c_mktsegment) || CASE WHEN c_custkey % 3 = 0 THEN ';common' ELSE '' END AS pipelines
  FROM customer)""",
    "srcd": """srcd AS (
  SELECT endpoint, organisation, unnest(string_split(pipelines, ';')) AS dataset FROM src)""",
    "rmap": """rmap AS (
  SELECT old_resource, arg_max_null(resource, seq) AS target
  FROM old_resource GROUP BY old_resource)""",
    "resolved": """resolved AS (
  SELECT p.dataset, p.resource AS old_resource,
         CASE WHEN m.old_resource IS NOT NULL THEN m.target ELSE p.resource END AS resource,
         (m.old_resource IS NOT NULL AND (m.target IS NULL OR m.target = '')) AS removed
  FROM pair p LEFT JOIN rmap m ON p.resource = m.old_resource)""",
    "enrich": """enrich AS (
  SELECT f.resource, f.start_date, e.endpoints, o.organisations
  FROM (SELECT resource, min(entry_date) AS start_date FROM clog
        WHERE resource IS NOT NULL GROUP BY resource) f
  LEFT JOIN (SELECT resource, string_agg(endpoint, ' ' ORDER BY endpoint) AS endpoints
             FROM (SELECT DISTINCT resource, endpoint FROM clog WHERE resource IS NOT NULL)
             GROUP BY resource) e ON e.resource = f.resource
  LEFT JOIN (SELECT resource, string_agg(organisation, ' ' ORDER BY organisation) AS organisations
             FROM (SELECT DISTINCT c.resource, s.organisation
                   FROM (SELECT DISTINCT resource, endpoint FROM clog WHERE resource IS NOT NULL) c
                   JOIN src s ON s.endpoint = c.endpoint)
             GROUP BY resource) o ON o.resource = f.resource)""",
    "tasks": """tasks AS (
  SELECT r.old_resource, r.dataset, r.resource,
         'collection/resource/' || r.resource AS path,
         coalesce(e.endpoints, '') AS endpoints,
         coalesce(e.organisations, '') AS organisations,
         strftime(e.start_date, '%Y-%m-%d') AS entry_date
  FROM resolved r
  LEFT JOIN enrich e ON e.resource = r.old_resource
  WHERE NOT r.removed
    AND NOT EXISTS (SELECT 1 FROM current_pairs c
                    WHERE c.dataset = r.dataset AND c.resource = r.old_resource))""",
    "tin": """tin AS (
  SELECT 'part-' || CAST(p.p_partkey // 1000 AS VARCHAR) AS dataset, p.p_partkey AS entity,
         sha256(CAST(l.l_orderkey AS VARCHAR)) AS resource,
         CAST(l.l_linenumber - 1 AS BIGINT) AS entry_number,
         CASE l.l_orderkey % 40 WHEN 0 THEN '9999-12-31' WHEN 1 THEN '1960-05-05' WHEN 2 THEN NULL
              WHEN 3 THEN CAST(year(l.l_shipdate) AS VARCHAR)
              WHEN 4 THEN CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) || 'T10:00:00'
              ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END AS entry_date,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN 1 WHEN l.l_orderkey % 40 = 5 THEN 901
                   WHEN l.l_orderkey % 40 = 6 THEN 5000 WHEN l.l_orderkey % 40 = 7 THEN NULL
                   ELSE 2 END AS BIGINT) AS priority,
         p.p_name AS name, 'P' || CAST(p.p_partkey AS VARCHAR) AS reference,
         CAST(l.l_suppkey AS VARCHAR) AS organisation_entity,
         CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) AS quantity,
         l.l_returnflag || l.l_linestatus AS status
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)""",
    "tfact": """tfact AS (
  SELECT *, sha256(CAST(entity AS VARCHAR) || '|' || field || '|' || value) AS fact FROM (
    SELECT dataset, entity, resource, entry_number, entry_date, priority, 'name' AS field, name AS value FROM tin
    UNION ALL SELECT dataset, entity, resource, entry_number, entry_date, priority, 'reference', reference FROM tin
    UNION ALL SELECT dataset, entity, resource, entry_number, entry_date, priority, 'organisation_entity', organisation_entity FROM tin
    UNION ALL SELECT dataset, entity, resource, entry_number, entry_date, priority, 'quantity', quantity FROM tin
    UNION ALL SELECT dataset, entity, resource, entry_number, entry_date, priority, 'status', status FROM tin))""",
    "rfields": """rfields AS (
  SELECT dataset, entity, field, value, entry_date, fact FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset, entity, field
                                 ORDER BY priority NULLS LAST, entry_date DESC NULLS LAST,
                                          entry_number DESC NULLS LAST, fact) AS rn
    FROM tfact) WHERE rn = 1)""",
    "ents": """ents AS (
  SELECT dataset, NULL::VARCHAR AS end_date, entity, max(entry_date) AS entry_date,
         max(CASE WHEN field = 'geometry' THEN value END) AS geometry,
         CASE WHEN count(CASE WHEN field NOT IN ('end_date','geometry','name','organisation_entity',
                   'point','prefix','quality','reference','start_date','typology') THEN 1 END) > 0
              THEN '{' || string_agg(CASE WHEN field NOT IN ('end_date','geometry','name',
                   'organisation_entity','point','prefix','quality','reference','start_date',
                   'typology') THEN '"' || field || '":"' || value || '"' END, ',' ORDER BY field)
                   || '}' END AS json,
         max(CASE WHEN field = 'name' THEN value END) AS name,
         max(CASE WHEN field = 'organisation_entity' THEN value END) AS organisation_entity,
         max(CASE WHEN field = 'point' THEN value END) AS point,
         max(CASE WHEN field = 'prefix' THEN value END) AS prefix,
         max(CASE WHEN field = 'quality' THEN value END) AS quality,
         max(CASE WHEN field = 'reference' THEN value END) AS reference,
         max(CASE WHEN field = 'start_date' THEN value END) AS start_date,
         max(CASE WHEN field = 'typology' THEN value END) AS typology
  FROM rfields GROUP BY dataset, entity)""",
    "spec": """spec AS (
  SELECT DISTINCT 'part-' || CAST(p_partkey // 1000 AS VARCHAR) AS dataset, 'part' AS collection,
         (p_partkey // 1000) * 1000 AS entity_minimum, (p_partkey // 1000) * 1000 + 999 AS entity_maximum
  FROM part)""",
    "old_entity": """old_entity AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_name
              WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_custkey + 5000000000 AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) END AS old_entity,
         CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_custkey + 1 AS VARCHAR) END AS entity,
         CASE WHEN c_acctbal < 0 THEN '410' ELSE '301' END AS status
  FROM customer)""",
    "eorg": """eorg AS (
  SELECT s_suppkey * 20 AS entity_minimum, s_suppkey * 20 + 19 AS entity_maximum,
         'org-' || CAST(s_nationkey AS VARCHAR) AS organisation FROM supplier)""",
}

# dependency order of the CTEs above
_DEPS = {
    "pair": ["docs"], "old_resource": ["docs"], "version_log": ["docs"],
    "current": ["version_log"], "clog": ["docs"], "rmap": ["old_resource"],
    "resolved": ["pair", "rmap"], "enrich": ["clog", "src"],
    "tasks": ["resolved", "enrich", "current"], "srcd": ["src"],
    "tfact": ["tin"], "rfields": ["tfact"], "ents": ["rfields"],
}


def with_ctes(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body
