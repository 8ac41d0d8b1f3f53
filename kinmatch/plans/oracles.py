"""DuckDB SQL for the registered queries, written apart from the Spark plans: one chain of named tables, a SELECT for each query."""

from __future__ import annotations


def _sim(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL AND {b} IS NULL THEN 1.0::DOUBLE WHEN {a} IS NULL OR {b} IS NULL THEN 0.0::DOUBLE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})) END)"


def _dob(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NOT DISTINCT FROM {b} THEN 1.0 ELSE 0.0 END)::DOUBLE"


def _scored(l: str, r: str) -> str:
    """nom, prenom, dob, commune as columns s1 to s4."""
    return f"{_sim(f'{l}.nom', f'{r}.nom')} AS s1, {_sim(f'{l}.prenom', f'{r}.prenom')} AS s2, {_dob(f'{l}.dob', f'{r}.dob')} AS s3, {_sim(f'{l}.commune', f'{r}.commune')} AS s4"


_TOTAL = "(s1 + s2 + s3 + s4) / 4"
_SAME_BLOCK = "year(a.dob) = year(b.dob) AND left(a.nom, 2) = left(b.nom, 2) AND left(a.prenom, 2) = left(b.prenom, 2)"
_SCORES = "round(total, 6) AS score_total, round(s1, 6) AS score_nom, round(s2, 6) AS score_prenom, round(s3, 6) AS score_dob, round(s4, 6) AS score_commune"

PRELUDE = f"""
WITH RECURSIVE people AS (
  SELECT c_custkey AS id, 'PERSON' || lpad((c_custkey - c_custkey % 3)::VARCHAR, 9, '0') || CASE WHEN c_custkey % 3 = 1 THEN 'X' ELSE '' END AS nom,
         CASE (c_custkey - c_custkey % 3) % 5 WHEN 0 THEN 'ALICE' WHEN 1 THEN 'BOB' WHEN 2 THEN 'CHLOE' WHEN 3 THEN 'DAVID' ELSE 'EMMA' END AS prenom,
         make_date(1950 + (c_custkey - c_custkey % 3) % 40, 1, 1 + (c_custkey - c_custkey % 3) % 28) AS dob,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN (c_custkey - c_custkey % 3) % 2 = 0 THEN 'CITY' || ((c_custkey - c_custkey % 3) % 7)::VARCHAR ELSE n_name END AS commune
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
pairs AS (SELECT l.id, l.nom AS l_nom, r.nom AS r_nom, l.prenom AS l_prenom, r.prenom AS r_prenom, l.dob AS l_dob, r.dob AS r_dob, l.commune AS l_commune, r.commune AS r_commune, {_scored("l", "r")}
          FROM people l JOIN people r ON r.id = l.id + 1),
decl AS (SELECT *, id % 7 AS day, id % 25 <> 4 AS is_open FROM people WHERE id % 10 <> 0),
fmt AS (SELECT id AS master, nom, prenom, dob, commune, id % 7 AS day, id % 70 <> 0 AS is_open FROM people WHERE id % 10 = 0
        UNION ALL SELECT id - 1, nom, prenom, dob, commune, id % 5, TRUE FROM people WHERE id % 40 = 1),
map0 AS (SELECT id, id - 3 AS master, 'Matched' AS status, id % 50 = 3 AS is_open FROM people WHERE id % 50 IN (3, 13)),
staged AS (SELECT * FROM decl d WHERE is_open AND id NOT IN (SELECT id FROM map0 WHERE is_open)),
firm AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 13 <> 0 THEN 'SIRET' || lpad(s_suppkey::VARCHAR, 9, '0') END AS siret, s_suppkey % 25 <> 4 AS is_open FROM supplier),
firm_fmt AS (SELECT id AS pe, siret, id % 7 AS day, TRUE AS is_open FROM firm WHERE id % 2 = 0
             UNION ALL SELECT id + 100000000, siret, id % 5, id % 3 <> 0 FROM firm WHERE id % 4 = 0),
firm_staged AS (SELECT id, siret FROM firm WHERE is_open AND id NOT IN (SELECT id FROM map0 WHERE is_open)),
firm_latest AS (SELECT siret, pe FROM (SELECT *, row_number() OVER (PARTITION BY siret ORDER BY day DESC, pe) AS rn FROM firm_fmt WHERE is_open AND siret IS NOT NULL) WHERE rn = 1),
firm_match AS (
  SELECT id, f.siret, coalesce(pe, 2000000000 + sum(CASE WHEN pe IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY id)::BIGINT) AS pe
  FROM firm_staged f LEFT JOIN firm_latest l ON f.siret = l.siret),
map2 AS (SELECT coalesce(m.id, f.id) AS id, m.master, m.status, f.pe, CASE WHEN f.id IS NOT NULL THEN 'Matched' END AS pe_status
         FROM map0 m FULL JOIN firm_match f ON m.id = f.id),
exact AS (
  SELECT * FROM (
    SELECT s.*, f.master, row_number() OVER (PARTITION BY s.id ORDER BY f.day DESC NULLS LAST, f.master) AS rn
    FROM staged s LEFT JOIN (SELECT * FROM fmt WHERE is_open) f ON s.nom = f.nom AND s.prenom = f.prenom AND s.dob = f.dob AND s.commune = f.commune)
  WHERE rn = 1),
rest AS (SELECT id, nom, prenom, dob, commune FROM exact WHERE master IS NULL),
map3 AS (
  SELECT coalesce(m.id, e.id) AS id, CASE WHEN e.id IS NULL THEN m.master ELSE e.master END AS master,
         CASE WHEN e.id IS NULL THEN m.status WHEN e.master IS NOT NULL THEN 'Matched' END AS status, m.pe, m.pe_status
  FROM map2 m FULL JOIN (SELECT id, master FROM exact) e ON m.id = e.id WHERE m.id IS NOT NULL OR e.master IS NOT NULL),
scored AS (SELECT *, {_TOTAL} AS total FROM (SELECT a.id, b.master, {_scored("a", "b")} FROM rest a JOIN fmt b ON b.is_open AND {_SAME_BLOCK})),
cand AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, master ORDER BY total DESC, s1 DESC, s2 DESC, s3 DESC, s4 DESC) AS rn FROM scored WHERE total >= 0.8)
  WHERE rn = 1),
best AS (SELECT id, count(*) AS n, max(total) AS score, arg_min(master, (-total, master)) AS best FROM cand GROUP BY id),
map4 AS (
  SELECT coalesce(m.id, b.id) AS id, m.master, CASE WHEN b.id IS NULL THEN m.status WHEN b.n = 1 THEN 'Proba_One_Match_to_stewardship' ELSE 'Proba_Several_Match_to_stewardship' END AS status,
         m.pe, m.pe_status, b.best, b.score
  FROM map3 m FULL JOIN best b ON m.id = b.id),
edges AS (SELECT *, {_TOTAL} AS total FROM (SELECT a.id AS a, b.id AS b, {_scored("a", "b")} FROM rest a JOIN rest b ON a.id < b.id AND {_SAME_BLOCK}) WHERE {_TOTAL} >= 0.8),
both_ways AS (SELECT a, b, total FROM edges UNION ALL SELECT b, a, total FROM edges),
reach AS (SELECT id AS node, id AS other FROM rest UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.other),
comp AS (SELECT node, min(other) AS comp FROM reach GROUP BY node),
clusters AS (
  SELECT nom, prenom, dob, commune, count(*) AS cnt, 1000000000 + row_number() OVER (ORDER BY nom, prenom, dob, commune) AS new_id
  FROM rest LEFT JOIN map4 USING (id) WHERE master IS NULL AND nom IS NOT NULL AND prenom IS NOT NULL AND dob IS NOT NULL AND commune IS NOT NULL
  GROUP BY nom, prenom, dob, commune HAVING count(*) > 1),
clustered AS (
  SELECT r.id, c.new_id FROM rest r LEFT JOIN clusters c ON r.nom = c.nom AND r.prenom = c.prenom AND r.dob = c.dob AND r.commune = c.commune),
stats AS (SELECT comp, count(*) AS node_count, count(DISTINCT new_id) AS masterid_count, min(node) AS pivot_node FROM comp JOIN clustered ON node = id GROUP BY comp),
pivot_ids AS (SELECT pivot_node, 1000000000 + (SELECT count(*) FROM clusters) + row_number() OVER (ORDER BY pivot_node) AS new_id FROM stats WHERE masterid_count = 0),
masters AS (SELECT node, comp, coalesce(c.new_id, p.new_id) AS master FROM comp JOIN clustered c ON node = c.id LEFT JOIN pivot_ids p ON node = pivot_node),
k AS (SELECT comp, count(DISTINCT master) AS k FROM masters GROUP BY comp),
intrarun AS (
  SELECT f.node, a.master, k.k,
         CASE WHEN k.k = 1 THEN coalesce(max(e.total), 1.0) ELSE max(coalesce(e.total, 0.8)) END AS score
  FROM masters f JOIN k USING (comp) JOIN masters a ON a.comp = f.comp AND a.master IS NOT NULL
  LEFT JOIN both_ways e ON e.a = f.node AND e.b = a.node
  WHERE f.master IS NULL AND k.k > 0 GROUP BY f.node, a.master, k.k),
best_in AS (SELECT node, any_value(k) AS k, max(score) AS score, arg_min(master, (-score, master)) AS best FROM intrarun GROUP BY node),
map8 AS (
  SELECT coalesce(m.id, n.node) AS id, coalesce(n.master, m.master) AS master,
         CASE WHEN n.master IS NOT NULL THEN CASE WHEN c.new_id IS NOT NULL THEN 'Created' ELSE 'Matched' END
              WHEN b.k = 1 THEN 'Proba_One_Match_to_stewardship' WHEN b.k > 1 THEN 'Proba_Several_Match_to_stewardship' ELSE m.status END AS status,
         m.pe, m.pe_status, coalesce(b.best, m.best) AS best, coalesce(b.score, m.score) AS score
  FROM map4 m FULL JOIN masters n ON m.id = n.node LEFT JOIN clustered c ON c.id = n.node LEFT JOIN best_in b ON b.node = n.node
  WHERE m.id IS NOT NULL OR n.master IS NOT NULL OR b.node IS NOT NULL),
relations AS (
  SELECT m.master::BIGINT AS spe, m.pe::BIGINT AS pe FROM staged s JOIN map8 m ON s.id = m.id
  WHERE m.status = 'Matched' AND m.pe_status = 'Matched' AND m.master IS NOT NULL AND m.pe IS NOT NULL GROUP BY ALL),
choices AS (
  SELECT id, id AS decision, CASE WHEN id % 60 = 7 THEN 'APPROVED' WHEN id % 90 = 37 THEN 'REJECTED' ELSE 'PENDING' END AS status, id - 7 AS chosen, id % 3 AS day FROM people WHERE id % 30 = 7
  UNION ALL SELECT id, id + 500000000, 'REJECTED', NULL, 5 FROM people WHERE id % 120 = 7),
decided_in_run AS (
  SELECT id, status, chosen FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY day DESC, decision DESC) AS rn FROM choices
    WHERE status IN ('APPROVED', 'REJECTED') AND decision % 4 = 1) WHERE rn = 1),
decided AS (
  SELECT id, status, chosen FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY day DESC, decision DESC) AS rn FROM (
      SELECT id, id AS decision, CASE WHEN id % 60 = 7 THEN 'APPROVED' WHEN id % 90 = 37 THEN 'REJECTED' ELSE 'PENDING' END AS status, id - 7 AS chosen, id % 3 AS day FROM people WHERE id % 30 = 7
      UNION ALL SELECT id, id + 500000000, 'REJECTED', NULL, 5 FROM people WHERE id % 120 = 7)
    WHERE status IN ('APPROVED', 'REJECTED')) WHERE rn = 1),
stewarded AS (
  SELECT coalesce(m.id, d.id) AS id, CASE WHEN d.status = 'APPROVED' THEN d.chosen ELSE m.master END AS master,
         CASE d.status WHEN 'APPROVED' THEN 'Matched' WHEN 'REJECTED' THEN 'Rejected' ELSE m.status END AS status
  FROM map0 m FULL JOIN decided d ON m.id = d.id),
old_golden AS (SELECT id, CASE WHEN id % 8 = 0 THEN nom || 'OLD' ELSE nom END AS nom, prenom, dob, commune FROM people WHERE id % 4 = 0),
old_hashed AS (SELECT id, nom, sha256(concat_ws('|', nom, prenom, dob::VARCHAR, commune)) AS h FROM old_golden),
new_hashed AS (SELECT id, nom, sha256(concat_ws('|', nom, prenom, dob::VARCHAR, commune)) AS h FROM people WHERE id % 2 = 0),
pe_all AS (SELECT pe, siret FROM firm_fmt UNION ALL SELECT pe, siret FROM firm_match WHERE pe > 2000000000),
pe_old AS (SELECT pe, min(siret || 'Z') AS siret FROM pe_all WHERE pe % 3 = 0 GROUP BY pe),
pe_old_hashed AS (SELECT pe, siret, sha256(coalesce(siret, '')) AS h FROM pe_old),
pe_new_hashed AS (SELECT pe, siret, sha256(coalesce(siret, '')) AS h FROM firm_match)
"""

# Companies of one line each: a master that several lines declare would need the latest; suppliers are unique.
SELECTS = {
    "levenshtein_pairs": "SELECT id, levenshtein(coalesce(l_nom, ''), coalesce(r_nom, ''))::BIGINT AS nom, levenshtein(coalesce(l_commune, ''), coalesce(r_commune, ''))::BIGINT AS commune FROM pairs",
    "string_similarity": "SELECT id, round(s1, 6) AS nom, round(s2, 6) AS prenom, round(s4, 6) AS commune FROM pairs",
    "date_similarity": f"SELECT id, {_dob('l_dob', '(CASE WHEN id % 5 <> 0 THEN r_dob END)')} AS dob FROM pairs",
    "person_score": f"SELECT id, round({_TOTAL}, 6) AS score FROM pairs",
    "blocking_keys": "SELECT id, year(dob)::BIGINT AS blocking_year, left(nom, 2) AS blocking_nom2, left(prenom, 2) AS blocking_pre2 FROM people",
    "canon_person": "SELECT id, nom, prenom, dob, commune, is_open FROM decl",
    "canon_company": "SELECT id, siret AS pseudo_siret, is_open FROM firm",
    "canon_person_format": "SELECT master AS spe_masterid, nom, commune, year(dob)::BIGINT AS blocking_year, left(nom, 2) AS blocking_nom2, left(prenom, 2) AS blocking_pre2, is_open FROM fmt",
    "canon_company_format": "SELECT pe AS pe_masterid, siret AS pseudo_siret, is_open FROM firm_fmt",
    "canon_mapping": "SELECT id, master AS spe_masterid, status AS spe_match_status, is_open FROM map0",
    "stage_new_persons": "SELECT id, nom, commune FROM staged",
    "stage_new_companies": "SELECT id, siret AS pseudo_siret FROM firm_staged",
    "company_latest_format": "SELECT siret AS pseudo_siret, pe AS pe_masterid FROM firm_latest",
    "company_match_upsert": "SELECT id, master AS spe_masterid, status AS spe_match_status, pe AS pe_masterid, pe_status AS pe_match_status FROM map2",
    "company_new_formats": "SELECT pe AS pe_masterid, siret AS pseudo_siret FROM firm_match WHERE pe > 2000000000",
    "person_exact_match": "SELECT id, master AS spe_masterid FROM exact WHERE master IS NOT NULL",
    "person_exact_upsert": "SELECT id, master AS spe_masterid, status AS spe_match_status, pe AS pe_masterid FROM map3",
    "person_nonmatched": "SELECT id, nom, year(dob)::BIGINT AS blocking_year FROM rest",
    "person_candidates": f"SELECT id, master AS candidate, {_SCORES} FROM cand",
    "candidate_counts": "SELECT id, n::BIGINT AS candidates, round(score, 6) AS best_score FROM best",
    "best_candidate": "SELECT id, best FROM best",
    "graph_nodes": "SELECT id AS node_id, prenom, NULL::BIGINT AS spe_masterid FROM rest",
    "graph_edges": f"SELECT a AS node_a, b AS node_b, {_SCORES} FROM edges",
    "connected_components": "SELECT node AS node_id, comp AS component_id FROM comp",
    "exact_clusters": "SELECT nom, prenom, dob, commune, cnt::BIGINT AS cnt FROM clusters",
    "cluster_master_ids": "SELECT id AS node_id, new_id::BIGINT AS spe_masterid FROM clustered WHERE new_id IS NOT NULL",
    "component_stats": "SELECT comp AS component_id, node_count::BIGINT AS node_count, masterid_count::BIGINT AS masterid_count, pivot_node FROM stats",
    "pivots": "SELECT node AS node_id, master::BIGINT AS spe_masterid FROM masters WHERE master IS NOT NULL",
    "case1_candidates": "SELECT node AS node_id, master::BIGINT AS candidate, round(score, 6) AS score_total FROM intrarun WHERE k = 1",
    "case2_candidates": "SELECT node AS node_id, master::BIGINT AS candidate, round(score, 6) AS score_total FROM intrarun WHERE k > 1",
    "best_intrarun": "SELECT node AS node_id, best::BIGINT AS best, round(score, 6) AS best_score FROM best_in",
    "mapping_final": "SELECT id, master::BIGINT AS spe_masterid, pe AS pe_masterid, status AS spe_match_status, pe_status AS pe_match_status, best::BIGINT AS best, round(score, 6) AS best_score FROM map8",
    "golden_persons": """
SELECT spe_masterid, spe_nom, spe_prenom, "spe_dateNaissance", "spe_communeNaissance", TRUE AS is_current, sha256(concat_ws('|', spe_nom, spe_prenom, "spe_dateNaissance"::VARCHAR, "spe_communeNaissance")) AS row_hash
FROM (SELECT m.master::BIGINT AS spe_masterid, nom AS spe_nom, prenom AS spe_prenom, dob AS "spe_dateNaissance", commune AS "spe_communeNaissance",
             row_number() OVER (PARTITION BY m.master ORDER BY day DESC, s.id DESC) AS rn
      FROM staged s JOIN map8 m ON s.id = m.id WHERE m.status = 'Matched' AND m.master IS NOT NULL) WHERE rn = 1""",
    "scd2_person": """
SELECT o.id AS spe_masterid, o.nom AS spe_nom, coalesce(n.h = o.h, TRUE) AS is_current, TRUE AND coalesce(n.h = o.h, TRUE) AS is_open, 'SILVER' AS source_system, o.h AS row_hash FROM old_hashed o LEFT JOIN new_hashed n USING (id)
UNION ALL SELECT n.id, n.nom, TRUE, TRUE, 'SILVER', n.h FROM new_hashed n LEFT JOIN old_hashed o USING (id) WHERE o.h IS NULL OR o.h <> n.h""",
    "scd2_close": "SELECT o.id AS spe_masterid, o.nom AS spe_nom FROM old_hashed o JOIN new_hashed n USING (id) WHERE o.h <> n.h",
    "scd2_company": """
SELECT o.pe AS pe_masterid, o.siret AS pseudo_siret, coalesce(n.h = o.h, TRUE) AS is_current, coalesce(n.h = o.h, TRUE) AS is_open, 'SILVER' AS source_system, o.h AS row_hash FROM pe_old_hashed o LEFT JOIN pe_new_hashed n USING (pe)
UNION ALL SELECT n.pe, n.siret, TRUE, TRUE, 'SILVER', n.h FROM pe_new_hashed n LEFT JOIN pe_old_hashed o USING (pe) WHERE o.h IS NULL OR o.h <> n.h""",
    "scd2_relation": """
SELECT *, TRUE AS is_current, sha256(concat_ws('|', employment_type, date_debut_relation::VARCHAR, date_fin_relation::VARCHAR)) AS row_hash
FROM (SELECT id - id % 6 AS spe_masterid, id % 6 + 1 AS pe_masterid, CASE WHEN (id - id % 6) % 4 = 0 THEN 'CDI' END AS employment_type, min(dob) AS date_debut_relation, max(dob) AS date_fin_relation
      FROM staged GROUP BY ALL)""",
    "stewardship_approved": "SELECT id, master AS spe_masterid, status AS spe_match_status FROM stewarded WHERE status = 'Matched'",
    "stewardship_rejected": "SELECT id, master AS spe_masterid, status AS spe_match_status FROM stewarded WHERE status = 'Rejected'",
    "person_new_formats": """
SELECT new_id::BIGINT AS spe_masterid, nom, prenom, dob, commune FROM clusters
UNION ALL SELECT p.new_id::BIGINT, r.nom, r.prenom, r.dob, r.commune FROM pivot_ids p JOIN rest r ON r.id = p.pivot_node""",
    "relation_run": """
SELECT spe AS spe_masterid, pe AS pe_masterid, '' AS employment_type, spe % 4 <> 0 AS is_current, spe % 4 <> 0 AS is_open, CASE WHEN spe % 4 = 0 THEN sha256('old') ELSE sha256('') END AS row_hash FROM relations WHERE spe % 2 = 0
UNION ALL SELECT spe, pe, '', FALSE, FALSE, CASE WHEN spe % 4 = 0 THEN sha256('old') ELSE sha256('') END FROM relations WHERE spe % 2 = 0
UNION ALL SELECT spe, pe, NULL, TRUE, TRUE, sha256('') FROM relations WHERE spe % 4 = 0 OR spe % 2 = 1""",
    "merge_watermark": """
SELECT spe_masterid, spe_nom, TRUE AS is_current, '2024-03-01' AS marked
FROM (SELECT m.master::BIGINT AS spe_masterid, nom AS spe_nom, row_number() OVER (PARTITION BY m.master ORDER BY day DESC, s.id DESC) AS rn
      FROM staged s JOIN map8 m ON s.id = m.id WHERE m.status = 'Matched' AND m.master IS NOT NULL AND day >= 3) WHERE rn = 1""",
    "second_run": """
SELECT id FROM staged WHERE id IN (SELECT id FROM map0 WHERE NOT is_open) OR id NOT IN (SELECT id FROM map8)""",
    "repeated_step": "SELECT 'demo' AS run_id, count(*)::BIGINT AS persons FROM staged UNION ALL SELECT 'demo2', count(*) FROM staged",
    "step_metrics": """
SELECT '01_stage_new_declarations:stg_new_decl_spe' AS step, count(*)::BIGINT AS row_count FROM staged
UNION ALL SELECT '01_stage_new_declarations:stg_new_decl_pe', count(*) FROM firm_staged
UNION ALL SELECT '02_match_pe:mapping', count(*) FROM map2
UNION ALL SELECT '02_match_pe:pe_enriched', (SELECT count(*) FROM firm_fmt) + (SELECT count(*) FROM firm_match WHERE pe > 2000000000)
UNION ALL SELECT '03_match_spe_deterministic:mapping', count(*) FROM map3
UNION ALL SELECT '03_match_spe_deterministic:stg_spe_nonmatched', count(*) FROM rest
UNION ALL SELECT '04_match_spe_probabilistic_candidates:mapping', count(*) FROM map4
UNION ALL SELECT '04_match_spe_probabilistic_candidates:spe_match_candidates', count(*) FROM cand
UNION ALL SELECT '05_build_intrarun_graph:spe_nodes', count(*) FROM rest
UNION ALL SELECT '05_build_intrarun_graph:spe_edges', count(*) FROM edges
UNION ALL SELECT '06_compute_connected_components:spe_components', count(*) FROM rest""",
    "run_journal": """
SELECT * FROM (VALUES ('run1', 'error', '01_only', 'a step broke', FALSE), ('run1', 'run', 'Failed', 'a step broke', TRUE), ('run0', 'run', 'Success', NULL, TRUE)) AS t(run_id, kind, what, message, in_order)""",
    "top_components": "SELECT comp AS component_id, node AS node_id FROM comp ORDER BY comp, node LIMIT 10",
    "candidate_report": "SELECT node AS node_id, master::BIGINT AS candidate, round(score, 6) AS score_total FROM intrarun ORDER BY node, master",
    "status_report": "SELECT id, concat(status, ':', master, ':', pe) AS line FROM map8 WHERE status IN ('Created', 'Matched') ORDER BY id",
    "stewardship_formats": """
SELECT DISTINCT d.chosen AS spe_masterid, r.nom, r.prenom, r.dob, r.commune FROM decided d JOIN rest r ON r.id = d.id
WHERE d.status = 'APPROVED' AND NOT EXISTS (SELECT 1 FROM fmt f WHERE f.master = d.chosen AND f.nom IS NOT DISTINCT FROM r.nom AND f.prenom IS NOT DISTINCT FROM r.prenom AND f.dob IS NOT DISTINCT FROM r.dob AND f.commune IS NOT DISTINCT FROM r.commune)""",
    "stewardship_of_run": """
SELECT coalesce(m.id, d.id) AS id, CASE WHEN d.status = 'APPROVED' THEN d.chosen ELSE m.master END AS spe_masterid,
       CASE d.status WHEN 'APPROVED' THEN 'Matched' WHEN 'REJECTED' THEN 'Rejected' ELSE m.status END AS spe_match_status
FROM map0 m FULL JOIN decided_in_run d ON m.id = d.id""",
    "rounds_counted": "SELECT node AS node_id, comp AS component_id FROM comp",
}

ORACLE_SQL = {name: f"{PRELUDE}{select}" for name, select in SELECTS.items()}
