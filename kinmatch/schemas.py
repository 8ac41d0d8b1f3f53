"""The tables, as DDL: control, staging, quality, golden and silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_ATTRIBUTES = "spe_nom_normalized string, spe_prenom_normalized string, spe_dateNaissance date, spe_communeNaissance string"
_BLOCKING = "blocking_year int, blocking_nom2 string, blocking_pre2 string"
_SCORES = "score_total double, score_nom double, score_prenom double, score_dob double, score_commune double"
_AT = "timestamp_ntz"
_VERSION = f"valid_from {_AT}, valid_to {_AT}, is_current boolean"

TABLES = {
    # control
    "process_run": f"run_id string, process_name string, start_ts {_AT}, end_ts {_AT}, status string, error_message string, host_name string, executed_by string",
    "process_metrics": f"run_id string, step_name string, created_at {_AT}, row_count long, duration_ms long, comment string",
    "process_error": f"run_id string, step_name string, error_number int, error_message string, error_line int, error_procedure string, error_ts {_AT}",
    "merge_log": f"label string, last_success_ts {_AT}",
    # staging
    "stg_new_decl_spe": f"run_id string, id_ligne_declaration long, spe_nom string, spe_nom_normalized string, spe_prenom string, spe_prenom_normalized string, spe_dateNaissance date, spe_communeNaissance string, created_at {_AT}, {_BLOCKING}",
    "stg_new_decl_pe": f"run_id string, id_ligne_declaration long, pseudo_siret string, pe_masterid long, created_at {_AT}",
    "stg_spe_nonmatched": f"run_id string, id_ligne_declaration long, {_ATTRIBUTES}, created_at {_AT}, {_BLOCKING}",
    "spe_nodes": f"run_id string, node_id long, id_ligne_declaration long, {_ATTRIBUTES}, spe_masterid long, created_at {_AT}, {_BLOCKING}",
    "spe_edges": f"run_id string, node_a long, node_b long, {_SCORES}, created_at {_AT}",
    "spe_components": f"run_id string, node_id long, component_id long, updated_at {_AT}",
    # quality
    "spe_match_candidates": f"run_id string, id_ligne_declaration long, candidate_spe_masterid long, {_SCORES}, created_at {_AT}",
    "spe_match_candidates_intrarun": f"run_id string, node_id long, candidate_spe_masterid long, score_total double, created_at {_AT}",
    "spe_stewardship_decision": f"decision_id long, run_id string, id_ligne_declaration long, decision_status string, chosen_spe_masterid long, decided_by string, decided_at {_AT}, comment string",
    # golden
    "master_spe": f"spe_masterid long, {_VERSION}, source_system string, spe_nom string, spe_prenom string, spe_dateNaissance date, spe_communeNaissance string, rnvp_ok boolean, row_hash binary, created_at {_AT}, updated_at {_AT}",
    "master_pe": f"pe_masterid long, {_VERSION}, source_system string, pseudo_siret string, rnvp_ok boolean, row_hash binary, created_at {_AT}, updated_at {_AT}",
    "master_relation": f"spe_masterid long, pe_masterid long, employment_type string, {_VERSION}, date_debut_relation date, date_fin_relation date, row_hash binary, created_at {_AT}, updated_at {_AT}",
    # silver
    "decl_spe": f"id_ligne_declaration long, spe_nom string, spe_nom_normalized string, spe_prenom string, spe_prenom_normalized string, spe_dateNaissance date, spe_communeNaissance string, created_at {_AT}, valid_to {_AT}",
    "decl_pe": f"id_ligne_declaration long, pseudo_siret string, created_at {_AT}, valid_to {_AT}",
    "spe_enriched": f"spe_masterid long, {_ATTRIBUTES}, rnvp_ok boolean, created_at {_AT}, valid_to {_AT}",
    "pe_enriched": f"pe_masterid long, pseudo_siret string, rnvp_ok boolean, created_at {_AT}, valid_to {_AT}",
    "mapping": f"id_ligne_declaration long, spe_masterid long, pe_masterid long, spe_match_status string, pe_match_status string, best_candidate_masterid long, best_score double, created_at {_AT}, updated_at {_AT}, valid_to {_AT}",
}

#: Primary keys; Spark enforces none, tests do.
KEYS = {
    "process_run": ["run_id"],
    "process_metrics": ["run_id", "step_name", "created_at"],
    "merge_log": ["label"],
    "stg_new_decl_spe": ["run_id", "id_ligne_declaration"],
    "stg_new_decl_pe": ["run_id", "id_ligne_declaration"],
    "stg_spe_nonmatched": ["run_id", "id_ligne_declaration"],
    "spe_nodes": ["run_id", "node_id"],
    "spe_edges": ["run_id", "node_a", "node_b"],
    "spe_components": ["run_id", "node_id"],
    "spe_match_candidates": ["run_id", "id_ligne_declaration", "candidate_spe_masterid"],
    "spe_match_candidates_intrarun": ["run_id", "node_id", "candidate_spe_masterid"],
    "spe_stewardship_decision": ["decision_id"],
    "master_spe": ["spe_masterid", "valid_from"],
    "master_pe": ["pe_masterid", "valid_from"],
    "master_relation": ["spe_masterid", "pe_masterid", "valid_from"],
    "decl_spe": ["id_ligne_declaration"],
    "decl_pe": ["id_ligne_declaration"],
    "mapping": ["id_ligne_declaration"],
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    """No rows, as a plan that the optimizer leaves out of unions and joins: no task starts for it."""
    return conform(spark.range(1).where("false"), name)


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in order, missing ones as typed nulls."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(TABLES[name])])
