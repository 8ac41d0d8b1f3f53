"""Human decisions on candidates, applied apart from runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import MATCH
from ..state import MATCHED, REJECTED, Params, State, upsert_mapping


def valid_decisions(decisions: DataFrame, run_id: str | None = None) -> DataFrame:
    """One decision a declaration, the latest by decided_at, then decision_id; other statuses are ignored."""
    rows = decisions.where(F.col("decision_status").isin("APPROVED", "REJECTED"))
    if run_id is not None:
        rows = rows.where(F.col("run_id") == run_id)
    fields = ["decided_at", "decision_id", "decision_status", "chosen_spe_masterid", "run_id"]
    last = rows.groupBy("id_ligne_declaration").agg(F.max(F.struct(*fields)).alias("last"))
    return last.select("id_ligne_declaration", *[F.col(f"last.{c}") for c in fields[1:]])


def _nodes_of(decisions: DataFrame, nodes: DataFrame) -> DataFrame:
    """Attributes of the declarations decided on: of the decision's run, or of the latest one."""
    columns = ["created_at", "run_id", *MATCH]
    own = nodes.groupBy("id_ligne_declaration", "run_id").agg(F.max(F.struct(*columns)).alias("own"))
    latest = nodes.groupBy("id_ligne_declaration").agg(F.max(F.struct(*columns)).alias("latest"))
    rows = decisions.join(own, ["id_ligne_declaration", "run_id"], "left").join(latest, "id_ligne_declaration", "left")
    node = F.when(F.col("run_id").isNull(), F.col("latest")).otherwise(F.col("own"))
    return rows.withColumn("node", node).where("node IS NOT NULL").select("chosen_spe_masterid", *[F.col(f"node.{c}").alias(c) for c in MATCH])


def apply_decisions(state: State, params: Params, run_id: str | None = None) -> State:
    """APPROVED sets the chosen master and Matched and adds the format; REJECTED sets Rejected and keeps any master.

    Raises on an approval without a chosen master. Applying decisions again
    changes no status and adds no format.
    """
    decisions = valid_decisions(state["spe_stewardship_decision"], run_id)
    approved = decisions.where("decision_status = 'APPROVED'")
    if (bad := approved.where("chosen_spe_masterid IS NULL").first()) is not None:
        raise ValueError(f"decision {bad.decision_id} approves no master")
    yes = approved.select("id_ligne_declaration", F.col("chosen_spe_masterid").alias("spe_masterid"), F.lit(MATCHED).alias("spe_match_status"))
    no = decisions.where("decision_status = 'REJECTED'").select("id_ligne_declaration", F.lit(REJECTED).alias("spe_match_status"))
    mapping = upsert_mapping(state["mapping"], yes, ["spe_masterid", "spe_match_status"], params.now)
    mapping = upsert_mapping(mapping, no, ["spe_match_status"], params.now)
    formats = _nodes_of(approved, state["spe_nodes"]).withColumnRenamed("chosen_spe_masterid", "spe_masterid").distinct()
    f, e = formats.alias("f"), state["spe_enriched"].alias("e")
    same = F.col("f.spe_masterid") == F.col("e.spe_masterid")
    for c in MATCH:
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"e.{c}"))
    missing = f.join(e, same, "left_anti").select("f.*")
    return state.put(mapping=mapping, spe_enriched=state.append("spe_enriched", missing.withColumn("created_at", params.now)))
