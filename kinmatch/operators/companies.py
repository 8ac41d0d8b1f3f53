"""Step 02: companies by pseudo_siret."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import numbered
from ..sources import canon
from ..state import MATCHED, Params, State, current, upsert_mapping


def latest_formats(formats: DataFrame) -> DataFrame:
    """(pseudo_siret, pe_masterid) of the latest current format; of equally late ones the lowest id."""
    newest = F.max(F.struct("created_at", (-F.col("pe_masterid")).alias("lowest")))
    found = current(formats).where(F.col("pseudo_siret").isNotNull()).groupBy("pseudo_siret").agg(newest.alias("newest"))
    return found.select("pseudo_siret", (-F.col("newest.lowest")).alias("pe_masterid"))


def match_companies(state: State, params: Params) -> State:
    """Known companies get their id, others a new one each (or each pseudo_siret, by option); all are Matched."""
    formats = state["pe_enriched"]
    staged = state.of_run("stg_new_decl_pe", params.run_id).select("id_ligne_declaration", "pseudo_siret")
    found = staged.join(latest_formats(canon.company_formats(formats)), "pseudo_siret", "left")
    known, new = found.where("pe_masterid IS NOT NULL"), found.where("pe_masterid IS NULL").drop("pe_masterid")
    if params.share_new_company_id:
        # a null pseudo_siret is nobody else's
        own = F.when(F.col("pseudo_siret").isNull(), F.col("id_ligne_declaration"))
        new = new.withColumn("own", own)
        ids, last = numbered(new.groupBy("pseudo_siret", "own").agg(F.min("id_ligne_declaration").alias("first")), ["first"], "pe_masterid", state.last_company)
        ids = ids.select(F.col("pseudo_siret").alias("s"), F.col("own").alias("o"), "pe_masterid")
        new = new.join(ids, F.col("pseudo_siret").eqNullSafe(F.col("s")) & F.col("own").eqNullSafe(F.col("o"))).select("pseudo_siret", "id_ligne_declaration", "pe_masterid")
    else:
        new, last = numbered(new, ["id_ligne_declaration"], "pe_masterid", state.last_company)
    matched = known.unionByName(new)
    changes = matched.select("id_ligne_declaration", "pe_masterid", F.lit(MATCHED).alias("pe_match_status"))
    there = formats.select("pe_masterid", "pseudo_siret")
    missing = matched.select("pe_masterid", "pseudo_siret").distinct().join(there, ["pe_masterid", "pseudo_siret"], "left_anti")
    return state.put(
        last_company=last,
        mapping=upsert_mapping(state["mapping"], changes, ["pe_masterid", "pe_match_status"], params.now),
        pe_enriched=state.append("pe_enriched", missing.withColumn("created_at", params.now)),
    )
