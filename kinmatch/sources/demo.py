"""Persons and companies made from the sample star schema, for queries and benchmarks.

Three customers in a row share a name, but for a letter at the end of the
second's; half of the groups share a city too. Every tenth customer is a known person; some masters have several formats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..state import MATCHED, State

START = "2024-01-01 00:00:00"


def _at(days) -> F.Column:
    return F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(days.cast("int"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    i = F.col("id")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("id"), "n_name", (F.col("c_custkey") - F.col("c_custkey") % 3).alias("g"))
    first = F.element_at(F.array(*[F.lit(x) for x in ("ALICE", "BOB", "CHLOE", "DAVID", "EMMA")]), (F.col("g") % 5 + 1).cast("int"))
    return rows.select(
        "id",
        F.concat(F.lit("PERSON"), F.lpad(F.col("g").cast("string"), 9, "0"), F.when(i % 3 == 1, "X").otherwise("")).alias("spe_nom_normalized"),
        first.alias("spe_prenom_normalized"),
        F.make_date((F.lit(1950) + F.col("g") % 40).cast("int"), F.lit(1), (F.lit(1) + F.col("g") % 28).cast("int")).alias("spe_dateNaissance"),
        F.when(i % 17 == 0, None).when(F.col("g") % 2 == 0, F.concat(F.lit("CITY"), (F.col("g") % 7).cast("string"))).otherwise(F.col("n_name")).alias("spe_communeNaissance"),
    )


def state(spark: SparkSession, sf_dir: str) -> State:
    """Declarations, formats, mappings and decisions."""
    p = people(spark, sf_dir)
    i = F.col("id")
    names = ["spe_nom_normalized", "spe_prenom_normalized", "spe_dateNaissance", "spe_communeNaissance"]
    decl = p.where(i % 10 != 0).select(
        i.alias("id_ligne_declaration"),
        F.col("spe_nom_normalized").alias("spe_nom"),
        "spe_nom_normalized",
        F.col("spe_prenom_normalized").alias("spe_prenom"),
        "spe_prenom_normalized",
        "spe_dateNaissance",
        "spe_communeNaissance",
        _at(i % 7).alias("created_at"),
        F.when(i % 25 == 4, _at(F.lit(30))).alias("valid_to"),
    )
    known = p.where(i % 10 == 0).select(i.alias("spe_masterid"), *names, _at(i % 7).alias("created_at"), F.when(i % 70 == 0, _at(F.lit(20))).alias("valid_to"))
    more = p.where(i % 40 == 1).select((i - 1).alias("spe_masterid"), *names, _at(i % 5).alias("created_at"), F.lit(None).alias("valid_to"))
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("id"))
    siret = F.when(i % 13 != 0, F.concat(F.lit("SIRET"), F.lpad(i.cast("string"), 9, "0")))
    firms = s.select(i.alias("id_ligne_declaration"), siret.alias("pseudo_siret"), _at(i % 7).alias("created_at"), F.when(i % 25 == 4, _at(F.lit(30))).alias("valid_to"))
    firm_known = s.where(i % 2 == 0).select(i.alias("pe_masterid"), siret.alias("pseudo_siret"), _at(i % 7).alias("created_at"), F.lit(None).alias("valid_to"))
    firm_more = s.where(i % 4 == 0).select((i + 100_000_000).alias("pe_masterid"), siret.alias("pseudo_siret"), _at(i % 5).alias("created_at"), F.when(i % 3 == 0, _at(F.lit(9))).alias("valid_to"))
    mapped = p.where(i % 50 == 3).select(i.alias("id_ligne_declaration"), (i - 3).alias("spe_masterid"), F.lit(MATCHED).alias("spe_match_status"), _at(F.lit(0)).alias("created_at"), F.lit(None).alias("valid_to"))
    expired = p.where(i % 50 == 13).select(i.alias("id_ligne_declaration"), (i - 3).alias("spe_masterid"), F.lit(MATCHED).alias("spe_match_status"), _at(F.lit(0)).alias("created_at"), _at(F.lit(1)).alias("valid_to"))
    decisions = p.where(i % 30 == 7).select(
        i.alias("decision_id"),
        i.alias("id_ligne_declaration"),
        F.when(i % 60 == 7, "APPROVED").when(i % 90 == 37, "REJECTED").otherwise("PENDING").alias("decision_status"),
        (i - 7).alias("chosen_spe_masterid"),
        _at(i % 3).alias("decided_at"),
    )
    again = decisions.where("id_ligne_declaration % 120 = 7").select(
        (F.col("decision_id") + 500_000_000).alias("decision_id"), "id_ligne_declaration", F.lit("REJECTED").alias("decision_status"), F.lit(None).alias("chosen_spe_masterid"), _at(F.lit(5)).alias("decided_at")
    )
    union = lambda a, b: a.unionByName(b)
    return State(spark).put(
        last_person=1_000_000_000,
        last_company=2_000_000_000,
        decl_spe=decl,
        decl_pe=firms,
        spe_enriched=union(known, more),
        pe_enriched=union(firm_known, firm_more),
        mapping=union(mapped, expired),
        spe_stewardship_decision=union(decisions, again),
    )
