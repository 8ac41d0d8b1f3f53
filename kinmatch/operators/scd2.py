"""Steps 09 to 11: golden tables with history, one generic merge used three times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import MATCH
from ..schemas import conform
from ..state import MATCHED, Params, State


def row_hash(columns: list[str], charset: str = "UTF-8") -> Column:
    """SHA-256 of the columns joined by |, nulls left out, as bytes."""
    flag = lambda c: F.col(c).cast("int") if c == "rnvp_ok" else F.col(c)
    text = F.concat_ws("|", *[flag(c).cast("string") for c in columns])
    return F.unhex(F.sha2(F.encode(text, charset), 256))


def merge(golden: DataFrame, name: str, source: DataFrame, keys: list[str], now: Column, source_system: str | None = None) -> DataFrame:
    """Type 2 merge of ``source`` (one row a key, with row_hash) into a golden table.

    A current row of another hash is closed; a key without a current row, or
    with one of another hash, gets a new current row. Equal hashes change
    nothing and keys that don't come stay open. Null keys equal empty ones.
    """
    key = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    s = source.withColumn("__key", F.array(*key))
    # history doesn't change: only current rows meet the source
    history, g = golden.where(~F.coalesce("is_current", F.lit(False))), golden.where("is_current").withColumn("__key", F.array(*key))
    hashes = s.select("__key", F.col("row_hash").alias("__new"))
    stale = F.col("row_hash") != F.col("__new")
    kept = g.join(hashes, "__key", "left").withColumns({
        "valid_to": F.when(stale, now).otherwise(F.col("valid_to")),
        "updated_at": F.when(stale, now).otherwise(F.col("updated_at")),
        "is_current": ~F.coalesce(stale, F.lit(False)),
    })
    open_ = g.select("__key", F.col("row_hash").alias("__old"))
    new = s.join(open_, "__key", "left").where(F.col("__old").isNull() | (F.col("__old") != F.col("row_hash")))
    new = new.withColumns({"valid_from": now, "is_current": F.lit(True), "created_at": now, "updated_at": now, "valid_to": F.lit(None)})
    if source_system:
        new = new.withColumn("source_system", F.lit(source_system))
    return history.unionByName(conform(kept, name)).unionByName(conform(new, name))


def watermark(state: State, label: str) -> datetime | None:
    row = state["merge_log"].where(F.col("label") == label).first()
    return row.last_success_ts if row else None


def _mark(state: State, label: str, params: Params) -> DataFrame:
    row = state.spark.createDataFrame([(label,)], "label string").withColumn("last_success_ts", params.now)
    return state["merge_log"].where(F.col("label") != label).unionByName(row)


def _staged(state: State, table: str, label: str, params: Params) -> DataFrame:
    rows = state.of_run(table, params.run_id)
    since = watermark(state, label) if params.use_watermark else None
    return rows if since is None else rows.where(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))


def _latest(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row a key: of the latest created_at, then the highest id_ligne_declaration."""
    newest = F.max(F.struct("created_at", "id_ligne_declaration", *columns)).alias("newest")
    return rows.groupBy(key).agg(newest).select(key, *[F.col(f"newest.{c}") for c in columns])


def person_source(staged: DataFrame, mapping: DataFrame, params: Params) -> DataFrame:
    m = mapping.where(F.col("spe_match_status").isin(*params.merge_statuses) & F.col("spe_masterid").isNotNull())
    rows = staged.join(m.select("id_ligne_declaration", "spe_masterid"), "id_ligne_declaration")
    rows = _latest(rows, "spe_masterid", MATCH).withColumn("rnvp_ok", F.lit(None).cast("boolean"))
    rows = rows.withColumn("row_hash", row_hash([*MATCH, "rnvp_ok"], params.hash_charset))
    return rows.withColumnsRenamed({"spe_nom_normalized": "spe_nom", "spe_prenom_normalized": "spe_prenom"})


def company_source(staged: DataFrame, mapping: DataFrame, params: Params) -> DataFrame:
    m = mapping.where((F.col("pe_match_status") == MATCHED) & F.col("pe_masterid").isNotNull())
    rows = staged.drop("pe_masterid").join(m.select("id_ligne_declaration", "pe_masterid"), "id_ligne_declaration")
    rows = _latest(rows, "pe_masterid", ["pseudo_siret"])
    rows = rows.withColumn("rnvp_ok", F.lit(None).cast("boolean"))
    return rows.withColumn("row_hash", row_hash(["pseudo_siret", "rnvp_ok"], params.hash_charset))


def relation_source(staged: DataFrame, mapping: DataFrame, params: Params, employment_type: Column | None = None, started: Column | None = None) -> DataFrame:
    """Persons and companies declared in one line. Employment type and start date aren't declared so far: null, unless given."""
    m = mapping.where(F.col("spe_match_status").isin(*params.merge_statuses) & (F.col("pe_match_status") == MATCHED))
    rows = staged.join(m.select("id_ligne_declaration", "spe_masterid", F.col("pe_masterid")), "id_ligne_declaration")
    rows = rows.where("spe_masterid IS NOT NULL AND pe_masterid IS NOT NULL")
    kind = (employment_type if employment_type is not None else F.lit(None)).cast("string").alias("employment_type")
    start = (started if started is not None else F.lit(None)).cast("date").alias("start")
    rows = rows.select("spe_masterid", "pe_masterid", kind, start).groupBy("spe_masterid", "pe_masterid", "employment_type")
    rows = rows.agg(F.min("start").alias("date_debut_relation"), F.max("start").alias("date_fin_relation"))
    return rows.withColumn("row_hash", row_hash(["employment_type", "date_debut_relation", "date_fin_relation"], params.hash_charset))


def merge_persons(state: State, params: Params) -> State:
    source = person_source(_staged(state, "stg_new_decl_spe", "merge_spe", params), state["mapping"], params)
    golden = merge(state["master_spe"], "master_spe", source, ["spe_masterid"], params.now, "SILVER")
    return state.put(master_spe=golden, merge_log=_mark(state, "merge_spe", params))


def merge_companies(state: State, params: Params) -> State:
    source = company_source(_staged(state, "stg_new_decl_pe", "merge_pe", params), state["mapping"], params)
    golden = merge(state["master_pe"], "master_pe", source, ["pe_masterid"], params.now, "SILVER")
    return state.put(master_pe=golden, merge_log=_mark(state, "merge_pe", params))


def merge_relations(state: State, params: Params) -> State:
    source = relation_source(_staged(state, "stg_new_decl_spe", "merge_relation", params), state["mapping"], params)
    golden = merge(state["master_relation"], "master_relation", source, ["spe_masterid", "pe_masterid", "employment_type"], params.now)
    return state.put(master_relation=golden, merge_log=_mark(state, "merge_relation", params))
