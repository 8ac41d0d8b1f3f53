"""What a run works on: immutable tables by name, and two id counters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import TABLES, conform, empty

MATCHED, CREATED, REJECTED = "Matched", "Created", "Rejected"
ONE, SEVERAL = "Proba_One_Match_to_stewardship", "Proba_Several_Match_to_stewardship"


@dataclass(frozen=True)
class Params:
    run_id: str
    run_ts: datetime
    threshold: float = 0.8
    #: Bound of the rounds of label propagation, for runs that ask for it (``count_rounds``); otherwise stars settle in few.
    max_iter: int = 1000
    count_rounds: bool = False
    status_created: str = CREATED
    #: Score of a candidate that no edge of its own leads to, with one master in the component and with several.
    no_edge_one: float = 1.0
    no_edge_several: float = 0.8
    #: Components get their masters counted again after the pivots have theirs.
    refresh_components: bool = True
    #: A pivot keeps the stewardship status that reference candidates gave it.
    protect_reference_candidates: bool = False
    #: New companies of one run that share a pseudo_siret share an id.
    share_new_company_id: bool = False
    merge_statuses: tuple[str, ...] = (MATCHED,)
    use_watermark: bool = True
    hash_charset: str = "UTF-8"
    #: Pairs of a block are dealt in parts of so many rows of its left side.
    block_part: int = 20_000
    #: Rounds of label propagation between two cuts of the lineage.
    rounds_a_cut: int = 4

    @property
    def now(self) -> Column:
        return F.lit(self.run_ts).cast("timestamp_ntz")


@dataclass(frozen=True)
class State:
    spark: SparkSession
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    last_person: int = 0
    last_company: int = 0

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else empty(self.spark, name)

    def put(self, last_person: int | None = None, last_company: int | None = None, **tables: DataFrame) -> State:
        """A state with some tables replaced, in their declared shape."""
        if unknown := set(tables) - set(TABLES):
            raise KeyError(f"no such tables: {sorted(unknown)}")
        merged = {**self.tables, **{k: conform(t, k) for k, t in tables.items()}}
        return replace(
            self,
            tables=MappingProxyType(merged),
            last_person=self.last_person if last_person is None else last_person,
            last_company=self.last_company if last_company is None else last_company,
        )

    def of_run(self, name: str, run_id: str) -> DataFrame:
        return self[name].where(F.col("run_id") == run_id)

    def replace_run(self, name: str, run_id: str, rows: DataFrame) -> DataFrame:
        """The table with this run's rows replaced, which makes a step repeatable."""
        return self[name].where(F.col("run_id") != run_id).unionByName(conform(rows.withColumn("run_id", F.lit(run_id)), name))

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        return self[name].unionByName(conform(rows, name))


def current(df: DataFrame) -> DataFrame:
    return df.where(F.col("valid_to").isNull())


def upsert_mapping(mapping: DataFrame, changes: DataFrame, columns: list[str], now: Column, insert: Column | None = None) -> DataFrame:
    """Sets ``columns`` of the rows of ``changes`` (by id_ligne_declaration, unique) and adds missing rows.

    Other columns, created_at and valid_to stay as they are. ``insert`` tells
    which missing rows are added; all, if not given.
    """
    key = "id_ligne_declaration"
    hit, missing = F.col("c.__hit").isNotNull(), F.col("m.__here").isNull()
    if insert is None:
        insert = F.lit(True)
    c = changes.select(key, *columns, insert.alias("__add"), F.lit(True).alias("__hit")).alias("c")
    m = mapping.withColumn("__here", F.lit(True)).alias("m")
    joined = m.join(c, F.col(f"m.{key}") == F.col(f"c.{key}"), "full_outer").where(~missing | F.col("c.__add"))
    fixed = {key: F.coalesce(f"m.{key}", f"c.{key}"), "created_at": F.when(missing, now).otherwise(F.col("m.created_at")), "updated_at": F.when(hit, now).otherwise(F.col("m.updated_at"))}
    pick = {x: F.when(hit, F.col(f"c.{x}")).otherwise(F.col(f"m.{x}")) for x in columns}
    return joined.select(*[(fixed.get(x) if x in fixed else pick.get(x, F.col(f"m.{x}"))).alias(x) for x in mapping.columns])
