"""Steps 03 and 04: persons against the known formats, exactly and by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import BLOCK, MATCH, same_key, scores, sure_prefix, total, total_bound
from ..runtime import checkpointed
from ..sources import canon
from ..state import MATCHED, ONE, SEVERAL, Params, State, current, upsert_mapping
from . import pairs

SCORES = ["score_total", "score_nom", "score_prenom", "score_dob", "score_commune"]


def exact_matches(staged: DataFrame, formats: DataFrame) -> DataFrame:
    """``staged`` with the spe_masterid of the latest current format of equal attributes, or null.

    A null attribute equals nothing. Formats are reduced to one a key before
    the join, so it adds no rows.
    """
    newest = F.max(F.struct("created_at", (-F.col("spe_masterid")).alias("lowest")))
    known = current(formats).dropna(subset=MATCH).groupBy(*MATCH).agg(newest.alias("newest"))
    known = known.select(*MATCH, (-F.col("newest.lowest")).alias("spe_masterid"))
    return staged.join(known, MATCH, "left")


def match_persons_exactly(state: State, params: Params) -> State:
    """Exact matches are Matched; a mapping without one loses its person; the rest goes on to scoring."""
    staged = state.of_run("stg_new_decl_spe", params.run_id).select("id_ligne_declaration", *MATCH)
    found = checkpointed(exact_matches(staged, canon.person_formats(state["spe_enriched"])))  # read for both tables
    has = F.col("spe_masterid").isNotNull()
    changes = found.select("id_ligne_declaration", "spe_masterid", F.when(has, F.lit(MATCHED)).alias("spe_match_status"))
    rest = canon.with_blocking(found.where(~has).select("id_ligne_declaration", *MATCH)).withColumn("created_at", params.now)
    return state.put(
        mapping=upsert_mapping(state["mapping"], changes, ["spe_masterid", "spe_match_status"], params.now, insert=has),
        stg_spe_nonmatched=state.replace_run("stg_spe_nonmatched", params.run_id, rest),
    )


def dealt(left: DataFrame, right: DataFrame, by: list[str], part: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``part``, partitioned by it and ``by``: a left row is in one part of at most about ``part`` rows, the right ones in all."""
    sizes = left.groupBy(*by).count().where(F.col("count") > part).select(*by, F.ceil(F.col("count") / part).cast("int").alias("parts"))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), parts).cast("int")
    left = left.join(sizes, by, "left").withColumn("part", spread).drop("parts")
    right = right.join(sizes, by, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    # comparing costs much more than its few bytes suggest: a fixed number of partitions keeps all cores busy
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.repartition(n, *by, "part"), right.repartition(n, *by, "part")


def surely(left: str, right: str) -> Column:
    """Whether a pair reaches the threshold by its equal attributes and the prefixes of its names (``sure``) alone."""
    found = F.col(f"{left}.sure") == F.col(f"{right}.sure")
    for c in MATCH[1:]:
        found = found & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return found


def scored_pairs(left: DataFrame, right: DataFrame, threshold: float, also: Column | None = None, part: int = 20_000) -> DataFrame:
    """Pairs of one block that reach the threshold, with their scores; columns of ``left`` and ``right`` as l and r.

    The threshold is part of the join, so pairs below it are never rows. What
    it asks to be equal (``same_key``) divides the blocks; bounds from the
    strings' lengths and prefixes spare most pairs the edit distance. A block
    of more than ``part`` rows on the left is dealt in parts, each of which
    meets the whole block of the right in a task of its own.
    """
    keys = same_key(threshold)
    left, right = (side.dropna(subset=BLOCK).withColumns({**keys, "sure": sure_prefix(threshold)}) for side in (left, right))
    block = [*BLOCK, *keys]
    left, right = dealt(left, right, block, part)
    l, r = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in [*block, "part"]]
    s = scores("l", "r")
    near = surely("l", "r") | ((total_bound("l", "r") >= threshold) & (total(s) >= threshold))
    for c in [*same[1:], *([also] if also is not None else []), near]:
        same[0] = same[0] & c
    return l.join(r, same[0]).withColumns(s).withColumn("score_total", total())


def reference_candidates(rest: DataFrame, formats: DataFrame, threshold: float, part: int = 20_000) -> DataFrame:
    """(id_ligne_declaration, candidate_spe_masterid, scores): of several formats of a master the best one."""
    left = rest.select("id_ligne_declaration", *MATCH, *BLOCK)
    right = current(formats).select("spe_masterid", *MATCH, *BLOCK)
    several = right.groupBy("spe_masterid").count().select("spe_masterid", (F.col("count") > 1).alias("several"))
    right = right.join(several, "spe_masterid")
    # a master of one format has one pair a declaration; only the others' pairs are grouped
    one, more = (
        scored_pairs(left, right.where(which).drop("several"), threshold, part=part).select("id_ligne_declaration", F.col("spe_masterid").alias("candidate_spe_masterid"), *SCORES)
        for which in (~F.col("several"), F.col("several"))
    )
    best = more.groupBy("id_ligne_declaration", "candidate_spe_masterid").agg(F.max(F.struct(*SCORES)).alias("s"))
    return one.unionByName(best.select("id_ligne_declaration", "candidate_spe_masterid", *[F.col(f"s.{c}") for c in SCORES]))


def best_candidate(candidates: DataFrame, key: str, name: str = "candidate_spe_masterid") -> DataFrame:
    """Per key: how many masters, the one of highest score (lowest id of equals) and its score; (key, master) is unique."""
    best = F.max(F.struct("score_total", (-F.col(name)).alias("lowest")))
    out = candidates.groupBy(key).agg(F.count(name).alias("candidate_cnt"), best.alias("best"))
    return out.select(key, "candidate_cnt", (-F.col("best.lowest")).alias("best_candidate_masterid"), F.col("best.score_total").alias("best_score"))


def best_reference(state: State, params: Params) -> DataFrame:
    """The ``best_candidate`` of each person that is left, without a row for each candidate."""
    rest = state.of_run("stg_spe_nonmatched", params.run_id)
    return pairs.best_formats(rest, current(canon.person_formats(state["spe_enriched"])), params.threshold, params.block_part)


def count_candidates(state: State, params: Params) -> int:
    """How many candidates the run has."""
    return best_reference(state, params).agg(F.sum("candidate_cnt")).first()[0] or 0


def match_persons_by_score(state: State, params: Params) -> State:
    """Scores what is left of this run against current formats; candidates go to stewardship."""
    rest = state.of_run("stg_spe_nonmatched", params.run_id)
    found = reference_candidates(rest, canon.person_formats(state["spe_enriched"]), params.threshold, params.block_part)
    candidates = state.replace_run("spe_match_candidates", params.run_id, found.withColumn("created_at", params.now))
    best = best_reference(state, params)
    status = F.when(F.col("candidate_cnt") == 1, F.lit(ONE)).otherwise(F.lit(SEVERAL))
    columns = ["spe_match_status", "best_candidate_masterid", "best_score"]
    return state.put(
        spe_match_candidates=candidates,
        mapping=upsert_mapping(state["mapping"], best.withColumn("spe_match_status", status), columns, params.now),
    )
