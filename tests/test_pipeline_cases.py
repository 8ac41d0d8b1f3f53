"""Cases beyond the smoke rows: each step on rows made for it, checked by hand-derived results."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kinmatch.functions import similarity as sim
from kinmatch.operators import companies, dedup, graph, persons, scd2, staging, stewardship
from kinmatch.plans import runner
from kinmatch.runtime import numbered
from kinmatch.sources import canon
from kinmatch.sources.store import LockTimeout, Store
from kinmatch.state import ONE, SEVERAL, Params, State, upsert_mapping

from .test_smoke_run import NOW, declared, mapping, params

D = date(1990, 1, 1)
P = params()
_FORMAT = "spe_masterid long, spe_nom_normalized string, spe_prenom_normalized string, spe_dateNaissance date, spe_communeNaissance string, created_at timestamp_ntz, valid_to timestamp_ntz"


def with_formats(state, rows):
    return state.put(spe_enriched=state.spark.createDataFrame([(*r, *[NOW, None][len(r) - 5 :]) for r in rows], _FORMAT))


def upto(state, *steps, p=P):
    for s in steps:
        state = s(state, p)
    return state


PERSON_STEPS = (staging.stage_new_declarations, persons.match_persons_exactly, persons.match_persons_by_score)


def test_similarity(spark):
    rows = [(None, None, 1.0), (None, "a", 0.0), ("a", None, 0.0), ("", "", 1.0), ("ab", "ab  ", 1.0), ("kitten", "sitting", 1 - 3 / 7), ("é", "e", 0.0), ("", "abc", 0.0), (" ", None, 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    for r in df.select("want", sim.similarity(F.col("a"), F.col("b")).alias("s"), sim.similarity(F.col("b"), F.col("a")).alias("t"), sim.similarity_bound(F.col("a"), F.col("b")).alias("u")).collect():
        assert r.s == r.t == pytest.approx(r.want) and 0 <= r.s <= r.u <= 1


def test_canon_cuts_blanks_and_folds_case(spark):
    s = declared(spark, [(1, "Dupont  ", "Al ", D, "Paris ")])
    row = canon.person_declarations(s["decl_spe"]).first()
    assert (row.spe_nom_normalized, row.spe_nom, row.spe_communeNaissance) == ("Dupont", "Dupont  ", "Paris")
    assert canon.person_declarations(s["decl_spe"], fold_case=True).first().spe_nom_normalized == "DUPONT"


def test_numbering_is_gap_free_and_ordered(spark):
    df = spark.createDataFrame([(f"k{(i * 37) % 500:03d}",) for i in range(500)] + [(None,)], "k string")
    out, last = numbered(df, ["k"], "n", 100)
    got = {r.k: r.n for r in out.collect()}
    assert last == 601 and got == {k: 101 + i for i, k in enumerate([None, *sorted(f"k{i:03d}" for i in range(500))])}
    assert numbered(df.where("k = 'none'"), ["k"], "n", 7)[1] == 7


def test_exact_reference_match_and_latest_format(spark):
    s = with_formats(declared(spark, [(1, "A", "B", D, "X"), (2, "A", "B", D, None)]), [(7, "A", "B", D, "X", NOW - timedelta(1)), (9, "A", "B", D, "X"), (8, "A", "B", D, "X"), (3, "A", "B", D, None), (4, "A", "B", D, "X", NOW + timedelta(1), NOW)])
    s = upto(s, *PERSON_STEPS[:2])
    assert mapping(s)[1].spe_masterid == 8 and mapping(s)[1].spe_match_status == "Matched"  # newest, lowest id of equals; the expired one doesn't count
    assert [r.id_ligne_declaration for r in s["stg_spe_nonmatched"].collect()] == [2]  # null equals nothing
    s = persons.match_persons_by_score(s, P)
    assert {(r.candidate_spe_masterid, r.score_total) for r in s["spe_match_candidates"].collect() if r.candidate_spe_masterid == 3} == {(3, 1.0)}


def test_reference_candidates(spark):
    people = [(1, "DUPONT", "ALICE", D, "PARIS"), (2, "MARTIN", "BOB", D, "LYON"), (3, None, "BOB", D, "LYON"), (4, "MARTIN", "BOB", None, "LYON")]
    s = with_formats(declared(spark, people), [(10, "DUPONX", "ALICE", D, "PARIS"), (10, "DUPOXX", "ALICE", D, "PARIS"), (20, "MARTYN", "BOB", D, "LYON"), (21, "MARTYN", "BOB", D, "LYON")])
    s = upto(s, *PERSON_STEPS)
    found = {(r.id_ligne_declaration, r.candidate_spe_masterid): r.score_total for r in s["spe_match_candidates"].collect()}
    assert set(found) == {(1, 10), (2, 20), (2, 21)} and found[1, 10] == pytest.approx((5 / 6 + 3) / 4)  # the better format
    m = mapping(s)
    assert (m[1].spe_match_status, m[1].best_candidate_masterid) == (ONE, 10) and (m[2].spe_match_status, m[2].best_candidate_masterid) == (SEVERAL, 20)
    assert 3 not in m and 4 not in m
    # pivots overwrite the status, unless protected
    s = runner.run_steps(s, P, steps=runner.STEPS[4:7])
    assert mapping(dedup.dedup_by_component(s, P))[1].spe_match_status == "Matched"
    kept = mapping(dedup.dedup_by_component(s, params(protect_reference_candidates=True)))
    assert kept[1].spe_match_status == ONE and kept[1].spe_masterid is not None
    assert len({r.spe_masterid for r in kept.values()}) == 4  # a null block is its own pivot


def test_blocks_dealt_in_parts_give_the_same_pairs(spark):
    people = [(i, f"NAME{i % 7}", "ANN", D, "X") for i in range(60)]
    s = upto(declared(spark, people), *PERSON_STEPS[:2])
    one = graph.build_graph(s, P)["spe_edges"].select("node_a", "node_b", "score_total")
    many = graph.build_graph(s, params(block_part=7))["spe_edges"].select("node_a", "node_b", "score_total")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count() > 900


def labels(spark, nodes, edges, max_iter):
    n = spark.createDataFrame([(i,) for i in nodes], "node_id long")
    e = spark.createDataFrame(edges, "node_a long, node_b long")
    out, rounds = graph.propagate_labels(n, e, max_iter)
    return {r.node_id: r.component_id for r in out.collect()}, rounds


def test_path_graph_takes_as_many_rounds_as_nodes(spark):
    path = [(i, i + 1) for i in range(1, 6)]
    assert labels(spark, range(1, 7), path, 6) == ({i: 1 for i in range(1, 7)}, 6)
    with pytest.raises(RuntimeError):
        labels(spark, range(1, 7), path, 5)
    assert labels(spark, [4, 9], [], 1) == ({4: 4, 9: 9}, 1)


def test_stars_settle_long_chains_in_few_rounds(spark):
    r = random.Random(2)
    n = 100_000
    chain = spark.range(1, n).select(F.col("id").alias("node_a"), (F.col("id") + 1).alias("node_b"))
    found, rounds = graph.least_labels(spark.range(1, n + 2).select(F.col("id").alias("node_id")), chain)
    assert rounds < 40
    assert sorted(map(tuple, found.groupBy("component_id").count().collect())) == [(1, n), (n + 1, 1)]
    for _ in range(3):
        edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)]
        got, _ = labels(spark, range(60), edges, 1000)
        stars, _ = graph.least_labels(spark.createDataFrame([(i,) for i in range(60)], "node_id long"), spark.createDataFrame(edges, "node_a long, node_b long"))
        assert {x.node_id: x.component_id for x in stars.collect()} == got
    none, _ = graph.least_labels(spark.createDataFrame([(4,), (9,)], "node_id long"), spark.createDataFrame([], "node_a long, node_b long"))
    assert sorted(map(tuple, none.collect())) == [(4, 4), (9, 9)]


def candidates(spark, masters, edges):
    m = spark.createDataFrame([(n, 1, x) for n, x in masters], "node_id long, component_id long, spe_masterid long")
    e = spark.createDataFrame(edges, "node_a long, node_b long, score_total double")
    return {(r.node_id, r.candidate_spe_masterid): r.score_total for r in dedup.intrarun_candidates(m, dedup.component_stats(m), e).collect()}


def test_candidates_without_a_direct_edge(spark):
    assert candidates(spark, [(1, 5), (2, None), (3, None)], [(1, 2, 0.9), (2, 3, 0.95)]) == {(2, 5): 0.9, (3, 5): 1.0}
    assert candidates(spark, [(1, 5), (2, None), (3, 6)], [(1, 2, 0.9), (1, 3, 0.85)]) == {(2, 5): 0.9, (2, 6): 0.8}
    # of a master's nodes one has no edge: it counts as 0.8
    assert candidates(spark, [(1, 5), (4, 5), (2, None), (3, 6)], [(1, 2, 0.75), (2, 3, 0.79), (3, 4, 0.9)]) == {(2, 5): 0.8, (2, 6): 0.79}


def golden(spark, rows):
    return State(spark).put(master_pe=spark.createDataFrame(rows, "pe_masterid long, pseudo_siret string").withColumn("row_hash", scd2.row_hash(["pseudo_siret"])).withColumn("is_current", F.lit(True)).withColumn("valid_from", F.lit(NOW - timedelta(9))))["master_pe"]


def source(spark, rows):
    return spark.createDataFrame(rows, "pe_masterid long, pseudo_siret string").withColumn("row_hash", scd2.row_hash(["pseudo_siret"]))


def test_type_2_merge(spark):
    g = scd2.merge(golden(spark, [(1, "a"), (2, "b"), (3, "c")]), "master_pe", source(spark, [(1, "a"), (2, "B"), (4, "d")]), ["pe_masterid"], P.now, "SILVER")
    got = {(r.pe_masterid, r.pseudo_siret): (r.is_current, r.valid_to) for r in g.collect()}
    assert got == {(1, "a"): (True, None), (2, "b"): (False, NOW), (2, "B"): (True, None), (3, "c"): (True, None), (4, "d"): (True, None)}
    again = scd2.merge(g, "master_pe", source(spark, [(1, "a"), (2, "B"), (4, "d")]), ["pe_masterid"], params(at=NOW + timedelta(1)).now)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, g.collect()))


def test_hash_leaves_nulls_out_and_has_a_charset(spark):
    df = spark.createDataFrame([("A", None), (None, "A")], "x string, y string")
    assert len({bytes(r.h) for r in df.select(scd2.row_hash(["x", "y"]).alias("h")).collect()}) == 1
    h = spark.createDataFrame([("SIRET001",)], "x string").select(F.lower(F.hex(scd2.row_hash(["x"], "UTF-16LE"))).alias("h")).first().h
    assert h == "c054ea9128868c1417b3dd72915bab0ae27392fc6b12ea2e3eae9fca48b73086"


def test_watermark_and_expired_mapping(spark):
    s = declared(spark, [(1, "A", "B", D, "X")], at=NOW - timedelta(3))
    s = s.put(mapping=spark.createDataFrame([(1, 5, "Matched", NOW, NOW)], "id_ligne_declaration long, spe_masterid long, spe_match_status string, created_at timestamp_ntz, valid_to timestamp_ntz"))
    s = s.put(merge_log=spark.createDataFrame([("merge_pe", NOW - timedelta(1))], "label string, last_success_ts timestamp_ntz"))
    s = upto(s, staging.stage_new_declarations, companies.match_companies, persons.match_persons_exactly)
    m = mapping(s)[1]
    # restaged in spite of the expired mapping, which loses its master and stays expired
    assert (m.spe_masterid, m.spe_match_status, m.pe_masterid, m.valid_to) == (None, None, 1, NOW)
    assert scd2.merge_companies(s, P)["master_pe"].isEmpty()  # declared before the last merge
    assert scd2.merge_companies(s, params(use_watermark=False))["master_pe"].count() == 1


def test_companies(spark):
    firms = [(1, None, NOW, None), (2, None, NOW, None), (3, "S", NOW, None), (4, "S", NOW, None), (5, "T", NOW, None), (6, "U", NOW, None)]
    s = declared(spark, [], firms).put(pe_enriched=spark.createDataFrame([(50, "T", NOW, None), (51, "T", NOW, None), (60, "U", NOW, NOW)], "pe_masterid long, pseudo_siret string, created_at timestamp_ntz, valid_to timestamp_ntz"))
    s = staging.stage_new_declarations(s, P)
    ids = lambda s: {i: r.pe_masterid for i, r in mapping(s).items()}
    assert ids(companies.match_companies(s, P)) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 50, 6: 5}
    shared = ids(companies.match_companies(s, params(share_new_company_id=True)))
    assert shared[3] == shared[4] and len(set(shared.values())) == 5
    assert companies.match_companies(s, P)["pe_enriched"].count() == 8


def test_upsert_touches_named_columns_only(spark):
    base = State(spark).put(mapping=spark.createDataFrame([(1, 5, 9, NOW)], "id_ligne_declaration long, spe_masterid long, pe_masterid long, created_at timestamp_ntz"))["mapping"]
    changes = spark.createDataFrame([(1, 6), (2, 7), (3, None)], "id_ligne_declaration long, spe_masterid long")
    later = params(at=NOW + timedelta(1)).now
    got = {r.id_ligne_declaration: r for r in upsert_mapping(base, changes, ["spe_masterid"], later, insert=F.col("spe_masterid").isNotNull()).collect()}
    assert set(got) == {1, 2} and (got[1].spe_masterid, got[1].pe_masterid, got[1].created_at, got[1].updated_at) == (6, 9, NOW, NOW + timedelta(1))
    assert got[2].created_at == NOW + timedelta(1)


def decisions(spark, rows):
    return spark.createDataFrame(rows, "decision_id long, id_ligne_declaration long, decision_status string, chosen_spe_masterid long, decided_at timestamp_ntz, run_id string")


def test_stewardship(spark):
    nodes = spark.createDataFrame([("r1", 1, 1, "A", "B", D, None, NOW)], "run_id string, node_id long, id_ligne_declaration long, spe_nom_normalized string, spe_prenom_normalized string, spe_dateNaissance date, spe_communeNaissance string, created_at timestamp_ntz")
    rows = [(1, 1, "REJECTED", None, NOW, "r1"), (2, 1, "APPROVED", 5, NOW + timedelta(1), "r1"), (3, 2, "REJECTED", None, NOW, None), (4, 3, "PENDING", 1, NOW, None)]
    s = State(spark).put(spe_nodes=nodes, spe_stewardship_decision=decisions(spark, rows), mapping=spark.createDataFrame([(2, 8, "Matched")], "id_ligne_declaration long, spe_masterid long, spe_match_status string"))
    s = stewardship.apply_decisions(s, P)
    assert {i: (r.spe_masterid, r.spe_match_status) for i, r in mapping(s).items()} == {1: (5, "Matched"), 2: (8, "Rejected")}
    assert s["spe_enriched"].count() == 1
    assert stewardship.apply_decisions(s, P)["spe_enriched"].count() == 1  # a null attribute doesn't make it new
    assert set(mapping(stewardship.apply_decisions(s.put(mapping=s["mapping"].where("false")), P, "r1"))) == {1}
    with pytest.raises(ValueError):
        stewardship.apply_decisions(s.put(spe_stewardship_decision=decisions(spark, [(1, 1, "APPROVED", None, NOW, None)])), P)


def test_store_run_lock_and_failure(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    short = [runner.STEPS[0], runner.STEPS[1], runner.STEPS[9]]
    monkeypatch.setattr(runner, "STEPS", short)
    monkeypatch.setattr(runner.run_steps, "__defaults__", (None, short))
    first = declared(spark, [(1, "A", "B", D, "X")])
    run_id = runner.run(store, params=P, arriving=dict(first.tables))
    assert run_id == "r1" and store.load().last_company == 1 and store.load()["master_pe"].count() == 1
    assert [r.status for r in store.log("process_run").collect()] == ["Success"] and store.log("process_metrics").count() == 6

    before = store.version()
    with store.lock():
        with pytest.raises(LockTimeout):
            runner.run(store, params=params("r2"), lock_timeout_s=0.3)
    assert store.version() == before

    def fails(state, params):
        raise ZeroDivisionError("no")

    monkeypatch.setattr(runner.run_steps, "__defaults__", (None, [*short, ("12_fails", fails, [])]))
    with pytest.raises(ZeroDivisionError):
        runner.run(store, params=params("r3"))
    assert store.version() == before
    assert {r.run_id: (r.status, r.error_message) for r in store.log("process_run").collect()}["r3"] == ("Failed", "no")
    assert [r.step_name for r in store.log("process_error").collect()] == ["12_fails"]
    with store.lock(0.5):  # it was let go
        pass
    runner.apply_stewardship(store, params=Params(run_id="s1", run_ts=NOW))
    assert store.version() != before
