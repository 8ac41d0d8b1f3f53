"""The seven smoke rows and a first run over an empty reference."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kinmatch.plans.runner import run_steps
from kinmatch.schemas import KEYS
from kinmatch.state import ONE, SEVERAL, Params, State

NOW = datetime(2024, 5, 1, 12)
PEOPLE = [
    (101, "DUPONT", "ALICE", date(1990, 1, 1), "PARIS"),
    (102, "DUPONT", "ALICE", date(1990, 1, 1), "PARIS"),
    (103, "DUPONX", "ALAIN", date(1990, 1, 1), "PARIS"),
    (104, "DUPONX", "ALAIN", date(1990, 1, 1), "PARIS"),
    (105, "DUPONO", "ALBERT", date(1990, 1, 1), "PARIS"),
    (201, "MARTIN", "BOB", date(1991, 5, 5), "LYON"),
    (202, "MARTYN", "BOB", date(1991, 5, 5), "LYON"),
]


def declared(spark, people=PEOPLE, companies=None, at=NOW):
    persons = [(i, n, n, p, p, d, c, at, None) for i, n, p, d, c in people]
    firms = companies if companies is not None else [(i, f"SIRET{k:03d}", at, None) for k, (i, *_) in enumerate(people, 1)]
    return State(spark).put(
        decl_spe=spark.createDataFrame(persons, "id_ligne_declaration long, spe_nom string, spe_nom_normalized string, spe_prenom string, spe_prenom_normalized string, spe_dateNaissance date, spe_communeNaissance string, created_at timestamp_ntz, valid_to timestamp_ntz"),
        decl_pe=spark.createDataFrame(firms, "id_ligne_declaration long, pseudo_siret string, created_at timestamp_ntz, valid_to timestamp_ntz"),
    )


def params(run="r1", at=NOW, **kw):
    return Params(run_id=run, run_ts=at, **kw)


def mapping(state):
    return {r.id_ligne_declaration: r for r in state["mapping"].collect()}


def keys_hold(state):
    for t, key in KEYS.items():
        if t in state.tables:
            assert state[t].groupBy(*key).count().where("count > 1").isEmpty(), t
    for t, key in (("master_spe", ["spe_masterid"]), ("master_pe", ["pe_masterid"])):
        assert state[t].where("is_current").groupBy(*key).count().where("count > 1").isEmpty()


@pytest.fixture(scope="module")
def first(spark):
    return run_steps(declared(spark), params())


def test_first_run(first):
    assert first.of_run("spe_nodes", "r1").count() == 7 and first["spe_match_candidates"].isEmpty()
    edges = {(r.node_a, r.node_b): r for r in first["spe_edges"].collect()}
    assert len(edges) == 7 and all(a < b and r.score_total >= 0.8 for (a, b), r in edges.items())
    assert edges[101, 103].score_total == pytest.approx((5 / 6 + 0.4 + 2) / 4) and edges[201, 202].score_total == pytest.approx(0.9583333)
    assert {r.node_id: r.component_id for r in first["spe_components"].collect()} == {101: 101, 102: 101, 103: 101, 104: 101, 105: 105, 201: 201, 202: 201}
    m = mapping(first)
    assert {i: (r.spe_masterid, r.spe_match_status) for i, r in m.items()} == {
        101: (1, "Created"), 102: (1, "Created"), 103: (2, "Created"), 104: (2, "Created"), 105: (3, "Matched"), 201: (4, "Matched"), 202: (None, ONE),
    }
    assert {i: r.pe_masterid for i, r in m.items()} == {101: 1, 102: 2, 103: 3, 104: 4, 105: 5, 201: 6, 202: 7}
    assert all(r.pe_match_status == "Matched" for r in m.values())
    assert m[202].best_candidate_masterid == 4 and m[202].best_score == pytest.approx(0.9583333)
    assert [(r.node_id, r.candidate_spe_masterid) for r in first["spe_match_candidates_intrarun"].collect()] == [(202, 4)]
    assert first["spe_enriched"].count() == 4 and first["pe_enriched"].count() == 7
    assert sorted(r.spe_masterid for r in first["master_spe"].collect()) == [3, 4]
    assert first["master_pe"].count() == 7
    assert sorted((r.spe_masterid, r.pe_masterid) for r in first["master_relation"].collect()) == [(3, 5), (4, 6)]
    assert (first.last_person, first.last_company) == (4, 7)
    assert first["merge_log"].count() == 3
    keys_hold(first)


def test_hashes(first):
    hashes = {r.h for t in ("master_spe", "master_pe", "master_relation") for r in first[t].select(F.lower(F.hex("row_hash")).alias("h")).collect()}
    assert {
        "6f6b6a6f42ae0254e695cb41ff7f90b6bd3237ed7a9d3709c49ee35e6bcbf210",
        "1c8007f616bddb7325754d4b96ff87ca0b11d89bece604a0970b10b7b6b50811",
        "3cccbd90ba13f34e2ac265115afdfebb9043f146126c3008d2e25f2970859b68",
        "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
    } <= hashes


def test_second_run_changes_nothing(first):
    again = run_steps(first, params("r2", datetime(2024, 5, 2)))
    assert again.of_run("stg_new_decl_spe", "r2").isEmpty()
    for t in ("mapping", "spe_enriched", "pe_enriched", "master_spe", "master_pe", "master_relation", "spe_match_candidates"):
        assert sorted(map(repr, again[t].collect())) == sorted(map(repr, first[t].collect())), t
    assert (again.last_person, again.last_company) == (4, 7)


def test_lower_threshold_joins_the_component(spark):
    s = run_steps(declared(spark), params(threshold=0.79))
    assert s["spe_edges"].count() == 11
    assert {r.component_id for r in s["spe_components"].collect()} == {101, 201}
    found = sorted((r.node_id, r.candidate_spe_masterid, round(r.score_total, 6)) for r in s["spe_match_candidates_intrarun"].collect())
    assert found == [(105, 1, 0.791667), (105, 2, 0.791667), (202, 3, 0.958333)]
    m = mapping(s)
    assert (m[105].spe_masterid, m[105].spe_match_status, m[105].best_candidate_masterid) == (None, SEVERAL, 1)
    assert (m[202].spe_match_status, m[202].best_candidate_masterid) == (ONE, 3)
    assert (s["master_spe"].count(), s["master_relation"].count(), s["master_pe"].count()) == (1, 1, 7)


def test_without_refreshed_components(spark):
    s = run_steps(declared(spark), params(refresh_components=False))
    assert mapping(s)[202].spe_match_status is None and s["spe_match_candidates_intrarun"].isEmpty()
