"""One run: lock, steps in order, publish; and its log."""

from __future__ import annotations

import contextlib
import socket
import time
import traceback
import uuid
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime


from ..operators import companies, dedup, graph, persons, scd2, staging, stewardship
from ..runtime import checkpointed
from ..sources.store import Store
from ..state import Params, State



def utc_now() -> datetime:
    now = datetime.now(UTC).replace(tzinfo=None)
    return now.replace(microsecond=now.microsecond // 1000 * 1000)


@dataclass
class RunLog:
    """Rows of process_run, process_metrics and process_error."""

    run_id: str
    process_name: str
    start_ts: datetime = field(default_factory=utc_now)
    status: str = "Running"
    end_ts: datetime | None = None
    error: str | None = None
    metrics: list[tuple] = field(default_factory=list)
    errors: list[tuple] = field(default_factory=list)

    def metric(self, step: str, rows: int | None, ms: int, comment: str | None = None) -> None:
        """Never fails a run."""
        with contextlib.suppress(Exception):
            self.metrics.append((self.run_id, step, utc_now(), rows, int(ms), comment))

    def failed(self, step: str, e: BaseException) -> None:
        last = traceback.extract_tb(e.__traceback__)
        where = last[-1] if last else None
        self.errors.append((self.run_id, step, 0, str(e)[:4000], where.lineno if where else None, where.name if where else None, utc_now()))
        self.status, self.error, self.end_ts = "Failed", str(e)[:4000], utc_now()

    def succeeded(self) -> None:
        self.status, self.end_ts = "Success", utc_now()

    def row(self, user: str) -> tuple:
        return (self.run_id, self.process_name, self.start_ts, self.end_ts, self.status, self.error, socket.gethostname(), user)


def _components(state: State, params: Params) -> State:
    return graph.compute_components(state, params)[0]


#: Name, step, and the tables whose rows a step's metrics count.
STEPS = [
    ("01_stage_new_declarations", staging.stage_new_declarations, ["stg_new_decl_spe", "stg_new_decl_pe"]),
    ("02_match_pe", companies.match_companies, ["mapping", "pe_enriched"]),
    ("03_match_spe_deterministic", persons.match_persons_exactly, ["mapping", "stg_spe_nonmatched"]),
    ("04_match_spe_probabilistic_candidates", persons.match_persons_by_score, ["mapping", "spe_match_candidates"]),
    ("05_build_intrarun_graph", graph.build_graph, ["spe_nodes", "spe_edges"]),
    ("06_compute_connected_components", _components, ["spe_components"]),
    ("07_new_spe_dedup_deterministic", dedup.dedup_exactly, ["spe_nodes", "mapping", "spe_enriched"]),
    ("08_new_spe_dedup_probabilistic", dedup.dedup_by_component, ["spe_nodes", "spe_match_candidates_intrarun", "mapping", "spe_enriched"]),
    ("09_merge_spe", scd2.merge_persons, ["master_spe", "merge_log"]),
    ("10_merge_pe", scd2.merge_companies, ["master_pe", "merge_log"]),
    ("11_merge_relation", scd2.merge_relations, ["master_relation", "merge_log"]),
]


#: Pairs: tables that no later step reads (but rounds that are counted read the edges).
PAIRS = frozenset({"spe_match_candidates", "spe_edges", "spe_match_candidates_intrarun"})


#: Numbers of pairs, as a step leaves them, where they aren't written.
COUNTS = {"spe_match_candidates": persons.count_candidates, "spe_edges": graph.count_edges}


def run_steps(state: State, params: Params, journal: RunLog | None = None, steps=STEPS, *, unwritten: frozenset[str] = frozenset()) -> State:
    """All steps. What a step changes is written once, so later steps neither repeat it nor carry its plan; ``unwritten`` tables are only counted."""
    journal = journal or RunLog(params.run_id, "run")
    for name, step, touched in steps:
        began = time.monotonic()
        try:
            state = step(state, params)
            done = {t: state[t] if t in unwritten else checkpointed(state[t]) for t in touched}
            state = state.put(**done)
            for t in touched:
                if t in unwritten and t in COUNTS:
                    count = COUNTS[t](state, params)
                else:
                    count = (done[t].where(f"run_id = '{params.run_id}'") if "run_id" in done[t].columns else done[t]).count()
                journal.metric(f"{name}:{t}", count, (time.monotonic() - began) * 1000)
        except BaseException as e:
            journal.failed(name, e)
            raise
    return state


def _keep(store: Store, journal: RunLog) -> None:
    store.append_log("process_run", [journal.row(store.spark.sparkContext.sparkUser())])
    store.append_log("process_metrics", journal.metrics)
    store.append_log("process_error", journal.errors)


def run(store: Store, process_name: str = "MM_RUN", params: Params | None = None, lock_timeout_s: float = 60.0, arriving: dict | None = None, **options) -> str:
    """A whole run over the store's snapshot, with ``arriving`` tables put first; returns the run id.

    Only a run that succeeds publishes; a failed one leaves the snapshot as it
    was, logs what went wrong and raises.
    """
    params = params or Params(run_id=str(uuid.uuid4()), run_ts=utc_now())
    if options:
        params = replace(params, **options)
    with store.lock(lock_timeout_s):
        journal = RunLog(params.run_id, process_name)
        try:
            state = store.load()
            if arriving:
                state = state.put(**arriving)
            state = run_steps(state, params, journal)
            store.publish(state)
            journal.succeeded()
        except BaseException as e:
            if journal.status != "Failed":
                journal.failed(process_name, e)
            raise
        finally:
            _keep(store, journal)
    return params.run_id


def apply_stewardship(store: Store, run_id: str | None = None, params: Params | None = None, lock_timeout_s: float = 60.0) -> str:
    """Applies decisions (of one run, or all) to the store's snapshot; logs under a run id of its own."""
    params = params or Params(run_id=str(uuid.uuid4()), run_ts=utc_now())
    with store.lock(lock_timeout_s):
        journal = RunLog(params.run_id, "apply_stewardship_decisions")
        began = time.monotonic()
        try:
            state = store.load()
            n = stewardship.valid_decisions(state["spe_stewardship_decision"], run_id).count()
            store.publish(stewardship.apply_decisions(state, params, run_id))
            journal.metric("apply_stewardship_decisions", n, (time.monotonic() - began) * 1000)
            journal.succeeded()
        except BaseException as e:
            journal.failed("apply_stewardship_decisions", e)
            raise
        finally:
            _keep(store, journal)
    return params.run_id


