"""Step 01: current declarations without a current mapping."""

from __future__ import annotations

from ..sources import canon
from ..state import Params, State, current


def stage_new_declarations(state: State, params: Params) -> State:
    """Stages new person and company declarations of this run; a mapping that has expired doesn't count."""
    mapped = current(canon.mappings(state["mapping"])).select("id_ligne_declaration")
    persons = current(canon.person_declarations(state["decl_spe"])).join(mapped, "id_ligne_declaration", "left_anti")
    companies = current(canon.company_declarations(state["decl_pe"])).join(mapped, "id_ligne_declaration", "left_anti")
    return state.put(
        stg_new_decl_spe=state.replace_run("stg_new_decl_spe", params.run_id, canon.with_blocking(persons)),
        stg_new_decl_pe=state.replace_run("stg_new_decl_pe", params.run_id, companies),
    )
