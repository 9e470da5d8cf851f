"""Incremental refresh of the runs table, late events included.

The stored object is the *run state* (``operators.runs.run_state``): per
run key, only mergeable partials.  A refresh folds the new events into
partials, then

* ``touched`` = run keys present in the new events,
* state rows of untouched keys are carried over (``left_anti``),
* state rows of touched keys (``left_semi``) are merged with the new
  partials,

so old events are never re-read and late events for an old run simply
merge into it.  Keys are compared null-safely (``<=>``): events without an
update id form a run too.  The touched-key side is the distinct keys of
one batch; AQE broadcasts it when its measured size allows, otherwise both
joins are shuffle joins on the run key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from runlens import schema as S
from runlens.config import THRESHOLDS, Config
from runlens.operators.runs import finalize_runs, merge_run_state, run_state
from runlens.session import materialize as checkpoint


def _on(left: DataFrame, right: DataFrame) -> Column:
    cond = None
    for k in S.RUN_KEYS:
        e = left[k].eqNullSafe(right[f"_t_{k}"])
        cond = e if cond is None else cond & e
    return cond


def refresh_state(
    state: DataFrame, new_enriched: DataFrame, cfg: Config | None = None, materialize: bool = True
) -> DataFrame:
    """State after adding ``new_enriched`` events to ``state``.  The new
    partials feed the touched keys of both joins and the merge; with
    ``materialize`` they are checkpointed once (one row per touched run), so
    the new events are folded once."""
    cfg = cfg or THRESHOLDS
    fresh = run_state(new_enriched, cfg)
    if materialize:
        fresh = checkpoint(fresh)
    touched = fresh.select(*[fresh[k].alias(f"_t_{k}") for k in S.RUN_KEYS])
    keep = state.join(touched, _on(state, touched), "left_anti")
    old = state.join(touched, _on(state, touched), "left_semi")
    return keep.unionByName(merge_run_state(old, fresh))


def incremental_runs(
    state: DataFrame, new_enriched: DataFrame, cfg: Config | None = None, materialize: bool = True
) -> DataFrame:
    """Runs table (without arrays) after an incremental refresh; equals that
    of a full rebuild."""
    return finalize_runs(refresh_state(state, new_enriched, cfg, materialize), cfg)
