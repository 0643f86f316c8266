"""The run: discovered items become extracted, duplicates are marked, the rest is classified. Each stage is a function of tables; its result is written."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import classify, dedupe, discover, extract, revisions, stats
from .cuts import cut


@dataclass(frozen=True)
class State:
    """The tables that a run changes."""

    items: DataFrame
    revisions: DataFrame


def discover_stage(state: State, candidates: DataFrame, now: datetime, run_id: int, refresh: bool = False) -> State:
    """New candidates become items; with ``refresh`` known ones are discovered again."""
    items = state.items
    fresh = discover.new_candidates(candidates, items)
    if refresh:
        items = discover.touch(items, discover.known_candidates(candidates, items), now)
    return replace(state, items=cut(discover.insert_new(items, fresh, now, run_id), "items"))


def extract_stage(state: State, fetched: DataFrame, now: datetime, limit: int | None = None) -> State:
    return replace(state, items=cut(extract.extract(state.items, fetched, now, limit), "items"))


def dedupe_stage(state: State, now: datetime) -> State:
    """Exact duplicates get no revision; the others do, before near ones are found among them."""
    items = state.items
    exact = cut(dedupe.exact_duplicates(items), "exact")
    fresh = cut(items.filter("status = 'extracted'").join(exact.select("id"), "id", "left_anti"), "fresh")
    flags = cut(revisions.updated(fresh, state.revisions), "updated")
    seen = fresh.select(F.lit(None).cast("long").alias("id"), F.col("id").alias("item_id"), "content_hash", F.lit(now).alias("seen_at"), "word_count")
    kept = cut(revisions.insert_or_ignore(state.revisions, seen), "revisions")
    recent = items.filter("status = 'classified'").orderBy(F.col("id").desc()).limit(dedupe.RECENT).select("id", F.col("body_text").alias("text"))
    near = cut(dedupe.near_duplicates(fresh.select("id", F.col("body_text").alias("text")), recent), "near")
    items = revisions.set_updated(items, flags, now)
    items = dedupe.mark(dedupe.mark(items, exact, dedupe.EXACT), near, dedupe.NEAR)
    return State(cut(items, "items"), kept)


def classify_stage(state: State, keywords: dict[str, list[str]] = classify.KEYWORDS, again: bool = False, ask=None) -> State:  # noqa: ANN001
    """Keyword labels, or those of ``ask``."""
    items = classify.pre_tag(state.items)
    work = classify.work_set(items, again)
    replies = classify.model_replies(work, ask, keywords) if ask else classify.offline(work, keywords)
    return replace(state, items=cut(classify.apply(items, replies), "items"))


def run(
    state: State,
    candidates: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    now: datetime,
    run_id: int,
    *,
    refresh: bool = False,
    limit: int | None = None,
    keywords: dict[str, list[str]] = classify.KEYWORDS,
    again: bool = False,
    offline: bool = True,
    ask=None,  # noqa: ANN001
    targets: DataFrame | None = None,
) -> tuple[State, DataFrame, DataFrame]:
    """A whole run: the new state, its row of ``runs`` and its rows of ``source_runs``.

    ``fetch`` turns discovered items into pages. A stage that fails ends the run; the state is then the last one written, and the row says why.
    A run is fine if no stage and no target failed; of ``targets(source_id, target)`` one that found nothing failed.
    """
    classify.may_classify(again, ask is not None, offline)
    spark = candidates.sparkSession
    log, note = None, None
    try:
        fresh = discover.new_candidates(candidates, state.items)
        log = cut(discover.target_log(candidates, fresh, run_id, targets), "targets")
        state = discover_stage(state, candidates, now, run_id, refresh)
        state = extract_stage(state, fetch(state.items.filter("status = 'discovered'")), now, limit)
        state = dedupe_stage(state, now)
        state = classify_stage(state, keywords, again, ask)
    except Exception as e:  # noqa: BLE001  kept with the run
        note = str(e)[-1500:]
    failed = log.filter("NOT ok").count() if log is not None else 0
    counts = stats.stages(state.items, run_id)
    row = counts.select(
        F.lit(run_id).cast("long").alias("id"), F.lit(now).alias("started_at"), F.lit(now).alias("finished_at"), "discovered", "extracted", "duplicates", "classified", "by_publisher",
        F.lit(note is None and not failed).alias("ok"), F.lit(note).cast("string").alias("notes"),
    )
    return state, cut(row, "run"), log if log is not None else spark.createDataFrame([], "run_id long, source_id string, target string, found long, new_items long, ok boolean")


def after_fetch(state: State, fetched: DataFrame, as_of: date, keywords: dict[str, list[str]] = classify.KEYWORDS) -> State:
    """All stages that follow fetching."""
    now = datetime.combine(as_of, time())
    return classify_stage(dedupe_stage(extract_stage(state, fetched, now), now), keywords)
