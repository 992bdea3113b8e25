"""All queries of the engine with their SQL counterparts."""

from __future__ import annotations

from plumbline.plans import entity_plans, matching_plans, review_plans, rollup_plans, stream_plans, text_plans

_PLANS = (rollup_plans, text_plans, matching_plans, entity_plans, review_plans, stream_plans)


def queries() -> dict:
    return {k: v for m in _PLANS for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _PLANS for k, v in m.SQL.items()}
