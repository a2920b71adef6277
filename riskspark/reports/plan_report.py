"""The report of a wide-table plan: features, tables, groups, and the SQL of the score."""

from __future__ import annotations

from ..operators.scoring import full_sql
from ..plans import metadata as md
from ..plans.planner import Plan
from ..sources.model_text import TreeModel
from . import sinks


def markdown(plan: Plan, metadata: md.Metadata, features: list[str], overrides: dict[str, str] | None = None, model: TreeModel | None = None, blacklist: list[str] | None = None) -> str:
    status = md.feature_status(features, metadata, overrides)
    groups = [{"group": g.name, "platform": g.platform, "category": g.category, "join_key": g.join_key, "tables": len(g.tables), "variables": sum(map(len, g.tables.values()))} for g in plan.groups]
    tables = [{"table": t, "variables": ", ".join(v)} for g in plan.groups for t, v in g.tables.items()]
    stats = [{"measure": k, "value": v} for k, v in metadata.statistics().items() if not isinstance(v, dict)]
    importance = [{"feature": f, "gain": g} for f, g in model.ranked()] if model else None
    return sinks.markdown(
        "wide table",
        {
            "features": status, "ambiguous": [{"feature": f, "table": t} for f, t in plan.resolved.items()] or None, "groups": groups, "tables": tables, "metadata": stats,
            "importance": importance, "blacklisted": ", ".join(md.blacklisted(features, blacklist or [])) or "none", "plan": "```\n" + plan.describe() + "\n```",
        },
    )


def keys(metadata: md.Metadata) -> list[dict]:
    """Join keys by table, for review."""
    return [{"table": t.name, "join_key": t.join_key, "candidates": ", ".join(t.candidates), "partition": t.partition} for t in metadata.tables.values()]


def score_sql(model: TreeModel, table: str, keep: list[str], path: str) -> None:
    sinks.save_text(path, full_sql(model, table, keep) + ";\n")
