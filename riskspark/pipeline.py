"""From a model, metadata and a configuration to a scored wide table, with its report and SQL."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .operators.scoring import ScoreCard, full_sql, score
from .plans import metadata as md
from .plans import planner
from .plans.sql_text import create_table, wide_sql
from .reports import plan_report
from .reports.sinks import save_text
from .sources.model_text import TreeModel


def planner_config(data: dict) -> planner.Config:
    """The planner's configuration from a nested mapping as load_config() gives it."""
    project, sample, sql = data.get("project") or {}, data.get("sample") or {}, data.get("sql_generation") or {}
    ranges = {}
    for names, r in (data.get("time_range_joins") or {}).items():
        rule = planner.TimeRange(
            {"equality": "equality"}.get(r.get("match_mode", "range"), "between" if r.get("direction") == "between" else "range"), r.get("time_field", "part_id"),
            r.get("sample_time_field", "issue_time"), int(r.get("window", 1)), "months" if str(r.get("time_function", "DATEDIFF")).upper() == "MONTHS_BETWEEN" else "days",
            r.get("direction", "<=") if r.get("direction") != "between" else "<=", int(r.get("offset", 0)), bool(r.get("dedup", True)), tuple(r.get("tie") or ()),
        )
        for name in names.split(",") if isinstance(names, str) else names:
            ranges[name.strip()] = rule
    custom = {
        t: planner.CustomJoin(c.get("join_key", ""), c.get("sample_key", ""), bool(c.get("md5_transform")), c.get("time_offset", {}).get("table_field", ""),
                              c.get("time_offset", {}).get("sample_field", ""), int(c.get("time_offset", {}).get("days", 0)), c.get("custom_on_clause", ""))
        for t, c in ((data.get("custom_join_conditions") or {}).get("by_table") or {}).items()
    }
    b = data.get("credit_primary_table") or {}
    bridge = None
    if b.get("enabled"):
        bridge = planner.CreditBridge(
            b["table"], b["key"], b.get("report", "ci_rpt_id"), b["time"], b["sample_key"], b["sample_time"], int(b.get("days", 90)), bool(b.get("md5", True)), str(b.get("min_partition", "")), b.get("partition_field", "dt")
        )
    return planner.Config(
        sample_key=sample.get("key", "apply_no"), biz_date=str(sql.get("biz_date", "")), target_platform=project.get("target_platform", ""), priority=list(data.get("behavior_platform_priority") or []),
        max_join=int(sql.get("max_subquery_join", 3)), strategy=sql.get("subgroup_strategy", "balanced"), fill=sql.get("coalesce_value"), join_types=dict(sql.get("join_types") or {}),
        partition_control=dict(sql.get("partition_control") or {}), time_ranges=ranges, custom=custom, extra_where=dict(data.get("extra_where_conditions") or {}), bridge=bridge,
        sample_keys=dict(sample.get("keys") or {}), strict=bool(data.get("strict", False)), cut_every=int(sql.get("cut_every", 0)),
    )


@dataclass
class ScoringPipeline:
    """metadata is changed by the configuration's overrides: variables, table keys, aliases, in this order."""

    model: TreeModel
    metadata: md.Metadata
    config: dict = field(default_factory=dict)

    def __post_init__(self):
        c = self.config
        self.metadata = self.metadata.with_overrides(c.get("variable_overrides"), c.get("table_join_keys"), c.get("variable_aliases"))
        self.planner_config = planner_config(c)
        out = c.get("output") or {}
        self.keep = list(out.get("keep_columns") or [self.planner_config.sample_key])
        self.card = ScoreCard(**{k: v for k, v in (c.get("scorecard") or {}).items() if k in ("shift", "slope", "digits")})
        shown = out.get("variable_output") or {}
        self.shown = {"output_variables": bool(shown.get("enabled")), "top": int(shown.get("top_n", 0)), "by_importance": bool(shown.get("sort_by_importance", True))}

    def features(self) -> list[str]:
        """Features of positive importance, without a blacklist's being an obstacle: those are reported."""
        return [f.lower() for f in self.model.valid_features()]

    def plan(self) -> planner.Plan:
        return planner.plan(self.metadata, self.features(), self.planner_config)

    def wide(self, sample: DataFrame, resolver: planner.Resolver) -> DataFrame:
        return planner.lower(self.plan(), self.metadata, sample, resolver, self.planner_config)

    def run(self, sample: DataFrame, resolver: planner.Resolver) -> DataFrame:
        """The scored sample."""
        return score(self.wide(sample, resolver), self.model, self.keep, self.card, **self.shown)

    def report(self) -> str:
        c = self.config
        return plan_report.markdown(self.plan(), self.metadata, self.features(), c.get("variable_overrides"), self.model, c.get("blacklist_vars"))

    def save_sql(
        self, path: str, sample: str, sample_columns: list[str], output: str = "wide_table", scored: str = "scored_table", columns_of: dict[str, list[str]] | None = None
    ) -> None:
        wide = wide_sql(self.plan(), self.metadata, sample, sample_columns, self.planner_config, columns_of=columns_of)
        save_text(path, create_table(output, wide) + "\n" + create_table(scored, full_sql(self.model, output, self.keep, self.card)))
