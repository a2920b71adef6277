"""The comparison report, with SQL to look up sample rows of each anomaly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import diff
from . import sinks

RULES = """Both null is a match; null on one side is not. Numbers up to -99999, empty texts and `nan` are null.
The score matches within 0.001. Numbers are rounded to the given or inferred decimals, texts are trimmed."""


def build(online: DataFrame, offline: DataFrame, spec: diff.DiffSpec, offline_score: str | None = None) -> dict[str, object]:
    merged = diff.merge(online, offline, spec.keys, offline_score, spec.score)
    if merged.isEmpty():
        raise ValueError("no rows with keys on both sides")
    compared = diff.compare(merged, spec)
    rates = diff.match_rates(compared, spec)
    return {
        "overview": diff.overview(online, offline, merged), "null rates online": diff.null_rates(online, "online"), "null rates offline": diff.null_rates(offline, "offline"),
        "score": rates.where("name = 'score'").select("match_count", "total", "match_rate"),
        "variables": rates.where("name <> 'score'").orderBy("source_rate", "match_rate", "name"),
        "sources": diff.drill_up(compared, spec).orderBy("strict", "source"),
        "anomalies": diff.anomalies(compared, spec).orderBy("name", "kind"),
        "values": diff.top_pairs(compared, spec).orderBy("name", "kind", "rank"),
        "look up": lookup_sql(diff.sample_rows(compared, spec), spec),
        "rules": RULES,
    }


def lookup_sql(samples: DataFrame, spec: diff.DiffSpec, tables: dict[str, str] | None = None, etl: str = "etl_dt", at: str = "sample_date") -> str:
    """One query for each anomaly group: the rows of its sample keys, nearest in time first. Three rows a group are collected."""
    key = spec.keys[0]
    groups: dict[tuple[str, str], list[str]] = {}
    for r in samples.orderBy("name", "kind", F.col("rank")).select("name", "kind", F.col(key).cast("string").alias("k")).collect():
        groups.setdefault((r["name"], r["kind"]), []).append((r["k"] or "").replace("'", "''"))
    source = {v.name: v.source for v in spec.variables}
    out = []
    for (name, kind), keys in groups.items():
        table = (tables or {}).get(source.get(name, ""), source.get(name, "unknown"))
        listed = ", ".join(f"'{k}'" for k in keys)
        out.append(f"-- {name}: {kind}\nSELECT {key}, {name}, {etl}, datediff({at}, {etl}) AS days FROM {table} WHERE {key} IN ({listed}) ORDER BY {key}, days;")
    return "```sql\n" + "\n\n".join(out) + "\n```"


def markdown(online: DataFrame, offline: DataFrame, spec: diff.DiffSpec, offline_score: str | None = None) -> str:
    return sinks.markdown("online and offline values", build(online, offline, spec, offline_score))
