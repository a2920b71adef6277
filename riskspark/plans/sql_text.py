"""A plan as Spark SQL text: for review, for schedulers that run SQL, and for the archive. lower() runs the same plan directly."""

from __future__ import annotations

from . import rules
from .metadata import Metadata
from .planner import Config, CustomJoin, Plan


def _day(column: str, kind: str) -> str:
    """SQL for a date of a column: kind is date, or text of yyyyMMdd or yyyyMM."""
    if kind == "date":
        return f"CAST({column} AS DATE)"
    text = f"replace(CAST({column} AS STRING), '-', '')"
    return f"CAST(coalesce(try_to_timestamp({text}, 'yyyyMMdd'), try_to_timestamp({text}, 'yyyyMM')) AS DATE)"


def _bridge(sample: str, config: Config, kind: str) -> str:
    b = config.bridge
    person = f"md5(CAST(r.{b.key} AS STRING))" if b.md5 else f"r.{b.key}"
    least = f" AND r.{b.partition} >= '{b.min_partition}'" if b.min_partition else ""
    issue = _day(f"s.{b.sample_time}", kind)
    return (
        f"bridge AS (SELECT s.*, x.{b.report} FROM {sample} s LEFT JOIN (SELECT s.{config.sample_key} AS _key, "
        f"max_by(r.{b.report}, struct(to_timestamp(r.{b.time}), r.{b.report})) AS {b.report} FROM {sample} s JOIN {b.table} r "
        f"ON {person} = s.{b.sample_key} AND to_timestamp(r.{b.time}) <= {issue} AND datediff({issue}, to_timestamp(r.{b.time})) <= {b.days}{least} "
        f"GROUP BY s.{config.sample_key}) x ON x._key = s.{config.sample_key})"
    )


JOINS = {"left": "LEFT JOIN", "inner": "JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN", "outer": "FULL JOIN"}


def wide_sql(
    plan: Plan, metadata: Metadata, sample: str, sample_columns: list[str], config: Config, kinds: dict[str, str] | None = None,
    columns_of: dict[str, list[str]] | None = None,
) -> str:
    """One statement: sample.* and the plan's variables. kinds names columns whose type is date; others are read as text.

    Tables are read by the partition that lower() reads them by; columns_of names the columns of tables, as far as known, and one that lacks
    its partition column is read whole, as lower() does.
    """
    kinds, columns_of = kinds or {}, columns_of or {}
    bridged = config.bridge is not None and any(g.category == rules.CREDIT for g in plan.groups)
    heads = [_bridge(sample, config, kinds.get(config.bridge.sample_time, ""))] if bridged else []
    base, taken, at = ("bridge" if bridged else sample), set(sample_columns), 0
    selected, steps = [], []
    for group in plan.groups:
        for table, names in group.tables.items():
            at += 1
            t, custom, rule = metadata.tables[table], config.custom.get(table, CustomJoin()), config.time_ranges.get(table)
            key = custom.join_key or t.join_key
            credit = bridged and t.category == rules.CREDIT
            sample_key = config.bridge.report if credit else custom.sample_key or config.sample_keys.get(key) or (key if key in sample_columns else config.sample_key)
            where = list(config.conditions(table, t.platform, t.category))
            read = config.partition(table, t.platform, t.category, t.partition)
            if read and read[0] in columns_of.get(table, read):
                where.insert(0, f"{read[0]} {read[1]} '{read[2]}'")
            if not credit and not custom.md5 and not custom.on:
                where.append(f"{key} IN (SELECT {sample_key} FROM {sample})")
            own_key = f"md5(CAST({key} AS STRING))" if custom.md5 else key
            columns = [f"{own_key} AS _key"] + [f"{metadata.get(n, table).physical} AS _{n}" for n in names]
            times = [x for x in (custom.time_field if custom.sample_time else "", rule.time_field if rule else "") if x]
            columns += [f"{x} AS _time" for x in times[:1]] + [f"{x} AS _tie_{x}" for x in (rule.tie if rule else ())]
            source = f"(SELECT {', '.join(columns)} FROM {table}" + (f" WHERE {' AND '.join(where)}" if where else "") + ")"
            how = config.join_type(t.platform, t.category).lower()
            if how not in JOINS:
                raise ValueError(f"join type {how} of {table} is none of {', '.join(JOINS)}")
            how = JOINS[how]
            on = [f"t{at}._key = s.{sample_key}"]
            if custom.on:
                on = [custom.on.replace("t.", f"t{at}.")]
            elif custom.time_field and custom.sample_time:
                on.append(f"CAST(t{at}._time AS INT) = CAST(date_format(date_add({_day(f's.{custom.sample_time}', kinds.get(custom.sample_time, ''))}, {custom.days}), 'yyyyMMdd') AS INT)")
            elif rule and rule.mode == "equality":
                on.append(f"date_format(add_months({_day(f't{at}._time', '')}, {rule.offset}), 'yyyyMM') = date_format({_day(f's.{rule.sample_field}', kinds.get(rule.sample_field, ''))}, 'yyyyMM')")
            elif rule:
                a, b = _day(f"s.{rule.sample_field}", kinds.get(rule.sample_field, "")), _day(f"t{at}._time", "")
                gap = lambda x, y, unit=rule.unit: f"months_between({x}, {y})" if unit == "months" else f"datediff({x}, {y})"
                span = gap(b, a) if rule.direction == ">=" and rule.mode == "range" else gap(a, b)
                order = {"<=": f" AND {b} <= {a}", ">=": f" AND {b} >= {a}"}.get(rule.direction, "") if rule.mode == "range" else ""
                on.append(f"{span} BETWEEN 0 AND {rule.window}{order}")
            fresh = {n: n if n not in taken else f"{group.name}_{n}" for n in names}
            taken |= set(fresh.values())
            if rule and rule.mode != "equality" and rule.dedup:
                # one row for each sample row, the nearest in time
                a, b = _day(f"s.{rule.sample_field}", kinds.get(rule.sample_field, "")), _day(f"t{at}._time", "")
                nearest = ", ".join([f"abs(datediff({a}, {b})) NULLS LAST", f"{b} DESC NULLS LAST", *(f"t{at}._tie_{x} DESC NULLS LAST" for x in rule.tie)])
                heads.append(
                    f"j{at} AS (SELECT * FROM (SELECT s.{config.sample_key} AS _id, {', '.join(f't{at}._{n}' for n in names)}, row_number() OVER (PARTITION BY s.{config.sample_key} ORDER BY {nearest}) AS _rn "
                    f"FROM {base} s JOIN {source} t{at} ON {' AND '.join(on)}) WHERE _rn = 1)"
                )
                steps.append(f"{how} j{at} t{at} ON t{at}._id = s.{config.sample_key}")
            else:
                steps.append(f"{how} {source} t{at} ON {' AND '.join(on)}")
            filled = (lambda x: f"coalesce({x}, {config.fill!r})") if config.fill is not None else (lambda x: x)
            selected += [f"{filled(f't{at}._{n}')} AS {fresh[n]}" for n in names]
    with_ = f"WITH {', '.join(heads)} " if heads else ""
    own = ", ".join(f"s.{c}" for c in [*sample_columns, *([config.bridge.report] if bridged and config.bridge.report not in sample_columns else [])])
    return f"{with_}SELECT {', '.join([own, *selected])} FROM {base} s {' '.join(steps)}".strip()


def create_table(name: str, sql: str) -> str:
    """The statements that replace a table by a query's rows."""
    return f"DROP TABLE IF EXISTS {name};\nCREATE TABLE {name} AS {sql};\n"
