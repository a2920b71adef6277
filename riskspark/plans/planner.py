"""From features and metadata to groups of tables, and from these to one lazy DataFrame."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import joins
from . import rules
from .metadata import Metadata


@dataclass(frozen=True)
class TimeRange:
    """How a table's time meets the sample's. mode: range, between or equality (of months, `offset` months later).

    dedup keeps the latest row of each sample row; it is the default, since a range join else repeats sample rows.
    """

    mode: str = "range"
    time_field: str = "part_id"
    sample_field: str = "issue_time"
    window: int = 1
    unit: str = "months"
    direction: str = "<="
    offset: int = 0
    dedup: bool = True
    tie: tuple[str, ...] = ()


@dataclass(frozen=True)
class CustomJoin:
    """table_key = sample_key, through md5 of the table's key, with the day of time_field `days` from the sample's, or by text."""

    join_key: str = ""
    sample_key: str = ""
    md5: bool = False
    time_field: str = ""
    sample_time: str = ""
    days: int = 0
    on: str = ""


@dataclass(frozen=True)
class CreditBridge:
    """The latest report of a person, not after the sample's time and at most `days` old, found by a hashed key."""

    table: str
    key: str
    report: str
    time: str
    sample_key: str
    sample_time: str
    days: int = 90
    md5: bool = True
    min_partition: str = ""
    partition: str = rules.PARTITION


@dataclass
class Config:
    sample_key: str = "apply_no"
    biz_date: str = ""
    target_platform: str = ""
    priority: list[str] = field(default_factory=list)
    max_join: int = 3
    strategy: str = "balanced"
    fill: float | None = None
    join_types: dict[str, str] = field(default_factory=dict)
    partition_control: dict[str, dict] = field(default_factory=dict)
    time_ranges: dict[str, TimeRange] = field(default_factory=dict)
    custom: dict[str, CustomJoin] = field(default_factory=dict)
    extra_where: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    bridge: CreditBridge | None = None
    sample_keys: dict[str, str] = field(default_factory=dict)
    strict: bool = False
    #: The wide table is written and read again after so many joined tables; 0: never.
    cut_every: int = 0

    def join_type(self, platform: str, category: str) -> str:
        return self.join_types.get(platform) or self.join_types.get(category) or "left"

    def partition_policy(self, table: str, platform: str, category: str) -> dict:
        """The policy of the table, its platform, its category or the default, with the default's values for what it lacks."""
        base = self.partition_control.get("default", {})
        for level in (f"table:{table}", f"platform:{platform}", f"category:{category}"):
            if level in self.partition_control:
                return {**base, **self.partition_control[level]}
        return dict(base)

    def partition(self, table: str, platform: str, category: str, own: str) -> tuple[str, str, str] | None:
        """(field, operator, value) that a table's rows are read by, if any; own is the table's partition column.

        A least partition goes before the business date, which holds for tables without a time rule unless the policy is not enabled.
        """
        policy = self.partition_policy(table, platform, category)
        name = policy.get("partition_field", own)
        if policy.get("min_partition"):
            return name, ">=", str(policy["min_partition"])
        if self.biz_date and policy.get("enabled", True) and table not in self.time_ranges:
            return name, "=", self.biz_date
        return None

    def conditions(self, table: str, platform: str, category: str) -> list[str]:
        """Extra conditions of the first level that has any: table, platform, category."""
        for level, name in (("by_table", table), ("by_platform", platform), ("by_category", category)):
            if found := self.extra_where.get(level, {}).get(name):
                return found
        return []


@dataclass(frozen=True)
class Group:
    name: str
    platform: str
    category: str
    join_key: str
    tables: dict[str, tuple[str, ...]]
    marker: str = ""


@dataclass(frozen=True)
class Plan:
    groups: tuple[Group, ...]
    resolved: dict[str, str]
    unknown: tuple[str, ...]

    def describe(self) -> str:
        lines = []
        for g in self.groups:
            lines.append(f"{g.name}: {g.category}/{g.platform} on {g.join_key}" + (f" [{g.marker}]" if g.marker else ""))
            lines += [f"  {t}: {', '.join(v)}" for t, v in g.tables.items()]
        if self.unknown:
            lines.append("unknown: " + ", ".join(self.unknown))
        return "\n".join(lines)


def resolve(metadata: Metadata, features: list[str], config: Config) -> dict[str, str]:
    """The table of each ambiguous feature: among behaviour tables the target platform's, else the first of the priority list, else the first."""
    out = {}
    for name, tables in metadata.ambiguous(features).items():
        own = [metadata.tables[t] for t in tables if t in metadata.tables and metadata.tables[t].category == rules.BEHAVIOUR]
        order = [p for p in (config.target_platform, *config.priority) if p]
        ranked = sorted(own, key=lambda t: order.index(t.platform) if t.platform in order else len(order))
        out[name] = ranked[0].name if ranked else tables[0]
    return out


def parts(tables: list[str], most: int, strategy: str = "balanced") -> list[list[str]]:
    """The tables in runs of at most `most`: filled one after the other, or as even as can be."""
    if strategy not in ("sequential", "balanced"):
        raise ValueError(f"unknown strategy {strategy}")
    n = -(-len(tables) // most) if tables else 0
    if n <= 1:
        return [tables] if tables else []
    if strategy == "sequential":
        return [tables[i : i + most] for i in range(0, len(tables), most)]
    ends = [0]
    for i in range(n):
        ends.append(ends[-1] + len(tables) // n + (i < len(tables) % n))
    return [tables[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def plan(metadata: Metadata, features: list[str], config: Config) -> Plan:
    """Groups of tables by platform, join key and time rule; credit tables are one group by report. In strict mode unknown features are an error."""
    known, unknown = metadata.split(features)
    if unknown and config.strict:
        raise ValueError(f"features without metadata: {unknown}")
    chosen = resolve(metadata, known, config)
    by_table: dict[str, list[str]] = {}
    for f in dict.fromkeys(known):
        table = chosen.get(f.lower()) or metadata.sources(f)[0]
        by_table.setdefault(table, []).append(f.lower())
    grouped: dict[tuple, dict[str, tuple[str, ...]]] = {}
    for table in sorted(by_table):
        t = metadata.tables[table]
        credit = t.category == rules.CREDIT and config.bridge is not None
        marker = "time" if table in config.time_ranges else ""
        key = (rules.CREDIT if credit else t.platform, t.category, config.bridge.report if credit else t.join_key, "" if credit else marker)
        grouped.setdefault(key, {})[table] = tuple(by_table[table])
    groups = []
    for (platform, category, join_key, marker), tables in grouped.items():
        for k, names in enumerate(parts(list(tables), config.max_join, config.strategy)):
            groups.append(Group(f"g{len(groups) + 1}" + (f"_{k + 1}" if k else ""), platform, category, join_key, {n: tables[n] for n in names}, marker))
    return Plan(tuple(groups), chosen, tuple(unknown))


Resolver = Callable[[str], DataFrame]


def scan(resolver: Resolver, metadata: Metadata, table: str, names: tuple[str, ...], config: Config, keep: list[str], sample: DataFrame, sample_key: str | None) -> DataFrame:
    """keep and the variables of a table, filtered by partition, extra conditions and the sample's keys, each before any join."""
    t = metadata.tables[table]
    df = resolver(table)
    kinds = dict(df.dtypes)
    read = config.partition(table, t.platform, t.category, t.partition)
    if read and read[0] in kinds:
        name, test, value = read
        value = F.lit(value).cast(kinds[name])
        df = df.where(F.col(name) >= value if test == ">=" else F.col(name) == value)
    for text in config.conditions(table, t.platform, t.category):
        df = df.where(F.expr(text))
    custom = config.custom.get(table, CustomJoin())
    key = custom.join_key or t.join_key
    if sample_key and not custom.md5 and not custom.on and key in kinds and not (config.bridge and t.category == rules.CREDIT):
        df = joins.semi(df, key, sample, sample_key)
    columns = list(dict.fromkeys([*keep, *(metadata.get(n, table).physical for n in names)]))
    return df.select(*columns)


def lower(plan: Plan, metadata: Metadata, sample: DataFrame, resolver: Resolver, config: Config, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """sample.* and all variables of the plan, one row for each sample row where tables are unique by their key or deduplicated.

    A variable that the sample, or a table before, already has under its name is called <group>_<variable>. With config.cut_every the
    table is written and read again after so many joins, by `cut` or below the shared folder: a plan of hundreds of joins takes long to
    optimise, and a lost executor would cost all of them.
    """
    cut, joined = cut or (Cuts(sample.sparkSession) if config.cut_every else None), 0
    out = sample
    bridge = _bridge(sample, resolver, config) if config.bridge and any(g.category == rules.CREDIT for g in plan.groups) else None
    if bridge is not None:
        out = bridge
    taken = set(out.columns)
    for group in plan.groups:
        for table, names in group.tables.items():
            fresh = {n: (n if n not in taken else f"{group.name}_{n}") for n in names}
            if config.cut_every and joined and joined % config.cut_every == 0:
                out = cut(out)
            out = _join(out, sample, table, names, fresh, group, metadata, resolver, config)
            taken |= set(fresh.values())
            joined += 1
    if config.fill is not None:
        added = [c for c in out.columns if c not in sample.columns]
        kinds = dict(out.dtypes)
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(config.fill).cast(kinds[c])) for c in added if kinds[c] in ("double", "float", "int", "bigint")})
    return out


def _bridge(sample: DataFrame, resolver: Resolver, config: Config) -> DataFrame:
    b = config.bridge
    reports = resolver(b.table)
    if b.min_partition and b.partition in reports.columns:
        reports = reports.where(F.col(b.partition) >= F.lit(b.min_partition).cast(dict(reports.dtypes)[b.partition]))
    person = joins.md5_key(F.col(b.key)) if b.md5 else F.col(b.key)
    reports = reports.select(person.alias("_person"), F.to_timestamp(F.col(b.time)).alias("_time"), F.col(b.report))
    timed = sample.withColumn("_issue", day(F.col(b.sample_time), dict(sample.dtypes)[b.sample_time]))
    found = joins.as_of(timed, reports, (b.sample_key, "_person"), ("_issue", "_time"), [b.report], b.days, [b.report])
    return found.drop("_issue", "_time")


def day(column: Column, kind: str) -> Column:
    """A date of a date, a timestamp, or a text or number yyyyMMdd or yyyyMM (its first day)."""
    if kind in ("date", "timestamp"):
        return column.cast("date")
    text = F.regexp_replace(column.cast("string"), "-", "")
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyyMMdd")), F.try_to_timestamp(text, F.lit("yyyyMM"))).cast("date")


def _join(out, sample, table, names, fresh, group, metadata, resolver, config) -> DataFrame:
    t, custom, rule = metadata.tables[table], config.custom.get(table, CustomJoin()), config.time_ranges.get(table)
    how = config.join_type(t.platform, t.category)
    key = custom.join_key or t.join_key
    credit = config.bridge is not None and t.category == rules.CREDIT
    sample_key = config.bridge.report if credit else custom.sample_key or config.sample_keys.get(key) or (key if key in out.columns else config.sample_key)
    times = [x for x in (custom.time_field, rule.time_field if rule else "", *(rule.tie if rule else ())) if x]
    side = scan(resolver, metadata, table, names, config, list(dict.fromkeys([key, *times])), sample, None if credit else sample_key)
    physical = {metadata.get(n, table).physical: fresh[n] for n in names}
    variables = {fresh[n]: metadata.get(n, table).physical for n in names}
    if custom.on:
        named = side.alias("t").select(F.struct("t.*").alias("t"))
        x = out.alias("s").join(named, F.expr(custom.on), how)
        return x.select("s.*", *(F.col(f"t.{c}").alias(n) for n, c in variables.items()))
    if rule and rule.mode in ("range", "between"):
        kinds = dict(side.dtypes)
        side = side.withColumn("_time", day(F.col(rule.time_field), kinds[rule.time_field]))
        if custom.md5:
            side = side.withColumn(key, joins.md5_key(F.col(key)))
        timed = out.withColumn("_issue", day(F.col(rule.sample_field), dict(out.dtypes)[rule.sample_field]))
        if rule.mode == "range" and rule.direction == "<=" and rule.dedup:
            # the latest row of a key is the nearest one: no pairs need be formed
            got = joins.as_of(timed, side, (sample_key, key), ("_issue", "_time"), list(physical), rule.window, rule.tie, unit=rule.unit)
            got = got.where(F.col("_time").isNotNull()) if how == "inner" else got
            return got.drop("_issue", "_time").withColumnsRenamed({c: n for c, n in physical.items() if c != n})
        got = joins.interval(
            timed, side, (sample_key, key), ("_issue", "_time"), list(physical), rule.window, rule.unit, "between" if rule.mode == "between" else rule.direction,
            how, [config.sample_key] if rule.dedup else None, rule.tie,
        )
        return got.drop("_issue", "_time").withColumnsRenamed({c: n for c, n in physical.items() if c != n})
    on: list[tuple] = [(sample_key, joins.md5_key(F.col(key)) if custom.md5 else key)]
    if custom.time_field and custom.sample_time:
        kind = dict(out.dtypes)[custom.sample_time]
        on.append((F.date_format(F.date_add(day(F.col(custom.sample_time), kind), custom.days), "yyyyMMdd").cast("int"), F.col(custom.time_field).cast("int")))
    if rule and rule.mode == "equality":
        kinds = dict(side.dtypes)
        shifted = F.date_format(F.add_months(day(F.col(rule.time_field), kinds[rule.time_field]), rule.offset), "yyyyMM")
        on.append((F.date_format(day(F.col(rule.sample_field), dict(out.dtypes)[rule.sample_field]), "yyyyMM"), shifted))
    return joins.keyed(out, side, on, variables, how)


class Cuts:
    """Writes tables below a folder, spark.checkpoint.dir unless one is given, and reads them again; they go with clear() or at exit."""

    def __init__(self, spark, folder: str = ""):
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not (folder or conf):
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="riskspark-")
        self.spark, self.made = spark, 0
        self.root = f"{(folder or conf).rstrip('/')}/wide-{uuid.uuid4().hex}"
        atexit.register(self.clear)

    def __call__(self, df: DataFrame) -> DataFrame:
        self.made += 1
        return materialise(df, f"{self.root}/{self.made:04d}")

    def clear(self) -> None:
        try:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write and read again: a wide table is cut here where its plan grows long."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def catalog(spark, paths: dict[str, str] | None = None, platform_alias: str = "") -> Resolver:
    """Tables by registered path, else by name in the catalog; `$platform` in a name is replaced."""

    def find(name: str) -> DataFrame:
        name = name.replace("$platform", platform_alias)
        return spark.read.parquet(paths[name]) if paths and name in paths else spark.table(name)

    return find


def from_frames(frames: dict[str, DataFrame]) -> Resolver:
    return lambda name: frames[name]


def chain(base: DataFrame, sides: list[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins of several tables on one key name, the first being the base."""
    return reduce(lambda a, b: a.join(b[0], b[1], "left"), sides, base)
