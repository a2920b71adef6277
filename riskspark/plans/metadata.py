"""Variables and tables: records, loading with a checked cache, conversion from dictionaries, overrides, statistics."""

from __future__ import annotations

import copy
import json
from collections import Counter, defaultdict
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path

from . import rules


@dataclass
class Variable:
    name: str
    table: str = ""
    description: str = ""
    table_description: str = ""
    category: str = ""
    platform: str = ""
    join_key: str = ""
    candidates: list[str] = field(default_factory=list)
    partition: str = rules.PARTITION
    duplicate: bool = False
    likely_key: bool = False
    column: str = ""

    @property
    def physical(self) -> str:
        return self.column or self.name


@dataclass
class Table:
    name: str
    description: str = ""
    category: str = ""
    platform: str = ""
    join_key: str = ""
    candidates: list[str] = field(default_factory=list)
    partition: str = rules.PARTITION
    variables: list[str] = field(default_factory=list)

    @property
    def variable_count(self) -> int:
        return len(self.variables)


@dataclass
class Metadata:
    """Variables by (name, table) and tables by name. Changes give a copy."""

    variables: list[Variable] = field(default_factory=list)
    tables: dict[str, Table] = field(default_factory=dict)

    def sources(self, name: str) -> list[str]:
        """The tables that hold a variable, in order."""
        return [v.table for v in self.variables if v.name == name.lower()]

    def get(self, name: str, table: str | None = None) -> Variable | None:
        return next((v for v in self.variables if v.name == name.lower() and table in (None, v.table)), None)

    def split(self, names: list[str]) -> tuple[list[str], list[str]]:
        """(known, unknown) of the names."""
        known = {v.name for v in self.variables}
        return [n for n in names if n.lower() in known], [n for n in names if n.lower() not in known]

    def ambiguous(self, names: list[str] | None = None) -> dict[str, list[str]]:
        by: dict[str, list[str]] = defaultdict(list)
        for v in self.variables:
            by[v.name].append(v.table)
        wanted = {n.lower() for n in names} if names is not None else set(by)
        return {n: t for n, t in by.items() if len(set(t)) > 1 and n in wanted}

    def grouped(self, by: str) -> dict[str, list[str]]:
        """Names of variables by table, category or platform."""
        out: dict[str, list[str]] = {}
        for v in self.variables:
            out.setdefault(getattr(v, by), []).append(v.name)
        return out

    def where(self, **wanted) -> list[Variable]:
        return [v for v in self.variables if all(getattr(v, k) == x for k, x in wanted.items())]

    def tables_where(self, **wanted) -> list[Table]:
        return [t for t in self.tables.values() if all(getattr(t, k) == x for k, x in wanted.items())]

    def join_info(self, table: str) -> dict:
        t = self.tables[table]
        return {"join_key": t.join_key, "candidates": t.candidates, "partition": t.partition}

    def statistics(self) -> dict:
        """Counts in nine dimensions, and of variables that occur in several tables."""
        v, t = self.variables, list(self.tables.values())
        count = lambda rows, by: dict(Counter(getattr(x, by) for x in rows).most_common())
        return {
            "variables": len(v), "tables": len(t), "by_category": count(v, "category"), "by_platform": count(v, "platform"), "by_table": count(v, "table"),
            "tables_by_category": count(t, "category"), "tables_by_platform": count(t, "platform"), "by_join_key": count(v, "join_key"),
            "duplicates": len(self.ambiguous()), "likely_keys": sum(x.likely_key for x in v),
        }

    def frame(self, spark):
        """The variables as a DataFrame."""
        kinds = "name string, table string, description string, table_description string, category string, platform string, join_key string, candidates array<string>, partition string, duplicate boolean, likely_key boolean, column string"
        return spark.createDataFrame([tuple(asdict(v).values()) for v in self.variables], kinds)

    def with_overrides(self, tables: dict[str, str] | None = None, keys: dict[str, str] | None = None, aliases: dict[str, str] | None = None) -> Metadata:
        """A copy in which variables come from the given tables, tables join on the given keys, and aliases name physical columns; in this order."""
        out = copy.deepcopy(self)
        for name, table in (tables or {}).items():
            low = name.lower()
            own = out.get(low, table) or out.get(low) or Variable(low)
            kind, place = rules.classify(table)
            t = out.tables.get(table)
            k = rules.join_keys(table, kind)
            moved = replace(
                own, table=table, category=t.category if t else kind, platform=t.platform if t else place, join_key=t.join_key if t else k.primary,
                candidates=list(t.candidates) if t else k.candidates, partition=t.partition if t else k.partition,
            )
            out.variables = [v for v in out.variables if v.name != low] + [moved]
            if not t:
                out.tables[table] = Table(table, "", kind, place, k.primary, k.candidates, k.partition)
            if low not in out.tables[table].variables:
                out.tables[table].variables.append(low)
        for table, key in (keys or {}).items():
            if table in out.tables:
                out.tables[table].join_key = key
            for v in out.variables:
                if v.table == table:
                    v.join_key = key
        for name, column in (aliases or {}).items():
            for v in out.variables:
                if v.name == name.lower():
                    v.column = column
            if out.get(column) and not out.get(name):
                out.variables.append(replace(out.get(column), name=name.lower(), column=column.lower()))
        return out

    def to_dict(self) -> dict:
        return {"variables": [asdict(v) for v in self.variables], "tables": [{**asdict(t), "variable_count": t.variable_count} for t in self.tables.values()]}

    @classmethod
    def from_dict(cls, data: dict) -> Metadata:
        """Variables and tables; what a variable lacks is taken from its table, and a table lists at least its variables."""
        fields = lambda kind, x: {k: v for k, v in x.items() if k in kind.__dataclass_fields__}
        out = cls([], {t["name"]: Table(**fields(Table, t)) for t in data.get("tables", [])})
        for x in data.get("variables", []):
            v = Variable(**fields(Variable, {**x, "name": x["name"].lower()}))
            t = out.tables.setdefault(v.table, Table(v.table)) if v.table else None
            for name in ("category", "platform", "join_key", "candidates") if t else ():
                if not getattr(v, name):
                    setattr(v, name, copy.copy(getattr(t, name)))
            if t and v.name not in t.variables:
                t.variables.append(v.name)
            out.variables.append(v)
        known = {(v.name, v.table) for v in out.variables}
        for t in out.tables.values():
            for name in t.variables:
                if (name.lower(), t.name) not in known:
                    out.variables.append(Variable(name.lower(), t.name, "", t.description, t.category, t.platform, t.join_key, list(t.candidates), t.partition))
        return out


def from_rows(rows: list[dict[str, str]]) -> Metadata:
    """Metadata of dictionary rows (name, description, db, table, table_description): one for each (name, table), classified."""
    out = Metadata()
    seen: set[tuple[str, str]] = set()
    for r in rows:
        name = str(r.get("name") or "").strip().lower()
        table = ".".join(x for x in (str(r.get("db") or "").strip(), str(r.get("table") or "").strip()) if x)
        if not name or (name, table) in seen:
            continue
        seen.add((name, table))
        kind, place = rules.classify(table)
        k = rules.join_keys(table, kind)
        out.variables.append(
            Variable(name, table, r.get("description") or "", r.get("table_description") or "", kind, place, k.primary, list(k.candidates), k.partition, likely_key=rules.likely_key(name))
        )
        t = out.tables.setdefault(table, Table(table, r.get("table_description") or "", kind, place, k.primary, list(k.candidates), k.partition))
        t.variables.append(name)
    many = out.ambiguous()
    for v in out.variables:
        v.duplicate = v.name in many
    return out


def save(metadata: Metadata, path: str) -> None:
    """As YAML or, by suffix, JSON."""
    data = metadata.to_dict()
    if path.endswith(".json"):
        text = json.dumps(data, ensure_ascii=False, indent=1)
    else:
        import yaml

        text = yaml.safe_dump(data, allow_unicode=True, sort_keys=False)
    Path(path).write_text(text, encoding="utf-8")


def load(path: str, cache: bool = True) -> Metadata:
    """From YAML or JSON. YAML is slow to parse, so a JSON copy beside it is used while it is newer."""
    source = Path(path)
    if path.endswith(".json"):
        return Metadata.from_dict(json.loads(source.read_text(encoding="utf-8")))
    beside = source.with_suffix(source.suffix + ".cache.json")
    if cache and beside.exists() and beside.stat().st_mtime_ns > source.stat().st_mtime_ns:
        return Metadata.from_dict(json.loads(beside.read_text(encoding="utf-8")))
    import yaml

    data = yaml.load(source.read_text(encoding="utf-8"), Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader)) or {}
    if cache:
        try:
            beside.write_text(json.dumps(data, ensure_ascii=False, default=str), encoding="utf-8")
        except OSError:  # a read-only place has no cache
            pass
    return Metadata.from_dict(data)


def feature_status(names: list[str], metadata: Metadata, overrides: dict[str, str] | None = None) -> list[dict[str, str]]:
    """name, status (OVERRIDE, OK, AMBIGUOUS, NOT_FOUND) and tables of each feature."""
    overrides = {k.lower(): v for k, v in (overrides or {}).items()}
    out = []
    for n in names:
        tables = list(dict.fromkeys(metadata.sources(n)))
        if n.lower() in overrides:
            status, tables = "OVERRIDE", [overrides[n.lower()]]
        else:
            status = "NOT_FOUND" if not tables else "OK" if len(tables) == 1 else "AMBIGUOUS"
        out.append({"name": n, "status": status, "tables": ",".join(tables)})
    return out


def blacklisted(names: list[str], blacklist: list[str]) -> list[str]:
    """The names on the blacklist, in their order; the caller warns."""
    own = {b.lower() for b in blacklist}
    return [n for n in names if n.lower() in own]
