"""Samples, dictionaries and workbooks as DataFrames; variable lists and configuration as plain values."""

from __future__ import annotations

import json
import re
import zipfile
from pathlib import Path
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Headers of a variable dictionary and their names here.
HEADERS = {"字段名": "name", "字段含义": "description", "库名": "db", "表名": "table", "表描述": "table_description", "来源表": "source"}


def read_csv(spark: SparkSession, path: str, sep: str | None = None, schema: str | None = None, lower: bool = True, sample: float | None = None) -> DataFrame:
    """A CSV file with a header. sep None: a tab if the first line holds more tabs than commas. Without a schema types are inferred, which reads
    the file once more, from all rows or from the share `sample` of them."""
    if sep is None:
        head = spark.read.text(path).limit(1).collect()
        line = head[0].value if head else ""
        sep = "\t" if line.count("\t") > line.count(",") else ","
    reader = spark.read.option("header", True).option("sep", sep)
    if sample:
        reader = reader.option("samplingRatio", sample)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return df.toDF(*(c.strip().lower() for c in df.columns)) if lower else df


def _column(ref: str) -> int:
    out = 0
    for c in re.match("[A-Z]+", ref)[0]:
        out = out * 26 + ord(c) - 64
    return out - 1


def xlsx_rows(path: str, sheet: int | str = 0) -> list[list[str | float | None]]:
    """The cells of a sheet of a workbook: numbers, texts (shared or inline), booleans as 0 and 1."""
    space = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for item in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", space):
                shared.append("".join(t.text or "" for t in item.iter(f"{{{space['m']}}}t")))
        book = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets", space)
        listed = list(book)
        chosen = listed[sheet] if isinstance(sheet, int) else next(s for s in listed if s.get("name") == sheet)
        links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = links[chosen.get(rel)].lstrip("/")
        root = ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
        rows = []
        for r in root.iter(f"{{{space['m']}}}row"):
            cells: list[str | float | None] = []
            for c in r:
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                value = c.find("m:v", space)
                if c.get("t") == "s":
                    cells[at] = shared[int(value.text)]
                elif c.get("t") == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(f"{{{space['m']}}}t"))
                elif value is not None and value.text is not None:
                    cells[at] = value.text if c.get("t") == "str" else float(value.text)
            rows.append(cells)
        return rows


def read_xlsx(spark: SparkSession, path: str, sheet: int | str = 0) -> DataFrame:
    """A sheet with a header row; a column is double if all its cells are numbers, else string. Workbooks are small: read by the driver."""
    rows = xlsx_rows(path, sheet)
    head = [str(c or f"_c{i}").strip().lower() for i, c in enumerate(rows[0])] if rows else []
    body = [(r + [None] * len(head))[: len(head)] for r in rows[1:]]
    numeric = [any(r[i] is not None for r in body) and all(isinstance(r[i], float) or r[i] is None for r in body) for i in range(len(head))]
    data = [[(c if n or c is None else f"{c:g}" if isinstance(c, float) else c) for c, n in zip(r, numeric, strict=True)] for r in body]
    schema = ", ".join(f"`{h}` {'double' if n else 'string'}" for h, n in zip(head, numeric, strict=True))
    return spark.createDataFrame(data, schema or "_empty string")


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: parquet, xlsx, else CSV with a sniffed separator."""
    kind = Path(path).suffix.lower()
    if kind == ".parquet":
        return spark.read.parquet(path)
    return read_xlsx(spark, path) if kind == ".xlsx" else read_csv(spark, path)


def dictionary_rows(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """Rows of a variable dictionary (CSV, TSV, xlsx or YAML) with names in lower case and the HEADERS' names."""
    if Path(path).suffix.lower() in (".yaml", ".yml"):
        import yaml

        data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
        rows = data["variables"] if isinstance(data, dict) else data
        return [{HEADERS.get(k, k): v for k, v in r.items()} for r in rows]
    df = read_xlsx(spark, path) if path.endswith(".xlsx") else read_csv(spark, path, lower=False)
    df = df.toDF(*(HEADERS.get(c.strip(), c.strip().lower()) for c in df.columns))
    if "name" in df.columns:
        df = df.withColumn("name", F.lower(F.trim("name")))
    if "source" not in df.columns and {"db", "table"} <= set(df.columns):
        df = df.withColumn("source", F.concat_ws(".", "db", "table"))
    return [r.asDict() for r in df.collect()]


def is_warehouse(columns: list[str]) -> bool:
    """Whether columns are those of a variable dictionary."""
    own = {HEADERS.get(c.strip(), c.strip().lower()) for c in columns}
    return "name" in own and bool({"table", "source"} & own)


def metadata_dict(spark: SparkSession, path: str, classify: bool = True) -> dict[str, dict]:
    """name: row of a dictionary; of another file, its first column is the key."""
    rows = dictionary_rows(spark, path)
    if not rows:
        return {}
    from ..plans import rules

    key = "name" if is_warehouse(list(rows[0])) else next(iter(rows[0]))
    out = {}
    for r in rows:
        if classify and r.get("source"):
            r = {**r, "category": rules.classify(r["source"])[0], "platform": rules.classify(r["source"])[1]}
        out.setdefault(str(r[key]).lower(), r)
    return out


def lookup_source(df: DataFrame, dictionary: DataFrame, variable: str = "variable") -> DataFrame:
    """df with source: the first table, by name, of each variable in a dictionary of name and source, else `unknown`."""
    first = dictionary.groupBy(F.lower("name").alias("_name")).agg(F.min("source").alias("source"))
    return df.join(first, F.lower(F.col(variable)) == F.col("_name"), "left").drop("_name").withColumn("source", F.coalesce("source", F.lit("unknown")))


def variable_list(path: str) -> list[str]:
    """Lower-cased names, one for each line; `#` starts a comment."""
    lines = (x.split("#", 1)[0].strip().lower() for x in Path(path).read_text(encoding="utf-8").splitlines())
    return list(dict.fromkeys(x for x in lines if x))


def merged(base: dict, over: dict) -> dict:
    """Nested mappings merged, the second winning."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def substituted(value, names: dict[str, str]):
    """`${name}` replaced in all texts of a nested value; unknown names stay."""
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: str(names.get(m[1], m[0])), value)
    if isinstance(value, dict):
        return {k: substituted(v, names) for k, v in value.items()}
    return [substituted(v, names) for v in value] if isinstance(value, list) else value


def load_config(path: str, model_path: str | None = None) -> dict:
    """A YAML file, merged with a model's own, `${}` replaced from its project section; a blacklist file is joined to the listed names."""
    import yaml

    read = lambda p: yaml.safe_load(Path(p).read_text(encoding="utf-8")) or {}
    out = read(path)
    if model_path:
        out = merged(out, read(model_path))
    out = substituted(out, {k: str(v) for k, v in (out.get("project") or {}).items()})
    names = [str(n).lower() for n in out.get("blacklist_vars") or []]
    if out.get("blacklist_file"):
        names += variable_list(str(Path(path).parent / out["blacklist_file"]))
    if names:
        out["blacklist_vars"] = list(dict.fromkeys(names))
    return out


def load_diff_config(path: str):
    """A JSON file of primary_keys, score_column and variables (name, data_source, precision, type)."""
    from ..operators.diff import DiffSpec, Variable

    data = json.loads(Path(path).read_text(encoding="utf-8"))
    own = [Variable(v["name"].lower(), v.get("data_source", "unknown"), v.get("precision"), v.get("type") or "numeric") for v in data.get("variables", [])]
    return DiffSpec([k.lower() for k in data["primary_keys"]], data["score_column"].lower(), own)


def diff_from_names(names: list[str], keys: list[str], score: str, sources: dict[str, str] | None = None):
    """A diff configuration of a list of variables, from a file, a model or elsewhere."""
    from ..operators.diff import DiffSpec, Variable

    return DiffSpec([k.lower() for k in keys], score.lower(), [Variable(n.lower(), (sources or {}).get(n.lower(), "unknown")) for n in names])
