"""Files in and out: what is written from the tables is read back and held against the same SQL as the tables; and settings in files."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from ..plans import metadata as md
from ..plans import planner
from ..plans.sql_text import create_table
from ..reports import plan_report, sinks
from ..sources import readers, scorecards
from ..sources.model_text import parse_text
from .assembly import _ROWS, WIDE, metadata
from .common import FEATURES, SAMPLE_SQL, query, rounded, sample, table
from .modelling import MODEL


def here() -> Path:
    """A folder of the driver's own, for files that only the driver reads; it goes at exit."""
    path = Path(tempfile.mkdtemp(prefix="riskspark-files-"))
    atexit.register(shutil.rmtree, path, True)
    return path


def _values(rows: list[tuple], names: str) -> str:
    text = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) v({names})"


NATION = "SELECT CAST(n_nationkey AS BIGINT) AS \"key\", n_name AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation"


def _nation(spark, sf_dir, sep):
    """The table as CSV with a header in capitals, in the shared folder, and its path."""
    path = f"{planner.Cuts(spark).root}/nation"
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("KEY"), F.col("n_name").alias(" Name "), F.col("n_regionkey").alias("REGION")).coalesce(1).write.option("header", True).option("sep", sep).csv(path)
    return path


@query("csv_scan", NATION)
def csv_scan(spark, sf_dir):
    return readers.read_csv(spark, _nation(spark, sf_dir, ";"), ";", "KEY long, Name string, REGION long")


@query("csv_sniffed", NATION)
def csv_sniffed(spark, sf_dir):
    got = readers.read_sample(spark, _nation(spark, sf_dir, "\t"))
    return got.select(F.col("key").cast("long").alias("key"), "name", F.col("region").cast("long").alias("region"))


@query("xlsx_round_trip", "SELECT CAST(c_nationkey AS BIGINT) AS nation, CAST(count(*) AS DOUBLE) AS customers, round(avg(c_acctbal), 4) AS balance_rate FROM customer GROUP BY 1")
def xlsx_round_trip(spark, sf_dir):
    """An aggregate in a workbook, read back: title, header, rows."""
    x = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").cast("double").alias("customers"), F.round(F.avg("c_acctbal"), 4).alias("balance_rate"))
    path = str(here() / "x.xlsx")
    sinks.write_xlsx(path, {"客户": {"by nation": x}})
    rows = [r for r in readers.xlsx_rows(path, "客户") if r]
    assert rows[0] == ["by nation"]
    got = spark.createDataFrame(rows[2:], ", ".join(f"{c} double" for c in rows[1]))
    return rounded(got.withColumn("nation", F.col("nation").cast("long")), 4)


@query("xlsx_scan", "SELECT r_name AS name, CAST(r_regionkey AS DOUBLE) AS \"key\" FROM region")
def xlsx_scan(spark, sf_dir):
    """A sheet that begins with its header."""
    path, rows = str(here() / "r.xlsx"), table(spark, sf_dir, "region").select("r_name", F.col("r_regionkey").cast("double")).collect()
    sinks.write_xlsx(path, {"regions": {"": (["Name", "KEY"], [list(r) for r in rows])}})
    return readers.read_sample(spark, path)


@query("csv_sink", f"WITH {SAMPLE_SQL} SELECT month, count(*) AS n, round(count(f_tax) / count(*), 6) AS coverage FROM sample GROUP BY 1")
def csv_sink(spark, sf_dir):
    x = sample(spark, sf_dir).groupBy("month").agg(F.count("*").alias("n"), F.round(F.count("f_tax") / F.count("*"), 6).alias("coverage"))
    path = f"{planner.Cuts(spark).root}/coverage"
    sinks.write_csv(x, path)
    return readers.read_csv(spark, path, ",", "month int, n long, coverage double")


@query("sql_sink", f"WITH {SAMPLE_SQL} SELECT data_flag, count(*) AS n FROM sample GROUP BY 1")
def sql_sink(spark, sf_dir):
    """A table replaced by the statements of a SQL file, run one by one."""
    name, path = f"riskspark_{uuid.uuid4().hex}", str(here() / "x.sql")
    sample(spark, sf_dir).createOrReplaceTempView("sql_sink_sample")
    sinks.save_text(path, create_table(name, "SELECT data_flag, count(*) AS n FROM sql_sink_sample GROUP BY 1"))
    for _ in range(2):
        for statement in Path(path).read_text(encoding="utf-8").split(";\n"):
            if statement.strip():
                spark.sql(statement)
    got = planner.Cuts(spark)(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return got


DICTIONARY = [(" Acctbal ", "余额", "wdyy", "t_ccr_customer"), ("spent", "支出", "ads", "ads_risk_month"), ("acctbal", "余额", "ads", "ads_risk_month"), ("last_price", "价格", "wdyy", "t_zxysblhs_orders")]
CLASSED = [("acctbal", "wdyy.t_ccr_customer", "行为变量"), ("spent", "ads.ads_risk_month", "行为变量"), ("last_price", "wdyy.t_zxysblhs_orders", "征信变量")]


def _dictionary(spark, kind: str):
    """YAML is read by the driver; a table of text by Spark, so that it goes to the shared folder."""
    heads = ("字段名", "字段含义", "库名", "表名")
    if kind == "yaml":
        path = str(here() / "d.yaml")
        text = "\n".join("- {" + ", ".join(f'"{h}": "{v.strip().lower() if h == "字段名" else v}"' for h, v in zip(heads, r, strict=True)) + f', "source": "{r[2]}.{r[3]}"' + "}" for r in DICTIONARY)
        Path(path).write_text(text, encoding="utf-8")
    else:
        path, text = f"{planner.Cuts(spark).root}/d.{kind}", "\n".join(("\t" if kind == "tsv" else ",").join(r) for r in [heads, *DICTIONARY])
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    got = readers.metadata_dict(spark, path)
    return spark.createDataFrame([(n, r["source"], r["category"]) for n, r in got.items()], "name string, source string, category string")


@query("dictionary_csv", _values(CLASSED, "name, source, category"))
def dictionary_csv(spark, sf_dir):
    return _dictionary(spark, "csv")


@query("dictionary_tsv", _values(CLASSED, "name, source, category"))
def dictionary_tsv(spark, sf_dir):
    return _dictionary(spark, "tsv")


@query("dictionary_yaml", _values(CLASSED, "name, source, category"))
def dictionary_yaml(spark, sf_dir):
    return _dictionary(spark, "yaml")


@query("metadata_round_trip", f'SELECT name, "table" FROM {_ROWS} UNION ALL SELECT name, "table" || \' (cached)\' FROM {_ROWS}')
def metadata_round_trip(spark, sf_dir):
    """Saved as YAML and read twice, the second time from the copy beside it."""
    path = str(here() / "m.yaml")
    md.save(metadata(), path)
    rows = [(v.name, v.table) for v in md.load(path).variables]
    rows += [(v.name, f"{v.table} (cached)") for v in md.load(path).variables]
    return spark.createDataFrame(rows, "name string, `table` string")


@query("config_load", _values([("blacklist", "a,b,c"), ("depth.left", "1"), ("depth.right", "9"), ("out", "risk_2024"), ("unknown", "${nothing}")], "name, value"))
def config_load(spark, sf_dir):
    """A configuration merged with a model's own, names replaced, a blacklist file joined."""
    at = here()
    (at / "c.yaml").write_text("project: {name: risk, year: 2024}\nout: '${name}_${year}'\nunknown: '${nothing}'\ndepth: {left: 1, right: 2}\nblacklist_vars: [A, b]\nblacklist_file: b.txt\n", encoding="utf-8")
    (at / "m.yaml").write_text("depth: {right: 9}\n", encoding="utf-8")
    (at / "b.txt").write_text("# names\nB\n C # third\n\n", encoding="utf-8")
    got = readers.load_config(str(at / "c.yaml"), str(at / "m.yaml"))
    rows = [("blacklist", ",".join(got["blacklist_vars"])), ("out", got["out"]), ("unknown", got["unknown"]), *((f"depth.{k}", str(v)) for k, v in got["depth"].items())]
    return spark.createDataFrame(rows, "name string, value string")


@query("diff_config", _values([("json", "x", "ods", "enum"), ("json", "y", "unknown", "numeric"), ("names", "a", "s", "numeric"), ("names", "b", "unknown", "numeric")] + [("model", f, "unknown", "numeric") for f in FEATURES], "origin, name, source, kind"))
def diff_config(spark, sf_dir):
    """Comparisons from a JSON file, a list of names and a model."""
    at = here()
    (at / "d.json").write_text(json.dumps({"primary_keys": ["K"], "score_column": "S", "variables": [{"name": "X", "data_source": "ods", "type": "enum"}, {"name": "y"}]}), encoding="utf-8")
    (at / "v.txt").write_text("A\nb # second\na\n", encoding="utf-8")
    specs = {
        "json": readers.load_diff_config(str(at / "d.json")), "names": readers.diff_from_names(readers.variable_list(str(at / "v.txt")), ["k"], "s", {"a": "s"}),
        "model": readers.diff_from_names(parse_text(MODEL).features, ["k"], "s"),
    }
    return spark.createDataFrame([(o, v.name, v.source, v.kind) for o, s in specs.items() for v in s.variables], "origin string, name string, source string, kind string")


@query("plan_sections", _values([(h,) for h in ("features", "ambiguous", "groups", "tables", "metadata", "importance", "blacklisted", "plan")], "section"))
def plan_sections(spark, sf_dir):
    """The sections of the plan's report, as its file has them."""
    plan, path = planner.plan(metadata(), [*WIDE, "acctbal"], planner.Config()), here() / "r.md"
    sinks.save_text(str(path), plan_report.markdown(plan, metadata(), [*WIDE, "acctbal"], None, parse_text(MODEL), ["spent"]))
    return spark.createDataFrame([(x[3:],) for x in path.read_text(encoding="utf-8").splitlines() if x.startswith("## ")], "section string")


@query("key_list", f'SELECT "table", min(name) IS NOT NULL AS listed FROM {_ROWS} GROUP BY 1')
def key_list(spark, sf_dir):
    return spark.createDataFrame([(r["table"], bool(r["join_key"])) for r in plan_report.keys(metadata())], "`table` string, listed boolean")


@query("stored_scorecard", f"WITH {SAMPLE_SQL}, c AS (SELECT f_quantity > 25 AS b, count(*) FILTER (bad = 0) AS good, count(*) FILTER (bad = 1) AS bad FROM sample GROUP BY 1), t AS (SELECT sum(good) AS g, sum(bad) AS d FROM c) SELECT 'f_quantity' AS feature, round(max(abs(good / g - bad / d)) , 6) AS ks FROM c, t WHERE NOT b")
def stored_scorecard(spark, sf_dir):
    """The KS of a stored binning's cumulative shares."""
    x = sample(spark, sf_dir).groupBy((F.col("f_quantity") > 25).alias("b")).agg(F.sum((F.col("bad") == 0).cast("long")).alias("good"), F.sum("bad").alias("bad")).orderBy("b").collect()
    path = str(here() / "s.json")
    scorecards.StoredScorecard({"f_quantity": [{"good": r.good, "bad": r.bad, "iv": 0.0} for r in x]}, [], []).save(path)
    card = scorecards.StoredScorecard.load(path)
    return rounded(spark.createDataFrame([(f, float(card.ks(f))) for f in card.features()], "feature string, ks double"))
