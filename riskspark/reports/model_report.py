"""The model report: three sheets of sections over a scored sample, and the checks of its input."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import missing, month_key
from ..operators import curves, performance, quality, stability, woe
from ..sources.scorecards import ScorecardProtocol
from . import sinks


@dataclass
class ReportConfig:
    """Roles of columns; every other numeric column that is not excluded is a feature."""

    target: str = "mob6_30"
    date: str = "loan_date"
    flag: str = "data_flag"
    key: str = "cert_no"
    part: str = "part_id"
    scores: tuple[str, ...] = ("pred_score", "score")
    card_scores: tuple[str, ...] = ("scorecard_score", "score")
    amount: str = ""
    exclude: tuple[str, ...] = ()
    top: int = 10

    def roles(self) -> set[str]:
        return {self.target, self.date, self.flag, self.key, self.part, *self.scores, *self.card_scores, self.amount, *self.exclude} - {""}

    def features(self, df: DataFrame) -> list[str]:
        return [f.name for f in df.schema.fields if f.name not in self.roles() and isinstance(f.dataType, NumericType)]

    def score(self, df: DataFrame, preferred: tuple[str, ...] | None = None) -> str:
        found = next((c for c in preferred or self.scores if c in df.columns), None)
        if found is None:
            raise ValueError(f"none of the score columns {preferred or self.scores}")
        return found


def check_input(df: DataFrame, config: ReportConfig) -> None:
    """All roles are there, the target holds 0 and 1 only, and there are train rows; one pass."""
    absent = [c for c in (config.target, config.date, config.flag) if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the input: {absent}")
    r = df.agg(F.sum((~F.col(config.target).isin(0, 1)).cast("long")).alias("odd"), F.sum((F.col(config.flag) == "train").cast("long")).alias("train")).first()
    if r.odd:
        raise ValueError(f"{config.target} must be 0 or 1")
    if not r.train:
        raise ValueError("no train rows")
    config.score(df)


@dataclass
class ReportGenerator:
    config: ReportConfig = field(default_factory=ReportConfig)
    scorecard: ScorecardProtocol | None = None
    dictionary: DataFrame | None = None

    def generate(self, df: DataFrame) -> dict[str, dict[str, object]]:
        """sheet: section: frame. Frames are lazy until a sink collects them."""
        check_input(df, self.config)
        x = df.withColumn("_month", month_key(F.col(self.config.date), dict(df.dtypes)[self.config.date]))
        return {"model design": self._design(x), "model performance": self._performance(x), "variable analysis": self._variables(x)}

    def to_excel(self, df: DataFrame, path: str) -> None:
        sinks.write_xlsx(path, self.generate(df))

    def to_markdown(self, df: DataFrame) -> str:
        return "\n".join(sinks.markdown(sheet, sections) for sheet, sections in self.generate(df).items())

    def _design(self, x: DataFrame) -> dict[str, object]:
        c = self.config
        by = x.groupBy(c.flag).agg(F.count("*").alias("total"), F.sum(F.col(c.target).cast("long")).alias("bad"))
        by = by.unionByName(by.agg(F.lit("total").alias(c.flag), F.sum("total").alias("total"), F.sum("bad").alias("bad")))
        summary = by.select(c.flag, "total", (F.col("total") - F.col("bad")).alias("good"), "bad", (F.col("bad") / F.col("total")).alias("bad_rate"))
        n = x.where("_month IS NOT NULL").groupBy("_month", c.flag).agg(F.count("*").alias("total"), F.sum(F.col(c.target).cast("long")).alias("bad"))
        first = Window.partitionBy("_month").orderBy(F.desc("total"), c.flag)
        months = n.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r").withColumn("bad_rate", F.col("bad") / F.col("total")).orderBy("_month")
        effect = curves.auc_ks(curves.tallies(x, [c.flag], c.score(x), c.target), [c.flag])
        ranges = x.groupBy(c.flag).agg(F.concat_ws("-", F.min("_month").cast("string"), F.max("_month").cast("string")).alias("range"))
        return {"samples": summary, "months": months, "ranges": ranges, "effect": effect}

    def _performance(self, x: DataFrame) -> dict[str, object]:
        c = self.config
        score = c.score(x, c.card_scores) if any(s in x.columns for s in c.card_scores) else c.score(x)
        flag = F.col(c.flag)
        amount = c.amount or None
        deciles = performance.bin_metrics(x, score, c.target, 10, [c.flag], 20, flag == "train").orderBy(c.flag, "bin")
        monthly = curves.group_metrics(x, "_month", score, c.target, amount).orderBy("_month")
        return {
            "sample effect": performance.set_effects(x, c.flag, score, c.target, flag == "train", flag == "oot", amount).orderBy(c.flag),
            "backtest": monthly, "lift": performance.monthly_lift(x.where("_month IS NOT NULL"), "_month", score, c.target).orderBy("_month"),
            "bins": deciles, "bins by month": performance.bin_metrics(x.where("_month IS NOT NULL"), score, c.target, 10, ["_month"], 20).orderBy("_month", "bin"),
        }

    def _variables(self, x: DataFrame) -> dict[str, object]:
        c = self.config
        names = self.scorecard.features() if self.scorecard else c.features(x)
        names = [n for n in names if n in x.columns]
        if not names:
            return {"overview": None}
        train = x.where(F.col(c.flag) == "train")
        over = quality.missing_summary(train, names).select("feature", "missing_rate")
        over = over.join(woe.information_value(train, names, c.target), "feature").join(woe.two_sample_ks(train, names, c.target).select("feature", "ks"), "feature")
        over = over.join(stability.variable_psi(x, names, F.col(c.flag) == "train", F.col(c.flag) == "oot"), "feature")
        if self.dictionary is not None:
            from ..sources.readers import lookup_source

            over = lookup_source(over, self.dictionary, "feature")
        order = self.scorecard.wald_order() if self.scorecard else []
        if order:
            place = F.create_map(*(y for i, n in enumerate(order) for y in (F.lit(n), F.lit(i))))
            over = over.orderBy(F.coalesce(F.try_element_at(place, F.col("feature")), F.lit(9999)), F.desc("iv"), "feature")
        else:
            over = over.orderBy(F.desc("iv"), "feature")
        # a row a feature: collected once, and shown and ranked from that
        kinds, rows = over.schema, over.limit(sinks.MOST_ROWS).collect()
        over = x.sparkSession.createDataFrame(rows, kinds).coalesce(1)
        top = [r["feature"] for r in rows[: c.top]]
        table = woe.monotonic_table(train, top, c.target).orderBy("feature", "place")
        points = [vars(p) for p in self.scorecard.points()] if self.scorecard and self.scorecard.has_model() else None
        return {"overview": over, "thresholds": THRESHOLDS, "woe": table, "scorecard": points}


#: Reference thresholds of the variable sheet.
THRESHOLDS = [
    {"metric": "missing_rate", "keep": "<= 0.95"},
    {"metric": "iv", "keep": ">= 0.02"},
    {"metric": "psi", "keep": "<= 0.25"},
    {"metric": "ks", "keep": ">= 0.03"},
]


def missing_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(missing(F.col(column), dict(df.dtypes)[column]).cast("double")).alias("missing_rate"))
