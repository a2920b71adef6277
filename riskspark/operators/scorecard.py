"""Scorecards: a weighted logistic model on WOE columns, its diagnostics, stepwise selection, and points.

Every fit, test and matrix is sums over the rows: one aggregate of a few numbers for each Newton step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERCEPT = "intercept"


def chi2_tail(x: float) -> float:
    """The chance that a chi-square value of one degree of freedom exceeds x."""
    return math.erfc(math.sqrt(max(x, 0.0) / 2))


def _sums(df: DataFrame, items: dict[str, Column]) -> dict[str, float]:
    r = df.agg(*(F.sum(c).alias(n) for n, c in items.items())).first()
    return {n: float(r[n] or 0.0) for n in items}


def _triangle(names: list[Column], weight: Column) -> dict[str, Column]:
    return {f"h_{i}_{j}": weight * names[i] * names[j] for i in range(len(names)) for j in range(i, len(names))}


def _square(sums: dict[str, float], n: int) -> np.ndarray:
    out = np.zeros((n, n))
    for i in range(n):
        for j in range(i, n):
            out[i, j] = out[j, i] = sums[f"h_{i}_{j}"]
    return out


@dataclass
class Fit:
    names: list[str]
    estimates: np.ndarray
    covariance: np.ndarray
    log_likelihood: float
    iterations: int

    def linear(self) -> Column:
        out = F.lit(0.0)
        for n, b in zip(self.names, self.estimates.tolist(), strict=True):
            out = out + F.lit(b) * _term(n)
        return out


def _term(name: str) -> Column:
    return F.lit(1.0) if name == INTERCEPT else F.col(name).cast("double")


def fit(df: DataFrame, target: str, variables: list[str], weight: str | None = None, steps: int = 25, close: float = 1e-10) -> Fit:
    """Newton's method; variables may name the intercept. Rows with a null variable do not count."""
    names = list(variables)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(target).isin(0, 1)).dropna(subset=[n for n in names if n != INTERCEPT] or [target])
    beta, terms = np.zeros(len(names)), [_term(n) for n in names]
    before, ll, cov, done = None, 0.0, np.zeros((len(names),) * 2), 0
    for done in range(1, steps + 1):
        eta = F.lit(0.0)
        for t, b in zip(terms, beta.tolist(), strict=True):
            eta = eta + F.lit(b) * t
        p = 1 / (1 + F.exp(-eta))
        y = F.col(target).cast("double")
        # log(1 + e^x) without overflow
        loss = F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta))) - y * eta
        s = _sums(rows, {**{f"g_{i}": w * (y - p) * t for i, t in enumerate(terms)}, **_triangle(terms, w * p * (1 - p)), "loss": w * loss})
        hessian = _square(s, len(names))
        cov = np.linalg.pinv(hessian)
        ll = -s["loss"]
        if before is not None and abs(ll - before) <= close * (abs(before) + 1):
            break
        before = ll
        beta = beta + cov @ np.array([s[f"g_{i}"] for i in range(len(names))])
    return Fit(names, beta, cov, ll, done)


def correlations(df: DataFrame, names: list[str]) -> np.ndarray:
    """Pearson correlations of complete rows, from one aggregate; constant columns correlate with nothing."""
    terms = [_term(n) for n in names]
    rows = df.dropna(subset=[n for n in names if n != INTERCEPT]) if any(n != INTERCEPT for n in names) else df
    s = _sums(rows, {"n": F.lit(1.0), **{f"s_{i}": t for i, t in enumerate(terms)}, **_triangle(terms, F.lit(1.0))})
    n = max(s["n"], 1.0)
    mean = np.array([s[f"s_{i}"] for i in range(len(names))]) / n
    cov = _square(s, len(names)) / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.where(np.outer(sd, sd) > 1e-12, cov / np.outer(sd, sd), 0.0)
    np.fill_diagonal(out, 1.0)
    return out


def vif(df: DataFrame, names: list[str]) -> dict[str, float]:
    """Variance inflation of each column regressed on the others without a constant of its own: diagonal of gram times inverse gram."""
    terms = [_term(n) for n in names]
    gram = _square(_sums(df, _triangle(terms, F.lit(1.0))), len(names))
    return dict(zip(names, (np.diag(gram) * np.diag(np.linalg.pinv(gram))).tolist(), strict=True))


@dataclass(frozen=True)
class WaldRow:
    parameter: str
    estimate: float
    error: float
    chi2: float
    p: float
    std: float
    std_estimate: float
    vif: float | None


def wald(df: DataFrame, model: Fit) -> list[WaldRow]:
    """Estimates with errors, tests, standardised estimates (by pi / sqrt 3) and inflation; largest test first."""
    own = [n for n in model.names if n != INTERCEPT]
    r = df.agg(*(F.stddev_samp(n).alias(n) for n in own)).first() if own else {}
    inflation = vif(df, model.names) if len(model.names) > 1 else {}
    out = []
    for i, n in enumerate(model.names):
        b, e = float(model.estimates[i]), math.sqrt(max(model.covariance[i, i], 0.0))
        chi2 = (b / e) ** 2 if e else 0.0
        sd = float(r[n] or 0.0) if n != INTERCEPT else 0.0
        out.append(WaldRow(n, b, e, chi2, chi2_tail(chi2), sd, b * sd / (math.pi / math.sqrt(3)), inflation.get(n)))
    return sorted(out, key=lambda x: -x.chi2)


def score_tests(df: DataFrame, target: str, model: Fit, candidates: list[str], weight: str | None = None) -> dict[str, tuple[float, float]]:
    """(chi2, p) of adding each candidate to the model, all from one aggregate."""
    if not candidates:
        return {}
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    p = 1 / (1 + F.exp(-model.linear()))
    y, v = F.col(target).cast("double"), w * p * (1 - p)
    terms = [_term(n) for n in model.names]
    items = dict(_triangle(terms, v))
    for k, c in enumerate(candidates):
        z = _term(c)
        items |= {f"u_{k}": w * (y - p) * z, f"z_{k}": v * z * z} | {f"x_{k}_{i}": v * z * t for i, t in enumerate(terms)}
    s = _sums(df.where(F.col(target).isin(0, 1)), items)
    inverse = np.linalg.pinv(_square(s, len(terms)))
    out = {}
    for k, c in enumerate(candidates):
        cross = np.array([s[f"x_{k}_{i}"] for i in range(len(terms))])
        spread = s[f"z_{k}"] - cross @ inverse @ cross
        chi2 = s[f"u_{k}"] ** 2 / spread if spread > 1e-12 else 0.0
        out[c] = (chi2, chi2_tail(chi2))
    return out


@dataclass
class Stepwise:
    """Forward by the largest score test, refused on correlation, sign or inflation, backward on the p-value."""

    p_most: float = 1e-2
    corr_most: float = 0.7
    vif_most: float = 4.0
    steps: int = 100
    absolute: bool = False
    dropped: list[str] = field(default_factory=list)

    def run(self, df: DataFrame, target: str, variables: list[str], weight: str | None = None) -> Fit:
        """Variables are WOE of good over bad, so that every estimate, the intercept's too, must be negative."""
        model = fit(df, target, [INTERCEPT], weight)
        for _ in range(self.steps):
            tests = score_tests(df, target, model, [v for v in variables if v not in model.names and v not in self.dropped], weight)
            grown = None
            for name, _ in sorted(tests.items(), key=lambda x: -x[1][0]):
                grown = self._try(df, target, [*model.names, name], weight)
                if grown is not None:
                    break
                self.dropped.append(name)
            if grown is None:
                break
            model = grown
        return model

    def _try(self, df: DataFrame, target: str, names: list[str], weight: str | None) -> Fit | None:
        corr = correlations(df, names) - np.eye(len(names))
        if (np.abs(corr) if self.absolute else corr).max() > self.corr_most:
            return None
        model = fit(df, target, names, weight)
        if (model.estimates >= 0).any() or max(vif(df, names).values()) > self.vif_most:
            return None
        while len(model.names) > 1:
            rows = wald(df, model)
            worst = max(rows, key=lambda r: r.p)
            if worst.p <= self.p_most:
                break
            self.dropped.append(worst.parameter)
            model = fit(df, target, [n for n in model.names if n != worst.parameter], weight)
        return model


@dataclass(frozen=True)
class Points:
    name: str
    left: float | None
    right: float | None
    score: float


def points(
    model: Fit, tables: dict[str, list[tuple[float | None, float | None, float]]], base: float = 600, odds: float = 20, step: float = 50,
    missing: dict[str, float] | None = None,
) -> list[Points]:
    """Points of each bin, (left, right, woe), of the model's variables, and of the intercept.

    A variable's lowest bin is moved to 0 points and the difference goes to the intercept; a bin that holds the
    variable's missing value is repeated, before it, as the row for missing values. The lowest edge is open.
    """
    factor = step / math.log(2)
    estimate = dict(zip(model.names, model.estimates.tolist(), strict=True))
    whole = base - factor * math.log(odds) - estimate.get(INTERCEPT, 0.0) * factor
    out = []
    for name in model.names:
        if name == INTERCEPT:
            continue
        raw = [-woe * factor * estimate[name] for _, _, woe in tables[name]]
        least = min(raw)
        whole += least
        edges = [left for left, _, _ in tables[name] if left is not None]
        for (left, right, _), value in zip(tables[name], raw, strict=True):
            gone = (missing or {}).get(name)
            if gone is not None and left is not None and left < gone <= right:
                out.append(Points(name, None, None, float(round(value - least))))
            low = -math.inf if edges and left == min(edges) else left
            out.append(Points(name, low, right, float(round(value - least))))
    return [*out, Points(INTERCEPT, None, None, float(round(whole)))]


def readable(rows: list[Points]) -> str:
    """The card as text, one line for each bin."""
    show = lambda r: "missing" if r.left is None and r.right is None else f"({r.left}, {r.right}]"
    return "\n".join(f"{r.name} {'' if r.name == INTERCEPT else show(r) + ' '}{r.score:g}" for r in rows)


def apply_points(df: DataFrame, rows: list[Points], out: str = "scorecard_score") -> DataFrame:
    """df with the sum of its rows' points; a value in no bin has none."""
    total = F.lit(0.0)
    names = dict.fromkeys(r.name for r in rows)
    for name in names:
        own = [r for r in rows if r.name == name]
        if name == INTERCEPT:
            total = total + F.lit(own[0].score)
            continue
        x, value = F.col(name).cast("double"), None
        for r in own:
            test = (x.isNull() | F.isnan(x)) if r.left is None else (x > r.left) & (x <= r.right)
            value = F.when(test, r.score) if value is None else value.when(test, r.score)
        total = total + F.coalesce(value.otherwise(0.0), F.lit(0.0))
    return df.withColumn(out, total)


def woe_column(column: str, interior: list[float], values: list[float]) -> Column:
    """The WOE of the (a, b] bin of a value: values has one more item than interior; null for null."""
    from .binning import right_closed

    listed = "array(" + ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in values) + ")"
    return F.get(F.expr(listed), right_closed(column, interior))


def split(df: DataFrame, target: str, month: str, oot_from: int, share: float = 0.8, seed: int = 2025, key: str | None = None) -> DataFrame:
    """df with data_flag: oot from a month on, else train or test, drawn at `share` within each class by an MD5 of seed, target and key.

    Without a key the whole row is hashed, so that rows of one key may fall on either side.
    """
    source = F.col(key).cast("string") if key else F.xxhash64(*df.columns).cast("string")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(target).cast("string"), source))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1_000_000 / 1_000_000
    return df.withColumn("data_flag", F.when(F.col(month) >= oot_from, "oot").when(draw < share, "train").otherwise("test"))
