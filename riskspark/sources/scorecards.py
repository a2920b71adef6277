"""Scorecards as artefacts: a protocol for reports, and an adapter that reads our own JSON form."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from itertools import zip_longest
from pathlib import Path
from typing import Protocol, runtime_checkable

from ..operators.scorecard import Points


@runtime_checkable
class ScorecardProtocol(Protocol):
    """What a report asks of a scorecard."""

    def features(self) -> list[str]: ...
    def woe_table(self, feature: str) -> list[dict]: ...
    def iv(self, feature: str) -> float: ...
    def ks(self, feature: str) -> float: ...
    def model_summary(self) -> list[dict]: ...
    def points(self) -> list[Points]: ...
    def bins(self, feature: str) -> list[tuple[float | None, float | None]]: ...
    def wald_order(self) -> list[str]: ...
    def has_model(self) -> bool: ...


@dataclass
class StoredScorecard:
    """A scorecard of plain values; a binner alone has no summary and no points."""

    tables: dict[str, list[dict]]
    summary: list[dict]
    rows: list[Points]
    #: Information values that were stored beside the tables; of others, the sum over the bins.
    ivs: dict[str, float] = field(default_factory=dict)

    def features(self) -> list[str]:
        return list(self.tables)

    def woe_table(self, feature: str) -> list[dict]:
        return self.tables[feature]

    def iv(self, feature: str) -> float:
        return self.ivs[feature] if feature in self.ivs else sum(r["iv"] for r in self.tables[feature])

    def ks(self, feature: str) -> float:
        """The largest gap of cumulative shares over the bins in order."""
        rows = self.tables[feature]
        goods, bads = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
        best = g = b = 0.0
        for r in rows:
            g, b = g + r["good"] / max(goods, 1), b + r["bad"] / max(bads, 1)
            best = max(best, abs(g - b))
        return best

    def model_summary(self) -> list[dict]:
        return self.summary

    def points(self) -> list[Points]:
        return self.rows

    def bins(self, feature: str) -> list[tuple[float | None, float | None]]:
        return [(r.get("low"), r.get("high")) for r in self.tables[feature]]

    def wald_order(self) -> list[str]:
        return [r["parameter"] for r in sorted(self.summary, key=lambda r: -r["chi2"]) if r["parameter"] != "intercept"]

    def has_model(self) -> bool:
        return bool(self.summary)

    def save(self, path: str) -> None:
        data = {"tables": self.tables, "summary": self.summary, "points": [vars(p) for p in self.rows], "ivs": self.ivs}
        Path(path).write_text(json.dumps(data, ensure_ascii=False), encoding="utf-8")

    @classmethod
    def load(cls, path: str) -> StoredScorecard:
        if Path(path).suffix.lower() != ".json":
            raise ValueError(f"{path}: only JSON scorecards are read; pickles run code when they are loaded")
        data = json.loads(Path(path).read_text(encoding="utf-8"))
        return cls(data["tables"], data.get("summary", []), [Points(**p) for p in data.get("points", [])], data.get("ivs", {}))

    @classmethod
    def from_object(cls, card) -> StoredScorecard:
        """From a scorecard, or a binner alone, that is in memory: its owner loads it where its file is trusted, and save()s this.

        A binner has `woetables` (frames of a row a bin) and `bins` (intervals) by feature, a scorecard has a `binner`, the rows of
        show_model_result() and the points in `score_card_result`.
        """
        binner = getattr(card, "binner", card)
        if not hasattr(binner, "woetables") or not hasattr(binner, "bins"):
            raise ValueError("neither a Scorecard nor a Binner: no woetables and bins")
        tables = {}
        for name in list(getattr(binner, "varlist", None) or binner.woetables):
            frame = binner.woetables.get(name)
            rows = [{str(k).lower(): v for k, v in r.items()} for r in frame.to_dict("records")] if frame is not None else []
            tables[name] = [
                {
                    "low": _edge(interval, "left"), "high": _edge(interval, "right"), "good": float(r.get("good", 0)), "bad": float(r.get("bad", 0)),
                    "woe": float(r.get("woe", 0)), "iv": float(r.get("iv", 0)),
                }
                for r, interval in zip_longest(rows, list(binner.bins.get(name, [])), fillvalue={})
            ]
        ivs = getattr(binner, "ivtable", None)
        shown = card.show_model_result() if hasattr(card, "show_model_result") else None
        summary = []
        for r in shown.to_dict("records") if shown is not None else []:
            own = {SUMMARY[k]: v for k, v in r.items() if k in SUMMARY}
            summary.append({k: v if isinstance(v, str) else float(v) for k, v in own.items()})
        points = getattr(card, "score_card_result", None)
        listed = [] if points is None or not len(points) else points.reset_index().to_dict("records")
        return cls(
            tables, summary, [Points(str(r["name"]), _edge(r, "left"), _edge(r, "right"), float(r["score"])) for r in listed],
            {str(k): float(v) for k, v in ivs.items()} if ivs is not None else {},
        )


#: Columns of a model's summary and their names here.
SUMMARY = {
    "Parameter": "parameter", "Estimate": "estimate", "Std-Error": "error", "Wald-Chi2": "chi2", "P-value-num": "p", "Std": "std", "Std-Estimate": "std_estimate", "VIF": "vif",
}


def _edge(interval, side: str) -> float | None:
    """An end of an interval object or of a row; None where there is none."""
    value = interval.get(side) if isinstance(interval, dict) else getattr(interval, side, None)
    return None if value is None or value != value else float(value)
