"""Tree ensembles from the public LightGBM text format, PMML field lists, and a JSON form of our own.

Pickled models are refused: loading one runs code from the file. Which value counts as missing (zero or NaN) is not taken
over from the file: scoring fills missing values before the trees see them.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field
from pathlib import Path


@dataclass
class Node:
    """An inner node, or a leaf (feature None). A categorical node sends the categories named left."""

    value: float = 0.0
    feature: int | None = None
    threshold: float = 0.0
    gain: float = 0.0
    categorical: bool = False
    categories: tuple[int, ...] = ()
    default_left: bool = False
    left: Node | None = None
    right: Node | None = None


@dataclass
class TreeModel:
    features: list[str]
    trees: list[Node] = field(default_factory=list)
    objective: str = ""
    params: dict[str, str] = field(default_factory=dict)

    def importance(self) -> dict[str, float]:
        """Total split gain by feature, in the model's order; 0 for unused ones."""
        out = dict.fromkeys(self.features, 0.0)
        stack = list(self.trees)
        while stack:
            node = stack.pop()
            if node.feature is not None:
                out[self.features[node.feature]] += node.gain
                stack += [node.left, node.right]
        return out

    def used(self) -> set[str]:
        out, stack = set(), list(self.trees)
        while stack:
            node = stack.pop()
            if node.feature is not None:
                out.add(self.features[node.feature])
                stack += [node.left, node.right]
        return out

    def valid_features(self) -> list[str]:
        """Features of positive importance, in the model's order."""
        return [f for f, g in self.importance().items() if g > 0]

    def ranked(self) -> list[tuple[str, float]]:
        return sorted(self.importance().items(), key=lambda x: (-x[1], self.features.index(x[0])))

    def classes(self) -> int:
        """Trees of one round: more than one is a model of several classes."""
        return max(int(self.params.get(k) or 1) for k in ("num_class", "num_tree_per_iteration"))

    def steepness(self) -> float:
        """The factor of the sigmoid that turns a sum of trees into a probability; other objectives and several classes are refused."""
        kind, *options = (self.objective or "binary").split()
        if kind not in ("binary", "cross_entropy", "xentropy") or self.classes() > 1:
            raise ValueError(f"a model of objective {self.objective!r} with {self.classes()} classes does not give one probability")
        return next((float(o.partition(":")[2]) for o in options if o.startswith("sigmoid:")), 1.0)

    def dump(self) -> dict:
        def tree(node: Node) -> dict:
            if node.feature is None:
                return {"leaf_value": node.value}
            return {
                "split_feature": node.feature, "threshold": "||".join(map(str, node.categories)) if node.categorical else node.threshold, "split_gain": node.gain, "default_left": node.default_left,
                "decision_type": "==" if node.categorical else "<=", "left_child": tree(node.left), "right_child": tree(node.right),
            }

        return {"feature_names": self.features, "objective": self.objective, "num_class": self.classes(), "tree_info": [{"tree_structure": tree(t)} for t in self.trees]}

    def info(self) -> dict:
        return {"objective": self.objective, "features": len(self.features), "valid_features": len(self.valid_features()), "trees": len(self.trees)}

    def summary(self, top: int = 10) -> str:
        lines = [f"{k}: {v}" for k, v in self.info().items()] + [f"{f}: {g:.4f}" for f, g in self.ranked()[:top]]
        return "\n".join(lines)


def _tree(block: dict[str, str]) -> Node:
    def numbers(name: str, kind=float) -> list:
        return [kind(x) for x in block.get(name, "").split()]

    leaves = [Node(value=v) for v in numbers("leaf_value")]
    splits = numbers("split_feature", int)
    if not splits:
        return leaves[0] if leaves else Node()
    kinds = numbers("decision_type", int) or [0] * len(splits)
    gains = numbers("split_gain") or [0.0] * len(splits)
    bounds, sets = numbers("cat_boundaries", int), numbers("cat_threshold", int)

    def categories(k: int) -> tuple[int, ...]:
        """The set bits of the k-th bit set, 32 categories for each number."""
        if k + 1 >= len(bounds) or bounds[k + 1] > len(sets):
            raise ValueError("a categorical split without its categories")
        words = sets[bounds[k] : bounds[k + 1]]
        return tuple(32 * i + b for i, w in enumerate(words) for b in range(32) if w >> b & 1)

    # bit 0: categorical, whose threshold is the number of a bit set; bit 1: missing values go left
    nodes = [
        Node(feature=f, threshold=t, gain=g, categorical=bool(k & 1), categories=categories(int(t)) if k & 1 else (), default_left=bool(k & 2))
        for f, t, g, k in zip(splits, numbers("threshold"), gains, kinds, strict=True)
    ]
    child = lambda i: nodes[i] if i >= 0 else leaves[-i - 1]
    for node, a, b in zip(nodes, numbers("left_child", int), numbers("right_child", int), strict=True):
        node.left, node.right = child(a), child(b)
    return nodes[0]


def parse_text(text: str) -> TreeModel:
    """A model in text form: `name=value` lines, each tree after a `Tree=` line."""
    head: dict[str, str] = {}
    blocks: list[dict[str, str]] = []
    at = head
    for line in text.splitlines():
        line = line.strip()
        if line == "end of trees":
            break
        name, found, value = line.partition("=")
        if not found:
            continue
        if name == "Tree":
            at = {}
            blocks.append(at)
        else:
            at[name] = value
    if "feature_names" not in head:
        raise ValueError("no feature_names: not a model in text form")
    return TreeModel(head["feature_names"].split(), [_tree(b) for b in blocks], head.get("objective", ""), head)


def parse_json(text: str) -> TreeModel:
    """A model as dump() gives it."""
    data = json.loads(text)

    def node(x: dict) -> Node:
        if "leaf_value" in x:
            return Node(value=x["leaf_value"])
        categorical = x.get("decision_type", "<=") == "=="
        named = tuple(int(float(c)) for c in str(x["threshold"]).split("||") if c) if categorical else ()
        return Node(
            feature=x["split_feature"], threshold=0.0 if categorical else float(x["threshold"]), gain=x.get("split_gain", 0.0), categorical=categorical, categories=named,
            default_left=x.get("default_left", False), left=node(x["left_child"]), right=node(x["right_child"]),
        )

    return TreeModel(data["feature_names"], [node(t["tree_structure"]) for t in data["tree_info"]], data.get("objective", ""), {"num_class": str(data.get("num_class", 1))})


def pmml_fields(text: str) -> list[str]:
    """Active fields of a PMML document's mining schema (else of its data dictionary), in any namespace; targets are left out."""
    root = ET.fromstring(text)
    local = lambda e: e.tag.rpartition("}")[2]
    mining = [e for e in root.iter() if local(e) == "MiningField"]
    own = mining or [e for e in root.iter() if local(e) == "DataField"]
    names = [e.get("name") for e in own if e.get("usageType", "active") == "active"]
    return list(dict.fromkeys(n for n in names if n and n != "_target"))


def load_model(path: str) -> TreeModel:
    """A model file by suffix: .json, .pmml or .xml (fields only), else text; pickles are refused."""
    kind = Path(path).suffix.lower()
    if kind in (".pkl", ".pickle", ".joblib"):
        raise ValueError(f"{path}: pickled models run code when they are loaded; save the model as text instead")
    text = Path(path).read_text(encoding="utf-8")
    if kind == ".json":
        return parse_json(text)
    if kind in (".pmml", ".xml"):
        return TreeModel(pmml_fields(text))
    return parse_text(text)


def from_object(model) -> TreeModel:
    """From a trained booster, or a wrapper with a booster_, that is in memory: by its own text form. Its owner loads it where its file is trusted."""
    booster = getattr(model, "booster_", None) or model
    if not hasattr(booster, "model_to_string"):
        raise ValueError("the model has no text form: no model_to_string()")
    return parse_text(booster.model_to_string())


def features_of(path: str) -> list[str]:
    return load_model(path).features


def valid_features_of(path: str) -> list[str]:
    return load_model(path).valid_features()
