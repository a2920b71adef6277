"""Quality rules: a threshold table compiled into one Spark projection (and into SQL), without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import SPACE_CHARS

#: Frequent function words of English, French, German and Spanish (ASCII ones), in alphabetical order.
STOP_WORDS = (
    "a al and are as at au aux avec be but by con da das de del dem den der des die du ein eine el elle en er es est et "
    "for from had has have he her his ich ihr il in is ist it je la las le les lo los mit nicht no nous of on or ou par "
    "para pas pero por pour que qui sa se sich sie sind son sont su sur that the their they this to un und una une von "
    "was we were with you zu"
).split()


@dataclass(frozen=True)
class Rule:
    """low % <= 100 * part / whole <= high %; whole None: part itself, in units, is held against low and high."""

    name: str
    part: str
    whole: str | None
    low: int | None = None
    high: int | None = None

    def sql(self) -> str:
        """A condition of integer arithmetic only, alike in Spark and in other SQL engines."""
        part, scale = (f"100 * {self.part}", f" * {self.whole}") if self.whole else (self.part, "")
        tests = [f"{part} >= {self.low}{scale}"] if self.low is not None else []
        tests += [f"{part} <= {self.high}{scale}"] if self.high is not None else []
        return "(" + " AND ".join(tests) + ")"


#: The production thresholds.
RULES = (
    Rule("length", "n_words", None, 50, 200_000),
    Rule("mean_word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("stop_words", "n_stop", None, 2, None),
    Rule("letter_words", "n_letter_words", "n_words", 50, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 40),
)

BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


def verdict_sql(rules=RULES) -> str:
    return " AND ".join(r.sql() for r in rules)


def stop_list() -> str:
    return ", ".join(f"'{w}'" for x in STOP_WORDS for w in dict.fromkeys((x, x.capitalize())))


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep plus the counts that the rules use, one row for each input row.

    Null and empty texts have zero words, lines and characters; repeated rows and ids are measured each on
    its own; other columns, whatever their names, are not read. Three-word windows meet by a 64-bit hash and are compared by their words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    own = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    ids = [f"_k{i}" for i in range(len(keep))]
    x = docs.select(*own, t.alias("t"), F.btrim(t, F.lit(SPACE_CHARS)).alias("core"))
    x = x.select(
        *ids, "t", F.expr(r"CASE WHEN core = '' THEN CAST(array() AS ARRAY<STRING>) ELSE split(core, '[\\x20\\x09-\\x0D]+') END AS w"),
        F.expr(r"filter(split(t, '\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]') AS lines"),
    )
    x = x.select(
        *ids, "lines", "w", F.expr("CAST(size(w) AS BIGINT) AS n_words"),
        F.length(F.translate("t", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        F.expr("CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols"),
        F.expr(
            """sort_array(transform(
                 slice(zip_with(zip_with(w, slice(w, 2, size(w)), (a, b) -> struct(a AS a, b AS b)),
                                slice(w, 3, size(w)), (p, c) -> xxhash64(p.a, p.b, c)), 1, greatest(size(w) - 2, 0)),
                 (h, i) -> struct(h AS h, i AS i))) AS g"""
        ),
    )
    x = x.withColumn("same", F.expr("zip_with(g, slice(g, 2, size(g)), (x, y) -> coalesce(x.h = y.h AND get(w, x.i) = get(w, y.i) AND get(w, x.i + 1) = get(w, y.i + 1) AND get(w, x.i + 2) = get(w, y.i + 2), false))"))
    x = x.withColumn(
        "at",
        F.expr(
            """sort_array(filter(zip_with(zip_with(g, same, (x, s) -> struct(x.i AS i, s AS s)),
                 slice(concat(array(false), same), 1, size(g)), (x, p) -> IF(x.s OR p, x.i, NULL)), i -> i IS NOT NULL))"""
        ),
    )
    return x.select(
        *(F.col(k).alias(c) for k, c in zip(ids, keep, strict=True)), "n_words", "word_chars", "n_symbols",
        F.expr("CAST(size(lines) AS BIGINT) AS n_lines"),
        F.expr("CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines"),
        F.expr(
            """aggregate(at, struct(0L AS e, 0L AS n),
                 (s, i) -> struct(i + 3L AS e, s.n + i + 3L - greatest(CAST(i AS BIGINT), s.e) AS n), s -> s.n) AS n_repeat_words"""
        ),
        F.expr(f"CAST(size(filter(w, x -> x IN ({stop_list()}))) AS BIGINT) AS n_stop"),
        F.expr("CAST(size(filter(w, x -> x RLIKE '[A-Za-z\\u00C0-\\u024F]')) AS BIGINT) AS n_letter_words"),
        F.expr(r"CAST(size(filter(lines, l -> l RLIKE '^[\\x20\\x09]*[-*\\u2022]')) AS BIGINT) AS n_bullet_lines"),
        F.expr(r"CAST(size(filter(lines, l -> l RLIKE '(\\.\\.\\.|\\u2026)[\\x20\\x09]*$')) AS BIGINT) AS n_ellipsis_lines"),
    )


def apply_rules(docs: DataFrame, rules=RULES, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The measures plus base_failed, one boolean for each rule (rule_<name>) and kept: all rules hold and the base does not fail."""
    x = measure(docs, text, keep)
    return x.select(
        "*", F.expr(f"{BASE_FAILED} AS base_failed"), *(F.expr(f"{r.sql()} AS rule_{r.name}") for r in rules),
        F.expr(f"(NOT {BASE_FAILED} AND {verdict_sql(rules)}) AS kept"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def oracle() -> str:
    """The same for DuckDB over the view documents: windows by their words, not by hash."""
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3))),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n >= 2) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{space}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: x IN ({stop_list()}))) AS BIGINT) AS n_stop,
    CAST(len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{{00C0}}-\x{{024F}}]'))) AS BIGINT) AS n_letter_words,
    CAST(len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09]*[-*\x{{2022}}]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|\x{{2026}})[\x20\x09]*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
  (NOT {BASE_FAILED} AND {verdict_sql()}) AS kept FROM m
"""
