"""Secret scans: three base patterns plus spans of high windowed entropy; DataFrame functions only.

Positions are code points, ends exclusive. Base kinds are matched leftmost and non-overlapping, then held against
their least lengths. The method adds spans: in runs of one character class, a window slides over the run and the
counts of its characters are updated by the one that enters and the one that leaves; sum(c * log2 c) is carried
along as an integer, so the window's Shannon entropy, log2(W) - sum / W, is known at each step without a recount.
Windows at or above the class's threshold are merged into spans; runs on the allow list add none, nor do spans within a base span.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import packed, unpacked

#: The base patterns, and the least length of what is named.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8


@dataclass(frozen=True)
class CharClass:
    """Runs of `chars` of at least `window` characters that hold all of `needs`; windows of at least `bits` of entropy are spans."""

    name: str
    chars: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()

    def members(self) -> frozenset[str]:
        return frozenset(chr(x) for x in range(33, 127) if re.match(f"[{self.chars}]", chr(x)))

    def most(self) -> int:
        """The largest integer sum of c * log2 c that a window may have."""
        return math.floor(SCALE * self.window * (math.log2(self.window) - self.bits))


SCALE = 1_000_000
#: Digits and letters of one case need three groups of digits at least, as words written together have as much entropy as tokens.
CLASSES = (
    CharClass("hex_entropy", "0-9A-Fa-f", 24, 3.0, ("[0-9]", "[A-Fa-f]")),
    CharClass("base64_entropy", "A-Za-z0-9+/_=-", 24, 4.0, ("[0-9]", "[a-z]", "[A-Z]")),
    CharClass("lower_entropy", "0-9a-z", 24, 3.6, ("[0-9][a-z]+[0-9]+[a-z]+[0-9]", "[g-z]")),
    CharClass("upper_entropy", "0-9A-Z", 24, 3.6, ("[0-9][A-Z]+[0-9]+[A-Z]+[0-9]", "[G-Z]")),
)

#: Runs that hold one of these are no secrets.
ALLOW = (
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^sha(1|256|384|512)-",
    r"(?i)example",
    r"(?i)placeholder",
    r"(?i)changeme",
    r"(?i)your[_-]?(api)?[_-]?(key|token|secret)",
    r"(?i)x{8}",
    r"0123456789",
    r"(?i)abcdefghij",
    r"(.)\1{7}",
)

SPAN = "STRUCT<s: BIGINT, e: BIGINT, x: STRING>"
TAGGED = "STRUCT<s: BIGINT, k: INT, e: BIGINT, kind: STRING>"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Elements, or characters of a run, that are handled as one block, so that no result is copied once for each of its elements.
BLOCK = 1024


def _blocked(array: str, zero: str, step, out, kind: str) -> str:
    """Running state along an array, in time proportional to its length: step(state, z) and out(state before z, z) are SQL.

    Results are appended within blocks only; each block starts from the state that the blocks before it leave behind.
    """
    blocks, part = f"sequence(0, CAST((size({array}) - 1) DIV {BLOCK} AS INT))", lambda k: f"slice({array}, {k} * {BLOCK} + 1, {BLOCK})"
    ahead = f"""aggregate({blocks}, struct(array({zero}) AS c), (w, k) -> struct(concat(w.c, array(
      aggregate({part('k')}, get(w.c, k), (c, z) -> {step('c', 'z')}))) AS c), w -> w.c)"""
    return f"""CASE WHEN size({array}) > 0 THEN flatten(get(transform(array({ahead}), s -> transform({blocks}, k -> aggregate({part('k')},
      struct(get(s, k) AS c, CAST(array() AS ARRAY<{kind}>) AS out),
      (a, z) -> struct({step('a.c', 'z')} AS c, concat(a.out, array({out('a.c', 'z')})) AS out), a -> a.out))), 0)) ELSE CAST(array() AS ARRAY<{kind}>) END"""


def _located(df: DataFrame, name: str, pattern: str, given: str = "true") -> DataFrame:
    """Add name: the spans of all leftmost non-overlapping matches of pattern in column t, from the matches and the pieces between them.

    given: a condition without which there is no match.
    """
    df = df.withColumn("_m", F.expr(f"CASE WHEN {given} THEN regexp_extract_all(t, {_text(pattern)}, 0) ELSE CAST(array() AS ARRAY<STRING>) END"))
    df = df.withColumn("_g", F.expr(f"CASE WHEN size(_m) > 0 THEN split(t, {_text(pattern)}, -1) ELSE CAST(array() AS ARRAY<STRING>) END"))
    df = df.withColumn("_z", F.expr("zip_with(slice(_g, 1, size(_m)), _m, (p, x) -> struct(CAST(length(p) AS BIGINT) AS p, CAST(length(x) AS BIGINT) AS n, x AS x))"))
    places = _blocked("_z", "0L", lambda c, z: f"{c} + {z}.p + {z}.n", lambda c, z: f"struct({c} + {z}.p AS s, {c} + {z}.p + {z}.n AS e, {z}.x AS x)", SPAN)
    return df.withColumn(name, F.expr(places)).drop("_m", "_g", "_z")


def _windows(c: CharClass) -> str:
    """A SQL expression on a span r: the merged spans of its windows of high entropy, as array of (s, e).

    A run of n characters takes time in proportion to n. Its windows are dealt out in blocks of BLOCK, and each block also reads
    the windows up to one length before and after its own, so that it knows which of its windows begin and which end a span. The counts of a window
    are bit fields of a few longs: the character that leaves and the one that enters change one field each.
    """
    w, bits = c.window, c.window.bit_length()
    fields = 62 // bits
    words, mask = -(-128 // fields), (1 << bits) - 1
    g = "array(" + ", ".join(f"{round(SCALE * n * math.log2(n)) if n else 0}L" for n in range(w + 2)) + ")"
    longs = "ARRAY<BIGINT>"
    # characters with the long and the bit that count them, of windows lo to hi
    chars = f"""transform(split(CAST(substring(CAST(r.x AS BINARY), v.lo + 1, v.hi - v.lo + {w}) AS STRING), ''), x -> struct(
        ascii(x) DIV {fields} AS w, CAST(ascii(x) % {fields} * {bits} AS INT) AS h))"""
    held = lambda n, z: f"CAST(shiftright(get({n}, CAST({z}.w AS INT)), {z}.h) & {mask}L AS INT)"
    own = lambda at: f"(v.lo + {at} >= v.f AND v.lo + {at} < v.f + {BLOCK})"
    # in and out: the character that enters, at i, and the one that leaves, null while the first window fills
    ends = f"struct(get(q, i) AS i, IF(i >= {w}, get(q, i - {w}), NULL) AS o)"
    left = f"struct(z.i AS i, z.o AS o, {held('a.n', 'z.i')} - IF(z.i = z.o, 1, 0) AS ni, {held('a.n', 'z.o')} AS no)"
    counted = """IF(y.i <=> y.o, a.n, transform(a.n, (n, j) -> n + IF(j = y.i.w, shiftleft(1L, y.i.h), 0L) - IF(j = y.o.w, shiftleft(1L, y.o.h), 0L)))"""
    total = f"a.sum + get({g}, y.ni + 1) - get({g}, y.ni) + IF(y.o IS NULL, 0L, get({g}, y.no - 1) - get({g}, y.no))"
    updated = f"get(transform(transform(array({ends}), z -> {left}), y -> struct({counted} AS n, {total} AS sum)), 0)"
    # p: the last window of high entropy so far
    at = f"(i - {w - 1})"
    far = f"(a.p < 0 OR {at} - a.p > {w})"
    high = f"""struct(u.n AS n, u.sum AS sum, {at} AS p, IF({far} AND {own(at)}, concat(a.s, array(CAST(v.lo + {at} AS BIGINT))), a.s) AS s,
        IF({far} AND a.p >= 0 AND {own('a.p')}, concat(a.e, array(CAST(v.lo + a.p + {w} AS BIGINT))), a.e) AS e)"""
    step = f"""get(transform(array({updated}), u -> IF(i < {w - 1} OR u.sum > {c.most()}L, struct(u.n AS n, u.sum AS sum, a.p AS p, a.s AS s, a.e AS e), {high})), 0)"""
    zero = f"struct(array_repeat(0L, {words}) AS n, 0L AS sum, -1 AS p, CAST(array() AS {longs}) AS s, CAST(array() AS {longs}) AS e)"
    last = f"struct(a.s AS s, IF(a.p >= 0 AND {own('a.p')}, concat(a.e, array(CAST(v.lo + a.p + {w} AS BIGINT))), a.e) AS e)"
    block = f"""get(transform(array({chars}), q -> aggregate(sequence(0, v.hi - v.lo + {w - 1}), {zero}, (a, i) -> {step}, a -> {last})), 0)"""
    many = f"(CAST(length(r.x) AS INT) - {w - 1})"
    bounds = f"""transform(sequence(0, CAST(({many} - 1) DIV {BLOCK} AS INT)), k -> struct(
        k * {BLOCK} AS f, greatest(0, k * {BLOCK} - {w}) AS lo, least({many} - 1, (k + 1) * {BLOCK} - 1 + {w}) AS hi))"""
    blocks = f"transform({bounds}, v -> {block})"
    return f"""get(transform(array({blocks}), t -> zip_with(flatten(transform(t, x -> x.s)), flatten(transform(t, x -> x.e)),
        (s, e) -> struct(r.s + s AS s, r.s + e AS e))), 0)"""


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), classes=CLASSES) -> DataFrame:
    """keep, t (the text, null as empty), base and spans: arrays of (s, k, e, kind) ordered by start, then kind as listed.

    One row for each input row; null and empty texts have no spans; other columns are not read. Text of any length
    is scanned whole, in time proportional to its length; a sort of its spans is all that grows faster.
    """
    ids = [f"_k{i}" for i in range(len(keep))]
    x = docs.select(*(F.col(c).alias(k) for c, k in zip(keep, ids, strict=True)), F.coalesce(F.col(text), F.lit("")).alias("t"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        x = _located(x, name, pattern)
    x = x.withColumn("assign", F.expr(f"filter(assign, m -> length(regexp_extract(m.x, {_text(ASSIGN)}, 2)) >= {ASSIGN_LEAST})"))
    tagged = lambda col, k, kind: f"transform({col}, m -> struct(m.s AS s, {k} AS k, m.e AS e, '{kind}' AS kind))"
    x = x.withColumn(
        "base",
        F.expr("array_sort(concat(" + ", ".join(tagged(n, k, n) for k, n in enumerate(("assign", "access", "hex"))) + "))"),
    )
    # a class whose runs all lie in those of a wider one is looked for only where the wider one has runs
    numbered = sorted(enumerate(classes, 3), key=lambda kc: -len(kc[1].members()))
    extra = []
    for at, (k, c) in enumerate(numbered):
        run = f"(?<![{c.chars}])[{c.chars}]{{{c.window},}}"
        wider = [j for j, d in numbered[:at] if c.members() <= d.members() and d.window <= c.window]
        x = _located(x, f"_a{k}", run, f"size(_a{wider[0]}) > 0" if wider else "true")
        # the flat form goes first: a lookbehind sees the text before it in split() and in extract_all() alike
        wanted = [f"m.x RLIKE {_text(n)}" for n in c.needs] + [f"NOT m.x RLIKE {_text(p)}" for p in ALLOW]
        x = x.withColumn(f"_r{k}", F.expr(f"filter(_a{k}, m -> {' AND '.join(wanted)})"))
        x = x.withColumn(f"_e{k}", F.expr(f"flatten(transform(_r{k}, r -> {_windows(c)}))"))
        extra.append(tagged(f"_e{k}", k, c.name))
    # along all spans by start, base kinds first: one that ends within a base span before it adds nothing
    x = x.withColumn("_all", F.expr(f"array_sort(concat(base, {', '.join(extra)}))"))
    further = lambda c, z: f"IF({z}.k < 3, greatest({c}, {z}.e), {c})"
    kept = _blocked("_all", "-1L", further, lambda c, z: f"IF({z}.k < 3 OR {z}.e > {c}, {z}, NULL)", TAGGED)
    return x.select(
        *(F.col(k).alias(c) for c, k in zip(keep, ids, strict=True)), F.col("t"), "base", F.expr(f"filter({kept}, m -> m IS NOT NULL) AS spans")
    )


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, m -> concat(m.kind, ':', m.s, ':', m.e)), ',')"


def digest(docs: DataFrame) -> DataFrame:
    count = lambda kind: f"CAST(size(filter(base, m -> m.kind = '{kind}')) AS BIGINT) AS n_{kind}"
    return scan(docs).selectExpr(
        "doc_id", *(count(k) for k in ("assign", "access", "hex")), f"sha2({_joined('base')}, 256) AS base_sha256", f"{_joined('spans')} AS spans"
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]", text: str = "text") -> DataFrame:
    """docs with every span, overlapping ones merged, replaced by mark in the text; n_chars, where present, follows. Null texts stay null."""
    cols = docs.columns
    x = scan(docs.select(packed(docs), F.col(text).alias("text")), "text", ("row",))
    # a cut begins at a span that starts at or after all ends before it, and ends where the next one finds the largest end
    opens = _blocked("spans", "-1L", lambda c, z: f"greatest({c}, {z}.e)", lambda c, z: f"IF({z}.s >= {c}, struct({z}.s AS s, {c} AS e), NULL)", "STRUCT<s: BIGINT, e: BIGINT>")
    x = x.withColumn("_opens", F.expr(f"filter({opens}, m -> m IS NOT NULL)"))
    x = x.withColumn("_ends", F.expr("IF(size(spans) > 0, concat(transform(slice(_opens, 2, size(_opens)), m -> m.e), array(array_max(transform(spans, m -> m.e)))), CAST(array() AS ARRAY<BIGINT>))"))
    quoted = mark.replace("\\", "\\\\").replace("'", "\\'")
    # what stays, from the text in blocks: a place in a long text is not counted out from its first character
    x = x.withColumn("_blocks", F.expr(f"IF(size(spans) > 0, regexp_extract_all(t, '(?s).{{1,{BLOCK}}}', 0), CAST(array() AS ARRAY<STRING>))"))
    held = f"array_join(slice(b, CAST(f DIV {BLOCK} AS INT) + 1, CAST(e DIV {BLOCK} - f DIV {BLOCK} AS INT) + 1), '')"
    clean = f"""CASE WHEN size(spans) = 0 THEN t ELSE get(transform(array(_blocks), b -> array_join(zip_with(concat(array(0L), _ends), concat(transform(_opens, m -> m.s), array(CAST(length(t) AS BIGINT))),
        (f, e) -> substring({held}, CAST(f % {BLOCK} + 1 AS INT), CAST(e - f AS INT))), '{quoted}')), 0) END"""
    x = x.withColumn("_clean", F.when(F.col(f"row.`{text}`").isNotNull(), F.expr(clean)))
    put = {text: F.col("_clean")}
    if "n_chars" in cols:
        put["n_chars"] = F.when(F.expr("size(spans) > 0"), F.length("_clean").cast("long")).otherwise(F.col("row.n_chars"))
    return x.select(*unpacked(cols, put))


def _alike(c: CharClass, times: int = 8) -> str:
    """A run of one character, for engines without back references."""
    return "|".join(f"[{x}]{{{times}}}" for x in sorted(c.members()))


def oracle(classes=CLASSES) -> str:
    """The digest for DuckDB over the view documents: each window's entropy from its own counts."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    base = (("assign", ASSIGN, f"length(regexp_extract(x, {quote(ASSIGN)}, 2)) >= {ASSIGN_LEAST}"), ("access", ACCESS, "TRUE"), ("hex", HEX, "TRUE"))

    def places(pattern: str) -> str:
        return f"""(SELECT r, x, e - length(x) AS s, e FROM (SELECT r, x, j, sum(length(p) + length(x)) OVER (PARTITION BY r ORDER BY j) AS e FROM (
  SELECT r, unnest(g[1:len(m)]) AS p, unnest(m) AS x, unnest(range(len(m))) AS j FROM (SELECT r, regexp_extract_all(t, {quote(pattern)}, 0) AS m, regexp_split_to_array(t, {quote(pattern)}) AS g FROM d) WHERE len(m) > 0)))"""

    parts = [f"SELECT r, {k} AS k, '{name}' AS kind, s, e FROM {places(pattern)} WHERE {test}" for k, (name, pattern, test) in enumerate(base)]
    extra = []
    for k, c in enumerate(classes, 3):
        allow = [quote(p if "\\1" not in p else _alike(c)) for p in ALLOW]
        tests = " AND ".join([f"regexp_matches(x, {quote(n)})" for n in c.needs] + [f"NOT regexp_matches(x, {p})" for p in allow])
        table = "[" + ", ".join(str(round(SCALE * n * math.log2(n)) if n else 0) for n in range(c.window + 1)) + "]"
        extra.append(f"""SELECT r, {k} AS k, '{c.name}' AS kind, min(i) AS s, max(i) + {c.window} AS e FROM (SELECT *, sum(new) OVER (PARTITION BY r, s ORDER BY i) AS island FROM (
  SELECT r, s, i, (coalesce(i - lag(i) OVER (PARTITION BY r, s ORDER BY i), {c.window + 1}) > {c.window})::INT AS new FROM (
    SELECT r, s, i FROM (SELECT r, s, i, ch, count(*) AS n FROM (SELECT r, s, s + i AS i, unnest(string_split(substr(x, i + 1, {c.window}), '')) AS ch FROM (
      SELECT r, s, x, unnest(range(0, length(x) - {c.window - 1})) AS i FROM {places(f"[{c.chars}]{{{c.window},}}")} WHERE {tests})) GROUP BY ALL) GROUP BY r, s, i HAVING sum({table}[n + 1]) <= {c.most()}))) GROUP BY r, s, island""")
    show = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k, e"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({' UNION ALL '.join(parts)}),
added AS ({' UNION ALL '.join(extra)}),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM added a WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = a.r AND b.s <= a.s AND a.e <= b.e)),
b AS (SELECT r, {', '.join(f"count(*) FILTER (kind = '{n}') AS n_{n}" for n, _, _ in base)}, string_agg({show}) AS x FROM base GROUP BY r),
s AS (SELECT r, string_agg({show}) AS x FROM spans GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{n}, 0) AS n_{n}" for n, _, _ in base)}, sha256(coalesce(b.x, '')) AS base_sha256, coalesce(s.x, '') AS spans FROM d LEFT JOIN b USING (r) LEFT JOIN s USING (r)"""
