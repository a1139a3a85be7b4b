"""Personal data: candidate spans scored by boosted trees, all in Spark SQL.

1. Generators propose overlapping spans per document: four base patterns
   (email, ip, card, phone) and two loose ones (numbers with any grouping,
   anything around an ``@``).  Positions come from the lengths of matches and
   of the gaps between them.
2. Base candidates that pass their validator are spans; they always stay.
3. Every candidate gets format features (digits, grouping, neighbours) and
   context features (cue words before it).  Boosted trees learn from base
   candidates of a bounded sample of documents which cells of that feature
   space pass the validators, on counts per cell, not on rows; a second fold
   of the sample calibrates the score above which candidates are right.
4. A loose candidate over the threshold that overlaps no base span is added.

Scoring is one CASE sum per tree, so nothing leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import id_text

# The base patterns.  Java evaluates a possessive group without
# recursion; at the end of a pattern it matches what the greedy one does.  A run
# of letters or digits is tried from its start, or from where the last match
# ended, only: every start inside it meets the same end of the run, so the
# leftmost match is the same and a text costs time in proportion to its length.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]

# A loose number is at most 64 characters long: none of the kinds is longer, and
# a long run of digits is no number of a person in any of its parts.
LOOSE_NUMBER = r"(?<![0-9])[(0-9][0-9\x20()./_-]{6,62}[0-9](?![0-9])"
LOOSE_EMAIL = r"(?:\G|(?<![^\s@<>()\[\],;:]))[^\s@<>()\[\],;:]++@[^\s@<>()\[\],;:]+"
GENERATORS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE,
              "number": LOOSE_NUMBER, "around": LOOSE_EMAIL}
NEEDS = {"email": "@", "phone": "+", "around": "@"}       # a text without it has no match
CUE = r"(?i)(tel|phone|call|fax|mobile|mail|contact|card|visa|account|address|\bip\b|\bid\b)\W*\w*\W*$"
CONTEXT = 24

FIT_DOCS = 20_000           # documents of the fitting sample, at most about this many
ROUNDS, RATE, LEAST = 24, 0.3, 8.0
PRECISION = 0.95            # calibrated share of right candidates above the threshold
CHUNK = 512                 # matches summed at a time when positions are computed

FEATURES = ["digits", "at", "groups", "before", "after", "cue", "luhn", "length"]


# -- spans ------------------------------------------------------------------

def _positions(m: str, g: str) -> str:
    """SQL: starts and ends of the matches ``m`` of a text split into gaps ``g``."""
    return f"""flatten(transform(
      aggregate(
        transform(sequence(0, (size({m}) - 1) div {CHUNK}), b -> zip_with(
          slice({g}, b * {CHUNK} + 1, {CHUNK}), slice({m}, b * {CHUNK} + 1, {CHUNK}),
          (x, y) -> named_struct('gap', char_length(x), 'len', char_length(y), 'm', y, 'left', right(x, {CONTEXT})))),
        named_struct('at', 0, 'out', cast(array() as array<struct<at:int,rows:array<struct<gap:int,len:int,m:string,left:string>>>>)),
        (a, rows) -> named_struct(
          'at', a.at + aggregate(rows, 0, (s, r) -> s + coalesce(r.gap, 0) + coalesce(r.len, 0)),
          'out', array_append(a.out, named_struct('at', a.at, 'rows', filter(rows, r -> r.len is not null)))),
        a -> a.out),
      c -> aggregate(c.rows,
        named_struct('at', c.at, 'out', cast(array() as array<struct<s:int,e:int,m:string,left:string>>)),
        (a, r) -> named_struct('at', a.at + r.gap + r.len, 'out', array_append(a.out, named_struct(
          's', a.at + r.gap, 'e', a.at + r.gap + r.len, 'm', r.m, 'left', r.left))),
        a -> a.out)))"""


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _luhn(m: str) -> str:
    """Whether the digits of ``m`` (at most 19 of them) pass the check sum."""
    d = f"reverse({_digits(m)})"
    digit = f"cast(substring({d}, i, 1) as int)"
    return (f"(length({_digits(m)}) between 2 and 19 and "
            f"aggregate(sequence(1, greatest(1, least(19, length({_digits(m)})))), 0, (a, i) -> a + "
            f"coalesce(if(i % 2 = 1, {digit}, if({digit} > 4, 2 * {digit} - 9, 2 * {digit})), 0)) % 10 = 0)")


VALID = {
    "email": "true",
    "ip": r"x.m rlike '^(0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(\\.|$)){4}$'",
    "card": f"(length({_digits('x.m')}) between 13 and 19 and {_luhn('x.m')})",
    "phone": f"length({_digits('x.m')}) between 9 and 15",
}


def _feature(name: str) -> str:
    """SQL of a small integer feature of candidate ``x`` in ``text``."""
    def side(c):
        return (f"case when {c} = '' or {c} rlike '\\\\s' then 0 when {c} rlike '[0-9]' then 3 "
                f"when {c} rlike '[A-Za-z]' then 2 else 1 end")
    d = f"length({_digits('x.m')})"
    return {
        "digits": f"case when {d} = 0 then 0 when {d} < 7 then 1 when {d} < 9 then 2 when {d} < 13 then 3 "
                  f"when {d} < 16 then 4 when {d} < 20 then 5 else 6 end",
        "at": "if(contains(x.m, '@'), if(x.m rlike '@.+[.][A-Za-z]{2,}$', 2, 1), 0)",
        "groups": "least(size(regexp_extract_all(x.m, '[0-9]+', 0)), 5)",
        "before": side("right(x.left, 1)"),
        "after": side("substring(text, x.e + 1, 1)"),
        "cue": f"if(x.left rlike r'{CUE}', 1, 0)",
        "luhn": f"if({_luhn('x.m')}, 1, 0)",
        "length": "case when length(x.m) < 8 then 0 when length(x.m) < 14 then 1 when length(x.m) < 24 then 2 else 3 end",
    }[name]


def _cells(source: str) -> str:
    fields = ", ".join(f"'{f}', {_feature(f)}" for f in FEATURES)
    return f"transform({source}, x -> named_struct('s', x.s, 'e', x.e, 'm', x.m, {fields}))"


def candidates(docs: DataFrame, id_col="doc_id", text_col="text", extra: dict | None = None) -> DataFrame:
    """doc_id, text, ``extra`` (new name: column), the passing spans of each base kind (``email`` ...) and
    the ``loose`` candidates that overlap none of them."""
    d = id_text(docs, id_col, text_col, extra)

    def found(kind, pattern):
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if kind in NEEDS:
            hits = F.when(F.contains("text", F.lit(NEEDS[kind])), hits).otherwise(F.lit([]).cast("array<string>"))
        return hits.alias(f"m_{kind}")

    d = d.select("*", *[found(k, p) for k, p in GENERATORS.items()])
    d = d.select("*", *[F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).alias(f"g_{k}")
                        for k, p in GENERATORS.items()])
    none = "cast(array() as array<struct<s:int,e:int,m:string,left:string>>)"
    d = d.select(*[c for c in d.columns if c[:2] not in ("m_", "g_")],
                 *[F.expr(f"if(size(m_{k}) > 0, {_positions(f'm_{k}', f'g_{k}')}, {none})").alias(f"all_{k}")
                   for k in GENERATORS])
    d = d.select("*", *[F.expr(f"filter(all_{k}, x -> {VALID[k]})").alias(k) for k in KINDS])
    base = "concat(" + ", ".join(KINDS) + ")"
    loose = (f"filter(concat(all_number, all_around), x -> not exists({base}, b -> b.s < x.e and x.s < b.e))")
    return d.withColumn("loose", F.expr(f"if(size(all_number) + size(all_around) = 0, {none}, {loose})"))


# -- boosted trees on feature cells ------------------------------------------

def _split(rows, grad, hess, members):
    """Best (gain, feature, cut) of the cells in ``members``."""
    total_g, total_h = sum(grad[i] for i in members), sum(hess[i] for i in members)
    best = (1e-9, None, None)
    for f in range(len(FEATURES)):
        for cut in sorted({rows[i][0][f] for i in members})[:-1]:
            left = [i for i in members if rows[i][0][f] <= cut]
            g, h = sum(grad[i] for i in left), sum(hess[i] for i in left)
            if sum(rows[i][1] for i in left) < LEAST or sum(rows[i][1] for i in members) - sum(
                    rows[i][1] for i in left) < LEAST:
                continue
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
            if gain > best[0]:
                best = (gain, f, cut)
    return best


def _grow(rows, grad, hess, members, depth):
    g, h = sum(grad[i] for i in members), sum(hess[i] for i in members)
    _, f, cut = _split(rows, grad, hess, members) if depth else (0, None, None)
    if f is None:
        return RATE * g / (h + 1)
    return (f, cut, _grow(rows, grad, hess, [i for i in members if rows[i][0][f] <= cut], depth - 1),
            _grow(rows, grad, hess, [i for i in members if rows[i][0][f] > cut], depth - 1))


def _value(tree, x):
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if x[f] <= cut else high
    return tree


def _sql(tree) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    f, cut, low, high = tree
    return f"if(y.{FEATURES[f]} <= {cut}, {_sql(low)}, {_sql(high)})"


class Trees:
    """Depth-2 trees on log odds; ``threshold`` is the calibrated score (None: nothing passes)."""

    def __init__(self, cells):
        """cells: (features, fold, candidates, passing)"""
        fit = [(c[0], c[2], c[3]) for c in cells if c[1] == 0]
        rest = [(c[0], c[2], c[3]) for c in cells if c[1] == 1]
        self.trees, self.start, self.threshold = [], 0.0, None
        n, good = sum(r[1] for r in fit), sum(r[2] for r in fit)
        if not 0 < good < n or not rest:
            return          # one class only: nothing to learn from, nothing is added
        self.start = math.log(good / (n - good))
        score = [self.start] * len(fit)
        for _ in range(ROUNDS):
            p = [1 / (1 + math.exp(-s)) for s in score]
            grad = [r[2] - r[1] * q for r, q in zip(fit, p)]
            hess = [r[1] * q * (1 - q) for r, q in zip(fit, p)]
            tree = _grow(fit, grad, hess, list(range(len(fit))), 2)
            self.trees.append(tree)
            score = [s + _value(tree, r[0]) for s, r in zip(score, fit)]
        seen = good = 0
        for s, r in sorted(((self.score(r[0]), r) for r in rest), key=lambda x: -x[0]):
            seen, good = seen + r[1], good + r[2]
            if good / seen >= PRECISION:
                self.threshold = s

    def score(self, x):
        return self.start + sum(_value(t, x) for t in self.trees)

    def sql(self) -> str:
        return " + ".join([f"{self.start!r}D"] + [_sql(t) for t in self.trees])


def fit(docs: DataFrame, id_col="doc_id", text_col="text", fit_docs: int = FIT_DOCS) -> Trees:
    """Trees from the base candidates of about ``fit_docs`` documents (chosen by
    hash of the id).  Only counts per feature cell reach the driver; the cells
    are bounded by the feature grid."""
    n = docs.count()
    sample = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, fit_docs / max(n, 1))))
    d = candidates(sample, id_col, text_col)
    rows = F.expr("concat(" + ", ".join(
        f"transform(all_{k}, x -> named_struct("
        + ", ".join(f"'{f}', {_feature(f)}" for f in FEATURES)
        + f", 'good', if({VALID[k]}, 1, 0)))" for k in KINDS) + ")")
    cells = (d.select("doc_id", F.explode(rows).alias("y"))
             .groupBy(*[F.col(f"y.{f}").alias(f) for f in FEATURES],
                      F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).alias("fold"))
             .agg(F.count("*").alias("n"), F.sum("y.good").alias("good")).collect())
    return Trees([(tuple(r[f] for f in FEATURES), r["fold"], float(r["n"]), float(r["good"]))
                  for r in sorted(cells)])


def detect(docs: DataFrame, id_col="doc_id", text_col="text", extra: tuple = (), fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, text, ``extra`` columns, n_email, n_ip, n_card, n_phone (base
    spans), base and spans: arrays of (kind, s, e) in code points, end
    exclusive, by kind as listed, then start.

    Null text has no spans; repeated rows are judged alike.  Without both
    passing and failing candidates to learn from, no loose span is added."""
    trees = fit(docs, id_col, text_col, fit_docs)
    carried = [f"x_{i}" for i in range(len(extra))]
    d = candidates(docs, id_col, text_col, dict(zip(carried, extra)))

    def named(kind, source):
        return f"transform({source}, x -> named_struct('kind', '{kind}', 's', x.s, 'e', x.e))"

    base = "concat(" + ", ".join(named(k, k) for k in KINDS) + ")"
    d = d.select("doc_id", "text", *carried, *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                 F.expr(base).alias("base"), "loose")
    if trees.threshold is None:
        return d.withColumn("spans", F.col("base")).drop("loose").withColumnsRenamed(dict(zip(carried, extra)))
    passed = f"filter({_cells('loose')}, y -> {trees.sql()} >= {trees.threshold!r}D)"
    d = d.withColumn("added", F.expr(f"if(size(loose) = 0, cast(array() as array<struct<kind:string,s:int,e:int>>), "
                                     f"transform({passed}, y -> named_struct('kind', "
                                     f"case when y.at > 0 then 'email' when y.digits >= 5 then 'card' else 'phone' end, "
                                     f"'s', y.s, 'e', y.e)))"))
    spans = "concat(" + ", ".join(
        f"array_sort(filter(concat(base, added), x -> x.kind = '{k}'))" for k in KINDS) + ")"
    return (d.withColumn("spans", F.expr(f"if(size(added) = 0, base, {spans})")).drop("loose", "added")
            .withColumnsRenamed(dict(zip(carried, extra))))


def joined(col: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.expr(f"array_join(transform({col}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')")


def redacted(text: str = "text", spans: str = "spans") -> Column:
    """The text with each span (overlapping ones together) replaced by its kind in brackets."""
    merged = f"""aggregate(array_sort(transform({spans}, x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind))),
      named_struct('at', 0, 'out', cast(array() as array<struct<a:int,b:int,kind:string>>)),
      (acc, x) -> if(x.e <= acc.at, acc, named_struct('at', x.e, 'out', array_append(acc.out,
        named_struct('a', acc.at, 'b', greatest(x.s, acc.at), 'kind', x.kind)))))"""
    return F.expr(f"""if(size({spans}) = 0, {text}, transform(array({merged}), r -> concat(
      array_join(transform(r.out, p -> concat(substring({text}, p.a + 1, p.b - p.a), '[', upper(p.kind), ']')), ''),
      substring({text}, r.at + 1)))[0])""")
