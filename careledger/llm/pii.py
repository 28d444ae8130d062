"""Personal data: candidates from high-recall generators, scored by boosted trees.

Base spans (e-mail addresses, IPv4 addresses, card numbers, telephone numbers) are found by exact
patterns and checks and always stay. Beside them, generators propose spans that may overlap:
written-out or bracketed addresses, defanged IPs, cards with odd separators, telephone numbers
without a country code. Boosted trees (pyspark.ml) score each proposal from its format and the text
around it, and a threshold for each kind, calibrated on held-out rows, selects what is added.

There are no labels for such spans, so the trees learn from the corpus itself: valid base spans,
rewritten into the forms that the generators look for, are positive; matches that fail the checks
and rewritten spans with a broken check are negative. Rows come from the base spans of all documents; rows with
the same features are one with a weight, and features say so little about a span that there are few.
Everything runs as column expressions: a document's spans are arrays of structs, trees
are CASE expressions over them, and no document moves.

Defined results: a null text is empty; an empty text has no span; offsets count code points, ends are
exclusive; spans of different kinds may overlap, added ones are never inside a base span; where
the documents have no positive or no negative row, nothing is added.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import staged, text_of

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH = 12, 4
# Precision on held-out rows that a kind's threshold must reach.
PRECISION = 0.99

# Quantifiers are possessive and starts are tied to where a run begins, which changes no match of the
# plain patterns but keeps long runs linear. \G allows a start right behind the last match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    # A run of more or fewer digits can't pass the check, so it need not match.
    "card": r"(?<![0-9]|[0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?(?:@|[(\[{]at[)\]}]|\bat\b)\s?[A-Za-z0-9-]{1,63}+"
             r"(?:(?:\.|\s?[(\[{](?:dot|\.)[)\]}]\s?|\sdot\s)[A-Za-z0-9-]{1,63}+){1,6}+",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:\x20?[(\[{]?(?:\.|dot)[)\]}]?\x20?[0-9]{1,3}+){3}+(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20._/-]{0,3}[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\([0-9]{2,4}\)|[0-9]{1,4})(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,4}+(?![0-9A-Za-z])",
}
_NOTHING = "CAST(array() AS array<struct<s:int,e:int,v:string,b:string,a:string>>)"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(pattern: str, hint: str | None) -> str:
    """Array of (s, e, v, b, a): start, end, match and the text around of each match in _t."""
    p = _sql(pattern)
    found = f"regexp_extract_all(_t, {p}, 0)"
    if hint:
        found = f"CASE WHEN {hint} THEN {found} ELSE array() END"
    return f"""CASE WHEN size({found}) = 0 THEN {_NOTHING} ELSE
        aggregate(sequence(0, size({found}) - 1),
            named_struct('pos', 0, 'out', {_NOTHING}, 'm', {found}, 'g', split(_t, {p}, -1)),
            (acc, i) -> named_struct(
                'pos', acc.pos + length(acc.g[i]) + length(acc.m[i]),
                'out', concat(acc.out, array(named_struct(
                    's', acc.pos + length(acc.g[i]), 'e', acc.pos + length(acc.g[i]) + length(acc.m[i]),
                    'v', acc.m[i], 'b', right(acc.g[i], 24), 'a', left(acc.g[i + 1], 8)))),
                'm', acc.m, 'g', acc.g),
            acc -> acc.out) END"""


def _digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '')"


def luhn(v: str) -> str:
    d = f"reverse({_digits(v)})"
    return f"""aggregate(sequence(1, greatest(length({d}), 1)), 0, (sum, i) -> sum + CASE
        WHEN length({d}) = 0 THEN 1 WHEN i % 2 = 1 THEN CAST(substr({d}, i, 1) AS INT)
        ELSE CAST(substr({d}, i, 1) AS INT) * 2 - IF(CAST(substr({d}, i, 1) AS INT) > 4, 9, 0) END) % 10 = 0"""


def _quad(v: str) -> str:
    """Each of the four numbers is at most 255."""
    return f"""size(regexp_extract_all({v}, '[0-9]+', 0)) = 4 AND forall(regexp_extract_all({v}, '[0-9]+', 0),
        x -> length(regexp_replace(x, '^0+', '')) <= 3 AND CAST(right(x, 3) AS INT) <= 255)"""


CHECKS = {
    "email": lambda v: "true",
    "ip": _quad,
    "card": lambda v: f"length({_digits(v)}) BETWEEN 13 AND 19 AND {luhn(v)}",
    "phone": lambda v: f"length({_digits(v)}) BETWEEN 9 AND 15",
}
_HINTS = {"email": "contains(_t, '@')", "phone": "contains(_t, '+')"}


def _features(kind: str, at: str) -> list[str]:
    """Numbers about a span: its format, then what stands around it."""
    v, b, a = f"{at}v", f"{at}b", f"{at}a"
    groups = f"regexp_extract_all({v}, '[0-9]+', 0)"
    flag = "IF({}, 1.0D, 0.0D)".format
    return [
        *(flag(f"'{kind}' = '{k}'") for k in KINDS),
        # Digits say nothing about an address.
        *(["0.0D"] * 5 if kind == "email" else [
            f"CAST(length({_digits(v)}) AS DOUBLE)",
            f"CAST(length({v}) AS DOUBLE)",
            f"CAST(size({groups}) AS DOUBLE)",
            f"CAST(coalesce(length(get({groups}, 0)), 0) AS DOUBLE)",
            f"CAST(coalesce(length(get({groups}, size({groups}) - 1)), 0) AS DOUBLE)",
        ]),
        f"CAST(length(regexp_replace({v}, '[^ ]', '')) AS DOUBLE)",
        f"CAST(length(regexp_replace({v}, '[^./_]', '')) AS DOUBLE)",
        f"CAST(length(regexp_replace({v}, '[^-]', '')) AS DOUBLE)",
        flag(luhn(v)) if kind == "card" else "0.0D",
        flag(_quad(v)) if kind == "ip" else "0.0D",
        flag(f"{v} RLIKE '^[(]'"),
        flag(f"{v} RLIKE '[(\\\\[{{]'"),
        flag(f"contains({v}, '@')"),
        flag(f"{v} RLIKE '(?i)[)\\\\]}} ](dot|[.])|[.]'") if kind == "email" else "0.0D",
        flag(f"{v} RLIKE '(?i)[.)\\\\]}} ][a-z]{{2,6}}$'") if kind == "email" else "0.0D",
        flag(f"{v} RLIKE '(?i)[a-z0-9] ?[(\\\\[{{]at[)\\\\]}}]'") if kind == "email" else "0.0D",
        flag(f"{v} RLIKE '^(19|20)[0-9][0-9][-./]'"),
        flag(f"{b} RLIKE '(?i)(tel|phone|call|fax|mobile|card|visa|ip|host|mail|contact)[^a-z]*$'"),
        flag(f"{b} RLIKE '[0-9A-Za-z=#$/_-]$'"),
        flag(f"{a} RLIKE '^[0-9A-Za-z=#$/_%-]'"),
    ]


# Rewritten forms of a valid span: (form, form with a broken check).
_REWRITES = {
    "email": [
        ("regexp_replace(replace(v, '@', ' (at) '), '[.](?=[^.]*$)', ' (dot) ')", "replace(v, '@', ' at ')"),
        ("replace(v, '@', ' [at] ')", "concat('look at ', regexp_extract(v, '@([A-Za-z0-9-]+)', 1), '.')"),
        ("regexp_replace(replace(v, '@', ' at '), '[.]', ' dot ')", "concat('the at ', regexp_extract(v, '@([A-Za-z0-9-]+)', 1), '.', left(v, 2))"),
        ("regexp_replace(replace(v, '@', '[at]'), '[.]', '[dot]')", "concat('at ', regexp_extract(v, '@([A-Za-z0-9-]+)', 1))"),
    ],
    "ip": [
        ("replace(v, '.', '[.]')", "concat('9', replace(v, '.', '[.]9'))"),
        ("replace(v, '.', '(dot)')", "concat('7', replace(v, '.', ' . 8'))"),
        ("replace(v, '.', ' . ')", "concat('3', replace(v, '.', '. 6'))"),
    ],
    "card": [
        (f"regexp_replace({_digits('v')}, '([0-9]{{4}})(?=[0-9])', '$1.')",
         f"regexp_replace(concat({_digits('left(v, length(v) - 1)')}, CAST((CAST(right(v, 1) AS INT) + 1) % 10 AS STRING)), '([0-9]{{4}})(?=[0-9])', '$1.')"),
        (f"regexp_replace({_digits('v')}, '([0-9]{{4}})(?=[0-9])', '$1  ')",
         f"regexp_replace(concat({_digits('left(v, length(v) - 1)')}, CAST((CAST(right(v, 1) AS INT) + 3) % 10 AS STRING)), '([0-9]{{4}})(?=[0-9])', '$1  ')"),
    ],
    "phone": [
        ("regexp_replace(v, '^[+][0-9]{1,3}[ .-]*', '')", f"concat('20', substr({_digits('v')}, 2, 2), '-', substr({_digits('v')}, 4, 2), '-', substr({_digits('v')}, 6, 2))"),
        (f"regexp_replace(right({_digits('v')}, 10), '^([0-9]{{3}})([0-9]{{3}})', '$1-$2-')", f"concat(substr({_digits('v')}, 2, 2), '.', substr({_digits('v')}, 4, 2), '.', substr({_digits('v')}, 6, 2))"),
        (f"regexp_replace(right({_digits('v')}, 10), '^([0-9]{{3}})([0-9]{{3}})', '$1.$2.')", f"concat(substr({_digits('v')}, 2, 1), ' ', substr({_digits('v')}, 4, 3), ' ', substr({_digits('v')}, 7, 3))"),
    ],
}


@dataclass(frozen=True)
class Model:
    """Trees as a SQL expression over f, a span's features; thresholds by kind."""

    score: str
    thresholds: dict[str, float]


def base_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """docs with _t, the text, and _email, _ip, _card, _phone: the spans that pass their checks."""
    out = docs.withColumn("_t", text_of(text_col))
    out = out.withColumns({f"_{k}": F.expr(_spans(p, _HINTS.get(k))) for k, p in BASE.items()})
    return out.withColumns({
        f"_{k}": F.expr(f"filter(_{k}, x -> {CHECKS[k]('x.v')})") for k in KINDS if k != "email"
    })


def training_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """kind, held, label, f, n: the features of all documents' spans, rewritten, and how many spans have them."""
    none = "CAST(array() AS array<struct<kind:string,v:string,b:string,a:string,good:boolean>>)"
    found = docs.select(text_of(text_col).alias("_t")).withColumns({f"_{k}": F.expr(_spans(BASE[k], _HINTS.get(k))) for k in KINDS})
    parts = [f"transform(_{k}, x -> named_struct('kind', '{k}', 'v', x.v, 'b', x.b, 'a', x.a, 'good', {CHECKS[k]('x.v')}))" for k in KINDS]
    spans = found.select(F.explode(F.expr(f"concat({none}, {', '.join(parts)})")).alias("x")).select("x.*")

    def by_kind(of: Callable[[str], str]) -> Column:
        return F.expr(f"CASE kind {' '.join(f"WHEN '{k}' THEN {of(k)}" for k in KINDS)} END")

    def forms(kind: str) -> str:
        each = ", ".join(
            f"named_struct('v', {good}, 'label', IF(good, 1, 0)), named_struct('v', IF(good, {bad}, v), 'label', 0)"
            for good, bad in _REWRITES[kind]
        )
        return f"array({each})"

    rows = spans.select("kind", "b", "a", F.explode(by_kind(forms)).alias("y")).select(
        "kind", "y.v", "b", "a", F.col("y.label").cast("double").alias("label"),
    )
    # Features are numbers: equal ones are one row.
    return rows.select(
        "kind", (F.pmod(F.xxhash64("v", "b"), F.lit(4)) == 0).alias("held"), "label",
        by_kind(lambda k: f"array({', '.join(_features(k, ''))})").alias("f"),
    ).groupBy("kind", "held", "label", "f").agg(F.count("*").alias("n"))


def as_sql(model, at: str = "f") -> str:
    """The margin of boosted trees as SQL over an array of features."""
    trees, stack = [], []
    weight = None
    for line in model.toDebugString.splitlines()[1:]:
        line = line.strip()
        if m := re.match(r"Tree \d+ \(weight ([-\d.E]+)\)", line):
            if weight is not None:
                trees.append(f"{weight} * ({''.join(stack)})")
            weight, stack = m[1] + "D", []
        elif m := re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line):
            stack.append(f"CASE WHEN {at}[{m[1]}] <= {m[2]}D THEN ")
        elif m := re.match(r"Else \(feature", line):
            stack.append(" ELSE ")
        elif m := re.match(r"Predict: ([-\d.E]+)", line):
            stack.append(f"{m[1]}D")
    trees.append(f"{weight} * ({''.join(stack)})")
    # Each ELSE branch closes its CASE: count them tree by tree.
    return " + ".join(_closed(t) for t in trees)


def _closed(tree: str) -> str:
    """END after each complete CASE: a CASE is complete once its ELSE branch is."""
    out, open_ = [], []
    for part in re.findall(r"CASE WHEN [^ ]+ <= [^ ]+ THEN | ELSE |[-\d.E]+D|[^CE\d-]+|.", tree):
        out.append(part)
        if part.startswith("CASE"):
            open_.append(0)
        elif part == " ELSE ":
            open_[-1] = 1
        elif re.fullmatch(r"[-\d.E]+D", part):
            while open_ and open_[-1] == 1:
                out.append(" END")
                open_.pop()
    return "".join(out)


def fit(docs: DataFrame, text_col: str = "text") -> Model | None:
    seen = staged(training_rows(docs, text_col), "spans")
    train = seen.where("NOT held")
    labels = {r["label"] for r in train.select("label").distinct().collect()}
    if labels != {0.0, 1.0}:
        return None
    trees = GBTClassifier(
        featuresCol="x", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, stepSize=0.5, seed=1, maxBins=32,
    ).fit(train.select("label", array_to_vector("f").alias("x"), F.col("n").cast("double").alias("n")))
    score = f"(1 / (1 + exp(-2 * ({as_sql(trees)}))))"
    bins = seen.where("held").select("kind", "label", "n", F.floor(F.expr(score) * 100).alias("bin")).groupBy("kind", "bin").agg(
        F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n"),
    ).collect()
    thresholds = {}
    for k in KINDS:
        right = n = 0
        for r in sorted((r for r in bins if r["kind"] == k), key=lambda r: -r["bin"]):
            right, n = right + r["right"], n + r["n"]
            if right < PRECISION * n or r["bin"] < 50:
                break
            thresholds[k] = r["bin"] / 100
    return Model(score, thresholds)


def find(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs with _t, base spans by kind, and _added: (k, s, e) of the proposals that the trees accept."""
    out = base_spans(docs, text_col)
    none = "CAST(array() AS array<struct<k:int,s:int,e:int>>)"
    if model is None or not model.thresholds:
        return out.withColumn("_added", F.expr(none))
    out = out.withColumn("_base", F.expr("concat(_email, _ip, _card, _phone)"))
    chosen = []
    for k, least in model.thresholds.items():
        out = out.withColumn(f"_p{k}", F.expr(_spans(PROPOSED[k], r"_t RLIKE '(?i)[^a-z0-9](at|@)[^a-z0-9]|@'" if k == "email" else None)))
        scored = f"transform(_p{k}, x -> named_struct('k', {KINDS.index(k)}, 's', x.s, 'e', x.e, 'f', array({', '.join(_features(k, 'x.'))})))"
        out = out.withColumn(f"_p{k}", F.expr(f"CASE WHEN size(_p{k}) > 0 THEN {scored} END"))
        score = model.score.replace("f[", "x.f[")
        chosen.append(
            f"coalesce(transform(filter(_p{k}, x -> {score} >= {least}D AND NOT exists(_base, y -> y.s <= x.s AND x.e <= y.e)), "
            f"x -> named_struct('k', x.k, 's', x.s, 'e', x.e)), {none})"
        )
    return out.withColumn("_added", F.expr(f"concat({', '.join(chosen)})"))


def listed(base_only: bool) -> Column:
    """kind:start:end of the spans, by kind as listed, then start, joined by commas."""
    parts = [f"transform(_{k}, x -> named_struct('k', {i}, 's', x.s, 'e', x.e))" for i, k in enumerate(KINDS)]
    if not base_only:
        parts.append("_added")
    names = f"array({', '.join(map(repr, KINDS))})"
    return F.expr(
        f"array_join(transform(array_sort(array_distinct(concat({', '.join(parts)}))), "
        f"x -> concat({names}[x.k], ':', x.s, ':', x.e)), ',')"
    )


def redact(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs with each span of the text replaced by [KIND]; overlapping spans go as one."""
    parts = [f"transform(_{k}, x -> named_struct('s', x.s, 'e', x.e, 'k', '[{k.upper()}]'))" for k in KINDS]
    tags = f"array({', '.join(repr(f'[{k.upper()}]') for k in KINDS)})"
    parts.append(f"transform(_added, x -> named_struct('s', x.s, 'e', x.e, 'k', {tags}[x.k]))")
    columns = docs.columns
    found = find(docs, model, text_col).withColumn("_all", F.expr(f"array_sort(concat({', '.join(parts)}))"))
    cleaned = F.expr("""CASE WHEN size(_all) = 0 THEN _t ELSE aggregate(_all, named_struct('pos', 0, 'out', ''),
        (acc, x) -> named_struct('pos', greatest(acc.pos, x.e), 'out', CASE WHEN x.s >= acc.pos
            THEN concat(acc.out, substr(_t, acc.pos + 1, x.s - acc.pos), x.k) ELSE acc.out END),
        acc -> concat(acc.out, substr(_t, acc.pos + 1))) END""")
    return found.withColumn(text_col, F.when(F.col(text_col).isNotNull(), cleaned)).select(*columns)
