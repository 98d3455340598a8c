"""Personal data by weak supervision, in DataFrame functions only.

1. Matches. One pass over the texts extracts, per kind, all matches and the stretches between them, as arrays that a generator turns into columns
   of their own, so that no array is evaluated anew for each of its elements. The stretch before a match is its context. The patterns loop over single
   characters only, so very long runs neither overflow the matcher's stack nor rescan.
2. Positions. Matches become slim rows of (document, kind, order, lengths); running sums give their places. ``BASE`` kinds are found as
   stated and always stay; ``MORE`` kinds are candidates, left out where they overlap a base span (running extremes over the starts).
   Both are windows within one document, linear but for sorting, so a page that lists 100 000 addresses takes seconds.
3. Votes. Every span is judged by labelers that may abstain: a format check (regular expression), gazetteers (top-level domains, card issuers,
   calling codes, account lengths by country), words in the context that speak for and against, and what touches the span on either side.
4. Reliabilities. Votes are counted per kind and pattern, a table of at most kinds x 3^labelers rows, and expectation-maximisation
   on these counts estimates each labeler's accuracy, its coverage and each kind's prior.
5. Classifier. A logistic regression on the span's own features (kind, length class, digits, context, neighbours; at most 2^features
   different rows after grouping) is fitted to the probabilities from step 4. Candidates it scores at ``KEEP`` or more become spans.

Only the two grouped tables reach the driver; their size depends on the numbers of labelers and features, not on the data.

Defined results: a null text is empty and has no spans; with no span at all nothing is learned and nothing added; candidates that overlap a
base span are dropped; repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.catalog import query
from flowloom.llm.common import documents, store

#: Fixed patterns of the base kinds, in the order in which spans are listed. Starts inside a run are excluded, since a
#: match there would have started earlier; repeated groups are written as single characters with a look behind.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))*(?<!\.)"
IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
#: A whole run of digits with single separators that has 14 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
MORE = (
    ("tel", r"(?<![0-9+(-])\(?[0-9]{3}[)\x20.-]\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
)
KINDS = [k for k, _ in BASE + MORE]
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
CONTEXT = 30
#: Gazetteers (fixed public values): top-level domains in common use and those reserved for examples,
TOP_LEVEL = (
    "com net org edu gov mil int info biz name pro aero coop museum mobi jobs travel tel cat asia post xyz online site shop store tech app dev blog cloud club live news page email "
    "ac ad ae af ag ai al am ao ar at au az ba bd be bg bh bo br by bz ca cc ch ci cl cm cn co cr cu cy cz de dk do dz ec ee eg es et eu fi fj fm fo fr ge gg gh gi gl gr gt hk hn hr "
    "hu id ie il im in io iq ir is it je jm jo jp ke kg kh kr kw kz la lb li lk lt lu lv ly ma mc md me mg mk ml mm mn mo mt mu mv mx my mz na ng ni nl no np nz om pa pe ph pk pl pr ps "
    "pt py qa ro rs ru rw sa se sg si sk sn so sr st su sv sy tg th tj tm tn to tr tt tv tw tz ua ug uk us uy uz va ve vn ws ye za zm zw example test invalid localhost").split()
#: leading digits of card issuers, digits of calling codes,
ISSUERS = "(?:4|5[0-8]|2[2-7]|3[0-9]|6)"
CALLING = "(?:1|7|2[07]|2[1-69][0-9]|3[0-469]|3[578][0-9]|4[013-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[7-9][0-9]|8[1246]|8[0578][0-9]|9[0-58]|9[679][0-9])"
#: and lengths of account numbers by country.
ACCOUNT_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20,
}
#: Context words (fixed values).
FOR = r"(?i)(?:e-?mail|mail|contact|phone|tel|call|fax|mobile|card|visa|account|iban|ssn|social|address|server|host|ip|reach|write)[^\x20]{0,3}(?:\x20[^\x20]{0,4})?\x20?$"
AGAINST = r"(?i)(?:version|isbn|order|sku|part|page|chapter|section|serial|model|doi|rev|build)[^\x20]{0,3}\x20?$"
STEPS, KEEP = 60, 0.5
LABELERS = ("format", "gazetteer", "context_for", "context_against", "touching")
FEATURES = ("long", "digits", "cue", "counter", "touched", "listed")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    if kind == "card":
        return F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def _format(kind: str, v: Column) -> Column:
    return {
        "email": F.rlike(v, F.lit(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,10}$")),
        "ip": F.rlike(v, F.lit(r"^(?:[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$")),
        "card": F.rlike(v, F.lit(r"^(?:[0-9]{14,16}|[0-9]{4}(?:[\x20-][0-9]{4}){3})$")),
        "phone": F.rlike(v, F.lit(r"^\+[0-9]{1,3}[\x20(.-]")),
        "tel": F.rlike(v, F.lit(r"^\(?[2-9][0-9]{2}[)\x20.-]\x20?[2-9]")),
        "ssn": ~F.rlike(v, F.lit(r"^(?:000|666|9)|-00-|-0000$")),
        "iban": F.length(F.regexp_replace(v, r"\x20", "")).between(15, 34),
    }[kind]


def _listed(kind: str, v: Column) -> Column:
    if kind == "email":
        return F.lower(F.substring_index(v, ".", -1)).isin(TOP_LEVEL)
    if kind == "iban":
        own = F.regexp_replace(v, r"\x20", "")
        return F.concat(F.left(own, F.lit(2)), F.length(own).cast("string")).isin([f"{c}{n}" for c, n in ACCOUNT_LENGTHS.items()])
    return {
        "ip": ~F.rlike(v, F.lit(r"^0|^[0-9]\.[0-9]\.[0-9]\.[0-9]$")), "card": F.rlike(digits(v), F.lit(f"^{ISSUERS}")), "phone": F.rlike(digits(v), F.lit(f"^{CALLING}")),
        "tel": F.rlike(v, F.lit(r"^\(?[2-9][0-8]")), "ssn": F.rlike(v, F.lit("^[0-8]")),
    }[kind]


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _judged(kind: str, v: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """Votes (-1 abstains) and features of a match between ``before`` and ``after``."""
    well, listed = _format(kind, v), _listed(kind, v)
    cue, counter = F.rlike(before, F.lit(FOR)), F.rlike(before, F.lit(AGAINST))
    touched = F.rlike(F.concat(F.right(before, F.lit(1)), F.lit(" "), after), F.lit(r"^[\p{L}\p{N}_/#]|[\p{L}\p{N}_/#]$"))
    never = F.lit(False)
    votes = [_vote(well, ~well), _vote(listed, ~listed), _vote(cue, never), _vote(never, counter), _vote(never, touched)]
    flags = [F.length(v) >= 16, F.length(digits(v)) >= 10, cue, counter, touched, listed]
    return F.array(*votes), F.array(*[f.cast("int") for f in flags])


def _matches(number: int, kind: str, found: str, gaps: str) -> Column:
    """One kind's matches in order, each with the length of what lies before it."""
    rows = F.arrays_zip(F.col(found).alias("v"), F.col(gaps).alias("g"), F.slice(F.col(gaps), 2, F.size(gaps)).alias("next"))

    def match(x: Column, i: Column) -> Column:
        v, before, after = x["v"], F.right(x["g"], F.lit(CONTEXT)), F.left(F.coalesce(x["next"], F.lit("")), F.lit(1))
        votes, flags = _judged(kind, v, before, after)
        length = F.length(v).cast("long")
        return F.struct(F.lit(number).alias("kind"), i.alias("i"), (F.length(x["g"]) + length).alias("step"), length.alias("length"), _passes(kind, v).alias("ok"),
                        votes.alias("votes"), flags.alias("flags"))
    return F.transform(F.filter(rows, lambda x: x["v"].isNotNull()), match)


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, found): a number for each document and its matches of all kinds."""
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    arrays = []
    for n, (_, pattern) in enumerate(BASE + MORE):
        arrays += [F.regexp_extract_all("t", F.lit(pattern), F.lit(0)).alias(f"m{n}"), F.split("t", pattern).alias(f"g{n}")]
    # the generator makes columns of the arrays: they are evaluated once, whatever names them later
    apart = text.select("id", F.inline(F.array(F.struct(*arrays))))
    return apart.select(F.monotonically_increasing_id().alias("row"), "id", F.concat(*[_matches(n, k, f"m{n}", f"g{n}") for n, k in enumerate(KINDS)]).alias("found"))


def placed(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, base, votes, flags): base spans, and candidates that overlap none."""
    each = found.select("row", F.explode("found").alias("x")).select("row", "x.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = each.withColumn("end", F.sum("step").over(so_far)).where("ok").withColumns({"start": F.col("end") - F.col("length"), "base": F.col("kind") < len(BASE)})
    up = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    open_till, next_start = F.max(F.when(F.col("base"), F.col("end"))).over(up), F.min(F.when(F.col("base"), F.col("start"))).over(down)
    apart = (F.coalesce(open_till, F.lit(0)) <= F.col("start")) & (F.coalesce(next_start, F.col("end")) >= F.col("end"))
    return spans.withColumn("apart", apart).where("base or apart").select("row", "kind", "start", "end", "base", "votes", "flags")


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], steps: int = STEPS) -> tuple[dict[str, float], dict[tuple[int, int], list[float]]]:
    """Expectation-maximisation over (kind, votes, count): (prior per kind, vote distributions per labeler and class)."""
    prior = {k: 0.7 for k, _, _ in patterns}
    # at first, a vote is right three times as often as wrong; abstaining says nothing
    dist = {(j, c): [0.34, 0.33 + (0.17 if c == 0 else -0.17), 0.33 + (0.17 if c == 1 else -0.17)] for j in range(len(LABELERS)) for c in (0, 1)}
    for _ in range(steps):
        mass = {key: [0.5, 0.5, 0.5] for key in dist}
        ones: dict[str, float] = dict.fromkeys(prior, 1.0)
        every: dict[str, float] = dict.fromkeys(prior, 2.0)
        for kind, votes, n in patterns:
            p = posterior(kind, votes, prior, dist)
            ones[kind] += n * p
            every[kind] += n
            for j, v in enumerate(votes):
                mass[j, 1][v + 1] += n * p
                mass[j, 0][v + 1] += n * (1 - p)
        prior = {k: ones[k] / every[k] for k in prior}
        dist = {key: [x / sum(m) for x in m] for key, m in mass.items()}
    return prior, dist


def posterior(kind: str, votes: tuple[int, ...], prior: dict[str, float], dist: dict[tuple[int, int], list[float]]) -> float:
    p = min(max(prior[kind], 1e-6), 1 - 1e-6)
    return _sigmoid(math.log(p / (1 - p)) + sum(math.log(dist[j, 1][v + 1] / dist[j, 0][v + 1]) for j, v in enumerate(votes)))


def fit_classifier(rows: list[tuple[list[float], float, float]], ridge: float = 1.0, steps: int = 400) -> list[float]:
    """Weights of a logistic regression on (features, weight of class 1, weight of class 0), by damped coordinate Newton steps."""
    if not rows:
        return []
    w = [0.0] * len(rows[0][0])
    for _ in range(steps):
        moved = 0.0
        for j in range(len(w)):
            g, h = ridge * w[j], ridge
            for x, one, zero in rows:
                if x[j]:
                    p = _sigmoid(sum(a * b for a, b in zip(w, x, strict=True) if b))
                    g += x[j] * ((one + zero) * p - one)
                    h += x[j] * x[j] * (one + zero) * p * (1 - p)
            step = max(-1.0, min(1.0, g / h))
            w[j] -= step
            moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def learn(spans: DataFrame) -> list[float] | None:
    """Weights for (1, kinds, features), or None where there is nothing to learn from."""
    rows = spans.groupBy("kind", "votes", "flags").agg(F.count("*").alias("n")).collect()  # at most kinds x 3^labelers x 2^features, and features follow from nearly the same facts as votes
    if not rows:
        return None
    patterns: dict[tuple[str, tuple[int, ...]], int] = {}
    for r in rows:
        patterns[KINDS[r["kind"]], tuple(r["votes"])] = patterns.get((KINDS[r["kind"]], tuple(r["votes"])), 0) + r["n"]
    prior, dist = reliabilities([(k, v, n) for (k, v), n in sorted(patterns.items())])
    merged: dict[tuple, list[float]] = {}
    for r in rows:
        p = posterior(KINDS[r["kind"]], tuple(r["votes"]), prior, dist)
        x = merged.setdefault((KINDS[r["kind"]], tuple(r["flags"])), [0.0, 0.0])
        x[0] += r["n"] * p
        x[1] += r["n"] * (1 - p)
    return fit_classifier([([1.0, *[float(k == kind) for kind in KINDS], *map(float, flags)], one, zero) for (k, flags), (one, zero) in sorted(merged.items())])


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): base spans, and all spans with the candidates that the classifier keeps, in order of start and kind."""
    found = store(matches(docs, id_col, text_col), "matches")
    spans = store(placed(found), "spans")
    weights = learn(spans)
    if weights is None:
        score = F.lit(0.0)
    else:
        of_kind = F.element_at(F.array(*[F.lit(w) for w in weights[1:1 + len(KINDS)]]), F.col("kind") + 1)
        score = F.lit(weights[0]) + of_kind + sum((F.col("flags")[i] * F.lit(w) for i, w in enumerate(weights[1 + len(KINDS):])), F.lit(0.0))
    kept = spans.where(F.col("base") | (score >= math.log(KEEP / (1 - KEEP)))).select("row", F.struct("start", "kind", "end").alias("s"))
    names = F.array(*[F.lit(k) for k in KINDS])
    whole = kept.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("s"))  # bounded by one document's spans
    whole = found.select("row", "id").join(whole, "row", "left").select("id", F.coalesce("s", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("s"))

    def named(s: Column) -> Column:
        return F.transform(s, lambda x: F.struct(F.element_at(names, x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return whole.select("id", named(F.filter("s", lambda x: x["kind"] < len(BASE))).alias("base"), named(F.col("s")).alias("spans"))


def listing(spans: Column) -> Column:
    """kind:start:end of spans in order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op6_pii")
def op6_pii(spark, sf_dir: str) -> DataFrame:
    found = find_spans(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k, _ in BASE]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))
