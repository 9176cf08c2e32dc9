"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates are the matches of the base patterns and of loose patterns (written-out
addresses, numbers without a country code, long-form IP). Three labelers vote for, against or not
at all on each: a regex labeler (checks of the base pattern), a gazetteer labeler (known
endings, prefixes and ranges) and a context labeler (cue words around it). Expectation-maximisation
over the counts of vote patterns estimates how reliable each labeler is for each kind; the
posteriors train a naive Bayes classifier over the shape of a span and its neighbours, which
decides on loose candidates. Base matches that pass their check always stay.

All of it is row-wise SQL functions but for two aggregations of fixed size: vote patterns (27 for
each kind) and classifier cells. A text is scanned where it lies, and nothing is shuffled with it.

Null texts count as empty. Null or repeated document ids are rows of their own. An empty table
gives none. Texts of any length are scanned whole; patterns run in linear time. Extra columns are
ignored.
"""

from __future__ import annotations

import json
import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored

KINDS = ["email", "ip", "card", "phone"]
FEATURES, CELLS = 5, 128

# Same matches as the patterns of the contract: where a match can begin is stated (a run's start or
# the last match's end) and loops are possessive, so that no text costs more than linear time.
# Card runs under 14 digits would be dropped anyway.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]{1,63}){1,8}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9+.)-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# The gazetteers and cue words.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]\x20?)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|us|it|nl|ch|at)$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.|^[0-9A-Fa-f]{4}:",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^\+[1-9]|^\(?[2-9][0-9]{2}",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|correo|courriel|kontakt)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|adresse|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|tarjeta|carte|karte|payment)\b",
    "phone": r"(?i)\b(?:tel|phone|call|mobile|fax|telefon|tel[eé]fono|t[eé]l[eé]phone|ring)\b",
}
CONTRARY = r"(?i)\b(?:version|v|section|isbn|order|invoice|item|serial|build)[\x20.:#]*$"


def _starts(found: str, gaps: str) -> str:
    """SQL for the start of each match, from the matches and the texts between them.

    Running sums over chunks of 256, so that a text with very many matches stays cheap.
    """
    steps = f"transform({found}, (m, i) -> cast(length({gaps}[i]) + if(i = 0, 0, length({found}[i - 1])) as bigint))"
    chunks = f"transform(sequence(0, (size({found}) - 1) div 256), b -> slice({steps}, b * 256 + 1, 256))"
    within = "aggregate(c, array(a.total), (s, x) -> concat(s, array(element_at(s, -1) + x)), s -> slice(s, 2, size(s) - 1))"
    return (
        f"if(size({found}) = 0, cast(array() as array<bigint>), aggregate({chunks}, "
        "named_struct('total', 0L, 'done', cast(array() as array<array<bigint>>)), "
        "(a, c) -> named_struct('total', a.total + aggregate(c, 0L, (s, x) -> s + x), "
        f"'done', concat(a.done, array({within}))), a -> flatten(a.done)))"
    )


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return (F.length(digits) <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _shape(match: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(match, "[0-9]", "9"), "[A-Za-z]+", "a")


def _candidate(kind: str, base: bool, match: Column, start: Column, before: Column, after: Column) -> Column:
    """One candidate: its span, the three votes (-1, 0, 1) and the classifier cell of each feature."""
    valid = _valid(kind, match) if base else F.lit(False)
    before, after = F.right(before, F.lit(40)), F.left(after, F.lit(20))
    around = F.concat(before, F.lit(" "), after)
    votes = [
        F.when(valid, 1).otherwise(-1 if base else 0),
        F.when(match.rlike(GAZETTEER[kind]), 1).otherwise(-1),
        F.when(F.right(before, F.lit(20)).rlike(CONTRARY), -1).when(around.rlike(CUES[kind]), 1).otherwise(0),
    ]
    seen = [
        _shape(match),
        F.least(F.length(match), F.lit(64)).cast("string"),
        _shape(F.right(before, F.lit(1))),
        _shape(F.left(after, F.lit(1))),
        F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1)),
    ]
    cells = [F.pmod(F.xxhash64(F.lit(j), x), F.lit(CELLS)).cast("int") for j, x in enumerate(seen)]
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        (valid if base else F.lit(False)).alias("base"),
        start.alias("start"),
        (start + F.length(match)).alias("end"),
        F.array(*votes).alias("votes"),
        F.array(*cells).alias("cells"),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """`docs` with the array `candidates` of each text."""
    scans = [(k, p, True) for k, p in BASE.items()] + [(k, p, False) for k, p in LOOSE.items()]
    own = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    needs = {"email": text.contains("@") | text.contains("(at)") | text.contains("[at]")}
    digit = text.rlike("[0-9]")
    none = F.array().cast("array<string>")
    f, g, s = (lambda i, c=c: f"_{c}{i}" for c in "fgs")
    rows = docs.select(
        *own,
        *(F.when(needs.get(k, digit), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none).alias(f(i)) for i, (k, p, _) in enumerate(scans)),
    )
    rows = rows.select(
        "*",
        *(F.when(F.size(f(i)) > 0, F.split(text, p, -1)).otherwise(none).alias(g(i)) for i, (_, p, _) in enumerate(scans)),
    )
    rows = rows.select("*", *(F.expr(_starts(f(i), g(i))).alias(s(i)) for i in range(len(scans))))

    def spans_of(i: int, kind: str, base: bool) -> Column:
        at = lambda column, n: F.get(F.col(column), n)
        return F.transform(
            F.col(f(i)),
            lambda m, n: _candidate(kind, base, m, at(s(i), n), at(g(i), n), at(g(i), n + 1)),
        )

    every = F.concat(*(spans_of(i, kind, base) for i, (kind, _, base) in enumerate(scans)))
    # A base match that fails its check is dropped, but its votes still teach the model.
    return rows.select(*own, every.alias("candidates"))


def reliabilities(counts: dict[tuple, int], rounds: int = 60) -> dict[tuple, float]:
    """Posterior of each (kind, votes) pattern by EM over the counts of the patterns.

    Labelers are independent given the truth; each has its own chances of a vote for real and for
    false candidates, which start from a mild belief that votes are right more often than not.
    """
    posterior = {}
    for kind in {k for k, *_ in counts}:
        own = {p[1:]: n for p, n in counts.items() if p[0] == kind}
        prior = 0.5
        chance = {(j, y, v): (0.6 if v == y else 0.25 if v == 0 else 0.15) for j, y, v in product(range(3), (1, -1), (-1, 0, 1))}
        for _ in range(rounds):
            held = {}
            for votes in own:
                real = prior * math.prod(chance[j, 1, v] for j, v in enumerate(votes))
                false = (1 - prior) * math.prod(chance[j, -1, v] for j, v in enumerate(votes))
                held[votes] = real / (real + false)
            total = {1: sum(n * held[v] for v, n in own.items()), -1: sum(n * (1 - held[v]) for v, n in own.items())}
            prior = min(0.99, max(0.01, (total[1] + 1) / (total[1] + total[-1] + 2)))
            for j, y, v in chance:
                part = sum(n * (held[p] if y == 1 else 1 - held[p]) for p, n in own.items() if p[j] == v)
                start = 0.6 if v == y else 0.25 if v == 0 else 0.15
                chance[j, y, v] = (part + 5 * start) / (total[y] + 5)
        posterior |= {(kind, *v): p for v, p in held.items()}
    return posterior


def train(found: DataFrame) -> list[float]:
    """Classifier weights from stored candidates: for each kind a prior, then one for each cell."""
    spans = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.base", "c.votes", "c.cells")
    counts = {
        (r.kind, *r.votes): r.n for r in spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    }  # at most 27 for each kind
    posterior = reliabilities(counts)
    cases = F.lit(0.0)
    for (kind, *votes), p in posterior.items():
        cases = F.when((F.col("kind") == kind) & (F.col("votes") == F.array(*map(F.lit, votes))), p).otherwise(cases)
    cells = (
        spans.select("kind", cases.alias("p"), F.posexplode("cells").alias("feature", "cell"))
        .groupBy("kind", "feature", "cell")
        .agg(F.sum("p").alias("real"), F.sum(1 - F.col("p")).alias("false"))
        .collect()
    )  # at most FEATURES * CELLS for each kind
    weights = [0.0] * (len(KINDS) * (1 + FEATURES * CELLS))
    totals = {k: [1.0, 1.0] for k in range(len(KINDS))}
    for r in cells:
        if r.feature == 0:
            totals[r.kind][0] += r.real
            totals[r.kind][1] += r.false
    for k, (real, false) in totals.items():
        weights[k] = math.log(real / false)
    for r in cells:
        real, false = totals[r.kind]
        at = len(KINDS) + (r.kind * FEATURES + r.feature) * CELLS + r.cell
        weights[at] = math.log((r.real + 1) / (real + CELLS)) - math.log((r.false + 1) / (false + CELLS))
    return weights


def decide(found: DataFrame, weights: list[float]) -> DataFrame:
    """Replace `candidates` by `spans`: (start, kind, end, base), sorted, kinds as numbers.

    A loose candidate joins if its odds are even or better and no base span overlaps it.
    """
    table = F.from_json(F.lit(json.dumps([round(w, 6) for w in weights])), "array<double>")

    def odds(c: Column) -> Column:
        first = c["kind"] * FEATURES
        return F.aggregate(
            F.transform(c["cells"], lambda cell, j: F.get(table, F.lit(len(KINDS)) + (first + j) * CELLS + cell)),
            F.get(table, c["kind"]),
            lambda a, x: a + x,
        )

    own = [c for c in found.columns if c != "candidates"]
    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"))
    rows = found.select(
        *own,
        F.transform(F.filter("candidates", lambda c: c["base"]), span).alias("_base"),
        F.transform(
            F.filter("candidates", lambda c: ~c["base"] & (F.element_at(c["votes"], 1) == 0) & (odds(c) >= 0)), span
        ).alias("_more"),
    )
    apart = F.filter(
        "_more", lambda m: ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )
    return rows.select(*own, F.array_sort(F.concat(F.col("_base"), apart)).alias("spans"))


def summarise(decided: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text."""
    names = F.array(*map(F.lit, KINDS))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k))
    listed = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    )
    return decided.select(
        "doc_id",
        *(count(k).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS)),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of all documents."""
    found = stored(candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text"), "pii")
    return decide(found, train(found))


def redact(docs: DataFrame, model: list[float]) -> DataFrame:
    """`docs` with each span of `text` replaced by its kind in angle brackets; nulls stay null."""
    rows = docs.select("text", F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    decided = decide(candidates(rows), model)
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    text = F.col("text")
    # Overlapping spans: the earlier one names the place, and what the later covers goes too.
    built = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("upto"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            F.when(
                s["start"] >= a["upto"],
                F.concat(
                    a["parts"],
                    F.array(
                        text.substr((a["upto"] + 1).cast("int"), (s["start"] - a["upto"]).cast("int")),
                        F.get(names, s["kind"]),
                    ),
                ),
            ).otherwise(a["parts"]).alias("parts"),
        ),
        lambda a: F.concat(F.array_join(a["parts"], ""), text.substr((a["upto"] + 1).cast("int"), F.length(text))),
    )
    clean = F.when(F.size("spans") > 0, built).otherwise(text)
    return decided.select(*((clean if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))
