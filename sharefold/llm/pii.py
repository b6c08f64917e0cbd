"""PII by weak supervision, with DataFrame functions only.

Strict patterns find the base spans, loose patterns further candidates. Labelers (patterns, gazetteers, context words)
vote on every candidate. Expectation-maximisation over the vote patterns estimates how reliable each labeler is, and
its posteriors train a logistic span classifier, which decides on candidates that no strict pattern holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharefold.llm.common import with_settled
from sharefold.session import scratch_path
from sharefold.sinks import pin

KINDS = ("email", "ip", "card", "phone")

# The strict patterns. Possessive forms match as the plain ones would, without deep recursion; where a match
# cannot start inside a run of its first characters, a look-behind spares the tries.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms of the same kinds.
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\s?[\[(]\s?at\s?[\])]\s?[A-Za-z0-9-]{1,64}+(?:\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[A-Za-z0-9-]{1,64}+)+",
    "phone": r"(?<![A-Za-z0-9+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![A-Za-z0-9-]|[\x20.][0-9])",
}
# A text without a match of its gate cannot match, and the gate is cheap.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
LOOSE_GATES = {"email": r"(?i)[\[(]\s?at\s?[\])]", "phone": r"[0-9][\x20.-][0-9]{3,4}[\x20.-][0-9]{3}"}

# Gazetteers of top-level domains, calling codes and card issuers, and context words.
DOMAINS = r"(?i)(?:\.|dot[\])]\s?)(?:com|net|org|edu|gov|info|io|de|fr|es|it|uk|us|ch|at|eu)$"
CALLING = r"^\+?(?:1|7|20|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[126]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
NEAR = {
    "email": r"(?i)\b(?:e-?mail|contact|write|reach|courriel|correo)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|carte|tarjeta|karte)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell|whatsapp|telefon|tfno)\b",
}
AGAINST = r"(?i)\b(?:isbn|issn|order|invoice|version|item|page|pages|serial|doi|article|section|no)\b[^\n]{0,6}$"

CONTEXT = 40
LABELERS = ("strict", "valid", "listed", "near", "against", "embedded")


def spans(text: Column, kind: str, loose: bool) -> Column:
    """Matches of one pattern with the text before and after: array<struct<kind, loose, gap, found, before, after>>.

    Splitting and extracting walk the same matches, so the lengths of pieces and matches give the places.
    """
    pattern, gate = (LOOSE[kind], LOOSE_GATES[kind]) if loose else (STRICT[kind], GATES[kind])
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("f"), pieces.alias("p"), F.slice(pieces, 2, 2_000_000_000).alias("q")),
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            F.lit(loose).alias("loose"),
            F.length(x["p"]).alias("gap"),
            x["f"].alias("found"),
            F.right(x["p"], F.lit(CONTEXT)).alias("before"),
            F.left(x["q"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,loose:boolean,gap:int,found:string,before:string,after:string>>")
    return F.when(text.rlike(gate), F.filter(rows, lambda r: r["found"].isNotNull())).otherwise(none)


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        double = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per match, and one with null kind for a document without: _doc, _row, kind, loose, start, stop, found,
    passes, before, after. ``_row`` tells rows apart and holds for the written table only."""
    staged = docs.select(F.col(key).alias("_doc"), F.monotonically_increasing_id().alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    parts = [(k, False) for k in KINDS] + [(k, True) for k in LOOSE]
    every = F.concat(*[spans(F.col("_text"), k, loose) for k, loose in parts])
    rows = with_settled(staged, "matches", every).select("_doc", "_row", F.posexplode_outer("matches").alias("at", "m"))
    rows = rows.select("_doc", "_row", "at", "m.*")
    until = Window.partitionBy("_row", "kind", "loose").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("found")).over(until).cast("bigint")
    placed = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("found"))
    digits = F.regexp_replace("found", "[^0-9]", "")
    many = F.length(digits)
    octets = F.forall(F.split("found", r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        F.split("found", r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255
    )
    passes = (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", octets)
        .when(F.col("kind") == "card", many.between(12, 19) & luhn(F.when(many.between(12, 19), digits).otherwise(F.lit("1"))))
        .otherwise(many.between(9, 15))
    )
    return placed.withColumn("passes", passes).select("_doc", "_row", "kind", "loose", "start", "stop", "found", "passes", "before", "after")


def votes(rows: DataFrame) -> DataFrame:
    """``rows`` with a column per labeler: 1 for personal data, -1 against, 0 where it does not say."""
    kind = F.col("kind")
    listed = (
        F.when(kind == "email", F.col("found").rlike(DOMAINS))
        .when(kind == "phone", F.col("found").rlike(CALLING))
        .when(kind == "card", F.col("found").rlike(ISSUERS))
        .otherwise(~F.col("found").rlike(r"^(?:0|127|255)\."))
    )
    near = F.lit(False)
    for k, words in NEAR.items():
        near = near | ((kind == k) & F.col("before").rlike(words))
    touching = F.col("before").rlike(r"[\p{L}\p{N}]$") | F.col("after").rlike(r"^[\p{L}\p{N}]")
    say = {
        "strict": F.when(F.col("loose"), 0).when(F.col("passes"), 1).otherwise(-1),
        "valid": F.when(F.col("passes"), 1).otherwise(-1),
        "listed": F.when(listed, 1).otherwise(-1),
        "near": F.when(near, 1).otherwise(0),
        "against": F.when(F.col("before").rlike(AGAINST), -1).otherwise(0),
        "embedded": F.when(touching, -1).otherwise(0),
    }
    return rows.withColumns({n: F.coalesce(c, F.lit(0)).cast("int") for n, c in say.items()})


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[float, dict, list[float]]:
    """Expectation-maximisation on counted vote patterns: the share of true spans, each labeler's vote probabilities
    given truth, and the posterior of each pattern. A vote's meaning is fixed by the start: the majority is right."""
    width = len(LABELERS)
    post = [min(0.9, max(0.1, 0.5 + 0.4 * sum(v) / width)) for v, _ in patterns]
    prior, says = 0.5, {}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        true = sum(p * n for p, (_, n) in zip(post, patterns, strict=True))
        prior = min(0.99, max(0.01, true / total))
        for j in range(width):
            for vote in (-1, 0, 1):
                yes = sum(p * n for p, (v, n) in zip(post, patterns, strict=True) if v[j] == vote)
                no = sum((1 - p) * n for p, (v, n) in zip(post, patterns, strict=True) if v[j] == vote)
                says[j, vote] = ((yes + 1) / (true + 3), (no + 1) / (total - true + 3))
        post = []
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(says[j, v[j]][0] / says[j, v[j]][1]) for j in range(width))
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return prior, says, post


FEATURES = ("bias", *(f"{n}{s}" for n in LABELERS for s in ("+", "-")))


def features(vote: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(v == s) for v in vote for s in (1, -1))]


def fit_classifier(patterns: list[tuple[tuple[int, ...], int]], post: list[float], rounds: int = 400, rate: float = 0.5) -> list[float]:
    """Logistic regression on the posteriors, weighted by count, with a little ridge."""
    weights = [0.0] * len(FEATURES)
    rows = [(features(v), n, p) for (v, n), p in zip(patterns, post, strict=True)]
    total = sum(n for _, n, _ in rows)
    for _ in range(rounds):
        slope = [0.001 * w for w in weights]
        for x, n, p in rows:
            guess = 1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, x, strict=True))))
            for i, a in enumerate(x):
                slope[i] += a * n * (guess - p) / total
        weights = [w - rate * s for w, s in zip(weights, slope, strict=True)]
    return weights


def classified(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``rows`` with ``p``, ``base`` and ``taken``, whether the span is to be reported. Pass a written table.

    At most 3**6 vote patterns come to the driver, whatever the data.
    """
    counted = rows.where("kind is not null").groupBy(*LABELERS).count().collect()
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in counted)
    weights = [0.0] * len(FEATURES)
    if patterns:
        _, _, post = reliabilities(patterns)
        weights = fit_classifier(patterns, post)
    score = F.lit(weights[0])
    for i, name in enumerate(LABELERS):
        score = score + F.when(F.col(name) == 1, weights[1 + 2 * i]).when(F.col(name) == -1, weights[2 + 2 * i]).otherwise(0.0)
    base = ~F.col("loose") & F.col("passes")
    p = 1 / (1 + F.exp(-score))
    # Only loose candidates need the classifier: a strict match that fails its check is no personal data.
    taken = base | (F.col("loose") & F.col("passes") & (p > threshold))
    return rows.withColumns({"p": p, "base": base, "taken": F.coalesce(taken, F.lit(False))})


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per document: the key and ``found``, array<struct<start, kind_no, stop, base, p>> ordered by start and kind.

    Places are code points, the end exclusive. Base spans are all strict matches that pass their checks. A further
    span has the kind of its loose pattern and overlaps no base span. A null text counts as empty; without candidates
    nothing is learned and nothing added. Rows that repeat are searched each for itself.
    """
    spark = docs.sparkSession
    rows = pin(votes(candidates(docs, key, text)), scratch_path(spark, "pii"))
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct("start", number.alias("kind_no"), "stop", "base", "p")
    per_doc = classified(rows, threshold).groupBy("_doc", "_row").agg(F.collect_list(F.when(F.col("taken"), span)).alias("all"))
    base = F.filter("all", lambda s: s["base"])
    clear = F.filter("all", lambda s: s["base"] | ~F.exists(F.col("b"), lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return with_settled(per_doc, "b", base).select(F.col("_doc").alias(key), F.array_sort(clear).alias("found"))
