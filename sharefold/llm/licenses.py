"""License scans by a positional index of rare words, with DataFrame functions only.

A template is a short licence text. Of every file, the licence words that are rarest in the corpus are looked up in
the templates' postings; postings that agree on where the template would start are an alignment; an alignment counts
when enough of the template's words and all its mandatory phrases stand in place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharefold.llm.common import with_settled
from sharefold.session import scratch_path
from sharefold.sinks import pin

# Fixed value: what separates words once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Of each template, so many of the file's rarest words are looked up; two of them (or all) must agree on the place.
LOOKUPS = 3
MIN_AGREEING = 2

# A template's number and a place in one number: places are below this.
START = 1 << 40


@dataclass(frozen=True)
class Template:
    """``text`` is found where at least ``share`` of its words and all ``phrases`` (of its words) stand in place."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    share: float = 1.0
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    def phrase_words(self) -> list[int]:
        """Places of the words that must stand."""
        needed: set[int] = set()
        for phrase in self.phrases:
            part = phrase.split()
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(part)] == part)
            needed.update(range(at, at + len(part)))
        return sorted(needed)


# Phrases of well-known licences.
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template("agpl", "affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use", "source and binary forms"), 0.75),
    Template("cc-by", "creative commons attribution"),
    Template("cc0", "creative commons zero"),
    Template("gpl-2", "gnu general public license version 2", ("general public license version 2",), 0.8),
    Template("gpl-3", "gnu general public license version 3", ("general public license version 3",), 0.8),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee"), 0.75),
    Template("lgpl", "lesser general public license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge"), 0.75),
    Template("mpl", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",), 0.75),
)


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, SEPARATORS), lambda w: w != "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def survey(docs: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """Per document: _doc, _row (hash of its text), n_words and which words of the vocabulary it has."""
    staged = docs.select(F.col(key).alias("_doc"), F.xxhash64(text).alias("_row"), F.explode(F.array(words_of(F.col(text)))).alias("w"))
    has = F.array_intersect("w", _strings(vocabulary))
    return staged.select("_doc", "_row", F.size("w").cast("bigint").alias("n_words"), has.alias("has"))


def rarity(surveyed: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of the vocabulary's words over all documents."""
    found = surveyed.select(F.explode("has").alias("word")).groupBy("word").count().collect()
    counts, n = {r[0]: r[1] for r in found}, surveyed.count()
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6 for w in vocabulary}


def alignments(docs: DataFrame, idf: dict[str, float], templates: tuple[Template, ...], key: str, text: str) -> DataFrame:
    """_doc, _row, t (number of the template), start, score: every place where a template stands."""
    vocabulary = sorted(idf)
    has = F.array_intersect("w", _strings(vocabulary))
    table = template_table(templates, idf)
    chosen = F.transform(
        table,
        lambda t: F.struct(t["t"].alias("t"), t["need"].alias("need"), F.filter(t["rarest"], lambda x: F.array_contains("has", x)).alias("words")),
    )
    chosen = F.transform(
        F.filter(chosen, lambda c: F.size(c["words"]) >= c["need"]),
        lambda c: F.struct(c["t"].alias("t"), F.slice(c["words"], 1, LOOKUPS).alias("words")),
    )
    postings = F.create_map(
        *[
            part
            for w in vocabulary
            for part in (
                F.lit(w),
                F.array(*[F.struct(F.lit(k).alias("t"), F.lit(i).alias("at")) for k, t in enumerate(templates) for i, x in enumerate(t.words) if x == w]),
            )
        ]
    )
    staged = docs.select(F.col(key).alias("_doc"), F.xxhash64(text).alias("_row"), F.explode(F.array(words_of(F.col(text)))).alias("w"))
    staged = with_settled(with_settled(staged, "has", has).where(F.size("has") > 0), "chosen", chosen)
    staged = staged.where(F.size("chosen") > 0)
    staged = with_settled(staged, "wanted", F.map_from_entries(F.transform("chosen", lambda c: F.struct(c["t"], c["words"]))))
    looked = F.array_distinct(F.flatten(F.col("chosen")["words"]))
    staged = with_settled(staged, "looked", looked)
    places = F.filter(
        F.transform("w", lambda x, i: F.when(F.array_contains("looked", x), F.struct(x.alias("word"), i.alias("pos")))), lambda h: h.isNotNull()
    )
    # A start is one number, template and place, since distinct numbers are hashed and distinct structs are not.
    starts = F.flatten(
        F.transform(
            places,
            lambda h: F.transform(
                F.filter(postings[h["word"]], lambda p: (h["pos"] >= p["at"]) & F.array_contains(F.col("wanted")[p["t"]], h["word"])),
                lambda p: p["t"].cast("bigint") * START + h["pos"] - p["at"],
            ),
        )
    )
    staged = with_settled(staged, "starts", F.array_distinct(starts))

    def aligned(code: Column) -> Column:
        """The template's number, its place, which of its words stand there and how many of the looked-up ones do."""
        t, start = F.floor(code / START).cast("int"), (code % START).cast("int")
        words = F.element_at(table, t + 1)["words"]
        stands = F.transform(words, lambda x, i: F.coalesce(F.get("w", start + i) == x, F.lit(False)))
        voting = F.transform(words, lambda x, i: F.array_contains(F.col("wanted")[t], x) & F.coalesce(F.get("w", start + i) == x, F.lit(False)))
        return F.struct(t.alias("t"), start.alias("start"), stands.alias("stands"), F.size(F.filter(voting, lambda v: v)).alias("votes"))

    # All of this is work on one text's own array: a row per alignment leaves it, and the words stay behind.
    found = staged.select("_doc", "_row", F.explode(F.transform("starts", aligned)).alias("a")).select("_doc", "_row", "a.*")
    placed = found.withColumn("own", F.element_at(table, F.col("t") + 1))
    mass = F.aggregate(
        F.arrays_zip("stands", F.col("own.idf").alias("idf")), F.lit(0.0), lambda s, x: s + F.when(x["stands"], x["idf"]).otherwise(F.lit(0.0))
    )
    total = F.aggregate(F.col("own.idf"), F.lit(0.0), lambda s, x: s + x)
    right = (
        (F.size(F.filter("stands", lambda x: x)) >= F.col("own.least"))
        & (F.col("votes") >= F.col("own.agree"))
        & F.forall(F.col("own.must"), lambda i: F.get("stands", i))
    )
    return placed.where(right).select("_doc", "_row", "t", "start", F.least(mass / total, F.lit(1.0)).alias("score"))


def template_table(templates: tuple[Template, ...], idf: dict[str, float]) -> Column:
    """The templates as one array of structs, in order; its size is that of the templates."""

    def row(k: int, t: Template) -> Column:
        distinct = sorted(set(t.words), key=lambda w: (-idf[w], w))
        must = F.array(*[F.lit(i) for i in t.phrase_words()]) if t.phrases else F.array().cast("array<int>")
        return F.struct(
            F.lit(k).alias("t"),
            _strings(t.words).alias("words"),
            _strings(distinct).alias("rarest"),
            F.array(*[F.lit(idf[w]) for w in t.words]).alias("idf"),
            must.alias("must"),
            F.lit(math.ceil(t.share * len(distinct) - 1e-9)).alias("need"),
            F.lit(math.ceil(t.share * len(t.words) - 1e-9)).alias("least"),
            F.lit(min(MIN_AGREEING, len(distinct))).alias("agree"),
        )

    return F.array(*[row(k, t) for k, t in enumerate(templates)])


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per document: the key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Places are words from 0. Base templates are found in all their places, ``n_base`` of them. ``labels`` are those of all
    templates found, distinct, sorted and joined by commas, '' for none; ``score`` is the best share of a template's
    rarity that stood in place, 0 for none. A null text counts as empty. Other columns are not read; a row that
    repeats another gets the same result.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    surveyed = pin(survey(docs, key, text, vocabulary), scratch_path(docs.sparkSession, "licence-words"))
    found = alignments(docs, rarity(surveyed, vocabulary), templates, key, text)
    base = F.col("t").isin([k for k, t in enumerate(templates) if t.base])
    name = F.element_at(_strings([t.label for t in templates]), F.col("t") + 1)
    per_file = found.groupBy("_doc", "_row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, name))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(name)), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    left, right = surveyed.alias("l"), per_file.alias("r")
    same = F.col("l._doc").eqNullSafe(F.col("r._doc")) & (F.col("l._row") == F.col("r._row"))
    return left.join(right, same, "left").select(
        F.col("l._doc").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
