"""One query per operator, over its whole table."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sharefold.llm import secrets
from sharefold.llm.bpe import share_tokenizer
from sharefold.llm.chat import format_turns, read_piece, unescape
from sharefold.llm.common import with_settled
from sharefold.llm.contamination import LEAST_WORDS, MASKS, MIN_SHARE, MIN_WORDS, SPAN, overlaps
from sharefold.llm.hard_negatives import mine_hard_negatives
from sharefold.llm.jaccard import jaccard_components
from sharefold.llm.language import fit_language_model, identify_languages
from sharefold.llm.licenses import scan_licenses
from sharefold.llm.line_dedup import dedup_lines
from sharefold.llm.periodic import detect_runs
from sharefold.llm.pii import KINDS, find_pii
from sharefold.llm.quality import COUNTS, judge, measure
from sharefold.llm.registry import QUERIES, SQL, query, table
from sharefold.llm.toxicity import fit_toxicity, score_toxicity
from sharefold.session import scratch_path
from sharefold.sinks import pin

__all__ = ["QUERIES", "SQL"]


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = fit_language_model(docs.where(~held_out))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "_language.lang_pred", "_language.score")


TOKENIZER = "byte_bpe_multi_50k.tiktoken"


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids never leave the task: one pass encodes, decodes and takes both digests."""
    tokenizer = share_tokenizer(spark, vocabulary or public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digests(texts: pa.Array) -> pa.Array:
        rows = []
        for start in range(0, len(texts), 256):
            ids, counts = tokenizer.value.encode(texts.slice(start, 256).to_pylist())
            for own in np.split(ids, np.cumsum(counts)[:-1]):
                packed = hashlib.sha256(own.astype("<u4").tobytes()).hexdigest()
                plain = hashlib.sha256(tokenizer.value.decode(own)).hexdigest()
                rows.append((len(own), packed, plain))
        names = ("n_tokens", "ids_sha256", "decoded_sha256")
        return pa.array([dict(zip(names, r, strict=True)) for r in rows], digest_type)

    digest_type = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    docs = table(spark, sf_dir, "documents").select("doc_id", digests("text").alias("d"))
    return docs.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


CHAT_RESULT = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
CHAT_KEYS = [n.split(" ")[0] for n in CHAT_RESULT.split(", ")]


def digest_conversations(batches):
    """Reads formatted turns back, sorted by conversation and place; a conversation is hashed as it streams by."""
    key, state = object(), None

    def row():
        turns, spoken, n, chars, formatted = state
        return dict(zip(CHAT_KEYS, (key, n, turns.hexdigest(), chars, spoken.hexdigest(), formatted), strict=True))

    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in CHAT_KEYS])
    for batch in batches:
        done = []
        for conv, piece, start, long in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or conv != key:
                if state is not None:
                    done.append(row())
                key, state = conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
            role, body = read_piece(piece)
            state[0].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
            if long:
                said = unescape(piece[start : start + long])
                state[1].update(said.encode())
                state[3] += len(said)
            state[2] += 1
            state[4] += len(piece)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([row()], schema)


@query()
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    columns = ("conv_id", "turn", "role", "text")
    turns = table(spark, sf_dir, "conversations").select(*columns).union(extra.select(*columns))
    pieces = format_turns(turns).select(*columns, "_chat.piece", "_chat.loss_start", "_chat.loss_chars")
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return ordered.select("conv_id", "piece", "loss_start", "loss_chars").mapInArrow(digest_conversations, CHAT_RESULT)


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
v AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM (SELECT doc_id, i, unnest(range(8)) AS o FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
m AS (SELECT doc_id, sum(c - 1) AS n FROM (SELECT doc_id, line, count(*) AS c FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
c AS (SELECT d.doc_id, nullif(source, '') AS host, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(m.n, 0)::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN m ON d.doc_id = m.doc_id LEFT JOIN v ON d.doc_id = v.doc_id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        10 * n_symbols > n_words OR 2 * n_dup_lines > greatest(n_words / 20, 1)
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words AS other_failed FROM c),
h AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed OR other_failed) AS k FROM f WHERE host IS NOT NULL GROUP BY host),
s AS (SELECT sum(k) / sum(n) AS mean, sum(n * (k / n) * (k / n)) / sum(n) AS square, count(*) / sum(n) AS noise FROM h),
p AS (SELECT mean, least(greatest(mean * (1 - mean) / greatest(square - mean * mean - mean * (1 - mean) * noise, 1e-6) - 1, 2), 10000) AS weight FROM s),
o AS (SELECT host, (k + (SELECT mean * weight FROM p)) / (n + (SELECT weight FROM p)) <= 0.5 AS ok FROM h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, TRUE) AS kept
FROM f LEFT JOIN o ON f.host = o.host
"""


@query(QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    counted = pin(measure(docs), scratch_path(spark, "quality"))
    return judge(counted).select("doc_id", *COUNTS, "base_failed", "kept")


def contamination_sql() -> str:
    """The same overlaps over the words themselves, a mask at a time."""
    joins = " UNION ALL ".join(
        f"SELECT d.doc_id, d.w AS dw, d.p AS dp, i.item_id, i.w AS iw, i.p AS ip, {SPAN} AS span FROM dp d JOIN ip i ON "
        + " AND ".join(f"d.w[d.p + {o}] = i.w[i.p + {o}]" for o in mask)
        for mask in MASKS
    )
    share = ", ".join(
        f"CASE WHEN {s} <= least({MIN_WORDS}, len(iw)) - span THEN list_sum(list_transform(range(0, least({MIN_WORDS}, len(iw))), "
        f"lambda k: CASE WHEN dp - {s} + k > 0 AND ip - {s} + k > 0 AND dw[dp - {s} + k] = iw[ip - {s} + k] THEN 1 ELSE 0 END)) ELSE 0 END"
        for s in range(MIN_WORDS - SPAN + 1)
    )
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents), i AS (SELECT item_id, {words} AS w FROM benchmark),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) - {SPAN - 2})) AS p FROM d),
ip AS (SELECT item_id, w, unnest(range(1, len(w) - {SPAN - 2})) AS p FROM i),
sp AS (SELECT doc_id, w, unnest(range(1, len(w) - {LEAST_WORDS - 2})) AS p FROM d),
si AS (SELECT item_id, w FROM i WHERE len(w) >= {LEAST_WORDS} AND len(w) < {SPAN}),
hits AS ({joins} UNION ALL
  SELECT doc_id, sp.w, sp.p, item_id, si.w, 1, len(si.w) FROM sp JOIN si ON sp.w[sp.p] = si.w[1] AND sp.w[sp.p:sp.p + len(si.w) - 1] = si.w),
judged AS (SELECT doc_id, item_id, dp, span, greatest({share}) / least({MIN_WORDS}, len(iw))::DOUBLE AS share FROM hits)
SELECT doc_id, item_id, count(*)::BIGINT AS n_seeds, max(share) AS similarity, (min(dp) - 1)::BIGINT AS first_word,
  (max(dp + span) - 2)::BIGINT AS last_word FROM judged WHERE share >= {MIN_SHARE} GROUP BY doc_id, item_id"""


@query(contamination_sql())
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return overlaps(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query()
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", F.col("_removed").alias("n_removed"), "text")


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT a AS x, a AS y FROM l UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, coalesce(min(r.y), s.doc_id) AS component_id
FROM s LEFT JOIN r ON s.doc_id = r.x GROUP BY s.doc_id, s.s
"""


@query(JACCARD_SQL)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def joined_spans(found: Column, kinds: Column) -> Column:
    """kind:start:end of spans in their order, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"]), s["start"], s["stop"])), ",")


def count_spans(found: Column, kind_no: int) -> Column:
    return F.size(F.filter(found, lambda s: s["kind_no"] == kind_no)).cast("bigint")


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    base = F.filter("found", lambda s: s["base"])
    counts = [count_spans(base, k + 1).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    digest = F.sha2(joined_spans(base, kinds), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined_spans(F.col("found"), kinds).alias("spans"))


@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.fit_secret_net(docs)
    found = docs.select("doc_id", F.explode(F.array(secrets.secrets_column(model))).alias("found"))
    kinds = F.array(*[F.lit(k) for k in secrets.KINDS])
    base = F.filter("found", lambda s: s["kind_no"] < len(secrets.KINDS))
    counts = [count_spans(F.col("found"), k + 1).alias(f"n_{kind}") for k, kind in enumerate(secrets.KINDS[:-1])]
    digest = F.sha2(joined_spans(base, kinds), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined_spans(F.col("found"), kinds).alias("spans"))


# From this score on a document counts as toxic.
TOXIC_FROM = 0.3


@query()
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = fit_toxicity(docs.where(~held_out), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), F.col("_toxicity").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.c, b.c)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query(NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def with_planted_period(docs: DataFrame) -> DataFrame:
    """Every tenth text, by its number's hash, repeats a stretch of its own words from some word on."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = F.coalesce(code % 10 == 0, F.lit(False))
    split = with_settled(docs, "_words", F.when(chosen, words))
    n, g = F.size("_words"), F.floor(code / 10)
    a = F.try_mod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeats = F.array_repeat(F.slice("_words", a + 1, p), F.ceil((n - a) / p).cast("int"))
    periodic = F.concat(F.slice("_words", F.lit(1), a), F.slice(F.flatten(repeats), F.lit(1), n - a))
    return split.withColumn("text", F.when(n > 0, F.array_join(periodic, " ")).otherwise(F.col("text"))).drop("_words")


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_period(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = with_settled(detect_runs(docs).select("doc_id", "_periodic"), "r", F.col("_periodic"))
    runs = F.col("r.runs")
    longest = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length = -longest["l"]
    return found.select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        longest["s"].alias("start"),
        length.alias("length"),
        longest["p"].alias("period"),
        F.floor(1000 * length / longest["p"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("r.collapsed"), 256).alias("collapsed_sha256"),
    )
