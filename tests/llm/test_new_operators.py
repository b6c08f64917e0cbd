"""Toxicity, hard negatives and periodic runs: against brute force, on held-out texts and on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from fixtures import LONG, documents, empty, prose

from pyspark.sql import functions as F

from sharefold.llm import secrets
from sharefold.llm.chat import PART, format_turns, read_piece, unescape
from sharefold.llm.hard_negatives import Packing, mine_hard_negatives
from sharefold.llm.licenses import scan_licenses
from sharefold.llm.periodic import detect_runs, frequent_segments, kept_words, periodic_runs, word_numbers
from sharefold.llm.queries import QUERIES
from sharefold.llm.toxicity import STRETCH, NgramReader, fit_toxicity, score_toxicity


# Periodic runs


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if all(words[i] == words[i - p] for i in range(p, len(words))))


def brute_runs(words):
    """Every stretch between two places that differ at some lag, straight from the definition."""
    found = set()
    for q in range(1, len(words) // 2 + 1):
        start = 0
        while start + q < len(words):
            end = start + q
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - start >= max(12, 2 * q) and smallest_period(words[start:end]) == q:
                found.add((start, end - start, q))
            start = end - q + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_kept(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def test_runs_equal_brute_force():
    draw = random.Random(5)
    for k in range(400):
        words = []
        for _ in range(draw.randrange(1, 7)):
            root = [draw.choice("abc"[: 1 + k % 3]) for _ in range(draw.randrange(1, 9))]
            words += (root * draw.randrange(1, 9))[: draw.randrange(1, 40)] + [draw.choice("abcxyz") for _ in range(draw.randrange(3))]
        runs = periodic_runs(word_numbers([w.encode() for w in words]))
        assert runs == brute_runs(words)
        stay = kept_words(len(words), runs)
        assert [w for w, s in zip(words, stay, strict=True) if s] == brute_kept(words, runs)


def test_a_rare_word_splits_and_its_parts_are_split_again():
    #              x occurs once; left of it y and z occur once in their part and split that again
    words = ("a b " * 6 + "y " + "c d " * 7 + "x " + "y " + "e f " * 6).split()
    assert frequent_segments(word_numbers([w.encode() for w in words])) == [(0, 12), (13, 27), (29, 41)]


@pytest.mark.parametrize("words", [["a"] * 200_000, ["a", "b", "c"] * 50_000, (["a"] * 1000 + ["b"]) * 100, LONG.split()])
def test_long_texts_take_seconds(words):
    runs = periodic_runs(word_numbers([w.encode() for w in words]))
    assert all(n >= max(12, 2 * q) for _, n, q in runs)
    if words[-1] != LONG.split()[-1]:
        assert max(runs, key=lambda r: r[1])[1] == len(words)


def test_runs_of_odd_rows(spark):
    rows = detect_runs(documents(spark)).collect()
    assert len(rows) == 11 and detect_runs(empty(spark)).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1]._periodic.runs == [] and by_id[1]._periodic.collapsed == ""
    assert by_id[9]._periodic.collapsed == by_id[9].text
    with pytest.raises(ValueError):
        detect_runs(documents(spark), out="id")


def test_periodic_query_equals_brute_force(spark, tmp_path):
    texts = {i: prose(i, n) for i, n in enumerate([0, 1, 2, 3, 5, 13, 40, 77, 100, 150, 200] * 8)}
    texts |= {1000: None, 1001: "", 1002: " \t\n", 1003: "x y " * 30, 1004: "a b " * 20, 1005: "q " * 11}
    frame = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, start string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    planted = 0
    for i, text in texts.items():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        runs = brute_runs(words)
        row = found[i]
        assert row.n_runs == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == want
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(brute_kept(words, runs)).encode()).hexdigest()
    assert planted


# Hard negatives


@pytest.mark.parametrize("size,bound", [(1, 0), (1, 1), (64, 200), (64, 40), (300, 5000), (64, 1 << 27)])
def test_packed_products_are_exact(size, bound):
    draw = np.random.default_rng(size + bound)
    anchors, rows = (draw.integers(-bound, bound + 1, (n, size)) for n in (7, 11))
    anchors[0], rows[0], rows[1] = bound, bound, -bound
    packing = Packing(size, bound)
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, a, strict=True)) for a in anchors] for r in rows])
    assert (packing.scores(rows, packing.anchors(anchors), anchors.sum(axis=1)) == want).all()


def test_several_candidates_share_a_wide_integer():
    assert Packing(64, 160).fields == 2 and Packing(16, 8).fields > 3


def brute_negatives(rows, k=5, m=10):
    found = []
    score = lambda a, b: sum(int(np.floor(256.0 * x)) * int(np.floor(256.0 * y)) for x, y in zip(a[1], b[1], strict=False))
    for a in {(r[0], tuple(r[1]), r[2]) for r in rows if r[0] % 100 == 0}:
        others = [(score(a, r), r) for r in rows if r[0] != a[0]]
        near = sorted((-s, r[0]) for s, r in others if r[2] == a[2])[:k]
        for p, i in near:
            fits = sorted((-s, r[0]) for s, r in others if r[2] != a[2] and -30 * p <= 100 * s <= -90 * p)[:m]
            found += [(a[0], i, n, j, -p, -s) for n, (s, j) in enumerate(fits, 1)]
    return sorted(found)


def vectors(spark, rows):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], c, "s", 1, 2) for i, v, c in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, score string, rank int, at int")


@pytest.mark.parametrize("anchor_block", [4096, 3])
def test_negatives_equal_brute_force(spark, anchor_block):
    draw = np.random.default_rng(3)
    # Coarse components make many ties, and every eleventh row repeats the one before.
    rows = [(i, (draw.integers(-2, 9, 6) / 8).tolist(), int(draw.integers(0, 3))) for i in range(0, 1500, 3)]
    rows += [(i + 1, v, c) for i, v, c in rows[::11]] + [rows[7], rows[100]]
    found = mine_hard_negatives(vectors(spark, rows), spark_condition(), anchor_block=anchor_block).collect()
    assert sorted(tuple(r) for r in found) == brute_negatives(rows)
    assert len(found) > 200


def spark_condition():
    return F.col("vec_id") % 100 == 0


def test_negatives_of_odd_rows(spark):
    fine = [(0, [1, 1], 1), (1, [1, 0.9], 1), (2, [0.5, 0.2], 2), (3, [0.5, 0.2], 2), (5, [0.7], 3)]
    odd = [(None, [1, 1], 1), (100, None, 1), (200, [1, None], 1), (300, [float("nan"), 1], 1), (400, [float("inf"), 1], 2), (500, [1, 1], None)]
    found = mine_hard_negatives(vectors(spark, fine + odd), spark_condition()).collect()
    assert sorted(tuple(r) for r in found) == brute_negatives(fine) != []
    assert mine_hard_negatives(vectors(spark, []), spark_condition()).count() == 0
    assert mine_hard_negatives(vectors(spark, fine[1:]), spark_condition()).count() == 0
    assert mine_hard_negatives(vectors(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]), spark_condition()).count() == 1
    with pytest.raises(ValueError):
        mine_hard_negatives(vectors(spark, [(0, [1e30], 1)]), spark_condition())


# Toxicity


def toxic_corpus(spark, n=1200):
    draw = random.Random(1)
    rows = []
    for i in range(n):
        words = prose(i, 5 + i % 60).split()
        if i % 6 == 0:
            words.insert(draw.randrange(len(words)), draw.choice(["You Grumpkin", "skraelhead", "skraelfoot"]))
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    docs = spark.createDataFrame([(i, t, 5.0) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows if i % 4], "doc_id long, toxic int, quality int")
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity_holds_on_texts_it_has_not_seen(spark):
    docs, labels, truth = toxic_corpus(spark)
    scored = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    unseen = [(r._toxicity, truth[r.doc_id]) for r in scored if r.doc_id % 4 == 0]
    assert all((s >= 0.3) == bool(y) for s, y in unseen) and len(unseen) == 300
    assert all(0 <= r._toxicity <= 1 for r in scored)
    few = score_toxicity(docs, fit_toxicity(docs, labels, per_class=60)).collect()
    assert sum((r._toxicity >= 0.3) == bool(truth[r.doc_id]) for r in few) > 0.97 * len(few)


def test_toxicity_of_odd_rows(spark):
    docs, labels, _ = toxic_corpus(spark, 300)
    model = fit_toxicity(docs.unionByName(docs), labels.unionByName(labels))
    rows = score_toxicity(documents(spark), model).collect()
    assert len(rows) == 11 and {r.score for r in rows} == {"s"}
    by_id = {r.doc_id: r._toxicity for r in rows}
    assert by_id[1] == by_id[2] and all(0 <= s <= 1 for s in by_id.values())
    assert score_toxicity(empty(spark), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7), (999_999, 1)], "doc_id long, toxic int")
    assert max(r._toxicity for r in score_toxicity(docs, fit_toxicity(docs, odd)).collect()) < 1e-9
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r._toxicity for r in score_toxicity(docs, fit_toxicity(docs, one)).collect()} == {1.0}
    with pytest.raises(ValueError):
        score_toxicity(documents(spark), model, out="score")


def test_ngrams_over_the_border_of_two_stretches():
    text = "ab" * (STRETCH // 2) + "cde" + "fg" * 40
    whole = NgramReader()
    pieces = [text[i : i + 5] for i in range(STRETCH - 8, STRETCH + 3)]
    found = set(whole.read(text).tolist())
    assert all(set(whole.read(p).tolist()) <= found for p in pieces)
    assert whole.read("").size == 0 and whole.read("\ud800\ud800x").size


# License scans of long texts


def test_a_long_text_full_of_license_phrases(spark):
    texts = [(1, "mit license " * 10_000), (2, "the of in license " * 5_000 + "Apache License"), (3, prose(4, 40)), (4, "mit License, MIT license")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert (found[1].n_words, found[1].n_base, found[1].first_word, found[1].last_word) == (20_000, 10_000, 0, 19_998)
    assert (found[2].n_base, found[2].first_word, found[2].base_labels) == (1, 20_000, "apache")
    assert (found[3].n_base, found[3].first_word, found[3].labels) == (0, None, "")
    assert (found[4].n_base, found[4].base_labels, found[4].score) == (2, "mit", 1.0)


# Secret scans: what the network adds


def secret_texts(n=500):
    draw = random.Random(2)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    token = lambda k: "".join(draw.choice(signs) for _ in range(k))
    long_word = lambda: "".join(draw.choice(["stein", "berg", "haus", "wald", "bach", "land"]) for _ in range(4))
    rows, planted = [], {}
    for i in range(n):
        words = [*prose(i, 25).split(), long_word(), long_word()]
        draw.shuffle(words)
        if i % 5 == 0:
            secret = token(32)
            words.insert(9, secret)  # no pattern takes it: nothing names it
            planted[i] = secret
        else:
            words.insert(9, f"api_key={token(32)}")
        rows.append((i, " ".join(words)))
    return rows, planted


def test_the_network_adds_secrets_that_no_pattern_takes(spark):
    rows, planted = secret_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.fit_secret_net(docs)
    assert model.quality.recall >= 0.9 and model.quality.precision >= 0.9 and min(model.quality.findings, model.quality.others) > 50
    texts = dict(rows)
    added = {i: set() for i in texts}
    for r in docs.select("doc_id", secrets.secrets_column(model).alias("found")).collect():
        assert sum(s.kind_no == 1 for s in r.found) == (r.doc_id not in planted)
        added[r.doc_id] = {texts[r.doc_id][s.start : s.stop] for s in r.found if s.kind_no == 4}
        assert all(0 <= s.score <= 1 for s in r.found)
    right = sum(planted[i] in added[i] for i in planted)
    wrong = sum(len(a - {planted.get(i)}) for i, a in added.items())
    assert right >= 0.9 * len(planted) and wrong <= 0.1 * right


def test_the_network_learns_from_all_findings(spark):
    rows, _ = secret_texts(2600)  # of no more than 2000 documents once
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.fit_secret_net(docs, shard_windows=3000)
    # A finding to a document but for every fifth, each seen in its own surroundings and in others.
    held = docs.where(F.pmod(F.xxhash64(F.lit("held"), "text"), F.lit(4)) == 0)
    assert model.quality.findings == 2 * held.where("doc_id % 5 <> 0").count()
    assert model.quality.recall >= 0.95 and model.quality.precision >= 0.9
    again = secrets.fit_secret_net(docs.repartition(3, "text"), shard_windows=3000)
    assert (again.slope, again.offset, again.threshold) == (model.slope, model.offset, model.threshold)


def test_odds_that_repeat_can_be_counted():
    odds, truth, many = np.array([-2.0, -1.0, 0.5, 2.0]), np.array([0, 1, 0, 1]), np.array([5, 2, 3, 6])
    plain = secrets.platt(np.repeat(odds, many), np.repeat(truth, many))
    assert np.allclose(secrets.platt(odds, truth, many=many), plain)


def test_odds_are_calibrated():
    draw = np.random.default_rng(4)
    odds = draw.normal(0, 4, 4000)
    truth = (draw.random(4000) < 1 / (1 + np.exp(-(0.5 * odds - 1)))).astype(int)
    slope, offset = secrets.platt(odds, truth)
    assert abs(slope - 0.5) < 0.05 and abs(offset + 1) < 0.15
    far = np.array([-40.0] * 30 + [40.0] * 30)
    assert secrets.platt(far, (far > 0).astype(int))[0] > 0


def test_secrets_of_odd_rows(spark):
    assert secrets.fit_secret_net(empty(spark)) is None
    rows = documents(spark).select("doc_id", secrets.secrets_column(None).alias("found")).collect()
    assert len(rows) == 11 and all(r.found == [] for r in rows)


# Chat formatting: parts of all types, odd roles and columns


def test_typed_parts_become_placeholders(spark):
    parts = [
        ("text", "look: <image 1> ", None, None, None, None, None), ("image", None, "s3://a", 57, 28, None, None),
        ("audio", "ignored", "b.wav", None, None, 2.5, None), ("text", None, None, None, None, None, None),
        ("document", None, None, None, None, None, 3), ("image", None, "c", None, None, None, None), ("video", "a\\b", "d", 9, 9, None, None),
    ]
    rows = [(1, "user", parts, "b", "s"), (2, "assistant", [], "b", "s"), (3, None, None, "b", "s"), (4, "assistant", [parts[1], parts[0]], "b", "s")]
    turns = spark.createDataFrame(rows, f"turn long, role string, parts array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>, _body string, _seen string")
    done = format_turns(turns, F.col("parts"))
    assert done.columns == [*turns.columns, "_chat"] and {(r._body, r._seen) for r in done.collect()} == {("b", "s")}
    found = {r.turn: r._chat for r in done.collect()}
    assert found[1].piece == "<turn user>\nlook: \\limage 1> <image 1><audio 2><document 3><image 4>a\\\\b</turn>\n"
    assert [tuple(a) for a in found[1].attachments] == [(1, "image", "s3://a", 3), (2, "audio", "b.wav", 63), (3, "document", "", 1536), (4, "image", "c", 1)]
    assert (found[1].tokens, found[1].loss_chars, found[2].piece, found[3].piece) == (1603, 0, "<turn assistant>\n</turn>\n", "<turn >\n</turn>\n")
    start, long = found[4].loss_start, found[4].loss_chars
    assert found[4].piece[start : start + long] == "<image 1>look: \\limage 1> "
    with pytest.raises(ValueError):
        format_turns(done, F.col("parts"))


def test_any_role_and_text_are_read_back(spark):
    odd = ["", "a>\nb", "<turn x>\n", "\\g\\l\\\\", "</turn>\n", "\\", ">\n>", "\U0001f600<"]
    turns = spark.createDataFrame([(r, t) for r in odd for t in odd], "role string, text string")
    for r in format_turns(turns).collect():
        assert tuple(unescape(x) for x in read_piece(r._chat.piece)) == (r.role, r.text)
    assert format_turns(turns.where("false")).count() == 0
