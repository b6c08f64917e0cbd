"""Line dedup, decontamination, Jaccard components and the pipeline against brute force and on odd rows."""

import random

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from fixtures import ODD, documents, empty, prose
from pyspark.sql import functions as F

from sharefold.llm.components import components
from sharefold.llm.contamination import decontaminate, overlaps
from sharefold.llm.jaccard import dealt_lists, jaccard_components, keep_one_of_each
from sharefold.llm.line_dedup import dedup_lines
from sharefold.llm.shingles import least_apart, parity


def lines(seed, n, least=3, most=40):
    draw = random.Random(seed)
    return [prose(seed * 1000 + i, draw.randrange(least, most)) for i in range(n)]


def corpus(seed=1, n=30):
    """Documents of lines, some with passages of others, repeats within, single lines shared and blank lines."""
    draw = random.Random(seed)
    shared = [lines(900 + k, draw.randrange(1, 8)) for k in range(6)]
    common = prose(5, 6)
    rows = []
    for i in range(n):
        own = lines(seed * 100 + i, draw.randrange(1, 8))
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(own) + 1)
            part = draw.choice(shared)
            own[at:at] = part[draw.randrange(len(part)) :]
        if draw.random() < 0.5:
            own.insert(draw.randrange(len(own) + 1), draw.choice([common, "", "  "]))
        rows.append((i, "\n".join(own), "en", "h"))
    return rows


def removed_lines(rows, least=50):
    """Brute force of line dedup, from the definition: every run of whole lines with enough words, wherever it starts and
    ends, goes when the same run stands at an earlier place that it does not overlap."""
    seqs = {i: [(k, t, len(t.split())) for k, t in enumerate((text or "").split("\n")) if t.split()] for i, text, *_ in rows}
    first, gone = {}, {i: set() for i in seqs}
    for i, seq in sorted(seqs.items()):
        for start in range(len(seq)):
            for end in range(start + 1, len(seq) + 1):
                if sum(x[2] for x in seq[start:end]) >= least:
                    run = tuple(x[1] for x in seq[start:end])
                    j, stop = first.setdefault(run, (i, end))
                    if j != i or start >= stop:
                        gone[i].update(x[0] for x in seq[start:end])
    return gone


@pytest.mark.parametrize("seed", [3, 4])
def test_lines_equal_brute_force(spark, seed):
    rows = corpus(seed, 40)
    rows.append((100, "\n".join([prose(1, 10)] * 30 + ["", *lines(8, 2)] + [prose(1, 10)] * 3), "en", "h"))
    gone = removed_lines(rows)
    assert sum(map(len, gone.values())) > 10
    for r in dedup_lines(documents(spark, rows)).collect():
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        kept = [t for k, t in enumerate(text.split("\n")) if k not in gone[r.doc_id]]
        assert r.text == "\n".join(kept) and r._removed == len(gone[r.doc_id])


def test_repeated_passage_goes_and_short_lines_stay(spark):
    passage = lines(77, 3, 25, 30)
    a = "\n".join(["start here", *passage, "the end"])
    b = "\n".join([*lines(5, 2), *passage, "the end", "more"])
    rows = [(1, a, "en", "h"), (2, b, "en", "h"), (3, "the end\nstart here", "en", "h")]
    found = {r.doc_id: r.text for r in dedup_lines(documents(spark, rows)).collect()}
    assert found[1] == a and found[3] == "the end\nstart here"
    assert found[2].split("\n") == [*lines(5, 2), "more"]


def test_a_repeat_whose_line_stood_elsewhere_before(spark):
    """The longest line stands in other surroundings first; the run around it is still a repeat of the second text's."""
    line, before, after = prose(60, 30), prose(61, 12), prose(62, 12)
    run = [before, line, after]
    rows = [(1, "\n".join([prose(63, 9), line, prose(64, 9)]), "en", "h"), (2, "\n".join(run), "en", "h"), (3, "\n".join([*run, prose(65, 9)]), "en", "h")]
    found = {r.doc_id: r for r in dedup_lines(documents(spark, rows)).collect()}
    assert [found[i]._removed for i in (1, 2, 3)] == [0, 0, 3] and found[3].text == prose(65, 9)


def test_lines_of_odd_rows(spark):
    docs = documents(spark)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "_removed"] and found.count() == docs.count()
    by_key = {r.doc_id: r for r in found.collect()}
    assert by_key[6]._removed == 1 and by_key[6].text == "" and by_key[5]._removed == 0
    assert by_key[1].text is None and by_key[7]._removed == 0 and by_key[None]._removed == 0
    assert dedup_lines(empty(spark)).count() == 0


def test_every_placing_of_two_substitutions_is_found(spark):
    """A passage of 13 words of an item, in other surroundings, with two of its words replaced in every way."""
    item = prose(21, 40).split()
    rows = []
    for a in range(13):
        for b in range(a + 1, 13):
            part = [w if k not in (a, b) else f"other{k}" for k, w in enumerate(item[11:24])]
            rows.append((len(rows), f"{prose(22, 20)} {' '.join(part)} {prose(23, 20)}", "en", "h"))
    clean = [(1000 + i, prose(500 + i, 60), "en", "h") for i in range(20)]
    items = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in overlaps(documents(spark, rows + clean), items).collect()} == set(range(78))


def test_short_items_are_found_word_for_word(spark):
    sizes = range(1, 13)
    items = spark.createDataFrame([(n, prose(30 + n, n)) for n in sizes], "item_id long, text string")
    rows = [(n, f"{prose(50, 9)} {prose(30 + n, n).upper()} {prose(51, 9)}", "en", "h") for n in sizes]
    rows += [(100 + n, f"{prose(50, 9)} {' '.join(prose(30 + n, n).split()[:-1])} {prose(51, 9)}", "en", "h") for n in range(2, 8)]
    found = {(r.doc_id, r.item_id): r for r in overlaps(documents(spark, rows), items).collect()}
    assert set(found) == {(n, n) for n in range(5, 13)}
    assert all((r.similarity, r.first_word, r.last_word) == (1.0, 9, 8 + n) for (n, _), r in found.items())


def test_overlaps_tolerate_substitutions(spark):
    item = prose(11, 30).split()
    changed = [w if k not in (6, 17) else "other" for k, w in enumerate(item)]
    rows = [
        (1, f"{prose(12, 50)} {' '.join(item)} {prose(13, 20)}", "en", "h"),
        (2, f"{prose(14, 50)} {' '.join(changed).upper()}", "en", "h"),
        (3, prose(15, 200), "en", "h"),
        (4, " ".join(item[:10]), "en", "h"),
    ]
    items = spark.createDataFrame([(5, " ".join(item)), (6, None), (7, ""), (8, "short one"), (5, " ".join(item))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in overlaps(documents(spark, rows), items).collect()}
    assert set(found) == {(1, 5), (2, 5)}
    assert found[1, 5].similarity == 1.0 and (found[1, 5].first_word, found[1, 5].last_word) == (50, 79)
    assert {r.doc_id for r in decontaminate(documents(spark, rows), items).collect()} == {3, 4}


def test_a_full_filter_changes_nothing(spark):
    items = spark.createDataFrame([(1, prose(1, 40))], "item_id long, text string")
    small, large = (overlaps(documents(spark), items, filter_bits=b).collect() for b in (7, 23))
    assert small and sorted(small) == sorted(large)


def test_contamination_of_odd_rows(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    left = decontaminate(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 1
    assert left.where("doc_id is null").count() == 0
    assert decontaminate(docs, items.limit(0)).count() == docs.count()
    assert decontaminate(empty(spark), items).count() == 0


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def near_copies(seed=1):
    draw = random.Random(seed)
    rows = []
    for group in range(12):
        base = prose(seed * 50 + group, draw.choice([3, 5, 9, 40, 150, 400])).split()
        for _ in range(draw.choice([1, 2, 5, 12])):
            own = list(base)
            for _ in range(draw.randrange(1 + len(own) // 25)):
                own[draw.randrange(len(own))] = f"new{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(own), "en", "h"))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 3)])
def test_components_equal_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr("sharefold.llm.jaccard.BLOCK", block)
    rows = near_copies(seed)
    sets = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = {r.doc_id: r for r in jaccard_components(documents(spark, rows)).collect()}
    assert {i: r.component_id for i, r in found.items()} == {i: find(i) for i in sets}
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert len({find(i) for i in sets}) < len(sets)


def test_jaccard_of_odd_rows(spark):
    docs = documents(spark)
    found = jaccard_components(docs).collect()
    assert len(found) == docs.count()
    by_key = {r.doc_id: r for r in found}
    assert by_key[6].component_id == 5 and by_key[1].component_id == 1 and by_key[2].component_id == 2
    assert by_key[1].n_shingles == by_key[3].n_shingles == 0 and by_key[4].n_shingles == 1
    assert keep_one_of_each(docs).columns == docs.columns
    assert keep_one_of_each(docs).count() == docs.count() - 1
    assert jaccard_components(empty(spark)).count() == 0


def test_texts_that_share_a_key_keep_their_links(spark):
    a, b = prose(31, 90), prose(32, 90)
    rows = [(1, a, "en", "h"), (1, b, "en", "h"), (1, b, "en", "h"), (2, "begin " + a, "en", "h"), (3, "begin " + b, "en", "h")]
    found = jaccard_components(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1)]
    assert sorted(r.doc_id for r in keep_one_of_each(documents(spark, rows)).collect()) == [1, 1, 1]


def test_blocks_that_cannot_link_are_not_dealt(spark, monkeypatch):
    """A list of sets of two sizes far apart: no walk holds both, and members already connected meet nobody."""
    monkeypatch.setattr("sharefold.llm.jaccard.BLOCK", 4)
    small = [(9, 40, i, 100, i % 3, i, 100, -1) for i in range(20)]
    large = [(9, 40, i, 400, 2, i if i < 30 else 30, 400, -1) for i in range(20, 40)]
    lists = spark.createDataFrame(small + large, "shingle long, many long, id long, n int, place int, comp long, pivot_n long, with_pivot int")
    rows = dealt_lists(lists, 85).collect()
    walks = {}
    for r in rows:
        walks.setdefault((r.i, r.j), set()).add(r.id)
    assert all(len({i < 20 for i in ids}) == 1 for ids in walks.values())
    pairs = {(x, y) for ids in walks.values() for x in ids for y in ids if x < y}
    apart = {(x, y) for x in range(40) for y in range(40) if x < y and (y < 20 or 20 <= x < 30)}
    assert apart <= pairs and len(rows) < 40 * 10


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (90, 100)], "a long, b long")
    found = {r.id: r.comp for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components(links.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    item = prose(500, 30)
    extra = [(20, "start " + item, "en", "h"), (21, "12345 67890 !!", None, "h"), (22, prose(1, 80).replace("alpha", "alfa", 1), "en", "h")]
    docs = documents(spark, [*ODD, *extra]).select("doc_id", "text", "lang", "source", "n_chars", "score")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs.columns, stage(spark, docs, str(tmp_path))
        left[name] = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str)
        if name != "byte_bpe":
            assert docs.columns == before
    assert not {1, 2, 3, 21} & set(left["language_id"]) and {5, 6, 7, 8, None, 20} <= set(left["language_id"])
    assert 6 not in left["line_dedup"] and 22 in left["line_dedup"]
    assert 22 not in left["near_duplicates"] and 20 in left["near_duplicates"]
    assert 20 not in left["decontamination"] and {5, 7, 9, None} <= set(left["decontamination"])
    assert left["byte_bpe"] == left["decontamination"]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id for r in run.collect()), key=str) == left["byte_bpe"]
    assert all(len(r.ids) == r.n_tokens for r in run.collect())


def test_pipeline_of_nothing(spark, tmp_path):
    nothing = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_native_operators_run_no_python(spark):
    items = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    from sharefold.llm.licenses import scan_licenses
    from sharefold.llm.pii import find_pii

    for df in (overlaps(documents(spark), items), dedup_lines(documents(spark)), scan_licenses(documents(spark)), find_pii(documents(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_python_tasks_of_the_pipeline_take_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        docs = spark.createDataFrame([(i, prose(i, 10) * 3000, "en" if i % 2 else None) for i in range(60)], "doc_id long, text string, lang string")
        corpus_pipeline.language_id(spark, docs, "")
        one = docs.coalesce(1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long")
        sizes = [r["size"] for r in one.collect()]
        assert sum(sizes) > 8 << 20 and max(sizes) < 5 << 20
    finally:
        spark.conf.set(name, before)


def test_jaccard_sets_are_made_without_a_join(spark, monkeypatch):
    from sharefold.llm import jaccard

    plans, pin = [], jaccard.pin

    def noted(df, path):
        if "/sets-" in path:
            lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
            # Subqueries hang on lines that a colon leads in.
            plans.append([line for line in lines if ":" not in line[: len(line) - len(line.lstrip(" :+-"))]])
        return pin(df, path)

    monkeypatch.setattr(jaccard, "pin", noted)
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, "y " * 9)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert plans and not any("Join" in line for plan in plans for line in plan)


def test_parities_never_say_more_than_sets_differ():
    draw = np.random.default_rng(7)
    for n, m, both in [(0, 0, 0), (1, 1, 1), (6, 7, 6), (64, 65, 60), (500, 500, 0), (500, 430, 430), (3000, 90, 20), (5000, 5000, 4700)]:
        pool = np.unique(draw.integers(0, 2**64, n + m, np.uint64))
        pool = draw.permutation(pool)
        a, b = np.sort(pool[:n]), np.sort(pool[n - both : n - both + m])
        found = least_apart(parity(a), parity(b))
        assert found == least_apart(parity(b), parity(a)) <= n + m - 2 * both
        if both == 0 and n:
            assert found > 0.163 * (n + m)  # too far apart for a link


def test_sets_of_pairs_too_far_apart_are_not_made(spark, monkeypatch):
    """Each two documents share one passage: rare shingles of both, but far from a link."""
    from sharefold.llm import jaccard

    made, walked, pin = [], [], jaccard.pin

    def noted(df, path):
        out = pin(df, path)
        if "/sets-" in path:
            made.append(out.count())
        if "/pairs-" in path:
            walked.append(out.where("not sure").count())
        return out

    monkeypatch.setattr(jaccard, "pin", noted)
    passages = {(i, j): [f"p{i}x{j}x{k}" for k in range(60)] for i in range(8) for j in range(i + 1, 8)}
    texts = [" ".join(w for pair, words in passages.items() if i in pair for w in words) for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert found == {i: i for i in range(8)}
    assert walked[0] > 0 and sum(made) == 0


def test_entries_move_once_to_their_lists(spark, monkeypatch):
    from sharefold.llm import jaccard

    plans, pin = [], jaccard.pin

    def noted(df, path):
        if "/lists-" in path:
            plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(shingle"))
        assert "/heads-" not in path
        return pin(df, path)

    monkeypatch.setattr(jaccard, "pin", noted)
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, "y " * 9)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert plans == [1]
    listed = spark.createDataFrame([(5, 2, 9, 0), (5, 1, 9, 3), (6, 1, 9, 4), (7, 3, 8, 0), (7, 2, 9, 1), (7, 4, 9, 2)], "shingle long, id long, n int, place int")
    lists = jaccard.member_lists(listed).collect()
    assert sorted((r.shingle, r.id, r.n, r.place, r.many, r.pivot) for r in lists) == [
        (5, 1, 9, 3, 2, 1),
        (5, 2, 9, 0, 2, 1),
        (7, 2, 9, 1, 3, 2),
        (7, 3, 8, 0, 3, 2),
        (7, 4, 9, 2, 3, 2),
    ]
