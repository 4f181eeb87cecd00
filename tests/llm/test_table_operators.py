"""Operators that work on tables, against brute force on small fixtures with odd rows."""

import hashlib
import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwright.llm import _common, chat, decontamination, line_dedup, pii, quality, sharding, simhash_dedup, token_files
from tripwright.llm._common import connected_components

P = pytest.importorskip("public_tokenizers")

rng = random.Random(7)
WORDS = [f"w{k}" for k in range(400)]


def _text(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = _text(120)
DOCS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w1 ", "w2 ", 1)), (4, _text(90)), (5, None), (6, ""), (7, "short one"), (7, "short one"),
    (None, _text(60)), (8, "\n".join([_text(20), "A Line, that repeats!", _text(15)])),
    (9, "a line that repeats\n" + _text(30) + "\n\nA LINE that repeats."), (10, _text(3000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "src", 1, 2) for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, component_id int, slot int")


def _components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_connected_components(spark):
    n = 60
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(45)] + [(0, k) for k in range(40, 55)] + [(3, 3)]
    edges = spark.createDataFrame(links, "src bigint, dst bigint")
    want = _components(n, links)
    got = {r[0]: r[1] for r in connected_components(edges).collect()}
    assert all(got.get(k, k) == want[k] for k in range(n))
    assert connected_components(edges.where("src < 0")).count() == 0


def test_staged_tables_leave_no_shuffle_files(spark):
    kept = lambda: {str(b) for b in map(str, spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")) if "shuffle_" in b}
    before = kept()
    some = lambda k: spark.range(1000).where(f"id % 2 = {k}").groupBy((F.col("id") % 7).alias("x")).count()
    both = _common.stage_all(map(some, (0, 1)), "both")
    deadline = time.time() + 20
    while kept() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not kept() - before
    assert both.agg(F.sum("count")).first()[0] == 1000 and both.count() == 14
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    path = both._tripwright_path
    _common.unstage(both, _common.stage(spark.range(3).toDF("x"), "other"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_line_dedup_leaves_only_its_result(spark):
    shared = _common.shared_dir(spark).removeprefix("file:") + "/tripwright"
    there = lambda: {n.rsplit("-", 1)[0] for n in os.listdir(shared) if n not in before}
    os.makedirs(shared, exist_ok=True)
    before = set(os.listdir(shared))
    words = [" ".join(f"w{(k * 7 + j) % 50}x" for j in range(12)) for k in range(20)]
    docs = spark.createDataFrame([(k, w + ("" if k % 2 else " z")) for k, w in enumerate(words + words)], "doc_id long, text string")
    line_dedup.dedup_lines(docs)
    assert "removed" in there() and not there() - {"removed", "edges"}


def test_simhash_groups(docs):
    got = simhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(DOCS)
    prints = [simhash_dedup.fingerprint(t or "") for _, t in DOCS]
    links = [(a, b) for a in range(len(DOCS)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    label = _components(len(DOCS), links)
    want = []
    for k, (i, _) in enumerate(DOCS):
        ids = [DOCS[j][0] for j in range(len(DOCS)) if label[j] == label[k] and DOCS[j][0] is not None]
        want.append((i, prints[k] - (1 << 64) if prints[k] >> 63 else prints[k], min(ids, default=None)))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_simhash_links_are_all_found(spark):
    seeds = [rng.getrandbits(64) for _ in range(20)]
    prints = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for s in seeds for _ in range(12)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {tuple(sorted(r)) for r in simhash_dedup.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()}
    want = {tuple(sorted((signed[a], signed[b]))) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3}
    assert found == want


def test_keep_one_keeps_columns_and_one_row_a_group(docs):
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 2 not in ids and ids.count(7) == 1 and None in ids


def test_line_dedup(docs):
    got = {(r["doc_id"], r["text"]): r["n_removed"] for r in line_dedup.dedup_lines(docs.where("doc_id in (5, 6, 8, 9, 1, 2)")).collect()}
    text = dict(DOCS)
    assert got[(8, text[8])] == 0 and got[(5, None)] == 0 and got[(6, "")] == 0
    assert got[(9, text[9].split("\n")[1] + "\n")] == 2
    assert got[(1, BASE)] == 0 and got[(2, "")] == 1


def test_line_dedup_links_fuzzy_lines(spark):
    line = " ".join(f"word{k}" for k in range(80))
    other = line.replace("word40", "wort40")
    rows = [(1, line), (2, other + "\nkept as it is here"), (3, _text(80))]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_line_dedup_of_an_empty_table(docs):
    assert line_dedup.dedup_lines(docs.where("doc_id < 0")).count() == 0


def _near_lines():
    """Lines with some words changed, and each pair of them that has the edit similarity, by brute force."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 10))) for _ in range(500)]
    lines = []
    for n in (20, 30, 40, 60, 80, 100) * 5:
        words = [rnd.choice(vocabulary) for _ in range(n)]
        lines.append(" ".join(words))
        changed = {rnd.randrange(n): rnd.choice(vocabulary) for _ in range(max(1, n // 12))}
        lines.append(" ".join(changed.get(k, w) for k, w in enumerate(words)))
    return lines


def test_line_dedup_finds_most_near_lines(spark):
    lines = _near_lines()
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    pairs = rows.alias("a").join(rows.alias("b"), F.col("a.doc_id") < F.col("b.doc_id")).select(
        F.col("a.doc_id"), F.col("b.doc_id"), F.levenshtein("a.text", "b.text"), F.greatest(F.length("a.text"), F.length("b.text"))
    )
    true = [(a, b) for a, b, edits, longest in pairs.collect() if edits <= 0.2 * longest]
    label = _components(len(lines), true)
    gone = {r["doc_id"] for r in line_dedup.dedup_lines(rows).collect() if r["n_removed"]}
    want = {k for k in range(len(lines)) if label[k] != k}
    assert len(true) >= 25 and gone <= want and len(gone) >= 0.9 * len(want)


def test_line_dedup_counts_repeated_words(spark):
    # a word that fills the line outvotes those beside it in its block, which stays as it is to the bit
    line = " ".join(["again"] * 60 + [f"only{k}" for k in range(20)])
    other = line.replace("only", "else")
    got = line_dedup.occurrences_of(spark.createDataFrame([(1, line), (2, other)], "doc_id bigint, text string")).where("own").collect()
    assert {r["n_words"] for r in got} == {80}
    assert sum(got[0][f"b{k}"] is not None and got[0][f"b{k}"] == got[1][f"b{k}"] for k in range(line_dedup.MOST_BLOCKS)) == 1


def test_line_dedup_edits_leave_other_blocks(spark):
    words = [f"alpha{k}" for k in range(60)]
    edited = [*words[:30], "omega", *words[31:]]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(["first", *words]))], "doc_id bigint, text string")
    one, two, three = (line_dedup.occurrences_of(rows).where("own").orderBy("doc_id").collect())
    differ = lambda x, y: sum(x[f"b{k}"] != y[f"b{k}"] for k in range(line_dedup.MOST_BLOCKS))
    assert one["blocks"] == 8 and differ(one, two) <= 2 and differ(one, three) <= 1


def test_line_dedup_groups_equal_brute_force(spark):
    """All lines of all documents, grouped by all pairs' edit similarity: the same lines stay."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 11))) for _ in range(400)]
    bases = [[rnd.choice(vocabulary) for _ in range(n)] for n in (14, 25, 50, 70, 120, 300) * 3]
    lines = []
    for base in bases:
        for edits in (0, 1, 2):
            words = list(base)
            for _ in range(edits):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            lines.append(" ".join(words if edits < 2 else words + [rnd.choice(vocabulary)]))
    rnd.shuffle(lines)
    docs = [(k, "\n".join(lines[k * 6 : k * 6 + 6])) for k in range(len(lines) // 6)] + [(90, "word " * 400), (91, "term " * 400), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    flat = [(d, p, line.strip()) for d, t in docs if t for p, line in enumerate(t.split("\n"))]
    lined = spark.createDataFrame([(k, line) for k, (_, _, line) in enumerate(flat)], "k int, line string")
    pairs = lined.alias("a").join(lined.alias("b"), F.expr("a.k < b.k AND levenshtein(a.line, b.line) <= 0.2 * greatest(length(a.line), length(b.line))"))
    label = _components(len(flat), [(r[0], r[1]) for r in pairs.select("a.k", "b.k").collect()])
    first = {}
    for k, (d, p, _) in enumerate(flat):
        first[label[k]] = min(first.get(label[k], (d, p)), (d, p))
    want = {(d, p) for k, (d, p, _) in enumerate(flat) if first[label[k]] != (d, p)}
    got = {(r["doc_id"], p) for r in line_dedup.removed_lines(frame).collect() for p, c in enumerate(bytes(r["mask"])) if c == 49}
    assert len(want) > 25 and got <= want and len(got) >= 0.95 * len(want)


def test_line_dedup_long_and_hostile_inputs(spark):
    many = "\n".join(f"line number {k} of a text with very many lines {k * k}" for k in range(5000))
    wide = " ".join(f"w{k * 7919 % 10007}" for k in range(40000))
    rows = [(1, many, 5), (1, many, 6), (2, wide, 7), (3, wide + " more\n\n", 8), (None, "x" * 100000, 9), (4, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_removed int").withColumn("class", F.lit("kept")).withColumn("mask", F.lit(1))
    out = line_dedup.dedup_lines(docs)
    got = {(r["doc_id"], r["text"]) for r in out.where("doc_id > 1 or doc_id is null").collect()}
    assert sorted(out.columns) == sorted(docs.columns) and got == {(2, wide), (3, "\n"), (None, "x" * 100000), (4, None)}


def test_line_dedup_of_short_lines_and_scripts_without_spaces(spark):
    han = "".join(chr(0x4E00 + 7 * k) for k in range(60))
    rows = [(1, "Read more\n\nok\n---\n" + han), (2, "read  more!\n\nOK\n---\n" + han), (3, "***\n" + han[:30] + "x" + han[31:]), (4, " \nok1")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: rows[0][1], 2: "", 3: "***", 4: " \nok1"}


def test_line_dedup_sums_each_line_once(spark):
    line = " ".join(f"word{k}" for k in range(100))
    rows = [(None, line)] * 50 + [(7, "other line\n" + line.replace("word50", "wort50"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["n_words"] for r in line_dedup.occurrences_of(docs).collect()} == {100, 2}
    got = line_dedup.dedup_lines(docs).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {(None, 0), (7, 1)} and not hasattr(line_dedup, "MAX_FUZZY_WORDS")


def _fuzzy_groups(spark, lines):
    """(a label for each line by the operator, one by all pairs' edit similarity, the pairs that have it)."""
    rows = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").cache()
    classes = line_dedup.stage(line_dedup.classes_of(line_dedup.occurrences_of(rows)), "classes")
    found = {r["class"]: r["component"] for r in line_dedup.groups_of(rows, classes).collect()}
    names = [r[0] for r in rows.orderBy("doc_id").select(F.xxhash64("text", F.lit("line"))).collect()]
    close = F.expr("a.doc_id < b.doc_id AND levenshtein(a.text, b.text, cast(floor(0.2 * greatest(length(a.text), length(b.text)) + 1e-9) AS int)) >= 0")
    true = [(r[0], r[1]) for r in rows.alias("a").join(rows.alias("b"), close).select("a.doc_id", "b.doc_id").collect()]
    return [found.get(n, n) for n in names], _components(len(lines), true), true


def test_line_dedup_links_all_short_lines(spark):
    rnd = random.Random(3)
    lines = {"abcd", "abcde", "la ja", "la ra"}
    for _ in range(120):
        line = "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(5, line_dedup.SHORT_CHARS - 8)))
        for _ in range(2):
            lines.add(" ".join(line.split()))
            for _ in range(rnd.randrange(1, 2 + len(line) // 5)):
                k = rnd.randrange(len(line))
                line = line[:k] + rnd.choice(["", "x", line[k] + "y"]) + line[k + 1 :]
    got, want, true = _fuzzy_groups(spark, sorted(x for x in lines if len(x) > 3))
    assert len(true) > 60 and len(set(want)) > 60
    assert _components(len(got), [(a, b) for a in range(len(got)) for b in range(a) if got[a] == got[b]]) == want


def test_line_dedup_links_lines_with_many_changed_words(spark):
    # a seventh of the words, in all blocks of a line
    rnd = random.Random(17)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 10))) for _ in range(3000)]
    lines = []
    for n in (9, 14, 30, 60, 100, 200, 400) * 8:
        words = [rnd.choice(vocabulary) for _ in range(n)]
        changed = {k: rnd.choice(vocabulary) for k in rnd.sample(range(n), n // 7)}
        lines += [" ".join(words), " ".join(changed.get(k, w) for k, w in enumerate(words))]
    got, _, true = _fuzzy_groups(spark, lines)
    assert len(true) > 45 and sum(got[a] == got[b] for a, b in true) >= 0.97 * len(true)


def test_line_dedup_counts_characters_before_lines_meet(spark, monkeypatch):
    # lines that share a passage, some of them near copies: pairs whose characters already differ too much are not compared
    rnd = random.Random(23)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 9)))
    passage = [word("abcdefghijklmnopqrstuvwxyz") for _ in range(60)]
    lines = []
    for k in range(90):
        letters = rnd.sample("abcdefghijklmnopqrstuvwxyzéü", 4)
        lines.append(" ".join([word(letters) for _ in range(38)] + passage))
        if k % 6 == 0:
            lines.append(lines[-1].replace(passage[7], "other").replace(passage[30], "more"))
    met, stage = [], line_dedup.stage

    def kept(df, name, **options):
        out = stage(df, name, **options)
        met.append((name, out.columns == ["a", "b"] and out.collect()))
        return out

    monkeypatch.setattr(line_dedup, "stage", kept)
    got, want, true = _fuzzy_groups(spark, lines)
    assert len(true) >= 15 and _components(len(got), [(a, b) for a in range(len(got)) for b in range(a) if got[a] == got[b]]) == want
    names = spark.createDataFrame([(x,) for x in lines], "text string").select(F.xxhash64("text", F.lit("line")), "text").collect()
    text = {r[0]: r[1] for r in names}
    last = [pairs for name, pairs in met if name in ("stars", "rest")][1:]
    assert last and sum(map(len, last)) > 0
    for a, b in (pair for pairs in last for pair in pairs):
        x, y = (Counter(re.sub("[^ a-z]", "?", text[k])) for k in (a, b))
        assert max((x - y).total(), (y - x).total()) <= 0.2 * max(x.total(), y.total())


def test_line_dedup_compares_pairs_in_slices(spark, monkeypatch):
    lines = [f"{'alpha beta gamma delta ' * 3}{k} " + "omega " * (k % 4 * 5 + 1) for k in range(14)]
    texts = spark.createDataFrame(list(enumerate(lines)), "class bigint, norm string")
    pairs = spark.createDataFrame([(a, b) for a in range(14) for b in range(a + 1, 14)], "a bigint, b bigint")
    count, stage_all = [], line_dedup.stage_all
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 1)

    def counted(frames, name):
        frames = list(frames)
        count.append(len(frames))
        return stage_all(frames, name)

    monkeypatch.setattr(line_dedup, "stage_all", counted)
    got = {(r["src"], r["dst"]) for r in line_dedup._linked(pairs, texts, 0.8).collect()}
    close = F.expr("a.class < b.class AND levenshtein(a.norm, b.norm) <= 0.2 * greatest(length(a.norm), length(b.norm))")
    want = {(r[0], r[1]) for r in texts.alias("a").join(texts.alias("b"), close).select("a.class", "b.class").collect()}
    assert got == want and 0 < len(want) < 91 and count == [4]  # 91 pairs, 28 at once


def test_line_dedup_compares_no_pairs_that_turns_have_joined(spark, monkeypatch):
    # near copies of two passages, and a third text: few pairs make each group one component
    rnd = random.Random(29)
    passages = [[f"{p}{rnd.randrange(10**6)}" for _ in range(60)] for p in "xy"]
    lines = [" ".join(f"z{rnd.randrange(10**6)}" if rnd.random() < 0.05 else w for w in passages[k % 2]) for k in range(60)] + ["alone " * 40]
    texts = spark.createDataFrame(list(enumerate(lines)), "class bigint, norm string")
    pairs = spark.createDataFrame([(a, b) for a in range(61) for b in range(a + 1, 61)], "a bigint, b bigint")
    found = spark.createDataFrame([(0, 0)], "node bigint, component bigint")
    compared, linked = [], line_dedup._linked
    monkeypatch.setattr(line_dedup, "MANY_PAIRS", 0)
    monkeypatch.setattr(line_dedup, "_linked", lambda now, *rest, **more: compared.append(now.count()) or linked(now, *rest, **more))
    got = {r["node"]: r["component"] for r in line_dedup._settled(pairs, texts, found, 0.8).collect()}
    assert got == {k: k % 2 for k in range(60)}
    # those between the groups (900, and 60 of the third text) are all compared, of the other 870 those of the first turn or little more
    assert len(compared) == len(line_dedup.TURNS) and 960 < sum(compared) < 960 + 400


def test_line_dedup_compares_no_pair_again(spark, monkeypatch):
    # lines that share passages and are too far apart: those of one passage meet by many keys, whose first classes differ
    rnd = random.Random(31)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(3, 9)))
    passage = [word() for _ in range(40)]
    lines = []
    for k in range(40):
        at = rnd.randrange(3) * 10
        lines.append(" ".join([word() for _ in range(9)] + passage[at : at + 20]))
        if k % 8 == 0:
            lines.append(lines[-1].replace(passage[at + 7], "other"))
    compared, linked = [], line_dedup._linked
    monkeypatch.setattr(line_dedup, "_linked", lambda now, *rest, **more: compared.extend((min(r), max(r)) for r in now.collect()) or linked(now, *rest, **more))
    got, want, true = _fuzzy_groups(spark, lines)
    assert len(true) >= 5 and _components(len(got), [(a, b) for a in range(len(got)) for b in range(a) if got[a] == got[b]]) == want
    assert len(compared) == len(set(compared)) > 100


def test_line_dedup_leaves_keys_whose_pairs_are_compared(spark, monkeypatch):
    # eight pairs of lines that share a passage of their own: the first class of each key has met the other
    rnd = random.Random(37)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(3, 9)))
    lines = []
    for _ in range(8):
        passage = [word() for _ in range(12)]
        lines += [" ".join([word() for _ in range(8)] + passage) for _ in range(2)]
    counted, stage = [], line_dedup.stage

    def kept(df, name, **options):
        out = stage(df, name, **options)
        if name == "counted" and "c0" in out.columns:
            counted.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "stage", kept)
    got, want, true = _fuzzy_groups(spark, lines)
    assert not true and len(set(got)) == 16 and counted == [0]


def test_line_dedup_moves_one_text_of_a_pair(spark):
    texts = spark.createDataFrame([(k, f"some line {k}") for k in range(9)], "class bigint, norm string")
    pairs = spark.createDataFrame([(0, k) for k in range(1, 9)], "a bigint, b bigint")
    close = line_dedup._close(pairs, texts, 0.8, True)
    assert {(r["src"], r["dst"]) for r in close.collect()} == {(0, k) for k in range(1, 9)}
    plan = close._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and not re.search(r"RepartitionByExpression \[a#\d+L, b#", plan)


def test_line_dedup_reads_each_text_once_for_many_classes(spark, monkeypatch):
    # texts of candidates are rows of their own: documents are split for the lines, once more for texts and once for the result
    words = [" ".join(f"w{(k * 7 + j) % 50}x" for j in range(12)) for k in range(20)]
    docs = spark.createDataFrame([(k, w + ("" if k % 2 else " z")) for k, w in enumerate(words + words)], "doc_id long, text string")
    want = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()}
    split, lines_of = [], line_dedup.lines_of
    monkeypatch.setattr(line_dedup, "lines_of", lambda rows: split.append(1) or lines_of(rows))
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_ROWS", 0)
    got = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == want and len(split) == 1


def test_sharding(spark, docs):
    names = [f"s{k}" for k in range(5)]
    table = sharding.lookup_table(names, 101)
    taken, turn, at = {}, 0, [0] * 5
    orders = [[(a + j * s) % 101 for j in range(101)] for a, s in (sharding._preference(n, 101) for n in names)]
    while len(taken) < 101:  # brute force: the whole preference lists
        k = turn % 5
        while orders[k][at[k]] in taken:
            at[k] += 1
        taken[orders[k][at[k]]] = k
        turn += 1
    assert [taken[s] for s in range(101)] == table
    fewer = sharding.lookup_table(names[:4], 101)
    assert sum(a != b for a, b in zip(table, fewer, strict=True)) < 60
    got = sharding.assign_shards(docs, shards=names, size=101).collect()
    digest = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16) % 101
    assert len(got) == len(DOCS) and all(r["slot"] == digest(r["doc_id"]) and r["shard"] == names[table[r["slot"]]] for r in got)
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)


def test_decontamination(spark):
    item = " ".join(f"b{k}" for k in range(30))
    changed = item.replace("b5 ", "x ").replace("b16 ", "y ").replace("b26 ", "z ")
    short = "one two three four five six"
    rows = [
        (1, f"{_text(40)} {item.upper()}! {_text(40)}"), (2, _text(100)), (3, f"{_text(9)} {changed}"), (4, None), (5, ""),
        (6, " ".join(item.split()[:8]) + " " + _text(50)), (7, f"{_text(30)} {short}."), (7, f"{_text(30)} {short}."),
        (8, " ".join(item.split()[3:17])), (9, " ".join(_text(1) if k % 3 == 0 else f"b{k}" for k in range(30))),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit(0))
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "too short"), (5, item)], "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontamination.overlaps(docs, bench).collect())
    assert got == [(1, 1), (1, 5), (3, 1), (3, 5), (7, 2), (8, 1), (8, 5)]
    kept = decontamination.drop_contaminated(docs, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6, 9] and kept.columns == docs.columns
    assert decontamination.overlaps(docs.where("doc_id < 0"), bench).count() == 0


def test_every_two_substitutions_in_a_window_have_a_seed():
    from itertools import combinations

    n = decontamination.WINDOW
    for gone in combinations(range(n), 2):
        assert any(all(a + o not in gone for o in mask) for mask in decontamination.MASKS for a in range(n - mask[-1]))


def test_quality_table(spark):
    good = [(k, _text(80)) for k in range(40)]
    junk = [(100 + k, " ".join(w + "$$$" for w in _text(80).split())) for k in range(20)]
    docs = spark.createDataFrame([*good, *junk, (200, None), (201, "few words"), (202, "a b c " * 40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:20]] + [(i, 0, 0) for i, _ in junk[:10]] + [(None, 1, 0), (3, None, 1)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.judge(docs, model).collect()}
    assert all(got[i]["kept"] for i, _ in good) and not any(got[i]["kept"] for i, _ in junk)
    assert got[200]["base_failed"] and got[201]["base_failed"] and got[202]["base_failed"] and not got[202]["kept"]
    assert {r["doc_id"] for r in quality.keep_good(docs, model).collect()} == {i for i, _ in good}


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    path = str(P.path("byte_bpe_50k.json"))
    got = [tuple(r) for r in token_files.read_token_files(token_files.write_token_files(docs, path)).collect()]
    tok, at, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_chat_table(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None), (None, 0, None, "x"), (1, 2, "user", "c")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("kind", F.lit(1))
    got = {r["conv_id"]: r for r in chat.digests(chat.format_chat(turns)).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 1 and got[1]["n_examples"] == 1
    assert got[2]["turns_sha256"] == hashlib.sha256(b"user\n\n").hexdigest() and got[None]["n_turns"] == 1
    assert chat.format_chat(turns.where("turn > 9")).count() == 0


def test_pii_table(docs):
    got = pii.find_pii(docs).collect()
    assert len(got) == len(DOCS) and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in got)
    assert pii.redact(docs.where("doc_id = 7").withColumn("text", F.lit("mail a@b.co now"))).first()["text"] == "mail [email] now"


def test_pii_shape_covers_the_whole_word():
    assert pii.word_key('"' + "0f" * 64 + '"') == pii.word_key('"' + "0f" * 16 + '"')
    assert pii.word_key("a-" * 60 + "0f" * 16) != pii.word_key("a-" * 60)


def test_every_allowed_substitution_meets_a_seed():
    from itertools import combinations

    for n in range(1, 14):
        words = [f"w{k}" for k in range(n)]
        masks = [-decontamination.RUNS[n]] if n in decontamination.RUNS else range(len(decontamination.MASKS))
        whole = decontamination._word_hashes(words)
        seeds = {(m, at, int(h)) for m in masks for at, h in enumerate(decontamination.seed_hashes(whole, m))}
        changes = n - int(np.ceil(decontamination.MIN_MATCH * n - 1e-9))
        for places in combinations(range(n), changes):
            text = [f"other{k}" if k in places else w for k, w in enumerate(words)]
            found = {(m, at, int(h)) for m in masks for at, h in enumerate(decontamination.seed_hashes(decontamination._word_hashes(text), m))}
            assert seeds & found, (n, places)


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(21)
    vocabulary = [f"v{k}" for k in range(60)]
    items = {k: [rnd.choice(vocabulary) for _ in range(n)] for k, n in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 20, 30))}
    items[0] = ["solitaire"]
    docs = {}
    for d in range(90):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 60))]
        if d % 3:
            item = list(items[rnd.randrange(len(items))])
            for _ in range(rnd.randrange(0, 4)):
                item[rnd.randrange(len(item))] = rnd.choice(vocabulary)
            at = rnd.randrange(len(words) + 1)
            words[at:at] = item
        docs[d] = words
    want = set()
    for d, words in docs.items():
        for i, item in items.items():
            n = min(13, len(item))
            if any(
                sum(0 <= s + b + k < len(words) and words[s + b + k] == item[b + k] for k in range(n)) >= 0.8 * n - 1e-9
                for b in range(len(item) - n + 1)
                for s in range(-len(item), len(words) + 1)
            ):
                want.add((d, i))
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()] + [(None, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(99, ""), (98, None)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(frame, bench).collect()}
    assert got == want
    assert decontamination.overlaps(frame.where("doc_id < 0"), bench).count() == 0
    assert decontamination.overlaps(frame, bench.where("item_id < 0")).count() == 0


def test_quality_fit_counts_an_id_once(spark):
    good = " ".join(f"word{k % 70} of" for k in range(90))
    rows = [(1, good)] * 5 + [(2, " ".join(f"%%{k} $$" for k in range(80)))] + [(3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labels)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, model).collect()}
    assert kept == {1: True, 2: False, 3: False}
    assert quality.judge(docs.where("doc_id < 0"), model).count() == 0


def test_quality_fits_on_all_labelled_rows(spark):
    rnd = random.Random(31)
    words = ["".join(rnd.choice("abcdefghij%$") for _ in range(3)) for _ in range(60)]
    rows = [(k, " ".join(rnd.choice(words[: 40 + 20 * (k % 7 == 0)]) for _ in range(50 + k % 3))) for k in range(21000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    good = {k: k % 7 > 0 for k, _ in rows if k % 40}
    labels = spark.createDataFrame([(k, int(g), 0) for k, g in good.items()], "doc_id bigint, quality int, toxic int")
    target, corpus = np.zeros(1 << quality.BUCKET_BITS), np.zeros(1 << quality.BUCKET_BITS)
    for k, text in rows:
        n = np.bincount(np.concatenate(list(quality.ngram_buckets(text.encode()))), minlength=len(corpus))
        corpus += n
        target += n * good.get(k, False)
    model = quality.fit(docs, labels)
    want = quality.Model(quality.ratios_of(target, corpus))
    counted = [(want.score(text), good[k]) for k, text in rows if k in good and not quality.base_failed(*quality.base_stats(text)[::4])]
    assert len(counted) > 20000 and np.array_equal(model.ratios, want.ratios)
    assert model.threshold == quality.choose_threshold(*map(np.array, zip(*counted, strict=True))) > float("-inf")


def test_quality_threshold_by_ranges_equals_arrays(spark):
    rnd = random.Random(37)
    for n, steps, loss in ((1, 5, 0.1), (40, 6, 0.3), (300, 40, 0.05), (500, 10**6, 0.01), (60, 3, 1.0)):
        rows = [(round(rnd.randrange(steps) / steps - 0.5 + 0.3 * g, 9), g) for g in (rnd.random() < 0.6 for _ in range(n))]
        got = quality.threshold_of(spark.createDataFrame(rows, "score double, good boolean"), loss)
        assert got == quality.choose_threshold(*map(np.array, zip(*rows, strict=True)), loss)
    assert quality.threshold_of(spark.createDataFrame([], "score double, good boolean")) == float("-inf")
