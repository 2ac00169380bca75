"""Corpus operators against brute force and on awkward tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from llm.fixtures import AWKWARD, BASE, LINE, LONG, awkward, empty
from oracle import compare
from tallyroad.llm import bcr, common, entry
from tallyroad.llm import exact_dedup as E
from tallyroad.llm import fingerprints as FP
from tallyroad.llm import jaccard_join as J
from tallyroad.llm import license_scan as LS
from tallyroad.llm import license_texts as LT
from tallyroad.llm import line_dedup as LD
from tallyroad.llm import lm_scoring as LM
from tallyroad.llm import mixing as M
from tallyroad.llm import sentencepiece_codec as SP
from tallyroad.llm import suffix_dedup as SD
from tallyroad.llm import toxicity as T
from tests_env import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile("[^\x20\x09-\x0d]+")


def documents(sf=SF):
    t = pq.read_table(f"{sf}/documents.parquet")
    return dict(zip(t.column("doc_id").to_pylist(), [x or "" for x in t.column("text").to_pylist()], strict=True))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql(spark, name):
    assert compare(spark, SF, entry.queries()[name], entry.oracle_sql()[name]) == ""


# ---- exact copies and lines


def test_exact_dedup_awkward(spark):
    got = E.exact_dedup(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert {(r["keep_id"], r["group_size"]) for i in (4, 5, 6) for r in by[i]} == {(6, 4)}  # with the null id's null text
    assert {(r["keep_id"], r["kept"]) for r in by[1]} == {(-5, False)} and by[-5][0]["kept"]
    assert by[9][0]["kept"] and not by[10][0]["kept"]
    assert E.exact_dedup(empty(spark)).count() == 0
    assert E.deduplicated(empty(spark)).count() == 0
    assert {"at", "maybe"} <= set(E.deduplicated(awkward(spark)).columns)


def test_bloom_rounds_lose_nothing(spark, monkeypatch):
    """Many segments and rounds find every repeated key; a round's broadcast is gone before the next one's is made."""
    monkeypatch.setattr(E, "SEGMENT_KEYS", 64)
    monkeypatch.setattr(E, "BROADCAST_BYTES", 200)
    assert E._layout(1143) == (18, 768, 2)
    made, held = spark.sparkContext.broadcast, []

    def watched(value):
        assert not held and sum(map(len, value.values())) <= 200
        out = made(value)
        held.append(out)
        plain = out.destroy
        out.destroy = lambda *a: (held.remove(out), plain(*a))
        return out

    monkeypatch.setattr(spark.sparkContext, "broadcast", watched)
    keys = [i - 500 for i in range(1000)] + [i - 500 for i in range(0, 1000, 7)]
    got = E.mark_possible_repeats(spark.createDataFrame([(k,) for k in keys], "key long")).collect()
    assert len(got) == len(keys)
    repeated = {k for k, n in collections.Counter(keys).items() if n > 1}
    assert {r["key"] for r in got if r["maybe"]} >= repeated
    assert sum(r["maybe"] for r in got) < 600


def test_exact_dedup_in_rounds(spark, monkeypatch):
    want = sorted(map(tuple, E.op8_exact_dedup(spark, SF).collect()))
    monkeypatch.setattr(E, "SEGMENT_KEYS", 16)
    monkeypatch.setattr(E, "BROADCAST_BYTES", 100)
    assert sorted(map(tuple, E.op8_exact_dedup(spark, SF).collect())) == want


def test_lines_awkward(spark):
    rows = LD.line_dedup(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    got = {(r["doc_id"], r["n_lines"], r["text"]): r for r in rows}
    assert got[12, 3, "first"]["n_dropped"] == 2 and [tuple(x) for x in got[12, 3, "first"]["keep_runs"]] == [(1, 1)]
    assert got[13, 2, "second"]["n_dropped"] == 1
    # rows of one doc_id with different texts keep and lose their own lines
    assert [tuple(x) for x in got[13, 2, "keep me first\nkeep me second"]["keep_runs"]] == [(0, 2)]
    assert got[14, 2, f"{LINE}\nthird"]["n_dropped"] == 0 and got[14, 4, f"{LINE}\nan other text\n{LINE}\nunder one id"]["n_dropped"] == 0
    assert got[4, 1, ""]["n_dropped"] == 0 and LD.line_dedup(empty(spark)).count() == 0
    assert sum(r["doc_id"] is None for r in rows) == 2


def test_lines_of_one_id_with_two_texts(spark):
    docs = spark.createDataFrame([(1, f"{LINE}\nkeep me first"), (1, f"keep me too\n{LINE}"), (2, LINE), (3, LINE)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"], r["n_dropped"]) for r in LD.line_dedup(docs).collect())
    assert got == [(1, "keep me first", 1), (1, "keep me too", 1), (2, "", 1), (3, LINE, 0)]


def test_first_occurrences_are_streamed_from_sorted_ranges(spark):
    """The plan keeps the ranges and the secondary sort and adds neither shuffle nor sort for the window."""
    rows = [(k % 3, 0, d, 0, p) for k in range(4) for d in range(5) for p in range(3)]
    firsts = LD.first_occurrences(spark.createDataFrame(rows, "h1 long, h2 long, doc_id long, mark long, pos int"), 8)
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == plan.count("Exchange ") == 1 and plan.count("Sort [h1") == 1 and plan.index("Window") < plan.index("Sort [h1")
    assert sorted((r["h1"], r["doc_id"], r["pos"]) for r in firsts.collect()) == [(k, d, 0) for k in range(3) for d in range(5)]


# ---- similarity


def jaccard_truth(texts: dict, width: int, num: int):
    sets = {}
    for i, t in texts.items():
        w = WORDS.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_family(n=90):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    out = {}
    for i in range(n):
        w = list(base)
        for _ in range(rng.integers(0, 5)):
            w[rng.integers(0, len(w))] = f"x{rng.integers(0, 10**6)}"
        out[i] = " ".join(w[: rng.integers(100, 121)])
    out |= {n + i: " ".join(f"z{rng.integers(0, 40)}" for _ in range(rng.integers(1, 60))) for i in range(60)}
    return out


@pytest.mark.parametrize(("width", "num"), [(3, 90), (5, 80), (2, 60)])
def test_jaccard_family(spark, monkeypatch, width, num):
    """Every link is found, also across blocks of a few members."""
    monkeypatch.setattr(J, "BLOCK", 7)
    monkeypatch.setattr(J, "QUERIES", 5)
    texts = near_family()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs, width, num, 100).collect()}
    assert got == jaccard_truth(texts, width, num)


def test_large_group_of_near_copies_meets_few_blocks(spark, monkeypatch):
    """Sets of one component don't meet each other's blocks, and sets that share one hash stay in few blocks."""
    monkeypatch.setattr(J, "BLOCK", 16)
    rng = np.random.default_rng(16)
    base = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(300):  # one word changed: links everywhere
        w = list(base)
        w[int(rng.integers(0, 100))] = f"x{i}"
        texts[i] = " ".join(w)
    for i in range(300, 500):  # a common beginning, otherwise unlike
        texts[i] = " ".join(base[:30] + [f"y{rng.integers(0, 10**6)}" for _ in range(60)])
    rows, plain = {}, common.materialize

    def watched(df, label, by=()):
        out = plain(df, label, by)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(J.common, "materialize", watched)
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 90, 100).collect()}
    assert got == {i: 0 if i < 300 else i for i in texts}
    assert rows["met"] < 300  # all pairs of sets and blocks would be 300 * 19 and more


def test_jaccard_awkward(spark):
    got = collections.defaultdict(set)
    for r in J.jaccard_components(awkward(spark), 3, 90, 100).collect():
        got[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert got[1] == {(58, -5)} and got[3] == {(58, -5)} and got[2] == {(59, -5)} and got[-5] == {(58, -5)}
    assert got[4] == {(0, 4)} and got[6] == {(0, 6)} and got[9] == got[10] == {(1, 9)} and got[11] == {(1, 11)}
    assert {c for _, c in got[8]} == {7}
    assert {c for _, c in got[None]} == {None}
    assert J.jaccard_components(empty(spark), 3, 90, 100).count() == 0
    kept = {r["doc_id"] for r in J.one_of_each(awkward(spark)).select("doc_id").collect()}
    assert -5 in kept and not kept & {1, 2, 3, 8, 10} and {4, 5, 6, 7, 9} <= kept


def shingles(text, n=5):
    w = WORDS.findall(text.translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_fingerprints_against_sets(spark):
    texts = sorted(documents().items(), reverse=True)
    got = {r["doc_id"]: r for r in FP.op4_fingerprints(spark, SF).collect()}
    errors = []
    for k, (i, t) in enumerate(texts):
        nxt, half = texts[(k + 1) % len(texts)][1], len(t) // 2
        edited, r = t[: len(t) - half] + nxt[:half], got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = shingles(t), shingles(edited), shingles(nxt)
        errors += [r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1), r["near_next"] - (len(a & c) / len(a | c) if a | c else 1)]
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.01
    equal = collections.defaultdict(set)
    for i, t in texts:
        equal[t].add(got[i]["fingerprint"])
    assert all(len(x) == 1 for x in equal.values())


def test_fingerprints_awkward(spark):
    got = FP.fingerprints(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert {r["fingerprint"] for r in got if r["doc_id"] in (4, 5, 6)} == {""}
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (1, 3, -5)}) == 1
    assert FP.fingerprints(empty(spark)).count() == 0
    clashing = spark.createDataFrame([(1, "a b c d e f", 7)], "doc_id long, text string, shingle_hashes int")
    assert FP.add_fingerprint(clashing).columns == ["doc_id", "text", "shingle_hashes", "fingerprint"] and FP.add_fingerprint(clashing).first()["shingle_hashes"] == 7
    with pytest.raises(ValueError, match="already"):
        FP.add_fingerprint(clashing.withColumnRenamed("shingle_hashes", "Fingerprint"))
    single = FP.fingerprints(spark.createDataFrame([(3, "a b c d e f")], "doc_id long, text string")).first()
    assert single["near_next"] == 1.0


# ---- repeated passages


def removal_truth(texts: dict, n=50):
    seen, out = set(), {}
    for i in sorted(texts):
        t = (texts[i] or "").encode()
        gone, own = np.zeros(len(t), bool), set()
        for k in range(len(t) - n + 1):
            if t[k : k + n] in seen:
                gone[k : k + n] = True
            own.add(t[k : k + n])
        seen |= own
        out[i] = (len(t), int(gone.sum()), int((np.diff(gone.view(np.int8), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def removed(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_suffix_dedup_documents(spark):
    assert removed(SD.op9_suffix_dedup(spark, SF)) == removal_truth(documents())


@pytest.mark.parametrize("collection", [4096, 16, 3])
def test_suffix_dedup_periods_and_pieces(spark, monkeypatch, collection):
    """Periodic texts, families of near copies, pieces of a few bytes and keys with more segments than a collection."""
    monkeypatch.setattr(SD, "CHUNK", 300)
    monkeypatch.setattr(SD, "COLLECTION", collection)
    rng = np.random.default_rng(6)
    base = "".join(rng.choice(list("abcd "), 900))
    texts = {}
    for i in range(40):
        t = list(base[: rng.integers(40, 900)])
        for _ in range(rng.integers(0, 6)):
            t[rng.integers(0, len(t))] = "é"
        texts[i] = "".join(t)
    texts |= {100: "ab" * 200, 101: "ab" * 90, 102: "b" + "ab" * 40, 103: "", 104: None, 105: base, 106: base}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert removed(SD.suffix_dedup(docs)) == removal_truth(texts)


def test_suffix_dedup_awkward(spark):
    got = SD.suffix_dedup(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    by = collections.defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["n_bytes"], r["n_removed"]))
    assert by[1] == {(len(BASE), len(BASE))} and by[-5] == {(len(BASE), 0)} and by[8] == {(len(LONG) + 4, len(LONG))}
    assert all(n == 0 for _, n in by[None])
    assert SD.suffix_dedup(empty(spark)).count() == 0


def test_split_key_finds_the_same(monkeypatch):
    """Collections split by the first symbols decide as one collection does, also where one string is very common."""
    rng = np.random.default_rng(12)
    shared = bytes(rng.choice([97, 98], 60).astype(np.uint8))
    contents = [bytes(rng.choice([97, 98], rng.integers(0, 9)).astype(np.uint8)) + shared + bytes(rng.choice([97, 98], rng.integers(0, 9)).astype(np.uint8)) for _ in range(40)]
    least = rng.integers(0, 1000, len(contents))
    want = SD._least_of_strings(contents, least)
    monkeypatch.setattr(SD, "COLLECTION", 5)
    got = SD._split_key(contents, least)
    assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_suffix_dedup_without_repeats(spark):
    """Blocks without a shared key, and without a removal, send nothing."""
    texts = {i: "".join(np.random.default_rng(i).choice(list("abcdefgh "), 120)) for i in range(3)}
    texts |= {7: texts[1][:49], 8: "x" + texts[2][:50]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert removed(SD.suffix_dedup(docs)) == removal_truth(texts)
    none = np.zeros(0, np.int64)
    assert SD._deal(none, none, [none], 4).num_rows == 0 and SD._deal(*SD._joined(np.zeros((0, 4), np.int64)), 4).num_rows == 0


def test_ranges_are_joined():
    found = np.array([[1, 7, 0, 60], [1, 7, 50, 55], [1, 7, 60, 70], [1, 7, 90, 95], [1, 8, 3, 9], [2, 7, 3, 9]])
    ids, marks, (start, length) = SD._joined(found[::-1])
    assert list(zip(ids.tolist(), marks.tolist(), start.tolist(), length.tolist(), strict=True)) == [(1, 7, 0, 70), (1, 7, 90, 5), (1, 8, 3, 6), (2, 7, 3, 6)]


def test_suffix_structure():
    rng = np.random.default_rng(7)
    for _ in range(40):
        strings = [bytes(rng.choice([97, 98], rng.integers(0, 14)).astype(np.uint8)) for _ in range(rng.integers(1, 9))]
        owner, offset, shared, before = bcr.build(strings)
        suffixes = [strings[i][o:] for i, o in zip(owner, offset, strict=True)]
        assert suffixes == sorted(suffixes) and len(suffixes) == sum(len(s) + 1 for s in strings)
        for k in range(1, len(suffixes)):
            a, b = suffixes[k - 1], suffixes[k]
            assert shared[k] == next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
        assert all(b == (strings[i][o - 1] + 1 if o else 0) for i, o, b in zip(owner, offset, before, strict=True))


# ---- classifier, scanner, codec


def planted(n, seed):
    rng = np.random.default_rng(seed)
    plain, bad = [f"word{i}" for i in range(400)], {"en": ["nasty", "vile", "rotten"], "de": [f"schlim{s}" for s in ("mer", "ste", "mes")]}
    out = []
    for i in range(n):
        lang = "en" if i % 2 else "de"
        w = list(rng.choice(plain, rng.integers(5, 80)))
        y = int(i % 4 < 2)
        if y:
            for _ in range(2):
                w.insert(rng.integers(0, len(w)), str(rng.choice(bad[lang])))
        out.append((" ".join(w), y, lang))
    return out


def test_classifier_learns_and_calibrates():
    model = T.fit(planted(600, 1))
    test = planted(300, 2)
    scores = T.score_texts(model, [t for t, _, _ in test])
    y = np.array([x for _, x, _ in test])
    assert ((scores >= 0.7) == (y == 1)).mean() > 0.97
    assert set(model.thresholds) == {"en", "de"} and all(0.3 <= v <= 0.9 for v in model.thresholds.values())


def test_scores_do_not_depend_on_blocks(monkeypatch):
    model = T.fit(planted(200, 3))
    texts = [t for t, _, _ in planted(50, 4)] + [None, "", " ".join(f"w{i}" for i in range(5000)) + " vile nasty"]
    whole = T.score_texts(model, texts)
    monkeypatch.setattr(T, "BLOCK", 64)
    monkeypatch.setattr(T, "KEPT_WORDS", 50)
    assert T.score_texts(model, texts) == pytest.approx(whole, abs=1e-5)
    assert whole[-1] == pytest.approx(whole[-1]) and whole[-2] == whole[-3]


def plain_score(model: T.Model, text) -> float:
    """Score of one text by its definition: every filter at every word, the greatest of each, the logistic layer."""
    zero = np.zeros(T.DIM)
    vectors = [sum((model.embedding[s].astype(float) for s in T.slots(w)), zero) for w in T.words(text)] or [zero]
    vectors += [zero, zero]
    z = model.out_bias
    responses = [[max(sum(float(f[j] @ vectors[k + j]) for j in range(len(f))) for k in range(len(vectors) - 2)) for f in filters] for filters in model.filters]
    for k, best in enumerate(x for r in responses for x in r):
        z += max(best + float(model.bias[k]), 0.0) * float(model.out[k])
    return 1 / (1 + math.exp(-z))


def test_scores_against_the_definition(spark):
    model = T.fit(planted(300, 5))
    texts = [t for t, _, _ in planted(40, 6)] + [None, "", "\n \t", "one", "vile", "Ünïcode € 漢字 vile", "word1 " * 300 + "nasty"]
    assert T.score_texts(model, texts) == pytest.approx([plain_score(model, t) for t in texts], abs=1e-5)
    # rows that repeat a doc_id are scored by their own texts
    docs = spark.createDataFrame([(3, "a calm text"), (3, "vile nasty rotten vile"), (3, "a calm text"), (None, "vile nasty rotten vile")], "doc_id long, text string")
    train = [(100 + i, t, y) for i, (t, y, _) in enumerate(planted(200, 8))]
    labels = spark.createDataFrame([(i, y) for i, _, y in train], "doc_id long, toxic int")
    both = docs.unionByName(spark.createDataFrame([(i, t) for i, t, _ in train], docs.schema))
    got = [(r["doc_id"], r["score"]) for r in T.toxicity_scores(both, labels).collect() if r["doc_id"] in (3, None)]
    assert len(got) == 4 and len({s for _, s in got}) == 2 and sorted(s > 0.5 for i, s in got if i == 3) == [False, False, True]


def test_toxicity_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = T.op2_toxicity(spark, sf).join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").toPandas()
    assert (got.toxic == got.predicted).mean() > 0.96
    pos, neg = got[got.toxic == 1].score.to_numpy(), got[got.toxic == 0].score.to_numpy()
    assert (pos[:, None] > neg[None]).mean() > 0.9


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    """No labelled row is left out, however many there are; shards change neither what is learnt nor depend on partitions."""
    many = spark.range(20_000).selectExpr("id as doc_id", "concat('word', id % 50, if(id % 2 = 1, ' vile', ' calm')) as text", "'en' as lang")
    labels = many.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    assert T.training_rows(many, labels).count() == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(20_000))
    rows = planted(900, 11)
    docs = spark.createDataFrame([(i, t, lang) for i, (t, _, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, y) for i, (_, y, _) in enumerate(rows)], "doc_id long, toxic int")
    monkeypatch.setattr(T, "SHARD_ROWS", 100)
    one, two = T.fitted(docs, labels), T.fitted(docs.repartition(3), labels.repartition(5))
    assert (one.embedding == two.embedding).all() and one.out_bias == two.out_bias and one.thresholds == two.thresholds
    assert set(one.thresholds) == {"en", "de"}
    test = planted(300, 12)
    scores = T.score_texts(one, [t for t, _, _ in test])
    assert ((scores >= 0.7) == (np.array([y for _, y, _ in test]) == 1)).mean() > 0.97


def test_toxicity_awkward(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (7, 0, None), (7, 0, 1), (9, 1, 7)], "doc_id long, quality int, toxic int")
    got = T.toxicity_scores(awkward(spark), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {None}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert T.toxicity_scores(empty(spark), labels).count() == 0
    assert T.toxicity_scores(awkward(spark), labels.where("false")).select(F.max("score")).first()[0] < 1e-6


def test_template_markup():
    a = LS.compile_template("permission <<beginOptional>>is hereby<<endOptional>> granted to <<var;min=1;max=3>> for free")
    run = lambda s: a.ends(s.encode().split(), 0)
    assert run("permission granted to you for free now") == 6
    assert run("permission is hereby granted to a b c for free") == 10
    assert run("permission is granted to you for free") is None
    assert run("permission granted to for free") is None
    assert run("permission granted to a b c d for free") is None
    for bad in ("a <<beginOptional>> b", "<<endOptional>> a", "<<beginOptional>>a<<endOptional>>", "a <<what>>"):
        with pytest.raises(ValueError):
            LS.compile_template(bad)


def test_license_scan_base(spark):
    got = {r["doc_id"]: r for r in LS.op3_license_scan(spark, SF).collect()}
    words = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for i, t in documents().items():
        w, starts, labels = words.findall(t.translate(LOWER)), [], set()
        for phrase, label in LT.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_license_scan_awkward(spark):
    got = LS.license_scan(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    r = next(x for x in got if x["doc_id"] == 2**62)
    assert (r["labels"], r["n_base"], r["score"]) == ("mit,mit-notice", 1, LS.NOTICE)
    assert {x["n_words"] for x in got if x["doc_id"] in (4, 5, 6)} == {0}
    assert LS.license_scan(empty(spark)).count() == 0


def written(markup: str, rng=None) -> str:
    """A text that a template accepts, with optional regions kept or left out and variables filled at random."""
    out = markup
    while True:
        new = re.sub("<<beginOptional>>((?:(?!<<beginOptional>>).)*?)<<endOptional>>", lambda m: m[1] if rng is None or rng.random() < 0.5 else " ", out, count=1, flags=re.S)
        if new == out:
            break
        out = new
    some = lambda m: " ".join(f"name{k}" for k in range(int(m[1]) if rng is None else rng.integers(int(m[1]), int(m[2]) + 1)))
    return re.sub("<<var;min=(\\d+);max=(\\d+)>>", some, out)


def pattern(markup: str) -> re.Pattern:
    """The template as a regular expression over words that are each followed by a blank."""
    out = []
    for part in re.split("(<<[^>]*>>)", markup):
        if part == "<<beginOptional>>":
            out.append("(?:")
        elif part == "<<endOptional>>":
            out.append(")?")
        elif m := re.fullmatch("<<var;min=(\\d+);max=(\\d+)>>", part):
            out.append(f"(?:[^ ]+ ){{{m[1]},{m[2]}}}")
        else:
            out += [re.escape(w.decode()) + " " for w in LS.split_words(part.encode())]
    return re.compile("".join(out))


TEMPLATES = [(k, v) for k, v in LT.TEXTS.items()] + [(k, v) for k, each in LT.NOTICES.items() for v in each]


def test_templates_against_regular_expressions():
    """Every template accepts what its markup allows, and with a word changed, left out or put in what the pattern accepts, nothing else."""
    rng = np.random.default_rng(13)
    taken = refused = 0
    for _, markup in TEMPLATES:
        automaton, wanted = LS.compile_template(markup), pattern(markup)
        for turn in range(12):
            words = LS.split_words(written(markup, rng).encode())
            assert automaton.ends(words, 0) is not None
            at = rng.integers(0, len(words))
            if turn % 3 == 0:
                words[at] = b"changed"
            elif turn % 3 == 1:
                del words[at]
            else:
                words.insert(at, b"additional")
            text = "".join(w.decode() + " " for w in words)
            for i in {0, int(at), max(0, int(at) - 3)}:
                place = sum(len(w) + 1 for w in words[:i])
                got = automaton.ends(words, i) is not None
                assert got == (wanted.match(text, place) is not None)
                taken, refused = taken + got, refused + (not got)
    assert taken > 20 and refused > 500


def test_license_labels_against_brute_force(spark):
    """Labels and scores of a table of license texts, notices and altered ones against patterns tried at every word."""
    rng = np.random.default_rng(14)
    texts = {}
    for k, (_, markup) in enumerate(TEMPLATES):
        whole = written(markup, rng)
        words = whole.split()
        cut = [w for j, w in enumerate(words) if j != len(words) // 2]
        texts |= {3 * k: f"Copyright 2020\n{whole.upper()}\nint main", 3 * k + 1: " ".join(cut), 3 * k + 2: "you may not use what is " + whole}
    texts |= {1000: written(LT.TEXTS["mit-text"])[:700] + " commercial use is forbidden and the licensee must pay a fee", 1001: "you may not ship this under the MIT license"}
    got = {r["doc_id"]: r for r in LS.license_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    patterns = [(label, score, pattern(m)) for label, m, score in [(k, v, LS.WHOLE) for k, v in LT.TEXTS.items()] + [(k, v, LS.NOTICE) for k, each in LT.NOTICES.items() for v in each]]
    for i, t in texts.items():
        words = [w.decode() for w in LS.split_words(t.encode())]
        text, places = "".join(w + " " for w in words), np.cumsum([0, *(len(w) + 1 for w in words)])[:-1].tolist()
        phrases = {label for p, label in LT.PHRASES.items() if f" {p} " in f" {text}"}
        found = [(label, score) for label, score, p in patterns for j, at in enumerate(places) if p.match(text, at) and not (score == LS.NOTICE and set(words[max(0, j - 2) : j]) & set(LT.NEGATIONS))]
        assert got[i]["labels"] == ",".join(sorted(phrases | {x for x, _ in found})), t
        assert got[i]["score"] == max([s for _, s in found], default=LS.BASE if phrases else 0.0)
    assert got[1000]["labels"] == "" and got[1001]["labels"] == "mit" and got[1001]["score"] == LS.BASE
    assert got[0]["labels"] == "mit-text" and got[0]["score"] == LS.WHOLE and got[1]["labels"] == ""


AWKWARD_TEXTS = ["", " ", "  two  blanks ", "Ünïcode 漢字 \U0001f600\n\ttab", "a" * 300, " " * 37 + "x", "\n\n  \n   y", "x" + " " * 5 + "y", "日本語の文章 без пробелов"]


def hand_made_model(path, fallback: bool) -> str:
    """A unigram model file written by hand: pieces of the merge model with probabilities of their own."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model, rng = pb.ModelProto(), np.random.default_rng(15)
    kind = model.SentencePiece
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    model.trainer_spec.byte_fallback = fallback
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces, model.normalizer_spec.escape_whitespaces = "identity", True, False, True
    v = SP.Vocabulary.load()
    special = [("<unk>", kind.UNKNOWN), ("<s>", kind.CONTROL), ("</s>", kind.CONTROL)]
    for piece, t in special + [(f"<0x{b:02X}>", kind.BYTE) for b in range(256) if fallback]:
        model.pieces.add(piece=piece, score=0.0, type=t)
    for piece in [p for p, ok in zip(v.pieces, v.normal, strict=True) if ok][::3]:
        model.pieces.add(piece=piece, score=-int(rng.integers(3 << 8, 15 << 8)) / 256, type=kind.NORMAL)  # sums are exact in four bytes, as the library adds
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_codec_has_the_ids_of_the_merge_model():
    import sentencepiece

    codec, library = SP.Codec(SP.Vocabulary.load()), sentencepiece.SentencePieceProcessor(model_file=SP.MODEL)
    texts = [t for _, t in sorted(documents().items())] + AWKWARD_TEXTS
    for t, (ids, _), want in zip(texts, codec.encode(texts), library.encode(texts, num_threads=1), strict=True):
        assert ids.tolist() == want
        assert codec.decode(ids) == t


@pytest.mark.parametrize("fallback", [True, False])
def test_codec_has_the_ids_of_a_unigram_model(tmp_path, fallback):
    import sentencepiece

    path = hand_made_model(tmp_path / "unigram.model", fallback)
    codec, library = SP.Codec(SP.Vocabulary.load(path)), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t for _, t in sorted(documents().items()) if len(t) < 10_000] + AWKWARD_TEXTS
    for t, (ids, _), want in zip(texts, codec.encode(texts), library.encode(texts, num_threads=1), strict=True):
        assert ids.tolist() == want
        assert not fallback or codec.decode(ids) == t


def best_score(codec: SP.Codec, word: str) -> float:
    """Best segmentation by trying every piece at every place."""
    best = [0.0] + [-math.inf] * len(word)
    for e in range(1, len(word) + 1):
        best[e] = max([best[e - 1] + codec.unknown_score, *(best[s] + codec.scores[word[s:e]] for s in range(e) if word[s:e] in codec.scores)])
    return best[-1]


def test_codec_is_best(tmp_path):
    codec = SP.Codec(SP.Vocabulary.load(hand_made_model(tmp_path / "unigram.model", True)))
    texts = [t for _, t in sorted(documents().items())[:40]] + AWKWARD_TEXTS
    for t, (ids, score) in zip(texts, codec.encode(texts), strict=True):
        assert score == pytest.approx(sum(best_score(codec, w) for w in codec.mark(t)), rel=1e-9)
        assert all(0 <= i < len(codec.v.pieces) for i in ids)


def test_codec_shares_prefixes_without_changing_results(monkeypatch):
    codec, alone = SP.Codec(SP.Vocabulary.load()), SP.Codec(SP.Vocabulary.load())
    words = ["▁the", "▁them", "▁theme", "▁then", "▁t", "▁"]
    codec.add(set(words))
    for w in words:
        alone.forget()
        alone.add({w})
        k = codec.index[w]
        assert codec.ids[codec.offsets[k] : codec.offsets[k + 1]].tolist() == alone.ids.tolist()
    monkeypatch.setattr(SP, "KEPT_WORDS", 3)
    assert [i.tolist() for i, _ in codec.encode(["the theme", "then"])] == [i.tolist() for i, _ in alone.encode(["the theme", "then"])]


def test_codec_awkward(spark):
    got = SP.encode_documents(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert {r["exact"] for r in got if r["doc_id"] != 15} == {True} and not next(r for r in got if r["doc_id"] == 15)["exact"]
    assert {r["n_pieces"] for r in got if r["doc_id"] in (4, 5)} == {0}
    assert SP.encode_documents(empty(spark)).count() == 0


# ---- language model and mixing


def test_lm_base_and_model(spark):
    texts = documents()
    tokens = {i: [*WORDS.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = collections.Counter(w for i, x in tokens.items() if not held[i] for w in x)
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in LM.op6_lm_scoring(spark, SF).collect()}
    better = 0.0
    for i, x in tokens.items():
        r, base = got[i], sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(x), sum(counts[w] > 0 for w in x), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
        better += (r["score"] - base) * held[i]
    assert better > 0


def plain_lm(texts: dict) -> dict:
    """Scores with all pairs in one set of restaurants, counted by dictionaries."""
    words = {i: [LM.START, *(LM._Hashes()[w.encode()] for w in WORDS.findall(t.translate(LOWER))), LM.END] for i, t in texts.items()}
    pairs = collections.Counter()
    for i, x in words.items():
        for p in zip(x[:-1], x[1:], strict=True):
            pairs[p] += zlib.crc32(str(i).encode()) % 10 != 0
    contexts, dishes = (np.array(sorted({p[k] for p in pairs}), np.uint64) for k in (0, 1))
    keys = sorted(pairs)
    at = lambda table, k: np.searchsorted(table, np.array([p[k] for p in keys], np.uint64))
    r = LM.Restaurants(at(contexts, 0), at(dishes, 1), np.array([pairs[p] for p in keys]), contexts, dishes)
    seen = np.bincount(r.word, r.count, len(dishes)) > 0

    def root():
        tables = np.bincount(r.word, r.tables, len(dishes))
        return LM.root_probabilities(tables, tables.sum(), seen.sum())

    for k in range(LM.ROUNDS):
        g = root()
        r.tables = (r.count > 0).astype(np.int64)
        for j in range(LM.BURN + 1):
            r.sweep(g, 100 * k + j)
    g = root()
    r.tables = (r.count > 0).astype(np.int64)
    for j in range(LM.BURN):
        r.sweep(g, 100 * LM.ROUNDS + j)
    first = 100 * LM.ROUNDS + LM.BURN
    p = dict(zip(keys, r.predict(g, range(first, first + LM.SAMPLES)), strict=True))
    return {i: sum(math.log10(p[x]) for x in zip(w[:-1], w[1:], strict=True)) for i, w in words.items()}


def test_lm_scores_against_one_block(spark):
    """Blocks, exchanges and chunks change nothing against one set of restaurants; nor do partitions."""
    want = plain_lm(documents())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in (before, "3"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append({r["doc_id"]: (r["score"], r["base_score"]) for r in LM.op6_lm_scoring(spark, SF).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
    assert {i: s for i, (s, _) in got[0].items()} == pytest.approx(want, abs=1e-5)


def test_lm_sampler_has_settled(monkeypatch):
    """Scores lie close to those of a chain that runs far longer."""
    texts = documents()
    got = plain_lm(texts)
    for k, v in (("ROUNDS", 6), ("BURN", 10), ("SAMPLES", 200)):
        monkeypatch.setattr(LM, k, v)
    want = plain_lm(texts)
    off = [(got[i] - want[i]) / (1 + len(WORDS.findall(t.translate(LOWER)))) for i, t in texts.items()]
    assert np.abs(off).mean() < 0.001 and abs(np.mean(off)) < 0.0005


def test_lm_tokenises_once(spark):
    df = LM.op6_lm_scoring(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("MapInArrow") == 1 and final.count("ReusedExchange") == 1 + LM.ROUNDS


def test_lm_beats_the_base_clearly(spark):
    """Held-out gain over the base, in log10 a token, on a larger table."""
    got = LM.op6_lm_scoring(spark, SF.replace("sf0.001", "sf0.01")).where("held_out").agg((F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).alias("gain")).first()
    assert got["gain"] > 1.0


def partitions_of(n: int):
    """All seatings of n customers as table sizes, with how often each occurs."""
    if n == 0:
        return {(): 1}
    out = collections.Counter()
    for sizes, times in partitions_of(n - 1).items():
        out[tuple(sorted((*sizes, 1)))] += times
        for k in range(len(sizes)):
            out[tuple(sorted((*sizes[:k], sizes[k] + 1, *sizes[k + 1 :])))] += times
    return out


def stay(size: int) -> float:
    return math.prod(k - LM.D1 for k in range(1, size))


@pytest.mark.parametrize("a", [0.05, 0.7, 5.0])
def test_seating_is_the_conditional_law(a):
    """Numbers of tables of one dish against all seatings of its customers."""
    many = 20_000
    for n in range(1, 7):
        law = collections.Counter()
        for sizes, times in partitions_of(n).items():
            law[len(sizes)] += times * a ** len(sizes) * math.prod(map(stay, sizes))
        total = sum(law.values())
        got = np.bincount(LM.seat(np.full(many, n), np.full(many, a), LM._mixed(np.arange(many), n)), minlength=n + 1) / many
        assert got[1:] == pytest.approx([law[t] / total for t in range(1, n + 1)], abs=0.015)
    assert LM.seat(np.array([0, 1]), np.array([1.0, 1.0]), np.array([1, 2], np.uint64)).tolist() == [0, 1]


@pytest.mark.parametrize("a", [0.01, 1.0, 30.0, 900.0])
def test_seating_of_many_customers(monkeypatch, a):
    """Beyond the table of Stirling numbers the law stays the same, as a longer table shows."""
    n = 400
    weight = LM.log_stirling(n, LM.D1)[n, 1 : n + 1] + np.arange(1, n + 1) * math.log(a)
    law = np.exp(weight - weight.max())
    law /= law.sum()
    t = np.arange(1, n + 1)
    mean, dev = (law * t).sum(), math.sqrt((law * t**2).sum() - (law * t).sum() ** 2)
    monkeypatch.setattr(LM, "EXACT", 64)
    got = LM.seat(np.full(1500, n), np.full(1500, a), LM._mixed(np.arange(1500)))
    assert got.mean() == pytest.approx(mean, rel=0.02, abs=0.1 + 0.15 * dev)
    assert got.min() >= 1 and got.max() <= n


def test_strengths_are_gamma():
    for shape in (0.3, 1.25, 40.0):
        x = LM.gamma(np.full(40_000, shape), LM._mixed(np.arange(40_000)))
        assert x.mean() == pytest.approx(shape, rel=0.03) and x.var() == pytest.approx(shape, rel=0.06)


def test_predictions_are_the_posterior_mean_and_sum_to_one():
    """One restaurant with three dishes: many sweeps against the sum over all seatings."""
    count, root = np.array([3, 2, 1, 0]), np.array([0.4, 0.3, 0.2, 0.1])  # the last stands for unknown words
    laws = []
    for n in count:
        law = collections.Counter()
        for sizes, times in partitions_of(int(n)).items():
            law[len(sizes)] += times * math.prod(map(stay, sizes))
        laws.append(law)
    total, mean = 0.0, np.zeros(4)
    for a in laws[0]:
        for b in laws[1]:
            for c in laws[2]:
                t = np.array([a, b, c, 0])
                weight = math.prod(LM.S1 + LM.D1 * k for k in range(t.sum())) * math.prod(root**t) * laws[0][a] * laws[1][b] * laws[2][c]
                total += weight
                mean += weight * (count - LM.D1 * t + (LM.S1 + LM.D1 * t.sum()) * root) / (LM.S1 + count.sum())
    r = LM.Restaurants(np.zeros(4, int), np.arange(4), count, np.array([7], np.uint64), np.arange(4, dtype=np.uint64))
    got = r.predict(root, range(6000))
    assert got.sum() == pytest.approx(1.0) and got == pytest.approx(mean / total, abs=0.01)
    tables = np.array([3, 1, 0])
    seen = LM.root_probabilities(tables, 4, 2)
    assert seen.sum() == pytest.approx(1.0)


def test_lm_awkward(spark):
    got = LM.lm_scores(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (4, 5, 6)} == {1}
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {None}
    assert len({r["train_tokens"] for r in got}) == 1
    assert LM.lm_scores(empty(spark)).count() == 0


def test_lm_equal_chunks(spark):
    """Equal input partitions make equal chunks: each gets its own replies."""
    train = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    alike = spark.sparkContext.parallelize([(train, "one two three two one")] * 3, 3)
    got = LM.lm_scores(spark.createDataFrame(alike, "doc_id long, text string")).collect()
    assert len(got) == 3 and len({(r["score"], r["base_score"]) for r in got}) == 1
    assert {(r["doc_id"], r["n_tokens"], r["train_tokens"]) for r in got} == {(train, 6, 18)}


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(10)
    rows = [(i, "w " * int(rng.integers(1, 60)), str(rng.choice(["a", "b", "c"], p=[0.7, 0.2, 0.1])), str(rng.choice(["x", "y"], p=[0.8, 0.2])), str(rng.choice(["t", "u"]))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    share = lambda m, **v: spark.createDataFrame(list(v.items()), f"{m} string, target double")
    targets = {"source": share("source", a=0.4, b=0.3, c=0.3), "lang": share("lang", x=0.6, y=0.4), "topic": share("topic", t=0.5, u=0.5)}
    got = M.mix(docs, targets).toPandas()
    got["kept"] = got.tokens * got.probability
    for margin, want in (("source", {"a": 0.4, "b": 0.3, "c": 0.3}), ("lang", {"x": 0.6, "y": 0.4}), ("topic", {"t": 0.5, "u": 0.5})):
        shares = got.groupby(margin).kept.sum() / got.kept.sum()
        assert shares.to_dict() == pytest.approx(want, abs=1e-5)
    assert got.probability.max() == 1.0
    assert got.selected.mean() == pytest.approx(got.probability.mean(), abs=0.03)


def test_raking_stops_when_margins_are_met(spark):
    rows = [("a", "x", "t", 10), ("a", "y", "u", 30), ("b", "x", "u", 20), ("b", "y", "t", 40), ("z", "x", "t", 5)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    share = lambda m, **v: spark.createDataFrame(list(v.items()), f"{m} string, target double")
    targets = {"source": share("source", a=0.5, b=0.5), "lang": share("lang", x=0.3, y=0.7), "topic": share("topic", t=0.4, u=0.6)}
    raked, drift = M.rake(cells, targets, rounds=200, tolerance=1e-9)
    got = raked.toPandas()
    assert drift <= 1e-9 and len(got) == 4 and "z" not in set(got.source)  # a value without a target is left out
    assert got.groupby("lang").weight.sum().to_dict() == pytest.approx({"x": 0.3, "y": 0.7}, abs=1e-8)
    assert M.rake(cells, targets, rounds=1)[1] > 1e-3


def test_mixing_awkward(spark):
    df = awkward(spark).withColumn("lang", F.when(F.col("doc_id") > 5, F.lit(None)).otherwise(F.col("lang")))
    got = M.mix(df).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["probability"] <= 1 for r in got)
    assert M.mix(empty(spark)).count() == 0
