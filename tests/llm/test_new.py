"""Collocations, resampling and fingerprints against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, low
from pyspark.sql import functions as F

from dockhand.llm import collocations as C
from dockhand.llm import fingerprints as P
from dockhand.llm import resampling as R

SMALL = {"batch_bytes": 700, "block_keys": 150}


def mixed(seed, n=60):
    """Texts of few words, with copies and shared passages."""
    draw = random.Random(seed)
    words = ["Ab", "b", "cc", "ä", "漢", "x-y", "7", "nul\x00", "e\x1c"]
    passage = " ".join(draw.choices(words, k=40))
    rows = []
    for i in range(n):
        text = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! "]) for w in draw.choices(words, k=draw.randint(0, 60)))
        rows.append((i, text + (passage if i % 3 == 0 else ""), draw.choice(["de", "en", "en", None])))
    return rows + [(n + i, t, lang) for i, (_, t, lang) in enumerate(rows[:10])]


def docs(spark, rows):
    return spark.createDataFrame([(d, t, x, "clash") for d, t, x in rows], "doc_id long, text string, lang string, phrase string").withColumn("score", F.lit("clash"))


# --- 11 -------------------------------------------------------------------------------------------------------


def collocations(rows, longest, least, covered, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        ranked = []
        for p, a in found.items():
            if 100 * longer[p] < covered * a:
                score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("rows,options", [
    (mixed(1), {}), (mixed(2), {"longest": 4, "trigger": 4, "least": 4}), (mixed(3), {"longest": 2, "trigger": 1, "top": 5, "covered": 100}),
    ([(d, t, None) for d, t in AWKWARD], {"least": 2, "longest": 5}), ([], {}), ([(1, None, "en"), (2, "", None), (3, ". , \t", "x")], {"least": 1}),
    ([(i, "a b " * 300, "en") for i in range(3)] + [(9, "one", "de")], {"trigger": 2, "least": 1}),
], ids=["mixed", "four words", "two words", "awkward", "empty", "no words", "periodic"])
def test_collocations(spark, rows, options):
    given = {"longest": 3, "least": 10, "covered": 50, "top": 2000} | {k: v for k, v in options.items() if k != "trigger"}
    found = C.collocations(docs(spark, rows), trigger=options.get("trigger", 8), **given, **SMALL)
    got = sorted((r["lang"], r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())
    assert got == collocations(rows, **given)


@pytest.mark.parametrize("trigger", [1, 2, 5])
@pytest.mark.parametrize("overlap", [1, 2, 3])
def test_chunks_hold_every_run_of_words_once(trigger, overlap):
    texts = [t for _, t, _ in mixed(4, 30)] + [None, "", "one", "one two", "a b " * 50]
    found = defaultdict(list)
    for d, chunk, own, tail in C.parse(pa.array(texts, pa.string()), overlap, trigger):
        words = chunk.replace(b"\n", b" ").split(b" ")
        assert own + tail == len(words) and tail in (0, overlap)
        found[d] += [tuple(words[i : i + overlap + 1]) for i in range(own)]
    for d, text in enumerate(texts):
        words = [x.encode() for x in re.split("[ \t.,;:!?\n\x0b\x0c\r]+", low(text)) if x]
        assert found[d] == [tuple(words[i : i + overlap + 1]) for i in range(len(words))]


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**14 + 7, 3 * 10**14, 10**14 + 9), (10**15 - 1, 10**15 - 1, 10**15 - 1), (1, 10**15 - 1, 10**15 - 1)]
    table = spark.createDataFrame(rows, "a long, l long, r long").select(C._score(F.col("a"), F.col("l"), F.col("r")).alias("s"), "a", "l", "r")
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in table.collect())


# --- 12 -------------------------------------------------------------------------------------------------------

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def resampled(rows, target, plan):
    def buckets(text):
        w = WORDS.findall(low(text))
        runs = [" ".join(w[i : i + k]) for k in range(plan.shortest, plan.longest + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(x.encode()) % plan.buckets for x in runs]

    cut = [buckets(t) for _, t in rows]
    s, t = Counter(b for _, x in cut for b in x), Counter(b for x in target for b in buckets(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + plan.buckets) / ((s[b] + 1) * (all_t + plan.buckets)))) for b in range(plan.buckets)]
    out = []
    for (d, _), (n, x) in zip(rows, cut, strict=True):
        weight = sum(gain[b] for b in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"{plan.seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    drawn = sorted((r for r in out if r[1] >= plan.least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for rank, r in enumerate(drawn[: plan.percent * len(drawn) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("rows,plan", [
    ([(d, t) for d, t, _ in mixed(5, 120)], R.Plan(buckets=50, percent=30)),
    ([(d, t) for d, t, _ in mixed(6)], R.Plan(buckets=7, shortest=1, longest=3, percent=100, least_words=0)),
    (AWKWARD, R.Plan(percent=50, least_words=0)), ([], R.Plan()), ([(1, None), (2, "")], R.Plan()),
], ids=["mixed", "runs", "awkward", "empty", "no words"])
def test_resampling(spark, rows, plan):
    target = ["b cc x y ä 7 7 7", None, "", "Ab ab AB"]
    table = docs(spark, [(d, t, None) for d, t in rows]).withColumn("rank", F.lit("clash"))
    found = R.resample(table, spark.createDataFrame([(t,) for t in target], "text string"), plan)
    assert sorted((tuple(r) for r in found.collect()), key=str) == resampled(rows, target, plan)


def test_empty_target(spark):
    rows = [(d, t) for d, t, _ in mixed(7, 20)]
    found = R.resample(docs(spark, [(d, t, None) for d, t in rows]), spark.createDataFrame([], "text string"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == resampled(rows, [], R.Plan())


def test_repeated_rows_are_drawn_each(spark):
    text = "b cc " * 20
    found = R.resample(docs(spark, [(1, text, None)] * 10 + [(2, text, None)]), spark.createDataFrame([(text,)], "text string"), R.Plan(percent=50))
    ranks = sorted(r["rank"] for r in found.collect() if r["rank"] is not None)
    assert ranks == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("chunk,few", [(7, 3), (1000, 1), (64, 50)])
def test_cutoff_is_exact(spark, chunk, few):
    draw = random.Random(8)
    keys = [(draw.randint(-3, 3), draw.choice([1, 2, R.NO_ID]), draw.randint(0, 2), i) for i in range(400)]
    table = spark.createDataFrame(keys, "minus long, id long, features long, row long").repartition(5)
    for wanted in (1, 2, 199, 400):
        assert R.cutoff(table, wanted, chunk, few) == sorted(keys)[wanted - 1]
    assert R.cutoff(table, 0) is None
    with pytest.raises(ValueError, match="401"):
        R.cutoff(table, 401)


# --- 13 -------------------------------------------------------------------------------------------------------


def likeness(a, b, size):
    def terms(text):
        w = re.findall("[^\x20\x09-\x0d]+", low(text))
        return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else Counter([tuple(w)] if w else [])

    a, b = terms(a), terms(b)
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def edited(rows):
    """{doc_id: (n_chars, edited text, text of the next)}; ids are distinct."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (d, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        out[d] = (len(text), text[: len(text) - n] + after[:n], text, after)
    return out


@pytest.mark.parametrize("rows", [
    [(d, t) for d, t, _ in mixed(9, 90)], [(None, "the last one of all"), (3, None), (5, ""), (4, "Ünï 漢字 \U0001f600\U0001f600 and more"), (-7, "x" * 5000)], [(1, "only one text here")], [],
], ids=["mixed", "odd", "one", "none"])
@pytest.mark.parametrize("partitions", ["1", "6"])
def test_neighbours_over_partitions(spark, rows, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r for r in P.edit_next(docs(spark, [(d, t, None) for d, t in rows])).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = edited(rows)
    assert got.keys() == expected.keys()
    for d, (n, mixture, text, after) in expected.items():
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(mixture.encode()).hexdigest())
        prints, filled = P.signatures(pa.array([text, mixture, after], pa.string()))
        assert bytes(r.fingerprint) == (prints[0].tobytes() if filled[0] else b"")
        assert bytes(r.edited_fingerprint) == (prints[1].tobytes() if filled[1] else b"")
        assert r.near_edited == pytest.approx(likeness(text, mixture, 1), abs=0.25)
        assert r.near_next == pytest.approx(likeness(text, after, 1), abs=0.25)


def test_repeated_ids_and_rows(spark):
    rows = [(1, "same text of all"), (1, "same text of all"), (1, "another text"), (None, "z"), (None, "z"), (2, None)]
    found = P.edit_next(docs(spark, [(d, t, None) for d, t in rows])).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in found) == sorted((str(d), len(t or "")) for d, t in rows)
    whole = [r for r in found if r.n_chars == 16]
    assert len({bytes(r.fingerprint) for r in whole}) == 1


@pytest.mark.parametrize("size", [1, 2, 5])
def test_estimates_follow_the_similarity(size):
    draw, errors = random.Random(10), []
    words = [f"w{i}" for i in range(150)]
    for _ in range(150):
        a = draw.choices(words, k=draw.randint(1, 200))
        b = a[: draw.randint(0, len(a))] + draw.choices(words, k=draw.randint(0, 150))
        a, b = " ".join(a), " ".join(b)
        s, filled = P.signatures(pa.array([a, b], pa.string()), size)
        errors.append(P.likeness(s[0], s[1], filled[0], filled[1]) - likeness(a, b, size))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.055


def test_fingerprints_do_not_depend_on_company():
    texts = [t for _, t, _ in mixed(11, 20)] + ["x y " * 3000]
    every, _ = P.signatures(pa.array(texts, pa.string()))
    for i in (0, 7, 20):
        assert (P.signatures(pa.array([texts[i]], pa.string()))[0][0] == every[i]).all()


def test_many_terms_go_in_pieces(monkeypatch):
    texts = [" ".join(f"t{i * 7 % 900}" for i in range(n)) for n in (0, 3, 800, 50)]
    whole, _ = P.signatures(pa.array(texts, pa.string()))
    for name, value in (("_PAIRS", 64), ("_ROWS", 16), ("_TERMS", 8)):
        monkeypatch.setattr(P, name, value)
    assert (P.signatures(pa.array(texts, pa.string()))[0] == whole).all()


def test_fingerprint_of_every_row(spark):
    rows = P.fingerprint(docs(spark, [(1, "a b", None), (None, None, None), (2, "a b", None)])).collect()
    prints = {str(r.doc_id): bytes(r.fingerprint) for r in rows}
    assert prints["1"] == prints["2"] != b"" and prints["None"] == b""
