"""The operators on small awkward tables, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from helpers import AWKWARD, components, held_out, low, near_duplicates, substrings, unigrams, words
from pyspark.sql import functions as F

from dockhand.llm import attention, blocks, chat, contamination, language, licenses, minhash, mixing, pii, scoring, store
from dockhand.llm import substrings as S
from dockhand.llm import vectors

DOCS = "doc_id bigint, text string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame(rows, DOCS).repartition(parts) if rows else spark.createDataFrame([], DOCS)


def plain(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def corpus(seed, n=60, vocabulary=40):
    """Random texts with copies, near copies and shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.5:
            w = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = word()
            text = " ".join(w)
        else:
            w = [word() for _ in range(rng.randrange(0, 60))]
            if kind > 0.8:
                at = rng.randrange(len(w) + 1)
                w[at:at] = passage[rng.randrange(8) :]
            text = " ".join(w)
        rows.append((rng.randrange(1000) * 60 + i, text))
    rng.shuffle(rows)
    return rows


# --- components ------------------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    links += [(rng.randrange(300, 380), rng.randrange(300, 380)) for _ in range(60)]
    found = store.components(spark.createDataFrame(links, "a bigint, b bigint"), "t")
    expected = components({x for p in links for x in p}, links)
    assert dict(map(tuple, found.collect())) == {n: r for n, r in expected.items() if any(n in p and p[0] != p[1] for p in links)}
    assert store.components(store.nothing(spark, "a bigint, b bigint"), "t").count() == 0


# --- 1 language ---------------------------------------------------------------------------------


def test_language_is_learned_and_unknown_is_und(spark):
    sample = {"en": "the cat and the dog with this", "de": "der hund und die katze mit über", "fr": "le chien et la forêt avec été"}
    rng = random.Random(1)
    rows = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        w = sample[lang].split()
        rows.append((i, " ".join(rng.choice(w) for _ in range(12)), None if i % 10 == 0 else lang, "clash"))
    rows += [(100, None, "en", ""), (101, "12 34 !", "en", ""), (102, "", None, ""), (103, "Über die Katze", None, ""), (104, "the dog " * 30000, None, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    model = language.fit(table)
    found = {r.doc_id: r for r in language.predict(table, model).collect()}
    assert len(found) == len(rows) and found[103].lang_pred == "de" and found[104].lang_pred == "en"
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (100, 101, 102))
    assert all(found[i].lang_pred == ("en", "de", "fr")[i % 3] and 0 <= found[i].score <= 1 for i in range(90))
    nothing = language.fit(table.where("false"))
    assert {r.lang_pred for r in language.predict(table, nothing).collect()} == {"und"}
    assert language.predict(table.where("false"), model).count() == 0


def test_language_scores_equal_a_plain_sum(spark):
    table = spark.createDataFrame([(0, "aab b", "x"), (1, "bba ab", "y"), (2, "ab", None)], "doc_id bigint, text string, lang string")
    model = language.fit(table, orders=(1, 2), buckets=1 << 14)
    grams = lambda t: [t[i : i + n] for n in (1, 2) for i in range(len(t) - n + 1)]
    sums = []
    for text in ("aab b", "bba ab"):
        g = grams(text)
        sums.append(math.log(0.5) + sum(math.log(g.count(x) + 0.5) - math.log(len(g) + 0.5 * (1 << 14)) for x in grams("ab")))
    share = 1 / sum(math.exp(s - max(sums)) for s in sums)
    row = next(r for r in language.predict(table, model).collect() if r.doc_id == 2)
    assert row.score == pytest.approx(share, rel=1e-4) and row.lang_pred == ("x", "y")[int(np.argmax(sums))]


def test_held_out_rows(spark):
    table = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("h", language.held_out("doc_id", 5, 0))
    assert all(r.h == held_out(r.doc_id, 5, 0) for r in table.collect())


def test_copies_of_few_texts_do_not_lose_a_language(spark):
    german = ["der hund und die katze schlafen", "wir gehen heute in den wald", "das wetter ist schön geworden"]
    rng = random.Random(5)
    english = [" ".join(rng.choices(["the", "dog", "and", "cats", "sleep", "we", "walk", "into", "woods"], k=8)) for _ in range(300)]
    rows = [(i, german[i % 3], "de") for i in range(3000)] + [(3000 + i, t, "en") for i, t in enumerate(english)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for seed in (1, 2, 3):
        model = language.fit(table, buckets=1 << 12, docs_per_language=50, seed=seed)
        wrong = language.predict(table, model).where("lang <> lang_pred").count()
        assert wrong == 0


# --- 2 licenses -----------------------------------------------------------------------------------


def test_scan_of_awkward_texts(spark):
    rows = [*AWKWARD, (20, "Under the MIT License. under the mit license"), (21, "cc-by-nc, Apache License, Version 2.0")]
    found = {r.doc_id: r for r in licenses.scan(docs(spark, rows)).collect()}
    assert [p.word for p in found[20].places] == [0, 4] and found[20].score == 1
    assert {p.label for p in found[21].places} == {"cc-by-nc", "apache-2"}
    assert found[2].n_words == found[3].n_words == found[4].n_words == 0 and found[6].n_words == 6
    assert licenses.scan(docs(spark, [])).count() == 0


# --- 3 personal data ---------------------------------------------------------------------------------


def test_pseudonyms_link_documents(spark):
    rows = [(1, "ip 10.1.2.3 here"), (2, "again 10.1.2.3"), (3, None), (4, ""), (5, "nothing at all 12"), (2, "again 10.1.2.3")]
    table = docs(spark, rows).withColumn("found", F.lit("clash"))
    got = {r.doc_id: r for r in pii.pseudonymize(table, b"k", found="found").collect()}
    assert got[1].found[0].pseudonym == got[2].found[0].pseudonym and "10.1.2.3" not in got[1].text
    assert got[3].text is None and got[4].text == "" and got[5].text == "nothing at all 12"
    assert pii.pseudonymize(table, b"k").columns == table.columns and pii.pseudonymize(docs(spark, []), b"k").count() == 0


# --- 4 substrings ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [AWKWARD, corpus(1), corpus(2, 120, 6), []], ids=["awkward", "mixed", "dense", "empty"])
def test_substrings_equal_brute_force(spark, rows):
    found = S.deduplicate(docs(spark, rows).withColumn("batch", F.lit("clash")), batch_bytes=700, block_keys=150)
    assert plain(found, "doc_id", "n_words", "n_removed", "kept_sha256") == substrings(rows)
    for r in found.collect():
        covered = {i for f in r.factors for i in range(f.start, f.start + f.length)}
        assert len(covered) == r.n_removed and all(f.length >= 13 and f.reference != r.doc_id for f in r.factors)


# --- 5 vectors ------------------------------------------------------------------------------------------


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    centers = rng.standard_normal((12, 16))
    rows = [(i, [float(x) for x in centers[i % 12] + rng.standard_normal(16) * (0.05 if i % 12 < 6 else 0.12)]) for i in range(240)]
    rows += [(300 + i, rows[0][1]) for i in range(20)] + [(301, rows[0][1]), (400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16),
             (404, [None] + [1.0] * 15), (405, [float("inf")] + [1.0] * 15), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, [3e-300, 0.0]), (409, [1.0, 0.0]), (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    ok = [(i, np.array(v, float)) for i, v in rows if v and i is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = [(i, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())) for i, v in ok]
    pairs = [(p, q) for p in range(len(unit)) for q in range(len(unit)) if p != q and len(unit[p][1]) == len(unit[q][1]) and unit[p][1] @ unit[q][1] >= 0.95]
    links = {}
    for p, _ in pairs:
        links[p] = links.get(p, 0) + 1
    root = components({i for i, _ in rows if i is not None}, [(unit[p][0], unit[q][0]) for p, q in pairs])
    expected = sorted([(unit[p][0], links.get(p, 0), root[unit[p][0]]) for p in range(len(unit))] + [(i, 0, i) for i in (400, 401, 402, 403, 404, 405, None)], key=str)
    found = vectors.near_duplicates(table, window=32, tile=16, passes=12)
    assert plain(found, "vec_id", "n_links", "component_id") == expected
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in found.collect())
    assert vectors.near_duplicates(table.where("false")).count() == 0


def skewed(n, pairs, seed=1, dim=64, common=0.9):
    """n vectors of which a third has pairwise cosines of about `common`, and as many more pairs of
    cosine 0.955 as told in that third: (vectors, their number of links by brute force)."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    cloud = unit(math.sqrt(common) * unit(rng.standard_normal(dim)) + math.sqrt(1 - common) * unit(rng.standard_normal((n // 3, dim))))
    first = cloud[:pairs]
    side = rng.standard_normal((pairs, dim))
    side = unit(side - (side * first).sum(1, keepdims=True) * first)
    all_of = np.concatenate([cloud, unit(rng.standard_normal((n - n // 3, dim))), 0.955 * first + math.sqrt(1 - 0.955**2) * side])
    return all_of, np.concatenate([(all_of[i : i + 1000] @ all_of.T >= 0.95).sum(1) - 1 for i in range(0, len(all_of), 1000)])


@pytest.mark.parametrize("tile", [32, 4096])
def test_links_in_a_dense_cloud_are_found(spark, tile):
    given, links = skewed(4000, 150)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(given)], "vec_id bigint, embedding array<double>").repartition(4)
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(table, window=32, tile=tile).collect()}
    got, expected = np.array([found[i] for i in range(len(given))]), links
    assert (got <= expected).all() and got.sum() >= 0.98 * expected.sum() > 0


def test_passes_grow_with_the_number_of_vectors():
    assert vectors.passes_for(1000, 0.95, 1024) == 4
    assert vectors.passes_for(10**6, 0.95, 1024) < vectors.passes_for(10**9, 0.95, 1024)


# --- 6 chats -----------------------------------------------------------------------------------------------


def test_chats_are_read_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "a\\b\\\\", "<s>\\</s>", "<<SYS>>\n<</SYS>>", "[ROLE]x[/ROLE]y[/TURN]\n", "", " lead", "<", "[", "\\", "ü\U0001f600", "$1 \\1 \n [/INST]\n"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "system", "be"), (2, 1, "user", "u"), (2, 2, "assistant", "a"), (3, 0, "assistant", "first"), (4, 0, "tool[/ROLE]", "t"), (4, 1, None, None),
             (5, 0, "user", "x"), (5, 0, "user", "x"), (None, None, "user", "no id"), (6, 0, "user", "long " * 50000), (6, 1, "assistant", "[INST]" * 20000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("state", F.lit("clash")).repartition(4)
    chats = chat.format_chats(table).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("learned", chat.learned(F.col("segments")))
    found = {r.conv_id: r for r in chats.collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda x: (x[0] is not None, x))
        assert [(t.role, t.text) for t in found[conv].turns] == [(r, x) for _, r, x in turns]
        assert found[conv].learned == "".join(x for _, r, x in turns if r == "assistant")
        assert found[conv].formatted == "".join(s.text for s in found[conv].segments)
    assert [c for c in found if found[c].valid and c is not None] and {c for c in found if found[c].valid} == {1, 2, 6}
    assert chat.format_chats(table.where("false")).count() == 0


def test_no_control_string_is_left_in_texts(spark):
    table = spark.createDataFrame([("<<<SYS>>>[[INST]</s></s>[/TURN]",)], "t string")
    text = table.select(chat.escape(F.col("t"), chat.TEMPLATE)).first()[0]
    assert not any(c in text for c in chat.TEMPLATE.control)


# --- 7 scoring ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [AWKWARD, corpus(5), []], ids=["awkward", "mixed", "empty"])
def test_scores(spark, rows):
    train = lambda d: d is not None and not held_out(d, 7, 2)
    table = docs(spark, rows)
    found = scoring.score(table, ~language.held_out("doc_id", 7, 2), batch_bytes=900, block_keys=50)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found.collect()), key=str)
    expected = unigrams(rows, train)
    assert got == sorted(((d, *expected[i][:3], round(expected[i][3], 6)) for i, (d, _) in enumerate(rows)), key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found.collect())


def test_scores_do_not_depend_on_batches(spark):
    rows = corpus(6, 30)
    score = lambda n: plain(scoring.score(docs(spark, rows), F.lit(True), batch_bytes=n).select("doc_id", F.round("score", 3).alias("s")), "doc_id", "s")
    assert score(300) == score(1 << 20)


def test_every_training_text_is_learned_from_once(spark):
    rows = corpus(7, 60) + [(5001, "ein zwei drei " * 400), (5002, None)]
    train = F.coalesce(~language.held_out("doc_id", 7, 2) & F.col("doc_id").isNotNull(), F.lit(False))
    batches = blocks.pack(docs(spark, rows), "text", {"train": train}, 900).select("batch", "payload")
    tokens = batches.mapInArrow(scoring._tokenize(scoring.VOCABULARY), scoring.TOKENS).toPandas()
    sizes, seen = {}, 0
    made = attention.Model.start(attention.Layout.of(np.ones(scoring.tokenizer(scoring.VOCABULARY)[2] + 1)), np.ones(scoring.tokenizer(scoring.VOCABULARY)[2] + 1), np.ones((attention.ROWS, attention.CLASSES)), 1)
    for turn, payload in tokens[tokens.turn >= 0][["turn", "payload"]].itertuples(index=False):
        assert 0 <= turn < scoring.ROUNDS
        x, y, first, _ = scoring._blocks(payload, scoring.VOCABULARY)
        seen += made.gradient(x, None, y, first)[1]
        sizes[turn] = sizes.get(turn, 0) + len(x)
    learned = tokens[tokens.turn == scoring.COUNTS].n.sum()  # subwords of training texts and their ends
    assert seen == learned > 0
    assert len(sizes) == scoring.ROUNDS
    n_train = sum(d is not None and not held_out(d, 7, 2) for d, _ in rows)
    assert sum(len(scoring._unpacked(p)[1]) for p in tokens[tokens.turn >= 0].payload) == n_train
    assert sum(len(scoring._unpacked(p)[1]) for p in tokens[tokens.turn != scoring.COUNTS].payload) == len(rows)


# --- 8 mixing ------------------------------------------------------------------------------------------------


def mixed_by_hand(rows, weights, total, epochs, seed):
    """rows: (doc_id, n_tokens, path)."""
    tokens = {}
    for _, n, path in rows:
        if n:
            tokens[path] = tokens.get(path, 0) + n
    capacity = {}
    for path, n in tokens.items():
        for depth in range(4):
            capacity[path[:depth]] = capacity.get(path[:depth], 0) + n * epochs
    budget = {(): min(total, capacity.get((), 0))}
    for depth in range(3):
        for node in sorted({p[:depth] for p in tokens}):
            children = sorted({p[: depth + 1] for p in tokens if p[:depth] == node})
            w = {c: (weights.domains, weights.languages, weights.sources)[depth].get(c[-1], weights.default) for c in children}
            left, open_ = budget[node], set(children)
            while full := {c for c in open_ if capacity[c] * sum(w[x] for x in open_) <= w[c] * left}:
                c = min(full, key=lambda c: (capacity[c] / w[c], c))
                budget[c] = capacity[c]
                left -= capacity[c]
                open_.discard(c)
            for c in open_:
                budget[c] = w[c] * left // sum(w[x] for x in open_)
    out = []
    for path, n in tokens.items():
        own = [(d, k) for d, k, p in rows if p == path and k]
        whole, rest = divmod(budget[path], n)
        out += [(d, e, k) for d, k in own for e in range(whole)]
        for d, k in sorted(own, key=lambda x: hashlib.md5(f"{seed}:{whole}:{'' if x[0] is None else x[0]}".encode()).hexdigest()):
            if rest > 0:
                out.append((d, whole, min(k, rest)))
                rest -= k
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0, 2.5, 99.0])
def test_mixing_equals_a_plain_version(spark, share):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40])), rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c"])) for i in range(200)]
    weights = mixing.Weights(domains={"x": 3}, languages={"en": 2}, sources={"c": 9})
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("taken", F.lit("clash"))
    domain = F.when(F.col("source") == "a", "x").otherwise("y")
    total = int(sum(len(words(r[1])) for r in rows) * share)
    found = mixing.mix(table, weights, share, 3, 5, domain=domain)
    by_hand = [(d, len(words(t)), ("x" if s == "a" else "y", lang or "unknown", s)) for d, t, lang, s in rows]
    assert plain(found, "doc_id", "epoch", "taken") == mixed_by_hand(by_hand, weights, total, 3, 5)
    assert sum(r.taken for r in found.collect()) <= total


def test_mixing_of_awkward_rows(spark):
    table = docs(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    every = mixing.mix(table, mixing.Weights(), 1.0, 2, 1)
    total = sum(len(words(t)) for _, t in AWKWARD)
    assert sum(r.taken for r in every.collect()) == total and {r.language for r in every.collect()} == {"unknown"}
    part = mixing.mix(table, mixing.Weights(), 0.5, 2, 1).withColumn("cut", mixing.prefix("text"))
    assert all(len(words(r.cut)) == r.taken for r in part.collect())
    assert mixing.mix(table.where("false"), mixing.Weights()).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(table, mixing.Weights(default=0))


# --- 9 near-duplicates --------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [AWKWARD, corpus(3, 100), []], ids=["awkward", "mixed", "empty"])
@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, rows, size):
    found = minhash.near_duplicates(docs(spark, rows).withColumn("rep", F.lit("clash")), size)
    assert plain(found, "doc_id", "n_shingles", "component_id", "kept") == near_duplicates(rows, size)


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 16)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(2, 14)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    found = minhash.near_duplicates(docs(spark, rows), 2)
    assert plain(found, "doc_id", "n_shingles", "component_id", "kept") == near_duplicates(rows, 2)


def test_one_outlier_beside_many_copies_is_compared_once_each(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    rows = [("b", i, 0, i % 3 == 0) for i in range(400)] + [("b", 1000 + i, 1000 + i, False) for i in range(3)] + [("b", 2000 + i, 2000, False) for i in range(20)]
    given = spark.createDataFrame([r[:3] for r in rows], "band string, rep long, root long")
    dealt = minhash._Search.dealt(given).collect()
    assert len(dealt) == len(rows)
    tiles = {}
    for r in dealt:
        tiles.setdefault((r.own, r.tile), []).append(r.rep)
    assert {own for own, _ in tiles} == {0, 2000, None}
    assert sorted(x for own, t in tiles for x in tiles[own, t] if own is None) == [1000, 1001, 1002]
    assert all(len(x) <= 24 for x in tiles.values()) and len([1 for own, _ in tiles if own == 0]) > 30


# --- 10 contamination ---------------------------------------------------------------------------------------


def test_contamination_in_blocks(spark):
    items = [" ".join(f"i{k}w{j}" for j in range(18)) for k in range(5)]
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, ""), (None, items[0]), (0, items[0]), (11, "five short words stand here")], "item_id bigint, text string")
    rows = [(1, "clean text of many words that is not in it at all you see it now"), (2, "pre " + items[3] + " post"), (3, items[1].replace("w5", "x").replace("w9", "x") + " " + items[4]),
            (4, None), (5, ""), (6, "so five SHORT words, stand here!"), (2, items[2]), (7, " ".join(items[0].split()[:12]))]
    table = docs(spark, rows).withColumn("item_id", F.lit("clash"))
    found = contamination.matches(table, bench, block_bytes=150)
    got = sorted((r.doc_id, sorted({c.item_id for c in r.contamination})) for r in found.collect())
    assert got == [(1, []), (2, [2]), (2, [3]), (3, [1, 4]), (4, []), (5, []), (6, [11]), (7, [])]
    clean = contamination.matches(table, bench, only_clean=True, block_bytes=150)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 4, 5, 7] and clean.columns == table.columns
    assert contamination.matches(table.where("false"), bench).count() == 0
    assert {len(r.contamination) for r in contamination.matches(table, bench.where("false")).collect()} == {0}


def test_short_and_nameless_items(spark):
    question = "which of these eleven words was replaced by another one here"
    bench = spark.createDataFrame([(1, question), (2, "four words of it"), (3, "yes"), (None, "an item that has no id but nine words")], "item_id bigint, text string")
    rows = [(1, "so: " + question.replace("eleven", "twelve") + "?"), (2, "there are four words of it in this text"), (3, "yes it is"), (4, "Yes!"),
            (5, "see an item that has no id but nine words."), (6, question.replace("eleven", "x").replace("another", "y")), (7, "three words of it")]
    found = contamination.matches(docs(spark, rows), bench)
    got = {r.doc_id: [(c.item_id, c.length, c.differing) for c in r.contamination] for r in found.collect()}
    assert got == {1: [(1, 11, 1)], 2: [(2, 4, 0)], 3: [], 4: [(3, 1, 0)], 5: [(None, 9, 0)], 6: [], 7: []}


def test_lower_case_is_ascii_only():
    assert low("ÉA") == "Éa"
