"""Every stage of the pipeline against a plain version, each on what the one before kept."""

import os
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from helpers import low, near_duplicates, words
from pyspark.sql import functions as F
from test_spark import mixed_by_hand

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as P  # noqa: E402
from dockhand.llm import contamination, mixing, pii  # noqa: E402
from dockhand.llm.queries import DOMAINS, MIX, WEIGHTS, PII_KEY, table  # noqa: E402

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


def contaminated(text, items, width=13, wrong=2):
    token = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    b = np.array(token(text))
    for item in items:
        a = np.array(token(item))
        n = min(len(a), width)
        most = n * wrong // width
        if not n or len(b) < n or (n < contamination.SHORTEST and len(b) != n):
            continue
        same = a[:, None] == b[None, :]
        for k in range(-len(a) + 1, len(b)):
            d = np.diagonal(same, k)
            if len(d) >= n and (np.convolve(d, np.ones(n), "valid") >= n - most).any():
                return True
    return False


def test_stages(spark):
    extra = [(10**6, None, None, "src1"), (10**6 + 1, "", "en", None), (10**6 + 2, "12 !!", "en", "src2"), (None, "the and of it was of the and", None, None)]
    docs = table(spark, SF_DIR, "documents")
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string"), allowMissingColumns=True)
    copy = docs.where("doc_id = 3")
    docs = docs.unionByName(copy).withColumn("score", F.lit("clash"))
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    for name, stage in P.STAGES:
        before = docs.collect()
        docs = P.written(stage(spark, docs, SF_DIR), name)
        after = docs.collect()
        ids = sorted((r.doc_id for r in after), key=str)
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
        if name == "language_id":
            letters = [r for r in before if re.search(r"[^\W\d_]", r.text or "")]
            assert ids == sorted((r.doc_id for r in letters), key=str)
            assert next(r.lang for r in after if r.doc_id is None) is not None
        elif name == "near_duplicates":
            rows = near_duplicates([(r.doc_id, r.text) for r in before], 5)
            assert ids == sorted({d for d, _, _, kept in rows if kept}, key=str) and len(ids) < len(before)
        elif name == "decontamination":
            assert ids == sorted((r.doc_id for r in before if not contaminated(r.text, items)), key=str)
        elif name == "pii":
            change = pii.permutation(PII_KEY)
            expected = {r.doc_id: pii.apply(r.text, pii.find(r.text, change)) for r in before}
            assert {r.doc_id: r.text for r in after} == expected and all(r.n_chars == len(r.text) for r in after)
        else:
            of = {f"src{i}": k for k, v in DOMAINS.items() for i in v}
            rows = [(r.doc_id, len(words(r.text)), (of.get(r.source, "other"), r.lang or "unknown", r.source or "unknown")) for r in before]
            total = int(sum(n for _, n, _ in rows) * MIX["share"])
            assert sorted(((r.doc_id, r.epoch, r.taken) for r in after), key=str) == mixed_by_hand(rows, WEIGHTS, total, MIX["max_epochs"], MIX["seed"])
            assert all(len(words(r.text)) == r.taken for r in after)


def test_stages_take_empty_tables(spark):
    empty = table(spark, SF_DIR, "documents").where("false")
    for name, stage in P.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0, name


def test_run_is_the_stages(spark):
    found = P.run(spark, SF_DIR)
    assert {"doc_id", "text", "lang", "source", "n_chars", "epoch", "taken", *mixing.LEVELS} <= set(found.columns) and found.count() > 0
