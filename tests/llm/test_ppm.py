"""PPM scores against a plain-Python model, and its probabilities against one."""

import collections
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from relayout.llm import ppm
from test_operators import CLASH, EDGE, SCHEMA

SMOKE, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


class Model:
    """Counts of every context up to the order; probabilities by escapes with exclusion, one symbol at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, collections.defaultdict(collections.Counter)
        for t in texts:
            s = [ppm.START] * order + list((t or "").encode()) + [ppm.END]
            for i in range(order, len(s)):
                for k in range(order + 1):
                    self.seen[tuple(s[i - k:i])][s[i]] += 1

    def p(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            all_seen = self.seen.get(tuple(context[len(context) - k:]), {})
            left = {s: n for s, n in all_seen.items() if s not in excluded}
            total = sum(left.values())
            half = 0 if len(all_seen) == 257 else 0.5
            if symbol in left:
                return p * (left[symbol] - half) / total
            if left:
                p *= half * len(left) / total
            excluded |= set(left)
        return p / (257 - len(excluded))

    def score(self, text):
        s = [ppm.START] * self.order + list((text or "").encode()) + [ppm.END]
        return sum(math.log10(self.p(s[i - self.order:i], s[i])) for i in range(self.order, len(s)))


def brute_base(texts, learned):
    tokens = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\x20\x09-\x0D]+", t or "")] + [None] for t in texts]
    c = collections.Counter(x for t, ok in zip(tokens, learned, strict=True) if ok for x in t)
    total, v = sum(c.values()), len(c)
    return [(len(t), sum(c[x] > 0 for x in t), total, sum(math.log10((c[x] + .5) / (total + .5 * (v + 1))) for x in t)) for t in tokens]


def check(df, rows, learned, order):
    got = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.score))
    model = Model([t for (_, t), ok in zip(rows, learned, strict=True) if ok], order)
    want = [(i, ok, *b, model.score(t)) for (i, t), ok, b in zip(rows, learned, brute_base([t for _, t in rows], learned), strict=True)]
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[-1]))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert (g.doc_id, g.learned, g.n_tokens, g.n_known, g.train_tokens) == w[:5]
        assert math.isclose(g.base_score, w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g.score, w[6], rel_tol=1e-9, abs_tol=1e-9)


def test_probabilities_sum_to_one():
    model = Model(["abracadabra", "abc", "", "bra"], 3)
    for context in ([257, 257, 257], list(b"abr"), list(b"zbr"), list(b"xyz"), list(b"aab")):
        assert math.isclose(sum(model.p(context, s) for s in range(257)), 1.0)
    full = Model([bytes(range(128)).decode() * 2], 1)
    assert math.isclose(sum(full.p([5], s) for s in range(257)), 1.0)


@pytest.mark.parametrize("order", [1, 4])
def test_small_documents(spark, order):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, (t or "")[:600]) for i, t in rows[:80]] + [(900, None), (901, ""), (902, "ÄÖ ü 😀 \x00 end"), (902, "dup"), (902, "dup")]
    learned = [i % 3 != 1 for i, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(7).alias(c) for c in CLASH + ["slice", "what"]])
    check(ppm.score(df, F.col("doc_id") % 3 != 1, order=order), rows, learned, order)


def test_slices_and_long_texts(spark, monkeypatch):
    """Many slices, texts that come in several runs."""
    monkeypatch.setattr(ppm, "SLICE", 500)
    monkeypatch.setattr(ppm, "ENTRIES", 7)
    monkeypatch.setattr(ppm.runs, "__defaults__", (64,))
    rows = [(i, f"text {i % 5} of many words, " * (1 + i % 9)) for i in range(40)] + [(99, "é long " * 300)]
    learned = [i % 2 == 0 for i, _ in rows]
    check(ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 2 == 0), rows, learned, 4)


def test_query_and_edges(spark, tmp_path):
    edge = spark.createDataFrame(EDGE, SCHEMA).select("*", *[F.lit(7).alias(c) for c in CLASH])
    out = ppm.score(edge, F.col("doc_id") != 2)
    assert out.count() == len(EDGE) and out.where("isnan(score) or score >= 0 or base_score >= 0").count() == 0
    assert ppm.score(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    none = ppm.score(edge, F.lit(False)).where("doc_id = 4").first()
    assert math.isclose(none.score, -5 * math.log10(257)) and none.train_tokens == 0 and none.n_known == 0
    with pytest.raises(ValueError):
        ppm.score(edge, F.lit(True), order=7)


def test_held_out_texts_of_the_corpus(spark):
    """Held-out rows by the contract's rule. The prose is words drawn independently, which unigrams fit best; four
    bytes of context come within a tenth of them."""
    out = ppm.query(spark, SMALL).toPandas()
    held = {i for i in out.doc_id if zlib.crc32(str(i).encode()) % 5 == 1}
    assert set(out.doc_id[out.held_out]) == held and len(out) == 1000
    assert (out.score < 0).all() and out.train_tokens.nunique() == 1
    late = out[out.held_out]
    assert late.score.sum() > 1.1 * late.base_score.sum()
