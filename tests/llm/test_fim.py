"""Fill-in-middle against a plain-Python version, both units, and edge rows."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from relayout.llm import fim
from test_operators import CLASH, EDGE, SCHEMA

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "\n\t ", "a", " a", "a ", "ä ö  ü\n", "日本 語 😀 x", "😀😀 \x1c y\x85z", "x <P> y", "<S", "a <M", ">", "ok <M> b",
         "é" * 50, " ".join("wörd%d" % i for i in range(300)), "x" * 100_000 + " é " + "y" * 1000, "\x0b\x0c a \x1f b c"]


def brute(doc_id, text, unit="words", rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text) if unit == "words" else list(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", text, None, None
    p, m, s = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


@pytest.mark.parametrize("unit", ["words", "chars"])
def test_against_plain_python(spark, unit):
    rows = [(10 * k + j, t) for j in range(8) for k, t in enumerate(TEXTS)] + [(None, "no id é"), (7, "same id"), (7, "same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(7).alias(c) for c in CLASH + ["form", "output"]])
    out = fim.transform(df, unit=unit, rate=90)
    got = sorted(map(repr, map(tuple, out.collect())))
    assert got == sorted(repr((i, *brute(i, t, unit, 90))) for i, t in rows)
    assert out.where(~fim.restore(F.col("output"), F.col("form")).eqNullSafe(F.col("output")) & (F.col("form") == "plain")).isEmpty()
    texts = df.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")).distinct()
    back = out.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), fim.restore(F.col("output"), F.col("form")).alias("t")).distinct()
    assert texts.exceptAll(back).isEmpty() and back.exceptAll(texts).isEmpty()
    assert {f for f, in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_exceptions_both_ways():
    text = "aé日😀b" * 7 + "plain" + "ü"
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.Exceptions(data)
    assert len(index.at) == 3 * 7 + 1
    chars = np.arange(len(text) + 1)
    byte = np.array([len(text[:k].encode()) for k in chars])
    assert (index.to_bytes(chars) == byte).all() and (index.to_chars(byte) == chars).all()


def test_edge_rows(spark):
    edge = spark.createDataFrame(EDGE, SCHEMA).select("*", *[F.lit(7).alias(c) for c in CLASH])
    assert fim.transform(edge).count() == len(EDGE)
    assert fim.transform(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        fim.transform(edge, unit="lines")
