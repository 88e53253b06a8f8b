"""Operator 13, fill-in-middle transformation over a sparse exception index.

Texts are cut in their UTF-8 bytes, as they come in Arrow batches. Of a batch only the multibyte
characters are recorded: the position of each one's first byte, and by how many bytes it exceeds one (summed
up). A position in bytes becomes one in code points by taking off the excess before it, found with one
``searchsorted``; the other way round it is added. Between exceptions, which is everywhere in ASCII texts, the
conversion is plain arithmetic: no text is decoded and no index has an entry per character.

A text has ``n`` units: words with the white space before them, and white space at the end (``unit="words"``), or
code points (``unit="chars"``). Two hashes of the seed and the id choose two cuts among the n + 1 places, a third
whether the text is transformed (``rate`` of 100), a fourth the order of the parts (``spm`` of 100):

    psm    <P> prefix <S> suffix <M> middle          spm    <S> suffix <P> prefix <M> middle

Rows are independent: there is no shuffle, and a lost task is simply run again.

Defined results: null is read as empty; empty texts, and those that hold a sentinel, stay plain (null lengths); a
null id is hashed as no text; rows that share an id get the same hashes, each with its own text. A text of any
length is cut whole. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_bytes

SEED, RATE, SPM = 42, 50, 80
#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Exceptions:
    """Where the multibyte characters of some bytes are, and their excess; converts positions both ways."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([[0], np.cumsum(excess)])  # excess of the first k exceptions
        self.char = self.at - self.before[:-1]  # the exceptions' own places in code points

    def to_chars(self, byte: np.ndarray) -> np.ndarray:
        """Code points before a byte position (at a character's start)."""
        return byte - self.before[np.searchsorted(self.at, byte)]

    def to_bytes(self, char: np.ndarray) -> np.ndarray:
        return char + self.before[np.searchsorted(self.char, char)]


def word_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte positions after every word, and how many of them come up to each of ``offsets``."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = inside[ends]  # a word never spans two texts
    after = np.flatnonzero(last) + 1
    return after, np.searchsorted(after, offsets, "right")


def sentinels(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a sentinel."""
    marks = [ord(x[1]) for x in (PREFIX, SUFFIX, MIDDLE)]
    hit = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")) & np.isin(data[1:-1], marks)) if len(data) > 2 else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, hit, "right") - 1
    whole = hit + 3 <= offsets[text + 1]
    return np.isin(np.arange(len(offsets) - 1), text[whole])


def cuts(data, offsets, first, second, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Exceptions]:
    """Units of every text, the byte positions of its two cuts, and the exceptions."""
    index = Exceptions(data)
    start, end = offsets[:-1], offsets[1:]
    if unit == "chars":
        n = index.to_chars(end) - index.to_chars(start)
        lo, hi = np.sort([first % (n + 1), second % (n + 1)], 0)
        return n, index.to_bytes(index.to_chars(start) + lo), index.to_bytes(index.to_chars(start) + hi), index
    after, upto = word_ends(data, offsets)
    words = np.diff(upto)
    # white space after the last word
    rest = np.where(words > 0, after[np.maximum(upto[1:] - 1, 0)] if len(after) else 0, start) < end
    n = words + rest

    def place(unit_no):
        inner = (unit_no > 0) & (unit_no <= words)
        at = after[np.where(inner, upto[:-1] + unit_no - 1, 0)] if len(after) else start
        return np.where(unit_no == 0, start, np.where(inner, at, end))

    lo, hi = np.sort([first % (n + 1), second % (n + 1)], 0)
    return n, place(lo), place(hi), index


def _cutting(rate: int, spm: int, unit: str):
    def make():
        def work(batch):
            data, offsets = text_bytes(batch.column("_text"))
            h = [batch.column(f"_h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4)]
            n, lo, hi, index = cuts(data, offsets, h[0], h[1], unit)
            plain = (offsets[:-1] == offsets[1:]) | sentinels(data, offsets) | (h[2] % 100 >= rate)
            spm_form = h[3] % 100 < spm
            prefix = index.to_chars(lo) - index.to_chars(offsets[:-1])
            middle = index.to_chars(hi) - index.to_chars(lo)
            p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
            out, form = [], []
            raw = data.tobytes()
            for i in range(len(n)):
                a, b, c, d = offsets[i], lo[i], hi[i], offsets[i + 1]
                if plain[i]:
                    out.append(raw[a:d])
                    form.append("plain")
                elif spm_form[i]:
                    out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
                    form.append("spm")
                else:
                    out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                    form.append("psm")
            return pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(out, pa.binary()).cast(pa.string()),
                 pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain)],
                names=["_id", "n", "form", "output", "prefix_chars", "middle_chars"])

        return work

    return make


def transform(documents: DataFrame, *, id_col="doc_id", text_col="text", seed: int = SEED, rate: int = RATE, spm: int = SPM,
              unit: str = "words") -> DataFrame:
    """Per row: ``id, n, form, output, prefix_chars, middle_chars``."""
    if unit not in ("words", "chars"):
        raise ValueError(f"unknown unit {unit!r}")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), key.alias("_key"))
    hashed = narrow.select("_id", "_text", *[
        F.conv(F.substring("_key", 1 + 8 * k, 8), 16, 10).cast("long").alias(f"_h{k + 1}") for k in range(4)])
    kind = narrow.schema["_id"].dataType.simpleString()
    out = map_batches(hashed, _cutting(rate, spm, unit),
                      f"_id {kind}, n long, form string, output string, prefix_chars long, middle_chars long")
    return out.withColumnRenamed("_id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of: the parts between the sentinels, put in order again."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    suffix = F.when(form == "psm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document cut for filling in the middle; digests of the outputs and of the restored texts."""
    out = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                      digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM hashed),
placed AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS lo, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT *, array_to_string(w[1:lo], '') AS prefix, array_to_string(w[lo + 1:hi], '') AS middle,
         array_to_string(w[hi + 1:], '') AS suffix FROM placed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
