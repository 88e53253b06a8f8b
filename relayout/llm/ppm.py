"""Operator 11, language-model scoring by prediction by partial matching (PPM) over bytes.

A text is its bytes and one end symbol; before it stand ``order`` start symbols. The byte-context trie is a family
of tables: a row of level k is a node's edge, the code of k context symbols and the symbol that follows (9 bits
each, so codes are exact, no hashes), with how often the texts learned from hold it. A symbol is predicted in
the longest context; if it was never seen there, an escape leads to the context shorter by one, where the symbols of the longer
one are excluded, and so on down to the uniform distribution over what is left of the alphabet. The escape
estimate is method D: of its count, each distinct symbol (of those not excluded) gives a half to the escape, unless all symbols were seen.
The model is pretrained: all counts are fixed before the first text is scored, and a text learned from is scored like any other.

1. One pass over the texts writes them down in *slices* of about ``SLICE`` bytes, each with its distinct codes and words and
   their counts in the texts learned from. The trie's deepest level is their sum over all slices; every other level is
   the sum of the level below it over the oldest symbol. It grows with the corpus and is never collected or broadcast.
2. From the root up, a join of each level with the level above gives every edge its log10 probability, escapes and exclusions
   included. A node has at most 258 edges, so no key of these joins and windows is hot.
3. Each slice gets back the log probabilities of its own codes and the counts of its own words, and meets its texts in a
   cogroup of bounded size (``SLICE`` bytes or one longer text). There, a text's score is a sum of lookups by binary search.

``base_score`` is the unigram model over lower-cased words and an end token, smoothed by a half. Words are told apart by 63-bit hashes.

Defined results: null is read as empty (an end symbol alone); repeated rows and rows that share an id are scored each; a null id
counts as an empty one where the rows to learn from are chosen. Without a text to learn from, the model is
uniform over 257 symbols and the base score that of unseen tokens. Extra columns are not read.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import pieces, slices, stage, text_bytes, word_hashes

ORDER = 4
#: Symbols beside the 256 bytes; bits of a symbol in a code; symbols that can be predicted.
END, START, BITS, ALPHABET = 256, 257, 9, 257
#: Bytes of text in a slice; positions worked on at a time; entries in a row of a slice's counts.
SLICE, RUN, ENTRIES = 32 << 20, 1 << 20, 1 << 16
#: Set in the keys of words, so that a key tells what it is: codes are not negative.
WORD = np.int64(-1 << 63)


# -------------------------------------------------------------------------------------- codes


def runs(offsets: np.ndarray, limit: int = RUN):
    """Runs ``i, j, a, b`` of texts [i, j) and their bytes [a, b); a text longer than ``limit`` comes in several."""
    for i, j in pieces(offsets, limit):
        a = int(offsets[i])
        while a + limit < offsets[j] and j == i + 1:
            yield i, j, a, a + limit
            a += limit
        yield i, j, a, int(offsets[j])


def codes(data: np.ndarray, offsets: np.ndarray, run: tuple[int, int, int, int], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of every position of a run, end symbols included, and the text (from 0) it belongs to."""
    i, j, a, b = run
    lengths = np.minimum(offsets[i + 1:j + 1], b) - np.maximum(offsets[i:j], a)
    text = np.repeat(np.arange(j - i), lengths)
    symbols = np.full(b - a + (j - i) * (order + 1), START, np.int64)
    symbols[np.arange(b - a) + order + text * (order + 1)] = data[a:b]
    symbols[np.cumsum(lengths + order + 1) - 1] = END
    if b < offsets[j]:
        symbols = symbols[:-1]
    if a > offsets[i]:  # in the middle of a text: what came before is the context
        symbols[:order] = data[a - order:a]
    code = symbols[order:].copy()
    for k in range(1, order + 1):
        code |= symbols[order - k:len(symbols) - k] << (BITS * k)
    owner = np.repeat(np.arange(j - i), lengths + 1)[:b - a + (j - i) - (b < offsets[j])]
    return code[symbols[order:] != START], owner


class Counts:
    """Distinct keys and how often each was learned (0 for those only met elsewhere)."""

    def __init__(self):
        self.key, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, learned: np.ndarray) -> None:
        for part, weight in ((keys[learned], 1), (keys[~learned], 0)):
            if len(part):
                new, times = np.unique(part, return_counts=True)
                key, n = np.concatenate([self.key, new]), np.concatenate([self.n, times * weight])
                order = np.argsort(key, kind="stable")
                key, n = key[order], n[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                self.key, self.n = key[first], np.add.reduceat(n, first)


SLICED = "slice long, _id {kind}, _text string, _learn boolean, keys array<bigint>, counts array<bigint>"


def _slicing(order: int, kind: pa.DataType):
    lists = pa.list_(pa.int64())

    def rows(n: int, name: int, **columns):
        empty = {"_id": kind, "_text": pa.string(), "_learn": pa.bool_(), "keys": lists, "counts": lists}
        arrays = [pa.array(np.full(n, name), pa.int64())] + [columns.get(c, pa.nulls(n, t)) for c, t in empty.items()]
        return pa.RecordBatch.from_arrays(arrays, names=["slice", *empty])

    def run(batches):
        name, size, grams, words = None, 0, None, None

        def flush():
            for found in (grams, words):
                for k in range(0, len(found.key), ENTRIES):
                    yield rows(1, name, keys=pa.array([found.key[k:k + ENTRIES]], lists), counts=pa.array([found.n[k:k + ENTRIES]], lists))

        for batch in batches:
            for part in slices(batch) if batch.num_rows else ():
                if name is None:
                    # any name no other slice has: the rows are written once, with it
                    name, size, grams, words = int.from_bytes(os.urandom(8), "big") >> 1, 0, Counts(), Counts()
                data, offsets = text_bytes(part.column("_text"))
                learn = part.column("_learn").to_numpy(zero_copy_only=False).astype(bool)
                for span in runs(offsets):
                    code, owner = codes(data, offsets, span, order)
                    grams.add(code, learn[span[0] + owner])
                for i, j in pieces(offsets):
                    h, n = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                    words.add(h.view(np.int64) | WORD, np.repeat(learn[i:j], n))
                yield rows(part.num_rows, name, _id=part.column("_id"), _text=part.column("_text"), _learn=part.column("_learn"))
                size += len(data)
                if size >= SLICE:
                    yield from flush()
                    name = None
        if name is not None:
            yield from flush()

    return run


# -------------------------------------------------------------------------------------- trie


def levels(edges: DataFrame, order: int) -> list[DataFrame]:
    """The trie from the root on: ``code, c`` of every edge, from those (staged) of the deepest level."""
    found = [edges]
    for k in range(order, 0, -1):
        shorter = F.col("code").bitwiseAND(F.lit((1 << (BITS * k)) - 1))
        found.append(stage(found[-1].groupBy(shorter.alias("code")).agg(F.sum("c").alias("c")), f"trie_{k - 1}"))
    return found[::-1]


def _logs(c: Column, n: Column, escapes: Column, rest: Column) -> Column:
    """log10 probability of a symbol counted ``c`` times of ``n``, or of an escape and then ``rest``, where ``escapes``
    symbols gave half a count each to the escape. (The logarithm of 0 is null, where a quotient would be an error.)"""
    share = lambda x: F.log10(x.cast("double")) - F.log10(n.cast("double"))
    return (F.when(c > 0, share(F.when(escapes > 0, c - F.lit(0.5)).otherwise(c)))
            .otherwise(F.when(escapes > 0, share(escapes * F.lit(0.5))).otherwise(F.lit(0.0)) + rest))


def _escapes(distinct: Column, seen: Column) -> Column:
    """Method D, on the symbols that are not excluded; none where the whole alphabet was ``seen``."""
    return F.when(seen == ALPHABET, F.lit(0)).otherwise(distinct)


def log_probabilities(trie: list[DataFrame]) -> DataFrame:
    """``code, logp`` of the deepest level's edges.

    ``rest`` is the log probability of an unseen symbol after its escape from the node. At the next node, the
    symbols of the node before are excluded: they are among its own, so their counts and number are taken off."""
    node = Window.partitionBy(F.shiftright("code", BITS))
    n, q = F.sum("c").over(node), F.count_if(F.col("c") > 0).over(node)
    root = trie[0].withColumn("n", n).withColumn("q", q)
    known = root.withColumn("rest", -F.log10((ALPHABET - F.col("q")).cast("double")))
    for k, level in enumerate(trie[1:], 1):
        above = known.select(F.col("code").alias("suffix"), F.col("c").alias("c_up"), F.col("n").alias("n_up"),
                             F.col("q").alias("q_up"), F.col("rest").alias("rest_up"))
        both = (level.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << (BITS * k)) - 1))).join(above, "suffix")
                .withColumn("n", n).withColumn("q", q)
                .withColumn("gone", F.sum(F.when(F.col("c") > 0, F.col("c_up")).otherwise(0)).over(node)))
        escapes = _escapes(F.col("q_up") - F.col("q"), F.col("q_up"))
        rest = _logs(F.col("c_up"), F.col("n_up") - F.col("gone"), escapes, F.col("rest_up"))
        known = stage(both.select("code", "c", "n", "q", rest.alias("rest")), f"trie_known_{k}")
    return known.select("code", _logs(F.col("c"), F.col("n"), _escapes(F.col("q"), F.col("q")), F.col("rest")).alias("logp"))


# -------------------------------------------------------------------------------------- scores


def _scoring(order: int, total: int, distinct: int, ends: int):
    def base(c):
        return np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        key, value = known.column("key").to_numpy(), known.column("value").to_numpy()
        at = np.argsort(key)
        key, value = key[at], value[at]
        words = int(np.searchsorted(key, 0))
        word, count, gram, logp = key[:words], value[:words], key[words:], value[words:]
        data, offsets = text_bytes(texts.column("_text"))
        n = len(offsets) - 1
        model, plain, tokens, seen = np.zeros(n), np.zeros(n), np.ones(n, np.int64), np.full(n, int(ends > 0))
        for span in runs(offsets):
            code, owner = codes(data, offsets, span, order)
            i, j = span[:2]
            model[i:j] += np.bincount(owner, logp[np.searchsorted(gram, code)], j - i)
        for i, j in pieces(offsets):
            h, m = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            c = count[np.searchsorted(word, h.view(np.int64) | WORD)] if len(h) else np.zeros(0)
            owner = np.repeat(np.arange(j - i), m)
            plain[i:j] = np.bincount(owner, base(c), j - i)
            seen[i:j] += np.bincount(owner[c > 0], minlength=j - i)
            tokens[i:j] += m
        return pa.table({"_id": texts.column("_id"), "learned": texts.column("_learn"), "n_tokens": pa.array(tokens), "n_known": pa.array(seen),
                         "base_score": pa.array(plain + base(ends)), "score": pa.array(model), "n_bytes": pa.array(np.diff(offsets))})

    return score


def score(documents: DataFrame, learn: Column, *, id_col="doc_id", text_col="text", order: int = ORDER) -> DataFrame:
    """Per row: ``id, learned, n_tokens, n_known, train_tokens, base_score, score, n_bytes``. ``learn`` is a condition over
    the documents: the rows that the models are learned from (null: not). ``order`` is 6 at most."""
    if not 1 <= order <= 6:
        raise ValueError("order has to be from 1 to 6: a code has 63 bits")
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.coalesce(learn, F.lit(False)).alias("_learn"))
    kind = narrow.select("_id").schema["_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    sliced = stage(narrow.mapInArrow(_slicing(order, to_arrow_type(kind)), SLICED.format(kind=kind.simpleString())), "slices")
    texts = sliced.where("keys is null").select("slice", "_id", "_text", "_learn")
    entries = (sliced.where("keys is not null").select("slice", F.explode(F.arrays_zip("keys", "counts")).alias("e"))
               .select("slice", F.col("e.keys").alias("key"), F.col("e.counts").alias("n")))
    summed = stage(entries.groupBy("key").agg(F.sum("n").alias("c")), "summed")
    trie = levels(summed.where("key >= 0").select(F.col("key").alias("code"), "c"), order)
    edges = log_probabilities(trie).select(F.col("code").alias("key"), F.col("logp").alias("value"))
    vocabulary = summed.where("key < 0")
    ends = texts.where("_learn").count()
    total, distinct = vocabulary.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    total, distinct = (total or 0) + ends, distinct + (ends > 0)
    known = (entries.select("slice", "key")
             .join(edges.unionByName(vocabulary.select("key", F.col("c").cast("double").alias("value"))), "key"))
    known = known.select(F.col("slice").alias("of"), "key", "value")
    out = texts.groupBy("slice").cogroup(known.groupBy("of")).applyInArrow(
        _scoring(order, total, distinct, ends),
        f"_id {kind.simpleString()}, learned boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return out.withColumn("train_tokens", F.lit(total).cast("long")).withColumnRenamed("_id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every document's log10 probability, learned from those whose crc32 of the id is not 1 modulo 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    out = score(docs, rest != 1)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
