"""Operator 7, toxicity behind a noisy channel.

A writer who hides a word sends its letters through a channel: figures and signs for letters, gaps
between letters, letters repeated. A disguised spelling is therefore read as a lattice: per place,
the letters it may stand for, with a channel cost, and the best path under a character language model
is the restored spelling (Viterbi over pairs of letters). Every spelling with a sign, a figure, a gap or a
repeated letter is searched, whatever its length and however many letters it has; its literal reading is a
path like the others. Spellings with one reading, which are almost all, need no search. A linear model over the words and word beginnings of the restored text
then gives the score.

* The language model is a letter trigram model counted over all documents (a letter outside a-z
  counts by its UTF-8 bytes as one class). Its size is fixed, whatever the data.
* The linear model is fitted to a bounded sample of labelled rows (``SAMPLE``): features are chosen by
  their likelihood ratio, weights by penalized logistic regression.

Defined results: null and empty texts get the score of a text without features; a document with
several labels counts as toxic if one says so; null labels are ignored; without labelled rows of both
kinds the score is 0.5 for none and the share of toxic rows else. Rows are scored alone, whole.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_batches, map_batches, remainder, text_bytes

#: At most this many labelled rows are learned from, and this many features kept.
SAMPLE, FEATURES = 24_000, 4_000
#: A feature must explain this much (log likelihood ratio, in nats): less is chance among so many features.
MIN_GAIN = 10.0
#: Figures and signs, and the letters they may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz", "#": "h"}
GAPS = ".-_~'`"
STRIP = ".,;:!?#$%&*\"'()[]{}<>|/\\-_~`+=^"
#: ``DOUBLED``: a letter that a writer has written twice, once meant; ``MIXED``: more for a figure meant as one beside a letter.
SIGN, ANY, SHORTER, DOUBLED, LITERAL, MIXED, BREAK = 1.0, 3.5, 0.7, 6.0, 2.5, 3.0, 1.0
#: Of a run of one letter, at most so many are told apart.
RUN = 3
#: Paths are cut back to where they still differ after so many places.
COMMIT = 256
CLASSES = 28
_ONE, _GAP = r"(?:[^\W_]|[@$!|+(#])", r"[ \t\xa0.\-_*~'`]+"
#: Single letters, figures or signs with gaps between them.
SPACED = re.compile(rf"(?<![^\W_])(?<![@$!|+(#]){_ONE}(?:{_GAP}{_ONE}(?!{_ONE})){{2,}}")
#: What has more than one reading: a sign, a figure, a gap, a letter that is repeated.
MANY = re.compile(rf"[{re.escape(''.join(LEET) + GAPS)}]|([^\W\d_])\1")
REPEATED = re.compile(rf"(.)\1{{{RUN},}}", re.S)
_NONE = rf"[^{re.escape(GAPS)}]"
BETWEEN = re.compile(rf"(?<={_NONE}{{2}})[{re.escape(GAPS)}]+|[{re.escape(GAPS)}]+(?={_NONE}{{2}})")
#: A longer run of non-blanks (runs of a character cut to ``RUN``) is several words: a gap beside a part of two or more
#: characters ends a word there. What longer spellings give is not remembered.
LONGEST, REMEMBERED = 48, 300_000


def letter_classes(data: np.ndarray) -> np.ndarray:
    """0 for what is no letter, 1-26 for a-z in either case, 27 for bytes of other characters."""
    lut = np.zeros(256, np.int32)
    lut[97:123] = lut[65:91] = np.arange(1, 27)
    lut[128:] = 27
    return lut[data]


def _counting():
    total = np.zeros(CLASSES ** 3, np.int64)

    def add(batch):
        data, offsets = text_bytes(batch.column(0))
        for at in range(0, len(data), 4 << 20):
            c = letter_classes(data[max(0, at - 2):at + (4 << 20)])
            if len(c) > 2:
                np.add(total, np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(total)), out=total)

    def finish():
        code = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), pa.array(total[code])], names=["code", "n"])

    return add, finish


def letter_model(documents: DataFrame, *, text_col="text") -> np.ndarray:
    """Log probability of a letter class after two others, from trigram counts of all documents. (Texts
    of a batch are counted as they lie next to one another; the few trigrams across their ends are
    noise in the counts.) At most 28 ** 3 sums reach the driver."""
    counts = (fold_batches(documents.select(text_col), _counting, "code int, n long")
              .groupBy("code").agg(F.sum("n").alias("n")).collect())
    table = np.zeros(CLASSES ** 3)
    for r in counts:
        table[r["code"]] = r["n"]
    table = table.reshape(CLASSES, CLASSES, CLASSES)
    two = table.sum(0)  # of the last two
    one = two.sum(0) + 1.0
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (table + 5 * p2[None]) / (table.sum(2, keepdims=True) + 5)
    return np.log(p3)


class Restorer:
    """Spellings back to letters under a letter model."""

    def __init__(self, model: np.ndarray):
        self.logp = model.tolist()

    @staticmethod
    def code(letter: str) -> list[int]:
        if not letter:
            return []
        if "a" <= letter <= "z":
            return [ord(letter) - 96]
        return [27] * len(letter.encode()) if letter.isalpha() else [0]

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest string through the lattice; a place lists strings and their channel costs."""
        logp = self.logp
        beam = {(0, 0): [0.0, None, ""]}  # the last two classes -> cost, path before, last string
        out: list[str] = []

        def commit(node: list) -> None:
            path, at = [], node
            while at is not None:
                path.append(at[2])
                at = at[1]
            out.extend(reversed(path))
            node[1], node[2] = None, ""

        for step, place in enumerate([*lattice, [(" ", 0.0)]], 1):
            ahead: dict = {}
            for (a, b), node in beam.items():
                for letters, cost in place:
                    x, y, c = a, b, node[0] + cost
                    for letter in letters:
                        for k in self.code(letter):
                            c -= logp[x][y][k]
                            x, y = y, k
                    if (x, y) not in ahead or c < ahead[x, y][0]:
                        ahead[x, y] = [c, node, letters]
            beam = ahead
            if step % COMMIT == 0:
                alive = list({id(node): node for node in beam.values()}.values())
                while len(alive) > 1:  # back to where all paths are one: that part is settled
                    alive = list({id(node[1]): node[1] for node in alive}.values())
                commit(alive[0])
        commit(min(beam.values(), key=lambda v: v[0]))
        return "".join(out).strip()

    def lattice(self, core: str) -> list[list[tuple[str, float]]]:
        places, i = [], 0
        while i < len(core):
            c, n = core[i], 1
            while i + n < len(core) and core[i + n] == c:
                n += 1
            beside = core[max(i - 1, 0):i] + core[i + n:i + n + 1]
            i += n
            n = min(n, RUN)
            if c.isalpha():
                options = [(c * n, 0.0)]
                if n == 2:
                    options += [(c, DOUBLED)]
                elif n > 2:
                    options += [(c, SHORTER), (c * 2, SHORTER)]
            elif c in LEET:
                cost = ANY if c == "*" else SIGN
                mixed = MIXED if any(x.isalpha() for x in beside) else 0.0
                options = [(c * n, LITERAL + mixed)] if c.isdigit() else [(" ", LITERAL)]
                fewer = DOUBLED if n == 2 else SHORTER
                options += [(x * k, cost + (fewer if k < n else 0.0)) for x in LEET[c] for k in range(1, n + 1)]
            elif c in GAPS:
                options = [(" ", BREAK), ("", 0.0)]
            else:
                options = [(" ", 0.0)]
            places.append(options)
        return places

    def token(self, token: str) -> list[str]:
        """The words that a run of non-blanks, in lower case, is restored to."""
        core = token.strip(STRIP)
        if token[:1] in LEET and len(token) > 1:  # a sign in front may be a letter
            core = token.rstrip(STRIP)
        if MANY.search(core):
            core = REPEATED.sub(lambda m: m[1] * RUN, core)
            if len(core) > LONGEST:
                core = BETWEEN.sub(" ", core)
            core = self.decode(self.lattice(core))
        return re.findall(r"[^\W\d_]+", core)

    def spaced(self, run: str) -> str:
        """Single letters with gaps: at every gap the word goes on or ends."""
        places = []
        for c in re.findall(rf"{_GAP}|{_ONE}", run):
            if c in LEET and c != "*":
                places.append([(" ", LITERAL), *((x, SIGN) for x in LEET[c])])
            elif c.isalnum():
                places.append([(c, 0.0)])
            else:
                places.append([("", 0.0), (" ", BREAK)])
        return self.decode(places)

    def text(self, text: str) -> str:
        """A whole text restored, in lower case; white space becomes single blanks."""
        text = SPACED.sub(lambda m: self.spaced(m[0]), text.lower())
        return " ".join(w for token in text.split() for w in self.token(token))


def beginnings(word: str) -> list[str]:
    """The features of a word: itself and its first letters."""
    return [word, *(f"{word[:k]}~" for k in (4, 5, 6) if len(word) > k)] if len(word) > 2 else []


class Features:
    """The set of features of a text; what a spelling gives is remembered."""

    def __init__(self, model: np.ndarray, known: dict[str, int] | None):
        self.restorer, self.known, self.seen = Restorer(model), known, {}

    def of_token(self, token: str) -> tuple:
        found = self.seen.get(token)
        if found is None:
            names = [f for w in self.restorer.token(token) for f in beginnings(w)]
            found = tuple(names) if self.known is None else tuple(self.known[f] for f in names if f in self.known)
            if len(token) <= LONGEST:
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen[token] = found
        return found

    def of_text(self, text: str | None) -> set:
        if not text:
            return set()
        text = text.lower()
        tokens = set(text.split())
        for m in SPACED.finditer(text):
            tokens.update(self.restorer.spaced(m[0]).split())
        out: set = set()
        for token in tokens:
            if found := self.of_token(token):
                out.update(found)
        return out


def _featuring(model: np.ndarray):
    def make():
        features, counts = Features(model, None), {}

        def add(batch):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in features.of_text(text):
                    pair = counts.get(f)
                    if pair is None:
                        pair = counts[f] = [0, 0]
                    pair[toxic] += 1

        def finish():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                 pa.array([c[1] for c in counts.values()], pa.int64())], names=["feature", "n0", "n1"])

        return add, finish

    return make


def _indexing(model: np.ndarray, known: dict[str, int]):
    def make():
        features = Features(model, known)

        def work(batch):
            return pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([sorted(features.of_text(t)) for t in batch.column(0).to_pylist()], pa.list_(pa.int32()))],
                names=["toxic", "found"])

        return work

    return make


def fit_logistic(rows: list[list[int]], y: np.ndarray, n: int, penalty: float = 0.5, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient steps on the penalized logistic loss."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter((c for r in rows for c in r), np.int64, len(at))
    w, b = np.zeros(n), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    scale = np.bincount(col, minlength=n) * 0.25 * 4 + penalty  # a document has few features: diagonal bound
    look, vb, old_w, old_b = w.copy(), b, w, b
    for step in range(steps):
        z = np.bincount(at, look[col], len(rows)) + vb
        g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        w = look - (np.bincount(col, g[at], n) + penalty * look) / scale
        b = vb - g.sum() / len(y)
        momentum = step / (step + 3)
        look, vb = w + momentum * (w - old_w), b + momentum * (b - old_b)
        old_w, old_b = w, b
    return w, float(b)


def learn(documents: DataFrame, labels: DataFrame, model: np.ndarray, training=None, *, id_col="doc_id", text_col="text",
          label_col="toxic", sample=SAMPLE, features=FEATURES) -> tuple[dict[str, int], np.ndarray, float]:
    """Features and weights, from at most ``sample`` labelled rows, the first by a hash of the id."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if training is not None:
        rows = rows.where(training)
    chosen = (rows.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    # at most ``sample`` ids go to all executors
    texts = (documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen), "id").select("text", "toxic"))
    counts = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not n0 or not n1:
        return {}, np.zeros(0), math.log((n1 + 1e-9) / (n0 + 1e-9)) if n0 + n1 else 0.0
    found = (fold_batches(texts, _featuring(model), "feature string, n0 long, n1 long")
             .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n1") + F.col("n0") >= 4))
    a, b = F.col("n1") / n1, F.col("n0") / n0
    mean = (F.col("n1") + F.col("n0")) / (n0 + n1)
    gain = (F.when(a > 0, F.col("n1") * F.log(a / mean)).otherwise(0.0)
            + F.when(b > 0, F.col("n0") * F.log(b / mean)).otherwise(0.0)
            + (n1 - F.col("n1")) * F.log((1 - a + 1e-9) / (1 - mean + 1e-9)) + (n0 - F.col("n0")) * F.log((1 - b + 1e-9) / (1 - mean + 1e-9)))
    best = found.where((a > b) & (gain >= MIN_GAIN)).orderBy(gain.desc(), "feature").limit(features).collect()
    known = {r["feature"]: k for k, r in enumerate(best)}
    rows = map_batches(texts, _indexing(model, known), "toxic int, found array<int>").collect()  # ``sample`` rows of few features
    weights, bias = fit_logistic([r["found"] for r in rows], np.array([r["toxic"] for r in rows], float), len(known))
    return known, weights, bias


def _scoring(model: np.ndarray, known: dict[str, int], weights: np.ndarray, bias: float):
    def make():
        features = Features(model, known)
        w = weights.tolist()

        def work(batch):
            z = [bias + math.fsum(w[k] for k in features.of_text(t)) for t in batch.column("_text").to_pylist()]
            score = [1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for x in z]
            return pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(score, pa.float64())], names=["_id", "score"])

        return work

    return make


def _restoring(model: np.ndarray):
    def make():
        restorer = Restorer(model)

        def work(batch):
            out = pa.array([None if t is None else restorer.text(t) for t in batch.column("_text").to_pylist()], pa.string())
            return pa.RecordBatch.from_arrays([batch.column("_id"), out], names=["_id", "restored"])

        return work

    return make


def _narrow(documents: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return narrow, narrow.schema["_id"].dataType.simpleString()


def restore(documents: DataFrame, model: np.ndarray, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``id, restored``: every whole text as the decoder reads it."""
    narrow, kind = _narrow(documents, id_col, text_col)
    return map_batches(narrow, _restoring(model), f"_id {kind}, restored string").withColumnRenamed("_id", id_col)


def score(documents: DataFrame, model: np.ndarray, fitted, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``id, score`` of every row."""
    narrow, kind = _narrow(documents, id_col, text_col)
    return map_batches(narrow, _scoring(model, *fitted), f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every document's toxicity, learned where crc32(doc_id) mod 5 is not 0."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = letter_model(documents)
    fitted = learn(documents, labels, model, ~held_out)
    return score(documents, model, fitted).select("doc_id", held_out.alias("held_out"), "score",
                                                  (F.col("score") >= 0.5).cast("int").alias("predicted"))
