"""Operator 10, BPE encoding and decoding by dynamic programming over prefixes.

A greedy BPE encoding of a word has this property: its prefix up to any token boundary is encoded as
those tokens, and two tokens may stand side by side exactly if encoding both together gives them back
(they are *compatible*). So every prefix of a word has one last token, found left to right: among the
vocabulary words that end there (an Aho-Corasick automaton over the vocabulary yields them), the one
that is compatible with the last token of what remains. Following these back-pointers from the end
gives the ids. No merge loop runs, and the time is linear in the word's length.

Compatibility follows from the merge ranks alone. A token's right edge is the chain of its last
parts, each of them there from the rank at which it is made until the rank at which it is used; the
left edge likewise. Two tokens are incompatible exactly if some pair of edge parts that are there at
the same time has a merge that comes first.

Before that, text is normalized and cut into words as the tokenizer file says (NFC, white space runs
as one blank, lower case; then its word pattern); special tokens found in the raw text are cut out
first. Decoding joins the tokens' strings with blanks, as the file names no decoder.

Defined results: null is read as empty and gives no ids; ids of a text depend on it alone, so repeated
rows get equal results. Very long texts and words are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, once

#: Words kept per task, with their ids, for the next time they come up.
REMEMBERED = 500_000
#: Texts of code points below this take a smaller, faster form of the word pattern.
LATIN = 0x250

def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


def category_ranges(kind: str, limit: int) -> str:
    """The code points below ``limit`` of a general category (its first letter), as the inside of a
    character class."""
    found, start = [], None
    for c in range(limit + 1):
        inside = c < limit and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            found.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(found)


def word_pattern(pattern: str, limit: int) -> str:
    """The file's word pattern for ``re``, right for texts of code points below ``limit``: letters, numbers
    and white space as explicit ranges (each of them stands inside a character class there)."""
    white = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    for short, full in ((r"\p{L}", category_ranges("L", limit)), (r"\p{N}", category_ranges("N", limit)), (r"\s", white)):
        pattern = pattern.replace(short, full)
    return pattern


class Vocabulary:
    """Tokens as strings over symbols: a byte b inside a word is chr(b), as the last of it chr(256 + b)."""

    def __init__(self, spec: dict):
        import ahocorasick

        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or not end:
            raise ValueError("a BPE file with word ends is needed")
        symbol = {c: chr(b) for b, c in enumerate(byte_alphabet())}

        def spelt(token: str) -> str:
            ended = token.endswith(end)
            body = "".join(symbol[c] for c in (token[:-len(end)] if ended else token))
            return body[:-1] + chr(256 + ord(body[-1])) if ended else body

        vocab = model["vocab"]
        self.shown = {i: t for t, i in vocab.items()}
        ids = {spelt(t): i for t, i in vocab.items()}
        self.ids = ids
        self.made: dict[int, int] = {}     # token -> rank of its merge
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = vocab[left], vocab[right]
            self.rank[a, b] = r
            whole = vocab[left + right]
            if whole not in self.made:
                self.made[whole], self.parts[whole] = r, (a, b)
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.known: dict[int, bool] = {}  # pairs of tokens already tested
        self.auto = ahocorasick.Automaton()
        for s, i in ids.items():
            if len(s) == 1 or self.whole(i):
                self.auto.add_word(s, (i, len(s)))
        self.auto.make_automaton()

    def whole(self, token: int) -> bool:
        """Whether encoding the token's own string gives the token: its parts are, and fit."""
        if token not in self.parts:
            return len(self.shown[token].replace("</w>", "")) <= 1
        a, b = self.parts[token]
        r = self.made[token]
        # up to rank r nothing may join the two parts otherwise
        return self.whole_known(a) and self.whole_known(b) and self._fits(a, b, r)

    def whole_known(self, token: int) -> bool:
        if (token, token) not in self.edges:
            self.edges[token, token] = [(int(self.whole(token)), 0)]
        return bool(self.edges[token, token][0][0])

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The token's parts on one side (0 its first, 1 its last), smallest first, each with the rank
        at which it is used up."""
        key = (token, -1 - side)
        if (found := self.edges.get(key)) is None:
            found, t, used = [], token, float("inf")
            while True:
                found.append((t, used))
                if t not in self.parts:
                    break
                t, used = self.parts[t][side], self.made[t]
            self.edges[key] = found = found[::-1]
        return found

    def _fits(self, a: int, b: int, until: float = float("inf")) -> bool:
        """No merge across the boundary comes before rank ``until``."""
        left, right = self.edge(a, 1), self.edge(b, 0)
        i = j = 0
        while True:
            (x, used_x), (y, used_y) = left[i], right[j]
            r = self.rank.get((x, y))
            # at equal rank the merge further left comes first
            if r is not None and r < until and r < used_x and r <= used_y:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if j + 1 == len(right) or (i + 1 < len(left) and used_x <= used_y):
                i += 1
            else:
                j += 1

    def encode_word(self, data: bytes) -> list[int]:
        """The ids of one word."""
        word = data[:-1].decode("latin-1") + chr(256 + data[-1])
        if (whole := self.ids.get(word)) is not None and (len(word) == 1 or self.whole_known(whole)):
            return [whole]
        n = len(word)
        last, since = [-1] * n, [0] * n  # of the prefix that ends here: its last token, where that begins
        known, fits = self.known, self._fits
        if len(known) > 1_000_000:
            known.clear()
        for at, (token, length) in self.auto.iter(word):
            if last[at] >= 0:
                continue
            begin = at + 1 - length
            if begin:
                before = last[begin - 1]
                if before < 0:
                    continue
                pair = before << 20 | token
                ok = known.get(pair)
                if ok is None:
                    ok = known[pair] = fits(before, token)
                if not ok:
                    continue
            last[at], since[at] = token, begin
        out, at = [], n
        while at:
            token = last[at - 1]
            if token < 0:
                raise ValueError("no encoding: the vocabulary lacks a symbol")
            out.append(token)
            at = since[at - 1]
        out.reverse()
        return out


class Encoder:
    """Texts to ids and back."""

    def __init__(self, text: str):
        spec = json.loads(text)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"] or spec["decoder"] is not None:
            raise ValueError("another normalizer, word pattern use or decoder than this operator knows")
        self.vocabulary = Vocabulary(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.shown = self.vocabulary.shown | {i: s for s, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        pattern = split["pattern"]["Regex"]
        self.words, self.all_words = (re.compile(word_pattern(pattern, limit)) for limit in (LATIN, sys.maxunicode + 1))
        self.beyond = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")
        self.seen: dict[str, tuple[int, ...]] = {}

    def normalized(self, text: str) -> str:
        # White space only separates words, so its runs need not be folded to blanks; lower case is
        # taken letter by letter: a final sigma is not special.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _plain(self, text: str, out: list[int]) -> None:
        seen = self.seen
        text = self.normalized(text)
        for word in (self.all_words if self.beyond.search(text) else self.words).findall(text):
            ids = seen.get(word)
            if ids is None:
                ids = tuple(self.vocabulary.encode_word(word.encode()))
                if len(word) < 64:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[word] = ids
            out += ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                self._plain(part, out)
        return out

    def decode(self, ids: list[int]) -> str:
        shown = self.shown
        return " ".join([shown[i] for i in ids if i in shown])


def _encoding(spec: str, digests: bool):
    def make():
        coder = once(("bpe", hashlib.sha256(spec.encode()).hexdigest()), lambda: Encoder(spec))
        written = {i: str(i) for i in coder.shown}

        def work(batch):
            sizes, first, second = [], [], []
            for text in batch.column("_text").to_pylist():
                ids = coder.encode(text)
                sizes.append(len(ids))
                if digests:
                    first.append(hashlib.sha256(" ".join([written[i] for i in ids]).encode()).hexdigest())
                    second.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
                else:
                    first.append(ids)
                    second.append(coder.decode(ids))
            kind = pa.string() if digests else pa.list_(pa.int32())
            names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
            kept = [c for c in batch.schema.names if c != "_text"]
            return pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sizes, pa.int64()), pa.array(first, kind), pa.array(second, pa.string())],
                names=[*kept, "n_tokens", *names])

        return work

    return make


def encode(documents: DataFrame, spec: str, *, id_col="doc_id", text_col="text", digests=False) -> DataFrame:
    """``id, n_tokens`` and either ``ids, decoded`` or, with ``digests``, ``ids_sha256, decoded_sha256``.
    ``spec`` is the text of the tokenizer file; it is read on the driver and travels with the job."""
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    out = map_batches(narrow, _encoding(spec, digests), f"_id {kind}, n_tokens long, {rest}")
    return out.withColumnRenamed("_id", id_col)


def read_spec(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def query(spark, sf_dir: str) -> DataFrame:
    """op10: ids of every document, and the text they decode to, as digests."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), read_spec(), digests=True)
