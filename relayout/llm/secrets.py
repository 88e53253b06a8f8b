"""Operator 8, secret scan: keywords, anchored patterns, checksums.

1. An Aho-Corasick automaton over the keywords (every spelling in letter case that the patterns
   accept) runs once over the text. Hexadecimal runs have no keyword; there every 32nd character is
   probed, since a run of 32 or more covers one of them.
2. A pattern is tried only *at* a hit, anchored there; a hit inside the previous match of its kind is
   skipped, which gives the leftmost non-overlapping matches of a full scan.
3. Kinds with an embedded check are then validated: forge and registry tokens end in the CRC-32 of
   their body in base 62; the header of a signed web token must decode to JSON naming an algorithm;
   a private key block must decode to DER whose stated length is its length.

Base kinds ``assign``, ``access`` and ``hex`` carry no checksum and always stay. Null is read as
empty; rows are independent, so repeated rows and rows with a null id get their own result. Spans
count code points, end exclusive. Work per text is linear in its length: of hits that fail in one run of a signed token
the first one is tried, and a header too deeply nested for the JSON reader is no header.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# Keywords and patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_VALUE = 8
ACCESS, ACCESS_LENGTH = r"AKIA[A-Z0-9]+", 16
HEX, HEX_LENGTH = r"[0-9a-f]+", 32
FORGE = r"(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
FORGE_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
SIGNED = r"eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"
SIGNED_RUN = r"[A-Za-z0-9_-]+"
PEM = r"-----BEGIN (?:RSA |EC )?PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END (?:RSA |EC )?PRIVATE KEY-----"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "forge", "signed", "pem")


def base62(n: int, width: int) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out.rjust(width, "0")


def forge_ok(m: re.Match) -> bool:
    """The last six of 36 characters are the CRC-32 of the others in base 62."""
    body = m[0].partition("_")[2]
    return base62(zlib.crc32(body[:-6].encode()), 6) == body[-6:]


def signed_ok(m: re.Match) -> bool:
    head = m[0].split(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, RecursionError):  # no JSON, or nested deeper than any header is
        return False
    return isinstance(found, dict) and "alg" in found


def pem_ok(m: re.Match) -> bool:
    try:
        der = base64.b64decode(re.sub(r"\s+", "", m[1]), validate=True)
    except ValueError:
        return False
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    width = der[1] & 0x7F
    return len(der) == 2 + width + int.from_bytes(der[2:2 + width], "big")


def scanner():
    """A function from a text to its spans ``(start, kind number, end)``, in order."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        for spelt in itertools.product(*({c, c.upper()} for c in word)):
            auto.add_word("".join(spelt), (0, len(word)))
    auto.add_word("AKIA", (1, 4))
    for word in FORGE_WORDS:
        auto.add_word(word, (3, len(word)))
    auto.add_word("eyJ", (4, 3))
    auto.add_word("-----BEGIN ", (5, 11))
    auto.make_automaton()
    # group 2 is a maximal run; letters of the keyword in either case, ASCII only
    assign = re.compile(ASSIGN.replace("(password", "((?i:password").replace("key)", "key))"), re.ASCII)
    anchored = {1: re.compile(ACCESS), 3: re.compile(FORGE), 4: re.compile(SIGNED), 5: re.compile(PEM)}
    valid = {0: lambda m: m.end(2) - m.start(2) >= ASSIGN_VALUE, 1: lambda m: m.end() - m.start() >= ACCESS_LENGTH,
             3: forge_ok, 4: signed_ok, 5: pem_ok}
    anchored[0] = assign
    hexes, probe, run = re.compile(HEX), re.compile(r"[0-9a-f]"), re.compile(SIGNED_RUN)

    def scan(text: str) -> list[tuple[int, int, int]]:
        spans, done = [], [0] * len(KINDS)
        for last, (kind, length) in auto.iter(text):
            at = last - length + 1
            if at < done[kind]:
                continue
            if (m := anchored[kind].match(text, at)) is None:
                if kind == 4:  # another hit in this run ends where it does, and fails like this one
                    done[kind] = run.match(text, at).end()
                continue
            done[kind] = m.end()
            if valid[kind](m):
                spans.append((at, kind, m.end()))
        done_to = 0
        for hit in probe.finditer(text[HEX_LENGTH - 1::HEX_LENGTH]):
            at = HEX_LENGTH - 1 + hit.start() * HEX_LENGTH
            if at < done_to:
                continue
            done_to = end = hexes.match(text, at).end()
            # back to the start of the run; short of 32 in all is no match
            start = at
            while start and text[start - 1] in "0123456789abcdef":
                start -= 1
            if end - start >= HEX_LENGTH:
                spans.append((start, 2, end))
        spans.sort()
        return spans

    return scan


def _scanning():
    scan = scanner()

    def shown(spans):
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def work(batch):
        rows = [scan(t or "") for t in batch.column("_text").to_pylist()]
        base = [[s for s in r if s[1] < 3] for r in rows]
        counts = [pa.array([sum(s[1] == k for s in r) for r in base], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), *counts,
             pa.array([hashlib.sha256(shown(r).encode()).hexdigest() for r in base], pa.string()),
             pa.array([shown(r) for r in rows], pa.string()),
             pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in r] for r in rows], FOUND)],
            names=["_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    return work


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(documents: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: ``id, n_assign, n_access, n_hex, base_sha256, spans, found`` (the spans as text and as
    an array of structs)."""
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = map_batches(
        narrow, _scanning,
        f"_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "found array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("_id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the secrets of every document."""
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
