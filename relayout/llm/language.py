"""Operator 4, language identification by compression.

Each language gets a zstandard raw-content dictionary: training text of that language. A text is
encoded once per language with that dictionary, in blocks, over its whole length; the language with
the smallest total is the answer. A text is *rejected* when the margin to the next language is
narrow, or when it has no letter.

Defined results: null, empty and letterless texts give ``und``, score 0 and are rejected. Equal sizes
go to the language with most training texts, then by code point (and are rejected, the margin being
zero). Without any
labelled row every text is ``und``. Rows are independent: repeated rows get equal results, and
columns other than id, text and language are not read.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, remainder

UNKNOWN = "und"
#: Bounds of the training sample: texts and characters of a text per language, bytes of a dictionary.
TEXTS, CHARS, DICTIONARY = 400, 1500, 96 << 10
#: More learned languages than this is an error (the dictionaries travel with the job).
LANGUAGES = 512
BLOCK, LEVEL = 1500, 9
#: Rejected below this margin, as a part of the best size.
MARGIN = 0.004

_NO_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> str:
    """Lower case, every run of other characters than letters (the letter categories) as one blank."""
    text = _NO_LETTERS.sub(" ", text.lower()).strip()
    if not text or text.replace(" ", "").isalpha():
        return text
    # signs like fractions and Roman numerals count as numeric, not as digits
    return " ".join("".join(c if c.isalpha() else " " for c in text).split())


def learn(documents: DataFrame, training=None, *, id_col="doc_id", text_col="text", lang_col="lang",
          texts=TEXTS, chars=CHARS, size=DICTIONARY, languages=LANGUAGES) -> dict[str, bytes]:
    """The dictionaries, the language with most texts first, from a bounded sample of the labelled rows for which ``training`` holds: of
    each language at most ``texts`` different texts, the first by a hash of the id, at most ``chars``
    characters of each. Ids and hashes alone are shuffled; the sampled texts come in by a join with
    the sampled ids, of which there are ``texts`` per language at most. They fill the dictionary in the order of the
    hash, until its ``size`` is reached: of texts of ``chars`` characters that is the first 65 or so."""
    labelled = documents.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if training is not None:
        labelled = labelled.where(training)
    ids = (labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))
           .groupBy("lang", "h").agg(F.min("id").alias("id")))
    counts = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(languages + 1).collect()}
    if len(counts) > languages:
        raise ValueError(f"more than {languages} languages")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = ids.withColumn("n", F.row_number().over(first)).where(F.col("n") <= texts).select("lang", "id", "h")
    sample = (labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
              .withColumn("h", F.xxhash64("t")).join(F.broadcast(chosen), ["lang", "id", "h"], "left_semi")
              .select("lang", F.xxhash64("id").alias("place"), "id", F.substring("t", 1, chars).alias("t")).distinct())
    parts: dict[str, list] = {}
    for r in sample.collect():  # at most texts * languages rows of at most chars characters
        parts.setdefault(r["lang"], []).append((r["place"], r["id"], letters_only(r["t"])))
    order = sorted(parts, key=lambda lang: (-counts[lang], lang))
    return {lang: " ".join(t for *_, t in sorted(parts[lang])).encode()[:size] for lang in order}


def _classifier(dictionaries: dict[str, bytes], id_name: str, text_name: str, margin: float):
    def make():
        import zstandard as z

        names = [n for n in dictionaries if dictionaries[n]]
        coders = []
        for name in names:
            d = z.ZstdCompressionDict(dictionaries[name], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            coders.append(z.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False).compress)

        def one(text):
            text = letters_only(text) if text else ""
            if not text or not names:
                return UNKNOWN, 0.0, True
            sizes = [0] * len(names)
            for at in range(0, len(text), BLOCK):
                block = text[at:at + BLOCK].encode()
                for k, coder in enumerate(coders):
                    sizes[k] += len(coder(block))
            best = min(sizes)
            narrow = len(sizes) > 1 and sorted(sizes)[1] - best <= margin * best
            # a byte more is taken as half as likely
            share = 1 / math.fsum(2.0 ** -min(s - best, 1000) for s in sizes)
            return names[sizes.index(best)], share, narrow

        def work(batch):
            out = [one(t) for t in batch.column(text_name).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_name), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.bool_())],
                names=["_id", "lang_pred", "score", "rejected"])

        return work

    return make


def classify(documents: DataFrame, dictionaries: dict[str, bytes], *, id_col="doc_id", text_col="text",
             margin: float = MARGIN) -> DataFrame:
    """``id, lang_pred, score, rejected`` of every row, in one pass without a shuffle."""
    narrow = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = map_batches(narrow, _classifier(dictionaries, "_id", "_text", margin),
                      f"_id {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("_id", id_col)


def keep_identified(documents: DataFrame, dictionaries: dict[str, bytes], *, text_col="text",
                    margin: float = MARGIN) -> DataFrame:
    """The rows whose language is identified, with all their columns."""
    make = _classifier(dictionaries, text_col, text_col, margin)

    def filtering():
        work = make()

        def keep(batch):
            return batch.filter(pc.invert(work(batch).column("rejected")))

        return keep

    return map_batches(documents, filtering, documents.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document's language, learned where crc32(doc_id) mod 3 is not 1."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = learn(documents, F.col("doc_id").isNotNull() & ~held_out)
    return classify(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
