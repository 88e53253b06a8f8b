"""Operator 3, n-gram Jaccard join by universe partition.

Two sets of at least J similarity, the smaller of size a, differ in at most H = a (1 - J) / J elements. In a
band of sizes, with H of the band's largest a, the universe of shingles is hashed into segments. If the
segments outnumber H, two similar sets agree on some segment whole, so a signature per segment (a hash of
the set's shingles in it) finds them. A segment may also be indexed with its one-deletion
neighbourhood (its shingles, and every choice of all but one): it then finds pairs that differ in one
element there and so counts for two. ``allocate`` chooses per band how many segments of either kind to
have, by cost: signatures emitted, and signatures that say little.

Segments with less than two shingles say little (many sets have the same), empty ones nothing. So there
are E spare segments, and a set may leave out up to E plain segments: those with too few shingles (one or
two, as allocated, are enough), and those whose signature is *hot* (held by ``HOT`` sets or more). What is left out depends on the segment's content alone, so two
sets that agree there leave out the same; since similar sets agree on more than E segments, one that both
index remains. A set with more than E such segments is indexed again in a finer partition, with as many
segments as elements, where it may leave out all but a few more than H; pairs of such sets meet there. Only
sets that consist of hot content almost wholly keep hot signatures.

Sets meet in the band of the smaller one: a set is indexed in its own band, and as a guest in the earlier
ones whose sets can be its partner.

Documents with equal sets are one vertex. Candidates are verified exactly on the sets. The result is the
components of the links, so candidates are taken in rounds: in every group of sets that share a
signature the first set meets all others, then the next seven do, then 56 and so on; members that are
by then in one component need no further test, and a group ends when it is one component. All pairs
that could link two components are tested; hot groups of copies end after the first round.

Hashes are 64 bits wide: a shingle is told by its hash, a set by the sum of its mixed hashes and its size.
Sets needed for verification are made a second time from the texts; a fixed-size bit filter keeps the
others from being shuffled.

Defined results: a text without words, or null, has an empty set, is linked with nothing and is its own
component; rows with a null id are linked with nothing and get a null component; rows that share an id are
told apart by their sets; repeated rows have equal results. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lookup, map_batches, mix, once, pieces, stage, text_bytes, word_hashes
from .components import components

WORDS, SIMILAR = 4, (85, 100)
#: A band's largest size over its smallest.
BAND = 1.4
#: Signatures held by this many sets are hot.
HOT = 64
#: A deletion segment is as wide as this many plain ones; cost of a deletion segment being empty, and of
#: signatures of single shingles.
WIDE, EMPTY_COST, WEAK_COST = 2, 40.0, 1.15
FILTER_BITS = 1 << 24
#: Sets that a task remembers, so that copies are indexed once per task and not each.
SEEN = 500_000
_U = np.uint64


# -------------------------------------------------------------------------------------- bands


def allocate(lo: int, differ: int) -> tuple[int, int, int, int]:
    """(deletion segments, plain segments, spare, least) for sets of ``lo`` elements or more that differ in
    at most ``differ``: 2 * deletion + plain = differ + 1 + spare, at the least cost. Plain segments
    with fewer than ``least`` shingles may be left out; ``spare`` covers how many there are to be
    expected, and three standard deviations."""
    best = None
    for least in (2, 1):
        for x in sorted({*range(0, (differ + 1) // 2 + 1, max(1, differ // 40)), (differ + 2) // 2}):
            y, spare, weak = max(0, differ + 1 - 2 * x), 0, 0.0
            for _ in range(100):
                if not y or y > 4 * lo:
                    break
                each = lo / (y + WIDE * x)  # shingles a plain segment holds
                weak = y * math.exp(-each) * (1 + each if least == 2 else 1)
                spare = math.ceil(weak + 3 * math.sqrt(weak))
                if y == differ + 1 + spare - 2 * x:
                    break
                y = differ + 1 + spare - 2 * x
            else:
                continue
            if y > 4 * lo:
                continue
            y = max(0, differ + 1 + spare - 2 * x)
            wide = lo * WIDE / (y + WIDE * x) if x else 0.0
            cost = (y - weak) * (1 if least == 2 else WEAK_COST) + x * (1 + wide) + EMPTY_COST * x * math.exp(-wide)
            if best is None or cost < best[0]:
                best = (cost, x, y, spare, least)
    return best[1:]


class Bands:
    """Bands of sizes for a similarity, with their segments."""

    def __init__(self, similar: tuple[int, int]):
        self.p, self.q = similar
        self.lo, self.hi, self.plan = [], [], []
        self.reach(64)

    def reach(self, size: int) -> None:
        while not self.hi or self.hi[-1] < size:
            lo = self.hi[-1] + 1 if self.hi else 1
            hi = max(lo, int(lo * BAND))
            differ = hi * (self.q - self.p) // self.p
            self.lo.append(lo)
            self.hi.append(hi)
            # without a difference there are no partners but equal sets
            self.plan.append(allocate(lo, differ) if differ else (0, 0, 0, 1))

    def fine(self, band: int) -> tuple[int, int, int, int]:
        """Plain segments only, as many as the band's largest set has elements."""
        while len(self.hi) <= band:
            self.reach(self.hi[-1] + 1)
        hi = self.hi[band]
        differ = hi * (self.q - self.p) // self.p
        y = max(hi, 2 * differ + 2)
        return 0, y, y - differ - 1, 1

    def of(self, size: int) -> list[tuple[int, bool]]:
        """The bands where a set of this size is indexed, and whether as a guest."""
        self.reach(size)
        own = int(np.searchsorted(self.hi, size))
        out = [(own, False)]
        b = own - 1
        while b >= 0 and size <= self.hi[b] * self.q // self.p:
            out.append((b, True))
            b -= 1
        return [(b, guest) for b, guest in out if self.plan[b][0] + self.plan[b][1]]


# -------------------------------------------------------------------------------------- sets


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted within a text, and n + 1 offsets."""
    h, counts = word_hashes(data, offsets)
    n = len(counts)
    ends = np.cumsum(counts)
    text = np.repeat(np.arange(n), counts)
    at = np.arange(len(h)) - np.repeat(ends - counts, counts)
    total = np.repeat(counts, counts)
    heads = np.flatnonzero((at + words <= total) | (at == 0))
    size = np.minimum(words, total[heads])
    value = mix(size.astype(_U) + _U(0x51ED270B))
    for k in range(words):
        inside = size > k
        value[inside] = mix(value[inside] * _U(0x9E3779B97F4A7C15) + h[heads[inside] + k])
    owner = text[heads]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(n + 1))


def set_hashes(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A set's vertex: a hash of its elements, in any order, and its size (0 for the empty set)."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(value ^ _U(0xA0761D6478BD642F)))])
    sizes = np.diff(bounds)
    return np.where(sizes > 0, mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(_U)), _U(0))


def signatures(value: np.ndarray, band: int, plan: tuple[int, int, int, int]) -> tuple[np.ndarray, int]:
    """The signatures of one set in one band (the lowest bit tells those of deletion segments), and how many
    more plain segments it may leave out (-1: it has to index all)."""
    x, y, spare, least = plan
    cells = y + WIDE * x
    seed = mix(np.array([band + 1], np.int64).view(_U) * _U(0x2545F4914F6CDD1D))[0]
    place = mix(value ^ seed)
    cell = ((place >> _U(32)) * _U(cells) >> _U(32)).astype(np.int64)
    segment = np.where(cell < WIDE * x, cell // WIDE, cell - WIDE * x + x)
    token = mix(value + seed)
    order = np.argsort(segment, kind="stable")
    segment, token = segment[order], token[order]
    first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    name, length = segment[first], np.diff(np.append(first, len(segment)))
    total = np.add.reduceat(token, first)

    def signed(s, t, n, deletion=0):
        return mix(t + mix(s.astype(_U) * _U(0xD1342543DE82EF95) + n.astype(_U) + seed)) & ~_U(1) | _U(deletion)

    plain = name >= x
    strong = plain & (length >= least)
    weak = y - int(strong.sum())
    out = []
    if weak <= spare:
        out.append(signed(name[strong], total[strong], length[strong]))
    else:
        out.append(signed(name[plain], total[plain], length[plain]))
        empty = np.setdiff1d(np.arange(x, x + y), name[plain])
        out.append(signed(empty, np.zeros(len(empty), _U), np.zeros(len(empty), np.int64)))
    if x:
        # deletion segments are always indexed: whole, and without each element
        out.append(signed(name[~plain], total[~plain], length[~plain], 1))
        empty = np.setdiff1d(np.arange(x), name[~plain])
        out.append(signed(empty, np.zeros(len(empty), _U), np.zeros(len(empty), np.int64), 1))
        upto = int(length[~plain].sum())
        out.append(signed(segment[:upto], np.repeat(total[~plain], length[~plain]) - token[:upto],
                          np.repeat(length[~plain], length[~plain]) - 1, 1))
    return np.unique(np.concatenate(out)), max(-1, spare - weak)


def _indexing(similar: tuple[int, int]):
    """The signatures of sets in all their bands."""

    def make():
        bands = once(("bands", similar), lambda: Bands(similar))

        def work(batch):
            rows = []
            for elements in batch.column("elements"):
                value = elements.values.to_numpy(zero_copy_only=False).view(_U)
                rows.append([(band, guest, *signatures(value, band, bands.plan[band])) for band, guest in bands.of(len(value))])
            flat = [m for r in rows for m in r]
            kind = pa.list_(pa.struct([("band", pa.int32()), ("guest", pa.bool_()), ("slack", pa.int32()), ("sigs", pa.list_(pa.int64()))]))
            sigs = np.concatenate([m[2] for m in flat]).view(np.int64) if flat else np.zeros(0, np.int64)
            inner = pa.ListArray.from_arrays(np.append(0, np.cumsum([len(m[2]) for m in flat])).astype(np.int32), pa.array(sigs))
            struct = pa.StructArray.from_arrays(
                [pa.array([m[0] for m in flat], pa.int32()), pa.array([m[1] for m in flat], pa.bool_()),
                 pa.array([m[3] for m in flat], pa.int32()), inner], fields=list(kind.value_type))
            index = pa.ListArray.from_arrays(np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32), struct)
            return pa.RecordBatch.from_arrays([batch.column("node"), index], names=["node", "index"])

        return work

    return make


def _gathering(words: int, bits: bytes):
    def make():
        mask = np.frombuffer(bits, np.uint8)

        def work(batch):
            data, offsets = text_bytes(batch.column("_text"))
            bit = batch.column("_bit").to_numpy(zero_copy_only=False)
            wanted = (mask[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
            nodes, sets = [], []
            for i, j in pieces(offsets):
                if not wanted[i:j].any():
                    continue
                value, bounds = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
                names = set_hashes(value, bounds)
                for k in np.flatnonzero(wanted[i:j]):
                    if bounds[k] < bounds[k + 1]:
                        nodes.append(names[k])
                        sets.append(value[bounds[k]:bounds[k + 1]].view(np.int64))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            arrays = pa.ListArray.from_arrays(np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32), pa.array(flat))
            return pa.RecordBatch.from_arrays([pa.array(np.array(nodes, _U).view(np.int64), pa.int64()), arrays], names=["node", "elements"])

        return work

    return make


# -------------------------------------------------------------------------------------- join


def _bit(id_col: Column) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(FILTER_BITS))


def bit_filter(ids: DataFrame) -> bytes:
    """FILTER_BITS bits, set where an id hashes to; at most FILTER_BITS / 64 sums reach the driver. A full
    filter lets everything pass, which is right as well."""
    bit = _bit(F.col("id"))
    words = (ids.groupBy(F.floor(bit / 64).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("bits")).collect())
    mask = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        mask[r["word"]] = r["bits"]
    return mask.tobytes()


def _shared(rows: DataFrame) -> DataFrame:
    """``sig, node, guest, band, slack, held`` of the signatures that may bring two sets together."""
    # equal sets fall together here; all later steps keep this partitioning
    single = rows.repartition("sig").groupBy("sig", "node").agg(
        F.first("guest").alias("guest"), F.first("band").alias("band"), F.first("slack").alias("slack"))
    group = Window.partitionBy("sig")
    return (single.withColumn("held", F.count(F.lit(1)).over(group)).withColumn("own", F.count_if(~F.col("guest")).over(group))
            .where("held > 1 and own > 0").drop("own"))


def _by_set(shared: DataFrame) -> DataFrame:
    """The shared signatures with how many hot plain ones their set has in the band, and its weight."""
    hot = (F.col("held") >= HOT) & (F.col("sig") % 2 == 0)
    marked = shared.withColumn("is_hot", hot)
    of_set = marked.groupBy("node", "band").agg(F.count_if("is_hot").alias("hot"), F.sum("held").alias("weight"))
    return marked.join(of_set, ["node", "band"])


def _pivots(rows: DataFrame) -> DataFrame:
    """``x, y``: of every signature its pivot and each other set that holds it, once. The pivot is the set (no guest) that
    shares most: the middle of a family links most of it at once. It is found by partial maxima in every task."""
    pivot = (rows.groupBy("sig").agg(F.max(F.struct(~F.col("guest"), "weight", F.col("node").alias("x"))).alias("top"), F.count(F.lit(1)).alias("held"))
             .where("held > 1").select("sig", "top.x", "held"))
    return (lookup(rows.select("sig", "node"), pivot, ["sig"], "held", "inner").where("x <> node")
            .select("x", F.col("node").alias("y")).distinct())


def _salted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x, y`` with the elements of both (``a, b``). A set that meets many others is spread over copies of itself,
    256 partners for each."""
    counts = stage(pairs.groupBy("x").agg(F.count(F.lit(1)).alias("n")), "partners")
    copies = F.ceil(F.col("n") / 256).cast("int")
    salted = pairs.join(counts, "x").select("x", "y", F.pmod(F.xxhash64("y"), copies).cast("int").alias("salt"))
    left = (sets.join(counts, sets["node"] == counts["x"])
            .select("x", F.col("elements").alias("a"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt")))
    right = sets.select(F.col("node").alias("y"), F.col("elements").alias("b"))
    return salted.join(right, "y").join(left, ["x", "salt"]).select("x", "y", "a", "b")


def _measured(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``x, y, f, over, size`` of pairs: in how many elements they differ, (p + q) times how far that is above what similar
    sets may differ in (so they are linked if it is not above 0), and how much larger y is."""
    p, q = similar
    a, b = F.size("a"), F.size("b")
    f = a + b - 2 * F.size(F.array_intersect("a", "b"))
    return (_salted(pairs, sets).select("x", "y", f.cast("long").alias("f"), (a + b).cast("long").alias("both"), (b - a).cast("long").alias("larger"))
            .select("x", "y", "f", ((p + q) * F.col("f") - (q - p) * F.col("both")).alias("over"), "larger"))


def _open_pairs(met: DataFrame, sets: DataFrame, named: Callable[[DataFrame, str], DataFrame], similar: tuple[int, int]) -> DataFrame:
    """``x, y``: the pairs within families that can be similar and whose ends are in two components.

    A family is a pivot P and the sets that met it. Of a member A only its differences from P count, D(A), f of them:
    A and B differ in |D(A)| + |D(B)| - 2 |D(A) & D(B)| elements. What D(B) has alone in the family, ``single`` of them, cannot be in
    D(A), so they differ in f(A) + 2 single(B) - f(B) or more. If that is to be within the limit, ``over``(A) must not be above
    ``room``(B), both told from P alone; and the other way round. Members linked to P are in its component,
    so one of the two, A, has ``over`` above 0, and B needs that much room: members that were edited by chance have none.
    Pairs are found by an equi-join on powers of two of either, not by trying all."""
    p, q = similar
    kept = named(met, "y").withColumnRenamed("cy", "comp")
    kept = stage(named(kept, "x").withColumn("inside", F.col("cx") == F.col("comp")).drop("cx"), "families")
    some = stage(kept.where("over > 0 and not inside").select("x").distinct(), "open_families")
    family = stage(kept.join(some, "x", "left_semi"), "open_members")
    differences = (_salted(family.select("x", "y"), sets)
                   .select("x", "y", F.explode(F.concat(F.array_except("a", "b"), F.array_except("b", "a"))).alias("e")))
    single = (differences.groupBy("x", "e").agg(F.min("y").alias("y"), F.count(F.lit(1)).alias("n")).where("n = 1")
              .groupBy("x", "y").agg(F.count(F.lit(1)).alias("single")))
    room = (q - p) * F.col("larger") - (p + q) * (2 * F.coalesce("single", F.lit(0)) - F.col("f"))
    rated = stage(family.join(single, ["x", "y"], "left").select("x", "y", "comp", "over", room.cast("long").alias("room")), "rated")
    power = lambda c: F.floor(F.log2(c.cast("double"))).cast("int")
    asking = rated.where("over > 0").select("x", F.col("y").alias("a"), F.col("comp").alias("ca"), F.col("over").alias("oa"),
                                            F.col("room").alias("ra"), power(F.col("over")).alias("level"))
    roomy = rated.where("room > 0").select("x", F.col("y").alias("b"), F.col("comp").alias("cb"), F.col("over").alias("ob"),
                                           F.col("room").alias("rb"), F.explode(F.sequence(F.lit(0), power(F.col("room")))).alias("level"))
    return (asking.join(roomy, ["x", "level"]).where("oa <= rb and ob <= ra and ca <> cb")
            .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct())


def links_to_components(members: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """``node, comp`` of the vertices that are linked (but the least of each component)."""
    named = members.sparkSession.createDataFrame([], "node long, comp long")

    def renamed(df: DataFrame, col: str) -> DataFrame:
        """The component of a column's vertices, as ``c`` and the column's name."""
        side = named.select(F.col("node").alias(col), F.col("comp").alias("_comp"))
        return df.join(side, col, "left").withColumn(f"c{col}", F.coalesce("_comp", F.col(col))).drop("_comp")

    def joined(found: DataFrame) -> DataFrame:
        """Components with more links."""
        found = stage(found.select(F.col("x").alias("u"), F.col("y").alias("v")), "found")
        if found.isEmpty():
            return named
        return stage(components(named.select(F.col("node").alias("u"), F.col("comp").alias("v")).unionByName(found)), "named")

    # every set meets the pivots of its signatures; then the pairs that are left
    met = stage(_measured(_pivots(members), sets, similar), "met")
    named = joined(met.where("over <= 0"))
    rest = stage(_open_pairs(met, sets, renamed, similar), "open_pairs")
    return joined(_measured(rest, sets, similar).where("over <= 0"))


def _refining(similar: tuple[int, int]):
    def make():
        bands = once(("bands", similar), lambda: Bands(similar))

        def work(batch):
            sigs, slack = [], []
            for band, elements in zip(batch.column("band").to_pylist(), batch.column("elements"), strict=True):
                bands.reach(len(elements))
                found, left = signatures(elements.values.to_numpy(zero_copy_only=False).view(_U), -2 - band, bands.fine(band))
                sigs.append(found.view(np.int64))
                slack.append(left)
            flat = np.concatenate(sigs) if sigs else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(np.append(0, np.cumsum([len(x) for x in sigs])).astype(np.int32), pa.array(flat))
            return pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("band"), batch.column("guest"), pa.array(slack, pa.int32()), lists],
                names=["node", "band", "guest", "slack", "sigs"])

        return work

    return make


def _plain_and_fine(shared: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The signatures that bring sets together. Hot plain ones are left out: by the sets that may do so, at
    once; by the others, for signatures of a finer partition, where many more segments may be left out.
    What is hot there, too, in sets that consist of little else, stays."""
    rows = stage(_by_set(shared), "by_set")
    first = rows.where(~F.col("is_hot"))
    crowded = rows.where(F.col("is_hot") & (F.col("hot") > F.col("slack"))).select("node", "band", "guest").distinct()
    fine = (map_batches(crowded.join(sets, "node").select("node", "band", "guest", "elements"), _refining(similar),
                        "node long, band int, guest boolean, slack int, sigs array<bigint>")
            .select("node", "band", "guest", "slack", F.explode("sigs").alias("sig")))
    second = _by_set(stage(_shared(fine), "fine_signatures"))
    return (first.select("sig", "node", "guest", "weight")
            .unionByName(second.where(~F.col("is_hot") | (F.col("hot") > F.col("slack"))).select("sig", "node", "guest", "weight")))


def similar_components(documents: DataFrame, *, id_col="doc_id", text_col="text", words=WORDS,
                       similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """``id, n_shingles, component_id, text_hash`` of every row: the size of its set, the least id reachable
    by links, and xxhash64 of its text (which tells rows with equal ids apart)."""
    narrow = documents.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    every = max(1, round(0.6 * similar[1] / (similar[1] - similar[0]))) if similar[0] < similar[1] else 1
    plain = stage(map_batches(narrow.withColumn("_hash", F.xxhash64("_text")), _naming(words, every),
                              "_id long, _hash long, node long, n_shingles long, sample array<bigint>"), "set_names")
    some = plain.where("n_shingles > 0 and _id is not null")
    vertices = stage(some.groupBy("node").agg(F.min("_id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                              F.max("n_shingles").alias("n_shingles")), "vertices")
    apart = lonely(plain.select("node", F.explode("sample").alias("e")), vertices.select("node", "n_shingles"), similar)
    needed = stage(vertices.join(apart, "node", "left_anti").select("node", "id"), "needed")
    gathered = map_batches(narrow.where(F.col("_id").isNotNull()).withColumn("_bit", _bit(F.col("_id"))),
                           _gathering(words, bit_filter(needed)), "node long, elements array<bigint>")
    sets = _sociable(stage(gathered.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets"), similar)
    rows = (map_batches(sets, _indexing(similar), "node long, index array<struct<band:int,guest:boolean,slack:int,sigs:array<bigint>>>")
            .select("node", F.explode("index").alias("b")).select("node", "b.band", "b.guest", "b.slack", F.explode("b.sigs").alias("sig")))
    shared = stage(_shared(rows), "signatures")
    members = stage(_plain_and_fine(shared, sets, similar), "members")
    named = links_to_components(members, sets, similar)
    joined = vertices.join(named, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = joined.groupBy("comp").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    classes = lookup(joined, least, ["comp"], "n").select("node", "copies", "component_id")
    keyed = plain.drop("sample").withColumn("_key", F.when(F.col("n_shingles") > 0, F.col("node")))
    out = lookup(keyed, classes.select(F.col("node").alias("_key"), "copies", "component_id"), ["_key"], "copies")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id"))
    return out.select(F.col("_id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("_hash").alias("text_hash"))


def keep_one(documents: DataFrame, *, id_col="doc_id", text_col="text", words=WORDS, similar=SIMILAR) -> DataFrame:
    """The documents without those similar to one that stays: of every component the row with the least
    id (then text hash) stays. Rows with an empty set or a null id stay."""
    found = stage(similar_components(documents, id_col=id_col, text_col=text_col, words=words, similar=similar), "similar")
    place = F.struct(F.col(id_col).alias("id"), F.col("text_hash").alias("th"))
    linked = (F.col("n_shingles") > 0) & F.col(id_col).isNotNull()
    least = (found.where(linked).groupBy("component_id").agg(F.min(place).alias("place"))
             .select(F.col("place.id").alias("_kid"), F.col("place.th").alias("_kth"), F.lit(True).alias("_first")))
    free = (found.where(~linked).select(F.col(id_col).alias("_kid"), F.col("text_hash").alias("_kth"), F.lit(False).alias("_first")).distinct())
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                              F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_th"))
    kept = packed.join(least.unionByName(free), F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")))
    # rows that agree in id and text are one document
    number = F.row_number().over(Window.partitionBy("_id", "_th").orderBy("_first"))
    return kept.withColumn("_n", number).where((F.col("_n") == 1) | ~F.col("_first")).select("row.*")


def _naming(words: int, every: int):
    """Names and sizes of all sets, and one in ``every`` of a set's shingles where the task meets it first."""

    def make():
        seen: set[int] = set()

        def work(batch):
            data, offsets = text_bytes(batch.column("_text"))
            node, size, samples = [], [], []
            for i, j in pieces(offsets):
                value, bounds = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words)
                names = set_hashes(value, bounds)
                node.append(names)
                size.append(np.diff(bounds))
                for k, name in enumerate(names.tolist()):
                    part = value[:0]
                    if name not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(name)
                        part = value[bounds[k]:bounds[k + 1]]
                        part = part[part % _U(every) == 0]
                    samples.append(part.view(np.int64))
            ends = np.append(0, np.cumsum([len(x) for x in samples])).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), pa.array(np.concatenate(node).view(np.int64)), pa.array(np.concatenate(size)),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(samples)))], names=["_id", "_hash", "node", "n_shingles", "sample"])

        return work

    return make


def lonely(elements: DataFrame, sizes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The sets (``node``) that have no partner, as too many of their elements (rows ``node, e``) are in no other set:
    a partner would lack them all, and similar sets lack at most 1 - J of each other's elements."""
    p, q = similar
    single = (elements.groupBy("e").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
              .groupBy("node").agg(F.count(F.lit(1)).alias("single")))
    return single.join(sizes, "node").where(q * F.col("single") > (q - p) * F.col("n_shingles")).select("node")


def _sociable(sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The sets left when lonely ones go, again and again while a fiftieth of them does."""
    while True:
        n = sets.count()
        gone = stage(lonely(sets.select("node", F.explode("elements").alias("e")),
                            sets.select("node", F.size("elements").alias("n_shingles")), similar), "lonely")
        sets = stage(sets.join(gone, "node", "left_anti"), "sociable")
        if n - sets.count() <= n // 50:
            return sets


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every document's component under 4-word shingles and 0.85 similarity."""
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")
