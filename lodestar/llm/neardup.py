"""Near-duplicate components: MinHash, banding, verification, star contraction.

1. Each text's set of word shingles is hashed to 64 bits and reduced to many
   universal hash minima, whose bands give bucket keys.
2. Documents with equal sets form one class; only its smallest id goes on, so
   that a group of exact copies costs one row a copy.
3. Each bucket proposes links from its head (the member that meets most others
   in its buckets, so the one nearest to what a group has in common) to the
   other members: a star, not all pairs.  Signatures sort out the hopeless
   ones; a link counts when the full sets reach the threshold.
4. Components of the links come from alternating large-star and small-star.
5. Buckets whose members are still in two or more components may hold links
   that no star tested.  These are searched exactly, without pairing a group:
   * members at least half like their head p are compared through their
     differences from p.  With A, M the numbers of shingles added to and missing
     from p, a pair needs 7 * (differences in common) >=
     3 * (A1 + A2) + 4 * (M1 + M2) - |p|.  For a member that is no link of p this
     is more than the other's own 3A + 4M, so the other must share one of any
     A + M - (3A + 4M) // 7 of its differences; the rarest ones are looked up.
   * a member less than half like its head can only be like others that are no
     links of the head (two that are both half like one other head are left to
     that one).  Among these, a text of which more than a quarter of the shingles
     occur nowhere else is out; the others look up the rarest quarter.
   Pairs found so are verified on the full sets and components contracted again.

Two sets at exactly the threshold 0.75 share no band with probability 5e-6;
above it the chance falls quickly.

Results for edge cases: null or empty text, or text without words, has no
shingles and links with nothing; fewer words than a shingle give one shingle
of the whole sequence; rows without an id are never linked (component null,
kept); rows that repeat an id are each returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, row_slices, text_bytes
from .words import U64, Words, mix, odd_constants, words_of

WORDS, BANDS, ROWS = 5, 32, 4
#: Threshold as a fraction in hundredths: 100 * intersection >= 75 * union.
PERCENT = 75
#: Signature agreement below which a similarity of 0.5, or of 0.75, is out of the question
#: (4.5 and 6.5 standard deviations).
AGREE_HALF, AGREE = 0.3, 0.5

_A = odd_constants(31, BANDS * ROWS)
_B = odd_constants(32, BANDS * ROWS)
_BAND = odd_constants(33, ROWS)
_SALT = odd_constants(34, BANDS)


def shingle_sets(words: Words, size: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; empty for a text without words."""
    h = words.hashes(lower=True)
    windows, at = words.windows(h, size, seed=35)
    first = np.searchsorted(at, words.first)
    few = odd_constants(36, size)
    out = []
    for i, n in enumerate(words.counts):
        if n >= size:
            out.append(np.unique(windows[first[i]:first[i + 1]]))
        elif n:
            short = h[words.first[i]:words.first[i + 1]]
            out.append(mix((short * few[:n]).sum(keepdims=True) + U64(int(n))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of universal hash minima for each (non-empty) set."""
    values = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(_A)), np.uint64)
    for j in range(len(_A)):
        out[:, j] = np.minimum.reduceat(values * _A[j] + _B[j], at)
    return out


_SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("set1", T.LongType()), T.StructField("set2", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType())])
_SKETCH_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set1", pa.int64()),
                           ("set2", pa.int64()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])

def _sliced(batch: pa.RecordBatch):
    raw, off = text_bytes(batch.column(1))
    for first, end in row_slices(off):
        yield batch.column(0).slice(first, end - first), words_of(raw[off[first]:off[end]], off[first:end + 1] - off[first])


def _sketch(batches):
    for batch in batches:
        for ids, words in _sliced(batch):
            sets = shingle_sets(words)
            n = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(n)
            one = np.zeros(len(sets), np.uint64)
            two, sig = one.copy(), [None] * len(sets)
            bands: list = [None] * len(sets)
            if len(some):
                full = [sets[i] for i in some]
                low = minima(full)
                keys = mix((low.reshape(len(full), BANDS, ROWS) * _BAND).sum(axis=2) + _SALT).view(np.int64)
                short = (low >> U64(48)).astype(np.uint16)
                for row, i in enumerate(some):
                    bands[i], sig[i] = keys[row], short[row].tobytes()
                    one[i] = sets[i].sum()
                    two[i] = mix(sets[i] * U64(0x9E3779B97F4A7C15) + U64(7)).sum()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())], schema=_SKETCH_ARROW)


def _sets(batches):
    for batch in batches:
        for ids, words in _sliced(batch):
            sets = shingle_sets(words)
            yield pa.RecordBatch.from_arrays([ids, pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["doc", "members"])


def _agree(least: float):
    """Pairs whose signatures agree in at least that share of the minima."""

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BANDS * ROWS) for i in (2, 3))
            keep = pa.array((a == b).mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return run


def _pairs_of_sets(batch):
    last = batch.num_columns - 1
    for x, y in zip(batch.column(last - 1), batch.column(last), strict=True):
        yield np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)


def _common(batches):
    """(a, b, common, either): sizes of the intersection and of the union of the full sets."""
    for batch in batches:
        common, either = [], []
        for x, y in _pairs_of_sets(batch):
            both = np.sort(np.concatenate([x, y]), kind="stable")
            common.append(int((both[1:] == both[:-1]).sum()))
            either.append(len(both) - common[-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), pa.array(either, pa.int64())],
                                         names=["a", "b", "common", "either"])


def _differences(batches):
    """(head, doc, feature, probes, ...): what b has beyond a, and lacks of it; the number of features to look up; the pair's other columns."""
    for batch in batches:
        features, probes = [], []
        for x, y in _pairs_of_sets(batch):
            added, missing = np.setdiff1d(y, x, assume_unique=True), np.setdiff1d(x, y, assume_unique=True)
            features.append(np.concatenate([added, mix(missing + U64(1))]))
            probes.append(len(features[-1]) - (3 * len(added) + 4 * len(missing)) // 7)
        if features:
            many = np.array([len(f) for f in features], np.int64)
            pair = pa.array(np.repeat(np.arange(len(many)), many))
            head, doc, linked, component, home = (batch.column(i).take(pair) for i in range(5))
            yield pa.RecordBatch.from_arrays(
                [head, doc, pa.array(np.concatenate(features).view(np.int64)), pa.array(np.repeat(np.array(probes, np.int64), many)),
                 linked, component, home], names=["head", "doc", "feature", "probes", "linked", "component", "home"])


def _members(batches):
    """(doc, feature, size): the shingles of rows (doc, members)."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
        size = np.array([len(x) for x in sets], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), size)), pa.array(np.concatenate(sets)),
                                          pa.array(np.repeat(size, size))], names=["doc", "feature", "size"])


def _beside(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    columns = pairs.columns
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("doc").alias(side), F.col(value).alias(f"{side}_value")), side)
    return pairs.select(*columns, "a_value", "b_value")


def _measured(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, common, either) of the pairs that the signatures leave."""
    likely = _beside(pairs, signatures, "signature").mapInArrow(_agree(least), "a long, b long")
    return _beside(likely, sets, "members").mapInArrow(_common, "a long, b long, common long, either long")


def _is_link() -> F.Column:
    return 100 * F.col("common") >= PERCENT * F.col("either")


def _sharing(probes: DataFrame, index: DataFrame, on: list[str], apart: str) -> DataFrame:
    """Pairs (a, b), once or more, of a probe and an index row that are equal in ``on``.

    Both carry doc, component and home; ``apart`` says which pairs p, q matter.
    """
    same = " AND ".join(f"p.{c} = q.{c}" for c in on)
    pairs = probes.alias("p").join(index.alias("q"), F.expr(f"{same} AND p.doc <> q.doc AND p.component <> q.component AND {apart}"))
    return pairs.select(F.least("p.doc", "q.doc").alias("a"), F.greatest("p.doc", "q.doc").alias("b"))


def _rarest(rows: DataFrame, counts: DataFrame, on: list[str], per: list[str], own: str, many: F.Column) -> DataFrame:
    """Of each ``per``, the ``many`` features that the fewest others have; without those that no other has.

    ``own`` tells whether a row is itself among those counted.
    """
    rows = rows.join(counts, on, "left").withColumn("others", F.coalesce("n", F.lit(0)) - F.when(F.col(own), 1).otherwise(0))
    place = F.row_number().over(W.partitionBy(*per).orderBy("others", "feature"))
    return rows.withColumn("place", place).where((F.col("place") <= many) & (F.col("others") > 0))


def _near_heads(stars: DataFrame, sets: DataFrame, tags: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs to verify among members at least half like their head; ``stars`` has (head, doc, linked)."""
    heads = stars.where("NOT linked").select("head").distinct()
    stars = stars.join(heads, "head", "left_semi")
    pairs = stars.join(tags, "doc").select(F.col("head").alias("a"), F.col("doc").alias("b"), "linked", "component", "home")
    rows = scratch.put(_beside(pairs, sets, "members").mapInArrow(
        _differences, "head long, doc long, feature long, probes long, linked boolean, component long, home long"), "differences")
    index = rows.where("NOT linked")
    counts = index.groupBy("head", "feature").agg(F.count("*").alias("n"))
    probes = _rarest(rows.withColumn("own", ~F.col("linked")), counts, ["head", "feature"], ["head", "doc"], "own", F.col("probes"))
    return _sharing(probes, index, ["head", "feature"], "true")


def _far_from_heads(far: DataFrame, others: DataFrame, sets: DataFrame, tags: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs to verify of members ``far`` from their head, with each other and with ``others`` (both: doc).

    Two with one home are both half like that head, which compares them already.
    """
    every = far.select("doc", F.lit(True).alias("far")).unionAll(others.select("doc", F.lit(False).alias("far")))         .groupBy("doc").agg(F.max("far").alias("far"))
    rows = scratch.put(sets.join(every, "doc", "left_semi").select("doc", "members").mapInArrow(
        _members, "doc long, feature long, size long"), "shingles")
    counts = scratch.keep(rows.groupBy("feature").agg(F.count("*").alias("n")).where("n > 1"), "frequent")
    # Of each document, how many of its shingles another one has: too few, and it is like none.
    shared = rows.join(counts, "feature").groupBy("doc", "size").agg(F.count("*").alias("n")).where(100 * F.col("n") >= PERCENT * F.col("size"))
    left = scratch.keep(shared.select("doc").join(every, "doc").join(tags, "doc"), "left")
    rows = rows.join(left, "doc").withColumn("own", F.lit(True))
    many = F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1
    probes = _rarest(rows, counts, ["feature"], ["doc"], "own", many)
    return _sharing(probes, rows.where("far").join(counts, "feature", "left_semi"), ["feature"], "coalesce(p.home <> q.home, true)")


def _homes(rays: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, home): of the heads that a document is half like, or is, the one that most documents are half like."""
    half = rays.where("half").select("head", "doc")
    # A table of its own, so that the members of a head with many can be dealt to several tasks.
    sizes = scratch.keep(half.groupBy("head").agg(F.count("*").alias("n")), "homes")
    own = half.unionAll(sizes.select("head", F.col("head").alias("doc")))
    return own.join(sizes, "head").groupBy("doc").agg(F.max(F.struct("n", "head")).alias("top")).select("doc", F.col("top.head").alias("home"))


def components(links: DataFrame, scratch: Scratch, label: str = "stars") -> DataFrame:
    """(node, component): the smallest node reachable, by alternating large-star and small-star.

    ``links`` has columns a, b.  Each star takes a node's smallest neighbour
    from a map-side combined minimum, a table of its own before it is joined
    back, so that a hub's neighbours can be dealt to several tasks.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges, step = scratch.put(edges, f"{label}0small"), 0
    while True:
        step += 1
        both = edges.select(F.explode(F.array(
            F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e")).select("e.*")
        low = scratch.keep(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "low")
        # Large star: neighbours above a node move to its smallest neighbour.
        large = both.where("v > u").join(low, "u").where("v <> m").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = scratch.keep(large, "large")
        least = scratch.keep(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        # Small star: a node and its smaller neighbours move to the smallest of these.
        small = large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi <> lo").distinct()
        small = scratch.put(small, f"{label}{step}small")
        scratch.drop("low", "large", "least", f"{label}{step - 1}small")
        edges = small
        # Done when every edge is a spoke: each node on one edge up, and no hub hangs on another.
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
            F.struct(F.col("lo").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR up > 0 AND down > 0").isEmpty():
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept), a row for each input row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = scratch.put(texts.mapInArrow(_sketch, _SKETCH), "sketch")

    same = ["set1", "set2", "n_shingles"]
    classes = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    classes = scratch.keep(classes, "classes")
    nodes = sketch.join(classes, same, "left").withColumn(
        "rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
    first = F.col("rep") == F.col("doc_id")
    nodes = scratch.put(nodes.select(
        "doc_id", "n_shingles", "rep", F.when(first, F.col("bands")).alias("bands"),
        F.when(first, F.col("signature")).alias("signature")), "nodes")
    scratch.drop("sketch", "classes")

    spread = nodes.where("n_shingles > 0 AND rep = doc_id").select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"))
    sizes = scratch.keep(spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    members = scratch.keep(spread.join(sizes, "bucket"), "members")
    # Written, as its size on disk tells whether signatures and texts can be filtered without a shuffle.
    meetings = scratch.put(members.groupBy("doc").agg(F.sum("n").alias("meetings")), "meetings")
    heads = members.join(meetings, "doc").groupBy("bucket").agg(F.max(F.struct("meetings", (-F.col("doc")).alias("minus"))).alias("top"))
    heads = scratch.keep(heads.select("bucket", (-F.col("top.minus")).alias("head")), "heads")
    members = scratch.put(members.join(heads, "bucket"), "headed")
    scratch.drop("sizes", "members", "heads")
    signatures = scratch.put(nodes.where("signature IS NOT NULL").select(F.col("doc_id").alias("doc"), "signature")
                             .join(meetings, "doc", "left_semi"), "signatures")
    sets = scratch.put(texts.withColumnRenamed("doc_id", "doc").join(meetings, "doc", "left_semi")
                       .select("doc", "text").mapInArrow(_sets, "doc long, members binary"), "sets")

    stars = members.where("doc <> head").select(F.col("head").alias("a"), F.col("doc").alias("b")).distinct()
    measured = scratch.put(_measured(stars, signatures, sets, AGREE_HALF), "measured")
    links = measured.where(_is_link()).select("a", "b")
    found = components(links, scratch)

    labelled = members.join(found, F.col("doc") == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc"))
    split = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
    split = scratch.keep(split.where("x < y AND n > 2").select("bucket"), "split")
    rays = members.join(split, "bucket", "left_semi").where("doc <> head").select("head", "doc").distinct()
    rays = rays.join(measured.select(F.col("a").alias("head"), F.col("b").alias("doc"), "common", "either")
                     .groupBy("head", "doc").agg(F.max("common").alias("common"), F.min("either").alias("either")), ["head", "doc"], "left")
    rays = scratch.put(rays.select("head", "doc", F.coalesce(_is_link(), F.lit(False)).alias("linked"),
                                   F.coalesce(2 * F.col("common") >= F.col("either"), F.lit(False)).alias("half")), "rays")
    tags = rays.select("doc").distinct().join(found, F.col("doc") == F.col("node"), "left").join(_homes(rays, scratch), "doc", "left")
    tags = scratch.put(tags.select("doc", F.coalesce("component", "doc").alias("component"), "home"), "tags")
    pairs = _near_heads(rays.where("half").select("head", "doc", "linked"), sets, tags, scratch).unionAll(_far_from_heads(
        rays.where("NOT half").select("doc").distinct(), rays.where("half AND NOT linked").select("doc").distinct(), sets, tags, scratch))
    more = scratch.put(_measured(pairs.distinct(), signatures, sets, AGREE).where(_is_link()).select("a", "b"), "more")
    if not more.isEmpty():
        found = components(found.toDF("a", "b").unionAll(more), scratch, "again")
    scratch.drop("meetings", "headed", "signatures", "sets", "measured", "split", "rays", "homes", "tags",
                 "differences", "shingles", "frequent", "left", "more")

    out = nodes.select("doc_id", "n_shingles", "rep").join(found, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep")
    return out.select(F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that are not the first of their component."""
    gone = near_duplicates(docs, key, text).where("NOT kept").select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[key] == F.col("_gone"), "left_anti")
