"""MinHash near-duplicate detection with an LSH forest and an exact join of its crowded regions.

A document's set holds the distinct hashes of its word shingles. Documents with equal sets form a
class. Each class has one signature of ``trees * levels`` minimum hashes. A tree of the forest is a
sorted order of all signatures: tree t reads them from place ``t * levels`` on, and around. Classes with
a common prefix of ``levels`` values stand together in an order: they are a region of it.

1. Neighbours: in the first orders every class is a candidate with the classes next to it, its longest
   common prefixes, however deep those are. Links are confirmed on whole sets and closed to components;
   a large group of copies becomes one component with a few pairs for each of its members.
2. The same in all other orders, for classes in regions that still hold several components.
3. Depth by region: a region of up to REGION classes that still holds several components is compared as a
   whole, at its first depth. In a larger one neighbours at the greatest depth have been compared, and
   what they leave goes to an exact prefix-filter join of whole sets, which loses no link however
   many classes share a passage.

A pair of similarity s that shares no region is missed with probability ``(1 - s ** levels) ** trees``: 3e-6
at 0.8 with the defaults, whatever the size of the regions. Copies are never expanded into pairs.

Defined results: null, empty and blank texts have an empty set, are linked with nothing
and form their own component; a text with fewer words than a shingle is one shingle;
repeated rows are one document; rows that share an id but not the text count as linked;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import batch_words, column, lean, mixed, salted_join, tables, text_steps, written
from plumbline.llm.components import components

TREES, LEVELS = 24, 4
#: Values of an order that its sort compares; classes alike in all of them are in no particular order.
DEPTH = 16
#: Classes of a region whose pairs are compared directly; the classes of larger regions go through an exact join.
REGION = 128


def shingles(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of each text, repeats included, with bounds.

    Letters A-Z are lowered; a text of fewer words than ``width`` is one shingle of all its words.
    """
    codes, bounds, words = batch_words(pc.ascii_lower(pc.fill_null(text.cast(pa.string()), "")))
    h = mixed(np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words)))[codes]
    n = np.diff(bounds)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_bounds = np.concatenate(([0], np.cumsum(count)))
    full = np.repeat(n >= width, count)
    at = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1] - bounds[:-1], count)
    out = np.zeros(out_bounds[-1], np.uint64)
    key = np.full(int(full.sum()), width, np.uint64)
    for k in range(width):
        key = mixed(key + h[at[full] + k])
    out[full] = key
    for d in np.flatnonzero((n > 0) & (n < width)):
        key = np.full(1, n[d], np.uint64)
        for k in range(n[d]):
            key = mixed(key + h[bounds[d] + k : bounds[d] + k + 1])
        out[out_bounds[d]] = key[0]
    return out, out_bounds


def coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the minimum hashes: a fixed pseudo-random rule."""
    base = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (base[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (base[count:] >> np.uint64(32)).astype(np.uint32)


def signatures(hashes: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """``count`` minimum hashes of each non-empty run; empty runs get the largest value."""
    out = np.full((len(bounds) - 1, count), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        a, b = coefficients(count)
        for k in range(count):
            out[some, k] = np.minimum.reduceat(low * a[k] + b[k], bounds[some])
    return out


def _sketching(width: int, trees: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for step in text_steps(batch, "text"):
                h, bounds = shingles(column(step, "text"), width)
                sizes = np.zeros(step.num_rows, np.int64)
                keys = np.zeros((2, step.num_rows), np.uint64)
                for d in np.flatnonzero(np.diff(bounds)):
                    own = np.unique(h[bounds[d] : bounds[d + 1]])
                    sizes[d] = len(own)
                    keys[0, d] = mixed(own).sum(dtype=np.uint64)
                    keys[1, d] = mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                sig = signatures(h, bounds, trees * levels)
                yield pa.RecordBatch.from_arrays(
                    [column(step, "doc_id"), pa.array(sizes), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "sig"],
                )

    return run


def _regions(trees: int, levels: int, some: slice = slice(None)):
    """Region keys of each class in all trees (or in ``some``). Passes the other columns on."""
    numbers = np.arange(trees, dtype=np.uint64)[some]
    order = np.arange(trees * levels).reshape(trees, levels)[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, t = batch.num_rows, len(order)
            if not n:
                continue
            sig = np.frombuffer(b"".join(column(batch, "sig").to_pylist()), np.uint32).reshape(n, -1)
            key = np.repeat(numbers[None, :] + np.uint64(levels << 32), n, 0)
            for level in range(levels):
                key = mixed(key.ravel()).reshape(n, t) + sig[:, order[:, level]]
            at = np.repeat(np.arange(n), t)
            keep = [c for c in batch.schema.names if c != "sig"]
            tree = pa.array(np.tile(numbers.astype(np.int32), n))
            yield pa.RecordBatch.from_arrays([pa.array(mixed(key.ravel()).view(np.int64)), *(column(batch, c).take(pa.array(at)) for c in keep), tree], names=["region", *keep, "tree"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for step in text_steps(batch, "text"):
                h, bounds = shingles(column(step, "text"), width)
                sets = [np.unique(h[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([column(step, "class_id"), pa.array(sets, pa.binary())], names=["class_id", "items"])

    return run


def confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets reach ``100 * intersection >= percent * union``."""
    for batch in batches:
        a, b = column(batch, "items_a"), column(batch, "items_b")
        good = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            x, y = np.frombuffer(a[k].as_buffer(), np.uint64), np.frombuffer(b[k].as_buffer(), np.uint64)
            if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = np.concatenate((x, y))
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            good[k] = 100 * common >= percent * (len(x) + len(y) - common)
        keep = pa.array(good)
        yield pa.RecordBatch.from_arrays([column(batch, "a").filter(keep), column(batch, "b").filter(keep)], names=["a", "b"])


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that whole sets confirm. A class with many pairs is dealt in parts."""
    pairs = written(pairs, "pairs")
    total = pairs.count()
    left = sets.select(F.col("class_id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("class_id").alias("b"), F.col("items").alias("items_b"))
    degree = lambda key: pairs.groupBy(key).agg(F.count("*").alias("weight"))
    both = salted_join(salted_join(pairs, left, "a", "b", total, degree("a")), right, "b", "a", total, degree("b"))
    return both.select("a", "b", "items_a", "items_b").mapInArrow(lambda it: confirmed(it, percent), "a long, b long")


def _region_pairs(percent: int, margin: float, order: np.ndarray):
    """Pairs of a region whose components differ and whose signatures and sizes allow the similarity.

    ``order``: the signature's places that each tree compares. A pair that meets in the regions of several
    trees is given by the first of them; ``trees`` has the bits of the trees in which a class stands in a whole region.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, comp, size, trees, tree = (table.column(c).to_numpy() for c in ("class_id", "component", "n_shingles", "trees", "tree"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(ids), -1)
        own, a, b = int(tree[0]), [], []
        for k in range(len(ids) - 1):
            other = np.flatnonzero(comp[k + 1 :] != comp[k]) + k + 1
            small, large = np.minimum(size[other], size[k]), np.maximum(size[other], size[k])
            other = other[100 * small >= percent * large]
            same = sig[other] == sig[k]
            near = same.mean(1) >= margin
            other, same = other[near], same[near]
            earlier = [t for t in range(own) if int(trees[k]) >> t & 1]
            if earlier and int(trees[k]) >> own & 1 and len(other):
                other = other[~same[:, order[earlier]].all(2).any(1)]
            a.append(np.minimum(ids[other], ids[k]))
            b.append(np.maximum(ids[other], ids[k]))
        return pa.table({"a": np.concatenate(a) if a else np.zeros(0, np.int64), "b": np.concatenate(b) if b else np.zeros(0, np.int64)}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _labels(trees: int, levels: int, depth: int, some: slice):
    """A row for each class and tree: the first ``depth`` values of the tree's order as bytes that sort like the values."""
    order = ((np.arange(trees) * levels)[:, None] + np.arange(depth)) % (trees * levels)
    numbers, order = np.arange(trees, dtype=np.int32)[some], order[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, t = batch.num_rows, len(order)
            if not n:
                continue
            sig = np.frombuffer(b"".join(column(batch, "sig").to_pylist()), np.uint32).reshape(n, -1)
            data = pa.py_buffer(sig[:, order].astype(">u4").tobytes())
            ends = pa.py_buffer((np.arange(n * t + 1) * (4 * depth)).astype(np.int32).tobytes())
            at = pa.array(np.repeat(np.arange(n), t))
            rest = [c for c in batch.schema.names if c != "sig"]
            label = pa.Array.from_buffers(pa.binary(), n * t, [None, ends, data])
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(numbers, n)), label, *(column(batch, c).take(at) for c in rest)], names=["tree", "label", *rest])

    return run


def _next_ones(levels: int, depth: int, percent: int, reach: int):
    """Pairs of rows up to ``reach`` places apart in a sorted order that share a region and whose components, sizes and labels allow a link.

    A label's ``depth`` values estimate the similarity; two binomial deviations below ``percent`` are let through.
    """
    least = percent / 100 * depth - 2 * (depth * percent / 100 * (1 - percent / 100)) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
            old = rows.num_rows - batch.num_rows
            label = np.frombuffer(b"".join(rows.column("label").to_pylist()), np.uint32).reshape(rows.num_rows, depth)
            tree, ids, comp, size = (rows.column(c).to_numpy() for c in ("tree", "class_id", "component", "n_shingles"))
            a, b = [], []
            for k in range(1, reach + 1):
                x, y = np.arange(rows.num_rows - k), np.arange(k, rows.num_rows)
                alike = label[x] == label[y]
                fits = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
                good = (y >= old) & (tree[x] == tree[y]) & alike[:, :levels].all(1) & (alike.sum(1) >= least) & (comp[x] != comp[y]) & fits
                a.append(np.minimum(ids[x], ids[y])[good])
                b.append(np.maximum(ids[x], ids[y])[good])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
            last = batch.slice(max(0, batch.num_rows - reach))

    return run


def _neighbour_pairs(classes: DataFrame, trees: int, levels: int, percent: int, some: slice, reach: int) -> DataFrame:
    """Candidates next to one another in the sorted orders ``some``.

    Every order is dealt by ranges of its labels, so that a region of any size spreads over tasks; two
    neighbours on both sides of a task's edge are left to the next steps.
    """
    depth = min(DEPTH, trees * levels)
    rows = classes.mapInArrow(_labels(trees, levels, depth, some), "tree int, label binary, class_id long, n_shingles long, component long")
    order = rows.repartitionByRange("tree", "label", "class_id").sortWithinPartitions("tree", "label", "class_id")
    return order.mapInArrow(_next_ones(levels, depth, percent, reach), "a long, b long").distinct()


def _forest_pairs(classes: DataFrame, trees: int, levels: int, percent: int, margin: float) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs between components that meet in a region of up to REGION classes, and the classes of larger ones.

    ``classes``: class_id, n_shingles, component, sig. Pairs whose signatures agree in a smaller share than ``margin`` are none.
    """
    members = written(_open_members(classes, trees, levels), "regions")
    near = members.where(F.col("m") <= REGION)
    masks = near.groupBy("class_id").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("trees"))
    pairs = _region_pairs(percent, margin, np.arange(trees * levels).reshape(trees, levels))
    found = near.select("region", "class_id", "tree").join(masks, "class_id").join(classes, "class_id").groupBy("region").applyInArrow(pairs, "a long, b long")
    return found.distinct(), members.where(F.col("m") > REGION).select("class_id").distinct()


def _open_members(classes: DataFrame, trees: int, levels: int) -> DataFrame:
    """Members of the regions, in all trees, that hold several components; ``m`` counts the region's classes."""
    rows = classes.select("class_id", "component", "sig").mapInArrow(_regions(trees, levels), "region long, class_id long, component long, tree int")
    open_regions = rows.groupBy("region").agg(F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("m > 1 and lo < hi")
    return rows.join(open_regions.select("region", "m"), "region").select("region", "class_id", "m", "tree")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set, with the set's size ``n`` and a hash ``mark`` of it."""
    for batch in batches:
        for step in text_steps(batch, "items"):
            sets = column(step, "items").to_pylist()
            n = np.array([len(x) // 8 for x in sets], np.int64)
            marks = np.array([xxhash.xxh3_64_intdigest(x) for x in sets], np.uint64).view(np.int64)
            ids = column(step, "class_id").to_numpy()
            yield pa.RecordBatch.from_arrays([*(pa.array(np.repeat(x, n)) for x in (ids, n, marks)), pa.array(np.frombuffer(b"".join(sets), np.int64))], names=["class_id", "n", "mark", "token"])


def _crowd_pairs(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs between components of ``crowd`` (class_id, component) that can be similar, by a prefix filter.

    Sets are ordered from the rarest shingle on. Of two sets of the similarity, the larger one's first
    ``n - ceil(s * n) + 1`` and the smaller one's first ``n - ceil(2 * s / (1 + s) * n) + 1`` have a shingle in common, and
    from the first common one on enough are left for the overlap. No such pair is lost, however many classes share a passage.
    Where most sets with a shingle are of one component, only the others are compared with all.
    """
    tokens = written(sets.join(crowd.select("class_id"), "class_id").select("class_id", "items").mapInArrow(_tokens, "class_id long, n long, mark long, token long"), "crowd-tokens")
    total = tokens.count()
    often = written(tokens.groupBy("token").agg(F.count("*").alias("weight")).where("weight > 1"), "token-counts")
    # Shingles of one set only come first and meet nothing: they are counted, not carried along.
    ranked = salted_join(tokens, often.withColumnRenamed("weight", "f"), "token", "class_id", total, often)
    order = ranked.groupBy("class_id", "n", "mark").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("tokens"))
    order = order.selectExpr("class_id", "n", "tokens", "n - size(tokens) AS alone", f"n - ({percent} * n + 99) div 100 + 1 AS prefix")
    first = order.selectExpr("class_id", "n", "alone", "posexplode(slice(tokens, 1, int(greatest(prefix - alone, 0)))) AS (at, t)").selectExpr("class_id", "n", "alone + at AS place", "t.token AS token")
    first = written(first.join(crowd, "class_id"), "prefixes")
    # main: the component that most of a shingle's sets belong to; shingles of one component are done.
    parts = first.groupBy("token", "component").agg(F.count("*").alias("own"))
    main = parts.groupBy("token").agg(F.max_by("component", F.struct("own", "component")).alias("main"), F.count("*").alias("parts"), F.sum("own").alias("weight")).where("parts > 1")
    main = written(main, "token-mains")
    first = written(salted_join(first, main.select("token", "main"), "token", "class_id", first.count(), main.select("token", "weight")), "prefixes")
    short = F.expr(f"place < n - (2 * {percent} * n + {99 + percent}) div {100 + percent} + 1")
    fits = f"(x.n < y.n OR x.n = y.n AND x.class_id < y.class_id) AND 100 * x.n >= {percent} * y.n AND {100 + percent} * least(x.n - x.place, y.n - y.place) >= {percent} * (x.n + y.n)"
    met = lambda x, y: x.alias("x").join(y.alias("y"), F.expr(f"x.token = y.token AND x.component <> y.component AND {fits}")).selectExpr("least(x.class_id, y.class_id) AS a", "greatest(x.class_id, y.class_id) AS b")
    minor, major = F.expr("component <> main"), F.expr("component = main")
    return met(first.where(short & minor), first).union(met(first.where(short & major), first.where(minor))).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, levels: int = LEVELS, first_trees: int = 8) -> DataFrame:
    """Component of each document under links of word-shingle similarity of ``percent`` or more.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``
    (whether the document is that one).
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with tables(docs.sparkSession) as keep:
        sketched, ids, known = _linked(texts, width, percent, trees, levels, first_trees)
        keep(sketched, ids, known)
    last = known.withColumnRenamed("node", "class_id")
    named = ids.join(last, "class_id", "left").select("k1", "k2", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))
    rows = sketched.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2", "n_shingles"], "left")
    component: Column = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _linked(texts: DataFrame, width: int, percent: int, trees: int, levels: int, first_trees: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables of the documents' sketches, of the classes, and of the components of linked classes."""
    sketched = written(texts.mapInArrow(_sketching(width, trees, levels), "doc_id long, n_shingles long, k1 long, k2 long, sig binary"), "sketches")
    ids = sketched.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("class_id"))
    ids = written(ids, "classes")
    classes = written(
        sketched.where("n_shingles > 0").join(ids.select(F.col("class_id").alias("doc_id"), "k1", "k2", "n_shingles"), ["doc_id", "k1", "k2", "n_shingles"], "left_semi").dropDuplicates(["doc_id", "k1", "k2"]).select(F.col("doc_id").alias("class_id"), "n_shingles", "sig"),
        "class-sketches",
    )
    # Classes that share any region at the first depth are all that can be linked; only their sets are made.
    rows = classes.select("class_id", "sig").mapInArrow(_regions(trees, levels), "region long, class_id long, tree int")
    shared = rows.groupBy("region").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).where("a < z").select("region")
    needed = written(rows.join(shared, "region", "left_semi").select("class_id").distinct(), "needed")
    sets = written(texts.join(needed.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("class_id"), "text").mapInArrow(_sets(width), "class_id long, items binary"), "sets").dropDuplicates(["class_id", "items"])
    share = percent / 100
    margin = share - 4.5 * (share * (1 - share) / (trees * levels)) ** 0.5
    known = None
    open_ids, crowded = needed, None
    for step in ("neighbours", "deeper", "forest", "crowds"):
        part = classes.join(open_ids, "class_id", "left_semi").withColumn("component", F.col("class_id"))
        if known is not None:
            part = part.drop("component").join(known.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
        part = written(part.select("class_id", "n_shingles", "component", "sig"), "parted")
        if step == "neighbours":
            pairs = _neighbour_pairs(part, trees, levels, percent, slice(0, first_trees), 1)
        elif step == "deeper":
            # Regions of one component have nothing left to find; all members of the others are here from now on.
            open_ids = written(_open_members(part, trees, levels).select("class_id").distinct(), "open")
            pairs = _neighbour_pairs(part.join(open_ids, "class_id", "left_semi"), trees, levels, percent, slice(first_trees, None), 2)
        elif step == "forest":
            pairs, crowded = _forest_pairs(part, trees, levels, percent, margin)
        else:  # all members of a crowded region are here, so regions that are now one component drop out
            members = _open_members(part.join(crowded, "class_id", "left_semi"), trees, levels).where(F.col("m") > REGION)
            crowd = written(part.join(members.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "component"), "crowd")
            if crowd.isEmpty():
                break
            pairs = _crowd_pairs(crowd, sets, percent)
        edges = _links(pairs, sets, percent)
        if known is not None:
            edges = edges.union(known.select(F.col("component").alias("a"), F.col("node").alias("b")))
        known = written(components(edges), "components")
    return sketched, ids, known


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text`` and others) that near_duplicates keeps; rows without an id stay."""
    kept = written(near_duplicates(docs, width, percent).where("kept").select(F.col("doc_id").alias("__kept_id")).distinct(), "kept")
    named = docs.where("doc_id is not null")
    joined = named.join(kept, named["doc_id"] == kept["__kept_id"], "left_semi")
    # an id's rows of other texts stay, as their similarity may be anything; of equal texts the first in order of the other columns does
    others = F.to_json(F.struct(*(c for c in docs.columns if c not in ("doc_id", "text")), F.lit(0).alias("__end")))
    once = joined.groupBy("doc_id", F.sha1(F.coalesce("text", F.lit("")).cast("binary")).alias("__text_key")).agg(F.min_by(F.struct(*docs.columns), others).alias("__row"))
    return once.select("__row.*").union(docs.where("doc_id is null"))
