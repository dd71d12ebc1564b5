"""Exact Jaccard join of n-gram sets as a metric-space join; results are connected components.

The Jaccard distance d is a metric. Two sets link when their similarity is at least ``share`` percent, that
is, when d is at most r. The join is a recursion over regions:

* The first regions. Documents without a common shingle are at distance 1, so a document's rarest shingles
  are its landmarks: any linked pair shares one of the first n - ceil(share * n) + 1 in a common order, here
  (number of sets that have it, hash). The numbers are exact: blocks of documents send their distinct shingles
  to hash buckets and get the counts back. Shingles of one set only are no landmarks. A region is the documents
  of one landmark; regions of equal membership are taken once.
* Before the regions are built, every set meets a few hubs: ``HUBS`` smallest values under different hash orders say
  which sets are likely near, and of the sets with one such value the one with most landmarks, that is, the near copy
  with fewest changes, is measured against the others. This connects most members of groups of near copies with a
  few distances each. What is not found here is found below; so it costs no link.
* Only regions whose members are not all connected by then are built, and in them only what is not known to be
  connected is compared. Regions of at most ``LEAF`` members are compared directly.
* In a larger region the open members are first measured against ``HOME_PIVOTS`` pivots of their home, the largest region
  they are in.
* One level of the recursion for what is left. Every region draws pivots among its open members (at first all are); all members' distances
  to the pivots are found, each distinct pair once. Members within r of a pivot lie in its cell and are linked.
  Members known to be connected need not be compared: the largest connected group of a region is closed, the
  others stay open. A closed member can still link to an open one, but by the triangle inequality only if its
  distance to its pivot is at least (smallest open distance to that pivot) - r: only these boundary members are
  replicated into the next level's region. A region is done when all its members are connected. The number of
  pivots grows by a factor, so the recursion ends after a logarithmic number of levels with every pair measured,
  connected, or excluded by a proof.
* Before sets are compared, a second family of pivots gives a lower bound: the shingle universe is cut in
  parts, ``BITS`` for every shingle, and the parities of a set's shingles in each part are its coordinates. The
  number of parities that differ bounds the symmetric difference from below, and nearly reaches it when two sets are
  close, so pairs that do not link rarely fetch their sets.

Equal sets are one node. Nothing is collected; every step of a level and of the components is written to the
shared scratch folder and deleted when the result, which is small, has been written.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; a text
of fewer words than ``width`` is one shingle; documents that repeat are one node; a null doc_id keeps a null
component (its text still connects others); rows with the same doc_id are judged row by row; empty tables
give empty results. Only the id and text columns are read. Sets and nodes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm import blocks as bl
from lakeops.llm import textbytes as tb
from lakeops.llm.graph import components

PIECE_BYTES = 1 << 20
MIN_PARTS, BITS = 512, 4
KEY_BITS, MOST = 48, 65535
#: Regions of so many members, and open members of so many, are compared directly: the end of the recursion.
LEAF = 32
#: The recursion starts with 8 times as many pivots a region, and each level draws that many times more.
PIVOTS = 8
#: Hash orders under which sets meet hubs, and pivots tried at home.
HUBS, HOME_PIVOTS = 3, 4
_ORDERS = tb.mix(np.arange(1, HUBS + 1, dtype=np.uint64)) | np.uint64(1)
CHUNK = 64


def shingle_sets(texts: list[str | None], width: int):
    """The sorted distinct shingle hashes of every text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data, begins = tb.join_texts(raw)
    data = tb.LOWER[data]
    starts, ends = tb.runs(tb.NOT_SPACE[data])
    codes = tb.span_hash(tb.prefix_hash(data), starts, ends)
    counts = tb.owner_counts(begins, starts)
    first = np.r_[0, np.cumsum(counts)]
    grams = tb.gram_hash(codes, width)
    out = []
    for i, n in enumerate(counts.tolist()):
        lo = int(first[i])
        if n >= width:
            out.append(np.unique(grams[lo:lo + n - width + 1]))
        elif n:
            out.append(tb.gram_hash(codes[lo:lo + n], n) ^ np.uint64(n))
        else:
            out.append(codes[:0])
    return out


def _block_sets(payload: bytes, width: int):
    """The batch of a block and the shingle set of each of its rows."""
    batch = bl.from_bytes(payload)
    sets = []
    for _, _, texts in tb.text_groups(batch, 1, PIECE_BYTES):
        sets += shingle_sets(texts, width)
    return batch, sets


def _keys_of(sets: list[np.ndarray]):
    """The distinct keys (the hashes' first ``KEY_BITS`` bits) of a block's distinct sets, and in how many sets each is."""
    own = {_signature(s): s for s in sets if len(s)}
    every = np.concatenate(list(own.values())) if own else np.empty(0, np.uint64)
    return np.unique(every >> np.uint64(64 - KEY_BITS), return_counts=True)


def _scatter_keys(batches, width: int, buckets: int):
    for block, payload in bl.rows_of(batches):
        keys, n = _keys_of(_block_sets(payload, width)[1])
        of = ((keys >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
        for lo, hi in zip(cuts.tolist(), np.r_[cuts[1:], len(of)].tolist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(of[lo])], pa.int64()), pa.array([block], pa.int64()),
                 pa.array([bl.columns_to_bytes(keys=bl.pack_sorted(keys[lo:hi]), n=np.minimum(n[lo:hi], MOST).astype(np.uint16))], pa.binary())],
                ["bucket", "block", "payload"])


def _add_counts(key, table: pa.Table) -> pa.Table:
    """Of one bucket: tells each block in how many sets of the corpus its keys are (``MOST`` stands for more)."""
    sent = [bl.columns_from_bytes(p) for p in table.column("payload").to_pylist()]
    keys = [bl.unpack_sorted(x["keys"]) for x in sent]
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.minimum(np.bincount(at, np.concatenate([x["n"] for x in sent])), MOST).astype(np.uint16)
    out, begin = [], 0
    for k in keys:
        out.append(bl.columns_to_bytes(n=total[at[begin:begin + len(k)]]))
        begin += len(k)
    return pa.table([pa.array([key[0].as_py()] * len(out), pa.int64()), table.column("block"), pa.array(out, pa.binary())], names=["bucket", "block", "payload"])


def _signature(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = tb.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))
        return int(tb.mix(np.array([total]))[0].view(np.int64))


def _node_rows(batches, width: int, share: int):
    """Per document: its node, size, landmarks, hub values and coordinates. A landmark is a shingle of the prefix that another set
    of the corpus has too; the prefix is taken in the order of (sets that have it, hash)."""
    seen: set[int] = set()
    for payload, answers in bl.rows_of(batches):
        batch, sets = _block_sets(payload, width)
        keys, _ = _keys_of(sets)
        answers.sort(key=lambda a: a["bucket"])  # buckets hold ranges of keys, in order
        count = np.concatenate([bl.columns_from_bytes(a["payload"])["n"] for a in answers]) if answers else np.empty(0, np.uint16)
        nodes, sizes, landmarks, hubs, sketches = [], [], [], [], []
        for s in sets:
            n = len(s)
            node = _signature(s) if n else None
            nodes.append(node)
            sizes.append(n)
            marks = None
            if n and node not in seen:
                seen.add(node)
                found = count[np.searchsorted(keys, s >> np.uint64(64 - KEY_BITS))]
                length = n - -(-share * n // 100) + 1
                first = np.lexsort((s, found))[:length]
                marks = s[first[found[first] > 1]].view(np.int64)
            landmarks.append(marks if marks is not None and len(marks) else None)
            hubs.append(tb.mix(np.array([(s * o).min() for o in _ORDERS]) + _ORDERS).view(np.int64) if landmarks[-1] is not None else None)
            sketches.append(_coordinates(s).tobytes() if landmarks[-1] is not None else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(landmarks, pa.list_(pa.int64())), pa.array(hubs, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
            ["doc_id", "node", "n", "landmarks", "hubs", "sketch"])


def _set_rows(batches, width: int, column: int):
    for batch in batches:
        for _, _, texts in tb.text_groups(batch, column, PIECE_BYTES):
            found = [s for s in shingle_sets(texts, width) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_signature(s) for s in found], pa.int64()),
                                              pa.array([s.tobytes() for s in found], pa.binary())], ["node", "shingles"])
    bl.release()


def _coordinates(s: np.ndarray) -> np.ndarray:
    """Parities, as bits, of the numbers of a set's shingles in equal parts of the universe: ``BITS`` parts a shingle."""
    parts = max(MIN_PARTS, 1 << (max(1, len(s) * BITS) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(parts - 1)).astype(np.int64), minlength=parts) & 1)


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Rows of coordinates, of a finer division, in the coarser one of ``width`` bytes, as 64-bit words."""
    folded = np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)
    return np.ascontiguousarray(folded).view(np.uint64)


def _may_link(batches, share: int):
    """Drops pairs whose coordinates alone prove a larger distance; (x, nx, sx, p, np, sp) -> (x, nx, p, np)."""
    for batch in batches:
        sizes = batch.column(1).to_numpy() + batch.column(4).to_numpy()
        a, b = batch.column(2).to_pylist(), batch.column(5).to_pylist()
        apart = np.empty(len(a), np.int64)
        widths = np.array([(len(x), len(y)) for x, y in zip(a, b)], np.int64).reshape(-1, 2)
        for wa, wb in np.unique(widths, axis=0).tolist():
            rows = np.flatnonzero((widths[:, 0] == wa) & (widths[:, 1] == wb))
            side = lambda of, w: _folded(np.frombuffer(b"".join(of[i] for i in rows), np.uint8).reshape(len(rows), w), min(wa, wb))
            apart[rows] = np.bitwise_count(side(a, wa) ^ side(b, wb)).sum(axis=1, dtype=np.int64)
        # similarity >= share / 100 means symmetric difference <= (nx + np) * (100 - share) / (100 + share)
        keep = apart * (100 + share) <= sizes * (100 - share)
        yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1, 3, 4])
    bl.release()


def _distances(batches):
    for whole in batches:
        for lo in range(0, whole.num_rows, 256):
            batch = whole.slice(lo, 256)
            common = []
            for x, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, p = np.frombuffer(x, np.uint64), np.frombuffer(p, np.uint64)
                at = np.minimum(np.searchsorted(p, x), len(p) - 1)
                common.append(int((p[at] == x).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64()), batch.column(4), batch.column(5)],
                                             ["x", "p", "common", "nx", "np"])
    bl.release()


def near_classes(documents: DataFrame, width: int = 4, share: int = 85, doc_id: str = "doc_id", text: str = "text",
                 broadcast_bytes: int = 8 << 20) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles and component_id, the smallest doc_id that can be reached by
    links of at least ``share`` percent Jaccard similarity."""
    if not 1 <= share <= 100 or width < 1:
        raise ValueError("share must be 1 to 100 percent and width at least 1")
    spark = documents.sparkSession
    store = bl.Store(spark)
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    blocks = bl.pack(docs, "text", store.keep)
    buckets = bl.bucket_count(blocks)
    sent = "bucket long, block long, payload binary"
    counts = blocks.mapInArrow(lambda b: _scatter_keys(b, width, buckets), sent).groupBy("bucket").applyInArrow(lambda key, t: _add_counts(key, t), sent)
    mine = counts.groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias("answers"))
    known = blocks.join(mine, "block", "left").select("payload", F.coalesce("answers", F.array().cast("array<struct<bucket:bigint,payload:binary>>")).alias("answers"))
    rows = store.keep(known.mapInArrow(lambda b: _node_rows(b, width, share),
                                       f"doc_id {id_type}, node long, n long, landmarks array<long>, hubs array<long>, sketch binary"))
    labels = _join_regions(docs, rows, width, share, broadcast_bytes, store)
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    if labels is not None:
        labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        first = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
        nodes = labelled.join(first, "label").select("node", "component_id")
    else:
        nodes = nodes.select("node", F.col("first").alias("component_id"))
    return store.result(rows.select("doc_id", "node", F.col("n").alias("n_shingles")).join(nodes, "node", "left")
                        .select("doc_id", "n_shingles",
                                F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def _hub_pairs(sets: DataFrame, order: int, labels: DataFrame | None, share: int) -> DataFrame:
    """Pairs of every set with the hub of its value under one hash order, unless they are known to be connected."""
    met = sets.select("node", "n", "degree", F.col("hubs")[order].alias("region"))
    met = met.withColumn("label", F.col("node")) if labels is None else _labelled(met, labels)
    rank = F.struct(F.col("degree"), F.xxhash64("node").alias("h"), F.col("node").alias("p"), F.col("n").alias("np"), F.col("label").alias("to"))
    hubs = (met.groupBy("region").agg(F.max(rank).alias("b"), F.min("label").alias("l1"), F.max("label").alias("l2")).where("l1 <> l2")
            .select("region", "b.p", "b.np", "b.to"))
    return (met.join(hubs, "region").where("label <> to").where(_sizes_allow(share))
            .select(F.least("node", "p").alias("x"), F.greatest("node", "p").alias("p")))


def _first_regions(sets: DataFrame, labels: DataFrame, store) -> DataFrame:
    """(region, node, n, degree, label, m) of every landmark whose sets are not all known to be connected, regions of
    equal members once."""
    postings = _labelled(sets, labels).select(F.explode("landmarks").alias("region"), "node", "n", "degree", "label")
    of = lambda seed: F.sum(F.shiftrightunsigned(F.xxhash64("node", F.lit(seed)), 32))
    open_ = store.keep(postings.groupBy("region").agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.count("*").alias("m"),
                                                      F.min("node").alias("low"), of(1).alias("s1"), of(2).alias("s2")).where("l1 <> l2")
                       .groupBy("m", "low", "s1", "s2").agg(F.min("region").alias("region")).select("region", "m"))
    return store.keep(postings.join(open_, "region"))


def _join_regions(docs, rows, width, share, broadcast_bytes, store) -> DataFrame | None:
    """Labels of all nodes that have a link, by the recursion over regions; None if no two nodes meet."""
    sets = store.keep(rows.where("sketch is not null").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "landmarks", "hubs", "sketch")])
                      .withColumn("degree", F.size("landmarks").cast("long")))
    if sets.isEmpty():
        return None
    sketches = sets.select("node", "n", "degree", "sketch")
    r = (100 - share) / 100 + 1e-9
    verify = lambda maybe: _measure(docs, rows, maybe, width, share, broadcast_bytes, store)
    measure = lambda pairs: verify(store.keep(_not_excluded(pairs.distinct(), sketches, share)))
    links = labels = None
    for order in range(HUBS):
        found = _links(measure(_hub_pairs(sets, order, labels, share)))
        links = found if links is None else links.unionAll(found)
        labels = store.keep(_near_labels(links, labels))
    members = _first_regions(sets, labels, store)
    leaf = members.where(F.col("m") <= LEAF).select("region", "node", "n", "label")
    other = leaf.select("region", F.col("node").alias("p"), F.col("n").alias("np"), F.col("label").alias("to"))
    direct = leaf.join(other, "region").where("node < p and label <> to").where(_sizes_allow(share)).select(F.col("node").alias("x"), "p")
    opened = _open(members.where(F.col("m") > LEAF), store)
    links = links.unionAll(_links(measure(direct.unionByName(_home_pairs(opened, HOME_PIVOTS, share)))))
    labels = store.keep(_near_labels(links, labels))
    opened = _open(_labelled(opened.select("region", "node", "n", "m", "degree"), labels), store)
    members = opened.select("region", "node", "n", "label", "open")
    pivots_each = 8 * PIVOTS
    while True:
        live = _draw_pivots(members, pivots_each, store)
        if live.isEmpty():
            return components(links.unionAll(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))), keep=store.keep)
        met = store.keep(_meet(live.join(sketches.select("node", "sketch"), "node"), share))
        measured = verify(store.keep(met.where("region is null").select("x", "nx", "p", "np").distinct()))
        links = links.unionAll(_links(measured))
        labels = store.keep(_near_labels(links, labels))
        reach = met.where("region is not null").groupBy("region", "p").agg((F.min("least") - r).alias("reach"))
        members = _next_regions(live, measured, reach, labels, store)
        pivots_each *= PIVOTS


def _links(measured: DataFrame) -> DataFrame:
    return measured.where("linked").select(F.col("x").alias("a"), F.col("p").alias("b"))


def _home_pairs(members: DataFrame, each: int, share: int) -> DataFrame:
    """Pairs of every open member with the ``each`` pivots of its home, the largest region it is in. Pivots are the
    members with most landmarks in regions: near copies with few changes, which are near the others."""
    rank = F.struct(F.col("degree"), F.xxhash64("node").alias("h"), F.col("node").alias("p"), F.col("n").alias("np"))
    home = members.where("open").groupBy("node", "n").agg(F.max(F.struct("m", "region")).alias("home")).select("node", "n", "home.region")
    # The best of each of ``each`` parts of a region.
    part = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(each)).alias("part")
    best = members.groupBy("region", part).agg(F.max(rank).alias("b")).select("region", "b.p", "b.np")
    return (home.join(best, "region").where("node <> p").where(_sizes_allow(share))
            .select(F.least("node", "p").alias("x"), F.greatest("node", "p").alias("p")))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open(rest: DataFrame, store) -> DataFrame:
    """Labelled members, with open, of the regions in which not all are known to be connected; all but a region's
    largest group of connected members are open."""
    sizes = rest.groupBy("region", "label").agg(F.count("*").alias("k"))
    main = sizes.groupBy("region").agg(F.max(F.struct("k", "label")).alias("largest"), F.count("*").alias("groups"))
    return store.keep(rest.join(main.where("groups > 1"), "region").withColumn("open", F.col("label") != F.col("largest.label"))
                      .drop("largest", "groups"))


def _near_labels(links: DataFrame, known: DataFrame | None) -> DataFrame:
    """(node, label): a smaller node of the same component, near the smallest one: the smallest neighbour by a link or
    a known label, followed twice. Equal labels prove a connection; only the result needs the whole components."""
    if known is not None:
        links = links.unionAll(known.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    for _ in range(2):
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("to"))
        labels = labels.join(further, "label").select("node", F.least("label", "to").alias("label"))
    return labels


def _sizes_allow(share: int):
    return F.least("n", "np") * 100 >= F.greatest("n", "np") * share


def _draw_pivots(members: DataFrame, each: int, store) -> DataFrame:
    """Members of the regions that are not done, about ``each`` open ones of a region marked as pivots (all of
    them if they are few, and one at least)."""
    stats = members.groupBy("region").agg(F.min("label").alias("l1"), F.max("label").alias("l2"),
                                          F.sum(F.col("open").cast("long")).alias("n_open"),
                                          F.min(F.when(F.col("open"), F.struct(F.xxhash64("node"), "node"))).alias("first"))
    live = members.join(stats.where("l1 <> l2 and n_open > 0"), "region")
    chance = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) / (1 << 30)
    drawn = (F.col("node") == F.col("first.node")) | (F.col("n_open") <= LEAF) | (chance * F.col("n_open") < each - 1)
    return store.keep(live.select("region", "node", "n", "label", "open", (F.col("open") & drawn).alias("pivot")))


def _not_excluded(pairs, sketches, share) -> DataFrame:
    """(x, nx, p, np) of the pairs whose coordinates do not exclude a link."""
    side = lambda name, size, sketch: sketches.select(F.col("node").alias(name), F.col("n").alias(size), F.col("sketch").alias(sketch))
    return (pairs.join(side("x", "nx", "sx"), "x").join(side("p", "np", "sp"), "p")
            .select("x", "nx", "sx", "p", "np", "sp")
            .mapInArrow(lambda b: _may_link(b, share), "x long, nx long, p long, np long"))


def _meet(live: DataFrame, share: int) -> DataFrame:
    """Members of regions against their pivots, by chunks of both, so that a pair that the coordinates exclude is never
    a row. Rows (x, nx, p, np) of pairs that may link, and rows (region, p, least) with a lower bound of the open
    members' distances to a pivot."""
    size = live.groupBy("region").agg(F.count("*").alias("m"), F.sum(F.col("pivot").cast("long")).alias("k"))
    packed = lambda rows, count: (rows.join(size, "region")
                                  .groupBy("region", F.pmod(F.xxhash64("node", F.lit(9)), F.ceil(F.col(count) / CHUNK)).alias("chunk"))
                                  .agg(F.collect_list(F.struct("node", "n", "label", "open", "sketch")).alias(count)).drop("chunk"))
    return packed(live, "m").join(packed(live.where("pivot"), "k"), "region").select("region", "m", "k").mapInArrow(
        lambda b: _meet_chunks(b, share), "region long, x long, nx long, p long, np long, least double")


def _meet_chunks(batches, share: int):
    for batch in batches:
        for row in range(batch.num_rows):  # one pair of chunks at a time as Python objects
            region, members, pivots = (batch.column(i).slice(row, 1).to_pylist()[0] for i in range(3))
            least = np.full(len(pivots), 1.0)
            pairs = []
            for a, xs in _by_width(members):
                for b, ps in _by_width(pivots):
                    w = min(a.shape[1], b.shape[1])
                    x, p = _folded(a, w), _folded(b, w)
                    n = np.array([members[i]["n"] for i in xs])[:, None] + np.array([pivots[j]["n"] for j in ps])[None, :]
                    apart = np.empty(n.shape, np.int64)
                    for j in range(len(ps)):
                        apart[:, j] = np.bitwise_count(x ^ p[j]).sum(axis=1, dtype=np.int64)
                    bound = 2.0 * apart / (n + apart)  # similarity is at most (n - apart) / (n + apart)
                    is_open = np.array([members[i]["open"] for i in xs])
                    for j, q in enumerate(ps):
                        others = is_open & np.array([members[i]["node"] != pivots[q]["node"] for i in xs])
                        if others.any():
                            least[q] = min(least[q], float(bound[others, j].min()))
                    for i, j in zip(*np.nonzero(apart * (100 + share) <= n * (100 - share))):
                        u, v = members[xs[i]], pivots[ps[j]]
                        if u["label"] != v["label"] and min(u["n"], v["n"]) * 100 >= max(u["n"], v["n"]) * share:
                            u, v = (u, v) if u["node"] < v["node"] else (v, u)
                            pairs.append((u["node"], u["n"], v["node"], v["n"]))
            rows = [(None, *pair, None) for pair in pairs] + [(region, None, None, q["node"], None, float(d)) for q, d in zip(pivots, least)]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                             ["region", "x", "nx", "p", "np", "least"])
    bl.release()


def _by_width(items: list[dict]):
    """Coordinates of the items with equally fine divisions, and their places."""
    widths: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        widths.setdefault(len(item["sketch"]), []).append(i)
    for w, at in widths.items():
        yield np.frombuffer(b"".join(items[i]["sketch"] for i in at), np.uint8).reshape(len(at), w), at


def _measure(docs, rows, maybe, width, share, broadcast_bytes, store) -> DataFrame:
    """(x, p, linked, d) of pairs (x, nx, p, np), from their sets. Only the texts of these are read again."""
    wanted = store.keep(maybe.select(F.col("x").alias("node")).union(maybe.select("p")).distinct())
    small = wanted.count() * 24 <= broadcast_bytes
    holders = rows.select("node", "doc_id").join(F.broadcast(wanted) if small else wanted, "node")
    holders = holders.groupBy("node").agg(F.min(F.struct("doc_id")).alias("d")).select(F.col("d.doc_id").alias("k")).distinct()
    some = docs.join(F.broadcast(holders) if small else holders, F.col("k").eqNullSafe(F.col("doc_id")), "left_semi").select("text")
    sets = store.keep(some.mapInArrow(lambda b: _set_rows(b, width, 0), "node long, shingles binary").join(wanted, "node")
                      .groupBy("node").agg(F.first("shingles").alias("shingles")))
    found = (maybe.join(sets.select(F.col("node").alias("x"), F.col("shingles").alias("a")), "x")
             .join(sets.select(F.col("node").alias("p"), F.col("shingles").alias("b")), "p")
             .select("x", "p", "a", "b", "nx", "np"))
    return store.keep(found.mapInArrow(_distances, "x long, p long, common long, nx long, np long")
                      .withColumn("all", F.col("nx") + F.col("np") - F.col("common"))
                      .select("x", "p", (F.col("common") * 100 >= F.col("all") * share).alias("linked"),
                              (1 - F.col("common") / F.col("all")).alias("d")))


def _next_regions(live, measured, reach, labels, store) -> DataFrame:
    """What one level leaves of the regions in which not all members are known to be connected: the open members, and
    of the closed ones those that no pivot they are linked to proves to be out of reach of every open member."""
    rest = _open(_labelled(live.where("not pivot").select("region", "node", "n"), labels), store)
    both = measured.where("linked").select(F.col("x").alias("node"), "p", "d")
    both = both.unionAll(measured.where("linked").select(F.col("p").alias("node"), F.col("x").alias("p"), "d"))
    # One row a member: its near pivots and the region's reaches meet as arrays, not pair by pair.
    farthest = reach.groupBy("p").agg(F.max("reach").alias("far"))
    near = both.join(farthest, "p").where("d < far").groupBy("node").agg(F.collect_list(F.struct("p", "d")).alias("near"))
    reaches = reach.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("p", "reach"))).alias("reaches"))
    out = (rest.where("not open").join(near, "node").join(reaches, "region")
           .where(F.exists("near", lambda pivot: pivot["d"] < F.col("reaches")[pivot["p"]])).select("region", "node"))
    return rest.where("open").unionAll(rest.where("not open").join(out, ["region", "node"], "left_anti")
                                       .select("region", "node", "n", "label", "open"))
