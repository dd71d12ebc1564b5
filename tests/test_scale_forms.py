"""Group limits, hot keys in stored tables, delta iteration, listing chains, vectors parsed once: results and plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.functions import vectors as V
from lakeops.operators import hierarchy, listing, lookup, ordering
from lakeops.operators.vector_job import vector_results
from lakeops.sources import lake


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- first n per group ---------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 3, 2000])
def test_first_n_per_group(spark, n):
    rng = random.Random(n)
    data = [(rng.choice([0, 0, 0, 1, 2, None]), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, v int, id int").repartition(6)
    got = ordering.first_n_per_group(df, ["g"], ["v", F.col("id").desc()], n)
    expected = {(g, v, i, k + 1) for g0 in (0, 1, 2, None) for k, (g, v, i) in
                enumerate(sorted((r for r in data if r[0] == g0), key=lambda r: (r[1], -r[2]))[:n])}
    if n < 1000:
        text = plan(got)
        assert text.count("WindowGroupLimit") == 2 and "Partial" in text and "rangepartitioning" not in text
    assert {tuple(r) for r in got.collect()} == expected


# --- ordinal from bounds -------------------------------------------------------------------------

def sort_key(value, down):
    """Nulls first rising, last falling; NaN is the largest number."""
    if value is None:
        return (0, 0, 0)
    big = isinstance(value, float) and value != value
    number = value if isinstance(value, (int, float)) else [ord(c) for c in value] + [-1]
    if down:
        return (-1, -int(big), 0 if big else -number if isinstance(number, (int, float)) else [-x for x in number])
    return (1, int(big), 0 if big else number)


ORDER_ROWS = [(random.Random(i).choice([None, 0.5, -0.5, float("nan"), float(i % 7), 2.0, 2.0, 2.0]), random.Random(i + 999).choice([None, "a", "b", "ab", "é", ""]), i) for i in range(700)]


@pytest.mark.parametrize("order", [["v", "s", "id"], [("v", "desc"), "s", ("id", "desc")], ["s", ("v", "desc"), "id"], [("s", "desc"), "id"]])
@pytest.mark.parametrize("bounds", ["drawn", "none", "all", "few rows", "outside"])
def test_ordinal_is_exact_with_any_bounds(spark, monkeypatch, order, bounds):
    df = spark.createDataFrame(ORDER_ROWS, "v double, s string, id int").repartition(5)
    named = ordering._named(order)
    at = {"v": 0, "s": 1, "id": 2}
    expected = [r[2] for r in sorted(ORDER_ROWS, key=lambda r: [sort_key(r[at[n]], down) for n, down in named])]
    of = lambda r: tuple(r[at[n]] for n, _ in named)
    place = {i: k for k, i in enumerate(expected)}
    given = {"drawn": None, "none": [], "all": [of(r) for r in sorted(ORDER_ROWS, key=lambda r: place[r[2]])][::7], "few rows": [of(ORDER_ROWS[expected[400]])],
             "outside": [of((None, None, -5)), of((None, None, 10_000))][:1]}[bounds]
    out = ordering.with_ordinal(df, order, "pos", bounds=given)
    assert "rangepartitioning" not in plan(out)
    assert [r.id for r in sorted(out.collect(), key=lambda r: r.pos)] == expected
    assert sorted(r.pos for r in out.collect()) == list(range(1, 701))


def test_ordinal_pieces_are_even(spark):
    """A column that a third of the rows share does not make one piece: the whole order is cut."""
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    bounds = ordering.draw_bounds(df, [("k", False), ("id", False)], 32)
    assert len(bounds) == 31
    sizes = [r["count"] for r in df.groupBy(ordering.piece_of(df, [("k", False), ("id", False)], bounds)).count().collect()]
    assert len(sizes) == 32 and max(sizes) < 4 * 20_000 / 32
    assert ordering.draw_bounds(df.limit(0), [("k", False)], 8) == [] and ordering.with_ordinal(df.limit(0), ["k", "id"]).count() == 0
    assert len(ordering.draw_bounds(df.withColumn("k", F.lit(1)), [("k", False)], 8)) == 1
    with pytest.raises(ValueError):
        ordering.with_ordinal(df, [("k", "up")])


# --- hot keys in stored tables ---------------------------------------------------------------------

def test_split_payload_join(spark, tmp_path):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS split_t")
    payload = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("pk"), (9000 - F.col("id")).alias("v"))
    keys = spark.range(700).select(F.when(F.col("id") < 100, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("n"))
    hot = lake.hot_keys(payload, ["pk"], 0.1)
    assert hot == [payload.where("pk = 'hot'").select(F.xxhash64("pk")).first()[0]]
    assert lake.hot_keys(payload.limit(0), ["pk"], 0.1) == []
    for bad in (0, 1e-6, 1):
        with pytest.raises(ValueError):
            lake.hot_keys(payload, ["pk"], bad)
    stored = [lake.save_split(df, f"split_t.{name}", by, 4, hot, str(tmp_path / name)) for df, name, by in ((keys, "k", ["k"]), (payload.repartition(5), "p", ["pk"]))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = lookup.key_payload_join(stored[0].rest, stored[1].rest, ["k"], ["pk"])
        assert "Exchange hashpartitioning" not in plan(rest)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(stored[1].hot.inputFiles()) >= 5 and stored[1].hot.count() == 3000 and stored[1].rest.where("pk = 'hot'").count() == 0
    got = lookup.split_payload_join(*stored, ["k"], ["pk"])
    expected = lookup.key_payload_join(keys, payload, ["k"], ["pk"])
    assert sorted(map(tuple, got.select(*expected.columns).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    with pytest.raises(ValueError):
        lookup.split_payload_join(stored[0], lake.SplitTable(payload, payload, ()), ["k"], ["pk"])
    spark.sql("DROP NAMESPACE split_t CASCADE")


# --- hierarchy: constant work per level ------------------------------------------------------------

def test_long_chain_reads_one_bucket_and_few_stores(spark, monkeypatch):
    """Each level of a chain looks into one hash partition of few stores."""
    looked = []
    of_buckets = hierarchy._Found.of_buckets

    def watched(self, buckets):
        out = of_buckets(self, buckets)
        files = sum(len(self._read(p).where(F.col("_bucket").isin(buckets)).inputFiles()) for p, _ in self.stores[:1])
        looked.append((len(buckets), len(self.stores), files, len(plan(out))))
        return out

    monkeypatch.setattr(hierarchy._Found, "of_buckets", watched)
    n = 36
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(n, 0), (5, None), (7, 3)], "parent int, child int")
    out = hierarchy.expand_hierarchy(edges, 0)
    assert {(r.node, r.depth) for r in out.collect()} == {(i, i) for i in range(1, n + 1)} | {(0, n + 1)}
    assert max(b for b, *_ in looked) <= 2 and max(s for _, s, *_ in looked) <= 8
    assert max(p for *_, p in looked) < 8 * min(p for *_, p in looked)


# --- listings ----------------------------------------------------------------------------------------

def follow(rows):
    """Status of one listing's pages (page, next, first) by walking."""
    pages = {}
    for p, n, f in rows:
        old = pages.get(p)
        pages[p] = (n if old is None or (n is not None and (old[0] is None or n < old[0])) else old[0], bool(f) or bool(old and old[1]))
    firsts = [p for p, (_, f) in pages.items() if f]
    gaps = [p for p, (n, _) in pages.items() if n is not None and n not in pages]

    def walk(p):
        seen = []
        while p in pages and p not in seen:
            seen.append(p)
            p = pages[p][0]
        return len(seen), p in seen

    looping = sum(walk(p)[1] for p in pages)
    reached = max([walk(p)[0] for p in firsts if not walk(p)[1]], default=0)
    faults = [int(not firsts), len(rows) - len(pages), len(gaps), looping, len(pages) - reached]
    return (len(pages), *faults, next((name for (name, _), n in zip(listing.FAULTS, faults) if n), listing.COMPLETE))


def test_listings(spark):
    rng = random.Random(2)
    cases = {"whole": [(i, i + 1 if i < 40 else None, i == 1) for i in range(1, 41)], "one": [(1, None, True)], "headless": [(2, 3, False), (3, None, False)],
             "twice": [(1, 2, True), (2, None, False), (2, None, False)], "gap": [(1, 2, True), (2, 3, False), (4, None, False)], "self": [(1, 1, True)],
             "loop": [(1, 2, True), (2, 3, False), (3, 1, False)], "tail loop": [(1, 2, True), (2, 3, False), (3, 2, False)],
             "second chain": [(1, None, True), (7, 8, False), (8, None, False)], "meet": [(1, 3, True), (2, 3, False), (3, None, False)]}
    for k in range(25):
        n = rng.randint(1, 9)
        cases[f"r{k}"] = [(i, rng.choice([None, i + 1, i + 1, i + 1, rng.randint(1, 10)]), i == 1) for i in range(1, n + 1) if rng.random() < 0.9] or [(1, None, True)]
    df = spark.createDataFrame([(name, *r) for name, rows in cases.items() for r in rows] + [(None, 1, None, True), ("one", None, 1, False)],
                               "listing string, page int, next int, first boolean")
    got = {r.listing: tuple(r)[1:] for r in listing.check_listings(df, "listing", "page", "next", F.col("first")).collect()}
    assert got == {name: follow(rows) for name, rows in cases.items()}
    assert listing.check_listings(df.limit(0), "listing", "page", "next", F.col("first")).collect() == []


# --- vectors -------------------------------------------------------------------------------------------

def test_vectors_are_parsed_once(spark):
    keys = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, 1)], "k int, id int")
    payload = spark.createDataFrame([(1, "1,2", "3,4", "0,1"), (2, "1,x", "1,1", "5"), (1, "9,9", "9,9", "9,9")], "pk int, a string, b string, c string")
    vectors = [V.parse_vector_text(c, 2) for c in "abc"]
    out = vector_results(keys, payload, ["id"], ["pk"], vectors, 2, 2, ["a", "b", "c"])
    assert [tuple(r) for r in out.orderBy("k").collect()] == [
        (1, 1, "Success", 9.0, 5.0), (2, 2, "Error: expected 2 values in column 3, found 1", None, None), (3, 9, "No data", None, None), (4, 1, "Success", 9.0, 5.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 3


def test_byte_vectors(spark):
    v = [[1.5, -2.0], [], None, [float("inf")], [3.0] * 700]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v array<float>").coalesce(1)
    raw = df.select("i", V.float32_to_bytes("v").alias("b")).orderBy("i")
    assert [None if r.b is None else bytes(r.b) for r in raw.collect()] == [None if x is None else np.array(x, "<f4").tobytes() for x in v]
    assert [r.v for r in raw.select("i", V.float32_from_bytes("b").alias("v")).orderBy("i").collect()] == v
    odd = spark.createDataFrame([(0, b"abc"), (1, b"\0\0\0\0"), (2, None), (3, b"")], "i int, b binary").coalesce(1)
    assert [r.v for r in odd.select("i", V.float32_from_bytes("b").alias("v")).orderBy("i").collect()] == [None, [0.0], None, []]
