"""N-gram join, components and sharding against plain Python, and their defined cases."""

import random

import brute
import pytest
from brute import docs_rows, docs_table  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from starfold.llm import ngram_join
from starfold.llm.components import components
from starfold.llm.ngram_join import classes, depth_for, drop_near_duplicates
from starfold.llm.sharding import BestFit, Rooms, pack, shard_documents


def near_copies(n, seed=3, words=60, changed=1):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(changed):
            w[draw.randrange(words)] = f"z{draw.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def rows():
    out = [(100 + i, t) for i, t in enumerate(near_copies(40))] + [(200 + i, t) for i, t in enumerate(near_copies(30, seed=4, changed=2))]
    out += [(300 + i, "the very same text in many documents of the table here") for i in range(20)]
    out += [(1, None), (2, ""), (3, "..."), (4, "one"), (5, "ONE!"), (6, "one two"), (7, "a b c d e"), (8, "A b, c d e"), (9, "a b c d e f")]
    return out


@pytest.mark.parametrize("block", [512, 8])
def test_classes(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    docs = spark.createDataFrame(rows(), "doc_id long, text string").withColumn("names", F.lit(1))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in classes(docs).collect()}
    assert got == brute.classes(rows())


def test_classes_of_the_table(spark, docs_table, docs_rows):
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in classes(docs_table).collect()} == brute.classes(docs_rows)


def test_repeated_rows_null_ids_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (3, "x")], "doc_id long, text string").withColumns({"row": F.lit(1), "gone": F.lit(2), "class_id": F.lit(3)})
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 1, 3]
    assert classes(docs.limit(0)).collect() == [] and drop_near_duplicates(docs.limit(0)).collect() == []


def test_depth_reaches_the_recall():
    depth = depth_for(0.8, 0.999, trees=20, deepest=8)
    assert 1 - (1 - 0.8**depth) ** 20 >= 0.999 > 1 - (1 - 0.8 ** (depth + 1)) ** 20


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, x) for x in range(5001, 5100)] + [(7, 7), (None, 3)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = sorted((find(u), find(v)))
            top[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in top}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_best_fit_takes_the_tightest_bin():
    draw = random.Random(1)
    sizes = sorted((draw.randrange(1, 50) for _ in range(3000)), reverse=True)
    fit, rooms = BestFit(100), []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        number = fit.put(size)
        if fits:
            assert rooms[number] == min(fits)[0]
        else:
            assert number == len(rooms)
            rooms.append(100)
        rooms[number] -= size
    tree = Rooms()
    assert tree.take(1) is None


def test_pack_is_nearly_even():
    draw = random.Random(2)
    things = [(draw.randrange(1, 1000), i) for i in range(2000)]
    where = pack(things, 8)
    loads = [sum(s for s, i in things if where[i] == k) for k in range(8)]
    assert max(loads) - min(loads) <= 1000
    assert pack([], 8) == {} and pack([(5, "x")], 8) == {"x": 0}


def test_shards(spark, docs_table):
    hot = docs_table.select("doc_id", "text").union(spark.range(1000, 1150).select("id", F.lit("the same text " * 40)))
    hot = hot.union(spark.createDataFrame([(2000, None), (2001, ""), (None, "x"), (5, "again"), (5, "again")], "doc_id long, text string")).withColumns({"slot": F.lit("s"), "run": F.lit(1), "h1": F.lit(2)})
    got = shard_documents(hot).collect()
    assert len(got) == hot.count()
    shards, groups = {}, {}
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 1 and r["run"] == 1
        shards.setdefault(r["shard"], []).append(r)
        groups.setdefault(r["text"] or "", set()).add(r["shard"])
    assert sorted(shards) == list(range(8))
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    total, largest = sum(r["size"] for r in got), max(sum(r["size"] for r in got if (r["text"] or "") == t) for t in groups)
    assert max(sum(r["size"] for r in s) for s in shards.values()) <= max(largest, 1.05 * total / 8)
    assert shard_documents(hot.limit(0)).collect() == []


def test_texts_without_a_link_shorten_their_prefixes(spark):
    """Isolated pairs just above the threshold: few trees miss some at the first depth and find them with shorter prefixes."""
    import random

    from starfold.llm.ngram_join import classes, depth_for

    draw = random.Random(7)
    rows = []
    for i in range(150):
        w = [f"w{draw.randrange(10**9)}" for _ in range(94)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:-9], *(f"x{i}y{j}" for j in range(9))]))]  # 81 of 99 shingles
    assert (depth_for(0.8, 0.9, 8), depth_for(0.8, 0.99, 8)) == (6, 3)
    got = classes(spark.createDataFrame(rows, "doc_id long, text string"), recall=0.9, trees=8, sure=0.99).collect()
    assert len(got) == 300
    linked = [r for r in got if r["n_links"] == 1 and r["class_id"] == r["doc_id"] // 2 * 2]
    lost = [r for r in got if r["n_links"] == 0]
    assert len(linked) + len(lost) == 300 and len(lost) <= 4


def jobs(spark, name, work):
    """The number of Spark jobs that the work ran."""
    spark.sparkContext.setJobGroup(name, name)
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_few_jobs(spark):
    """Each job costs a cluster's start of all its tasks, however small the table: the join took 147 for the rows of sf0.01."""
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 400)], "u long, v long")
    assert jobs(spark, "components", lambda: components(edges).collect()) <= 12
    assert jobs(spark, "classes", lambda: classes(docs).collect()) <= 60


@pytest.mark.parametrize(("forest", "sent"), [(500_000, 100_000), (50, 100_000), (50, 0)])
def test_components_of_many_forests(spark, monkeypatch, forest, sent):
    """Hubs with the smallest and the largest id, a long chain in any order, text ids: in one forest a task or in many, moved
    roots sent or joined."""
    from starfold.llm import components as module

    monkeypatch.setattr(module, "FOREST", forest)
    monkeypatch.setattr(module, "SENT", sent)
    draw = random.Random(9)
    names = [f"n{i:05d}" for i in range(2000)]
    chain = draw.sample(names[:800], 800)
    edges = list(zip(chain, chain[1:], strict=False)) + [(names[800], x) for x in names[801:1400]] + [(names[1999], x) for x in names[1400:1999]]
    draw.shuffle(edges)
    frame = spark.createDataFrame(edges + edges[:500], "u string, v string").repartition(8)
    got = components(frame).collect()
    assert len(got) == 2000
    assert {r["node"]: r["component"] for r in got} == {x: names[0 if i < 800 else 800 if i < 1400 else 1400] for i, x in enumerate(names)}
