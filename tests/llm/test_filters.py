"""Line dedup, decontamination and quality rules against plain Python, and their defined cases."""

import brute
import pytest
from brute import docs_rows, docs_table  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from starfold.llm.decontam import Index, contamination, drop_contaminated, text_key
from starfold.llm.line_dedup import dedup_lines
from starfold.llm.quality import RULES, estimate, features, fit, judge, quality_filter

LONG = "This line is long enough to be counted as a key, Number "
DOCS = [(i, f"{LONG}1\nown line {i} of this one document only, long as well\n\t {LONG.upper()}1 ") for i in range(1, 7)]
DOCS += [(10, None), (11, ""), (12, "\n"), (13, f"{LONG}1\n{LONG}1\n"), (None, f"x\n{LONG}1\n"), (14, "short\nshort"), (14, f"{LONG}1"), (15, "é" * 45 + "\nÉ" + "é" * 44)]
DOCS += [(20 + i, "\r" + "Ä" * 40 + " A") for i in range(5)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_line_dedup(spark):
    extra = frame(spark, DOCS).withColumns({"n_lines": F.lit("x"), "pos": F.lit(1), "row": F.lit(2), "drop": F.lit(3), "k": F.lit(4)})
    got = sorted(((r["doc_id"] or -1, r["text"], r["n_lines"], r["n_dropped"], r["pos"], r["row"]) for r in dedup_lines(extra).collect()), key=repr)
    want = sorted(((i or -1, t, n, d, 1, 2) for i, t, n, d in brute.line_dedup(DOCS)), key=repr)
    assert got == want
    assert any(d for *_, d, _, _ in want)


def test_line_dedup_of_a_very_long_text_and_of_nothing(spark):
    rows = [(i, "\n".join(f"{LONG}{k}" for k in range(3000))) for i in range(5)]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in dedup_lines(frame(spark, rows)).collect()}
    assert got[4][1] == 0 and got[4][2] == rows[4][1]
    assert all(got[i] == (3000, 3000, "") for i in range(4))
    assert dedup_lines(frame(spark, [])).collect() == []


ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "one Two three"), (3, None), (4, ""), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
         (1, "rho sigma tau"), (None, "omega omega omega"), (6, "lonely"), (7, "one two three")]
TEXTS = [(1, "x alpha, beta GAMMA delta epsilon zeta eta theta iota kappa lambda y"), (2, "one two one two three three"), (3, None), (4, "..."), (5, "alpha beta gamma delta epsilon zeta eta theta iota KAPPÄ"),
         (6, "omega omega omega omega"), (7, "lonely x LONELY"), (1, "rho-sigma tau"), (8, "one two one two three three"), (None, "one two three"), (9, "w " * 30_000 + "one two three")]


def test_contamination(spark):
    docs = frame(spark, TEXTS).withColumns({"t": F.lit("t"), "places": F.lit(0), "contaminated": F.lit("?")})
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], sorted(map(str, r["items"])), r["n_items"], r["contaminated"], r["t"]) for r in contamination(docs, frame(spark, ITEMS, "item_id long, text string")).collect())
    assert got == sorted((str(i), n, h, x, len(x), h > 0, "t") for i, n, h, x in brute.contamination(TEXTS, ITEMS))
    left = drop_contaminated(docs, frame(spark, ITEMS, "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]


def test_contamination_of_empty_tables(spark):
    none, items = frame(spark, []), frame(spark, ITEMS, "item_id long, text string")
    assert contamination(none, items).collect() == []
    assert not any(r["contaminated"] for r in contamination(frame(spark, TEXTS), none.withColumnRenamed("doc_id", "item_id")).collect())


def test_proximity(spark):
    items = frame(spark, [(1, "red fox jumps")], "item_id long, text string")
    docs = frame(spark, [(1, "red fox jumps"), (2, "red quick fox jumps"), (3, "fox"), (4, "jumps red red red red red red fox")])
    index = Index(docs, items)
    assert index.near(0).select("k1").distinct().count() <= index.near(1).select("k1").distinct().count()
    assert index.phrases().count() == 1


def test_contamination_of_the_table(spark, docs_table, docs_rows):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute.contamination(docs_rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    got = contamination(docs_table, items).select("doc_id", "n_words", "n_hit", F.array_sort(F.transform("items", lambda x: x.cast("string")))).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_quality_numbers(spark, docs_rows):
    rows = docs_rows + [(-1, None), (-2, ""), (-3, "a b"), (-4, "a b c a b c\n\n \na b c a b c"), (-5, "x\x0by\x0cz " * 3), (-6, "a a a a"), (-7, " \n\n "), (-8, "no ends # at & all " * 4000)]
    scored = features(frame(spark, rows))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ends"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in scored.select("row.doc_id", *names).collect()}
    assert got == {i: tuple(brute.numbers(t)[n] for n in names) for i, t in rows}


def test_quality_verdicts(spark, docs_table, docs_rows):
    scored = features(docs_table)
    got = {r["doc_id"]: r["kept"] for r in judge(scored, fit(scored)).select("row.doc_id", "kept").collect()}
    assert got == dict(zip((i for i, _ in docs_rows), brute.quality(docs_rows), strict=True))
    left = quality_filter(docs_table.withColumn("kept", F.lit("own")).withColumn("w", F.lit(1)))
    assert left.columns == [*docs_table.columns, "kept", "w"]
    assert {r["doc_id"] for r in left.collect()} == {i for i, k in got.items() if k}


def test_quality_of_nothing(spark):
    none = frame(spark, [])
    assert quality_filter(none).collect() == []
    assert estimate({}).prior == pytest.approx(2 / 3)


def test_estimation_finds_the_accuracies():
    """Votes drawn with known accuracies: a rule that is often wrong gets less weight than one that is mostly right."""
    import random

    draw, counts = random.Random(7), {}
    right = [0.95, 0.9, 0.9, 0.85, 0.65, 0.9, 0.9]
    for _ in range(20_000):
        good = 1 if draw.random() < 0.8 else -1
        votes = tuple(0 if draw.random() < 0.2 else good if draw.random() < p else -good for p in right)
        counts[votes] = counts.get(votes, 0) + 1
    model = estimate(counts)
    assert model.prior == pytest.approx(0.8, abs=0.02)
    assert model.good[RULES[4]][1] == pytest.approx(0.8 * 0.65, abs=0.03)
    assert model.bad[RULES[0]][-1] == pytest.approx(0.8 * 0.95, abs=0.03)


def test_labels_agree(spark, docs_table):
    """Rejected documents are those labelled as bad, beside what the base rules reject."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    scored = features(docs)
    rows = [r for r in judge(scored, fit(scored)).select("row.doc_id", "base_failed", "kept").collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(r["kept"] == bool(labels[r["doc_id"]]) for r in rows) >= 0.99 * len(rows)


def test_proximity_takes_all_words(spark):
    """Proximity matches against a search of all places: each word of a window has to stand near its own place."""
    import random

    draw = random.Random(5)
    item = [f"w{i}" for i in range(10)]
    texts = [" ".join(draw.choices(item, k=30)) for _ in range(20)] + ["w0 w1 " + "x " * 8, "a " + " ".join(item), " ".join(item[:4] + ["x"] + item[4:]), " ".join(item[:4] + item[5:3:-1] + item[6:])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    index = Index(docs, spark.createDataFrame([(1, " ".join(item)), (2, "w3 w5 w4")], "item_id long, text string"))
    wins = index.windows.collect()
    for slop in (0, 1, 2):
        want = set()
        for t in texts:
            w = t.split()
            for r in wins:
                for at in (i for i, x in enumerate(w) if x == r["win"][r["a_at"]]):
                    start = at - r["a_at"]
                    if all(x in w[max(0, start + i - slop) : max(0, start + i + slop + 1)] for i, x in enumerate(r["win"])):
                        want.add((t, start, tuple(r["win"])))
        keys = {(r["k1"], r["k2"]): r["t"] for r in index.texts.select("t", *text_key()).collect()}
        name = {tuple(r["wid"]): tuple(r["win"]) for r in wins}
        got = {(keys[r["k1"], r["k2"]], r["start"], name[tuple(r["wid"])]) for r in index.near(slop).collect()}
        assert got == want and want
