"""Keyword tables, resumable calls, headers, kept-up state and sketches."""

import gzip
import random
import time

import pytest
from pyspark.sql import functions as F

from catalogops.functions import text as T
from catalogops.operators import dedup, hierarchy, inference, keywords, quality, upkeep
from catalogops.plans import curate, queries_rules, registry
from catalogops.sources import delimited, stages

# --- keywords

TEXTS = [
    None, "", " ", "Red Bolt", "redbolt", "the RED", "a red b", "red", "İstanbul kebab", "ends with bolt", "bolt ends", "日本語 テスト",
    "x" * 3000 + " red", "\U0001f600 bolt",
]
WORDS = ["red", "bolt", "ed b", "日本", "kebab", "missing", "\U0001f600", "x" * 200, "s"]


@pytest.mark.parametrize("match", sorted(T.MATCHERS))
def test_table_of_keywords_equals_the_loop(spark, match):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 2)], "id long, t string")
    table = spark.createDataFrame([(w,) for w in WORDS + WORDS[:3] + [None]], "keyword string")
    got = {(r.text, r.keyword) for r in keywords.hits(df, "t", table, match).collect()}
    expected = set()
    for w in WORDS:
        expected |= {(r.t, w) for r in df.where(T.MATCHERS[match]("t", [w])).select("t").distinct().collect()}
    assert got == expected and got
    marked = keywords.mark(df.withColumn("hit", F.lit("x")), "t", table, "hit", match).collect()
    assert len(marked) == len(TEXTS) * 2
    assert all(r.hit == (r.t in {t for t, _ in expected}) for r in marked)


def test_first_priority_labels(spark):
    df = spark.createDataFrame([(1, "red bolt"), (2, "bolt"), (3, "nut"), (4, None)], "id long, t string")
    table = spark.createDataFrame([("bolt", 2, "b"), ("red", 1, "r"), ("olt", 2, "a")], "keyword string, priority int, label string")
    got = {r.id: r.label for r in keywords.classify(df, "t", table, "none", "label").collect()}
    assert got == {1: "r", 2: "a", 3: "none", 4: "none"}
    assert keywords.hits(df.limit(0), "t", table).count() == 0
    assert keywords.hits(df, "t", table.limit(0)).count() == 0


def test_long_texts_are_not_copied_for_each_keyword(spark, tmp_path):
    words = [f"w{i:04d}x" for i in range(400)]
    df = spark.createDataFrame([(i, f"{i} " + " ".join(words) + " y" * 20_000) for i in range(40)], "id long, t string")
    table = spark.createDataFrame([(w, i, w) for i, w in enumerate(words)], "keyword string, priority int, label string")
    held = keywords.hits(df, "t", table, digests=True)
    assert held.columns == ["text_digest", "keyword"] and held.count() == 40 * 400
    # What a substring carries between the tasks: 32 bytes for its text, whatever the text's length.
    for made in (held, keywords.classify(df, "t", table, "none", "out"), keywords.mark(df, "t", table, "out")):
        cut = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "MapInArrow" in line and "cut(" in line]
        assert cut and all("text_digest" in line.split("],")[0].split("cut(")[1] and "text#" not in line for line in cut)
    assert {r.out for r in keywords.classify(df, "t", table, "none", "out").collect()} == {words[0]}


def test_bad_keywords_are_refused(spark):
    df = spark.createDataFrame([("a",)], "t string")
    for bad in ("", "y" * 300):
        with pytest.raises(ValueError):
            keywords.hits(df, "t", spark.createDataFrame([(bad,)], "keyword string"))


def test_many_keywords_cost_little_more_than_few(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(6, 12)))
    listed = list({word() for _ in range(100_000)})
    spark.createDataFrame([(w,) for w in listed], "keyword string").write.parquet(str(tmp_path / "kw"))
    texts = [" ".join([word(), rng.choice(listed), word()]) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    table, seconds = spark.read.parquet(str(tmp_path / "kw")), {}
    for part in (table.limit(1000), table):
        start = time.perf_counter()
        found = keywords.hits(df, "t", part).count()
        seconds[part is table] = time.perf_counter() - start
    assert found >= 3000
    # A hundred times the keywords.
    assert seconds[True] < 5 * seconds[False] + 5
    sample = set(listed[:300])
    got = {(r.text, r.keyword) for r in keywords.hits(df, "t", table).where(F.col("keyword").isin(*sample)).collect()}
    assert got == {(t, w) for t in texts for w in sample if w in t}


# --- resumable calls

def test_a_killed_run_loses_one_portion(spark, tmp_path):
    log, calls = str(tmp_path / "log"), tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([(i, f"p{i % 90}") for i in range(120)] + [(500, None), (501, "bad")], "id long, prompt string")

    def maker(limit):
        def make():
            def model(prompts):
                out = []
                for p in prompts:
                    if p == "bad":
                        out.append(ValueError("refused"))
                        continue
                    with open(calls / p, "a") as f:
                        f.write("x")
                    if limit is not None and len(list(calls.iterdir())) > limit:
                        raise SystemExit("killed")
                    out.append(p.upper())
                return out

            return model

        return make

    def run(limit):
        return inference.infer_resumable(df, "prompt", maker(limit), ["id"], log, "m", commit_rows=10, batch=4)

    with pytest.raises(Exception):
        run(45).collect()
    filed = spark.read.parquet(log).count()
    assert 20 <= filed <= 45
    paid = {p.name: p.stat().st_size for p in calls.iterdir()}
    rows = {r.id: r for r in run(None).collect()}
    assert len(rows) == 122 and all(rows[i].reply == f"P{i % 90}" and rows[i].error is None for i in range(120))
    assert rows[500].error == "no prompt" and "refused" in rows[501].error and rows[501].reply is None
    # What was filed is not asked again.
    again = [n for n, size in paid.items() if (calls / n).stat().st_size > size]
    assert len(again) <= len(paid) - filed
    before = {p.name: p.stat().st_size for p in calls.iterdir()}
    assert run(None).where("reply IS NOT NULL").count() == 120
    assert {p.name: p.stat().st_size for p in calls.iterdir()} == before
    other = inference.infer_resumable(df.limit(0), "prompt", maker(None), ["id"], str(tmp_path / "none"))
    assert other.count() == 0


# --- headers

def test_headers_read_no_more_of_larger_files(spark, tmp_path):
    systems = spark._jvm.org.apache.hadoop.fs.FileSystem
    told = lambda: sum(s.getBytesRead() for s in systems.getAllStatistics())
    read = {}
    for name, lines in (("small", 10_000), ("large", 1_000_000)):
        folder = tmp_path / f"{name} files"
        folder.mkdir()
        for sep, k in ((",", 0), ("\t", 1)):
            row = sep.join(["some category", "some sub", "some product"]) + "\n"
            (folder / f"{k}.csv").write_text(sep.join(["Category", "Sub", "Product"]) + "\r\n" + row * lines)
        (folder / "empty.csv").write_text("")
        with gzip.open(folder / "z.csv.gz", "wt") as f:
            f.write("Category,Sub,Product" + "x" * 100_000)
        before = told()
        found = delimited.headers(spark, str(folder))
        read[name] = told() - before
        assert [(f.rsplit("/", 1)[1], line[:20]) for f, line in found] == [
            ("0.csv", "Category,Sub,Product"), ("1.csv", "Category\tSub\tProduct"), ("z.csv.gz", "Category,Sub,Product")]
        assert len(found[2][1]) == 100_020
    size = (folder / "0.csv").stat().st_size
    assert size > 30_000_000 and 0 < read["large"] <= read["small"] + 1000 < 1_000_000


def test_folder_with_a_space_is_read(spark, tmp_path):
    folder = tmp_path / "my files"
    folder.mkdir()
    (folder / "a b.csv").write_text("Category,Sub,Product\nc,s,p\n")
    assert [tuple(r) for r in delimited.read_delimited(spark, str(folder)).collect()] == [("c", "s", "p")]


# --- kept up to date

@pytest.mark.parametrize("seed", [1, 2])
def test_kept_up_equals_the_whole(spark, seed):
    rng = random.Random(seed)
    cell = lambda values: rng.choice(values)
    rows = [
        (i, cell(["A", "B", None]), cell(["long one", "short", "x", "yy", None]), cell(["Bolt", "bolt ", "nut", "gear", None, ""]))
        for i in range(300)
    ]
    schema = "row_id long, category string, subcategory string, product_category string"
    state = sizes = None
    seen = []
    while rows:
        n = rng.randrange(1, 120)
        batch, rows = rows[:n], rows[n:]
        seen += batch
        arrived = spark.createDataFrame(batch, schema)
        after = stages.stage(upkeep.kept_rows(state, arrived, ignore_case=True), "state")
        sizes = stages.stage(upkeep.kept_sizes(sizes, state, after, arrived, ignore_case=True), "sizes")
        state = after
        whole = dedup.priority(spark.createDataFrame(seen, schema), ignore_case=True)
        key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
        assert key(state) == key(whole)
        assert key(sizes) == key(hierarchy.group_sizes(whole))


# --- sketches, rollup, observed counts

def test_sketches_stay_within_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 2).alias("a"), (F.col("id") % 6).alias("b"), (F.col("id") % 50_000).alias("v"))
    parts = [quality.distinct_sketches(df.where(F.pmod("v", F.lit(3)) == k), ["a", "b"], "v") for k in range(3)]
    pairs = quality.merge_sketches(*parts, by=["a", "b"])
    for by in (["a", "b"], ["a"]):
        told = {tuple(r[c] for c in by): r.n_distinct for r in quality.estimates(quality.merge_sketches(pairs, by=by)).collect()}
        true = {tuple(r[c] for c in by): r.n for r in df.groupBy(*by).agg(F.count_distinct("v").alias("n")).collect()}
        assert told.keys() == true.keys()
        assert all(abs(told[k] - n) <= 4 * 1.04 / 64 * n for k, n in true.items())


def test_rollup_keeps_nulls_apart_from_sums(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("a", "x")], "category string, subcategory string")
    got = {(r.category, r.subcategory, r.level): (r.n, r.n_children, r.n_thin) for r in hierarchy.rollup(df, 2).collect()}
    assert got == {
        ("a", "x", 0): (2, 1, 0), ("a", None, 0): (1, 1, 1), (None, "x", 0): (1, 1, 1),
        ("a", None, 1): (3, 2, 1), (None, None, 1): (1, 1, 1), (None, None, 3): (4, 3, 2),
    }


def test_input_rows_are_counted_by_the_first_write(spark, sf, tmp_path, monkeypatch):
    rows, counted = registry.tax_dirty(spark, sf), []
    n, count = rows.count(), type(rows).count
    monkeypatch.setattr(type(rows), "count", lambda self: counted.append(1) if self is rows else count(self))

    def run():
        curate.curate(
            rows, queries_rules.demo_pack("correct"), queries_rules.demo_pack("validate"),
            lambda lists: lists.withColumn("reply", F.lit("none")), str(tmp_path / "job"), min_items=3, embed=lambda df, c: df.withColumn(
                "vector", F.array(F.col("row_id").cast("float"), F.lit(1.0).cast("float"))),
        )
        return spark.read.json(str(tmp_path / "job" / "metrics")).first()

    monkeypatch.setattr(curate.vectors, "knn", lambda df, *a: df.sparkSession.createDataFrame([], "id long, neighbour long, sim double, rank int"))
    for _ in range(2):
        metrics = run()
        assert metrics.input_rows == n and not counted
    assert metrics.input_file == ",".join(sorted(rows.inputFiles()))
