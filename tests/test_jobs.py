"""Sources, inference, canonical names, resumable steps, streaming, whole job."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from catalogops.operators import batching, canonical, inference
from catalogops.plans import curate, queries_rules, registry
from catalogops.sources import delimited, exchange, stages
from catalogops.streaming import ingest

COLUMNS = ["category", "subcategory", "product_category"]


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("sep", ["\t", ","])
def test_separator_and_aliases(spark, tmp_path, sep):
    head = sep.join([" Product Category", "Sub-Category ", "Main Cat", "note"])
    rows = [sep.join(r) for r in (["p1", "s1", "c1", ""], ["  ", "s", "c", ""], ["p3", "", "c", ""])]
    path = write(tmp_path / "in.csv", "\n".join([head, *rows]) + "\n")
    got = delimited.read_delimited(spark, path).collect()
    assert [tuple(r) for r in got] == [("c1", "s1", "p1")]


def test_quotes_na_tokens_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'category,subcategory,product\nA,"x, ""y""",NA\nB,s,"two\nlines"\n')
    got = delimited.read_delimited(spark, path, multiline=True).collect()
    assert [tuple(r) for r in got] == [("A", 'x, "y"', "NA"), ("B", "s", "two\nlines")]
    got = delimited.read_delimited(spark, path, na_tokens=["NA"], multiline=True).collect()
    assert [r.product_category for r in got] == ["two\nlines"]


@pytest.mark.parametrize("head", ["category,product", "category,product,product b", "category,cat,sub"])
def test_bad_headers_are_refused(spark, tmp_path, head):
    path = write(tmp_path / "bad.csv", head + "\na,b,c\n")
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, path)


def test_strict_single_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        write(tmp_path / name, "category,sub,product\na,b,c\n")
    assert delimited.read_delimited(spark, str(tmp_path)).count() == 2
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, str(tmp_path), strict_single=True)


def test_files_of_different_headers_and_malformed_rows(spark, tmp_path):
    write(tmp_path / "a.csv", "category,subcategory,product\nc1,s1,p1\n")
    write(tmp_path / "b.csv", "product\tcategory\tsubcategory\nName 2\tc2\ts2\nName 3\tc3\n")
    got = sorted(tuple(r) for r in delimited.read_delimited(spark, str(tmp_path)).collect())
    assert got == [("c1", "s1", "p1"), ("c2", "s2", "Name 2")]
    assert delimited.malformed_rows(spark, str(tmp_path)).count() == 0
    write(tmp_path / "c.csv", "category,subcategory,product\nc4,s4,p4,extra\nc5,s5,p5\n")
    assert [r.line for r in delimited.malformed_rows(spark, str(tmp_path)).collect()] == ["c4,s4,p4,extra"]
    with pytest.raises(Exception, match="more cells"):
        delimited.read_delimited(spark, str(tmp_path)).collect()


def test_batch_files_of_json_arrays(spark, tmp_path):
    def rec(p):
        return {"category": "c", "subcategory": None, "product_category": p}

    write(tmp_path / "batch_0002.json", json.dumps([rec("é"), rec("d")], indent=2))
    write(tmp_path / "batch_0001.json", json.dumps([rec("a")]))
    got = exchange.read_batch_files(spark, str(tmp_path), COLUMNS).orderBy("batch_id", "idx").collect()
    assert [(r.batch_id, r.idx, r.product_category) for r in got] == [(1, 0, "a"), (2, 0, "é"), (2, 1, "d")]


def test_cluster_map_file(spark, tmp_path):
    write(tmp_path / "clusters.json", json.dumps({"cluster_0000": ["a", "b"], "cluster_0001": ["c"]}, indent=2))
    got = exchange.read_cluster_map(spark, str(tmp_path / "clusters.json")).collect()
    assert sorted(map(tuple, got)) == [("cluster_0000", 0, "a"), ("cluster_0000", 1, "b"), ("cluster_0001", 0, "c")]


FIELDS = StructType([StructField("a", StringType()), StructField("n", IntegerType())])


def test_reply_shapes(spark):
    replies = [
        (1, '```json\n[{"a": "x", "n": 1}, {"a": "y"}]\n```'), (2, 'ok {"a": "z"} done'), (3, "7"),
        (4, ""), (5, '["p", "q"]'), (6, '{"other": 1}'), (7, "[]"), (8, None), (9, '[{"a": "x"}, 3]'),
    ]
    rows, dead = inference.reply_rows(spark.createDataFrame(replies, "id int, reply string"), FIELDS, ["id"])
    assert sorted((r.id, r.idx, r.a, r.n) for r in rows.collect()) == [
        (1, 0, "x", 1), (1, 1, "y", None), (2, 0, "z", None)
    ]
    assert sorted(r.id for r in dead.collect()) == [3, 4, 5, 6, 8, 9]
    with pytest.raises(RuntimeError):
        inference.require_complete(dead)
    inference.require_complete(dead.where("false"))


def test_model_failures_stay_visible(spark):
    def make():
        def model(prompts):
            if "boom" in prompts:
                raise RuntimeError("down")
            return [ValueError("bad") if p == "no" else p * 2 for p in prompts]

        return model

    df = spark.createDataFrame([(1, "a"), (2, "no"), (3, "b")], "id int, prompt string").coalesce(1)
    got = {r.id: (r.reply, r.error) for r in inference.infer(df, "prompt", make, ["id"]).collect()}
    assert got == {1: ("aa", None), 2: (None, "ValueError('bad')"), 3: ("bb", None)}
    big = spark.createDataFrame([(2**53 + 1, "a"), (None, "boom"), (7, "c")], "id long, prompt string").coalesce(1)
    got = {r.id: (r.reply, r.error) for r in inference.infer(big, "prompt", make, ["id"]).collect()}
    assert got == {2**53 + 1: ("aa", None), None: (None, "RuntimeError('down')"), 7: ("cc", None)}
    boom = df.select("id", F.lit("boom").alias("prompt"))
    assert all("down" in r.error for r in inference.infer(boom, "prompt", make, ["id"]).collect())


def test_prompts_hold_every_record_once(spark):
    df = spark.range(60).select("id", F.concat(F.lit('n "'), "id").alias("name"), F.lit(None).cast("string").alias("x"))
    out = inference.chunk_prompts(df, " Do it. \n", ["name", "x"], ["id"]).orderBy("batch_id").collect()
    assert [r.n for r in out] == [25, 25, 10]
    seen = []
    for r in out:
        head, body = r.prompt.split("\n\nINPUT:\n")
        assert head == "Do it."
        seen += json.loads(body)
    assert seen == [{"name": f'n "{i}', "x": None} for i in range(60)]


def test_failed_replies_merge_nothing(spark):
    rows = [
        ("c1", ["a", "b"], '{"canonical_name": "A", "merged": ["a"]}', None),
        ("c2", ["c", "d"], '{"canonical_name": "C"}', None), ("c3", ["e", "f"], "none of these", None),
        ("c4", ["g"], None, None), ("c5", ["h", "i"], '{"merged": ["h"]}', None), ("c6", ["j", "k"], None, "down"),
        ("c7", ["l", "m"], "[1, 2]", None),
    ]
    df = spark.createDataFrame(rows, "cluster_id string, members array<string>, reply string, error string")
    good, dead = canonical.synonym_replies(df)
    assert {r.cluster_id: (r.canonical_name, r.merged) for r in good.collect()} == {
        "c1": ("A", ["a"]), "c2": ("C", ["c", "d"]), "c5": ("h", ["h", "i"]), "c7": ("l", ["l", "m"])
    }
    assert {r.cluster_id: r.failure for r in dead.collect()} == {"c3": "not JSON", "c4": "no reply", "c6": "down"}


def test_last_cluster_wins_and_map_is_one_hop(spark):
    rows = [("c1", "X", ["a", "b"]), ("c2", "Y", ["b", "c"]), ("c3", "a", ["Y"])]
    replies = spark.createDataFrame(rows, "cluster_id string, canonical_name string, merged array<string>")
    mapping = canonical.synonym_map(replies)
    assert {r.member: r.canonical for r in mapping.collect()} == {"a": "X", "b": "Y", "c": "Y", "Y": "a"}
    assert canonical.changes(mapping).first()[0] == 4
    df = spark.createDataFrame([("c",), ("Y",), ("q",), (None,)], "p string")
    assert [r.p for r in canonical.apply_map(df, mapping, "p").collect()] == ["Y", "a", "q", None]


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("Paint Roller", "Paint Rollers", True), ("6-Pack Paint Rollers", "9-Pack Paint Rollers", False),
        ("A And B", "A & B", True), ("Colour Box", "Color Boxes", True), ("4-Wheel Carts", "6-Wheel Carts", False),
        ("Garden Hoses & Nozzle Kits", "Garden Hoses And Nozzle Kits", True), ("Batteries", "Battery", True),
        ("Glass", "Glas", False), ("Bench-Vises", "bench vise", True), ("PVC Pipes", "Polyvinyl Chloride Pipe", True),
        ("Sandals", "Sand", False), ("Brand", "Br&", False), ("Lens", "Len", False), ("Cookies", "Cookie", True),
        ("-20C Freezer", "20C Freezer", False), ("1,5 mm", "1 5 mm", False), ("1/2 Inch", "1-2 Inch", False),
    ],
)
def test_merge_keys(spark, a, b, same):
    phrases = {"Polyvinyl Chloride": "PVC"}
    df = spark.createDataFrame([(a, b)], "a string, b string")
    r = df.select(*[canonical.merge_key(c, phrases=phrases).alias(c) for c in "ab"]).first()
    assert (r.a == r.b) is same


def one_edit(a, b):
    """Whether one letter added, left out or changed makes them equal."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at:] == b[at + 1:] if len(a) < len(b) else a[at + 1:] == b[at + 1:]


def plain_classes(counts, least=5):
    words = [w for w in counts if len(w) >= least and not any(c.isdigit() for c in w)]
    hop = {}
    for w in words:
        near = [(-counts[o], o) for o in words if counts[o] >= 2 * counts[w] and one_edit(w, o)]
        if near:
            hop[w] = min(near)[1]
    last = lambda w: last(hop[w]) if w in hop else w
    return {w: last(w) for w in hop}


def edited(rng, word, letters="abcdefghijklmnopqrstuvwxyz"):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind < 2):]


def spelled(spark, counts):
    rows = [(w, n) for w, n in counts.items()]
    df = spark.createDataFrame(rows, "word string, n int").selectExpr("word", "explode(sequence(1, n)) AS i")
    return {r.variant: r.standard for r in canonical.spelling_classes(df).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_spelling_classes_are_the_plain_ones(spark, seed):
    rng = random.Random(seed)
    # Few letters make dense neighbourhoods; lengths run across the one where halves take over.
    counts = {}
    for size in (4, 5, 6, 23, 24, 25, 26, 40):
        for _ in range(12):
            word = "".join(rng.choice("ab") for _ in range(size))
            counts[word] = rng.randint(1, 40)
            for _ in range(4):
                word = edited(rng, word, "ab")
                counts[word] = rng.randint(1, 40)
    counts |= {"size12a": 9, "size12b": 1, "x" * 5000: 3, "x" * 4999: 1}
    assert spelled(spark, counts) == plain_classes(counts)


def test_planted_spelling_variants(spark):
    rng = random.Random(7)
    words = {"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(5, 11))) for _ in range(600)}
    counts = {w: rng.randint(20, 200) for w in sorted(words)}
    planted = {}
    for w in rng.sample(sorted(words), 300):
        v = edited(rng, w)
        if v not in counts and len(v) >= 5:
            planted[v] = w
            counts[v] = rng.randint(1, 9)
    got = spelled(spark, counts)
    right = sum(got.get(v) == w for v, w in planted.items())
    assert right >= 0.98 * len(planted) and right >= 0.98 * len(got)


def test_respelled_keys_and_names(spark):
    names = ["Grey Widget 10"] * 4 + ["grey widgets 10", "Grey Widgget 10", "Grey Widget 12", "Hot Widget", "Hot Wiget", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    classes = canonical.spelling_classes(canonical.name_words(df, "p"))
    keys = {r.p: r.merge_key for r in canonical.respelled_key(df, "p", classes).collect()}
    assert keys["Grey Widgget 10"] == keys["grey widgets 10"] == "grey widget 10" != keys["Grey Widget 12"]
    assert keys[None] is None and keys[""] == ""
    merged = {r.member: r.canonical for r in canonical.merge_by_key(df, "p", classes=classes).collect()}
    assert merged["Hot Wiget"] == merged["Hot Widget"] and "Grey Widget 12" not in merged
    empty = canonical.spelling_classes(df.where("p = 'none'").withColumnRenamed("p", "word"))
    assert empty.count() == 0
    with pytest.raises(ValueError):
        canonical.spelling_classes(df, "p", dominance=1)


def test_merge_by_key_picks_a_name(spark):
    names = ["paint roller", "Paint Rollers", "PAINT-ROLLERS", "PVC And ABS tubes", "PVC & ABS Tube", "Lonely"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = {r.member: r.canonical for r in canonical.merge_by_key(df, "p").collect()}
    assert got["paint roller"] == got["PAINT-ROLLERS"] == "Paint Rollers"
    assert got["PVC & ABS Tube"] == "PVC & ABS Tubes"
    assert "Lonely" not in got


def test_resumed_step_is_not_rebuilt(spark, tmp_path):
    path, calls = str(tmp_path / "step"), []

    def build():
        calls.append(1)
        return spark.range(3)

    for reset in (False, False, True):
        assert stages.materialize(spark, path, build, reset).count() == 3
    assert len(calls) == 2


def test_stage_uses_the_folder_of_the_session(spark):
    df = stages.stage(spark.range(2), "probe")
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]


def test_arrivals_are_curated_once(spark, sf, tmp_path):
    pack = queries_rules.demo_pack("correct")
    src, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    rows = registry.tax_dirty(spark, sf)

    def deliver(part):
        batched = batching.fixed_batches(part, 100, ["row_id"])
        batching.pack_batches(batched, COLUMNS).write.mode("append").json(src)

    def run():
        records = ingest.batch_stream(spark, src, COLUMNS)
        ingest.curate_arrivals(records, pack, out, chk).awaitTermination()
        return spark.read.parquet(out).select(*COLUMNS)

    from catalogops.operators.cascade import apply_rules

    deliver(rows.where("row_id < 100"))
    assert run().count() == 100
    deliver(rows.where("row_id >= 100"))
    expected = apply_rules(rows, pack).select(*COLUMNS)
    assert sorted(map(str, run().collect())) == sorted(map(str, expected.collect()))
    assert run().count() == rows.count()


def test_whole_job(spark, sf, tmp_path):
    rows = registry.tax_dirty(spark, sf)
    calls = []

    def name_clusters(lists):
        calls.append(1)
        reply = F.to_json(F.struct(F.upper(F.element_at("members", 1)).alias("canonical_name")))
        return lists.withColumn("reply", reply)

    def run():
        return curate.curate(
            rows, queries_rules.demo_pack("correct"), queries_rules.demo_pack("validate"), name_clusters,
            str(tmp_path / "job"), conditions={"bulk": F.col("category") == "BULK"}, targets={"bulk": 10_000},
            min_items=3, min_sim=0.6,
        )

    final, report = run()
    first = [tuple(r) for r in final.collect()]
    assert first == sorted(first) and len({r[2].strip().lower() for r in first}) == len(first)
    measures = {r.metric: (r.value, r.ok) for r in report.collect()}
    assert measures["final_products"] == (len(first), None) and measures["bulk"][1] is True
    metrics = spark.read.json(str(tmp_path / "job" / "metrics")).first()
    assert metrics.metrics.final_products == len(first) and metrics.input_rows == rows.count()
    again, _ = run()
    assert [tuple(r) for r in again.collect()] == first and len(calls) == 1
