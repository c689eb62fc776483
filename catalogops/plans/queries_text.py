"""Queries for replies, synonyms, canonical names, vectors and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.replies import clean_reply
from ..functions.text import folded
from ..operators import batching, canonical, clusters, grams, inference, vectors
from ..sources import exchange
from ..sources.stages import new_path, stage
from .registry import TAX, cores, query, read, strip_sql, tax

# --- replies: an event's JSON wrapped the way a model wraps its answer

FIELDS = StructType([StructField("k", IntegerType())])


def replies(spark, sf):
    props = F.col("props")
    kind = F.col("event_id") % 7
    body = F.when(kind == 1, F.concat(F.lit("["), props, F.lit(","), props, F.lit("]"))).otherwise(props)
    fenced = F.concat(F.lit("Here is:\n```json\n"), body, F.lit("\n```"))
    reply = F.when(kind == 0, "sorry").when(kind == 2, "[1, 2]").otherwise(fenced)
    return read(spark, sf, "events").select(F.col("event_id").alias("id"), reply.alias("reply"))


@query(
    "clean_json_reply",
    """SELECT event_id AS id, CASE event_id % 7 WHEN 0 THEN 'sorry' WHEN 2 THEN '[1, 2]'
         WHEN 1 THEN '[' || props || ',' || props || ']' ELSE props END AS cleaned FROM events""",
)
def clean_json_reply(spark, sf):
    return replies(spark, sf).select("id", clean_reply("reply").alias("cleaned"))


@query(
    "reply_to_rows",
    """SELECT event_id AS id, CAST(unnest(CASE WHEN event_id % 7 = 1 THEN [0, 1] ELSE [0] END) AS INTEGER) AS idx,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 7 NOT IN (0, 2)""",
)
def reply_to_rows(spark, sf):
    rows, _ = inference.reply_rows(replies(spark, sf), FIELDS, ["id"])
    return rows


@query(
    "dead_letter",
    """SELECT event_id AS id, CASE event_id % 7 WHEN 0 THEN 'sorry' ELSE '[1, 2]' END AS reply,
         'not a list of records' AS failure FROM events WHERE event_id % 7 IN (0, 2)""",
)
def dead_letter(spark, sf):
    _, dead = inference.reply_rows(replies(spark, sf), FIELDS, ["id"])
    return dead


@query(
    "infer_replay",
    """SELECT e.event_id AS id, CASE WHEN event_type <> 'error' THEN props END AS reply,
         CASE WHEN event_type = 'error' THEN 'no recorded reply' END AS error FROM events e""",
)
def infer_replay(spark, sf):
    events = read(spark, sf, "events")
    recorded = events.where("event_type <> 'error'").select(
        F.col("event_id").alias("id"), F.col("props").alias("reply")
    )
    return inference.replay(events.select(F.col("event_id").alias("id")), recorded, ["id"])


@query(
    "infer_model",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE upper(event_type) END AS reply,
         event_type = 'error' AS failed FROM events""",
)
def infer_model(spark, sf):
    """A callable per partition, with single prompts that fail."""

    def make_model():
        def model(prompts):
            return [ValueError(p) if p == "error" else p.upper() for p in prompts]

        return model

    prompts = read(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("prompt")
    )
    return inference.infer(prompts, "prompt", make_model, ["id"]).select(
        "id", "reply", F.col("error").isNotNull().alias("failed")
    )


@query(
    "infer_resumed",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL ELSE upper(event_type) || ' ' || user_id END AS reply,
         event_type = 'error' AS failed FROM events""",
)
def infer_resumed(spark, sf):
    """A run over a half, then one over all that finds the half's answers in the log."""

    def make_model():
        def model(prompts):
            return [ValueError(p) if p.startswith("error") else p.upper() for p in prompts]

        return model

    events = read(spark, sf, "events")
    prompts = events.select(F.col("event_id").alias("id"), F.concat_ws(" ", "event_type", "user_id").alias("prompt"))
    log = new_path(spark, "answers-log")
    ask = lambda df: inference.infer_resumable(df, "prompt", make_model, ["id"], log, "upper")
    ask(prompts.where("id % 2 = 0"))
    return ask(prompts).select("id", "reply", F.col("error").isNotNull().alias("failed"))


# --- synonym clusters: distinct (brand, name) pairs in runs of eight

SYN = f"""{TAX}, named AS (SELECT DISTINCT subcategory, product_category FROM tax),
  placed AS (SELECT *, row_number() OVER (ORDER BY subcategory, product_category) - 1 AS pos FROM named),
  syn AS (SELECT pos // 8 AS number, printf('cluster_%04d', pos // 8) AS cluster_id,
                 list(product_category ORDER BY pos) AS members FROM placed GROUP BY 1, 2),
  replied AS (SELECT number, cluster_id, members,
    CASE number % 4 WHEN 1 THEN upper(members[1]) WHEN 2 THEN members[-1] WHEN 3 THEN 'Name ' || number
      ELSE members[1] END AS canonical_name,
    CASE number % 4 WHEN 3 THEN [members[-1]] ELSE members END AS merged FROM syn WHERE number % 8 <> 4 AND number % 8 <> 0),
  pairs AS (SELECT number, canonical_name, unnest(merged) AS member,
                   generate_subscripts(merged, 1) AS pos FROM replied),
  synonyms AS (SELECT member, arg_max(canonical_name, number * 100 + pos) AS canonical FROM pairs GROUP BY 1)"""


def syn(spark, sf):
    names = tax(spark, sf).select("subcategory", "product_category").distinct()
    batched = batching.fixed_batches(names, 8, ["subcategory", "product_category"])
    packed = batching.pack_batches(batched, ["product_category"])
    number = (F.col("batch_id") - 1).alias("number")
    return packed.select(
        number,
        F.format_string("cluster_%04d", F.col("batch_id") - 1).alias("cluster_id"),
        F.col("items.product_category").alias("members"),
    )


def syn_replies(spark, sf):
    kind, last = F.col("number") % 4, F.element_at("members", -1)
    def reply(name, merged=None):
        parts = [name.alias("canonical_name")] + ([merged.alias("merged")] if merged is not None else [])
        return F.to_json(F.struct(*parts))

    text = (
        F.when(kind == 1, reply(F.upper(F.element_at("members", 1)), F.col("members")))
        .when(kind == 2, reply(last))
        .when(kind == 3, F.concat(
            F.lit("```json\n"),
            reply(F.concat(F.lit("Name "), F.col("number").cast("string")), F.array(last)),
            F.lit("\n```"),
        ))
        .when(F.col("number") % 8 == 4, F.lit("I cannot merge these."))
    )
    down = F.when(F.col("number") % 8 == 0, F.lit("down"))
    return canonical.synonym_replies(syn(spark, sf).withColumns({"reply": text, "error": down}))


def syn_map(spark, sf):
    return canonical.synonym_map(syn_replies(spark, sf)[0], ["number"])


@query(
    "synonym_reply",
    f"""WITH {SYN} SELECT cluster_id, canonical_name, array_to_string(merged, '|') AS merged FROM replied""",
)
def synonym_reply(spark, sf):
    return syn_replies(spark, sf)[0].select(
        "cluster_id", "canonical_name", F.array_join("merged", "|").alias("merged")
    )


@query(
    "synonym_dead_letter",
    f"""WITH {SYN} SELECT cluster_id, CASE number % 8 WHEN 0 THEN 'down' ELSE 'not JSON' END AS failure,
               len(members) AS n FROM syn WHERE number % 4 = 0""",
)
def synonym_dead_letter(spark, sf):
    dead = syn_replies(spark, sf)[1]
    return dead.select("cluster_id", "failure", F.size("members").cast("long").alias("n"))


@query(
    "cluster_lines_roundtrip",
    f"""WITH {SYN} SELECT cluster_id, array_to_string(members, '|') AS members FROM syn""",
)
def cluster_lines_roundtrip(spark, sf):
    path = new_path(spark, "cluster-lines")
    exchange.write_clusters(syn(spark, sf).select("cluster_id", "members"), path)
    return exchange.read_cluster_lines(spark, path).select(
        "cluster_id", F.array_join("members", "|").alias("members")
    )


@query("synonym_map", f"WITH {SYN} SELECT member, canonical FROM synonyms")
def synonym_map(spark, sf):
    return syn_map(spark, sf)


@query(
    "synonym_changes",
    f"WITH {SYN} SELECT count(*) FILTER (member <> canonical) AS duplicates_removed FROM synonyms",
)
def synonym_changes(spark, sf):
    return canonical.changes(syn_map(spark, sf))


@query(
    "apply_synonyms",
    f"""WITH {SYN} SELECT DISTINCT category, subcategory, coalesce(canonical, product_category) AS product_category
        FROM tax LEFT JOIN synonyms ON member = product_category""",
)
def apply_synonyms(spark, sf):
    mapping = stage(syn_map(spark, sf), "synonyms")
    renamed = canonical.apply_map(tax(spark, sf), mapping, "product_category")
    return renamed.select("category", "subcategory", "product_category").distinct()


@query(
    "render_prompt",
    f"""WITH {SYN} SELECT cluster_id, 'Pick one name.' || chr(10) || chr(10) || 'Input cluster (' || cluster_id || '):'
          || chr(10) || '- ' || array_to_string(members, chr(10) || '- ') AS prompt FROM syn""",
)
def render_prompt(spark, sf):
    prompt = inference.cluster_prompt("Pick one name.", F.col("cluster_id"), F.col("members"))
    return syn(spark, sf).select("cluster_id", prompt.alias("prompt"))


# --- merge keys over names in several forms

NAMES = """forms AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN p_name || 's'
    WHEN 2 THEN upper(p_name) WHEN 3 THEN replace(p_name, ' ', '-') WHEN 4 THEN p_name || ' And Colour'
    ELSE p_name || ' & Color' END AS name FROM part),
  keyed AS (SELECT *, array_to_string(list_transform(list_filter(string_split(regexp_replace(
      replace(lower(name), '&', ' and '), '[-,/]', ' ', 'g'), ' '), lambda w: w <> ''),
      lambda w: CASE WHEN w = 'colour' THEN 'color' ELSE regexp_replace(w, 's$', '') END), ' ') AS merge_key FROM forms)"""


def forms(spark, sf):
    name, kind = F.col("p_name"), F.col("p_partkey") % 6
    form = (
        F.when(kind == 0, name).when(kind == 1, F.concat(name, F.lit("s")))
        .when(kind == 2, F.upper(name)).when(kind == 3, F.replace(name, F.lit(" "), F.lit("-")))
        .when(kind == 4, F.concat(name, F.lit(" And Colour"))).otherwise(F.concat(name, F.lit(" & Color")))
    )
    return read(spark, sf, "part").select("p_partkey", form.alias("name"))


@query(
    "merge_key_groups",
    f"""WITH {NAMES} SELECT merge_key, count(*) AS n, count(DISTINCT name) AS n_names FROM keyed GROUP BY 1""",
)
def merge_key_groups(spark, sf):
    keyed = forms(spark, sf).withColumn("merge_key", canonical.merge_key("name"))
    per_name = keyed.groupBy("merge_key", "name").agg(F.count(F.lit(1)).alias("n"))
    return per_name.groupBy("merge_key").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_names")
    )


# --- spelling variants by rule, over all words of all texts

# Of two words of five or more letters that one edit makes equal, the first two or the last two letters agree.
SPELLING = """counted AS MATERIALIZED (SELECT word, count(*) AS n FROM said WHERE length(word) >= 5 AND NOT regexp_matches(word, '[0-9]') GROUP BY 1),
  met AS (SELECT a.word AS variant, b.word AS other, b.n AS m FROM counted a JOIN counted b
          ON a.word[1:2] = b.word[1:2] AND b.n >= 2 * a.n AND abs(length(a.word) - length(b.word)) <= 1
          UNION SELECT a.word, b.word, b.n FROM counted a JOIN counted b
          ON a.word[-2:] = b.word[-2:] AND b.n >= 2 * a.n AND abs(length(a.word) - length(b.word)) <= 1),
  hops AS MATERIALIZED (SELECT variant, other AS standard FROM met WHERE levenshtein(variant, other) = 1
          QUALIFY row_number() OVER (PARTITION BY variant ORDER BY m DESC, other) = 1),
  walked(variant, standard) AS (SELECT variant, standard FROM hops
          UNION ALL SELECT w.variant, h.standard FROM walked w JOIN hops h ON h.variant = w.standard),
  classes AS (SELECT * FROM walked WHERE standard NOT IN (SELECT variant FROM hops))"""


@query(
    "spelling_classes",
    f"""WITH RECURSIVE said AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
      {SPELLING} SELECT variant, standard FROM classes""",
)
def spelling_classes(spark, sf):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    return canonical.spelling_classes(read(spark, sf, "documents").select(F.explode(words).alias("word")))


SLIPS = """names AS (SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN replace(p_name, 'dg', 'g') WHEN 1 THEN replace(p_name, 'z', 's')
    WHEN 2 THEN replace(p_name, 'lt', 'llt') ELSE p_name END || ' ' || p_size AS name FROM part),
  placed AS (SELECT name, unnest(string_split(lower(name), ' ')) AS form, generate_subscripts(string_split(lower(name), ' '), 1) AS pos
    FROM names),
  worded AS (SELECT name, pos, regexp_replace(form, '([^s0-9]{3})s$', '\\1') AS word FROM placed),
  said AS (SELECT word FROM worded)"""


@query(
    "respelled_groups",
    f"""WITH RECURSIVE {SLIPS}, {SPELLING},
      keyed AS (SELECT name, string_agg(coalesce(standard, word), ' ' ORDER BY pos) AS merge_key
        FROM (SELECT DISTINCT name, pos, word FROM worded) LEFT JOIN classes ON variant = word GROUP BY 1)
      SELECT merge_key, count(*) AS n_names FROM keyed GROUP BY 1""",
)
def respelled_groups(spark, sf):
    name, kind = F.col("p_name"), F.col("p_partkey") % 9
    slip = (
        F.when(kind == 0, F.replace(name, F.lit("dg"), F.lit("g"))).when(kind == 1, F.replace(name, F.lit("z"), F.lit("s")))
        .when(kind == 2, F.replace(name, F.lit("lt"), F.lit("llt"))).otherwise(name)
    )
    names = read(spark, sf, "part").select(F.concat_ws(" ", slip, F.col("p_size").cast("string")).alias("name"))
    classes = canonical.spelling_classes(canonical.name_words(names, "name"))
    keyed = canonical.respelled_key(names.distinct(), "name", classes)
    return keyed.groupBy("merge_key").agg(F.count(F.lit(1)).alias("n_names"))


@query(
    "canonical_pick",
    f"""WITH {NAMES}, u AS (SELECT DISTINCT merge_key, name FROM keyed),
        r AS (SELECT *, row_number() OVER (PARTITION BY merge_key ORDER BY contains(' ' || lower(name), ' small'),
                NOT contains(name, ' '), NOT ends_with(lower(name), 's'), -length(name), name) AS rn,
              count(*) OVER (PARTITION BY merge_key) AS n_names FROM u)
        SELECT merge_key, regexp_replace(array_to_string(list_transform(string_split(name, ' '),
            lambda w: upper(w[1]) || w[2:]), ' '), '\\bAnd\\b', '&', 'g') AS canonical, n_names
        FROM r WHERE rn = 1""",
)
def canonical_pick(spark, sf):
    keyed = forms(spark, sf).withColumn("merge_key", canonical.merge_key("name"))
    return canonical.pick_names(keyed, "merge_key", "name", ["small"])


# --- vectors and clusters

COSINE = "round(list_cosine_similarity(a.v, b.v), 9)"
VECS = """v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


@query(
    "l2_normalize",
    """WITH s AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (1 + vec_id % 5)) AS v FROM embeddings),
       n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM s)
       SELECT vec_id, round(v[1] / norm, 6) + 0 AS first_value, round(v[-1] / norm, 6) + 0 AS last_value,
              round(list_sum(list_transform(v, lambda x: (x / norm) * (x / norm))), 6) AS squared FROM n""",
)
def l2_normalize(spark, sf):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (1 + F.col("vec_id") % 5))
    unit = vectors.l2_normalize(
        read(spark, sf, "embeddings").select("vec_id", scaled.alias("v")), "v", "u"
    )
    return unit.select(
        "vec_id",
        (F.round(F.element_at("u", 1), 6) + 0).alias("first_value"),
        (F.round(F.element_at("u", -1), 6) + 0).alias("last_value"),
        F.round(vectors.inner_product(F.col("u"), F.col("u")), 6).alias("squared"),
    )


def top_sql(tau: float) -> str:
    return f"""{VECS}, top AS MATERIALIZED (SELECT * FROM (SELECT a.vec_id AS id, b.vec_id AS neighbour, {COSINE} AS sim,
      row_number() OVER (PARTITION BY a.vec_id ORDER BY {COSINE} DESC, b.vec_id) AS rank
      FROM v a JOIN v b ON a.vec_id <> b.vec_id) WHERE rank <= 9 AND sim >= {tau})"""


@query(
    "knn_topk",
    f"""WITH {top_sql(-1)} SELECT id, neighbour, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM top""",
)
def knn_topk(spark, sf):
    found = vectors.knn(read(spark, sf, "embeddings"), "vec_id", "embedding", min_sim=-1.0, partitions=cores(spark))
    return found.withColumn("sim", F.round("sim", 6))


TAU = 0.35

# The sequential procedure itself, one id per step, carrying the visited list.
LEADER_SQL = f"""{top_sql(TAU)},
  lists AS MATERIALIZED (SELECT id, list(neighbour ORDER BY rank) AS ns FROM top GROUP BY 1),
  ids AS MATERIALIZED (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) AS step,
     coalesce(ns, []) AS ns FROM v LEFT JOIN lists ON lists.id = vec_id),
  walk(step, leader, took, visited) AS (
    SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[])
    UNION ALL
    SELECT i.step,
      CASE WHEN list_contains(w.visited, i.id) THEN NULL ELSE i.id END,
      CASE WHEN list_contains(w.visited, i.id) THEN [] ELSE list_filter(i.ns, lambda n: NOT list_contains(w.visited, n)) END,
      CASE WHEN list_contains(w.visited, i.id) THEN w.visited
        ELSE list_concat(w.visited, [i.id], list_filter(i.ns, lambda n: NOT list_contains(w.visited, n))) END
    FROM walk w JOIN ids i ON i.step = w.step + 1),
  made AS (SELECT leader, took, printf('cluster_%04d', row_number() OVER (ORDER BY leader) - 1) AS cluster_id
    FROM walk WHERE leader IS NOT NULL AND len(took) > 0)"""


def embedding_clusters(spark, sf):
    edges = vectors.knn(read(spark, sf, "embeddings"), "vec_id", "embedding", min_sim=TAU, partitions=cores(spark))
    return clusters.cluster_table(clusters.leader_assignment(edges))


@query(
    "leader_clusters",
    f"""WITH RECURSIVE {LEADER_SQL}
        SELECT cluster_id, leader AS leader_id, leader AS member_id, CAST(0 AS INTEGER) AS ord FROM made
        UNION ALL
        SELECT cluster_id, leader, unnest(took), CAST(generate_subscripts(took, 1) AS INTEGER) FROM made""",
)
def leader_clusters(spark, sf):
    return embedding_clusters(spark, sf)


@query(
    "cluster_members",
    f"""WITH RECURSIVE {LEADER_SQL}
        SELECT cluster_id, array_to_string(list_concat([leader], took), ',') AS members FROM made""",
)
def cluster_members(spark, sf):
    named = embedding_clusters(spark, sf).withColumn("name", F.col("member_id").cast("string"))
    return clusters.cluster_lists(named, "name").select(
        "cluster_id", F.array_join("members", ",").alias("members")
    )


_STEP = "CAST((CAST(xor({h}, CAST(codes[i{at}] AS UBIGINT)) AS UHUGEINT) * 1099511628211) % 18446744073709551616 AS UBIGINT)"
_HASH = _STEP.format(
    h=_STEP.format(h=_STEP.format(h="CAST(14695981039346656037 AS UBIGINT)", at=""), at=" + 1"), at=" + 2"
)


BUCKETS = f"""c AS (SELECT doc_id, list_transform(string_split(' ' || lower({strip_sql('text')}) || ' ', ''),
            lambda ch: unicode(ch)) AS codes FROM documents),
        h AS (SELECT doc_id, unnest(list_transform(range(1, len(codes) - 1), lambda i: {_HASH})) AS h FROM c),
        buckets AS MATERIALIZED (
            SELECT doc_id, CAST(xor(h, h // 8589934592) % 256 AS INTEGER) AS bucket, count(*) AS n FROM h GROUP BY ALL)"""


@query("embed_hash", f"WITH {BUCKETS} SELECT * FROM buckets")
def embed_hash(spark, sf):
    """Vectors turned back into the counts they were made of."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    made = vectors.embed_hashed(docs, "text", partitions=cores(spark)).select(
        "doc_id", F.length(folded("text")).alias("grams"), "vector"
    )
    total = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x)
    # The norm comes first: next to an explode it would be computed per element.
    made = made.withColumn("norm", F.col("grams") / total)
    scaled = made.select("doc_id", "norm", F.posexplode("vector").alias("bucket", "x"))
    return scaled.select(
        "doc_id", "bucket", F.round(F.col("x") * F.col("norm")).cast("long").alias("n")
    ).where("n > 0")


# Counts are whole numbers, so the division and the cast give the encoder's single-precision values bit for bit.
@query(
    "similar_texts",
    f"""WITH {BUCKETS},
        norms AS (SELECT doc_id, sqrt(CAST(sum(n * n) AS DOUBLE)) AS norm FROM buckets GROUP BY 1),
        cells AS (SELECT doc_id, norm, CAST(unnest(range(256)) AS INTEGER) AS bucket FROM norms),
        v AS MATERIALIZED (SELECT doc_id, list(CAST(CAST(coalesce(n, 0) / norm AS FLOAT) AS DOUBLE) ORDER BY bucket) AS v
              FROM cells LEFT JOIN buckets USING (doc_id, bucket) GROUP BY 1),
        near AS (SELECT a.doc_id AS id, b.doc_id AS neighbour, {COSINE} AS sim
                 FROM v a JOIN v b ON a.doc_id <> b.doc_id WHERE {COSINE} >= {vectors.MIN_SIMILARITY}),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS rank FROM near)
        SELECT id, neighbour, sim, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank < {vectors.NEIGHBOURS}""",
)
def similar_texts(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    encoded = vectors.embed_hashed(docs, "text", partitions=cores(spark))
    return vectors.knn(encoded, "doc_id", "vector", partitions=cores(spark))


@query("approximate_texts")
def approximate_texts(spark, sf):
    """As ``similar_texts``, by tables of sorted codes: exact similarities, nearly all neighbours."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    encoded = vectors.embed_hashed(docs, "text", partitions=cores(spark))
    return vectors.approximate_knn(encoded, "doc_id", "vector", partitions=cores(spark))


GRAMS = 8


@query(
    "similar_grams",
    f"""WITH t AS (SELECT doc_id, lower({strip_sql('text')}) AS t FROM documents WHERE text IS NOT NULL),
        d AS (SELECT t, min(doc_id) AS rep FROM t GROUP BY 1),
        g AS (SELECT rep, substr(' ' || t || ' ', CAST(i AS BIGINT), {GRAMS}) AS gram
              FROM (SELECT rep, t, unnest(range(1, length(t) + {4 - GRAMS})) AS i FROM d)),
        c AS MATERIALIZED (SELECT rep, gram, count(*) AS n FROM g GROUP BY 1, 2),
        s AS (SELECT rep, CAST(sum(n * n) AS DOUBLE) AS square FROM c GROUP BY 1),
        dots AS (SELECT a.rep AS a, b.rep AS b, CAST(sum(a.n * b.n) AS DOUBLE) AS dot
                 FROM c a JOIN c b ON a.gram = b.gram GROUP BY 1, 2),
        sims AS (SELECT a, b, round(dot / sqrt(x.square * y.square), 9) AS sim
                 FROM dots JOIN s x ON x.rep = a JOIN s y ON y.rep = b),
        near AS (SELECT v.doc_id AS id, w.doc_id AS neighbour, CASE WHEN a = b THEN 1.0 ELSE sim END AS sim
                 FROM sims JOIN d p ON p.rep = a JOIN d q ON q.rep = b JOIN t v ON v.t = p.t JOIN t w ON w.t = q.t
                 WHERE v.doc_id <> w.doc_id AND (a = b OR sim >= {vectors.MIN_SIMILARITY})),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS rank FROM near)
        SELECT id, neighbour, sim, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank < {vectors.NEIGHBOURS}""",
)
def similar_grams(spark, sf):
    """Whole texts by the counts of all their n-grams, unhashed: an inverted index in place of blocks."""
    return grams.gram_join(read(spark, sf, "documents"), "doc_id", "text", n=GRAMS, partitions=cores(spark))
