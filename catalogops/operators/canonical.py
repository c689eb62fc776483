"""Synonym maps, merge keys and the choice of a canonical name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.replies import clean_reply
from ..functions.text import col, folded, word_prefix
from ..sources.stages import discard, stage, stage_at

REPLY = "struct<canonical_name: string, merged: array<string>>"


def synonym_replies(
    df: DataFrame, reply_col: str = "reply", members_col: str = "members"
) -> tuple[DataFrame, DataFrame]:
    """Split clusters into ``(good, dead_letter)`` by what their reply is.

    A good reply is JSON. It adds ``canonical_name`` and ``merged``: without a
    usable ``canonical_name`` the first member names the cluster and all members
    merge; without ``merged`` all members merge. A failed call (``error`` set),
    no reply or a reply that is not JSON merges nothing: that cluster goes to the
    dead letters with its ``failure`` and its items stay as they are.
    """
    cleaned = clean_reply(reply_col)
    errors = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    failure = (
        F.when(errors.isNotNull(), errors)
        .when(F.col(reply_col).isNull(), F.lit("no reply"))
        .when(F.try_parse_json(cleaned).isNull(), F.lit("not JSON"))
    )
    checked = df.withColumn("failure", failure)
    answer = F.from_json(cleaned, REPLY)
    name = answer.getField("canonical_name")
    members = F.col(members_col)
    good = checked.where(F.col("failure").isNull()).drop("failure").withColumns(
        {
            "canonical_name": F.coalesce(name, F.try_element_at(members, F.lit(1))),
            "merged": F.when(
                name.isNotNull(), F.coalesce(answer.getField("merged"), members)
            ).otherwise(members),
        }
    )
    return good, checked.where(F.col("failure").isNotNull())


def synonym_map(replies: DataFrame, order_by: Sequence[str] = ("cluster_id",)) -> DataFrame:
    """``(member, canonical)``: the last cluster that names a member wins."""
    pairs = replies.select(
        *order_by, "canonical_name", F.posexplode("merged").alias("pos", "member")
    ).where(F.col("member").isNotNull())
    # Numbered ids outgrow their padding: longer ones are later.
    order = [
        part.alias(f"o{i}{j}")
        for i, c in enumerate(order_by)
        for j, part in enumerate((F.length(F.col(c).cast("string")), F.col(c)))
    ]
    last = F.max(F.struct(*order, "pos", "canonical_name"))
    return pairs.groupBy("member").agg(last.alias("w")).select(
        "member", F.col("w.canonical_name").alias("canonical")
    )


def changes(mapping: DataFrame) -> DataFrame:
    """How many names the map really changes."""
    return mapping.agg(
        F.count_if(F.col("member") != F.col("canonical")).alias("duplicates_removed")
    )


def apply_map(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by its canonical name; one hop.

    ``mapping`` grows with the data, so it carries no broadcast hint: the
    planner broadcasts it only when its stored size is small.
    """
    table = mapping.select(
        F.col("member").alias("syn_member"), F.col("canonical").alias("syn_name")
    )
    joined = df.join(table, F.col(column) == F.col("syn_member"), "left")
    name = F.coalesce("syn_name", column).alias(column)
    return joined.select(*[name if c == column else F.col(c) for c in df.columns])


# Spelling variants that never change the meaning.
SPELLINGS = {
    "colour": "color",
    "aluminium": "aluminum",
}


# Words that look like a plural and are none, and plurals of words in -ie.
PLURAL_FORM = ("lens", "gas", "bus", "canvas", "atlas", "bias", "series", "species")
PLURAL_IE = ("cookies", "pies", "ties", "movies", "brownies", "hoodies", "zombies", "selfies")


def _singular(word: Column) -> Column:
    """Plural stripping for lower-case words; words with digits stay."""
    return (
        F.when(word.rlike("[0-9]") | (F.length(word) < 4), word)
        .when(word.isin(*PLURAL_FORM), word)
        .when(word.isin(*PLURAL_IE), F.regexp_replace(word, "s$", ""))
        .when(word.rlike("ies$"), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("(?:ss|x|ch|sh)es$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike("(?:ss|us|is)$"), word)
        .otherwise(F.regexp_replace(word, "s$", ""))
    )


def merge_key(
    c: Column | str,
    spellings: Mapping[str, str] = SPELLINGS,
    phrases: Mapping[str, str] | None = None,
) -> Column:
    """Names with equal keys differ only in form.

    Form is: case, ``And`` / ``&``, hyphen, comma, slash, singular or plural, spelling
    variant, and the abbreviations given as ``phrases`` (full form to short
    form). Digits and sizes always stay, so variants by size keep apart: a sign
    before a digit, a decimal comma and a fraction are part of the size.
    """
    text = F.regexp_replace(folded(c), "&", " and ")
    text = F.regexp_replace(text, "[-,/](?![0-9])", " ")
    for full, short in (phrases or {}).items():
        text = F.regexp_replace(text, rf"\b\Q{full.lower()}\E\b", short.lower())
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    words = F.transform(words, _singular)
    for variant, standard in spellings.items():
        words = F.transform(
            words, lambda w: F.when(w == variant, F.lit(standard)).otherwise(w)
        )
    return F.array_join(words, " ")


# Words shorter than this are another word when one letter changes ("cat", "cot").
SPELLED = 5
# How many times as frequent a word must be to be the standard of another one.
DOMINANCE = 2.0


# Words up to one letter longer meet by what is left without one letter, words from there on by halves.
LONG = 24


def _meeting_forms(word: Column) -> Column:
    """Texts of which two words have one in common if one edit makes them equal.

    Up to ``LONG`` + 1 letters: the word, and what is left of it without each of
    its letters. From there on, where those would be long and many: its front
    and back half for its own length and for a word that is one letter shorter,
    as one edit leaves one half alone.
    """
    n = F.length(word)
    short = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n))
    )
    half = lambda m: F.floor(m / 2).cast("int")
    halves = [
        form for m in (n, n - 1) for form in (
            F.concat(F.lit("<"), m.cast("string"), F.substring(word, F.lit(1), half(m))),
            F.concat(F.lit(">"), m.cast("string"), F.substring(word, n - m + half(m) + 1, m - half(m))),
        )
    ]
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(
        F.when(n <= LONG + 1, F.concat(F.array(word), short)).otherwise(none),
        F.when(n > LONG, F.array(*halves)).otherwise(none),
    ))


def name_words(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, pos, word)``: the words of a name in the form that merge keys compare."""
    words = F.split(merge_key(column, spellings={}), " ")
    return df.select(*keep, F.posexplode(words).alias("pos", "word"))


def spelling_classes(
    words: DataFrame, word: str = "word", least: int = SPELLED, dominance: float = DOMINANCE
) -> DataFrame:
    """``(variant, standard)`` of words that are another word with one letter added, left out or changed.

    ``words`` holds one row per occurrence. A word of at least ``least`` letters
    and no digit is a variant of the most frequent word within one edit that is
    at least ``dominance`` times as frequent as it, ties to the alphabetically
    first; that word may be a variant itself, and the last of the walk is the
    standard. Counts rise along it, so the walk ends and there are no circles.
    Words with digits are sizes and codes and never meet; NULL is no word. A
    ``dominance`` of one or less is refused: equal counts have no order.

    Words meet by equality of ``_meeting_forms`` and are then compared. Copies
    are counted before any shuffle, and a form of a short word is shared only by
    words that are one letter more than it.
    """
    if dominance <= 1:
        raise ValueError("dominance must be above 1")
    spark = words.sparkSession
    w = F.col("word")
    counted = stage(
        words.select(F.col(word).alias("word")).where((F.length("word") >= least) & ~w.rlike("[0-9]"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")),
        "word-counts",
    )
    forms = counted.select("word", "n", F.explode(_meeting_forms(w)).alias("form"))
    other = forms.select(F.col("word").alias("other"), F.col("n").alias("m"), "form")
    near = (F.col("m") >= dominance * F.col("n")) & (F.levenshtein("word", "other", 1) == 1)
    chosen = F.min(F.struct((-F.col("m")).alias("rank"), "other"))["other"].alias("standard")
    hops = forms.join(other, "form").where(near).groupBy("word").agg(chosen)
    return _last_hop(spark, hops.withColumnRenamed("word", "variant"))


def _last_hop(spark: SparkSession, hops: DataFrame) -> DataFrame:
    """Follow ``standard`` to its end, twice as far in each round."""
    here, path = stage_at(hops, "spelling-hops")
    while True:
        onward = here.select(F.col("variant").alias("_from"), F.col("standard").alias("_to"))
        joined, next_path = stage_at(
            here.join(onward, F.col("standard") == F.col("_from"), "left").select(
                "variant", F.coalesce("_to", "standard").alias("standard"), F.col("_to").isNotNull().alias("_moved")
            ),
            "spelling-hops",
        )
        discard(spark, path)
        here, path = joined.drop("_moved"), next_path
        if joined.where("_moved").isEmpty():
            return here


def respelled_key(df: DataFrame, column: str, classes: DataFrame, name: str = "merge_key") -> DataFrame:
    """Add the merge key of ``column`` with every word in its standard spelling.

    ``classes`` is ``(variant, standard)``; it grows with the words and carries
    no broadcast hint. Each different name is looked up once; a NULL name has a
    NULL key.
    """
    names = df.select(F.col(column).alias("_name")).where(F.col(column).isNotNull()).distinct()
    table = classes.select(F.col("variant").alias("word"), "standard")
    spelled = name_words(names, "_name", ["_name"]).join(table, "word", "left")
    placed = F.struct("pos", F.coalesce("standard", "word").alias("w"))
    keys = spelled.groupBy("_name").agg(F.array_join(F.array_sort(F.collect_list(placed))["w"], " ").alias("_key"))
    return df.join(keys, F.col(column) == F.col("_name"), "left").select(
        *[c for c in df.columns if c != name], F.col("_key").alias(name)
    )


def title(c: Column | str) -> Column:
    """Upper-case first letters, keep the rest, and write ``&`` for ``And``."""
    words = F.transform(
        F.split(col(c), " "),
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)),
    )
    return F.regexp_replace(F.array_join(words, " "), r"\bAnd\b", "&")


def pick_names(
    df: DataFrame, key: str, name: str, entity_words: Sequence[str] = ()
) -> DataFrame:
    """One canonical name per key: no business words, not a single word, plural,
    longest, alphabetically first, then in title case."""
    n = F.col(name)
    order = F.struct(
        (word_prefix(n, entity_words) if entity_words else F.lit(False)).alias("entity"),
        (~n.contains(" ")).alias("single"),
        (~F.lower(n).endswith("s")).alias("singular"),
        (-F.length(n)).alias("longest"),
        n.alias("name"),
    )
    # Distinct spellings first: copies of one name vanish inside the map tasks.
    names = df.select(key, name).distinct()
    best = names.groupBy(key).agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n_names"))
    return best.select(key, title("best.name").alias("canonical"), "n_names")


def merge_by_key(
    df: DataFrame, column: str, entity_words: Sequence[str] = (), classes: DataFrame | None = None, **key_options
) -> DataFrame:
    """Synonym map ``(member, canonical)`` from merge keys, without a model.

    With ``classes`` (``spelling_classes``) spelling variants merge too, in
    place of the listed ``spellings``.
    """
    names = df.select(F.col(column).alias("member")).dropna().distinct()
    if classes is not None:
        keyed = respelled_key(names, "member", classes)
    else:
        keyed = names.withColumn("merge_key", merge_key("member", **key_options))
    best = pick_names(keyed, "merge_key", "member", entity_words)
    merged = best.where("n_names > 1").select("merge_key", "canonical")
    return keyed.join(merged, "merge_key").select("member", "canonical")
