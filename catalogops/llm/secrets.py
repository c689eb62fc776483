"""Secrets in texts: fixed patterns, and tokens that pass for random.

Tokens of letters and digits are given the encoding their characters suggest.
Tests of randomness (even use of the alphabet, runs in the order of the alphabet
and in kinds of symbols, serial correlation) are combined into one p-value;
names, words and counters fail one of them. How
large the p-value must be is set for each encoding and length class from all
tokens of the corpus, so that the expected share of structured tokens among
those reported stays below a bound. All of it is column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let

#: Fixed patterns of the base kinds. The last two state the least length that the kind asks for:
#: a maximal run of at least so many characters is the same as a maximal run that is long enough.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ("assign", "access", "hex", "random")
RANDOM = len(KINDS) - 1

#: Alphabets in the order they are tried; a token belongs to the first whose pattern it matches.
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": (r"^(?=.*[0-9])(?=.*[a-zA-Z])([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "letters": (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": (
        r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+=*$",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    ),
}
_VOWELS = "aeiouAEIOU"
#: Expected share of structured tokens among the reported ones, at most.
FALSE_DISCOVERIES = 0.05
#: Steps of the p-value at which that share is estimated.
STEPS = 40
#: With fewer tokens of a p beyond the first step, a class's own estimate says too little and is pooled ...
LEAST_TOKENS = 50
#: ... and if the pool gives no threshold either, this p is it: about as large a share of random tokens is lost.
FALLBACK = 2 / STEPS
MASK = "[SECRET]"


#: Elements that are summed up together, so that a running value takes a short walk and not one from the start.
_RUN = 256
#: Code points of a stretch of text out of which pieces are cut.
_STRETCH = 4096


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0), lambda a, x: a + x)


def _greatest(part: Column) -> Column:
    return F.coalesce(F.array_max(part), F.lit(0))


def _with_before(values: Column, fold: Callable[[Column], Column], join: Callable[[Column, Column], Column], body: Callable) -> Column:
    """``body(before)``: ``before(i)`` is the fold (sum or maximum) of the values ahead of place ``i``.

    Runs of ``_RUN`` values are folded once, so a place costs a run at most and not all that is ahead of it.
    """
    def folded(all_: Column, runs: Column, ahead: Column) -> Column:
        def before(i: Column) -> Column:
            run = F.floor(i / _RUN).cast("int")
            inside = F.slice(all_, run * _RUN + 1, i - run * _RUN)
            return join(F.coalesce(F.get(ahead, run), F.lit(0)), fold(inside))

        return body(before)

    def runs_of(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / _RUN).cast("int")
        places = F.when(F.size(all_) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda j: fold(F.slice(all_, j * _RUN + 1, F.lit(_RUN))))

    return let(values, lambda all_: let(runs_of(all_), lambda runs: let(
        F.transform(runs, lambda _, j: fold(F.slice(runs, F.lit(1), j))), lambda ahead: folded(all_, runs, ahead)
    )))


def _spans(text: Column, pattern: str, kind: int, keep: int | None = None, least: int = 0, said: bool = False) -> Column:
    """array<struct(start, kind, end)> of the matches, leftmost and not overlapping, in code points.

    What lies between the matches is split off by the same pattern; the lengths
    of both give the places. With ``keep`` a match counts only if that group has
    at least ``least`` characters. With ``said`` the structs hold the match too.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    group = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(keep or 0)), lambda g: F.char_length(g))
    parts = F.zip_with(
        F.arrays_zip(found.alias("said"), group.alias("group")), gaps,
        lambda m, g: F.struct(m["said"].alias("said"), m["group"].alias("group"), g.alias("gap"), F.char_length(m["said"]).alias("length")),
    )
    # The last gap has no match behind it.
    matches = F.filter(parts, lambda m: m["said"].isNotNull())

    def placed(m: Column) -> Column:
        return _with_before(
            F.transform(m, lambda x: x["gap"] + x["length"]), _total, lambda a, b: a + b,
            lambda before: F.transform(m, lambda x, i: F.struct(
                (before(i) + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (before(i) + x["gap"] + x["length"]).alias("end"), x["group"].alias("group"), x["said"].alias("said"),
            )),
        )

    kept = F.filter(let(matches, placed), lambda s: s["group"] >= least)
    names = ["start", "kind", "end", *(["said"] if said else [])]
    ended = F.transform(kept, lambda s: F.struct(*[s[n].alias(n) for n in names]))
    none = F.array().cast(f"array<struct<start:int,kind:int,end:int{',said:string' if said else ''}>>")
    return F.when(F.rlike(text, F.lit(pattern)), ended).otherwise(none)


def _rank(values: Column, x: Column) -> Column:
    """How many of the ascending values are below ``x``: a search by halves."""
    turns = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))
    middle = lambda s: F.floor((s["low"] + s["high"]) / 2).cast("int")
    below = lambda s: (s["low"] < s["high"]) & F.coalesce(F.get(values, middle(s)) < x, F.lit(False))
    return F.aggregate(
        turns, F.struct(F.lit(0).alias("low"), F.size(values).alias("high")),
        lambda s, _: F.struct(
            F.when(below(s), middle(s) + 1).otherwise(s["low"]).alias("low"),
            F.when(below(s) | (s["low"] >= s["high"]), s["high"]).otherwise(middle(s)).alias("high"),
        ),
        lambda s: s["low"],
    )


def _apart(tokens: Column, spans: Column) -> Column:
    """The tokens that no span touches: as many spans start before a token's end as end up to its start."""
    starts, ends = (F.array_sort(F.transform(spans, lambda s: s[c])) for c in ("start", "end"))
    free = lambda begun, ended: F.filter(tokens, lambda t: _rank(begun, t["end"]) == _rank(ended, t["start"] + 1))
    return F.when(F.size(spans) == 0, tokens).otherwise(let(starts, lambda begun: let(ends, lambda ended: free(begun, ended))))


def with_base_spans(df: DataFrame, text: str, name: str = "_base") -> DataFrame:
    """Add the spans of the fixed patterns, by start and then kind. NULL counts as empty."""
    plain = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn("_plain", plain).withColumn(name, F.array_sort(F.concat(
        _spans(F.col("_plain"), ASSIGN, 0, keep=2, least=ASSIGN_LENGTH),
        _spans(F.col("_plain"), ACCESS, 1),
        _spans(F.col("_plain"), HEX, 2),
    )))


def encoding(token: Column) -> Column:
    """Name of the encoding that the token's characters suggest; NULL if none does."""
    chosen = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(ENCODINGS.items()):
        chosen = F.when(F.rlike(token, F.lit(pattern)), name).otherwise(chosen)
    return chosen


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z) by its logistic approximation."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def _with(s: Column, kept: str, **more: Column) -> Column:
    """A struct of the named fields of ``s`` and some new ones."""
    return F.struct(*[s[f].alias(f) for f in kept.split()], *[c.alias(n) for n, c in more.items()])


def _kind_shares(symbols: str) -> dict[str, float]:
    """Of a random symbol of the alphabet: sums of squares and cubes of the shares of kinds, share of vowels in letters."""
    kinds = [sum(map(test, symbols)) / len(symbols) for test in (str.isupper, str.islower, str.isdigit)]
    kinds.append(1 - sum(kinds))
    letters = [c for c in symbols if c.isalpha()]
    return {"squares": sum(k ** 2 for k in kinds), "cubes": sum(k ** 3 for k in kinds),
            "vowels": sum(c in _VOWELS for c in letters) / len(letters)}


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_SIGNS = "+/-_"


def _kinds(text: Column) -> Column:
    """Upper and lower case, digits and signs as ``U``, ``l``, ``0`` and what the sign is."""
    return F.translate(text, _UPPER + _LOWER + _DIGITS, "U" * 26 + "l" * 26 + "0" * 10)


def _sounds(text: Column) -> Column:
    """Vowels as ``0``, consonants as ``1``, all else as blanks."""
    letters = _UPPER + _LOWER
    spoken = "".join("0" if c in _VOWELS else "1" for c in letters)
    return F.translate(text, letters + _DIGITS + _SIGNS, spoken + " " * len(_DIGITS + _SIGNS))


def _run_counts(s: Column) -> dict[str, Column]:
    """Runs of ``kinds`` and ``sounds``, and the letters and groups of letters of the latter."""
    runs = lambda t, pattern: F.regexp_count(t, F.lit(pattern)).cast("double")
    return {
        "kind_runs": runs(s["kinds"], "U+|l+|0+|[^Ul0]+"), "sound_runs": runs(s["sounds"], "0+|1+"),
        "spoken": F.char_length(F.replace(s["sounds"], F.lit(" "))).cast("double"),
        "groups": runs(s["sounds"], "[01]+"), "long_groups": runs(s["sounds"], "[01]{2,}"),
    }


def _wording(s: Column) -> Column:
    """How much like words a token looks: near standard normal for random symbols, large for joined words.

    Words keep to one kind of symbols (upper or lower case, digits, signs) for
    longer, and their vowels and consonants take turns more often. Both are
    counted by runs, with the exact mean and variance for independent symbols.
    """
    def share(of: str) -> Column:
        chosen = F.lit(0.5)
        for known, (_, symbols) in ENCODINGS.items():
            chosen = F.when(s["encoding"] == known, _kind_shares(symbols)[of]).otherwise(chosen)
        return chosen

    def z(changes: Column, pairs: Column, triples: Column, once: Column, twice: Column) -> Column:
        var = pairs * once * (1 - once) + 2 * triples * (twice - once * once)
        return F.when(var > 0, (changes - pairs * once) / F.sqrt(var)).otherwise(0.0)

    by_kind = z(s["kind_runs"] - 1, s["n"] - 1, s["n"] - 2, 1 - share("squares"), 1 - 2 * share("squares") + share("cubes"))
    both = share("vowels") * (1 - share("vowels"))
    pairs = s["spoken"] - s["groups"]
    by_sound = z(s["sound_runs"] - s["groups"], pairs, pairs - s["long_groups"], 2 * both, both)
    return (by_sound - by_kind) / math.sqrt(2)


def randomness(tokens: Column) -> Column:
    """array<struct(encoding, length_class, p)> of an array of tokens; small p means not random.

    p is that of the worst of four tests by Sidak's rule, so it is near uniform
    for random tokens of every length: chi-squared of the symbol counts with its
    exact mean and variance for the length, runs above and below the middle of
    the alphabet, runs of kinds of symbols and of vowels (``_wording``), and
    correlation of neighbours. p is NULL without an encoding.
    Each step is a map over the array whose structs hold what the next one needs.
    """
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, x: t + x)
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    tail, head = lambda a: F.slice(a, F.lit(2), F.size(a) - 1), lambda a: F.slice(a, F.lit(1), F.size(a) - 1)

    def alphabet_of(name: Column) -> Column:
        chosen = F.lit("")
        for known, (_, symbols) in ENCODINGS.items():
            chosen = F.when(name == known, symbols).otherwise(chosen)
        return chosen

    named = F.transform(tokens, lambda t: F.struct(encoding(t).alias("encoding"), F.regexp_replace(t, "=+$", "").alias("plain")))
    folded = F.transform(named, lambda s: _with(
        s, "encoding", alphabet=alphabet_of(s["encoding"]),
        text=F.when(s["encoding"] == "base64", F.translate(s["plain"], "-_", "+/"))
        .when(s["encoding"].isin("base32", "letters"), s["plain"]).otherwise(F.lower(s["plain"])),
    ))
    seen = F.transform(folded, lambda s: _with(s, "encoding alphabet text", kinds=_kinds(s["text"]), sounds=_sounds(s["text"])))
    coded = F.transform(seen, lambda s: _with(
        s, "encoding alphabet", **_run_counts(s), n=F.char_length(s["text"]).cast("double"), k=F.char_length(s["alphabet"]).cast("double"),
        x=F.transform(letters(s["text"]), lambda c: (F.instr(s["alphabet"], c) - 1).cast("double")),
        squares=total(F.transform(letters(s["alphabet"]), lambda c: F.pow(
            (F.char_length(s["text"]) - F.char_length(F.replace(s["text"], c))).cast("double"), F.lit(2.0)
        ))),
    ))
    centred = F.transform(coded, lambda s: _with(
        s, "encoding n k squares", wording=_wording(s), half=F.transform(s["x"], lambda v: F.when(v >= s["k"] / 2, 1.0).otherwise(0.0)),
        x=F.transform(s["x"], lambda v: v - total(s["x"]) / s["n"]),
    ))
    summed = F.transform(centred, lambda s: _with(
        s, "encoding wording n k squares", high=total(s["half"]),
        changes=total(F.zip_with(head(s["half"]), tail(s["half"]), lambda u, v: F.abs(u - v))),
        around=total(F.transform(s["x"], lambda v: v * v)),
        along=total(F.zip_with(head(s["x"]), tail(s["x"]), lambda u, v: u * v)),
    ))
    scored = F.transform(summed, lambda s: _with(
        s, "encoding wording n changes around along", both=2 * s["high"] * (s["n"] - s["high"]),
        z_chi=(s["k"] * s["squares"] / s["n"] - s["n"] - (s["k"] - 1)) / F.sqrt(2 * (s["k"] - 1) * (s["n"] - 1) / s["n"]),
    ))
    spread = F.transform(scored, lambda s: _with(
        s, "encoding wording n changes both z_chi", var=s["both"] * (s["both"] - s["n"]) / (s["n"] * s["n"] * (s["n"] - 1)),
        z_serial=F.when(s["around"] > 0, F.abs(s["along"] / s["around"] + 1 / s["n"]) * F.sqrt(s["n"])).otherwise(20.0),
    ))
    tails = F.transform(spread, lambda s: _with(
        s, "encoding n", wording=_upper_tail(s["wording"]), chi=_upper_tail(s["z_chi"]), serial=2 * _upper_tail(s["z_serial"]),
        runs=2 * _upper_tail(
            F.when(s["var"] > 0, F.abs(s["changes"] - s["both"] / s["n"]) / F.sqrt(s["var"])).otherwise(20.0)
        ),
    ))
    return F.transform(tails, lambda s: _with(
        s, "encoding", length_class=F.floor(F.log2(s["n"]) * 2).cast("int"),
        p=F.when(s["encoding"].isNotNull(), 1 - F.pow(1 - F.least(s["chi"], s["serial"], s["runs"], s["wording"], F.lit(1.0)), F.lit(4.0))),
    ))


def thresholds(docs: DataFrame, text: str = "text", bound: float = FALSE_DISCOVERIES) -> dict[tuple[str, int], float]:
    """(encoding, length class) -> least p of the tokens to report.

    Of random tokens as many have p above a half as below, so twice the tokens
    above a half are the random ones, spread evenly; what a threshold lets
    through beyond their share is structured. ``least_steps`` chooses the step.
    Every different token of all whole texts counts once. Only counts for each
    class and step come to the driver: a few hundred numbers at any size.
    """
    tokens = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))).alias("token")).distinct()
    judged = tokens.select(F.explode(randomness(F.array("token"))).alias("t")).where("t.p IS NOT NULL")
    counted = judged.groupBy(
        F.col("t.encoding").alias("encoding"), F.col("t.length_class").alias("length_class"),
        F.least(F.floor(F.col("t.p") * STEPS), F.lit(STEPS - 1)).cast("int").alias("step"),
    ).count().collect()
    held: dict[tuple[str, int], list[int]] = {}
    for r in counted:
        held.setdefault((r["encoding"], r["length_class"]), [0] * STEPS)[r["step"]] += r["count"]
    return least_steps(held, bound)


def _least_step(counts: list[int], bound: float) -> float | None:
    """The least step whose share of structured tokens, less its standard error, is within ``bound``."""
    random = 2 * sum(counts[STEPS // 2:])
    for step in range(1, STEPS):
        above = sum(counts[step:])
        spread = math.sqrt(random) * (1 - step / STEPS)
        if above and above - random * (1 - step / STEPS) - spread <= bound * above:
            return step / STEPS
    return None


def least_steps(held: Mapping[tuple[str, int], list[int]], bound: float = FALSE_DISCOVERIES) -> dict[tuple[str, int], float]:
    """(encoding, length class) -> least p to report, from the counts of the steps of each class.

    A class with ``LEAST_TOKENS`` tokens beyond the first step speaks for
    itself, and reports nothing if no step will do. A smaller one is pooled with
    the nearest length classes of its encoding until there are so many, else
    with all encodings; it gets ``FALLBACK`` if the pool has no step.
    """
    found = {}
    for name, size in held:
        counts = held[name, size]
        pools = sorted({abs(s - size) for n, s in held if n == name}) + [None]
        for reach in pools:
            chosen = [c for (n, s), c in held.items() if reach is None or n == name and abs(s - size) <= reach]
            pooled = [sum(c) for c in zip(*chosen)]
            if sum(pooled[1:]) >= LEAST_TOKENS:
                break
        step = _least_step(pooled, bound) if sum(pooled[1:]) >= LEAST_TOKENS else None
        if step is None and sum(counts[1:]) < LEAST_TOKENS:
            step = FALLBACK
        if step is not None:
            found[name, size] = step
    return found


def with_spans(docs: DataFrame, least_p: Mapping[tuple[str, int], float], text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans``, arrays of struct(start, kind, end).

    ``spans`` holds the base spans and the tokens whose p reaches their class's
    threshold and which no base span touches, by start and then kind.
    """
    based = with_base_spans(docs, text, "base_spans")
    if not least_p:
        return based.withColumn("spans", F.col("base_spans")).drop("_plain")

    def passes(t: Column) -> Column:
        limit = F.lit(None).cast("double")
        for (name, size), p in sorted(least_p.items()):
            limit = F.when((t["encoding"] == name) & (t["length_class"] == size), p).otherwise(limit)
        return F.coalesce(t["p"] >= limit, F.lit(False))

    tokens = _spans(F.col("_plain"), TOKEN, RANDOM, said=True)
    judged = randomness(F.transform("_free", lambda t: t["said"]))
    random = F.transform(
        F.filter("_free", lambda t, i: passes(F.get(F.col("_judged"), i))),
        lambda t: F.struct(*[t[c].alias(c) for c in ("start", "kind", "end")]),
    )
    return (
        based.withColumn("_tokens", tokens).withColumn("_free", _apart(F.col("_tokens"), F.col("base_spans"))).withColumn("_judged", judged)
        .withColumn("spans", F.array_sort(F.concat("base_spans", random)))
        .drop("_plain", "_tokens", "_free", "_judged")
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans`` of every whole text; thresholds come from all of ``docs``.

    NULL and empty texts have none. Repeated rows are judged alike, and a token
    repeated in many texts counts once for the thresholds. Columns of those
    names are replaced; an empty table gives an empty table.
    """
    return with_spans(docs, thresholds(docs, text), text)


def redact(docs: DataFrame, text: str = "text", mask: str = MASK) -> DataFrame:
    """The documents with every secret in ``text`` replaced by ``mask``; touching spans become one.

    Columns stay as they are but for ``text``; NULL stays NULL.
    """
    scanned = scan(docs, text).withColumn("_stretches", F.regexp_extract_all(
        F.coalesce(F.col(text), F.lit("")), F.lit(rf"(?s).{{1,{_STRETCH}}}"), F.lit(0)
    ))

    def cut(start: Column, end: Column) -> Column:
        """The text from ``start`` to ``end``, out of the stretches that hold it."""
        first, last = (F.floor(x / _STRETCH).cast("int") for x in (start, end))
        held = F.array_join(F.slice("_stretches", first + 1, last - first + 1), "")
        return F.substring(held, start - first * _STRETCH + 1, end - start)

    # Ahead of a span everything is written up to the farthest end of those before it.
    kept = _with_before(
        F.transform("spans", lambda s: s["end"]), _greatest, lambda a, b: F.greatest(a, b),
        lambda before: F.transform("spans", lambda s, i: let(before(i), lambda at: F.when(
            (s["end"] > at) & ((s["start"] > at) | (at == 0)), F.concat(cut(at, s["start"]), F.lit(mask))
        ).otherwise(""))),
    )
    end = F.array_max(F.transform("spans", lambda s: s["end"]))
    masked = F.concat(F.array_join(kept, ""), cut(end, F.char_length(text)))
    return scanned.withColumn(text, F.when(F.size("spans") > 0, masked).otherwise(F.col(text))).select(*docs.columns)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )))
