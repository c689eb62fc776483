"""Language models, fill-in-middle order and tokenizer alignment against plain versions."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogops.llm import alignment, fim, language, queries

ODD = [
    None, "", " ", "a", "a  b", " a", "a ", "\n", "a\n b", "a \n", "x\r\n y\t z", "naïve café", "a▁b", "▁", "<s> </s> <unk> <0x41>",
    "<|endoftext|> a<|endoftext|>", "\U0001f600 \U0001f468‍\U0001f469", "日本語の文。 中文", "a b", "　 c", "é", "don't we'll", "1,234 5", "a" * 300,
    "\x00 b", "tab\there", "same text", "same text", "same text", "﻿x", "½ cup", "ab <P> cd", "<M>",
]


def frame(spark, texts, **more):
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(v) for c, v in more.items()})


# ---- alignment ----

def plain_alignment(texts):
    """Whole texts at once, dictionaries for the counts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer_path())
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    symbols = alignment.byte_symbols()
    linked, counts = [], collections.Counter()
    for text in texts:
        if not text:
            linked.append(None)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            linked.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
        pairs = [(x, y) for x, e in zip(ids_a, ends_a) for y, f in zip(ids_b, ends_b) if e == f]
        counts.update(pairs)
        common = sorted({*ends_a} & {*ends_b})
        groups, low = [], 0
        for end in common:
            side = lambda ids, ends: ",".join(str(i) for i, e in zip(ids, ends) if low < e <= end)  # noqa: E731, B023
            groups.append(side(ids_a, ends_a) + "|" + side(ids_b, ends_b))
            low = end
        linked.append((len(ids_a), len(ids_b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = [
        (0, 0, 0, 0, 0, 0, "") if x is None
        else (*x[:3], len(x[3]), sum(counts[p] == best[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), x[4])
        for x in linked
    ]
    return out, counts


def aligned(spark, df, **names):
    measures, pairs = alignment.align(df, queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model"), **names)
    return measures, pairs


def test_alignment_is_the_plain_one(spark, sf):
    some = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    short = [t[:600] for t in some]
    texts = ODD + short + short[:7]
    expected, counts = plain_alignment(texts)
    measures, pairs = aligned(spark, frame(spark, texts, _text_id="x", n_a=5, _key=1))
    found = [tuple(r)[1:] for r in measures.orderBy("doc_id").collect()]
    assert found == expected
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    assert {(r.a_id, r.b_id): (r.n_links, r.best) for r in pairs.collect()} == {p: (n, n == best[p[1]]) for p, n in counts.items()}


def test_alignment_of_rare_pairs_by_shuffle(spark, monkeypatch):
    texts = [f"word{k % 7} other{k % 3} end" for k in range(40)]
    expected, _ = plain_alignment(texts)
    monkeypatch.setattr(alignment, "FREQUENT", 8)
    measures, _ = aligned(spark, frame(spark, texts))
    assert [tuple(r)[1:] for r in measures.orderBy("doc_id").collect()] == expected


def test_alignment_in_stretches(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["a", "the", " ", "  ", "\n ", " of", "é", "日", ". "]) for _ in range(4000))
    paths = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
    whole = alignment.Aligner(*paths).align([text])[0]
    monkeypatch.setattr(alignment, "STRETCH", 50)
    monkeypatch.setattr(alignment.stretches, "__defaults__", (50,))
    cut = alignment.Aligner(*paths).align([text])[0]
    assert whole[:4] == cut[:4] and whole[4].tolist() == cut[4].tolist() and whole[5].tolist() == cut[5].tolist()
    assert whole[:4] == (*plain_alignment([text])[0][0][:3], plain_alignment([text])[0][0][6])


def test_alignment_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, None)], "n_a long, text string")
    measures, _ = aligned(spark, df, key="n_a")
    assert measures.columns[:2] == ["n_a", "n_a_"]
    assert sorted((r[0] or 0, r[1]) for r in measures.collect()) == [(0, 2), (1, 0), (1, 2)]
    measures, pairs = aligned(spark, df.limit(0), key="n_a")
    assert measures.count() == 0 and pairs.count() == 0


# ---- fill in middle ----

def plain_middle(key, text, form=fim.Form(), seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in (form.prefix, form.suffix, form.middle)) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:i], text[i:j], text[j:]
    if h[3] % 100 < 20:
        return n, "spm", i, j - i, form.suffix + s + form.prefix + p + form.middle + m
    return n, "psm", i, j - i, form.prefix + p + form.suffix + s + form.middle + m


def test_middle_is_the_plain_one_and_comes_back(spark):
    rng = random.Random(1)
    texts = ODD * 3 + ["".join(rng.choice("ab \né日\U0001f600") for _ in range(rng.randrange(3000))) for _ in range(60)]
    out = fim.restore(fim.transform(frame(spark, texts, n=1, output="x")))
    rows = out.orderBy("doc_id").collect()
    assert [tuple(r)[1:6] for r in rows] == [plain_middle(k, t) for k, t in enumerate(texts)]
    assert [r.restored for r in rows] == [t or "" for t in texts]
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [1, 2, 3, 7, 512])
@pytest.mark.parametrize("kind", fim.UNITS)
def test_every_cut_of_every_unit(kind, block):
    texts = ["", "a", " a b", "café au  lait\n\nmore 日本 ", "\n", "x\ny", "   ", "\U0001f600" * 9]
    piece = fim.Piece([t.encode() for t in texts], kind, block)

    def starts(t):
        if kind == "chars":
            return list(range(len(t)))
        if kind == "lines":
            return [k for k in range(len(t)) if k == 0 or t[k - 1] == "\n"]
        return [k for k in range(len(t)) if k == 0 or (t[k] in " \n" and t[k - 1] not in " \n")]

    assert piece.trees.totals()[:, 0].tolist() == [len(starts(t)) for t in texts]
    wanted = [(i, u, c) for i, t in enumerate(texts) for u, c in enumerate([*starts(t), len(t)])]
    at, chars = piece.cut(np.array([w[0] for w in wanted]), np.array([w[1] for w in wanted]))
    assert chars.tolist() == [w[2] for w in wanted]
    assert at.tolist() == [len(texts[i][:c].encode()) for i, _, c in wanted]


def test_middle_markers_and_keys(spark):
    for bad in ({"prefix": ""}, {"prefix": "<S>"}, {"prefix": "aba"}, {"prefix": "<M", "middle": "<M>"}, {"prefix": ">x", "middle": "<M>"}):
        with pytest.raises(ValueError):
            fim.Form(**bad)
    df = spark.createDataFrame([(None, "some text here"), (4, None)], "n long, text string")
    out = fim.transform(df, key="n")
    assert out.columns == ["n", "n_", "form", "prefix_chars", "middle_chars", "output"]
    assert {(r[0], *r[1:]) for r in map(tuple, out.collect())} == {(None, *plain_middle(None, "some text here")), (4, *plain_middle(4, None))}
    assert fim.round_trip_digests(df.limit(0), key="n").count() == 0
    words = fim.restore(fim.transform(df, key="n", units="words", form=fim.Form(plain=0))).where("n = 4 OR n IS NULL")
    assert sorted(r.restored for r in words.collect()) == ["", "some text here"]


# ---- language ----

def plain_kneser_ney(found, order, symbols):
    """Probability of the last character of a string after the others, by dictionaries and recursion."""
    raw = [collections.Counter() for _ in range(order + 1)]
    for w in found:
        s = f"<{w}>"
        for n in range(1, order + 1):
            raw[n].update(s[i:i + n] for i in range(len(s) - n + 1))
    counts = {}
    for n in range(1, order + 1):
        counts[n] = {g: c if n == order or g[0] == "<" else sum(1 for x in raw[n + 1] if x[1:] == g) for g, c in raw[n].items()}
    del counts[1]["<"]

    def p(gram):
        if not gram:
            return 1 / symbols
        own = counts[len(gram)]
        once, twice = (sum(c == k for c in own.values()) for k in (1, 2))
        d = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))
        after = {g: c for g, c in own.items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        return max(own.get(gram, 0) - d, 0) / sum(after.values()) + d * len(after) / sum(after.values()) * p(gram[1:])

    return p, raw


def test_kneser_ney_is_the_plain_one():
    rng = random.Random(5)
    found = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    p, raw = plain_kneser_ney(found, 3, 9)
    model = language.Model({
        n: (np.array([[ord(c) for c in g] for g in raw[n]], np.uint32).reshape(-1, n), np.array(list(raw[n].values())))
        for n in (1, 2, 3)
    }, 9)
    alphabet = sorted(set("".join(found))) + [">"]
    for context in ["", "<", "a", "<a", "ab", "dd", "zz", "<z"]:
        grams = [context + c for c in [*alphabet, "q"]]
        got = np.exp2(model.score(np.array([[ord(c) for c in g] for g in grams], np.uint32)))
        assert np.allclose(got, [p(g) for g in grams], rtol=1e-5)
        # With the alphabet of nine symbols, of which six occur, the seen and three unseen ones sum to one.
        assert math.isclose(got[:-1].sum() + 3 * got[-1], 1, rel_tol=1e-5)


def test_words_are_runs_of_letters(monkeypatch):
    text = "Don't STOP½ a½b 3x_y 日本 İ"
    expected = ["don", "t", "stop", "a", "b", "x", "y", "日本", "i"]
    assert [w for part in language.words(text) for w in part][:9] == expected
    monkeypatch.setattr(language, "STRETCH", 3)
    assert [w for part in language.words(text) for w in part][:9] == expected


@pytest.fixture(scope="module")
def labelled(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    return docs.withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 4 == 2).cache()


def test_held_out_accuracy_and_score(spark, labelled):
    models = language.fit(labelled.where("NOT held"))
    assert models.languages == ["de", "en", "es", "fr"]
    judged = language.predict(labelled.where("held").withColumns({"score": F.lit("x"), "_text": F.lit(1)}), models)
    rows = judged.collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.accepted for r in rows) >= 0.97 * len(rows)
    again = {r.doc_id: r for r in language.predict(labelled.where("held").repartition(7), language.fit(labelled.where("NOT held").repartition(5))).collect()}
    assert all(again[r.doc_id].lang_pred == r.lang_pred and math.isclose(again[r.doc_id].score, r.score, rel_tol=1e-6, abs_tol=1e-9) for r in rows)


def test_unlearned_languages_are_rejected(spark, labelled):
    models = language.fit(labelled.where("NOT held AND lang <> 'es'"))
    rows = language.predict(labelled.where("held"), models).collect()
    known = [r.accepted for r in rows if r.lang != "es"]
    unknown = [r.accepted for r in rows if r.lang == "es"]
    assert sum(known) >= 0.95 * len(known) and sum(unknown) <= 0.1 * len(unknown)


def test_language_edge_cases(spark):
    rows = [("ja nein und aber doch", "de"), ("yes no and but still", "en"), (None, "en"), ("oui non et mais", None), ("", "en"), ("12 !", "en")]
    models = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert models.languages == ["de", "en"]
    texts = [None, "", "123 ...", "½", "und doch", "and still", "and still", "日本語", "no " * 400_000]
    got = language.predict(frame(spark, texts, lang="x"), models).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got[:7]] == ["und"] * 4 + ["de", "en", "en"]
    assert [r.score for r in got[:4]] == [0.0] * 4 and got[0].cross_entropy is None and not got[0].accepted
    assert got[7].lang_pred in {"de", "en"} and got[8].lang_pred == "en"
    assert language.fit(spark.createDataFrame(rows, "text string, lang string").limit(0)) is None
    nothing = language.predict(frame(spark, ["a"]), None).collect()
    assert nothing[0].lang_pred == "und"
    assert language.predict(frame(spark, ["a"]).limit(0), models).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_CHARS", 20_000)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(300)) for _ in range(200)]
    df = spark.createDataFrame([(t, "aa") for t in texts], "_text string, _lang string")
    taken = language.sample(df).agg(F.sum(F.length("_block"))).first()[0]
    assert 10_000 < taken < 30_000
    # Copies are one block.
    assert language.sample(spark.createDataFrame([(texts[0][:100], "aa")] * 50, "_text string, _lang string")).count() == 1
