import random

import numpy as np
from pyspark.sql import functions as F

from tallybridge.llm import language_id as L

SYLLABLES = {
    "en": "th ing tion er wh ly and ou".split(),
    "de": "sch ung keit ein pf ü ver zu".split(),
    "fr": "eau ment oi que é aux ier ou".split(),
    "es": "ción ado ar ll mente que ñ os".split(),
    "xx": "kw zq vv ky qo xi ww jj".split(),
}


def texts(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    word = lambda: "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3)))
    return [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(n)]


def rows(n, seed):
    pairs = [(t, lang) for lang in SYLLABLES for t in texts(lang, n, seed)]
    return [(i, t, lang) for i, (t, lang) in enumerate(pairs)]


def test_held_out_accuracy_and_hierarchy(spark, documents):
    model = L.learn(documents(rows(60, "train")))
    assert model["families"] == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    assert {k for k in model["duels"] if k[0] == "lang"} == {("lang", "de", "en"), ("lang", "es", "fr")}
    found = L.predict(documents(rows(40, "test")), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_only_the_text_is_read(spark, documents):
    model = L.learn(documents(rows(40, "train")))
    docs = documents(rows(10, "test"))
    other = docs.select((F.col("doc_id") * 7).alias("doc_id"), "text", F.lit("de").alias("lang"), F.lit(None).cast("string").alias("source"), "n_chars")
    key = lambda df: sorted((r["text"], r["lang_pred"], r["score"]) for r in L.predict(df, model).collect())
    assert key(docs) == key(other)


def test_awkward_rows_and_clashing_names(spark, documents, awkward):
    model = L.learn(documents(rows(30, "train")))
    docs = awkward.withColumns({"score": F.lit("mine"), "Lang_Pred": F.lit(1), "tags": F.array(F.lit("a"))})
    out = L.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "tags", "lang_pred", "score"]
    got = out.collect()
    assert len(got) == 16
    undetermined = {r["text"] for r in got if r["lang_pred"] == "und"}
    assert undetermined == {None, "", " \t\n "}
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert {r["score"] for r in kept.collect()} == {"mine"}


def test_no_labels_and_one_label(spark, documents):
    empty = documents([(1, "text", None)]).where("doc_id < 0")
    model = L.learn(empty)
    assert L.predict(documents([(1, "some text")]), model).first()["lang_pred"] == "und"
    assert L.predict(empty, model).count() == 0
    one = L.learn(documents([(1, "some text", "en"), (2, None, "fr"), (3, "more", None)]))
    assert L.predict(documents([(1, "some text")]), one).first()["lang_pred"] == "en"


def test_sample_is_bounded(spark, documents):
    model = L.learn(documents(rows(50, "train") + [(10_000 + i, "same text again", "en") for i in range(100)]), per_language=20)
    assert model["langs"] == sorted(SYLLABLES)


def test_pieces_of_long_texts_add_up():
    text = " ".join(texts("fr", 30, "long"))
    whole, pieces = L.counts_of(text), L.counts_of(text, 100)
    assert abs(pieces.sum() - whole.sum()) <= 20 * len(text) / 100
    assert (pieces >= whole).all()


def test_clear_documents_are_kept_under_many_labels(spark, documents):
    codes = ["en", "de", "nl", "sv", "fr", "pl", "lt", "cy", "fi", "tr", "hi", "ar", "xx"]
    rng = random.Random(5)
    words = {c: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(12)] for c in codes}
    made = lambda n: [(i, " ".join(rng.choices(words[c], k=30)), c) for i, c in enumerate(codes * n)]
    model = L.learn(documents(made(30)))
    assert len(model["families"]) == 10 and len(model["families"]["germanic"]) == 4
    docs = documents(made(4))
    found = L.predict(docs, model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0.3 <= r["score"] <= 1 for r in found)
    assert L.keep_identified(docs, model).count() == len(found)


def test_coupled_duels_are_chances():
    assert np.allclose(L.coupled(np.array([[0, 0.8], [0.2, 0]])), [0.8, 0.2])
    p = np.array([0.6, 0.25, 0.1, 0.05])
    assert np.allclose(L.coupled(p[:, None] / (p[:, None] + p[None, :])), p)
    sure = np.full((12, 12), 0.5)
    sure[3], sure[:, 3] = 0.999, 0.001
    assert L.coupled(sure).argmax() == 3 and L.coupled(sure).max() > 0.95


def test_sample_counts_different_texts(spark, documents):
    pairs = [("lt", f"alpha labas {i}") for i in range(2)] * 600 + [("lv", "sveiki visi")] * 1200
    pairs += [("en", f"words {i} of english") for i in range(60)] + [("en", "the hot text")] * 500
    docs = documents([(i, t, c) for i, (c, t) in enumerate(pairs)])
    langs, sample = L.sampled(docs.select("text", "lang"), 20)
    rows = [tuple(r) for r in sample.select("lang", "text").collect()]
    assert langs == ["en", "lt", "lv"] and len(rows) == len(set(rows)) and set(rows) <= set(pairs)
    assert {c: sum(r[0] == c for r in rows) for c in langs} == {"en": 20, "lt": 2, "lv": 1}


def test_labels_of_copies_are_predicted(spark, documents):
    # texts that a draw of 20 by counted rows passes over
    late = lambda words: next(
        r["t"]
        for r in spark.range(50).select(F.concat(F.lit(words), F.col("id").cast("string")).alias("t")).orderBy("t").collect()
        if spark.range(1).select(F.pmod(F.xxhash64(F.lit(r["t"])), F.lit(1 << 30)) > (1 << 29)).first()[0]
    )
    pairs = [(late("labas rytas "), "lt")] * 500 + [(late("sveiki visi "), "lv")] * 500
    model = L.learn(documents([(i, t, c) for i, (t, c) in enumerate(pairs)]), per_language=20)
    got = {r["lang"]: r["lang_pred"] for r in L.predict(documents([(i, t, c) for i, (t, c) in enumerate(dict(pairs).items())]), model).collect()}
    assert got == {"lt": "lt", "lv": "lv"}


def test_many_labels_have_a_bounded_model(spark, documents):
    """A dirty column of labels: those with the most texts are learned, all documents are predicted."""
    rng = random.Random(6)
    codes = [f"label{i:02}" for i in range(75)]
    words = {c: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(10)] for c in codes}
    made = lambda n: [(" ".join(rng.choices(words[c], k=25)), c) for i, c in enumerate(codes) for _ in range(n(i))]
    train = made(lambda i: 6 if i < 60 else 3)
    model = L.learn(documents([(i, t, c) for i, (t, c) in enumerate(train)]), max_labels=60)
    assert model["langs"] == codes[:60] and len(model["duels"]) == 60 * 59 // 2
    assert sum(w.nbytes for w, *_ in model["duels"].values()) <= 60 * 59 // 2 * 4 * L.DIMENSIONS
    test = made(lambda i: 1)
    found = L.predict(documents([(i, t, c) for i, (t, c) in enumerate(test)]), model).collect()
    assert len(found) == 75 and {r["lang_pred"] for r in found} <= set(codes[:60])
    assert all(r["lang_pred"] == r["lang"] for r in found if r["lang"] in codes[:60])


def test_large_families_are_bounded(spark, documents):
    """A side of a family duel holds a bounded number of texts, however many languages the family has."""
    codes = [*L.FAMILIES["slavic"], "en"]
    pairs = [(f"{c} word{i} text{i * 7}", c) for c in codes for i in range(20)]
    langs, sample = L.sampled(documents([(i, t, c) for i, (t, c) in enumerate(pairs)]).select("text", "lang"), 20)
    most = -(-L.FAMILY_SHARE * 20 // len(L.FAMILIES["slavic"]))
    kept = sample.where(F.col("lang").isin(*L.FAMILIES["slavic"]) & (F.col("rank") <= most))
    assert len(langs) == 12 and kept.count() == most * 11 <= L.FAMILY_SHARE * 20 + 11
    model = L.learn(documents([(i, t, c) for i, (t, c) in enumerate(pairs)]), per_language=20)
    assert len([d for d in model["duels"] if d[0] == "family"]) == 1


def test_sparse_fit_separates(spark):
    rng = np.random.default_rng(3)
    y = np.where(np.arange(200) % 2, 1, -1)
    at = [np.sort(rng.choice(40, 6, replace=False)) + (100 if s > 0 else 60) for s in y]
    x = [rng.random(6) for _ in y]
    w, b, slope, offset = L.fit_duel(at, x, y)
    margin = np.array([v @ w[i] + b for i, v in zip(at, x)])
    assert w.shape == (L.DIMENSIONS,) and (np.sign(margin) == y).all() and slope > 0
