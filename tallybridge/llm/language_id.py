"""Language identification in two steps: the language family first, then the language within it.

Both steps are linear support vector machines on hashed byte n-grams, one against one. The duels
between families see one class per family; the duels between languages see only their family.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import in_fold, keep_rows, map_text, staged, table

# Families of languages by ISO 639-1 code. Any other label is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

#: Buckets of the hashed n-grams.
DIMENSIONS = 8192
#: At most so many labelled texts of each language are learned from (a documented bound of the classifier's sample).
PER_LANGUAGE = 500
#: A family's side of a duel has at most so many times that number of texts, dealt evenly to its languages.
FAMILY_SHARE = 4
#: At most so many labels are learned, those with the most different texts: duels grow with their square, and 64 labels
#: make a model of 66 MB at most, which is what is collected and broadcast.
MAX_LABELS = 64
UNDETERMINED = "und"

_FOLDED = np.full(256, 32, np.uint8)
for _b in itertools.chain(range(97, 123), range(128, 256)):
    _FOLDED[_b] = _b
_MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


def counts_of(text: str, chars: int = 1 << 20) -> np.ndarray:
    """Hashed counts of the n-grams of 1 to 4 bytes of the whole lower-cased text; anything but letters is blank."""
    total = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(text), chars):
        piece = text[max(0, at - 3) : at + chars].lower().encode("utf-8", "surrogatepass")
        b = _FOLDED[np.frombuffer(piece, np.uint8)].astype(np.uint32)
        h = np.zeros(len(b), np.uint32)
        for n in range(min(4, len(b))):
            h = h[: len(b) - n] * _MULTIPLIERS[n] + b[n:]
            total += np.bincount((h * np.uint32(2654435769)) >> np.uint32(32 - 13), minlength=DIMENSIONS)
    return total


def features_of(text: str) -> np.ndarray:
    """Square roots of the counts at unit length: frequent n-grams don't drown the others, nor long texts short ones."""
    x = np.sqrt(counts_of(text))
    return x / max(np.sqrt((x * x).sum()), 1e-9)


def fit_duel(at: list[np.ndarray], x: list[np.ndarray], y: np.ndarray, c: float = 10.0, epochs: int = 30) -> tuple[np.ndarray, float, float, float]:
    """Linear SVM with squared hinge loss by dual coordinate descent, classes weighted alike; then Platt's sigmoid.

    Row ``i`` has the values ``x[i]`` in the places ``at[i]``, and is held as that. Returns weights, intercept, slope and offset: the
    chance of class +1 is sigmoid(slope * margin + offset).
    """
    at = [np.append(i, DIMENSIONS) for i in at]  # the intercept
    x = [np.append(v, 1.0).astype(float) for v in x]
    share = {s: max(1, (y == s).sum()) / len(y) for s in (-1, 1)}
    diagonal = np.array([share[int(s)] / c for s in y])
    squares = np.array([(v * v).sum() for v in x]) + diagonal
    w, alpha = np.zeros(DIMENSIONS + 1), np.zeros(len(x))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(x)):
            step = (1 - y[i] * (x[i] @ w[at[i]]) - diagonal[i] * alpha[i]) / squares[i]
            new = max(0.0, alpha[i] + step)
            if new != alpha[i]:
                w[at[i]] += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    margin = np.array([v @ w[i] for i, v in zip(at, x)])
    target = np.where(y > 0, (max(1, (y > 0).sum()) + 1) / (max(1, (y > 0).sum()) + 2), 1 / ((y < 0).sum() + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * slope, (p - target).sum()])
        r = p * (1 - p) + 1e-9
        h = np.array([[(r * margin * margin).sum() + 1e-3, (r * margin).sum()], [(r * margin).sum(), r.sum() + 1e-6]])
        d = np.linalg.solve(h, g)
        slope, offset = slope - d[0], offset - d[1]
        if np.abs(d).max() < 1e-6:
            break
    return w[:-1], float(w[-1]), max(float(slope), 0.1), float(offset)


def sampled(rows: DataFrame, per_language: int, max_labels: int = MAX_LABELS) -> tuple[list[str], DataFrame]:
    """The labels of ``rows`` (text, lang) that are learned, and (lang, text, rank) of at most ``per_language`` different
    texts of each, at least one.

    Copies of a text under a label count once. Texts are picked by a hash; they are read again only for the hashes picked. Of
    more than ``max_labels`` labels those with the most different texts are taken, ties in the order of their names.
    """
    keys = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    keys = staged(keys.withColumn("pick", F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))), "labelled-texts")
    sizes = keys.groupBy("lang").agg(F.count("*").alias("n"), F.min("pick").alias("least"))
    sizes = staged(sizes.orderBy(F.desc("n"), "lang").limit(max_labels), "labels")
    langs = sorted(r["lang"] for r in sizes.collect())
    order = Window.partitionBy("lang").orderBy("pick", "h")
    picked = (
        keys.join(F.broadcast(sizes), "lang")  # a row for each label
        .where((F.col("pick") * F.col("n") < 1.5 * per_language + 20) | (F.col("pick") == F.col("least")))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_language)
        .select("lang", "h", "rank")
    )
    rows = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(picked), ["lang", "h"])
    return langs, rows.groupBy("lang", "h").agg(F.min("text").alias("text"), F.min("rank").alias("rank")).drop("h")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, max_labels: int = MAX_LABELS) -> dict:
    """Learn the duels from labelled rows; rows without text or label are passed over.

    The sample is at most ``per_language`` different texts of each label, picked by a hash of the text; a duel between
    families has at most ``FAMILY_SHARE`` times as many of each. Each duel is fitted by a task of its own. Labels beyond ``max_labels``
    are not learned, so a column of many labels neither ends the job nor outgrows the driver.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    langs, sample = sampled(rows, per_language, max_labels)
    model = {"langs": langs, "families": {}, "duels": {}}
    for code in langs:
        model["families"].setdefault(FAMILY_OF.get(code, code), []).append(code)
    duels = [("family", a, b) for a, b in itertools.combinations(sorted(model["families"]), 2)]
    duels += [("lang", a, b) for codes in model["families"].values() for a, b in itertools.combinations(codes, 2)]
    if not duels:
        return model

    def features() -> Callable:
        def of(texts: list) -> dict:
            dense = [features_of(t) for t in texts]
            at = [np.flatnonzero(x) for x in dense]
            return {"at": [i.astype(np.int32) for i in at], "x": [x[i].astype(np.float32) for x, i in zip(dense, at)]}

        return of

    sides = []
    for code in langs:
        family = FAMILY_OF.get(code, code)
        for kind, a, b in duels:
            name = family if kind == "family" else code
            if name in (a, b):
                most = per_language if kind == "lang" else -(-FAMILY_SHARE * per_language // len(model["families"][family]))
                sides.append((code, json.dumps([kind, a, b]), 1 if name == a else -1, most))
    spark = docs.sparkSession
    sides = spark.createDataFrame(sides, "lang string, duel string, y int, most int")
    seen = map_text(sample, "text", "at array<int>, x array<float>", features, carry=["lang", "rank"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        w, b, slope, offset = fit_duel(list(rows["at"]), list(rows["x"]), rows["y"].to_numpy())
        return pd.DataFrame([{"duel": rows["duel"].iloc[0], "w": w.astype(np.float32), "b": b, "slope": slope, "offset": offset}])

    fitted = (
        seen.join(F.broadcast(sides), "lang")  # a row for each label and duel
        .where("rank <= most")
        .select("duel", "y", "at", "x")
        .groupBy("duel")
        .applyInPandas(fit, "duel string, w array<float>, b double, slope double, offset double")
    )
    for r in fitted.collect():
        model["duels"][tuple(json.loads(r["duel"]))] = (np.array(r["w"], np.float32), r["b"], r["slope"], r["offset"])
    return model


def coupled(chances: np.ndarray) -> np.ndarray:
    """One distribution from pairwise chances (``chances[i, j]``: i against j), by the second pairwise coupling of Wu, Lin
    and Weng: the p with least sum of (chances[j, i] p[i] - chances[i, j] p[j])**2. A certain winner gets about 1, however many names."""
    k = len(chances)
    chances = np.where(np.eye(k, dtype=bool), 0.0, chances)
    q = -chances.T * chances
    q[np.diag_indices(k)] = (chances * chances).sum(0)
    system = np.ones((k + 1, k + 1))
    system[:k, :k], system[k, k] = q, 0.0
    p = np.clip(np.linalg.solve(system, np.append(np.zeros(k), 1.0))[:k], 0.0, 1.0)
    return np.round(p / p.sum(), 12)  # rounded, so that ties are ties


def _shares(x: np.ndarray, kind: str, names: list[str], duels: dict) -> np.ndarray:
    """Chance of each name: its duels, coupled."""
    if len(names) == 1:
        return np.ones(1)
    chances = np.zeros((len(names), len(names)))
    for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
        w, intercept, slope, offset = duels[kind, a, b]
        p = 1 / (1 + np.exp(-np.clip(slope * (x @ w + intercept) + offset, -15, 15)))
        chances[i, j], chances[j, i] = p, 1 - p
    return coupled(chances)


def judge_of(spark: SparkSession, model: dict) -> Callable:
    """A factory, for use in tasks, of a function from a text to its label and score."""
    families = sorted(model["families"])
    shared = spark.sparkContext.broadcast(model)  # bounded by MAX_LABELS

    def make() -> Callable:
        import regex

        letter, m = regex.compile(r"\p{L}"), shared.value

        def one(value: str | None) -> tuple[str, float]:
            if value is None or not families or not letter.search(value):
                return UNDETERMINED, 0.0
            x = features_of(value).astype(np.float32)
            of_family = _shares(x, "family", families, m["duels"])
            best = int(of_family.argmax())
            codes = m["families"][families[best]]
            of_code = _shares(x, "lang", codes, m["duels"])
            return codes[int(of_code.argmax())], float(of_family[best] * of_code.max())

        return one

    return make


def predict(docs: DataFrame, model: dict, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (chance of the family times that of the language in it) to every row.

    A null text, one without any letter, and every text under a model without labels are ``und`` with score 0.
    Ties go to the name that sorts first. Columns named like the two are replaced.
    """
    judge = judge_of(docs.sparkSession, model)

    def make() -> Callable:
        one = judge()

        def of(texts: list) -> dict:
            out = [one(t) for t in texts]
            return {"lang_pred": [o[0] for o in out], "score": [o[1] for o in out]}

        return of

    return map_text(docs, text, "lang_pred string, score double", make, carry)


#: A document is kept if its language is determined with at least this chance.
KEEP_SCORE = 0.3


def keep_identified(docs: DataFrame, model: dict, least: float = KEEP_SCORE) -> DataFrame:
    """The rows of ``docs``, columns as they are, whose language is determined with a chance of ``least`` or more."""
    judge = judge_of(docs.sparkSession, model)

    def make() -> Callable:
        one = judge()

        def passes(value: str | None) -> bool:
            code, score = one(value)
            return code != UNDETERMINED and score >= least

        return passes

    return keep_rows(docs, "text", make)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from labelled documents outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = learn(docs.where(~held_out))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return predict(rows, model, carry=["doc_id", "held_out"])
