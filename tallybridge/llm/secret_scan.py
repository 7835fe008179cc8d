"""Secret scans: candidates by shape, and a random forest that removes the false ones, in built-in functions only.

Every run of 16 or more characters that keys are made of is a candidate. The forest judges it by its
length, the transitions between its kinds of characters, how much of it the corpus' own dictionary covers, the
path of its document and the words around it. It is trained on labelled findings; where nobody has reviewed any,
what assigns or announces a candidate labels it, and that evidence is no feature. Each candidate is then judged
by a forest that has learned from other strings. Strings in a format that
an issuer marks as its own (a fixed prefix and length) are secrets whatever the forest says and whatever is
around them, unless they are a placeholder themselves. Such a string inside a run is a candidate of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import staged, table

# Characters of keys, words that announce one, words of placeholders, paths of test material, marked formats.
CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
ANNOUNCES = r"(?i)token|secret|passw|pwd|api.?key|access.?key|auth|bearer|credential|private.?key"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[-_]|xxxx|<.*>"
TEST_PATH = r"(?i)(^|[/_.\-])(tests?|examples?|samples?|fixtures?|mocks?|docs?)([/_.\-]|$)"
MARKED = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_\w{22,}|sk_live_[0-9A-Za-z]{24,}|xox[abprs]-[0-9A-Za-z\-]{20,}|AIza[0-9A-Za-z_\-]{35}|glpat-[0-9A-Za-z_\-]{20})(?![A-Za-z0-9])"
#: Of the text before a candidate in its word, so many characters are looked at, after the last mark between fields and the last tag.
LEAD = 120
FIELDS = r"(?s)^.*(?:[,;{}&]|<[^<>]*>)"
_EDGE = "\x1f"
WORD = r"[^\x20\x09-\x0D]+"

#: What the forest sees. ``words`` are numbers of buckets, which it sees as one count for each bucket. The other columns of a
#: candidate (announced, assigned, quoted, placeholder) are evidence for labels and no features.
FEATURES = ["length", "digits", "uppers", "symbols", "distinct", "transitions", "vowel_turns", "coverage", "test_path", "slashes", "words"]
#: Neighbouring words are hashed into so many buckets; so many words before and after a candidate are neighbours.
WORD_BUCKETS, WORDS_BEFORE, WORDS_AFTER = 128, 4, 2
#: Candidates are dealt by a checksum to so many folds, and each fold is judged by what was learned from the others.
FOLDS = 2
#: A dictionary word is in the corpus at least so many times, has no more letters than this, and stands alone.
DICTIONARY_COUNT, DICTIONARY_LETTERS = 5, 24
#: At most so many labelled findings of each class are learned from (a documented bound of the classifier's sample).
PER_CLASS = 2000
TREES, DEPTH, SEED = 24, 8, 11
#: The secrets of all documents are broadcast up to so many bytes in total, and joined by shuffle beyond.
BROADCAST_BYTES = 32_000_000
REDACTED = "<secret>"


def candidates(docs: DataFrame, carry: list[str], text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: the columns ``carry``, ``word`` (number of its word from 0), ``candidate`` and all
    features but ``coverage``. Null and empty texts have none; a null path is an empty one."""
    words = F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")
    long = lambda w, i: (F.length(F.get(w, i)) >= 16) & F.get(w, i).rlike(CANDIDATE)
    around = lambda w, i: F.struct(
        i.alias("word"),
        F.get(w, i).alias("w"),
        F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)).alias("before"),
        F.coalesce(F.get(w, i + 1), F.lit("")).alias("after"),
        F.concat(
            F.slice(w, F.greatest(i - WORDS_BEFORE, F.lit(0)) + 1, F.least(i, F.lit(WORDS_BEFORE))),
            F.slice(w, i + 2, F.lit(WORDS_AFTER)),
        ).alias("beside"),
    )
    found = F.transform(
        F.array(words),
        lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: long(w, i)), lambda i: around(w, i)),
    )
    rows = docs.select(*carry, F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.explode(F.flatten(found)).alias("f"))
    apart = F.regexp_replace("w", F.lit(f"({MARKED})"), F.lit(f"{_EDGE}$1{_EDGE}"))
    rows = rows.select(*carry, "path", "f.*").withColumn("w", F.when(F.col("w").rlike(MARKED), apart).otherwise(F.col("w")))
    # gaps[i] is the text between the candidates i - 1 and i
    rows = rows.withColumns({"runs": F.regexp_extract_all("w", F.lit(CANDIDATE), F.lit(0)), "gaps": F.split("w", CANDIDATE, -1)})
    near = lambda i: F.right(F.concat(F.coalesce(F.get("gaps", i - 1), F.lit("")), F.coalesce(F.get("runs", i - 1), F.lit("")), F.get("gaps", i)), F.lit(LEAD + 1))
    placed = F.transform("runs", lambda c, i: F.struct(c.alias("candidate"), i.alias("i"), F.translate(near(i), _EDGE, "").alias("near")))
    rows = rows.withColumn("c", F.explode(placed)).select(*carry, "path", "word", "before", "after", "beside", "c.*")
    field = F.regexp_replace("near", FIELDS, "")
    first = (F.col("i") <= 1) & (F.length("near") <= LEAD) & (F.length("field") == F.length("near"))
    rows = rows.withColumn("field", F.right(field, F.lit(LEAD)))
    rows = rows.withColumn("lead", F.when(first, F.concat("before", F.lit(" "), "field")).otherwise(F.col("field")))
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    lead = F.col("lead")
    return rows.select(
        *carry,
        "word",
        "candidate",
        n.cast("double").alias("length"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("uppers"),
        share("[^A-Za-z0-9]").alias("symbols"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct"),
        share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]").alias("transitions"),
        share("(?i)(?<=[aeiou])[b-df-hj-np-tv-z]|(?<=[b-df-hj-np-tv-z])[aeiou]").alias("vowel_turns"),
        F.col("path").rlike(TEST_PATH).cast("double").alias("test_path"),
        (F.regexp_count(c, F.lit("/")) / n).alias("slashes"),
        lead.rlike(ANNOUNCES).cast("double").alias("announced"),
        lead.rlike("[=:][\"'`(\\[]*$|[=:] *[\"'`(\\[]*$").cast("double").alias("assigned"),
        lead.rlike("[\"'`]$").cast("double").alias("quoted"),
        (lead.rlike(PLACEHOLDER) | c.rlike(PLACEHOLDER) | F.col("after").rlike(PLACEHOLDER)).cast("double").alias("placeholder"),
        _buckets(F.concat("beside", F.regexp_extract_all(F.col("field"), F.lit("[A-Za-z]{2,}"), F.lit(0)))).alias("words"),
    )


def _buckets(words: Column) -> Column:
    """The buckets of words by their letters. Words that announce a key or a placeholder are left out, as they decide labels."""
    letters = F.transform(words, lambda x: F.regexp_replace(F.lower(x), r"[^\p{L}]+", ""))
    told = F.filter(F.arrays_zip(letters.alias("letters"), words.alias("whole")), lambda x: (F.length(x["letters"]) >= 2) & ~x["whole"].rlike(ANNOUNCES) & ~x["whole"].rlike(PLACEHOLDER))
    return F.transform(told, lambda x: F.pmod(F.xxhash64(x["letters"]), F.lit(WORD_BUCKETS)).cast("int"))


def _pieces(candidate: Column) -> Column:
    return F.regexp_extract_all(F.lower(candidate), F.lit("[a-z]{3,}"), F.lit(0))


def covered(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with ``coverage``: the share of a candidate's characters in letter runs that are dictionary words.

    The dictionary is counted over all texts, and only asked for the runs that occur in candidates; each distinct
    candidate is worked out once.
    """
    runs = found.select("candidate").distinct().select("candidate", F.explode(_pieces(F.col("candidate"))).alias("run"))
    runs = runs.where(F.length("run") <= DICTIONARY_LETTERS)
    spoken = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D.,;:!?]+")).alias("run"))
    spoken = spoken.where(F.length("run").between(3, DICTIONARY_LETTERS)).groupBy("run").count()
    spoken = spoken.where(F.col("count") >= DICTIONARY_COUNT).select("run")
    known = runs.join(spoken, "run").groupBy("candidate").agg(F.sum(F.length("run")).alias("letters"))
    known = known.select("candidate", (F.col("letters") / F.length("candidate")).alias("coverage"))
    return found.join(known, "candidate", "left").na.fill(0.0, ["coverage"])


def marked() -> Column:
    """Whether the candidate is in a format that its issuer marks, and no placeholder itself."""
    return F.col("candidate").rlike(f"^{MARKED}$") & ~F.col("candidate").rlike(PLACEHOLDER)


def weak_label() -> Column:
    """A label for findings that nobody has reviewed, from evidence that is no feature: true for a string that is assigned to
    a name that announces a key; false for a placeholder, and for what is neither assigned nor announced; else null. Marked
    formats, which are settled without the forest, have none."""
    announced, assigned = F.col("announced") == 1, F.col("assigned") == 1
    label = F.when(F.col("placeholder") == 1, 0.0).when(announced & assigned, 1.0).when(~announced & ~assigned, 0.0)
    return F.when(~marked(), label)


def fold() -> Column:
    """The fold of a candidate: all copies of a string are in one."""
    return F.pmod(F.crc32(F.col("candidate").cast("binary")), F.lit(FOLDS)).cast("int")


def _vectors(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with the vector ``name`` of all features, a count for each bucket of neighbouring words."""
    counts = F.transform(F.sequence(F.lit(0), F.lit(WORD_BUCKETS - 1)), lambda b: F.size(F.filter("words", lambda x: x == b)).cast("double"))
    rows = rows.withColumn("__counts", array_to_vector(counts))
    plain = [f for f in FEATURES if f != "words"]
    return VectorAssembler(inputCols=[*plain, "__counts"], outputCol=name).transform(rows).drop("__counts")


def sampled(findings: DataFrame, label: str, per_class: int) -> DataFrame:
    """Label and ``FEATURES`` of at most ``per_class`` different findings (candidate and features) of each class."""
    order = [F.xxhash64("candidate", *FEATURES), F.col("candidate")]
    one = findings.select(F.col(label).cast("double").alias("label"), "candidate", *FEATURES).where("label in (0, 1)").distinct()
    classes = [one.where(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0.0, 1.0)]
    return classes[0].unionByName(classes[1]).select("label", *FEATURES)


def train(findings: DataFrame, label: str = "label", per_class: int = PER_CLASS) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (``FEATURES`` and a label of 0 or 1; null labels are passed over).

    The sample is bounded: the ``per_class`` different findings of each class that hash lowest; copies of a finding
    count once. Both classes weigh the same. Without both there is no model.
    """
    sample = staged(sampled(findings, label, per_class), "labelled")
    sizes = dict(sample.groupBy("label").count().collect())
    if len(sizes) < 2:
        return None
    weight = F.when(F.col("label") == 1, 0.5 / sizes[1.0]).otherwise(0.5 / sizes[0.0]) * sum(sizes.values())
    sample = _vectors(sample.withColumn("weight", weight), "features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", weightCol="weight")
    return forest.fit(sample.coalesce(1))


def judged(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` with ``probability`` of being a secret: the forest's, 1 for marked formats. Without a model only those count."""
    if model is None:
        return found.withColumn("probability", marked().cast("double"))
    rows = _vectors(found, "__features")
    model.setFeaturesCol("__features").setProbabilityCol("__probability").setRawPredictionCol("").setPredictionCol("")
    rows = model.transform(rows)
    forest = vector_to_array("__probability")[1]
    return rows.withColumn("probability", F.when(marked(), 1.0).otherwise(forest)).drop("__features", "__probability")


def judged_across(found: DataFrame, label: str = "label") -> DataFrame:
    """``found`` with ``probability``, each fold judged by the forest that the labelled findings of the other folds train.

    Where those lack a class, the findings of all folds train it; where these do too, only marked formats count. A string
    that is a placeholder itself, which no other string can teach, is settled by that.
    """
    folds = found.withColumn("__fold", fold())
    models = [train(folds.where(F.col("__fold") != k), label) for k in range(FOLDS)]
    if None in models:
        whole = train(found, label)
        models = [model or whole for model in models]
    rows = [judged(folds.where(F.col("__fold") == k).drop("__fold"), model) for k, model in enumerate(models)]
    return reduce(DataFrame.unionByName, rows).withColumn("probability", F.when(F.col("candidate").rlike(PLACEHOLDER), 0.0).otherwise(F.col("probability")))


def scan(docs: DataFrame, carry: list[str], labelled: DataFrame | None = None, least: float = 0.5, text: str = "text", path: str = "source") -> DataFrame:
    """The secrets of ``docs``: ``carry``, word, candidate, probability, for candidates of probability ``least`` or more.

    ``labelled`` are reviewed findings (``candidate``, ``FEATURES``, ``label``); without them the corpus' own candidates are
    labelled by ``weak_label`` and judged across folds. Repeated rows have repeated findings.
    """
    found = staged(candidates(docs, carry, text, path), "candidates")
    found = staged(covered(found, docs, text), "findings")
    if labelled is None:
        rows = judged_across(found.withColumn("__label", weak_label()), "__label")
    else:
        rows = judged(found, train(labelled))
    return rows.where(F.col("probability") >= least).select(*carry, "word", "candidate", "probability")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, columns as they are, with every secret replaced by ``<secret>`` and n_chars counted again.

    Documents without a secret are unchanged. A document is named by a hash of its columns: equal rows have equal secrets.
    """
    whole = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant", "void"))])
    rows = docs.withColumn("__row", whole)
    secrets = scan(rows, ["__row"], text=text).groupBy("__row").agg(F.collect_set("candidate").alias("__secrets"))
    secrets = staged(secrets, "secrets")
    size = F.sum(16 + F.aggregate("__secrets", F.lit(0), lambda n, s: n + 16 + F.octet_length(s)))
    if (secrets.agg(size).first()[0] or 0) <= BROADCAST_BYTES:
        secrets = F.broadcast(secrets)
    longest = F.array_sort(F.col("__secrets"), lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(longest, F.col(text), lambda rest, secret: F.replace(rest, secret, F.lit(REDACTED)))
    rows = rows.join(secrets, "__row", "left").withColumn(text, F.when(F.col("__secrets").isNull(), F.col(text)).otherwise(clean))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("__secrets").isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in all documents: doc_id, number of the word, the string and its probability."""
    return scan(table(spark, sf_dir, "documents"), ["doc_id"])
