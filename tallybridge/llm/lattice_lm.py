"""Language-model scores from a subword lattice: the probability of a text over all its segmentations.

The model draws pieces of an existing vocabulary one after another until an end piece. A text's probability is the sum
over every way to cut its words into pieces, by a forward recursion in log space. Pieces do not reach over
white space, so the sum over a text's segmentations is the product of its words' sums, and each distinct
word is worked out once. The vocabulary's own scores are the prior of the pieces' weights (its scores are
ranks, taken as a Zipf law); rounds of expectation-maximisation over all training words re-estimate them.

Texts move neither through the driver nor through a shuffle. One pass turns them into bags of words against the
dictionary of their chunk; dictionary entries meet the corpus counts by a join on the word, and the chunk again by its
number. A word that is in a third of all texts has one entry in each chunk.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import SLICE, in_fold, pa_type, staged, table, word_blocks

#: A chunk's dictionary and bags are held in a task; it ends after so many words.
CHUNK_WORDS = 2_000_000
#: Rounds of expectation-maximisation, and the weight of the prior in pieces.
ROUNDS = 2
PRIOR_WEIGHT = 1000.0
#: For re-estimation only, longer words are taken in parts of so many characters.
PART = 4096
#: Rows of a dictionary entry table.
ENTRY_ROWS = 50_000
#: Expected counts are summed as integers of this fraction, so that no order of summing changes a score.
UNIT = 1e-6
START = "▁"


def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces that lower-cased words can hold, byte pieces and the end, with natural-log prior weights from the file's scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scored = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            scored.append((-1e9, piece))
        elif model.is_control(i) or model.is_unknown(i) or (START in piece[1:]) or piece == START * len(piece) != START:
            continue
        elif not any("A" <= c <= "Z" for c in piece):
            scored.append((model.get_score(i), piece))
    scored.sort(key=lambda s: (-s[0], s[1]))
    pieces = ["</s>"] + [p for _, p in scored]
    weights = 1.0 / (np.arange(len(pieces)) + 10.0)
    return pieces, np.log(weights / weights.sum())


class Lattice:
    """Sums over the segmentations of words under given weights of the pieces (natural logs)."""

    def __init__(self, pieces: list[str], logs: np.ndarray):
        self.logs = logs.tolist()
        self.root: dict = {}
        self.bytes: dict[int, int] = {}
        self.longest = 1
        for k, piece in enumerate(pieces):
            if k == 0:
                continue
            if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
                self.bytes[int(piece[3:5], 16)] = k
                continue
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = k
            self.longest = max(self.longest, len(piece))

    def _spelled(self, c: str) -> list[int]:
        """The byte pieces of a character that no piece spells."""
        return [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]

    def log_sum(self, word: str) -> float:
        """Log of the summed probability of all segmentations; needs memory for the longest piece only."""
        text, root, logs, longest = START + word, self.root, self.logs, self.longest
        size = longest + 1
        ahead: list = [None] * size
        ahead[0] = 0.0
        log1p, exp, n = math.log1p, math.exp, len(text)
        for i in range(n):
            here = ahead[i % size]
            ahead[i % size] = None
            if here is None:
                continue
            node, whole = root, False
            for j in range(i, n):
                node = node.get(text[j])
                if node is None:
                    break
                k = node.get("")
                if k is not None:
                    whole = whole or j == i
                    v, at = here + logs[k], (j + 1) % size
                    a = ahead[at]
                    ahead[at] = v if a is None else (a + log1p(exp(v - a)) if a > v else v + log1p(exp(a - v)))
            if not whole:
                v, at = here + sum(logs[k] for k in self._spelled(text[i])), (i + 1) % size
                a = ahead[at]
                ahead[at] = v if a is None else (a + log1p(exp(v - a)) if a > v else v + log1p(exp(a - v)))
        return ahead[n % size]

    def expect(self, text: str, weight: float, into: list[float]) -> None:
        """Add the expected uses of each piece in ``text`` (forward and backward sums), times ``weight``."""
        root, logs, n = self.root, self.logs, len(text)
        arcs = []
        ahead: list = [None] * (n + 1)
        ahead[0] = 0.0
        log1p, exp = math.log1p, math.exp
        for i in range(n):
            here = ahead[i]
            if here is None:
                continue
            node, whole = root, False
            for j in range(i, n):
                node = node.get(text[j])
                if node is None:
                    break
                k = node.get("")
                if k is not None:
                    whole = whole or j == i
                    v, a = here + logs[k], ahead[j + 1]
                    arcs.append((i, j + 1, logs[k], k))
                    ahead[j + 1] = v if a is None else (a + log1p(exp(v - a)) if a > v else v + log1p(exp(a - v)))
            if not whole:
                spelled = tuple(self._spelled(text[i]))
                cost = sum(logs[k] for k in spelled)
                v, a = here + cost, ahead[i + 1]
                arcs.append((i, i + 1, cost, spelled))
                ahead[i + 1] = v if a is None else (a + log1p(exp(v - a)) if a > v else v + log1p(exp(a - v)))
        back: list = [0.0] * (n + 1)
        back[n] = weight
        # in probabilities relative to the forward sum: each position gives its share back along its arcs
        for i, j, cost, k in reversed(arcs):
            share = back[j] * exp(ahead[i] + cost - ahead[j])
            back[i] += share
            if type(k) is tuple:
                for b in k:
                    into[b] += share
            else:
                into[k] += share


def bags(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Rows (doc_id, text, held_out) as bags of words against the dictionary of their chunk.

    Rows with ``bag`` are (parts of) texts: row number, doc_id, held_out, packed ids and counts of their words. Rows with
    ``words`` are parts of a chunk's dictionary: the first id, the words, their counts in training texts.
    """
    kind = docs.schema["doc_id"].dataType
    schema = f"chunk bigint, row bigint, doc_id {kind.simpleString()}, held_out boolean, bag binary, first int, words array<binary>, trained array<bigint>"
    kinds = [pa.int64(), pa.int64(), pa_type(kind), pa.bool_(), pa.binary(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    names = ["chunk", "row", "doc_id", "held_out", "bag", "first", "words", "trained"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        row = chunk - 1
        place: dict[bytes, int] = {}
        trained: Counter = Counter()
        held = 0
        rows: list[tuple] = []

        def table_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        def dictionary() -> Iterator[pa.RecordBatch]:
            words = list(place)
            for at in range(0, len(words), ENTRY_ROWS):
                part = words[at : at + ENTRY_ROWS]
                yield table_of([(chunk, None, None, None, None, at, part, [trained[w] for w in part])])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids, texts, out = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text", "held_out"))
                for doc_id, text, held_out in zip(ids, texts, out):
                    row += 1
                    bag: Counter = Counter()
                    for words in word_blocks(text or ""):
                        bag.update(words)
                        held += len(words)
                        if held >= chunk_words:  # the dictionary ends; the rest of the text goes on in the next chunk
                            rows.append(_bag(chunk, row, doc_id, held_out, bag, place, trained))
                            yield table_of(rows)
                            yield from dictionary()
                            rows, place, trained, held, bag = [], {}, Counter(), 0, Counter()
                            chunk += 1
                    rows.append(_bag(chunk, row, doc_id, held_out, bag, place, trained))
                if rows:
                    yield table_of(rows)
                    rows = []
        yield from dictionary()

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, schema)


def _bag(chunk: int, row: int, doc_id: object, held_out: bool, bag: Counter, place: dict, trained: Counter) -> tuple:
    ids = np.fromiter((place.setdefault(w, len(place)) for w in bag), np.uint32, len(bag))
    counts = np.fromiter(bag.values(), np.uint32, len(bag))
    if not held_out:
        trained.update(bag)
    order = np.argsort(ids)
    return (chunk, row, doc_id, held_out, pack_bag(ids[order], counts[order]), None, None, None)


def pack_bag(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending ids as differences, and counts, byte by byte of all numbers so that the many zeros lie together."""
    both = np.concatenate([np.diff(ids, prepend=np.uint32(0)), counts]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_bag(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    steps, counts = np.split(both, 2)
    return np.cumsum(steps), counts


def reestimate(vocab: DataFrame, n_ends: int, pieces: list[str], prior: np.ndarray, rounds: int = ROUNDS, prior_weight: float = PRIOR_WEIGHT) -> np.ndarray:
    """Natural-log weights of the pieces after ``rounds`` over all training words (``vocab``: word, c)."""
    logs, spark = prior, vocab.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, logs))  # as large as the vocabulary file

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*shared.value)
            into = [0.0] * len(shared.value[0])
            for batch in batches:
                for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    text = START + word.decode("utf-8", "surrogatepass")
                    for at in range(0, len(text), PART):
                        lattice.expect(text[at : at + PART], float(c), into)
            used = [k for k, v in enumerate(into) if v > 0]
            uses = [round(into[k] / UNIT) for k in used]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(uses, pa.int64())], names=["piece", "uses"])

        found = vocab.where("c > 0").select("word", "c").mapInArrow(run, "piece int, uses bigint")
        uses = np.zeros(len(pieces))
        for r in found.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():  # a row for each piece at most
            uses[r["piece"]] = r["uses"] * UNIT
        uses[0] = n_ends
        logs = np.log((uses + prior_weight * np.exp(prior)) / (uses.sum() + prior_weight))
    return logs


def score(docs: DataFrame, pieces_path: str, rounds: int = ROUNDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text.

    Tokens are A-Z-lower-cased words between ASCII white space, then one end; a null text has the end only.
    Weights and counts come from rows that are not held out. The base scores a token by its smoothed
    share of the training tokens, the lattice a word by the sum over its segmentations.
    """
    spark = docs.sparkSession
    pieces, prior = vocabulary(pieces_path)
    made = staged(bags(docs, chunk_words), "bags")
    texts = made.where("bag is not null")
    entries = made.where("words is not null").select("chunk", "first", F.posexplode(F.arrays_zip("words", "trained")).alias("at", "entry"))
    entries = entries.select("chunk", (F.col("first") + F.col("at")).alias("id"), F.col("entry.words").alias("word"), F.col("entry.trained").alias("trained"))
    vocab = staged(entries.groupBy("word").agg(F.sum("trained").alias("c")), "vocabulary")
    words, kinds = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n_ends = texts.where("not held_out").agg(F.count_distinct("row")).first()[0]
    total, distinct = words + n_ends, kinds + (n_ends > 0)
    logs = reestimate(vocab, n_ends, pieces, prior, rounds)
    shared = spark.sparkContext.broadcast((pieces, logs))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            sums = [lattice.log_sum(w.decode("utf-8", "surrogatepass")) / math.log(10) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums, pa.float64())], names=["word", "c", "log_p"])

    weighed = vocab.select("word", "c").mapInArrow(weigh, "word binary, c bigint, log_p double")
    values = entries.select("chunk", "id", "word").join(weighed, "word").select("chunk", "id", "c", "log_p")
    floor = math.log10(total + 0.5 * (distinct + 1))
    end_base, end_score = math.log10(n_ends + 0.5) - floor, float(logs[0]) / math.log(10)

    def add_up(texts: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        c, log_p = np.zeros(len(values), np.int64), np.zeros(len(values))
        at = values["id"].to_numpy()
        c[at], log_p[at] = values["c"].to_numpy(), values["log_p"].to_numpy()
        base = np.log10(c + 0.5) - floor
        out = {"n": [], "known": [], "base": [], "score": []}
        for ids, counts in map(unpack_bag, texts["bag"]):
            out["n"].append(int(counts.sum()))
            out["known"].append(int(counts[c[ids] > 0].sum()))
            out["base"].append(float(counts @ base[ids]))
            out["score"].append(float(counts @ log_p[ids]))
        return texts[["row", "doc_id", "held_out"]].assign(**out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = (
        texts.select(F.col("chunk").alias("bag_chunk"), "row", "doc_id", "held_out", "bag")
        .groupBy("bag_chunk")
        .cogroup(values.withColumnRenamed("chunk", "entry_chunk").groupBy("entry_chunk"))
        .applyInPandas(add_up, f"row bigint, doc_id {kind}, held_out boolean, n bigint, known bigint, base double, score double")
    )
    whole = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("held_out").alias("held_out"),
        (F.sum("n") + 1).alias("n_tokens"),
        (F.sum("known") + int(n_ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.sum("base") + end_base).alias("base_score"),
        (F.sum("score") + end_score).alias("score"),
    )
    return whole.drop("row")


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every whole text, learned from the documents outside fold 1 of 5."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", in_fold(F.col("doc_id"), 5, 1).alias("held_out"))
    return score(docs, public_tokenizers.path("piece_bpe_32k.model"))
