"""Alignment of two tokenizers over a corpus: each distinct text is tokenised and aligned once.

Texts are shuffled by their whole content and counted, so a text that is in a third of all rows is worked on once. Its tokens of
both tokenizers cover the same bytes; offsets where tokens of both end cut them into groups, and tokens of one
group are linked. How many documents hold an id pair linked is a count over distinct texts, each weighted by its
multiplicity. The measures of a text then go back to its documents by a join on the text's digest.

Pair counts do not travel text by text. A task gathers the texts' pairs in chunks: a dictionary of the chunk's distinct pairs with
their weighted counts, and each text's pairs as numbers in it. Dictionary entries of all chunks meet by pair, and go back to their
chunk with the corpus' count, so a pair that is in every text has one row a chunk. Counts of an id's best pair go by
the vocabulary, which bounds them.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import SLICE, staged, table

#: Pairs of texts in a chunk, after which it ends with the text at hand; and the rows of one part of its dictionary.
CHUNK_PAIRS = 1_000_000
ENTRY_ROWS = 50_000
#: Aligned cuts that a worker takes up before those that it has not met since are forgotten; longer cuts are not remembered.
REMEMBERED, SHORT = 120_000, 64
#: New cuts that are encoded as one text.
TOGETHER = 64
#: A group of more links is kept as distinct pairs.
LISTED = 4096
#: Measures of a text that occurs in at least this share of all rows are broadcast (so there are fewer than its inverse).
FREQUENT = 1 / 1000

#: A blank after a letter, digit, underscore or ASCII mark, but for the text's last character.
_MARK = r"[\w!-/:-@\[-`{-~]"
_CUT = re.compile(rf"(?<={_MARK}) (?=.)", re.DOTALL)
_LAST = re.compile(_MARK).match


#: Three counts in one number, so that those of many cuts are added up at once.
_FIELD = 40


class Aligned(NamedTuple):
    """A cut's numbers of tokens and groups, its groups in writing and its pairs (a id << 32 | b id).

    ``pairs`` holds a pair for each link. Where these are many, ``heavy`` holds the distinct pairs and their numbers of links instead.
    """

    counts: int
    written: str
    pairs: bytes
    heavy: tuple[np.ndarray, np.ndarray] | None = None


def cross(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of two id lists, and how often each pair of occurrences is one."""
    (x, nx), (y, ny) = (np.unique(ids, return_counts=True) for ids in (a, b))
    return (x[:, None] << 32 | y[None, :]).ravel(), np.outer(nx, ny).ravel()


class Vocabularies:
    """Sizes in bytes of the ids of both tokenizers, and how each id is written: before a comma or at the end of its group."""

    def __init__(self, sizes_a: list[int], sizes_b: list[int]):
        self.sizes_a, self.sizes_b = np.array(sizes_a, np.int64), np.array(sizes_b, np.int64)
        self.written = [f"{i}{end}" for n, ends in ((len(sizes_a), ",|"), (len(sizes_b), ",;")) for end in ends for i in range(n)]
        self.lengths = np.array(list(map(len, self.written)), np.int64)


def align(a: list[int], b: list[int], vocabularies: Vocabularies, ends: list[int]) -> list[Aligned]:
    """Groups and links of two tokenisations of the same bytes, for each of the stretches that end at ``ends``, where
    tokens of both end too."""
    a, b, stops = np.array(a, np.int64), np.array(b, np.int64), np.array(ends, np.int64)
    ends_a, ends_b = np.cumsum(vocabularies.sizes_a[a]), np.cumsum(vocabularies.sizes_b[b])
    at = np.minimum(np.searchsorted(ends_b, ends_a), len(b) - 1)
    closing = ends_b[at] == ends_a
    # tokens of each group, and those of the groups before it
    to_a, to_b = np.flatnonzero(closing) + 1, at[closing] + 1
    from_a, from_b = (np.concatenate([[0], t]) for t in (to_a, to_b))
    n_a, n_b = np.diff(from_a), np.diff(from_b)
    groups = np.searchsorted(ends_a[closing], stops)
    if (groups == len(to_a)).any() or (ends_a[closing][groups] != stops).any():
        raise ValueError("a stretch does not end with tokens of both")
    cuts = np.concatenate([[0], groups + 1])

    heavy = n_a * n_b > LISTED
    listed = np.where(heavy, 0, n_a * n_b)
    from_link = np.concatenate([[0], np.cumsum(listed)])
    group = np.repeat(np.arange(len(n_a)), listed)
    place = np.arange(from_link[-1]) - from_link[group]
    pairs = (a[from_a[group] + place // n_b[group]] << 32 | b[from_b[group] + place % n_b[group]]).tobytes()

    # each group in writing: its ids of one side, then those of the other
    of_a, of_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    in_a, in_b = np.arange(len(a)), np.arange(len(b))
    known_a, known_b = len(vocabularies.sizes_a), len(vocabularies.sizes_b)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[in_a + from_b[of_a]] = a + known_a * (in_a + 1 == to_a[of_a])
    codes[in_b + to_a[of_b]] = 2 * known_a + b + known_b * (in_b + 1 == to_b[of_b])
    text = "".join(map(vocabularies.written.__getitem__, codes.tolist()))
    letters = np.concatenate([[0], np.cumsum(vocabularies.lengths[codes])])[(from_a + from_b)[cuts]].tolist()
    links = (8 * from_link[cuts]).tolist()
    counts = zip(*(np.diff(f[cuts]).tolist() for f in (from_a, from_b)), np.diff(cuts).tolist())
    out = [
        Aligned(x << 2 * _FIELD | y << _FIELD | n, text[letters[k] : letters[k + 1] - 1], pairs[links[k] : links[k + 1]])
        for k, (x, y, n) in enumerate(counts)
    ]
    for k in np.unique(np.searchsorted(cuts, np.flatnonzero(heavy), "right") - 1).tolist():
        large = [g for g in range(cuts[k], cuts[k + 1]) if heavy[g]]
        found = [cross(a[from_a[g] : to_a[g]], b[from_b[g] : to_b[g]]) for g in large]
        out[k] = out[k]._replace(heavy=tuple(np.concatenate(c) for c in zip(*found)))
    return out


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both tokenizers and the bytes of their ids.

    A text is cut at blanks that follow a letter, digit or mark: there the byte-level pre-tokenizer always starts a token, and
    no piece of the other vocabulary reaches over such a place (or texts are not cut). So the alignment of a text is that of its
    cuts, one after the other, and natural text repeats its cuts.
    """

    def __init__(self, byte_level: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        symbols = byte_symbols()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in symbols for c in token)
            self.bytes_a[i] = bytes(symbols[c] for c in token) if known else token.encode()
        self.bytes_b = []
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(names):
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.vocabularies = Vocabularies(*([len(t) for t in bs] for bs in (self.bytes_a, self.bytes_b)))
        self.cuttable = not any(x != "▁" == y for piece in names for x, y in zip(piece, piece[1:]))
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}

    def _align(self, cuts: list[str]) -> list[Aligned | None]:
        """None where the tokens' bytes are not those of the text. Cuts are encoded together where each may follow the other."""
        joined = [" ".join(cuts[k : k + TOGETHER]) for k in range(0, len(cuts), TOGETHER)]
        encoded = self.a.encode_batch_fast([" " + j for j in joined], add_special_tokens=False)
        fitting: list[tuple[list[int], list[int], list[str]]] = []
        others: dict[str, Aligned | None] = {}
        for k, (text, x, b) in enumerate(zip(joined, encoded, self.b.encode(joined, num_threads=1))):
            a, group = x.ids, cuts[k * TOGETHER : (k + 1) * TOGETHER]
            whole = (" " + text).encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) == whole == b"".join(map(self.bytes_b.__getitem__, b)):
                fitting.append((a, b, group))
            elif len(group) == 1:
                others[group[0]] = None
            else:
                others.update((c, self._align([c])[0]) for c in group)
        if fitting:
            together = [c for _, _, group in fitting for c in group]
            ends = list(accumulate(len(c.encode()) + 1 for c in together))
            a, b = ([i for f in fitting for i in f[side]] for side in (0, 1))
            others.update(zip(together, align(a, b, self.vocabularies, ends)))
        return [others[c] for c in cuts]

    def texts(self, texts: list[str]) -> Iterator[list[Aligned] | None]:
        """The aligned cuts of each text (not empty), or None where its bytes are not those of the tokens."""
        split = [_CUT.split(t) if self.cuttable else [t] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*split).difference(known)
        known.update({c: older[c] for c in new.intersection(older)})
        new = [c for c in new.difference(older) if len(c) <= SHORT]
        follows = [c for c in new if _LAST(c[-1:])]  # a blank may be put behind: see _CUT
        for at in range(0, len(follows), 4096):
            known.update(zip(follows[at : at + 4096], self._align(follows[at : at + 4096])))
        known.update({c: self._align([c])[0] for c in new if c not in known})
        for cuts in split:
            parts = [known[c] if len(c) <= SHORT else self._align([c])[0] for c in cuts]
            yield None if None in parts else parts


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_of(byte_level: str, pieces: str) -> Aligner:
    """One for each worker process: what it remembers serves its later tasks too."""
    if (byte_level, pieces) not in _ALIGNERS:
        _ALIGNERS[byte_level, pieces] = Aligner(byte_level, pieces)
    return _ALIGNERS[byte_level, pieces]


def measures_of(parts: list[Aligned]) -> tuple[tuple[int, int, int, int, str], np.ndarray, np.ndarray]:
    """Of a text's cuts: (n_a, n_b, n_groups, n_links, groups_sha256), its distinct pairs, and the links of each."""
    pairs, uses = np.unique(np.frombuffer(b"".join([p[2] for p in parts]), np.int64), return_counts=True)
    heavy = [p.heavy for p in parts if p.heavy]
    if heavy:
        pairs, at = np.unique(np.concatenate([pairs, *(h[0] for h in heavy)]), return_inverse=True)
        uses = np.bincount(at, np.concatenate([uses, *(h[1] for h in heavy)]), len(pairs)).astype(np.int64)
    digest = hashlib.sha256()
    for k in range(0, len(parts), 100_000):
        digest.update((";" if k else "").encode() + ";".join([p[1] for p in parts[k : k + 100_000]]).encode())
    counts = sum([p[0] for p in parts])
    n_a, n_b, n_groups = (counts >> shift & (1 << _FIELD) - 1 for shift in (2 * _FIELD, _FIELD, 0))
    return (n_a, n_b, n_groups, int(uses.sum()), digest.hexdigest()), pairs, uses


def gather(texts: DataFrame, byte_level: str, pieces: str, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """Rows (digest, text, copies) of distinct texts as chunks.

    Rows with ``digest`` are texts: their measures, and their pairs as numbers in the chunk's dictionary with the links of each. Rows
    with ``pairs`` are parts of a dictionary: the first number, the pairs, and the copies of the texts that hold each.
    """
    schema = (
        "chunk bigint, digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, numbers binary, links binary,"
        " first int, pairs array<bigint>, held array<bigint>"
    )
    kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["chunk", "digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers", "links", "first", "pairs", "held"]

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(byte_level, pieces)
        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def ended() -> Iterator[pa.RecordBatch]:
            every, at = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
            copies = np.repeat([h[1] for h in held], [len(h[3]) for h in held])
            counts = np.bincount(at, copies, len(every)).astype(np.int64)
            at = at.astype("<u4")
            rows, begin = [], 0
            for digest, _, values, own, links in held:
                end = begin + len(own)
                kind = "<u2" if links.max(initial=0) < 1 << 16 else "<u8"
                steps = np.diff(at[begin:end], prepend=np.uint32(0)).astype("<u4")  # ascending numbers
                rows.append((chunk, digest, *values, steps.tobytes(), links.astype(kind).tobytes(), None, None, None))
                begin = end
                if len(rows) == SLICE:
                    yield table_of(rows)
                    rows = []
            if rows:
                yield table_of(rows)
            for first in range(0, len(every), ENTRY_ROWS):
                part = slice(first, first + ENTRY_ROWS)
                yield table_of([(chunk, *[None] * 8, first, every[part].tolist(), counts[part].tolist())])

        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                digests, texts, copies = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("digest", "text", "copies"))
                for digest, n, parts in zip(digests, copies, aligner.texts(texts)):
                    if parts is None:
                        continue
                    values, own, links = measures_of(parts)
                    held.append((digest, n, values, own, links))
                    size += len(own)
                    if size >= chunk_pairs:
                        yield from ended()
                        held, size, chunk = [], 0, chunk + 1
        if held:
            yield from ended()

    return texts.select("digest", "text", "copies").mapInArrow(run, schema)


def pair_counts(entries: DataFrame) -> DataFrame:
    """(pair, count, best): the documents that hold each id pair linked, and whether no pair of its first id has more."""
    counts = staged(entries.groupBy("pair").agg(F.sum("held").alias("count")), "alignment-pairs")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))  # a row for each id of the vocabulary at most
    return counts.join(F.broadcast(most), first == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_corpus(docs: DataFrame, byte_level: str, pieces: str, ids: str = "doc_id", text: str = "text", chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """One row per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_level`` (tokenizers file) reads a blank and the text, ``pieces`` (sentencepiece file) the text, to which it adds that
    blank itself. Strings of special tokens inside a text are plain text. Texts that are null, empty, or whose tokens do
    not have the text's bytes have zeros and an empty digest, and hold no pair. Rows that share an id, or a text, are
    documents of their own, each counted; null ids stay null. A text of any length is one unit: its tokens are held by one task.
    An empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    usable = F.col("text") != ""
    rows = docs.select(F.col(f"`{ids}`").alias("id"), F.col(f"`{text}`").alias("text"))
    distinct = rows.where(usable).groupBy("text").agg(F.count("*").alias("copies"))  # the shuffle by full text
    distinct = distinct.withColumn("digest", F.unhex(F.sha2("text", 256)))
    made = staged(gather(distinct, byte_level, pieces, chunk_pairs), "alignment")
    entries = made.where("pairs is not null").select("chunk", "first", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "entry"))
    entries = entries.select("chunk", (F.col("first") + F.col("at")).alias("number"), F.col("entry.pairs").alias("pair"), F.col("entry.held").alias("held"))
    counted = entries.join(pair_counts(entries), "pair").select(F.col("chunk").alias("entry_chunk"), "number", "count", "best")

    def add_up(texts: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        count, best = np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        at = values["number"].to_numpy()
        count[at], best[at] = values["count"].to_numpy(), values["best"].to_numpy()
        n_best, total = [], []
        for numbers, links in zip(texts["numbers"], texts["links"]):
            own = np.cumsum(np.frombuffer(numbers, "<u4"), dtype=np.int64)
            uses = np.frombuffer(links, "<u2" if len(links) < 4 * len(own) else "<u8").astype(np.int64)
            n_best.append(int(uses[best[own]].sum()))
            total.append(int((uses * count[own]).sum()))
        return texts[["digest", "n_a", "n_b", "n_groups", "n_links"]].assign(n_best=n_best, count_sum=total, groups_sha256=texts["groups_sha256"])

    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = "digest binary, " + ", ".join(f"{c} bigint" for c in columns) + ", groups_sha256 string"
    texts = made.where("digest is not null").select(F.col("chunk").alias("text_chunk"), "digest", *columns[:4], "groups_sha256", "numbers", "links")
    measured = staged(texts.groupBy("text_chunk").cogroup(counted.groupBy("entry_chunk")).applyInPandas(add_up, schema), "alignment-texts")

    named = rows.select("id", F.when(usable, F.unhex(F.sha2("text", 256))).alias("digest"))
    named = staged(named, "alignment-documents")
    return with_measures(spark, named, measured, columns, ids)


def with_measures(spark: SparkSession, named: DataFrame, measured: DataFrame, columns: list[str], ids: str, share: float = FREQUENT) -> DataFrame:
    """Rows (id, digest) with the measures of their digest, or zeros.

    Digests of at least this share of all rows are fewer than its inverse, so their measures are broadcast; the
    rows of the others meet theirs in a shuffle in which no key is large.
    """
    least = max(2, int(named.count() * share) + 1)
    frequent = staged(named.where("digest is not null").groupBy("digest").count().where(F.col("count") >= least).select("digest"), "alignment-frequent")
    hot = F.broadcast(frequent.withColumn("hot", F.lit(True)))
    marked = named.join(hot, "digest", "left").withColumn("hot", F.col("hot") | F.col("digest").isNull())
    few = F.broadcast(measured.join(F.broadcast(frequent), "digest", "left_semi"))
    common = marked.where("hot").drop("hot").join(few, "digest", "left")
    others = marked.where("hot is null").drop("hot").join(measured, "digest", "left")
    whole = common.unionByName(others)
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in columns]
    return whole.select(F.col("id").alias(ids), *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the byte-level vocabulary's tokens of every whole text align with the piece vocabulary's."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return align_corpus(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
