"""Benchmark decontamination by greedy string tiling with running Karp-Rabin hashes.

Every run of ``SEED`` words of a benchmark item is hashed. The rolling hashes of all runs of whole documents are
joined with these seeds, so that only documents and items that share a run are tiled. Tiling marks, longest
first, matches of words that overlap no match marked before, whatever their order in the document. An item
whose words are covered to ``COVERAGE`` or more by tiles in a document contaminates it.

Words are runs of letters and digits with case ignored; white space, marks and symbols of any script separate them. Compatible
forms of a character (full-width letters, ligatures) are one, and characters that only steer line breaks are left out. In
scripts that are written without blanks each character is a word.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybridge.llm.common import SLICE, keep_rows, pa_type, table

#: Words of a seed, and of the shortest tile.
SEED = 5
#: Share of an item's words that tiles must cover.
COVERAGE = 0.7
#: Items are searched in blocks of so many characters at most (one item at least); a block's seeds go to every task.
BLOCK_CHARS = 4_000_000
#: Texts are hashed together, or in pieces, of about so many bytes.
PIECE = 1 << 20

_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[97:123] = _BREAK[128:] = False
_BLANK = bytes(32 if b else i for i, b in enumerate(_BREAK))


# Scripts without blanks between words (Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han), by code points.
_UNSPACED = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF),
    (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF),
)
# Soft hyphen, joiners, byte order mark and variation selectors.
_INVISIBLE = "\u00ad\u200c\u200d\u2060\ufeff\ufe00-\ufe0f"


def _separators() -> str:
    """A character class of everything beyond ASCII that is a separator, a mark, a symbol or a control."""
    ranges: list[list[int]] = []
    for point in range(128, sys.maxunicode + 1):
        if unicodedata.category(chr(point))[0] in "ZPSC" and not 0xD800 <= point <= 0xDFFF:
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@cache
def _marks() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """Patterns for characters to leave out, to take for blanks, and to take for words of their own."""
    unspaced = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _UNSPACED)
    return re.compile(f"[{_INVISIBLE}]+"), re.compile(f"[{_separators()}]+"), re.compile(f"([{unspaced}])")


def _folded(text: str) -> bytes:
    invisible, separators, unspaced = _marks()
    text = unicodedata.normalize("NFKC", text)
    text = unspaced.sub(r" \1 ", separators.sub(" ", invisible.sub("", text)))
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANK)


@cache
def _latin() -> tuple[bytes, re.Pattern]:
    """What each character below 256 folds to where that is one such character, and a pattern for the others."""
    folds = [_folded(chr(i)).decode() for i in range(256)]
    single = [len(f) == 1 and ord(f) < 256 for f in folds]
    others = b"".join(re.escape(bytes([i])) for i in range(256) if not single[i])
    return bytes(ord(f) if one else 32 for f, one in zip(folds, single)), re.compile(b"[" + others + b"]")


def folded(text: str | None) -> bytes:
    """Lower-cased text with everything but letters and digits blank."""
    text = text or ""
    if text.isascii():
        return text.lower().encode().translate(_BLANK)
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return _folded(text)
    folds, others = _latin()
    return _folded(text) if others.search(raw) else raw.translate(folds).decode("latin-1").encode()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class RollingWords:
    """Karp-Rabin hashes modulo 2**64 of words, and of runs of words, in folded bytes."""

    def __init__(self, seed: int):
        self.seed = seed
        self.up = self.down = np.zeros(0, np.uint64)
        self.steps = _powers(_STEP, seed)[::-1]

    def runs(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first byte, end byte) of each run of ``seed`` words: differences of prefix sums, scaled back."""
        if len(self.up) <= len(data):
            n = max(len(data) + 1, PIECE)
            self.up, self.down = _powers(_BASE, n), _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), n)
        edges = np.diff(np.concatenate([[1], _BREAK[data].view(np.int8), [1]]))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        n = len(starts) - self.seed + 1
        if n <= 0:
            return np.zeros(0, np.uint64), starts[:0], ends[:0]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.down[: len(data)], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.up[starts]
        words = (words ^ (words >> np.uint64(29))) * _STEP
        total = np.zeros(n, np.uint64)
        for k in range(self.seed):
            total += words[k : k + n] * self.steps[k]
        return total ^ (total >> np.uint64(31)), starts[:n], ends[self.seed - 1 :]


def tiles(pattern: list, text: list, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (position in ``pattern``, in ``text``, length) of at least ``least`` tokens.

    The longest maximal matches of unmarked tokens are marked first; ties go to the earliest in the pattern, then
    in the text. Matches are extended token by token, so equal hashes alone never count. Every maximal match is found
    once; one that meets marked tokens when its turn comes is put back as what is left of it.
    """
    used_p, used_t, out = bytearray(len(pattern)), bytearray(len(text)), []
    seeds = defaultdict(list)
    for i in range(len(text) - least + 1):
        seeds[tuple(text[i : i + least])].append(i)
    matches = []
    for p in range(len(pattern) - least + 1):
        before = pattern[p - 1] if p else None
        for t in seeds.get(tuple(pattern[p : p + least]), ()):
            if p and t and text[t - 1] == before:
                continue  # part of the match that begins one token earlier
            n, most = least, min(len(pattern) - p, len(text) - t)
            while n < most and pattern[p + n] == text[t + n]:
                n += 1
            matches.append((-n, p, t))
    heapify(matches)
    while matches:
        n, p, t = heappop(matches)
        n = -n
        free = [not (used_p[p + k] or used_t[t + k]) for k in range(n)]
        if all(free):
            used_p[p : p + n] = used_t[t : t + n] = b"\1" * n
            out.append((p, t, n))
            continue
        at = 0
        while at < n:
            end = at
            while end < n and free[end]:
                end += 1
            if end - at >= least:
                heappush(matches, (at - end, p + at, t + at))
            at = end + 1
    return out


def _blocks(items: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of a bounded size, read one after another in the order of their id."""
    held, size = [], 0
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    if held:
        yield held


class Matcher:
    """Finds the items of a block in documents."""

    def __init__(self, block: list[tuple[int, str]], seed: int, coverage: float):
        self.ids = [i for i, _ in block]
        self.items = [folded(t).split() for _, t in block]
        self.coverage, self.rolling = coverage, RollingWords(seed)
        found = [self.rolling.runs(np.frombuffer(b" ".join(w), np.uint8))[0] for w in self.items]
        owners = np.repeat(np.arange(len(found)), [len(h) for h in found])
        places = np.concatenate([np.arange(len(h)) for h in found])
        hashes = np.concatenate(found)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners, self.places = hashes[order], owners[order], places[order]
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(hashes >> np.uint64(42)).astype(np.int64)] = True

    def _hits(self, data: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(first byte, end byte, range of seeds) of the runs that are seeds."""
        runs, first, end = self.rolling.runs(data)
        at = np.flatnonzero(self.sieve[(runs >> np.uint64(42)).view(np.int64)])
        low, high = np.searchsorted(self.hashes, runs[at]), np.searchsorted(self.hashes, runs[at], "right")
        real = high > low
        return zip(first[at][real].tolist(), end[at][real].tolist(), low[real].tolist(), high[real].tolist())

    def _hits_of_long(self, data: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """The same, piece by piece; each piece begins with the last words of the one before."""
        at, size = 0, PIECE
        while at < len(data):
            end = min(len(data), at + size)
            while end < len(data) and not _BREAK[data[end]]:
                end += 1
            for a, b, low, high in self._hits(data[at:end]):
                yield at + a, at + b, low, high
            if end == len(data):
                return
            starts = np.flatnonzero(np.diff(np.concatenate([[1], _BREAK[data[at:end]].view(np.int8)])) == -1)
            if len(starts) < self.rolling.seed:
                size *= 2
            else:
                at, size = at + int(starts[-(self.rolling.seed - 1)]) if self.rolling.seed > 1 else end, PIECE

    def _judge(self, data: bytes, hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
        """(item, covered words, tiles) of the items that reach the coverage in one document."""
        spans: dict[int, list[list[int]]] = defaultdict(list)
        seen: dict[int, set[int]] = defaultdict(set)
        for a, b, low, high in hits:
            for j in range(low, high):
                k = int(self.owners[j])
                seen[k].add(int(self.places[j]))
                if spans[k] and a < spans[k][-1][1]:
                    spans[k][-1][1] = max(b, spans[k][-1][1])
                else:
                    spans[k].append([a, b])
        out = []
        seed = self.rolling.seed
        for k in sorted(spans):
            item = self.items[k]
            within = len({p + i for p in seen[k] for i in range(seed)})
            if within < self.coverage * len(item):
                continue  # tiles lie on words that seeds cover
            # any match lies in one span; of equal spans no more can be used than fit the item
            text: list = []
            copies: Counter = Counter()
            for a, b in spans[k]:
                span = data[a:b]
                copies[span] += 1
                if copies[span] <= len(item) // seed:
                    text += [*span.split(), None]
            found = tiles(item, text, seed)
            covered = sum(n for _, _, n in found)
            if covered >= self.coverage * len(item):
                out.append((k, covered, len(found)))
        return out

    def of(self, texts: list[str | None]) -> Iterator[list[tuple[int, int, int]]]:
        """For each text its contaminating items. Short texts are hashed together."""
        held: list[bytes] = []
        for text in texts:
            data = folded(text)
            if len(data) > PIECE:
                yield from self._together(held)
                held = []
                yield self._judge(data, list(self._hits_of_long(np.frombuffer(data, np.uint8))))
            else:
                held.append(data)
                if sum(map(len, held)) > PIECE:
                    yield from self._together(held)
                    held = []
        yield from self._together(held)

    def _together(self, held: list[bytes]) -> Iterator[list[tuple[int, int, int]]]:
        if not held:
            return
        whole = b" ".join(held)
        begins = np.cumsum([0] + [len(d) + 1 for d in held])
        hits = defaultdict(list)
        for a, b, low, high in self._hits(np.frombuffer(whole, np.uint8)):
            doc = int(np.searchsorted(begins, a, "right")) - 1
            if b < begins[doc + 1]:  # not from one text into the next
                hits[doc].append((a - int(begins[doc]), b - int(begins[doc]), low, high))
        for doc, data in enumerate(held):
            yield self._judge(data, hits[doc]) if doc in hits else []


def contaminated(
    docs: DataFrame, items: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Rows (doc_id, item_id, item_words, covered_words, tiles, coverage), one for each row of ``docs`` and each row of
    ``items`` that it contains to ``coverage`` or more.

    Null and empty texts contain nothing; items of fewer than ``seed`` words are found in nothing. Repeated rows give
    repeated results. Documents are read once for each block of items.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, item_id {items.schema['item_id'].dataType.simpleString()}, item_words int, covered_words int, tiles int, coverage double"
    kind, item_kind = pa_type(docs.schema["doc_id"].dataType), pa_type(items.schema["item_id"].dataType)
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(items, block_chars):
        matcher = docs.sparkSession.sparkContext.broadcast(Matcher(block, seed, coverage))  # bounded by block_chars

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            m = matcher.value
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    ids = part.column(0).to_pylist()
                    rows = [
                        (i, m.ids[k], len(m.items[k]), covered, n, covered / len(m.items[k]))
                        for i, found in zip(ids, m.of(part.column(1).to_pylist()))
                        for k, covered, n in found
                    ]
                    if rows:
                        kinds = [kind, item_kind, pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                        names = ["doc_id", "item_id", "item_words", "covered_words", "tiles", "coverage"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out


def remove_contaminated(docs: DataFrame, items: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, columns as they are, that contain no item to ``coverage`` or more."""
    for block in _blocks(items, block_chars):
        matcher = docs.sparkSession.sparkContext.broadcast(Matcher(block, seed, coverage))  # bounded by block_chars

        def make(matcher=matcher) -> Callable[[str | None], bool]:
            return lambda text: not any(matcher.value.of([text]))

        docs = keep_rows(docs, "text", make)
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with its covered share."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
