"""Token-id store: raw id payloads in shard files, found by key through a minimal perfect hash index.

Layout of a store (a folder on a file system that all executors reach):

* ``shards/<name>.ids``: a 16-byte header (magic, format version, bytes an id) and the ids of whole
  documents one after the other, little-endian, in ascending order of doc_id. Ids take 2 bytes where the
  vocabulary allows it, else 4.
* ``catalog`` (Parquet): the shards in order, with their number of ids and the ids of all shards before.
* ``index/<number>.mph``: the minimal perfect hash of the keys that hash to this index shard. A 32-byte header, a
  displacement for each bucket, then one entry for each key: shard, offset in ids, number of ids, and a
  32-bit fingerprint of the key, so that a key that was never stored is told apart.

A lookup hashes the key, reads one displacement and one entry, and compares the fingerprint: constant
time, whatever the number of documents. Files are written under names that no other attempt uses, and
only names that reach the catalog count, so a lost or repeated task does no harm.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybridge.llm.common import pa_type, staged, table
from tallybridge.session import new_folder

MAGIC = b"TOKS"
INDEX_MAGIC = b"MPHF"
VERSION = 1
#: A shard file ends after so many ids.
SHARD_IDS = 16_000_000
#: Keys of an index shard on average: what a task holds to build or search it.
INDEX_KEYS = 32_768
#: Keys of a bucket on average.
BUCKET_KEYS = 4
END_ID = 0
#: Cuts whose ids a worker takes up before it forgets those that it has not met since; new cuts that are encoded as one text.
REMEMBERED, TOGETHER = 400_000, 64
#: Texts are encoded together up to so many characters.
TEXTS_CHARS = 8 << 20
#: Longer texts are encoded in pieces of about so many characters.
PIECE_CHARS = 1 << 20

_ENTRY = np.dtype([("shard", "<u4"), ("fingerprint", "<u4"), ("offset", "<u8"), ("n", "<u8")])


# ---------------------------------------------------------------- encoding


class Encoder:
    """Ids of whole texts by a tokenizers file, equal to encoding each text at once.

    The file's pre-tokenizer starts a new token at a blank that follows anything but white space. So a text may be
    cut there, and natural text repeats its cuts: the cuts of many texts are numbered in Arrow, the ids of each distinct one are looked
    up among those seen before, and cuts that are new are encoded together, one behind the other.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if len(vocabulary) <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.end = np.array([END_ID], self.kind).tobytes()
        #: Bytes of a token: each character of its name stands for one.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cuts(self, cuts: list[str]) -> list[bytes]:
        """Ids of cuts with a blank before each, none of which is empty or ends in white space."""
        joined = ["".join([" " + c for c in cuts[k : k + TOGETHER]]) for k in range(0, len(cuts), TOGETHER)]
        out: list[bytes] = []
        for k, encoded in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(encoded.ids, self.kind)
            group = cuts[k * TOGETHER : (k + 1) * TOGETHER]
            ends = np.cumsum([len(c.encode()) + 1 for c in group])
            reached = np.cumsum(self.sizes[ids])
            to = np.searchsorted(reached, ends)
            if len(ids) and to[-1] < len(ids) and (reached[to] == ends).all():
                raw, width = ids.tobytes(), self.kind.itemsize
                bounds = [0, *((to + 1) * width).tolist()]
                out += [raw[x:y] for x, y in zip(bounds, bounds[1:])]
            else:
                out += self._raw([" " + c for c in group])
        return out

    def _look_up(self, cuts: list[str]) -> list[bytes]:
        """Ids of distinct cuts; nothing for one that is empty or ends in white space, behind which no token starts."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, cuts))
        new = []
        for k, ids in enumerate(found):
            if ids is None:
                c = cuts[k]
                ids = older.get(c)
                if ids is None:
                    if c and not c[-1].isspace():
                        new.append(k)
                        continue
                    ids = b""
                found[k] = known[c] = ids
        for at in range(0, len(new), 1 << 16):
            part = new[at : at + (1 << 16)]
            for k, ids in zip(part, self._cuts([cuts[k] for k in part])):
                found[k] = known[cuts[k]] = ids
        return found

    def _pieces(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        offsets = split.offsets.to_numpy()
        offsets, flat = offsets - offsets[0], split.flatten()
        heads = offsets[:-1]
        numbered = flat.dictionary_encode()
        number = numbered.indices.to_numpy().astype(np.int64)
        found = self._look_up(numbered.dictionary.to_pylist())
        first = self._raw(flat.take(pa.array(heads)).to_pylist())
        # ids of all distinct cuts, then those of the heads, which have no blank before them
        width = self.kind.itemsize
        unfit = np.array([not x for x in found], bool)[number]
        found += first
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // width
        begins = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(found), self.kind)
        unfit[heads] = False
        number[heads] = len(found) - len(first) + np.arange(len(heads))
        n = sizes[number]
        to = np.concatenate([[0], np.cumsum(n)])
        raw = ids[np.arange(to[-1]) + np.repeat(begins[number] - to[:-1], n)].tobytes()
        bounds = (to[offsets] * width).tolist()
        unfit = np.add.reduceat(unfit, heads).astype(bool)
        out = [raw[x:y] for x, y in zip(bounds, bounds[1:])]
        for k, text in enumerate(texts):
            at = text.find(" ")
            if unfit[k] or (at > 0 and text[at - 1].isspace()):
                out[k] = self._raw([text])[0]
        return out

    def encode(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """For each text its ids and the end id as little-endian bytes; a long text's in several pieces."""
        short = [t for t in texts if len(t) <= PIECE_CHARS]
        ready = iter(self._pieces(short))
        for text in texts:
            yield iter((next(ready), self.end)) if len(text) <= PIECE_CHARS else self._long(text)

    def _long(self, text: str) -> Iterator[bytes]:
        at = 0
        while at < len(text):
            cut = at + PIECE_CHARS
            while (cut := text.find(" ", cut)) > 0 and text[cut - 1].isspace():
                cut += 1
            cut = cut if cut > 0 else len(text)
            yield from self._pieces([text[at:cut]])
            at = cut
        yield self.end


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process: what it remembers serves its later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- minimal perfect hash


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_DIRECT = np.uint32(1 << 31)


def _slots(second: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    return _mix(second + displacement.astype(np.uint64) * _GOLDEN) % np.uint64(n)


def _fingerprint(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (_mix(first ^ (second * _GOLDEN)) >> np.uint64(32)).astype(np.uint32)


def build_mph(first: np.ndarray, second: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacements, slot of each key) for distinct pairs of 64-bit hashes; the slots are 0 to n - 1.

    Hash and displace: keys fall into small buckets by their first hash; the largest bucket first, each bucket
    gets the least displacement that sends its keys, by their second hash, to slots that are free. Buckets of one
    key come last and name their slot directly.
    """
    n = len(first)
    m = max(1, -(-n // BUCKET_KEYS))
    for seed in range(1 << 16):
        bucket = (_mix(first + np.uint64(seed)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=m)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        free = np.ones(n, bool)
        displacements, slots = np.zeros(m, np.uint32), np.zeros(n, np.int64)
        done = True
        for b in np.argsort(-sizes, kind="stable"):
            keys = order[begins[b] : begins[b + 1]]
            if len(keys) < 2:
                break
            for start in range(0, 1 << 20, 256):
                tried = np.arange(start, start + 256)
                at = _slots(second[keys][None, :], tried[:, None], n).astype(np.int64)
                ok = free[at].all(1)
                if len(keys) > 1 and ok.any():
                    apart = np.sort(at[ok], 1)
                    ok[np.flatnonzero(ok)] = (apart[:, 1:] != apart[:, :-1]).all(1)
                if ok.any():
                    d = int(ok.argmax())
                    displacements[b], slots[keys] = tried[d], at[d]
                    free[at[d]] = False
                    break
            else:
                done = False
                break
        if not done:
            continue
        singles = np.flatnonzero(sizes == 1)
        left = np.flatnonzero(free)
        displacements[singles] = left.astype(np.uint32) | _DIRECT
        slots[order[begins[singles]]] = left
        return seed, displacements, slots
    raise ValueError("keys are not distinct")


class IndexShard:
    """One file of the index, held in memory by the task that searches it."""

    def __init__(self, data: bytes):
        magic, version, n, m, self.seed = struct.unpack("<4sIQQQ", data[:32])
        if magic != INDEX_MAGIC or version != VERSION:
            raise ValueError("not an index of this version")
        self.displacements = np.frombuffer(data, "<u4", m, 32)
        self.entries = np.frombuffer(data, _ENTRY, n, 32 + 4 * m)

    @staticmethod
    def dump(first: np.ndarray, second: np.ndarray, shard: np.ndarray, offset: np.ndarray, n: np.ndarray) -> bytes:
        seed, displacements, slots = build_mph(first, second)
        entries = np.zeros(len(first), _ENTRY)
        for name, values in (("shard", shard), ("fingerprint", _fingerprint(first, second)), ("offset", offset), ("n", n)):
            entries[name][slots] = values
        head = struct.pack("<4sIQQQ", INDEX_MAGIC, VERSION, len(first), len(displacements), seed)
        return head + displacements.astype("<u4").tobytes() + entries.tobytes()

    def find(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the keys, and whether each key's fingerprint agrees."""
        n, m = len(self.entries), len(self.displacements)
        if not n:
            return np.zeros(len(first), _ENTRY), np.zeros(len(first), bool)
        d = self.displacements[(_mix(first + np.uint64(self.seed)) % np.uint64(m)).astype(np.int64)]
        slot = np.where(d & _DIRECT, (d & ~_DIRECT).astype(np.uint64), _slots(second, d, n)).astype(np.int64)
        found = self.entries[np.minimum(slot, n - 1)]
        return found, found["fingerprint"] == _fingerprint(first, second)


# ---------------------------------------------------------------- files


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark resolves it: executors must not take it for one of their own disks."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def _files(root: str) -> tuple[pafs.FileSystem, str]:
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(root)


class _ShardWriter:
    def __init__(self, root: str, width: int):
        self.fs, base = _files(root)
        self.name = f"{uuid.uuid4().hex}.ids"
        self.fs.create_dir(f"{base}/shards", recursive=True)
        self.out = self.fs.open_output_stream(f"{base}/shards/{self.name}")
        self.out.write(struct.pack("<4sIQ", MAGIC, VERSION, width))
        self.ids = 0

    def close(self) -> None:
        self.out.close()


def _hashes(df: DataFrame) -> DataFrame:
    """The two hashes of the key (doc_id, copy) and the index shard's number is the first modulo their number."""
    return df.withColumns({"first": F.xxhash64("doc_id", "copy"), "second": F.xxhash64(F.lit(7), "copy", "doc_id")})


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of (doc_id, text) in parts of about ``TEXTS_CHARS``."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + TEXTS_CHARS, "right")))
        yield batch.slice(at, to - at)
        at = to


def write_store(docs: DataFrame, tokenizer: str, root: str, text: str = "text", shard_ids: int = SHARD_IDS, index_keys: int = INDEX_KEYS) -> None:
    """Encode the whole texts of ``docs`` and write a store into the empty folder ``root``.

    A null text is empty, so that its document has the end id only. Rows that share a doc_id (a null one too) are
    stored one after the other and told apart by ``copy``, 0 for the first; their order is that of the texts. An empty
    table makes a store without shards.
    """
    spark = docs.sparkSession
    root = _qualified(spark, root)
    kind = docs.schema["doc_id"].dataType
    id_type = pa_type(kind)
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"doc_id {kind.simpleString()}, copy int, file string, offset bigint, n bigint"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        width = encoder.kind.itemsize
        shard = None
        last, copy = object(), 0
        for batch in batches:
            for part in _parts(batch):
                out = []
                texts = part.column(1).to_pylist()
                for doc_id, pieces in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    copy = copy + 1 if doc_id == last else 0
                    last = doc_id
                    if shard is None or shard.ids >= shard_ids:
                        if shard:
                            shard.close()
                        shard = _ShardWriter(root, width)
                    begin = shard.ids
                    for ids in pieces:
                        shard.out.write(ids)
                        shard.ids += len(ids) // width
                    out.append((doc_id, copy, shard.name, begin, shard.ids - begin))
                kinds = [id_type, pa.int32(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["doc_id", "copy", "file", "offset", "n"]
                )
        if shard:
            shard.close()

    entries = staged(rows.mapInArrow(write, schema), "token-entries")
    shards = entries.groupBy("file").agg(F.min(F.struct("doc_id", "copy")).alias("head"), F.sum("n").alias("ids"))
    order = Window.orderBy("head")  # one row for each shard
    before = F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select((F.row_number().over(order) - 1).alias("shard"), "file", "ids", before.cast("long").alias("start"))
    shards.write.parquet(f"{root}/catalog")
    shards = spark.read.parquet(f"{root}/catalog")

    number = max(1, -(-entries.count() // index_keys))
    keys = _hashes(entries.join(shards.select("file", "shard"), "file").drop("file"))
    keys = keys.select(F.pmod("first", F.lit(number)).cast("int").alias("part"), "first", "second", "shard", "offset", "n")
    keys = keys.repartition("part").sortWithinPartitions("part")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _files(root)
        fs.create_dir(f"{base}/index", recursive=True)
        for part, run in _runs(batches):
            u = [run[c].to_numpy().view(np.uint64) for c in ("first", "second")]
            data = IndexShard.dump(*u, *(run[c].to_numpy() for c in ("shard", "offset", "n")))
            name = f"{uuid.uuid4().hex}.mph"
            with fs.open_output_stream(f"{base}/index/{name}") as out:
                out.write(data)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name])], names=["part", "file"])

    keys.mapInArrow(index, "part int, file string").withColumn("parts", F.lit(number)).write.parquet(f"{root}/index-catalog")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Runs of one ``part`` out of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column(batch.schema.get_field_index("part")).to_numpy()
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            piece = batch.slice(a, b - a)
            if held and held[0].column(held[0].schema.get_field_index("part"))[0].as_py() != int(parts[a]):
                whole = pa.Table.from_batches(held)
                yield whole["part"][0].as_py(), whole
                held = []
            held.append(piece)
    if held:
        whole = pa.Table.from_batches(held)
        yield whole["part"][0].as_py(), whole


def locate(keys: DataFrame, root: str) -> DataFrame:
    """(doc_id, copy, shard, offset, n) of the keys (doc_id, copy) that the store holds, by the index alone."""
    spark = keys.sparkSession
    root = _qualified(spark, root)
    files = spark.read.schema("part int, file string, parts int").parquet(f"{root}/index-catalog")
    number = files.agg(F.max("parts")).first()[0]
    kind = keys.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, copy int, shard bigint, offset bigint, n bigint"
    if number is None:
        return spark.createDataFrame([], schema)
    rows = _hashes(keys.select("doc_id", F.col("copy").cast("int").alias("copy")))
    rows = rows.withColumn("part", F.pmod("first", F.lit(number)).cast("int")).join(files.select("part", "file"), "part")
    rows = rows.repartition("part").sortWithinPartitions("part")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _files(root)
        for _, run in _runs(batches):
            with fs.open_input_stream(f"{base}/index/{run['file'][0].as_py()}") as source:
                shard = IndexShard(source.read())
            entries, held = shard.find(*(run[c].to_numpy().view(np.uint64) for c in ("first", "second")))
            run, entries = run.filter(pa.array(held)), entries[held]
            columns = [run["doc_id"].combine_chunks(), run["copy"].combine_chunks()]
            columns += [pa.array(entries[c].astype(np.int64)) for c in ("shard", "offset", "n")]
            yield from pa.table(columns, names=["doc_id", "copy", "shard", "offset", "n"]).to_batches(max_chunksize=10_000)

    return rows.mapInArrow(find, schema)


def read_store(keys: DataFrame, root: str, outputs: str, use: Callable[[Iterator[np.ndarray]], tuple]) -> DataFrame:
    """For each key that the store holds: doc_id, copy, start (ids of all documents before it), n_tokens, and what
    ``use`` returns for its ids, which it gets as arrays of unsigned 32-bit numbers, one after another."""
    from pyspark.sql import types as T

    spark = keys.sparkSession
    root = _qualified(spark, root)
    catalog = spark.read.parquet(f"{root}/catalog").select(F.col("shard").cast("long").alias("shard"), "file", "start")
    rows = locate(keys, root).join(catalog, "shard")
    rows = rows.select("doc_id", "copy", "file", "offset", (F.col("start") + F.col("offset")).alias("start"), "n")
    rows = rows.repartition("file").sortWithinPartitions("file", "offset")
    kind = keys.schema["doc_id"].dataType
    added = T._parse_datatype_string(outputs)
    schema = f"doc_id {kind.simpleString()}, copy int, start bigint, n_tokens bigint, {outputs}"
    kinds = [pa_type(kind), pa.int32(), pa.int64(), pa.int64(), *(pa_type(f.dataType) for f in added.fields)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _files(root)
        name, source, width = None, None, 2

        def ids(offset: int, n: int) -> Iterator[np.ndarray]:
            for at in range(offset, offset + n, 1 << 20):
                take = min(1 << 20, offset + n - at)
                source.seek(16 + at * width)
                yield np.frombuffer(source.read(take * width), f"<u{width}").astype("<u4")

        for batch in batches:
            out = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "copy", "file", "offset", "start", "n")]
            for doc_id, copy, file, offset, start, n in zip(*columns):
                if file != name:
                    if source:
                        source.close()
                    name, source = file, fs.open_input_file(f"{base}/shards/{file}")
                    magic, version, width = struct.unpack("<4sIQ", source.read(16))
                    if magic != MAGIC or version != VERSION:
                        raise ValueError("not a shard of this version")
                out.append((doc_id, copy, start, n, *use(ids(offset, n))))
            if out:
                names = ["doc_id", "copy", "start", "n_tokens", *added.names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
        if source:
            source.close()

    return rows.mapInArrow(read, schema)


def ids_crc32(ids: Iterator[np.ndarray]) -> tuple[int]:
    """Unsigned crc32 of all ids as little-endian unsigned 32-bit integers."""
    crc = 0
    for part in ids:
        crc = zlib.crc32(part.tobytes(), crc)
    return (crc,)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every text's ids into a store, look every document up again by its key, and digest the ids read."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    root = new_folder(spark, "token-store")
    write_store(docs, public_tokenizers.path("byte_bpe_50k.json"), root)
    keys = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    keys = keys.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1)).alias("copy"))
    return read_store(keys, root, "ids_crc32 bigint", ids_crc32).drop("copy")
