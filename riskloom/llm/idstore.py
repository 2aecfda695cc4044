"""Token ids as a store of compressed shards with one shared zstandard dictionary (operator 1).

A store is a folder in shared storage: ``dictionary`` (trained on the serialized id arrays of a
bounded sample of documents) and shards ``p<part>-<seq>.ids`` with an index ``.idx`` beside each.  A
shard has a header (magic, SHA-256 of the dictionary, bytes an id takes) and then one zstandard frame a
document, so a short document is read by one seek.  The index has doc_id, offset, length and ids of
every frame.  Documents lie in ascending doc_id (null ids first, repeated ids by length and bytes).

Null texts are empty; an empty document has just its end id.  An empty table gives no shard.  Ids are
kept in two bytes where the vocabulary allows, else in four.  Lost executors: every stage is
deterministic, frames are a written table, and files appear under their names only when whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, save_file, shared_folder, shared_uri, text_chunks, texts
from riskloom.llm.tokens import encoder

#: The dictionary is trained on this many documents, those with the smallest hashes of their id.
SAMPLE_DOCUMENTS = 512
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 64 << 20
#: Bytes of text encoded at a time: a word that repeats in them is looked up once.
ENCODE_BYTES = 8 << 20
LEVEL = 3
MAGIC = b"IDSHARD1"
INDEX = np.dtype([("doc_id", "<i8"), ("null_id", "?"), ("offset", "<i8"), ("length", "<i8"), ("n_tokens", "<i8")])

_DICTIONARIES: dict[str, tuple] = {}


def _width(path: str) -> str:
    return "<u2" if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def _documents(batch: pa.RecordBatch, path: str, end_id: int) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, its ids with the end id) of every row."""
    for part in text_chunks(batch, limit=ENCODE_BYTES):
        ids, at = encoder(path).encode(part.column("text"))
        for key, a, b in zip(part.column("doc_id").to_pylist(), at[:-1], at[1:], strict=True):
            yield key, np.append(ids[a:b], np.uint32(end_id))


def _dictionary(uri: str) -> tuple:
    """(SHA-256, compression dictionary or None) of a store, read once in a worker."""
    import zstandard

    if uri not in _DICTIONARIES:
        fs, root = shared_folder(uri)
        with fs.open_input_file(f"{root}/dictionary") as f:
            data = f.read()
        _DICTIONARIES.clear()
        _DICTIONARIES[uri] = (hashlib.sha256(data).digest(), zstandard.ZstdCompressionDict(data) if data else None)
    return _DICTIONARIES[uri]


def train_dictionary(docs: DataFrame, uri: str, path: str, end_id: int, sample: int = SAMPLE_DOCUMENTS) -> str:
    """Train the store's dictionary in one task over ``sample`` documents; its SHA-256."""

    def train(batches):
        import zstandard

        width = _width(path)
        arrays = [ids.astype(width).tobytes() for b in batches for _, ids in _documents(b, path, end_id)]
        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
        except zstandard.ZstdError:  # too little to learn from
            data = b""
        save_file(uri, "dictionary", [data])
        yield pa.RecordBatch.from_pydict({"sha256": [hashlib.sha256(data).hexdigest()]})

    one = docs.sparkSession.range(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))  # so that there is a task
    chosen = docs.orderBy(F.xxhash64("doc_id"), "doc_id", F.length("text")).limit(sample).unionByName(one)
    return chosen.coalesce(1).mapInArrow(train, "sha256 string").first()["sha256"]


def write_store(docs: DataFrame, path: str, end_id: int, *, id_col="doc_id", text_col="text", shard_bytes=SHARD_BYTES) -> tuple[str, DataFrame]:
    """Encode every whole text and write the store; (its URI, a table with one row a shard: name,
    n_docs, n_tokens, start = ids in the shards before it)."""
    docs = texts(docs, id_col, text_col)
    uri = shared_uri(docs.sparkSession, "idstore")
    train_dictionary(docs, uri, path, end_id)

    def compress(batches):
        import zstandard

        digest, dictionary = _dictionary(uri)
        width, packer = _width(path), zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("frame", pa.binary())])
        for batch in batches:
            for part in text_chunks(batch, limit=ENCODE_BYTES):
                keys, sizes, frames = [], [], []
                for key, ids in _documents(part, path, end_id):
                    keys.append(key)
                    sizes.append(len(ids))
                    frames.append(packer.compress(ids.astype(width).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(frames, pa.binary())], schema=schema)

    frames = materialize(docs.mapInArrow(compress, "doc_id long, n_tokens long, frame binary"), "frames")

    def write(batches):
        from pyspark import TaskContext

        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def shard():
            digest, _ = _dictionary(uri)
            name, head = f"p{part:07d}-{seq:05d}", MAGIC + digest + bytes([np.dtype(_width(path)).itemsize])
            index = np.zeros(len(held), INDEX)
            lengths = np.array([len(f) for _, _, f in held], np.int64)
            index["doc_id"], index["null_id"] = [k or 0 for k, _, _ in held], [k is None for k, _, _ in held]
            index["n_tokens"], index["length"] = [n for _, n, _ in held], lengths
            index["offset"] = len(head) + np.cumsum(lengths) - lengths
            save_file(uri, f"{name}.ids", [head, *(f for _, _, f in held)])
            save_file(uri, f"{name}.idx", [index.tobytes()])
            row = {"part": [part], "seq": [seq], "name": [name], "n_docs": [len(held)], "n_tokens": [int(index["n_tokens"].sum())]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame")), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= shard_bytes:
                    yield shard()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield shard()

    ordered = frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "frame")
    shards = materialize(ordered.mapInArrow(write, "part int, seq int, name string, n_docs long, n_tokens long"), "shards")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard, not a document
    return uri, shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_ids(uri: str, name: str, entry: np.void, shard=None) -> np.ndarray:
    """The ids of one document, by its index entry: one seek, one frame."""
    import zstandard

    digest, dictionary = _dictionary(uri)
    if shard is None:
        fs, root = shared_folder(uri)
        with fs.open_input_file(f"{root}/{name}.ids") as f:
            return read_ids(uri, name, entry, f)
    shard.seek(0)
    head = shard.read(len(MAGIC) + 33)
    if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) : -1] != digest:
        raise ValueError(f"{name} was written with another dictionary")
    shard.seek(int(entry["offset"]))
    data = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(shard.read(int(entry["length"])))
    return np.frombuffer(data, f"<u{head[-1]}").astype("<u4")


def read_index(uri: str, name: str) -> np.ndarray:
    fs, root = shared_folder(uri)
    with fs.open_input_file(f"{root}/{name}.idx") as f:
        return np.frombuffer(f.read(), INDEX)


def scan_store(uri: str, shards: DataFrame) -> DataFrame:
    """Read all shards back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches):
        import zstandard

        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist(), strict=True):
                digest, dictionary = _dictionary(uri)
                index, sums, sizes = read_index(uri, name), [], []
                opener = zstandard.ZstdDecompressor(dict_data=dictionary)
                fs, root = shared_folder(uri)
                with fs.open_input_file(f"{root}/{name}.ids") as f:
                    head = f.read(len(MAGIC) + 33)
                    if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) : -1] != digest:
                        raise ValueError(f"{name} was written with another dictionary")
                    for entry in index:  # they follow each other: one pass over the file
                        ids = np.frombuffer(opener.decompress(f.read(int(entry["length"]))), f"<u{head[-1]}").astype("<u4")
                        sizes.append(len(ids))
                        sums.append(zlib.crc32(ids))
                sizes = np.array(sizes, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc_id"], pa.int64(), mask=index["null_id"].copy()), pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = shards.select("name", "start").repartition(max(1, min(shards.count(), 10_000)), "name")  # tiny rows, much work each
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
