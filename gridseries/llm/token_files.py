"""Token-id files: documents encoded, compressed one by one with a shared dictionary, and indexed.

A file set is a folder of three Parquet tables, so any store that Spark reaches can hold it:
``shards`` (``bucket, shard, at`` (ids of its bucket before it), ``dict_hash, width`` (bytes per id),
``doc_ids``, ``counts`` (ids per document), ``offsets`` into ``payload`` (one more than documents)),
``buckets`` (``bucket, base``: ids of all documents before it) and ``dictionary`` (``dict_hash,
dictionary``). Buckets, shards in a bucket and documents in a shard ascend by document id. A document
is one zstandard frame of little-endian ids, so a short one is read without its neighbours.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridseries.llm.common import ensure_shared_dir, text_key

#: Fixed value of the registered query: the id that ends each document.
END_ID = 2
DICTIONARY_BYTES = 65_536
#: Bounds of the dictionary's training sample: documents, and characters of each (longer ones are not sampled).
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 8000
#: A shard is closed at so many documents or compressed bytes.
SHARD_ROWS, SHARD_BYTES = 1024, 4 << 20
#: Words whose ids a task remembers.
MOST_WORDS = 700_000
#: Characters that are cut from the end of a word: ASCII, and neither letters, numbers nor part of a contraction.
STOPS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"


#: Byte-level tokenizers write a byte that is no visible Latin-1 character as one from U+0100 on, in turn.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


#: Fixed value: the split pattern of word tokenizers that drop white space.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_words(tokenizer_json: str) -> bool:
    """Whether a tokenizer is built so that a text's ids are those of its words: it normalises by NFC, lower
    case and blanks for white space at most, its first split is ``WORD_SPLIT``, of which only the matches
    stay, and no added token holds white space or ends with a stop."""
    built = json.loads(tokenizer_json)
    norm, cut = built.get("normalizer") or {"type": "Sequence", "normalizers": []}, built.get("pre_tokenizer") or {}
    norms, cuts = norm.get("normalizers", [norm]), cut.get("pretokenizers", [cut])
    blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    return (
        all(n == blanks or n in ({"type": "NFC"}, {"type": "Lowercase"}) for n in norms)
        and cuts[0] == {"type": "Split", "pattern": {"Regex": WORD_SPLIT}, "behavior": "Removed", "invert": True}
        and all(c.get("type") == "ByteLevel" and not c.get("add_prefix_space") and not c.get("use_regex") for c in cuts[1:])
        and not built.get("truncation") and not built.get("padding")
        and all(not re.search(r"\s", t["content"]) and t["content"][-1] not in STOPS and not (t["single_word"] or t["normalized"] or t["lstrip"] or t["rstrip"]) for t in built.get("added_tokens", []))
    )


class Words(dict):
    """Ids of words as bytes, found when first asked for; forgets all when there are ``MOST_WORDS``."""

    def __init__(self, learn):
        self.learn = learn
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MOST_WORDS:
            self.clear()
            self[""] = b""
        out = self[word] = self.learn(word)
        return out


class WordEncoder:
    """Ids of a text as little-endian bytes, by way of a bounded memory of its words where that is right.

    Of a tokenizer that :func:`splits_words` a text's ids are the ids of its words in turn, and a word's are
    those of its core and of the stops after it, if the core's normal form ends with a letter or number (it
    may end with a mark, to which the stops would stick). Another tokenizer encodes whole texts.
    """

    def __init__(self, tokenizer_json: str, width: int, end_id: int):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.code = {2: "H", 4: "I"}[width]
        self.end = self._bytes([end_id])
        self.by_word = splits_words(tokenizer_json)
        # whether the model takes letters as they are is seen on words of every Latin-1 letter
        self.plain = self.by_word
        letters = [chr(c) for c in range(256) if chr(c).isalpha()]
        for probe in [*letters, *(f"ab{x}cd" for x in letters), *(f"{x.upper()}e" for x in letters)]:
            coded = self._letters(probe)
            if coded is not None and [t.id for t in self.model.tokenize(coded)] != self._ids(probe):
                self.plain = False
        self.words = Words(self._word)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _letters(self, core: str) -> str | None:
        """What the tokenizer makes of a word of Latin-1 letters before its model: the word in lower case,
        its bytes as the characters of byte-level tokenizers. None for other words."""
        if not self.plain or not core.isalpha():
            return None
        try:
            core.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return core.lower().encode("utf-8").decode("latin-1").translate(BYTE_CHARACTERS)

    def _word(self, word: str) -> bytes:
        if self.plain and word.isascii() and word.isalpha():
            low = word.lower()
            return self._bytes([t.id for t in self.model.tokenize(word)]) if low == word else self.words[low]
        core = word.rstrip(STOPS)
        if core and len(core) < len(word) and unicodedata.category((core if core.isascii() else self.normal(core))[-1])[0] in "LN":
            return self.words[core] + self.words[word[len(core) :]]
        letters = self._letters(word)
        return self._bytes(self._ids(word) if letters is None else [t.id for t in self.model.tokenize(letters)])

    def _join(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.by_word:
            return [self._join(text or "") + self.end for text in texts]
        found = self.tokenizer.encode_batch_fast([text or "" for text in texts], add_special_tokens=False)
        return [self._bytes(x.ids) + self.end for x in found]


def _encoder(tokenizer_json: str, width: int, end_id: int) -> WordEncoder:
    """The encoder of this Python process: a worker keeps its words from task to task."""
    memory = sys.modules.setdefault("gridseries_worker_memory", types.ModuleType("gridseries_worker_memory"))
    key = (hash(tokenizer_json), width, end_id)
    if getattr(memory, "key", None) != key:
        memory.key, memory.encoder = key, WordEncoder(tokenizer_json, width, end_id)
    return memory.encoder


def _width(tokenizer_json: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_str(tokenizer_json).get_vocab(with_added_tokens=True)
    return 2 if max([end_id, *vocabulary.values()]) < 1 << 16 else 4


def train_dictionary(docs: DataFrame, tokenizer_json: str, width: int, end_id: int = END_ID) -> bytes:
    """Dictionary trained on a bounded sample of serialized documents, empty if they are too few."""
    # a share of the ids that gives about SAMPLE_ROWS rows, so that no task sends more than its part
    share = max(1, docs.count() // SAMPLE_ROWS)
    sample = sorted(
        docs.where((F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(share)) == 0) & F.length("text").between(1, SAMPLE_CHARS))
        .select("text").limit(2 * SAMPLE_ROWS).collect()
    )
    arrays = WordEncoder(tokenizer_json, width, end_id).encode([r["text"] for r in sample])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes() if len(arrays) >= 50 else b""
    except zstandard.ZstdError:
        return b""


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode ``docs`` and write the file set to ``path``.

    Null and empty texts are documents of the end id alone. Documents with a null id come first, rows
    of one id are ordered by a hash of their text, repeated rows are written as often. Other columns
    are ignored; an empty table gives a file set without shards.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()  # travels with the job: executors need no file
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    width = _width(tokenizer_json, end_id)
    dictionary = train_dictionary(docs, tokenizer_json, width, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.2 / count))) if count > 1 else []
    shared = spark.sparkContext.broadcast((tokenizer_json, dictionary, np.array(cuts, dtype=np.float64)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, trained, bounds = shared.value
        encoder = _encoder(tokenizer, width, end_id)
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            bucket = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(bounds, known))
            raw = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), ids, batch.column("key"), pa.array([len(r) // width for r in raw], pa.int64()), pa.array([pack.compress(r) for r in raw], pa.binary())],
                names=["bucket", "doc_id", "key", "count", "frame"],
            )

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, number, at = None, 0, 0
        ids, counts, frames, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            return pa.RecordBatch.from_pylist(
                [{"bucket": bucket, "shard": number, "at": at, "dict_hash": dict_hash, "width": width, "doc_ids": ids, "counts": counts, "offsets": offsets, "payload": b"".join(frames)}],
                schema=shard_schema,
            )

        shard_schema = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("at", pa.int64()), ("dict_hash", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in batches:
            for row_bucket, doc_id, n, frame in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "count", "frame")), strict=True):
                if ids and (row_bucket != bucket or len(ids) >= SHARD_ROWS or held + len(frame) > SHARD_BYTES):
                    yield close()
                    number, at = number + 1, at + sum(counts)
                    ids, counts, frames, held = [], [], [], 0
                if row_bucket != bucket:
                    bucket, number, at = row_bucket, 0, 0
                ids.append(doc_id)
                counts.append(n)
                frames.append(frame)
                held += len(frame)
        if ids:
            yield close()

    encoded = docs.withColumn("key", text_key(F.col("text"))).mapInArrow(encode, "bucket int, doc_id long, key long, count long, frame binary")
    placed = encoded.repartitionById(max(1, len(cuts) + 1), "bucket").sortWithinPartitions("bucket", "doc_id", "key")
    placed.mapInArrow(
        shard, "bucket int, shard int, at long, dict_hash string, width int, doc_ids array<long>, counts array<long>, offsets array<long>, payload binary"
    ).write.parquet(f"{path}/shards")
    # one row per bucket: the only sums that meet in one task
    totals = spark.read.parquet(f"{path}/shards").select("bucket", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("bucket").agg(F.sum("n").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).write.parquet(f"{path}/buckets")
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").write.parquet(f"{path}/dictionary")


def read(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, unless ``digest_only``, ``ids`` of every document.

    Refuses a dictionary whose hash is not the one that a shard was written with.
    """
    held = spark.read.parquet(f"{path}/dictionary").first()
    shared = spark.sparkContext.broadcast((held["dict_hash"], bytes(held["dictionary"])))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dict_hash, trained = shared.value
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        for batch in batches:
            for row in range(batch.num_rows):
                of = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                if of["dict_hash"] != dict_hash:
                    raise ValueError("the shard was written with another dictionary")
                start, starts, sums, ids = of["base"] + of["at"], [], [], []
                for k, n in enumerate(of["counts"]):
                    raw = unpack.decompress(of["payload"][of["offsets"][k] : of["offsets"][k + 1]])
                    values = np.frombuffer(raw, dtype=f"<u{of['width']}").astype("<u4")
                    if len(values) != n:
                        raise ValueError("a document's length differs from the index")
                    starts.append(start)
                    sums.append(zlib.crc32(values.tobytes()))
                    start += n
                    if not digest_only:
                        ids.append(values)
                columns = {"doc_id": pa.array(of["doc_ids"], pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(of["counts"], pa.int64()), "ids_crc32": pa.array(sums, pa.int64())}
                if not digest_only:
                    columns["ids"] = pa.array([v.astype(np.int64) for v in ids], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    shards = spark.read.parquet(f"{path}/shards").join(F.broadcast(spark.read.parquet(f"{path}/buckets")), "bucket")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
    return shards.select("base", "at", "dict_hash", "width", "doc_ids", "counts", "offsets", "payload").mapInArrow(decode, schema)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this id, by the offset index: only their frames are decompressed."""
    trained = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    hits = (
        spark.read.parquet(f"{path}/shards").where(F.array_contains("doc_ids", doc_id))
        .select("width", F.explode(F.arrays_zip("doc_ids", F.slice("offsets", 1, F.size("doc_ids")).alias("at"), F.slice("offsets", 2, F.size("doc_ids")).alias("to"))).alias("x"), "payload")
        .where(F.col("x.doc_ids") == doc_id)
        .select("width", F.substring("payload", (F.col("x.at") + 1).cast("int"), (F.col("x.to") - F.col("x.at")).cast("int")).alias("frame"))
    )
    return [np.frombuffer(unpack.decompress(bytes(r["frame"])), dtype=f"<u{r['width']}").tolist() for r in hits.collect()]


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, read back from the files."""
    import public_tokenizers

    path = f"{ensure_shared_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, path, digest_only=True)
