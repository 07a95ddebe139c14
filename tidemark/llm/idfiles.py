"""Token-id files: encode documents in doc_id order, write compressed blocks, read them back.

**Format.** A folder of Parquet files written by Spark's own committer, so that a lost executor or a repeated
task leaves no half file, on any file system Spark reaches. A row is a frame: whole documents with about
``FRAME_IDS`` ids, in order. It holds the documents' ids and lengths and the frame's ids cut into blocks of
``idcoder.BLOCK``, each coded on its own with models that start fresh, plus each block's byte count and the
CRC-32 of its ids. A block that does not decode to its checksum raises an error that names it.

``part`` and ``frame`` order the frames as the documents are ordered: ascending doc_id, NULL first, and rows of
one doc_id by a hash of the text. A document's ``start`` is the number of ids of all documents before it; only
id counts per part and frame, not documents, are summed up for it.

Whatever stands between two spaces or line feeds is encoded by the tokenizers library once and remembered
per Python worker, up to about ``KNOWN_BYTES``; the tokenizer drops white space and joins nothing across it. New
chunks of many texts are encoded in one call, words of Latin-1 letters once for every case and all marks behind them.

Defined results: a NULL or empty text has the end id alone. Repeated rows are documents of their own.
An empty table writes an empty folder. Other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tidemark.llm import idcoder
from tidemark.llm.frames import forget_others, remember_as, ship_package
from tidemark.operators.keysets import own_exchange
from tidemark.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
FRAME_IDS = 1 << 23
# Bytes of remembered chunks in a worker, what an entry takes besides its text and ids, and bytes of text encoded at once.
KNOWN_BYTES, ENTRY_BYTES, GROUP_BYTES = 120_000_000, 160, 8_000_000
# Fixed value: how pieces that end a word are written.
WORD_END = "</w>"
# Marks behind a word that no rule of the tokenizer joins to it, and words of letters that it lower-cases
# one by one and changes in no other way.
MARKS = "!#$%&()*+,-./:;=?@[]^_`{}~\"\\"
LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
# Fixed value: where case counts before the tokenizer lower-cases, as its special tokens begin with the former, and some
# letters are composed with a mark in one case only.
CASED = "<\\||\\p{M}"
FRAME = (
    "part long, frame long, n_ids long, doc_ids array<long>, lengths array<long>, block_digits binary, "
    "block_crcs binary, payload binary"
)
FRAME_ARROW = pa.schema(
    [("part", pa.int64()), ("frame", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int64())), ("block_digits", pa.binary()), ("block_crcs", pa.binary()),
     ("payload", pa.binary())]
)
DOCUMENT = "part long, frame long, doc_id long, before long, n_tokens long, ids_crc32 long"
DOCUMENT_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("part", "frame", "doc_id", "before", "n_tokens", "ids_crc32")]
)


def listed(values: pa.Array) -> list:
    """Python objects of an array without NULLs, faster than ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of texts, chunk by chunk."""

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        # For words that normalizing and splitting would leave as they are.
        self.plain = Tokenizer.from_file(public_tokenizers.path(name))
        self.plain.normalizer = None
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text and the end id behind."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        reached = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < len(texts):
            done = reached[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(reached, done + GROUP_BYTES, "right")))
            yield from self.encode_group(texts.slice(begin, end - begin))
            begin = end

    def encode_group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        if not pc.any(pc.match_substring_regex(texts, CASED)).as_py():
            texts = pc.ascii_lower(texts)
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        chunks = listed(coded.dictionary)
        self.learn(chunks)
        ids_of = list(map(self.known.__getitem__, chunks))
        ids = np.frombuffer(b"".join(ids_of), "<u4")
        sizes = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) >> 2
        # Ids of every chunk in its place.
        at = coded.indices.to_numpy()
        counts = sizes.take(at)
        ends = np.cumsum(counts)
        places = np.repeat((np.cumsum(sizes) - sizes).take(at) - ends + counts, counts)
        places += np.arange(len(places))
        ids = ids.take(places)
        bounds = np.concatenate(([0], ends)).take(np.cumsum(np.concatenate(([0], pc.list_value_length(split).to_numpy()))))
        last = np.array([END_ID], "<u4")
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield np.concatenate((ids[a:b], last))

    def learn(self, chunks: list[str]) -> None:
        """Have these different chunks in memory. It has two halves, so that chunks in use stay."""
        if self.held > KNOWN_BYTES // 2:
            self.older, self.known, self.held = self.known, {}, 0
        known, older = self.known, self.older
        new = list(filterfalse(known.__contains__, chunks))
        if older:
            for chunk in filter(older.__contains__, new):
                self.keep(chunk, older[chunk])
            new = list(filterfalse(known.__contains__, new))
        # A word and the marks behind it are encoded apart, so each word is encoded once for all its marks.
        stems = pc.utf8_rtrim(pa.array(new, pa.string()), MARKS)
        latin = listed(pc.match_substring_regex(stems, LATIN))
        words, others, joined = set(), set(), []
        for chunk, word, letters in zip(new, listed(pc.utf8_lower(stems)), latin, strict=True):
            if not letters:
                others.add(chunk)
            elif chunk == word:
                words.add(chunk)
            else:
                joined.append((chunk, word, chunk[len(word) :]))
        for parts, found in ((words, {x[1] for x in joined}), (others, {x[2] for x in joined})):
            for part in filterfalse(known.__contains__, found):
                if (ids := older.get(part)) is not None:
                    self.keep(part, ids)
                else:
                    parts.add(part)
        if words:
            plain = list(words)
            ids = np.array(self.plain.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            # The last piece of a word tells that it ends.
            self.cut(plain, ids, np.flatnonzero(self.word_end[ids]) + 1)
        if others:
            plain = list(others)
            encoded = self.tokenizer.encode(plain, is_pretokenized=True, add_special_tokens=False)
            ends = np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(plain)), "right")
            self.cut(plain, np.array(encoded.ids, "<u4"), ends)
        for chunk, word, marks in joined:
            self.keep(chunk, known[word] + known[marks] if marks else known[word])

    def cut(self, chunks: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        begins = [0, *ends[:-1]]
        self.known.update(zip(chunks, [raw[a:b] for a, b in zip(begins, ends, strict=True)], strict=True))
        self.held += ENTRY_BYTES * len(chunks) + sum(map(len, chunks)) + len(raw)

    def keep(self, chunk: str, ids: bytes) -> None:
        self.known[chunk] = ids
        self.held += ENTRY_BYTES + len(chunk) + len(ids)


@lru_cache(maxsize=1)
def encoder(name: str) -> Encoder:
    remember_as(__name__, encoder.cache_clear)
    return Encoder(name)


def frame_row(part: int, frame: int, docs: list[int | None], ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    blocks = [flat[i : i + idcoder.BLOCK] for i in range(0, len(flat), idcoder.BLOCK)]
    payload, digits = [], []
    # Frames of one long document are coded in pieces of bounded memory.
    for at in range(0, len(blocks), FRAME_IDS // idcoder.BLOCK):
        raw, counts = idcoder.encode(blocks[at : at + FRAME_IDS // idcoder.BLOCK])
        payload.append(raw)
        digits.append(counts)
    crcs = np.array([zlib.crc32(b.astype("<u4").tobytes()) for b in blocks], "<u4")
    values = [
        part, frame, len(flat), docs, [len(x) for x in ids],
        np.concatenate(digits).astype("<u4").tobytes(), crcs.tobytes(), b"".join(payload),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(values, FRAME_ARROW, strict=True)], schema=FRAME_ARROW
    )


def read_blocks(item: dict) -> np.ndarray:
    """All ids of a frame; raises on a block that fails its checksum."""
    digits = np.frombuffer(item["block_digits"], "<u4").astype(np.int64)
    crcs = np.frombuffer(item["block_crcs"], "<u4")
    lengths = np.full(len(digits), idcoder.BLOCK)
    lengths[-1] = item["n_ids"] - idcoder.BLOCK * (len(digits) - 1)
    begins = np.cumsum(digits) - digits
    out = []
    for at in range(0, len(digits), FRAME_IDS // idcoder.BLOCK):
        to = min(at + FRAME_IDS // idcoder.BLOCK, len(digits))
        raw = item["payload"][2 * begins[at] : 2 * (begins[to - 1] + digits[to - 1])]
        for k, block in enumerate(idcoder.decode(raw, digits[at:to], lengths[at:to]), start=at):
            if zlib.crc32(block.astype("<u4").tobytes()) != crcs[k]:
                raise ValueError(f"part {item['part']}, frame {item['frame']}: block {k} is damaged")
            out.append(block)
    return np.concatenate(out).astype("<u4")


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = TOKENIZER) -> None:
    """Write the frames of all documents to a new folder."""
    placed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("hash"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(__name__)
        part, frame, held, ids, size = TaskContext.get().partitionId(), 0, [], [], 0
        machine = encoder(tokenizer)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, found in zip(names, machine.encode(batch.column(1)), strict=True):
                held.append(name)
                ids.append(found)
                size += len(found)
                if size >= FRAME_IDS - FRAME_IDS // 16:
                    yield frame_row(part, frame, held, ids)
                    frame, held, ids, size = frame + 1, [], [], 0
        if held:
            yield frame_row(part, frame, held, ids)

    ship_package(docs.sparkSession)
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    dealt.mapInArrow(encode, FRAME).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    ship_package(spark)
    frames = spark.read.schema(FRAME).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                item = batch.slice(i, 1).to_pylist()[0]
                ids = read_blocks(item)
                ends = np.cumsum(np.array(item["lengths"], np.int64))
                begins = np.concatenate(([0], ends[:-1]))
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                size = len(ends)
                columns = [
                    np.full(size, item["part"]), np.full(size, item["frame"]), item["doc_ids"], begins,
                    item["lengths"], crcs,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], schema=DOCUMENT_ARROW
                )

    # One row per frame; the frames of a part, then the parts, are summed up.
    sizes = frames.select("part", "frame", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(
        F.col("part").alias("_p"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base")
    )
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("frame")) - F.col("n_ids")
    offsets = sizes.withColumn("inside", inside).join(parts, F.col("part") == F.col("_p")).select(
        F.col("part").alias("_part"), F.col("frame").alias("_frame"), (F.col("base") + F.col("inside")).alias("offset")
    )
    read = frames.mapInArrow(decode, DOCUMENT)
    at = (F.col("part") == F.col("_part")) & (F.col("frame") == F.col("_frame"))
    return read.join(own_exchange(offsets), at).select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def id_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write all documents' ids and give the digest of what reading them gives."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/ids-{uuid.uuid4()}"
    write_ids(docs, path)
    return read_ids(spark, path)
