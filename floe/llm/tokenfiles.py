"""Token ids in binary files of fixed-width packed integers.

A shard holds the documents of one range of ids, in ascending order:

    magic (8 bytes)
    blocks: ``block_ids`` ids each (the last may be shorter), every id in
            ``bits`` bits, least significant bit first, padded to whole bytes
    block offsets: n_blocks + 1 unsigned 64-bit file positions
    document ids: signed 64-bit; null flags: one byte each
    document starts: n_docs + 1 unsigned 64-bit positions in the shard's ids
    footer: bits, block_ids, n_docs, n_ids, n_blocks, position of the block
            offsets (unsigned 64-bit each), magic

``bits`` is the least number that holds every id of the vocabulary.  A reader
unpacks a block with numpy at once; a document or any range of ids needs only
the blocks that hold it.

Tasks write shards through ``pyarrow.fs`` into a folder all executors share:
to a name of their own first, then moved to the shard's name, so a task that
runs again replaces its file with the same bytes.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floe.llm.common import stored
from floe.llm.pieces import Memory, library_ids, load_tokenizer, runs, word_ids
from floe.session import scratch_path

MAGIC = b"FLOETOK1"
FOOTER = struct.Struct("<6Q8s")
BLOCK_IDS = 32_768
#: Distinct words a worker remembers.
REMEMBERED = 1_000_000


def bits_for(vocabulary: int) -> int:
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits``-bit integers, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8), axis=None, bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return spread.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class ShardWriter:
    """Writes one shard, holding one block of ids and 17 bytes per document in memory."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.offsets, self.docs, self.nulls, self.starts = [len(MAGIC)], [], [], [0]
        self.held: list[np.ndarray] = []
        self.n_held = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block_ids:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint32)
        whole = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for a in range(0, whole, self.block_ids):
            block = pack(ids[a : min(a + self.block_ids, whole)], self.bits)
            self.out.write(block)
            self.offsets.append(self.offsets[-1] + len(block))
        self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def close(self) -> int:
        """Write the index; the number of ids."""
        self._flush(last=True)
        at = self.offsets[-1]
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array(self.docs, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(FOOTER.pack(self.bits, self.block_ids, len(self.docs), self.starts[-1], len(self.offsets) - 1, at, MAGIC))
        return self.starts[-1]


class ShardReader:
    """Random access to a shard: ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        source.seek(size - FOOTER.size)
        self.bits, self.block_ids, self.n_docs, self.n_ids, n_blocks, at, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        source.seek(at)
        self.offsets = np.frombuffer(source.read(8 * (n_blocks + 1)), "<u8")
        self.docs = np.frombuffer(source.read(8 * self.n_docs), "<i8")
        self.nulls = np.frombuffer(source.read(self.n_docs), np.uint8)
        self.starts = np.frombuffer(source.read(8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        self._cached = (-1, np.empty(0, np.uint32))

    def block(self, k: int) -> np.ndarray:
        if self._cached[0] != k:
            self.source.seek(int(self.offsets[k]))
            data = self.source.read(int(self.offsets[k + 1] - self.offsets[k]))
            self._cached = (k, unpack(data, self.bits, min(self.block_ids, self.n_ids - k * self.block_ids)))
        return self._cached[1]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from the blocks that hold them."""
        parts = []
        for k in range(start // self.block_ids, -(-stop // self.block_ids) if stop > start else start // self.block_ids):
            a = k * self.block_ids
            parts.append(self.block(k)[max(start - a, 0) : stop - a])
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _words_stand_alone(spec: dict) -> bool:
    """Whether white space only parts words for this tokenizer: its normaliser works by
    character, its pattern never covers white space, and added tokens hold none."""
    normal = spec["normalizer"] or {"type": "Sequence", "normalizers": []}
    steps = normal.get("normalizers", [normal])
    pre = spec["pre_tokenizer"] or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    by_character = all(
        s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " " for s in steps
    )
    pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    parted = first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"] and first["pattern"] == {"Regex": pattern}
    plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"]) and not any(ch.isspace() for ch in a["content"]) for a in spec["added_tokens"])
    return by_character and parted and plain


class WordEncoder:
    """Ids of whole texts by the tokenizers library; where words stand alone, each distinct word is encoded about once."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        spec = json.loads(self.tokenizer.to_str())
        self.by_word = _words_stand_alone(spec)
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        self.lower = any(s["type"] == "Lowercase" for s in steps)
        self.memory = Memory(lambda words: word_ids(self.tokenizer, words, self.lower), REMEMBERED)

    def vocabulary(self) -> int:
        return max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for run in runs(texts):
            if not self.by_word:
                yield from (np.frombuffer(b, "<u4") for b in library_ids(self.tokenizer, run))
                continue
            # Cut at ASCII white space only; other white space stays inside a word for the library.
            words = pc.ascii_split_whitespace(pa.array(run, pa.large_string()))
            yield from self.memory.ids(words.flatten(), pc.list_value_length(words).to_numpy())


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every row's whole text (null: empty), append ``end_id``, and write shards into ``folder``.

    Returns the manifest: shard, uri, n_docs, n_ids and first (ids of all
    shards before it).  Documents are in ascending id order over shards and
    inside each (null ids first, repeated ids by text), so a shard is one
    range of ids and no task sees more than its range.  An empty table gives
    an empty manifest; other columns are never looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The beginning of a text orders like the text; rows that agree in all are interchangeable, so a hot id is many shards.
    ranged = rows.repartitionByRange("id", F.left("text", F.lit(64)), F.monotonically_increasing_id()).sortWithinPartitions("id", "text")
    named = ranged.select(F.col("id").cast("string").alias("id"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        base, root = _open(folder)
        e = encoder(tokenizer)
        writer = out = None
        own, final = f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex}", f"{root}/shard-{shard:06d}.tok"
        for pdf in batches:
            if writer is None:
                base.create_dir(root, recursive=True)
                out = base.open_output_stream(own)
                writer = ShardWriter(out, bits_for(max(e.vocabulary(), end_id + 1)))
            for doc, ids in zip(pdf["id"], e.encode(pdf["text"].tolist())):
                writer.add(None if doc is None else int(doc), np.append(ids, np.uint32(end_id)).astype(np.uint32))
        if writer is not None:
            n_ids, n_docs = writer.close(), len(writer.docs)
            out.close()
            base.move(own, final)
            yield pd.DataFrame({"shard": [shard], "uri": [f"{folder}/shard-{shard:06d}.tok"], "n_docs": [n_docs], "n_ids": [n_ids]})

    manifest = stored(named.mapInPandas(run, "shard long, uri string, n_docs long, n_ids long"), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the shards; ids are little-endian unsigned 32-bit integers in a binary."""
    shards = manifest.count()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for uri, first in zip(pdf["uri"], pdf["first"]):
                base, path = _open(uri)
                with base.open_input_file(path) as source:
                    r = ShardReader(source)
                    for a in range(0, r.n_docs, 512):
                        b = min(a + 512, r.n_docs)
                        yield pd.DataFrame(
                            {
                                "doc_id": [None if null else str(d) for d, null in zip(r.docs[a:b], r.nulls[a:b])],
                                "start": r.starts[a:b] + first,
                                "n_tokens": np.diff(r.starts[a : b + 1]),
                                "ids": [r.document(i).astype("<u4").tobytes() for i in range(a, b)],
                            }
                        )

    spread = manifest.repartitionByRange(max(1, shards), "shard")
    rows = spread.select("uri", "first").mapInPandas(run, "doc_id string, start long, n_tokens long, ids binary")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def digest(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """The contract's columns, from the files."""
    manifest = write(docs, tokenizer, end_id, scratch_path(docs.sparkSession, "tokens"))
    return read(stored(manifest, "token-offsets")).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
