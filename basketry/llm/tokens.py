"""Token-ID / binary output: independent zstandard frames with a seek table and checksums.

A shard file holds, in the public seekable zstandard layout,

* data frames: each an ordinary zstandard frame over a few whole documents, so that any reader of
  zstandard can decompress it without the others;
* a skippable frame (magic 0x184D2A50) with the document index: ``count`` as u32, then the first
  document id of every data frame as i64;
* the seek table, a skippable frame (magic 0x184D2A5E): per frame its compressed size, decompressed
  size and the low 32 bits of the XXH64 of its decompressed bytes, each u32; then the footer: number of
  frames u32, descriptor byte (0x80: checksums), magic 0x8F92EAB1. All numbers are little-endian.

A data frame decompresses to: number of documents u32; ids i64 each; validity u8 each (0: the id is
null); numbers of tokens u32 each; then all token ids u32 each.

Shards follow each other in ascending document id (null first; rows that share an id are ordered by
text). A task writes one shard under a name of its own and the manifest, which Spark commits, names the
shards that count: a repeated or lost task leaves a file nobody reads. No task holds more than one
frame, so a long document costs memory in proportion to itself only.

Null texts are encoded as empty ones; every document ends with ``end_id``. An empty table gives an empty
manifest. Columns other than the two named ones are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import file_at, fresh_folder, kept, ship
from basketry.session import materialise

SKIPPABLE, SEEK_TABLE, SEEKABLE_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 256 << 10
#: Runs of characters whose ids a worker keeps, and characters it encodes at once.
KEPT_RUNS, AT_ONCE = 700_000, 2 << 20

MANIFEST = "shard int, path string, documents long, tokens long, frames int"
ENCODED = "doc_id long, start long, n_tokens long, ids_crc32 long"


class ChunkEncoder:
    """Token ids of whole texts, encoding each distinct run of non-white ASCII characters once.

    The tokenizer drops white space before it merges and neither its normaliser nor its pre-tokeniser
    looks across it; it lowers case; and it parts most letters from the signs that follow them. So the ids
    of a text are those of its runs in order, lower-cased, and those of a word with signs are the word's and
    the signs', where the tokenizer's own cut says so. A tokenizer with other settings encodes whole texts.
    Texts that may hold a special token's name keep their case. Every word is encoded by the
    library; tests compare with it on whole texts. The first ``KEPT_RUNS`` runs are kept, others are encoded
    again when they come again."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.parting: dict[str, bool] = {}
        self.whole_texts = not _looks_at_runs_alone(tokenizer_path)
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def _append(self, runs: list[bytes], lengths: np.ndarray, flat: np.ndarray) -> None:
        n = len(self.first) - 1
        self.known.update(zip(runs, range(n, n + len(runs)), strict=True))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, flat])

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs at these places and how many each has."""
        starts, lengths = self.first[at], self.first[at + 1] - self.first[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - ends + lengths, lengths) + np.arange(total)], lengths

    def _learn(self, runs: list[bytes]) -> list[bytes]:
        known = self.known
        new = list(set(runs).difference(known))
        # Only what ends with a sign can be a word with signs.
        cut = [self._word_and_signs(r) if r[-1] in _SIGNS else None for r in new]
        whole = [r for r, m in zip(new, cut, strict=True) if m is None]
        pairs = [(r, *m) for r, m in zip(new, cut, strict=True) if m is not None]
        encode = [p for p in dict.fromkeys([*whole, *(x for p in pairs for x in p[1:])]) if p not in known]
        found = [e.ids for e in self.tokenizer.encode_batch_fast([r.decode() for r in encode], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self._append(encode, lengths, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())))
        if pairs:
            ids, lengths = self._gather(np.array([known[x] for p in pairs for x in p[1:]], np.int64))
            self._append([p[0] for p in pairs], lengths[0::2] + lengths[1::2], ids)
        return [*encode, *(p[0] for p in pairs)]

    def _word_and_signs(self, run: bytes) -> tuple[bytes, bytes] | None:
        """Letters and the signs that follow them, if a run is nothing else and the tokenizer parts them."""
        m = _WORD_AND_SIGNS(run.decode())
        return (m[1].encode(), m[2].encode()) if m and m[1].isalpha() and self._parts(m[1][-1]) else None

    def _parts(self, letter: str) -> bool:
        """Whether the tokenizer cuts between a letter and signs behind it. It normalises before it cuts, and some
        letters become one with a mark behind it, which goes with the signs."""
        if letter not in self.parting:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(letter + ","))
            self.parting[letter] = [piece for piece, _ in cut][-1] == ","
        return self.parting[letter]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str] | list[bytes]) -> list[np.ndarray]:
        """Ids of each text; texts may come as the bytes of their UTF-8."""
        if self.whole_texts:
            whole = [t.decode() if isinstance(t, bytes) else t for t in texts]
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
        split = []
        for text in texts:
            raw = text if isinstance(text, bytes) else text.encode()
            split.append((raw if b"<|" in raw else raw.lower()).split())
        runs = [r for s in split for r in s]
        kept = len(self.known), self.first, self.flat
        added = self._learn(runs)
        ids, lengths = self._gather(np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs)))
        if kept[0] >= KEPT_RUNS:
            for r in added:
                del self.known[r]
            self.first, self.flat = kept[1:]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cuts = ends[np.cumsum([len(s) for s in split], dtype=np.int64)] if split else []
        return np.split(ids, cuts[:-1]) if split else []


def _looks_at_runs_alone(tokenizer_path: str) -> bool:
    """Whether a tokenizer drops white space, lowers case and never looks across white space, so that runs can be
    encoded one by one. Others encode whole texts."""
    with open(tokenizer_path, encoding="utf-8") as held:
        settings = json.load(held)
    steps = [n.get("type") for n in (settings.get("normalizer") or {}).get("normalizers", [])]
    cuts = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = cuts[0] if cuts else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and pattern.endswith("[^\\s\\p{L}\\p{N}]+")
    special = all(t["content"].startswith("<|") for t in settings.get("added_tokens", []))
    return bool(steps == ["NFC", "Replace", "Lowercase"] and drops and special)


#: Signs that never begin a contraction or a special token.
_SIGNS = frozenset(b"!#$%&()*+,-./:;=?@[\\]^_`{}~\"")
_WORD_AND_SIGNS = re.compile(r"([^\W\d_]+)([!-&(-/:;=?@\[-`{}~]+)").fullmatch


def encoder_of(tokenizer_path: str) -> ChunkEncoder:
    """The encoder of this worker process, kept from task to task."""
    return kept(f"tokens {tokenizer_path}", lambda: ChunkEncoder(tokenizer_path))


def parts_of(texts: list[str] | list[bytes], characters: int = AT_ONCE) -> Iterator[slice]:
    """Consecutive texts of about so many ``characters`` (or bytes), one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= characters or i - start >= 1000:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


class ShardWriter:
    """Writes frames to an open stream as documents come."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table: list[tuple[int, int, int]] = []
        self.firsts: list[int] = []
        self.documents = self.tokens = 0
        self._clear()

    def _clear(self) -> None:
        self.ids: list[int | None] = []
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id: int | None, tokens: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.parts.append(tokens)
        self.bytes += tokens.nbytes
        self.documents += 1
        self.tokens += len(tokens)
        if self.bytes >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if not self.ids:
            return
        raw = b"".join(
            [
                struct.pack("<I", len(self.ids)),
                np.array([i or 0 for i in self.ids], "<i8").tobytes(),
                np.array([i is not None for i in self.ids], "u1").tobytes(),
                np.array([len(p) for p in self.parts], "<u4").tobytes(),
                *[p.astype("<u4", copy=False).tobytes() for p in self.parts],
            ]
        )
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.firsts.append(-(2**63) if self.ids[0] is None else self.ids[0])
        self._clear()

    def close(self) -> None:
        self._flush()
        index = struct.pack("<I", len(self.firsts)) + np.array(self.firsts, "<i8").tobytes()
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        rows = [*self.table, (len(index) + 8, 0, 0)]
        body = b"".join(struct.pack("<III", *r) for r in rows) + struct.pack("<IBI", len(rows), 0x80, SEEKABLE_FOOTER)
        self.stream.write(struct.pack("<II", SEEK_TABLE, len(body)) + body)


class ShardReader:
    """Random access to a shard: only the frames that hold what is asked for are read."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_FOOTER:
            raise ValueError("no seek table at the end of the file")
        rows = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), "<u4").reshape(count, 3).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(rows[:, 0])])
        self.table, self.starts = rows[:-1], starts
        index = self._at(int(starts[count - 1]), int(rows[-1, 0]))[8:]
        self.firsts = np.frombuffer(index[4:], "<i8")
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, i: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents of frame ``i``; raises when its checksum does not hold."""
        packed, size, checksum = (int(x) for x in self.table[i])
        raw = self.decompressor.decompress(self._at(int(self.starts[i]), packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        (n,) = struct.unpack_from("<I", raw)
        ids = np.frombuffer(raw, "<i8", n, 4)
        valid = np.frombuffer(raw, "u1", n, 4 + 8 * n)
        counts = np.frombuffer(raw, "<u4", n, 4 + 9 * n).astype(np.int64)
        at = 4 + 13 * n
        for doc_id, known, length in zip(ids.tolist(), valid.tolist(), counts.tolist(), strict=True):
            yield (doc_id if known else None), np.frombuffer(raw, "<u4", length, at)
            at += 4 * length

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(len(self.table)):
            yield from self.frame(i)

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Tokens of every document with this id, reading only frames that can hold it."""
        low = max(0, int(np.searchsorted(self.firsts, doc_id, "left")) - 1)
        high = int(np.searchsorted(self.firsts, doc_id, "right"))
        return [t.copy() for i in range(low, high) for d, t in self.frame(i) if d == doc_id]


def write_shards(
    docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = 1, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shards; returns the stored manifest."""
    ship(docs.sparkSession)
    folder = folder or fresh_folder(docs.sparkSession, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, stream, path = encoder_of(tokenizer_path), None, None, ""
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for part in parts_of(texts):
                if writer is None:
                    path = f"{folder}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zst"
                    files, inner = file_at(path)
                    files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    stream = files.open_output_stream(inner, compression=None)
                    writer = ShardWriter(stream, frame_bytes)
                for doc_id, ids in zip(ids_of[part], encoder.encode_all(texts[part]), strict=True):
                    writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            stream.close()
            row = [TaskContext.get().partitionId()], [path], [writer.documents], [writer.tokens], [len(writer.table)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()), strict=True)],
                names=["shard", "path", "documents", "tokens", "frames"],
            )

    spread = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return materialise(spread.mapInArrow(write, MANIFEST), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """One row per document of the shards: its id, the number of tokens before it in all shards, its
    number of tokens and the crc32 of them. One task per shard; it holds one frame at a time."""
    ship(manifest.sparkSession)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    count = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files, inner = file_at(path)
                with files.open_input_file(inner) as source:
                    reader = ShardReader(source)
                    for i in range(len(reader.table)):
                        ids, tokens = zip(*reader.frame(i), strict=True)
                        sizes = [len(t) for t in tokens]
                        starts = start + np.concatenate([[0], np.cumsum(sizes)])
                        start = int(starts[-1])
                        crcs = [zlib.crc32(t.tobytes()) for t in tokens]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in (ids, starts[:-1], sizes, crcs)],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return placed.repartition(count).mapInArrow(read, ENCODED)
