"""Token ids in wavelet-matrix files.

A shard file holds the ids of whole documents as bit-planes: plane 0 has the
highest bit of every id; behind it ids with a 0 stand before those with a 1, in
order, and so on down to the lowest bit. Planes are cut into blocks that are
compressed one by one and carry the number of ones before them, so that access,
counting and lookup of a token touch one or two blocks per plane of one file.

Layout (little-endian): ``WVM1``, planes u8, documents u32, ids u64, then the
lengths u64 and bytes of the sections: document ids (zstd, i64), their null mask
(zstd, u8), document starts (zstd, u64), and per plane the zeros u64, the block
directory (per block: end of its bytes u64, ones before it u64) and the blocks.

Null and empty texts are documents of the end id alone. Null ids come first.
Repeated rows are written each, equal ids ordered by text. An empty table gives
no shard. Extra columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zlib
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proteoframe.llm.base import running_sum, small_batches, store

#: Ids of a shard: documents are added until it has as many.
SHARD_IDS = 1 << 22
BLOCK_BITS = 1 << 16
#: Words of a generation of the ids that a Python worker remembers.
CACHE_WORDS = 700_000
#: Plain words: letters below LATIN_END but for DOTTED (lower case adds an accent to it), then some of MARKS.
#: TOGETHER of their letter runs are encoded in one text.
MARKS, LATIN_END, DOTTED, TOGETHER = ".,!?;:", "\u0280", "\u0130", 250
#: Bytes of UTF-8 texts whose letters all lie below LATIN_END.
LATIN_BYTES = bytes(range(0xCA))
_HEAD = struct.Struct("<4sBIQ")
_RAW = b"\x00"


def _pack(data: bytes) -> bytes:
    small = zstandard.compress(data, 1)
    return b"\x01" + small if len(small) < len(data) else _RAW + data


def _unpack(data: bytes) -> bytes:
    return data[1:] if data[:1] == _RAW else zstandard.decompress(data[1:])


def write_shard(ids: np.ndarray, starts: np.ndarray, docs: list[int | None], planes: int) -> bytes:
    """The file of one shard. ``starts``: where each document begins in ``ids``."""
    null = np.array([d is None for d in docs], dtype=np.uint8)
    known = np.array([0 if d is None else d for d in docs], dtype="<i8")
    sections = [_pack(known.tobytes()), _pack(null.tobytes()), _pack(np.asarray(starts, dtype="<u8").tobytes())]
    now = ids
    for p in range(planes - 1, -1, -1):
        ones = ((now >> now.dtype.type(p)) & now.dtype.type(1)).astype(bool)
        packed = np.packbits(ones, bitorder="little")
        step = BLOCK_BITS // 8
        blocks = [_pack(packed[i:i + step].tobytes()) for i in range(0, len(packed), step)]
        counts = np.array([np.bitwise_count(packed[i:i + step]).sum(dtype=np.int64) for i in range(0, len(packed), step)], dtype=np.int64)
        table = np.stack([np.cumsum([len(b) for b in blocks]), np.cumsum(counts) - counts]) if blocks else np.zeros((2, 0))
        sections.append(struct.pack("<QQ", len(ones) - int(counts.sum()), len(blocks))
                        + table.astype("<u8").tobytes() + b"".join(blocks))
        now = np.concatenate([now[~ones], now[ones]])
    lengths = struct.pack(f"<{len(sections)}Q", *map(len, sections))
    return _HEAD.pack(b"WVM1", planes, len(docs), len(ids)) + lengths + b"".join(sections)


class Shard:
    """A shard file opened from its bytes; blocks are unpacked when they are touched."""

    def __init__(self, data: bytes) -> None:
        magic, self.planes, n_docs, self.n = _HEAD.unpack_from(data)
        if magic != b"WVM1":
            raise ValueError("not a wavelet shard")
        lengths = struct.unpack_from(f"<{3 + self.planes}Q", data, _HEAD.size)
        at = _HEAD.size + 8 * len(lengths)
        parts = []
        for size in lengths:
            parts.append(data[at:at + size])
            at += size
        ids, null, starts = (np.frombuffer(_unpack(p), dtype=t) for p, t in zip(parts, ("<i8", "u1", "<u8")))
        self.docs = [None if z else int(i) for i, z in zip(ids, null)]
        self.starts = starts.astype(np.int64)
        self._planes = []
        for p in parts[3:]:
            zeros, blocks = struct.unpack_from("<QQ", p)
            table = np.frombuffer(p, dtype="<u8", count=2 * blocks, offset=16).reshape(2, blocks).astype(np.int64)
            self._planes.append((zeros, table[0], table[1], p[16 + 16 * blocks:]))

    def _block(self, plane: int, block: int) -> np.ndarray:
        _, ends, _, data = self._planes[plane]
        raw = _unpack(data[ends[block - 1] if block else 0:ends[block]])
        size = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
        return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=size, bitorder="little")

    def _bit_rank(self, plane: int, i: int) -> tuple[int, int]:
        """Bit at ``i`` (0 at the end) and ones before it."""
        block, rest = divmod(i, BLOCK_BITS)
        if block == len(self._planes[plane][1]):
            return 0, self.n - self._planes[plane][0]
        bits = self._block(plane, block)
        ones = int(self._planes[plane][2][block]) + int(bits[:rest].sum())
        return (int(bits[rest]) if rest < len(bits) else 0), ones

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p in range(self.planes):
            bit, ones = self._bit_rank(p, i)
            value = value << 1 | bit
            i = self._planes[p][0] + ones if bit else i - ones
        return value

    def _interval(self, token: int, i: int) -> tuple[int, int]:
        """Where, behind the last plane, the ``token``s before position ``i`` stand."""
        low, high = 0, i
        if token >> self.planes:
            return 0, 0
        for p in range(self.planes):
            a, b = self._bit_rank(p, low)[1], self._bit_rank(p, high)[1]
            if token >> (self.planes - 1 - p) & 1:
                low, high = self._planes[p][0] + a, self._planes[p][0] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before position ``i``."""
        low, high = self._interval(token, i)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _bit_select(self, plane: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) ``bit`` of a plane."""
        _, _, ones, _ = self._planes[plane]
        before = ones if bit else np.arange(len(ones)) * BLOCK_BITS - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(plane, block) == bit)[k - before[block]])

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``token``."""
        low, high = self._interval(token, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for p in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - p) & 1
            i = self._bit_select(p, bit, i - self._planes[p][0] if bit else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in order, plane by plane from the lowest."""
        now = np.zeros(self.n, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for p in range(self.planes - 1, -1, -1):
            zeros, ends, _, _ = self._planes[p]
            ones = np.concatenate([self._block(p, b) for b in range(len(ends))] or [np.zeros(0, np.uint8)]).view(bool)
            out = np.empty_like(now)
            out[~ones] = now[:zeros]
            out[ones] = now[zeros:] | now.dtype.type(1 << (self.planes - 1 - p))
            now = out
        return now


class Generations:
    """A table of bounded size: when it is full it becomes the old generation, and what is asked for
    again comes back from there, so frequent keys stay."""

    def __init__(self, size: int) -> None:
        # Plain dicts: a set is compared with them without a walk over all their keys.
        self.size, self.now, self.old = size, {}, {}

    def __getitem__(self, key: bytes) -> bytes:
        return self.now[key]

    def __len__(self) -> int:
        return len(self.now)

    def missing(self, keys: set) -> list:
        """Keys that neither generation has; the others are in ``now`` afterwards."""
        if len(self.now) > self.size:
            self.old, self.now = self.now, {}
        new, now, old = [], self.now, self.old
        for key in keys.difference(now):
            known = old.get(key)
            if known is None:
                new.append(key)
            else:
                now[key] = known
        return new


def words_of(text: str | None) -> list[bytes]:
    """What stands between ASCII white space, where the tokenizer splits too.

    It folds case as well, so texts of plain letters are folded here, at once and before words are told apart.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw.translate(None, LATIN_BYTES) and DOTTED.encode() not in raw:
        raw = text.lower().encode("utf-8", "surrogatepass") if text else raw
    return raw.split()


class WordIds(Generations):
    """Ids of words as bytes, remembered from text to text.

    A plain word is a run of letters with a few marks behind; the tokenizer folds
    case and treats both runs alone. With ``ends``, which says of every id
    whether it ends a run, the letter runs of plain words are encoded many at a
    time, once for all marks behind them, and cut apart afterwards.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], dtype: str, ends: np.ndarray | None = None,
                 encode_runs: Callable[[list[str]], list[list[int]]] | None = None) -> None:
        super().__init__(CACHE_WORDS)
        self.encode, self.dtype, self.ends, self.encode_runs = encode, dtype, ends, encode_runs or encode
        self.marks = {"": b""}

    def learn(self, texts: list[list[bytes]]) -> None:
        runs, marked, others = set(), [], []
        missing, now = self.missing(set().union(*texts)), self.now
        for word in missing:
            text = word.decode("utf-8", "surrogatepass")
            letters = text.rstrip(MARKS) if self.ends is not None else ""
            if letters.isalpha() and len(text) - len(letters) <= 2 and (
                    letters.isascii() or max(letters) < LATIN_END and DOTTED not in letters):
                low = letters.lower()
                runs.add(low)
                if low != text:
                    marked.append((word, low, text[len(letters):]))
            else:
                others.append((word, text))
        new = [run for run in runs if run.encode() not in now]
        for k in range(0, len(new), TOGETHER * 64):
            self._together(new[k:k + TOGETHER * 64])
        for marks in {m for _, _, m in marked}.difference(self.marks):
            self.marks[marks] = self._bytes(self.encode([marks])[0])
        for word, run, marks in marked:
            now[word] = now[run.encode()] + self.marks[marks]
        for (word, _), ids in zip(others, self.encode([t for _, t in others])):
            now[word] = self._bytes(ids)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _together(self, runs: list[str]) -> None:
        cuts = range(0, len(runs), TOGETHER)
        for k, ids in zip(cuts, self.encode_runs([" ".join(runs[k:k + TOGETHER]) for k in cuts])):
            part, ids = runs[k:k + TOGETHER], np.array(ids, dtype=self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):  # the tokenizer sees other runs: ask it for each
                self.now.update((run.encode(), self._bytes(own)) for run, own in zip(part, self.encode(part)))
                continue
            raw, start = ids.tobytes(), 0
            for run, end in zip(part, (ends * ids.itemsize).tolist()):
                self.now[run.encode()] = raw[start:end]
                start = end


_words: dict[str, WordIds] = {}


def word_ids(tokenizer_file: str, dtype: str) -> WordIds:
    """One memory of word ids for each tokenizer in a Python worker."""
    key = f"{tokenizer_file} {dtype}"
    if key not in _words:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        def encoder(tokenizer: Tokenizer) -> Callable[[list[str]], list[list[int]]]:
            return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        tokenizer = Tokenizer.from_file(tokenizer_file)
        ends = runs = None
        if tokenizer.model.end_of_word_suffix == "</w>":
            ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
            ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
            # Letter runs come folded and apart: the same model needs no normaliser and no pattern for them.
            plain = Tokenizer.from_file(tokenizer_file)
            plain.normalizer = normalizers.Sequence([])
            plain.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            runs = encoder(plain)
        _words[key] = WordIds(encoder(tokenizer), dtype, ends, runs)
    return _words[key]


SHARDS = "part int, seq int, n_docs long, n_ids long, shard binary"


def shards(docs: DataFrame, tokenizer_file: str, end_id: int = 2, planes: int = 16, doc_id: str = "doc_id",
           text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shard files of all documents in ascending id order, one row each: ``part, seq, n_docs, n_ids, shard``.

    Texts are dealt by ranges of ids and encoded where they are written; a task
    holds one shard at a time. ``planes`` must cover the vocabulary.
    """
    small_batches(docs.sparkSession)
    dtype = "<u2" if planes <= 16 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer_file, dtype), np.array([end_id], dtype=dtype).tobytes()
        width, part, seq = len(end), TaskContext.get().partitionId(), 0
        names, texts, size = [], [], 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(t) // width for t in texts])
            ids = np.frombuffer(b"".join(texts), dtype=dtype)
            data = write_shard(ids, np.cumsum(lengths) - lengths, names, planes)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(names)]), "n_ids": pa.array([len(ids)]),
                "shard": pa.array([data], pa.binary())})

        for batch in batches:
            split = list(map(words_of, batch.column("text").to_pylist()))
            words.learn(split)
            for name, found in zip(batch.column("doc_id").to_pylist(), split):
                names.append(name)
                texts.append(b"".join(map(words.now.__getitem__, found)) + end)
                size += len(texts[-1]) // width
                if size >= shard_ids:
                    yield shard()
                    names, texts, size, seq = [], [], 0, seq + 1
        if names:
            yield shard()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(write, SHARDS)


def read_documents(files: DataFrame) -> DataFrame:
    """Per document of the shard files: ``part, seq, doc_id, at`` (ids before it in its shard), ``n_tokens, ids_crc32``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "shard"))):
                shard = Shard(data)
                ids = shard.ids().astype("<u4")
                ends = np.r_[shard.starts[1:], shard.n]
                crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(shard.starts, ends)]
                n = len(shard.docs)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part] * n, pa.int32()), "seq": pa.array([seq] * n, pa.int32()),
                    "doc_id": pa.array(shard.docs, pa.int64()), "at": pa.array(shard.starts, pa.int64()),
                    "n_tokens": pa.array(ends - shard.starts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return files.select("part", "seq", "shard").mapInArrow(
        read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")


def documents(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from stored shard files."""
    sizes = files.select("part", "seq", "n_ids", F.lit(1).alias("all"))
    starts = store(running_sum(sizes, ["all"], "part", ["seq"], "n_ids", "_before").select("part", "seq", "_before"))
    return (read_documents(files).join(starts, ["part", "seq"])
            .select("doc_id", (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))
