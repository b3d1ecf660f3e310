"""Token ids in Arrow IPC files of fixed-size lists, and reading them back at random.

Documents follow one another in ascending id order, each closed by an end id. The stream is cut into
sequences of equal length; a file's record batches hold them as fixed-size lists (``ids``, and
``mask``: false where a file's last sequence is filled up), so that sequence k of a file is found by
division and read without copying or decoding. An index table lists where each document lies.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierkeep.llm.batches import map_batches
from tierkeep.session import cut, scratch_path

#: Ids of a sequence, sequences of a record batch, and ids after which a file is closed.
SEQUENCE, BATCH, FILE = 1024, 256, 1 << 24

#: Words whose ids a worker remembers; it forgets them all when so many are reached.
REMEMBERED = 300_000

#: Bytes of text that are encoded at a time (one text may be longer), and words whose ids are laid out at a time.
SLICE, WORDS = 8 << 20, 1 << 20

# A word of Latin letters, each one code point, and ASCII signs behind it that form one piece: no
# apostrophe, which may begin a piece of its own, and none of the signs that special tokens are written with.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:;=?@\[-`{}~]*)")

# The signs that byte-level vocabularies write for the bytes 0 to 255: the byte itself if that is a
# visible Latin-1 sign, else the next free one from 256 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SIGNS = dict(zip((b for b in range(256) if b not in _VISIBLE), range(256, 512)))


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space, so that its words can be encoded apart.

    ``encode`` gives the ids of the library for the whole text, without special tokens. The texts of
    a slice are split and their words numbered by Arrow, so that Python sees each distinct word once a
    slice; their ids are then laid out by numpy. Words that came before are remembered, the others
    are encoded in one call. Latin letters need no normalising but lower case, and form one piece, so
    for them the vocabulary's model alone is asked, in the signs it has for their bytes; signs behind
    them are a piece of their own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._whole = Tokenizer.from_file(path)
        self._letters = Tokenizer(self._whole.model)
        self.kind = np.dtype(np.uint16 if self._whole.get_vocab_size() <= 1 << 16 else np.uint32)
        self._known: dict[bytes, bytes] = {b"": b""}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as bytes of ``kind``."""
        ids, ends = self.encode_column(pa.array(texts, pa.binary()).cast(pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no NULLs) one after another, and where each text's begin, with their number last."""
        words = pc.ascii_split_whitespace(texts)
        first_word = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
        numbered = words.flatten().dictionary_encode()
        distinct = numbered.dictionary.cast(pa.binary()).to_pylist()
        self._learn(distinct)
        found = [self._known[w] for w in distinct]
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        table, place = np.frombuffer(b"".join(found), self.kind), np.cumsum(size) - size
        codes = numbered.indices.to_numpy(zero_copy_only=False)
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(size[codes], out=ends[1:])
        out = np.empty(ends[-1], self.kind)
        for start in range(0, len(codes), WORDS):
            some = codes[start : start + WORDS]
            low, high = ends[start], ends[start + len(some)]
            out[low:high] = table[np.arange(low, high) + np.repeat(place[some] - ends[start : start + len(some)], size[some])]
        return out, ends[first_word.astype(np.int64)]

    def _learn(self, words: list[bytes]) -> None:
        if len(self._known) > REMEMBERED:
            self._known = {b"": b""}
        known, ends, letters, others = self._known, {}, set(), []
        for word in words:
            if word in known:
                continue
            plain = _PLAIN.fullmatch(word.decode())
            if plain is not None:
                stem = plain[1].lower()
                ends[word] = (stem, plain[2])
                letters.add(stem)
            else:
                others.append(word.decode())
                ends[word] = (others[-1], "")
        marks = list({mark for _, mark in ends.values()})
        letters = list(letters)
        signs = [w if w.isascii() else w.encode().decode("latin-1").translate(_SIGNS) for w in letters]
        fresh = dict(zip(others, self._ids(self._whole, others)))
        fresh.update(zip(letters, self._ids(self._letters, signs)))
        behind = {"": b"", **dict(zip(marks, (self._ids(self._whole, [m])[0] if m else b"" for m in marks)))}
        for word, (stem, mark) in ends.items():
            known[word] = fresh[stem] + behind[mark]

    def _ids(self, tokenizer: Tokenizer, words: list[str]) -> list[bytes]:
        if not words:
            return []
        found = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, self.kind).tobytes()
        of = np.array([-1 if i is None else i for i in found.word_ids], np.int64)
        at = (np.searchsorted(of, np.arange(len(words) + 1)) * self.kind.itemsize).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _schema(kind: pa.DataType, sequence: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE`` bytes of text each, of one row at least."""
    size = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // SLICE
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield batch.slice(a, b - a)


class _FileWriter:
    """One file at a time, a record batch whenever enough ids have come. The name is never used twice,
    so what a lost task wrote stays behind unread."""

    def __init__(self, folder: str, sequence: int, kind: np.dtype):
        self._system, self._folder = _filesystem(folder)
        self._sequence, self._kind = sequence, kind
        self._open()

    def _open(self) -> None:
        self.name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.arrow"
        self._sink = self._system.open_output_stream(f"{self._folder}/{self.name}")
        self._schema = _schema(pa.from_numpy_dtype(self._kind), self._sequence)
        self._out = ipc.new_file(self._sink, self._schema)
        self._waiting: list[bytes] = []
        self._held = 0
        self.ids = 0

    def add(self, ids: bytes) -> None:
        self._waiting.append(ids)
        self._held += len(ids)
        self.ids += len(ids) // self._kind.itemsize
        if self._held >= self._sequence * BATCH * self._kind.itemsize:
            self._put(last=False)

    def _put(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self._waiting), self._kind)
        block = self._sequence * (1 if last else BATCH)
        whole = -(-len(flat) // block) * block if last else len(flat) // block * block
        real = min(len(flat), whole)
        padded = np.zeros(whole, self._kind)
        padded[:real] = flat[:real]
        mask = np.arange(whole) < real
        step = self._sequence * BATCH
        for start in range(0, whole, step):
            parts = (pa.array(padded[start : start + step]), pa.array(mask[start : start + step]))
            lists = [pa.FixedSizeListArray.from_arrays(p, self._sequence) for p in parts]
            self._out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self._schema))
        rest = flat[real:].tobytes()
        self._waiting, self._held = ([rest] if rest else []), len(rest)

    def close(self) -> None:
        self._put(last=True)
        self._out.close()
        self._sink.close()

    def roll(self) -> None:
        self.close()
        self._open()


_INDEX = "doc_id bigint, part int, file string, file_no int, first bigint, n_tokens bigint"


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, sequence: int = SEQUENCE, file_ids: int = FILE
) -> DataFrame:
    """Encode whole texts, write the files below ``folder``, and return the index, written once.

    The index has a row per document: ``doc_id``, ``file``, ``part`` and ``file_no`` (which order the
    files), ``first`` (its first id's place in the file) and ``n_tokens`` (with the end id). Texts
    are range-partitioned by id, then by how they begin, so files in order hold ids in order and an id
    of very many documents spreads over tasks; documents of one id follow each other in the order of
    their texts, NULL ids come first, NULL texts are empty. A task keeps one record batch in memory. ``docs`` needs ``doc_id`` and ``text``. No documents give no files.
    """
    system, path = _filesystem(folder)
    system.create_dir(path, recursive=True)
    text = F.coalesce("text", F.lit("")).alias("text")
    placed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).repartitionByRange("doc_id", F.substring("text", 1, 16))
    placed = placed.sortWithinPartitions("doc_id", "text")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        closing = np.array([end_id], encoder.kind).tobytes()
        out, part, file_no = None, TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for rows in _slices(batch):
                index: dict[str, list] = {n: [] for n in ("doc_id", "part", "file", "file_no", "first", "n_tokens")}
                flat, ends = encoder.encode_column(rows.column("text"))
                for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    if out is None:
                        out = _FileWriter(folder, sequence, encoder.kind)
                    elif out.ids >= file_ids:
                        out.roll()
                        file_no += 1
                    row = (doc_id, part, out.name, file_no, out.ids, b - a + 1)
                    for values, value in zip(index.values(), row):
                        values.append(value)
                    out.add(flat[a:b].tobytes() + closing)
                yield pa.RecordBatch.from_pydict(
                    index, schema=pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("file", pa.string()),
                                             ("file_no", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64())])
                )
        if out is not None:
            out.close()

    return cut(placed.mapInArrow(write, _INDEX))


class TokenFile:
    """Random access to one file; local files are mapped, so only what is asked for is read."""

    def __init__(self, folder: str, name: str):
        system, path = _filesystem(folder)
        local = isinstance(system, fs.LocalFileSystem)
        self._source = pa.memory_map(f"{path}/{name}") if local else system.open_input_file(f"{path}/{name}")
        self._file = ipc.open_file(self._source)
        self._sequence = self._file.schema.field("ids").type.list_size
        self._at, self._flat, self._real = -1, None, None

    def _batch(self, number: int) -> None:
        if number != self._at:
            ids, mask = self._file.get_batch(number).columns
            self._flat = ids.flatten().to_numpy(zero_copy_only=True)
            self._real = mask.flatten().to_numpy(zero_copy_only=False)
            self._at = number

    def ids(self, first: int, n: int) -> np.ndarray:
        """Ids ``first`` to ``first + n`` that the masks do not call filling; a view of the file if they
        lie in one record batch. Fewer than ``n`` come back if the file ends before."""
        step, parts, last = self._sequence * BATCH, [], first + n
        while first < last:
            number, place = divmod(first, step)
            if number >= self._file.num_record_batches:
                break
            self._batch(number)
            span = slice(place, place + last - first)
            flat, real = self._flat[span], self._real[span]
            parts.append(flat if real.all() else flat[real])
            first += len(flat)
            if len(real) < min(step - place, last - first + len(flat)):
                break
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``number`` and its mask."""
        batch = self._file.get_batch(number // BATCH)
        ids, mask = (batch.column(c)[number % BATCH].values for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)

    def close(self) -> None:
        self._source.close()


def read_documents(index: DataFrame, folder: str, end_id: int = 1) -> DataFrame:
    """What the files hold for every document of the index: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``n_tokens`` counts the ids read back whose mask is true, ``start`` those of all documents before,
    over all files, and ``ids_crc32`` is taken of them as little-endian 32-bit integers. The index only
    tells where to look: ValueError is raised if a file holds fewer ids than it says, or no end id behind
    them. The window that adds up files runs over one row per file.
    """

    def read(batch: pa.RecordBatch) -> dict[str, object]:
        crc, counts, now, opened = [], [], None, None
        for name, first, n in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "n_tokens"))):
            if name != now:
                if opened is not None:
                    opened.close()
                now, opened = name, TokenFile(folder, name)
            ids = opened.ids(first, n)
            if len(ids) != n or ids[-1] != end_id:
                raise ValueError(f"{name} does not hold the {n} ids from {first} on that its index names")
            counts.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
        if opened is not None:
            opened.close()
        return {
            **{c: batch.column(c) for c in ("doc_id", "part", "file_no", "file", "first")},
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
        }

    checked = cut(map_batches(index, read, f"{_INDEX}, ids_crc32 bigint"))
    files = checked.groupBy("part", "file_no", "file").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(files.select(F.col("file").alias("_file"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    joined = checked.join(offsets, F.col("file") == F.col("_file"))
    return joined.select("doc_id", (F.col("_before") + F.col("first")).cast("bigint").alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write the files below ``folder`` (a new one in the shared folder if none is given) and read them back."""
    target = scratch_path(docs.sparkSession, "tokens") if folder is None else folder
    return read_documents(write_tokens(docs, target, tokenizer, end_id), target, end_id)
