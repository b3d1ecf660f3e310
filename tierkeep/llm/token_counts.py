"""Token counts per section by offset-mapped attribution.

A whole document is encoded once; the spans of its tokens are laid over the spans of its sections. A
token inside one section counts there. A token across a boundary counts for the section that holds
most of its characters, the earlier one if several hold as many.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tierkeep.llm.batches import ROWS


class Spans:
    """Tokens of a byte-level vocabulary with the characters that they lie on."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        self._encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last; a token inside a character lies on it."""
        ids = np.array(self._encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self._bytes[ids])
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        return character[ends - self._bytes[ids]], character[ends - 1] + 1


@lru_cache(maxsize=2)
def _spans(path: str, pattern: str) -> Spans:
    return Spans(path, pattern)


def line_starts(text: str) -> np.ndarray:
    """Sections of a text: its lines, each with the line feed that ends it. An empty text has one."""
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.flatnonzero(raw == 10) + 1])
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(raw) else starts


def attributed(first: np.ndarray, last: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens counted for each section, and how many of these cross a boundary.

    Sections begin at ``starts`` and cover ``length`` characters without gaps; they may be empty.
    """
    home = np.searchsorted(starts, first, side="right") - 1
    other = np.searchsorted(starts, last - 1, side="right") - 1
    crossing = np.flatnonzero(home != other)
    ends = np.append(starts[1:], length)
    for t in crossing.tolist():
        among = np.arange(home[t], other[t] + 1)
        held = np.minimum(ends[among], last[t]) - np.maximum(starts[among], first[t])
        home[t] = among[int(held.argmax())]
    return np.bincount(home, minlength=len(starts)), np.bincount(home[crossing], minlength=len(starts))


_SCHEMA = (
    "doc_id bigint, field string, line int, first_char bigint, n_chars bigint, n_tokens bigint, n_crossing bigint, "
    "doc_tokens bigint"
)


def section_tokens(docs: DataFrame, vocabulary: str, pattern: str, fields: Sequence[str] = ("source", "lang", "text")) -> DataFrame:
    """Token counts of every section of every document, which is the text columns ``fields`` joined by spaces.

    Sections are the fields, each with the space that follows, the last field by lines, each with
    its line feed. Rows: ``doc_id``, ``field``, ``line`` (0 for all but the last field's later
    lines), ``first_char`` (in the document), ``n_chars``, ``n_tokens`` (which sum to the document's),
    ``n_crossing`` (of these, tokens that reach into another section), ``doc_tokens``.

    ``vocabulary`` is a rank file of a byte-level vocabulary, ``pattern`` its pattern. NULL fields
    count as empty; empty fields have a row. Repeated documents stay apart as rows of the same id.
    Documents are encoded where they lie, nothing is shuffled. No documents give no rows.
    """
    numbers = ("line", "first_char", "n_chars", "n_tokens", "n_crossing", "doc_tokens")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("field", pa.string()), ("line", pa.int32()), *((n, pa.int64()) for n in numbers[1:])]
    )

    def sections(values: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The document, where its sections start, and their field and line numbers."""
        heads = np.cumsum([0, *(len(v) + 1 for v in values[:-1])])
        lines = line_starts(values[-1])
        starts = np.concatenate([heads[:-1], heads[-1] + lines])
        of = np.concatenate([np.arange(len(values) - 1), np.full(len(lines), len(values) - 1)])
        line = np.concatenate([np.zeros(len(values) - 1, np.int64), np.arange(len(lines))])
        return " ".join(values), starts, of, line

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _spans(vocabulary, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                found: dict[str, list[np.ndarray]] = {n: [] for n in ("row", "field", *numbers)}
                for row, values in enumerate(zip(*(rows.column(f).to_pylist() for f in fields))):
                    document, starts, of, line = sections([v or "" for v in values])
                    first, last = spans.of(document)
                    held, crossing = attributed(first, last, starts, len(document))
                    lengths = np.append(starts[1:], len(document)) - starts
                    row_of, whole = np.full(len(starts), row), np.full(len(starts), len(first))
                    for n, v in zip(found, (row_of, of, line, starts, lengths, held, crossing, whole)):
                        found[n].append(v)
                if not found["row"]:
                    continue
                flat = {n: np.concatenate(v) for n, v in found.items()}
                columns = [
                    rows.column("doc_id").take(pa.array(flat["row"])),
                    pa.array(list(fields)).take(pa.array(flat["field"])),
                    *(pa.array(flat[n]).cast(schema.field(n).type) for n in numbers),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    texts = (docs[f].cast("string").alias(f) for f in fields)
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), *texts).mapInArrow(count, _SCHEMA)
