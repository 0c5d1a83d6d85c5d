"""Packing of token sequences: bounded-space best fit with cuts, then a merge of what stayed open."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.staging import staged

SIZE = 1024
WINDOWS = 16
FAN_IN = 64
SEPARATOR = (0).to_bytes(4, "little")
PART_CHARACTERS = 1 << 20
BATCH_ROWS = 20_000

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64()),
    ("ids", pa.binary()),
])
PIECES_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "part long, ids binary")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: visible ones stand for themselves, the others come after 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """Ids of a text as little-endian 32-bit bytes, by the byte-level BPE vocabulary of a ``tokenizers`` file.

    The ids are those that library gives: its added tokens are found in texts first, the rest is encoded by merges, here
    with a faster encoder. The vocabulary's pattern starts a new token at a single space between two visible characters,
    so a very long text is cut there into parts of a bounded size; added tokens may not hold spaces.
    """

    _loaded: dict[str, "Tokenizer"] = {}
    cut = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        if any(re.search(r"\s", content) for content in added):
            raise ValueError("an added token holds a space")
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in stored["model"]["vocab"].items() if token not in added}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    @classmethod
    def load(cls, path: str) -> "Tokenizer":
        """One per worker process."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, text: str | None, part: int = PART_CHARACTERS) -> bytes:
        out, at, text = [], 0, text or ""
        while at < len(text):
            found = self.cut.search(text, at + part) if len(text) - at > part else None
            end = found.start() if found else len(text)
            out.append(np.array(self.encoding.encode(text[at:end], allowed_special="all"), "<u4").tobytes())
            at = end
        return b"".join(out)


class Packer:
    """At most ``windows`` open sequences; ``done`` collects the pieces of closed ones."""

    def __init__(self, size: int, windows: int, first_sequence: int):
        self.size, self.windows, self.next = size, windows, first_sequence
        self.open: list[list] = []
        self.used: list[int] = []
        self.done: list[tuple] = []

    def add(self, doc_id, doc_tokens: int, start: int, ids: bytes) -> None:
        """Whole sequences are cut off first; the rest goes where it fits best."""
        count = len(ids) // 4
        at = 0
        while count - at >= self.size:
            self._close([(doc_id, doc_tokens, start + at, ids[4 * at:4 * (at + self.size)])])
            at += self.size
        rest = count - at
        if rest:
            self._place(doc_id, doc_tokens, start + at, ids[4 * at:])

    def _place(self, doc_id, doc_tokens: int, start: int, ids: bytes) -> None:
        need = len(ids) // 4
        fits = [(self.size - used, i) for i, used in enumerate(self.used) if used + need <= self.size]
        if fits:
            i = min(fits)[1]
        elif len(self.open) < self.windows:
            self.open.append([])
            self.used.append(0)
            i = len(self.open) - 1
        else:  # the fullest is topped up, so it leaves without padding
            i = max(range(len(self.used)), key=lambda j: (self.used[j], -j))
            free = self.size - self.used[i]
            self._close([*self.open.pop(i), (doc_id, doc_tokens, start, ids[:4 * free])])
            self.used.pop(i)
            self._place(doc_id, doc_tokens, start + free, ids[4 * free:])
            return
        self.open[i].append((doc_id, doc_tokens, start, ids))
        self.used[i] += need
        if self.used[i] == self.size:
            self.used.pop(i)
            self._close(self.open.pop(i))

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc_id, doc_tokens, start, ids in pieces:
            length = len(ids) // 4
            self.done.append((doc_id, start, length, zlib.crc32(ids), doc_tokens, self.next, offset, ids))
            offset += length
        self.next += 1

    def finish(self) -> None:
        """Join the open sequences end to end; the last one is cut at powers of two, which need no padding."""
        pieces = [piece for _, window in sorted(zip(self.used, self.open), key=lambda x: -x[0]) for piece in window]
        left = sum(self.used)
        self.open, self.used = [], []
        current, room = [], self._next_length(left)
        for doc_id, doc_tokens, start, ids in pieces:
            while ids:
                take = min(room, len(ids) // 4)
                current.append((doc_id, doc_tokens, start, ids[:4 * take]))
                start, ids, room, left = start + take, ids[4 * take:], room - take, left - take
                if not room:
                    self._close(current)
                    current, room = [], self._next_length(left)

    def _next_length(self, left: int) -> int:
        return self.size if left >= self.size else 1 << max(0, left.bit_length() - 1)


def _record_batch(rows: list[tuple], part: int | None, keep_ids: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 8
    arrays = [pa.array(columns[i], pa.int64()) for i in range(7)]
    arrays.append(pa.array([part] * len(rows), pa.int64()))
    arrays.append(pa.array(columns[7] if keep_ids else [None] * len(rows), pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, schema=PIECES)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         windows: int = WINDOWS, fan_in: int = FAN_IN, keep_ids: bool = False) -> DataFrame:
    """Pieces of tokenised documents, placed in sequences of at most ``size`` tokens (a power of two).

    Every task keeps ``windows`` open sequences. A document's whole sequences are cut off, its rest goes to the
    open sequence with the least room that holds it; where none does and no more may be opened, the fullest is
    filled with a cut of it and leaves. What a task leaves open (under ``windows * size`` tokens) goes, ``fan_in``
    tasks together, to a merge that packs it the same way and cuts its last sequence at powers of two. So every
    sequence is full or as long as a power of two, and nothing is padded.

    ``vocabulary`` is the path of a ``tokenizers`` file. A document is its ids and a separator, id 0; a null or empty text is
    the separator alone, a very long one is cut like any other and encoded in parts. Rows that repeat
    an id are documents of their own; a null id stays null. An empty table gives no rows. Only the two named
    columns are read, so others may have any name. ``keep_ids`` adds the ids of each piece (32-bit, little-endian).
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokenizer, packer = Tokenizer.load(vocabulary), Packer(size, windows, part << 32)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                encoded = tokenizer.encode(texts[i].as_py()) + SEPARATOR
                packer.add(ids[i].as_py(), len(encoded) // 4, 0, encoded)
                if len(packer.done) >= BATCH_ROWS:
                    yield _record_batch(packer.done, None, keep_ids)
                    packer.done = []
        yield _record_batch(packer.done, None, keep_ids)
        left = [(doc_id, start, len(ids) // 4, None, doc_tokens, w, k, ids)
                for w, window in enumerate(packer.open) for k, (doc_id, doc_tokens, start, ids) in enumerate(window)]
        yield _record_batch(left, part, True)

    def merge(key: tuple, left: pa.Table) -> pa.Table:
        packer = Packer(size, windows, (1 << 62) + (key[0].as_py() << 32))
        for row in left.sort_by([("part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            packer.add(row["doc_id"], row["doc_tokens"], row["start"], row["ids"])
        packer.finish()
        return pa.Table.from_batches([_record_batch(packer.done, None, keep_ids)])

    pieces = staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                    .mapInArrow(first, PIECES_DDL), "pieces")
    left = pieces.where("part is not null")
    merged = left.groupBy(F.floor(F.col("part") / fan_in).alias("merge")).applyInArrow(merge, PIECES_DDL)
    result = pieces.where("part is null").union(merged).drop("part")
    return result if keep_ids else result.drop("ids")
