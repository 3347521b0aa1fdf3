"""Bounded-space online packing of token sequences."""

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from flowlens.llm.texts import sliced, stored, utf8

#: Words that a worker's tokenizer remembers.
CACHED_WORDS = 500_000
#: Partitions whose leftovers are merged in one task.
MERGED_PARTITIONS = 4

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
          " sequence_id bigint, offset bigint, open boolean")
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("open", pa.bool_())])


#: Text of ASCII without apostrophes and of Latin letters that lower-case one to one; in
#: lower case the tokenizer cuts it as ``PARTS`` does, and nowhere else.
PLAIN = re.compile(r"[\t\n\r -&(-~À-ÖØ-öø-ÿ]*+")
PARTS = re.compile(r"[a-zß-öø-ÿ]++|[0-9]|[!-&(-/:-@\[-`{-~]++")
SPECIAL = "<|"
WORD_END = "</w>"
#: Byte-level vocabularies spell a byte as the character of its number; bytes that are not
#: printable there, in order, from 256 on.
BYTE_LETTERS = {n: 256 + at for at, n in enumerate(
    n for n in range(256) if not (33 <= n <= 126 or 161 <= n <= 172 or n >= 174))}


class WordTokenizer:
    """Ids of a text as bytes, one word at a time.

    For a tokenizer that drops white space and never joins across it, lower-cases, and
    cuts between letters, digits and punctuation (byte-level BPE with word ends). Words
    repeat, so most are looked up; those that are new are encoded many in one call. Texts
    other than ``PLAIN`` are split at ASCII white space, and words there that are not
    plain go to the tokenizer as they are. The memory is emptied when it is full.
    """

    def __init__(self, path: str, end_id: int, cached: int = CACHED_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # The model alone, for words that are already in lower case and spelled in bytes.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.end = end_id.to_bytes(4, "little")
        self.cached = cached
        self.known: dict[str, bytes] = {}

    def whole(self, words: list[str]) -> list[bytes]:
        return [np.array(found.ids, "<u4").tobytes() for found in
                self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters: each ends with the only word-end token it has."""
        text = " ".join(words)
        if not text.isascii():
            text = " ".join(w.encode().decode("latin-1").translate(BYTE_LETTERS) for w in words)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        if len(stops) != len(words):
            return self.whole(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def lookup(self, parts: set[str]) -> dict[str, bytes]:
        """The ids of all parts; a small dictionary, so that its use stays in the cache."""
        known = self.known
        found = {p: known.get(p) for p in parts}
        missing = [p for p, ids in found.items() if ids is None]
        letters = [p for p in missing if "a" <= p[0] and PARTS.fullmatch(p)]
        letters.sort(key=str.isascii)
        new = {}
        for at in range(0, len(letters), 400):
            part = letters[at:at + 400]
            new.update(zip(part, self.letters(part)))
        others = [p for p in missing if p not in new]
        new.update(zip(others, self.whole(others)))
        if len(known) + len(new) > self.cached:
            known.clear()
        known.update(new)
        found.update(new)
        return found

    @staticmethod
    def parts(text: bytes | None) -> list[str]:
        """The pieces that are looked up, in order."""
        text = (text or b"").decode()
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return PARTS.findall(text.lower())
        found = []
        for word in re.split("[ \t\n\r\x0b\x0c]+", text):
            if PLAIN.fullmatch(word) and SPECIAL not in word:
                found += PARTS.findall(word.lower())
            else:
                found.append(word)
        return found

    def encode_all(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 250):
            split = [self.parts(t) for t in texts[at:at + 250]]
            ids = self.lookup(set().union(*split))
            for parts in split:
                data = b"".join(map(ids.__getitem__, parts)) + self.end
                yield np.frombuffer(data, "<u4")


_encoders: dict[tuple, WordTokenizer] = {}


def encoder_of(path: str, end_id: int) -> WordTokenizer:
    """The worker's tokenizer; a worker keeps one, with its words, from task to task."""
    if (path, end_id) not in _encoders:
        _encoders.clear()
        _encoders[path, end_id] = WordTokenizer(path, end_id)
    return _encoders[path, end_id]


class Windows:
    """A fixed number of open windows; a document goes where it leaves least room."""

    def __init__(self, size: int, slots: int, first_id: int):
        self.size, self.slots, self.next_id = size, slots, first_id
        self.room: list[tuple[int, int]] = []
        self.content: dict[int, list] = {}

    def new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, piece: tuple, length: int) -> list[tuple[int, list]]:
        """Put a piece; returns the windows that this closes, as (id, pieces)."""
        closed = []
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            left, window = self.room.pop(at)
        else:
            if len(self.room) >= self.slots:
                _, fullest = self.room.pop(0)
                closed.append((fullest, self.content.pop(fullest)))
            left, window = self.size, self.new()
            self.content[window] = []
        self.content[window].append(piece)
        if left == length:
            closed.append((window, self.content.pop(window)))
        else:
            insort(self.room, (left - length, window))
        return closed


def rows_of(windows: list[tuple[int, list]], open_: bool) -> list[tuple]:
    """Piece rows of windows; offsets follow the order of the pieces."""
    rows = []
    for window, pieces in windows:
        offset = 0
        for doc, start, ids, total in pieces:
            rows.append((doc, start, len(ids), ids.tobytes(), total, window, offset, open_))
            offset += len(ids)
    return rows


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(PIECES_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, PIECES_ARROW)], schema=PIECES_ARROW)


def pack_partitions(docs: DataFrame, tokenizer: str, end_id: int, size: int,
                    slots: int) -> DataFrame:
    """Pieces of every partition; ``open`` marks those of windows left open at its end.

    Sequence ids are the partition's number times 2 ** 32 and a counter.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer, end_id)
        windows = Windows(size, slots, TaskContext.get().partitionId() << 32)
        for batch in sliced(batches, 1000):
            rows, held = [], 0
            found = encoder.encode_all(utf8(batch["text"]))
            for doc, ids in zip(batch["doc_id"].to_pylist(), found):
                total, start = len(ids), 0
                closed = []
                while total - start >= size:
                    closed.append((windows.new(), [(doc, start, ids[start:start + size], total)]))
                    start += size
                if start < total:
                    closed += windows.place((doc, start, ids[start:], total), total - start)
                rows += rows_of(closed, False)
                held += 4 * size * len(closed)
                if held > 8_000_000:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)
        yield batch_of(rows_of(sorted(windows.content.items()), True))

    return docs.select("doc_id", "text").mapInArrow(pack, PIECES)


def closed_lengths(total: int, size: int) -> list[int]:
    """Lengths that cut ``total`` tokens: full windows, then falling powers of two.

    A sequence whose length is a power of two is not padded, so nothing is lost.
    """
    rest = total % size
    return [size] * (total // size) + [1 << i for i in range(rest.bit_length() - 1, -1, -1)
                                       if rest >> i & 1]


def merge_open(pieces: list[tuple], size: int, first_id: int, full: float) -> list[tuple]:
    """Pack the pieces of open windows anew: largest first, each where it fits best.

    Windows filled to the share ``full`` or more stay; the others' pieces are laid end to
    end and cut.
    """
    windows = Windows(size, len(pieces), first_id)
    done: list[tuple[int, list]] = []
    for piece in sorted(pieces, key=lambda p: (-len(p[2]), p[0] is None, p[0], p[1])):
        done += windows.place(piece, len(piece[2]))
    loose = []
    for window, content in sorted(windows.content.items()):
        if sum(len(p[2]) for p in content) >= full * size:
            done.append((window, content))
        else:
            loose += content
    lengths = closed_lengths(sum(len(p[2]) for p in loose), size)
    at, used = 0, 0
    for length in lengths:
        content = []
        while length:
            doc, start, ids, total = loose[at]
            part = ids[used:used + length]
            content.append((doc, start + used, part, total))
            length, used = length - len(part), used + len(part)
            if used == len(ids):
                at, used = at + 1, 0
        done.append((windows.new(), content))
    return rows_of(done, False)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, slots: int = 64,
         merged_partitions: int = MERGED_PARTITIONS, full: float = 0.995) -> DataFrame:
    """Pack the tokens of all ``docs`` into sequences of at most ``size`` tokens.

    One row per piece: doc_id, start (tokens of the document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset. A document's tokens
    are its text's and ``end_id``; a null text has only that. Documents longer than a
    window fill whole windows first; what remains is placed whole where it leaves least
    room among ``slots`` open windows of its partition. When none fits, the fullest is
    closed. Windows open at a partition's end are merged over ``merged_partitions``
    partitions at a time, a group of at most slots * merged_partitions windows.

    Null, repeated or clashing doc_ids: every row is packed on its own. No rows: no rows.
    Pieces are stored before the merge, so texts are tokenized once and a lost executor
    costs its own partitions. The tokenizer's file must be at the same path on all
    executors.
    """
    packed = stored(pack_partitions(docs, tokenizer, end_id, size, slots), "pieces")

    def merge(rows: pa.Table) -> pa.Table:
        pieces = [(doc, start, np.frombuffer(ids, "<u4"), total) for doc, start, ids, total
                  in zip(*[rows[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")])]
        first = (1 << 62) + (rows["group"][0].as_py() << 32)
        return pa.Table.from_batches([batch_of(merge_open(pieces, size, first, full))])

    group = F.floor(F.shiftright("sequence_id", 32) / merged_partitions)
    merged = (packed.where("open").withColumn("group", group)
              .groupBy("group").applyInArrow(merge, PIECES))
    return packed.where("not open").union(merged).drop("open")
