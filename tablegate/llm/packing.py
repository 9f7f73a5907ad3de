"""Packing into token sequences by order-preserving dynamic programming.

Documents stay in order of id. A task tokenizes a range of them, and chooses
the ends of its sequences among the ends of documents and of sentences: the
cost of a cut set is its padding plus a penalty for every cut that parts a
document, ``f(j) = min f(i) + (L - (p_j - p_i)) + penalty_j`` over the cuts i
with ``p_j - p_i <= L``. As ``f(i) + p_i`` does not depend on j, the minimum
over that window comes from a monotone queue, so a transition costs O(1).
Where no boundary lies within ``fallback`` tokens (junk without sentences),
cuts at every ``fallback`` tokens are allowed at a higher penalty. Blocks of
about ``BLOCK`` sequences are solved at a time and their last sequences go on
into the next block, so memory is bounded by a block and the longest document.

Python in tasks: the tokenizer and the queue cannot be built-in functions.
One range shuffle of the texts, no other.

Defined results: a null text counts as empty and is its end token alone, as is
a text without tokens; repeated rows and ids are packed as rows of their own;
ids that are null come first; an empty table gives an empty result. Columns
other than id and text are not looked at. Token ids do not depend on the order;
sequence numbers do not repeat, but have gaps.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.base import quoted, workspace

LENGTH = 2048
END_ID = 1
SENTENCE_PENALTY = 8
FORCED_PENALTY = 32
FALLBACK = 64
BLOCK = 256
_CACHED_WORDS = 600_000  # words whose ids a worker keeps at most

SCHEMA = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class WordTokenizer:
    """Ids of whole texts, by way of the ids of their white-space separated words.

    The tokenizer drops white space and its pieces never cross it, so a text's
    ids are those of its words in a row. Words repeat, so their ids are kept
    (two or four bytes an id) until there are too many and it begins anew. Marks
    that stand for a token of their own (``<|endoftext|>``) get its id, as in
    the tokenizer as loaded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        # Marks of tokens of their own are cut out first, as they stand; words are then ordinary text.
        self._added = {t.content: i for i, t in self._model.get_added_tokens_decoder().items()}
        marks = sorted(self._added, key=len, reverse=True)
        self._marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self._model.encode_special_tokens = True
        self._known: dict[str, bytes] = {}
        self._bpe = self._model.model
        names = self._model.get_vocab()
        self._kind = "H" if max(names.values()) < 1 << 16 else "I"
        self.ends_sentence = np.zeros(max(names.values()) + 1, dtype=bool)
        bytes_of = {name: b for b, name in enumerate(map(chr, (_BYTE_NAMES.get(b, b) for b in range(256))))}
        for name, i in names.items():
            bare = name.removesuffix("</w>")
            if bare != name and all(c in bytes_of for c in bare):
                # A piece that begins inside a character is no mark of its own, see ``_endings``.
                text = bytes(bytes_of[c] for c in bare).decode("utf-8", "replace")
                if _MARKS & set(text) and "\ufffd" not in text and not any(c.isalnum() for c in text):
                    self.ends_sentence[i] = True
        # The ids of marks of several tokens, the last one first.
        self._endings = []
        for mark in sorted(_MARKS):
            ids = self._model.encode(mark, add_special_tokens=False).ids
            if len(ids) > 1:
                self._endings.append(ids[::-1])
        # Of every id whether it ends a sentence (1), or may with those before it (2); the last entry is of all ids beyond.
        self._mark_of = np.append(self.ends_sentence, False).astype(np.uint8)
        for ending in self._endings:
            self._mark_of[ending[0]] |= 2

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Places after the tokens that end a sentence."""
        marks = np.take(self._mark_of, ids, mode="clip")
        some = np.flatnonzero(marks)
        marks = marks[some]
        ends, last = (marks & 1).astype(bool), some[marks > 1]
        if len(last):
            for first, *before in self._endings:
                at = last[ids[last] == first]
                for k, i in enumerate(before, 1):
                    at = at[at >= k]
                    at = at[ids[at - k] == i]
                ends[np.searchsorted(some, at)] = True
        return some[ends] + 1

    def _packed(self, ids: list[int]) -> bytes:
        return array(self._kind, ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word that is not known."""
        core = word.rstrip(_SIGNS)
        if core.isalpha() and _latin(core) and core == core.lower():
            # One piece of letters, then perhaps one of signs; both as the model's merges see them.
            if core == word:
                return self._piece(word)
            seen = core in self._known
            ids = self._piece(core) + self._piece(word[len(core) :])
            if seen:
                self._keep(word, ids)
            return ids
        ids = self._packed(self._model.encode(word, add_special_tokens=False).ids)
        if len(word) < 64:
            self._keep(word, ids)
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of letters alone or signs alone."""
        ids = self._known.get(piece)
        if ids is None:
            bytewise = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_NAMES)
            ids = self._packed([t.id for t in self._bpe.tokenize(bytewise)])
            self._keep(piece, ids)
        return ids

    def _keep(self, piece: str, ids: bytes) -> None:
        if len(self._known) >= _CACHED_WORDS:
            self._known.clear()
        self._known[piece] = ids

    def __call__(self, text: str) -> np.ndarray:
        if self._marks is None or not self._marks.search(text):
            return self._ids(text)
        parts = self._marks.split(text)  # every second part is a mark
        return np.concatenate([np.array([self._added[p]], dtype=np.uint32) if k % 2 else self._ids(p) for k, p in enumerate(parts)])

    def _ids(self, text: str) -> np.ndarray:
        """Ids of a text without marks."""
        # Lower case beforehand merges more words; done where it is letter by letter.
        words = _words(text.lower(), _ODD_LATIN) if _latin(text) else _words(text)
        parts = list(map(self._known.get, words))
        if None in parts:
            for i, known in enumerate(parts):
                if known is None:
                    parts[i] = self._word(words[i])
        return np.frombuffer(b"".join(parts), dtype=self._kind).astype(np.uint32)


def _byte_names() -> dict[int, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    odd = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return {b: 256 + i for i, b in enumerate(odd)}


_BYTE_NAMES = _byte_names()
_SIGNS = ".,!?%$&*#|;:"
_MARKS = frozenset(".!?…。．｡！？؟۔।॥")


def _latin(text: str) -> bool:
    """Whether all characters are below U+0100; those have no combining forms and one lower case each."""
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def _words(text: str, odd: str | None = None) -> list[str]:
    """Words between ASCII white space; ``odd``: all odd spaces that the text may have, where they are few."""
    if any(c in text for c in odd) if odd else _ODD_SPACE.search(text):
        return [w for w in text.translate(_TO_SPACE).split(" ") if w]
    return text.split()


# str.split() also parts at these, which the tokenizer may not take as white space.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ODD_LATIN = "\x1c\x1d\x1e\x1f\x85\xa0"  # those below U+0100
_TO_SPACE = dict.fromkeys((9, 10, 11, 12, 13), " ")

_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a vocabulary file; one per worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def candidate_cuts(total: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, fallback: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in (0, total] where a sequence may end, with their penalties; total is one of them."""
    at = np.unique(np.concatenate((doc_ends, sentence_ends, [total])))
    at = at[(at > 0) & (at <= total)]
    before = np.concatenate(([0], at[:-1]))
    wide = np.flatnonzero(at - before > fallback)
    forced = [np.arange(a + fallback, b, fallback) for a, b in zip(before[wide].tolist(), at[wide].tolist(), strict=True)]
    extra = np.concatenate(forced) if forced else np.zeros(0, np.int64)
    cuts = np.concatenate((at, extra))
    penalty = np.concatenate((np.where(np.isin(at, doc_ends), 0, SENTENCE_PENALTY), np.full(len(extra), FORCED_PENALTY)))
    order = np.argsort(cuts, kind="stable")
    return cuts[order], penalty[order]


def best_cuts(cuts: list[int], penalty: list[int], length: int) -> list[int]:
    """The chosen sequence ends, the last of ``cuts`` among them, at least padding plus penalties."""
    value = [0]  # value[j]: least cost of the tokens before cut j
    back = [0]
    position = [0, *cuts]
    queue: deque[int] = deque([0])  # cuts by position, their value + position rising
    for j in range(1, len(position)):
        at = position[j]
        while position[queue[0]] < at - length:
            queue.popleft()
        i = queue[0]
        value.append(value[i] + length - (at - position[i]) + penalty[j - 1])
        back.append(i)
        key = value[j] + at
        while queue and value[queue[-1]] + position[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    out = []
    j = len(position) - 1
    while j:
        out.append(position[j])
        j = back[j]
    return out[::-1]


class _Packer:
    """Packs a stream of documents, block by block."""

    def __init__(self, sentence_ends: Callable[[np.ndarray], np.ndarray], length: int, fallback: int):
        self.ends, self.length, self.fallback = sentence_ends, length, fallback
        self.sequence = 0
        self.docs: list[tuple[object, np.ndarray, int]] = []  # id, token ids, those of them that are packed
        self.held = 0

    def add(self, key: object, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((key, ids, 0))
        self.held += len(ids)
        while self.held >= 2 * BLOCK * self.length:
            yield from self.pack(BLOCK * self.length)
        if self.held >= BLOCK * self.length:
            yield from self.pack(self.held)

    def pack(self, limit: int, last: bool = False) -> Iterator[tuple]:
        """Pack what is held, up to ``limit`` tokens; unless last, the last two sequences stay."""
        parts, keys, room = [], [], limit
        for key, ids, done in self.docs:
            if not room:
                break
            take = min(room, len(ids) - done)
            parts.append(ids[done : done + take])
            keys.append((key, done, len(ids)))
            room -= take
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        whole = np.array([d + len(p) == n for (_, d, n), p in zip(keys, parts, strict=True)], dtype=bool)
        inner = self.ends(ids)
        # The end token is a document's last; a sentence that ends right before it is no better a cut.
        cuts, penalty = candidate_cuts(len(ids), ends[whole], np.setdiff1d(inner, ends[whole] - 1), self.fallback)
        chosen = best_cuts(cuts.tolist(), penalty.tolist(), self.length) if len(ids) else []
        if not last:
            chosen = chosen[:-2]
        at, stop = 0, chosen[-1] if chosen else 0
        starts = ends - np.array([len(p) for p in parts], dtype=np.int64)
        d = 0
        for cut in chosen:
            offset = 0
            while at < cut:
                while ends[d] <= at:
                    d += 1
                to = min(cut, int(ends[d]))
                key, done, n = keys[d]
                piece = ids[at:to]
                yield key, done + at - int(starts[d]), to - at, zlib.crc32(piece.astype("<u4").tobytes()), n, self.sequence, offset
                offset += to - at
                at = to
            self.sequence += 1
        # What is packed goes; a document that is packed in part stays with its count.
        left, rest = stop, []
        for key, tokens, done in self.docs:
            take = min(left, len(tokens) - done)
            left -= take
            if done + take < len(tokens):
                rest.append((key, tokens, done + take))
        self.docs, self.held = rest, self.held - stop


def _pack_partition(path: str, length: int, end_id: int, fallback: int, id_type: pa.DataType) -> Callable:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokenizer(path)
        packer = _Packer(encode.sentence_ends, length, fallback)
        first = TaskContext.get().partitionId() << 33
        end = np.array([end_id], dtype=np.uint32)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])]
            arrays[5] = pa.array(np.asarray(columns[5], dtype=np.int64) + first)
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.extend(packer.add(key, np.concatenate((encode(text.as_py() or ""), end))))
            if rows:
                yield out()
        rows.extend(packer.pack(packer.held, last=True))
        yield out()

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    fallback: int = FALLBACK,
) -> DataFrame:
    """One row per piece of a document in a sequence (see ``SCHEMA``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    workspace(docs.sparkSession, "packing")
    id_type = docs.schema[id_col].dataType
    # The row number parts repeated ids, so that one id cannot fill a range.
    rows = docs.select(
        F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text)).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    ranged = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    run = _pack_partition(tokenizer_path, length, end_id, fallback, to_arrow_type(id_type))
    return ranged.mapInArrow(run, SCHEMA.format(id=id_type.simpleString()))
