"""Language ID by cross-parsing entropy.

For every language a suffix automaton of labelled text. A text is parsed
against each: from where the last phrase ended, take the longest match in the
language's text, until the text is used up. The bits of a parse are its
phrases times log2 of the language's text length; divided by the number of
characters parsed they estimate the cross entropy, so the language of fewest
normalised phrases wins. Characters are letters in lower case; any run of other
characters is one blank.

The automata come from a bounded sample of labelled rows: windows of
``WINDOW`` characters at a place given by a hash of the text, from the
``ROWS_PER_LANGUAGE`` distinct texts of least hash per language, among about
``DRAW`` times as many that a second hash draws first (all of them, if there
are no more). They are built once on the driver and broadcast (a few MB). Texts are parsed in numpy inside tasks:
each step moves thousands of texts by one character through a table of all
languages' transitions; those of letters beyond the ``DENSE`` commonest are
searched in a sorted list, so every letter of every script counts. Long texts are parsed in lanes of ``LANE``
characters side by side. A lane begins in the state the one before ends in, so
phrases cross lanes: all lanes are first parsed from the start state, then again
from the state that is true, until they have the states they had before. Where
that never happens a lane is parsed three times at most. With many languages
the table has fewer columns, so that it takes ``TABLE_BYTES`` at most; the list
of the other transitions takes 12 bytes each.

Defined results: ``und`` with score 0 for texts that are null or without a
letter, and for all texts if nothing could be learned; letters that no
training text has are phrases of one character in every language; of languages
with equally few phrases the first by name; repeated rows get equal results;
an empty table gives an empty result. ``score`` is the winner's share of
``2 ** (-bits / TEMPER)`` over the languages.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.base import BATCH_BYTES, mapped, quoted, remainder, save, workspace

ROWS_PER_LANGUAGE = 60
WINDOW = 400
DRAW = 16
DENSE = 62  # commonest letters, which have columns in the table; transitions of all others are searched for
LANE = 2048
STRIDE = 128  # characters between two looks whether a lane's states are those it had
TABLE_BYTES = 64 << 20  # of the table of common letters in a worker
TEMPER = 16.0
UNKNOWN = "und"


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all factors; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def _letter_classes(alphabet: str) -> np.ndarray:
    """Class of every code point: 0 no letter, 1.. the letters of ``alphabet``, then one for all others."""
    table = np.zeros(0x110000, dtype=np.min_scalar_type(len(alphabet) + 1))
    place = {c: i + 1 for i, c in enumerate(alphabet)}
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = place.get(c.lower()[0], len(alphabet) + 1)
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Parser:
    """All languages' automata as one table; made in each worker from the broadcast parts.

    The table has a column for each of the first ``DENSE`` letters, the transitions
    of other letters are a sorted list of (state, class); which of both holds a
    transition changes no result.
    """

    def __init__(self, languages: list[str], alphabet: str, edges: list[tuple[np.ndarray, ...]], sizes: list[int], dense: int = DENSE):
        """edges: per language (from, class, to) of its transitions; sizes: characters of its text."""
        self.languages = languages
        self.classes = _letter_classes(alphabet)
        self.n_classes = len(alphabet) + 2
        states = [int(max(e[0].max(initial=0), e[2].max(initial=0))) + 1 for e in edges]
        # The last column is of all classes without one, and always empty.
        room = max(0, TABLE_BYTES // (4 * sum(states)) - 2)
        self.width = min(dense, room, len(alphabet)) + 2
        self.root = np.concatenate(([0], np.cumsum(states)[:-1])).astype(np.int32)
        # A transition that is missing leads to the language's own root.
        self.table = np.repeat(self.root, np.array(states) * self.width).astype(np.int32)
        self.first = np.repeat(self.root[:, None], self.n_classes, axis=1)  # of the roots, for every class
        keys, to = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for k, (root, (a, c, b)) in enumerate(zip(self.root.tolist(), edges, strict=True)):
            at = root + a.astype(np.int64)
            common = c < self.width - 1
            self.table[at[common] * self.width + c[common]] = root + b[common]
            self.first[k, c[a == 0]] = root + b[a == 0]
            keys.append(at[~common] * self.n_classes + c[~common])
            to.append((root + b[~common]).astype(np.int32))
        keys, to = np.concatenate(keys), np.concatenate(to)
        order = np.argsort(keys)
        self.rare, self.rare_to = keys[order], to[order]
        self.bits = np.log2(np.maximum(2, np.array(sizes, dtype=np.float64)))

    def _moved(self, now: np.ndarray, c: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """(language, text) states after one character of each text; ``fresh`` are those after it from the roots."""
        to = self.table[now * np.int32(self.width) + np.minimum(c, np.int32(self.width - 1))]
        rare = np.flatnonzero(c >= self.width - 1)
        if len(rare) and len(self.rare):
            # A language that has the letter nowhere has no transition from its root either.
            k, i = np.nonzero(fresh[:, rare] != self.root[:, None])
            i = rare[i]
            key = now[k, i] * np.int64(self.n_classes) + c[i]
            place = np.searchsorted(self.rare, key).clip(max=len(self.rare) - 1)
            hit = self.rare[place] == key
            to[k[hit], i[hit]] = self.rare_to[place[hit]]
        return to

    def normalized(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all texts' characters, blanks run together, and the offsets of the texts."""
        points = _points("".join(texts))
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        codes = self.classes[points]
        keep = codes != 0
        # Of each run of others the first stays, but not at a text's start.
        keep[1:] |= codes[:-1] != 0
        starts = (ends - lengths)[lengths > 0]
        keep[starts] = codes[starts] != 0
        sums = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
        return codes[keep], sums[np.concatenate(([0], ends))]

    def _advance(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, state: np.ndarray, count: np.ndarray, low: int, high: int) -> None:
        """Characters ``low`` to ``high`` of lanes in falling order of size; changes ``state`` and ``count``."""
        root = self.root[:, None]
        active = np.searchsorted(-size, -np.arange(low + 1, high + 1), side="right")
        for t, m in zip(range(low, high), active.tolist(), strict=True):
            if not m:
                break
            c = codes[start[:m] + t].astype(np.int32)
            now = state[:, :m]
            fresh = self.first[:, c]
            to = self._moved(now, c, fresh)
            ended = to == root
            if ended.any():
                # The phrase before ends here; the character begins the next one, or is one that matches nothing.
                count[:, :m] += (ended & (now != root)).view(np.int8)
                to = np.where(ended, fresh, to)
                count[:, :m] += (to == root).view(np.int8)
            state[:, :m] = to

    def phrases(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of phrases per text and language."""
        lengths = np.diff(offsets)
        n_lanes = -(-lengths // LANE)
        of = np.repeat(np.arange(len(lengths)), n_lanes)
        number = np.arange(len(of)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        start = offsets[of] + number * LANE
        size = np.minimum(offsets[of + 1] - start, LANE)
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        before = np.where(number > 0, np.roll(place, 1), -1)[order]
        start, size, of, number = start[order], size[order], of[order], number[order]
        root = self.root[:, None]
        begin = np.repeat(root, len(of), axis=1)  # the state in which a lane was parsed
        state, count = begin.copy(), np.zeros((len(self.root), len(of)), dtype=np.int32)
        later = before >= 0  # lanes that are not a text's first
        column, marks = np.cumsum(later) - 1, []  # of these lanes, every STRIDE characters: states and phrases so far
        for low in range(0, int(size.max(initial=0)), STRIDE):
            self._advance(codes, start, size, state, count, low, low + STRIDE)
            marks.append((state[:, later], count[:, later]))
        # A lane begins in the state that the one before ends in; from where it has the states it had, all else stays.
        first_time = True
        while True:
            todo = np.flatnonzero(later & (begin != state[:, before]).any(axis=0))
            if not len(todo):
                break
            if not first_time:
                # Of each text the first: what it begins in is final, so a lane is parsed three times at most.
                by_text = todo[np.lexsort((number[todo], of[todo]))]
                todo = np.sort(by_text[np.unique(of[by_text], return_index=True)[1]])
            first_time = False
            now = state[:, before[todo]]
            begin[:, todo] = now
            counted = np.zeros(now.shape, dtype=np.int32)
            for k, (states, counts) in enumerate(marks):
                self._advance(codes, start[todo], size[todo], now, counted, k * STRIDE, (k + 1) * STRIDE)
                at = column[todo]
                more = counted - counts[:, at]
                met = (now == states[:, at]).all(axis=0)
                states[:, at], counts[:, at] = now, counted
                if met.any():
                    for _, after in marks[k + 1 :]:
                        after[:, at[met]] += more[:, met]
                    count[:, todo[met]] += more[:, met]
                    todo, now, counted = todo[~met], now[:, ~met], counted[:, ~met]
                    if not len(todo):
                        break
            state[:, todo], count[:, todo] = now, counted
        last = np.ones(len(of), dtype=bool)
        last[before[later]] = False
        count += (state != root) & last
        out = np.zeros((len(lengths), len(self.root)), dtype=np.int64)
        for j in range(len(self.root)):
            out[:, j] = np.bincount(of, weights=count[j], minlength=len(lengths))
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits a character of each text."""
        codes, offsets = self.normalized(texts)
        length = np.diff(offsets)
        bits = self.phrases(codes, offsets) * self.bits
        best = np.argmin(bits, axis=1)
        low = bits.min(axis=1)
        share = 1.0 / np.exp2(np.maximum((low[:, None] - bits) / TEMPER, -1000)).sum(axis=1)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), length.tolist(), strict=True)]
        return names, np.where(length > 0, share, 0.0), np.where(length > 0, low / np.maximum(1, length), 0.0)


_built: dict[str, Parser] = {}


def _parser(key: str, model: LanguageModel) -> Parser:
    """The parser of a model; a worker process keeps the last one."""
    if key not in _built:
        _built.clear()
        _built[key] = Parser(model.languages, model.alphabet, model.edges, model.sizes)
    return _built[key]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    alphabet: str
    edges: list[tuple[np.ndarray, ...]]
    sizes: list[int]

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``lang_pred``, ``score`` and ``bits_per_char``."""
        names = ["lang_pred", "score", "bits_per_char"]
        kinds = [T.StringType(), T.DoubleType(), T.DoubleType()]
        if not self.languages:
            return docs.withColumns({n: F.lit(v) for n, v in zip(names, (UNKNOWN, 0.0, 0.0), strict=True)})
        docs = docs.select(*[F.col(quoted(c)) for c in docs.columns if c not in names or c == text])
        at = docs.columns.index(text)
        parts = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, self))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parser = None
            limit = 4 * BATCH_BYTES * 8 // max(8, len(self.languages))
            for batch in batches:
                if parser is None:
                    parser = _parser(*parts.value)
                texts = batch.column(at)
                found, low, size = ([], [], []), 0, 0
                sizes = [len(x.as_py() or b"") for x in texts.cast(pa.large_binary())]
                for high, n in enumerate(sizes, 1):
                    size += n
                    if size >= limit or high == len(sizes):
                        for into, got in zip(found, parser.predict([x or "" for x in texts[low:high].to_pylist()]), strict=True):
                            into.extend(got)
                        low, size = high, 0
                extra = [pa.array(v, k) for v, k in zip(found, (pa.string(), pa.float64(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *names])

        return mapped(docs, run, [T.StructField(n, t) for n, t in zip(names, kinds, strict=True)])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows: int = ROWS_PER_LANGUAGE, window: int = WINDOW) -> LanguageModel:
    """Automata from at most ``rows`` windows of ``window`` characters per language; pass only rows that may be learned from."""
    path = workspace(docs.sparkSession, "langid")
    labelled = docs.select(F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"))
    labelled = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    draw = F.xxhash64("text")
    # Repeated texts are one, also when they are counted: a language of copies keeps its few other texts.
    keyed = labelled.select("lang", draw.alias("draw"), F.xxhash64("text", F.lit(1)).alias("other")).distinct()
    keyed = save(keyed, f"{path}/keyed")
    # About DRAW times the texts that are wanted: so few, that a language's may be ranked in one task.
    counts = keyed.groupBy(F.col("lang").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    counts = save(counts, f"{path}/counts")  # its size is then known, so rows are not shuffled by language to join it
    share = F.pmod(F.col("other"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    keyed = keyed.join(counts, F.col("lang") == F.col("name")).where(share * F.col("n") < DRAW * rows).select("lang", "draw")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    few = save(keyed.withColumn("rank", rank).where(F.col("rank") <= rows).select("lang", "draw"), f"{path}/drawn")
    room = F.greatest(F.length("text") - window, F.lit(0)) + 1
    part = F.substring("text", (F.pmod(F.xxhash64("text", F.lit(2)), room) + 1).cast("int"), F.lit(window))
    sample = labelled.select("lang", draw.alias("draw"), part.alias("part")).join(F.broadcast(few), ["lang", "draw"])
    got = sorted((r[0], r[1]) for r in sample.groupBy("lang", "draw").agg(F.min("part").alias("part")).select("lang", "part").collect())
    texts = {name: " ".join(p for n, p in got if n == name) for name in {r[0] for r in got}}
    seen: dict[str, int] = {}
    for whole in texts.values():
        for c in whole:
            if c.isalpha():
                seen[c.lower()[0]] = seen.get(c.lower()[0], 0) + 1
    alphabet = "".join(sorted(seen, key=lambda c: (-seen[c], c)))  # all letters, the commonest first
    languages = sorted(texts)
    place = _letter_classes(alphabet)
    edges, sizes = [], []
    for name in languages:
        codes = place[_points(texts[name])]
        codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
        moves = suffix_automaton(codes.tolist())
        rows_ = [(a, c, b) for a, m in enumerate(moves) for c, b in m.items()]
        flat = np.array(rows_, dtype=np.int32).reshape(-1, 3)
        edges.append((flat[:, 0], flat[:, 1], flat[:, 2]))
        sizes.append(len(codes))
    return LanguageModel(languages, alphabet, edges, sizes)


def predict_documents(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_char; learned from the rows outside the held-out fold."""
    learn = remainder("doc_id", folds) != held_out
    model = fit(docs.where(learn))
    out = model.predict(docs.select("doc_id", "text"))
    return out.select("doc_id", (~learn).alias("held_out"), "lang_pred", "score", "bits_per_char")
