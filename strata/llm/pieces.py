"""SentencePiece-style encoding and decoding by a streaming Viterbi search.

A text is written with a leading ``▁`` and ``▁`` for every space, and cut into
vocabulary pieces of the largest total score. The search reads characters from
left to right and keeps back pointers only for a window as long as the longest
piece, from the last boundary that all surviving paths share; there it commits
the ids.

At boundaries that no piece can span (before a ``▁`` that follows another
character, around characters that no longer piece holds) all paths meet
whatever the text, so ids may be committed there, and what follows depends on
nothing before: the search goes on from one such boundary to the next, and the
ids of a stretch that it has met before are remembered. The ids are those of
one search over the whole text (tested on documents).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import col, extras

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 500_000   # segments a worker remembers (forgotten all at once)
LONGEST_REMEMBERED = 64


class Remembered(dict):
    """Ids by segment, searched when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, segment: str) -> tuple[int, ...]:
        found = tuple(chain.from_iterable(self.vocabulary.search(segment)))
        if len(segment) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[segment] = found
        return found


class Vocabulary:
    """Pieces and scores of a model file, and the search over them."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = {names[i]: (i, sp.get_score(i)) for i in plain}
        self.unknown_score = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces))
        # Every beginning of a piece: (id or -1, score).
        self.table = {p[:k]: (-1, 0.0) for p in self.pieces for k in range(1, len(p))} | self.pieces
        self.surface = [b""] * n
        for i in plain:
            self.surface[i] = names[i].encode()
        for b, i in self.byte_id.items():
            self.surface[i] = bytes([b])
        self.surface[self.unknown] = " ⁇ ".encode()
        # Segments: characters of no longer piece stand alone; a ▁ starts a
        # segment if no piece has it after another character.
        inside = {c for p in self.pieces if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\x0b\x0c\r" if c not in inside)
        late = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        body = f"[^{re.escape(alone)}]+" if late else f"{SPACE}*[^{SPACE}{re.escape(alone)}]+|{SPACE}+"
        self.segment = re.compile(f"{body}|[{re.escape(alone)}]" if alone else body, re.DOTALL)
        self.known = Remembered(self)

    def _ids(self, text: str, start: int, end: int, piece: int) -> list[int]:
        if piece >= 0:
            return [piece]
        return [self.byte_id.get(b, self.unknown) for b in text[start:end].encode()] if self.byte_id else [self.unknown]

    def search(self, text: str) -> Iterator[list[int]]:
        """Committed ids of ``text``, one list a commit. Ties go to the piece
        that starts earlier, that is, to the longer last piece.

        The window is as long as the longest piece; only where the surviving
        paths share no boundary in it, it is doubled.
        """
        get, longest, unknown = self.table.get, self.longest, self.unknown_score
        low = float("-inf")
        done, n = 0, len(text)
        while done < n:
            # Positions are counted from the last commit. Paths are extended
            # from all positions before ``size`` and reach up to ``reach``.
            size, i = min(longest, n - done), 0
            best, start, piece = [0.0], [0], [-1]
            while True:
                reach = min(size + longest, n - done)
                more = reach + 1 - len(best)
                best, start, piece = best + [low] * more, start + [0] * more, piece + [-1] * more
                view = text[done:done + reach]
                while i < size:
                    score, single = best[i], False
                    for end in range(i + 1, min(reach, i + longest) + 1):
                        hit = get(view[i:end])
                        if hit is None:
                            break
                        if hit[0] >= 0:
                            single = single or end == i + 1
                            total = score + hit[1]
                            if total > best[end]:
                                best[end], start[end], piece[end] = total, i, hit[0]
                    # The unknown character, if no piece of one character starts here.
                    if not single and score + unknown > best[i + 1]:
                        best[i + 1], start[i + 1], piece[i + 1] = score + unknown, i, -1
                    i += 1
                if done + size == n:
                    shared = size
                else:
                    shared = self._meeting(start, [p for p in range(size, reach + 1) if best[p] > low])
                if shared:
                    break
                size = min(2 * size, n - done)
            out: list[int] = []
            p = shared
            while p:
                if piece[p] >= 0:
                    out.append(piece[p])
                else:
                    out.extend(reversed(self._ids(view, start[p], p, -1)))
                p = start[p]
            out.reverse()
            done += shared
            yield out

    @staticmethod
    def _meeting(start: list[int], live: list[int]) -> int:
        """The last boundary on the back-pointer paths of all live positions,
        0 if only the last commit is."""
        ahead = set(live)
        # The path that is furthest on steps back until all have met.
        while len(ahead) > 1:
            p = max(ahead)
            ahead.discard(p)
            ahead.add(start[p])
        return ahead.pop()

    def encode(self, text: str) -> array:
        if not text:
            return array("I")
        segments = self.segment.findall(SPACE + text.replace(" ", SPACE))
        return array("I", chain.from_iterable(map(self.known.__getitem__, segments)))

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[str, Vocabulary] = {}


def vocabulary(model: str) -> Vocabulary:
    """The vocabulary of a model file, loaded once a worker."""
    if model not in _loaded:
        _loaded[model] = Vocabulary(model)
    return _loaded[model]


def _column(model: str, at: int, name: str, kind: pa.DataType, convert):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                made = pa.array([None if x is None else convert(v, x) for x in (y.as_py() for y in part.column(at))], kind)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, name])
    return run


def _with_column(df: DataFrame, source: str, name: str, ddl: str, kind: pa.DataType, model: str, convert) -> DataFrame:
    kept = [source, *extras(df, [name], [source])]
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    return df.select(*[col(c) for c in kept]).mapInArrow(_column(model, 0, name, kind, convert), f"{fields}, `{name}` {ddl}")


def encode(df: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The input with ``ids_col``: little-endian unsigned 32-bit piece ids.

    Edge cases: a null text has null ids, an empty one no ids; texts of any
    length are searched with a bounded window; repeated rows are encoded each;
    an empty table gives an empty result; a column named like ``ids_col`` is
    replaced.
    """
    return _with_column(df, text_col, ids_col, "binary", pa.binary(), model, lambda v, x: v.encode(x).tobytes())


def decode(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The input with ``text_col``: the text of the ids.

    Restores every text exactly, except that ``▁`` itself comes back as a
    space. Edge cases: null ids give null, no ids the empty text; bytes that
    are no UTF-8 become replacement characters; a column named like
    ``text_col`` is replaced.
    """
    def convert(v: Vocabulary, data: bytes) -> str:
        ids = array("I")
        ids.frombytes(data)
        return v.decode(ids)

    return _with_column(df, ids_col, text_col, "string", pa.string(), model, convert)
