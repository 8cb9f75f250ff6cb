"""Language-model scoring with a weighted backoff automaton.

N-grams of the training rows are counted over the whole corpus; the count of
an n-gram only travels to the blocks of documents that contain it. Each block
turns its smoothed n-grams into states and arcs with failure arcs, and one
left-to-right traversal of every text carries the state and adds up
log-probabilities.

Smoothing is hierarchical Dirichlet: p(w | h) = (c(hw) + MU * p(w | h')) /
(c(h) + MU) with h' the history without its first word, down to the add-one
unigram (c(w) + 1) / (N + V + 1), whose last part is left to unknown words.
An n-gram never seen in training takes the failure arc of its history, of
weight MU / (c(h) + MU), so every state's distribution sums to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, store, text_bytes, text_or_empty
from strata.llm.words import _A, U, mixed, slices, word_hashes

ORDER = 2
MU = 200.0
BLOCK_BYTES = 4_000_000   # texts of a block: what a task holds in arrays at once
START, END = U(0x5D1A3C7F90B24E61), U(0xC2B2AE3D27D4EB4F)
KEY_BYTES = {1: 8}  # other orders: the low 6 bytes, the bucket says more


def _released(table: pa.Table) -> pa.Table:
    """``table``, after giving freed Arrow memory back to the system."""
    pa.default_memory_pool().release_unused()
    return table


def _sequence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each between START and END, and the texts'
    first positions."""
    parts, lengths = [], []
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    for part in slices(batch, 0):
        w, at = word_hashes(part.column(0))
        parts.append(w)
        lengths.append(np.diff(at))
    n = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
    at = np.concatenate([[0], np.cumsum(n + 2)])
    seq = np.full(at[-1], START, np.uint64)
    seq[at[1:] - 1] = END
    inner = np.ones(at[-1], bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    if parts:
        seq[inner] = np.concatenate(parts)
    return seq, at


def _grams(seq: np.ndarray, at: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per order: ``(k, positions, keys)`` of the k-grams ending at each
    position (k words, the first possibly START)."""
    depth = np.arange(len(seq)) - np.repeat(at[:-1], np.diff(at))
    keys = mixed(seq * _A + U(1))
    positions = np.arange(len(seq))
    yield 1, positions, keys
    for k in range(2, order + 1):
        before = np.empty_like(keys)
        before[1:] = keys[:-1]
        keys = mixed(before * _A + seq + U(k))
        positions = np.flatnonzero(depth >= k - 1)
        yield k, positions, keys[positions]


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U(32)) * U(buckets)) >> U(32)


def _pack(keys: np.ndarray, width: int) -> bytes:
    return keys.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


ENTRIES = "block long, bucket long, gram int, keys binary, counts binary"
TOTALS = "block long, bucket long, gram int, counts binary, v long, n long"


def _profile(order: int, buckets: int):
    """A block of documents to its distinct n-grams and their training
    counts, one row a bucket of keys."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        seq, at = _sequence(table["text"].combine_chunks())
        train = np.repeat(table["train"].to_numpy(), np.diff(at))
        out: list[tuple] = []
        block = table["block"][0].as_py()
        for k, positions, keys in _grams(seq, at, order):
            own = np.sort(keys[train[positions]])
            distinct = np.sort(keys)
            distinct = distinct[np.concatenate([[True], distinct[1:] != distinct[:-1]])]
            counts = (np.searchsorted(own, distinct, "right") - np.searchsorted(own, distinct)).astype(np.uint32)
            bucket = _bucket(distinct, buckets)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    out.append((block, int(bucket[a]), k, _pack(distinct[a:b], KEY_BYTES.get(k, 6)), counts[a:b].tobytes()))
        cols = list(zip(*out, strict=True))
        return _released(pa.table({"block": pa.array(cols[0], pa.int64()), "bucket": pa.array(cols[1], pa.int64()),
                                   "gram": pa.array(cols[2], pa.int32()), "keys": pa.array(cols[3], pa.binary()),
                                   "counts": pa.array(cols[4], pa.binary())}))
    return run


def _total(table: pa.Table) -> pa.Table:
    """Entries of one bucket to the corpus counts of each block's n-grams, in
    the order they came; also the bucket's distinct words and tokens."""
    out: list[tuple] = []
    grams = table["gram"].to_numpy()
    bucket = table["bucket"][0].as_py()
    start = mixed(np.array([START], np.uint64) * _A + U(1))[0]
    v = n = 0
    for k in np.unique(grams).tolist():
        rows = np.flatnonzero(grams == k)
        part = table.take(pa.array(rows))
        keys = [_unpack(x.as_py(), KEY_BYTES.get(k, 6)) for x in part["keys"]]
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in part["counts"]])
        every = np.concatenate(keys)
        first, at = _distinct(every)
        distinct = every[first]
        total = np.bincount(at, weights=counts).astype(np.int64)
        if k == 1:
            words = distinct != start
            v, n = int((total[words] > 0).sum()), int(total[words].sum())
        ends = np.cumsum([len(x) for x in keys])
        for block, piece in zip(part["block"].to_pylist(), np.split(total[at], ends[:-1]), strict=True):
            out.append((block, bucket, k, piece.tobytes(), None, None))
    out.append((-1, bucket, 0, b"", v, n))
    cols = list(zip(*out, strict=True))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return _released(pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                              names=["block", "bucket", "gram", "counts", "v", "n"]))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One position of each distinct key, keys ascending, and each key's number."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Automaton:
    """Backoff automaton of one block's n-grams, laid over the block's texts.

    The states are the n-grams shorter than the order that training has seen
    (and the empty one): after a token, the automaton is in the longest of
    them that ends there. ``arc[k]`` has, for every position, the weight of
    the arc that reads its token from a state of ``k`` words, or NaN where
    that state has no such arc; ``failure[k]`` the weight of the failure arc
    that leaves the state of ``k`` words ending there for its last ``k - 1``.
    """

    def __init__(self, seq, at, order, counts, v, n, mu):
        self.at, self.arc, self.failure, self.length = at, [], [], np.zeros(len(seq), np.int8)
        below_p = below_c = below_at = None
        for k, positions, keys in _grams(seq, at, order):
            first, number = _distinct(keys)
            where, c = positions[first], counts[k]
            slot = np.zeros(len(seq), np.int32)
            slot[positions] = number
            if k == 1:
                p = (c + 1.0) / (n + v + 1.0)
                self.known = (c > 0)[slot]
                arc = np.log10(p)[slot]
            else:
                p = (c + mu * below_p[below_at[where]]) / (below_c[below_at[where - 1]] + mu)
                weight = np.where(c > 0, np.log10(p), np.nan)
                arc = np.full(len(seq), np.nan)
                arc[positions] = weight[number]
            self.arc.append(arc)
            if k < order:
                failure = np.full(len(seq), 0.0)
                failure[positions] = np.log10(mu / (c + mu))[number]
                self.failure.append(failure)
                self.length[positions[(c > 0)[number]]] = k
            below_p, below_c, below_at = p, c, slot

    def traverse(self) -> np.ndarray:
        """Log10-probability of every text, read from left to right.

        All texts and positions are read at once: the state before a token is
        the state after the token before it, which the automaton knows
        without the score so far. Each reads its token by an arc, or takes
        failure arcs until a state has one; the empty state always has.
        """
        score = np.zeros(len(self.length))
        state = np.empty_like(self.length)
        state[1:] = self.length[:-1]
        todo = np.ones(len(state), bool)
        todo[self.at[:-1]] = False  # START is where texts begin, no token
        for k in range(len(self.arc) - 1, -1, -1):
            here = np.flatnonzero(todo & (state == k))
            arc = self.arc[k][here]
            reads = ~np.isnan(arc)
            score[here[reads]] += arc[reads]
            todo[here[reads]] = False
            if k:
                fails = here[~reads]
                score[fails] += self.failure[k - 1][fails - 1]
                state[fails] = k - 1
        return np.add.reduceat(score, self.at[:-1])


def _score(order: int, buckets: int, v: int, n: int, mu: float):
    """A block's documents and its n-grams' corpus counts to scores."""
    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        seq, at = _sequence(docs["text"].combine_chunks())
        counts = {}
        for k in range(1, order + 1):
            rows = totals.filter(pc.equal(totals["gram"], k)).sort_by("bucket")
            counts[k] = (np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in rows["counts"]])
                         if rows.num_rows else np.empty(0, np.int64))
        automaton = Automaton(seq, at, order, counts, v, n, mu)
        known, base = automaton.known, automaton.arc[0].copy()
        known[at[:-1]], base[at[:-1]] = False, 0.0
        first = at[:-1]
        return _released(pa.table({
            "id": docs["id"], "train": docs["train"], "n_tokens": pa.array(np.diff(at) - 1),
            "n_known": pa.array(np.add.reduceat(known, first, dtype=np.int64)),
            "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(automaton.traverse())}))
    return run


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                order: int = ORDER, mu: float = MU, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, ``train``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` (unigram) and ``score`` (automaton).

    Tokens are the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, then one
    end. The model learns from the rows for which ``train`` holds.

    Edge cases: a null or empty text is the end alone; a null ``train``
    counts as true; null and repeated ids are scored row by row; without
    training rows every token has probability one (V = N = 0); an empty table
    gives an empty result; other input columns are ignored.

    Every n-gram of a block is one entry of the shuffle, whatever its
    frequency, so no key gathers more entries than there are blocks.
    """
    blocks = text_bytes(docs, text_col) // block_bytes + 1
    buckets = blocks // 2 + 1
    text = text_or_empty(text_col)
    dealt = docs.select(F.pmod(F.xxhash64(col(id_col), col(text_col)), F.lit(blocks)).alias("block"),
                        col(id_col).alias("id"), F.coalesce(train, F.lit(True)).alias("train"), text.alias("text"))
    totals = store(dealt.groupBy("block").applyInArrow(_profile(order, buckets), ENTRIES)
                   .groupBy("bucket").applyInArrow(_total, TOTALS), "lm-totals")
    size = totals.where("block = -1").agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = dealt.groupBy("block").cogroup(totals.where("block >= 0").groupBy("block")).applyInArrow(
        _score(order, buckets, size[0], size[1], mu),
        f"id {id_type}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(col("id").alias(id_col), "train", "n_tokens", "n_known",
                         F.lit(size[1]).cast("long").alias("train_tokens"), "base_score", "score")
