"""Shortest-pack-first packing of token pieces over their length histogram.

Documents are tokenised once into pieces of at most ``max_tokens`` ids. Only
the histogram of piece lengths (at most ``max_tokens`` numbers) reaches the
driver, where lengths are placed longest first into packing patterns with
counts. Every piece then finds its sequence by its rank among the pieces of
its length.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import broadcast_rows, col, store

MAX_TOKENS = 2048
END_ID = 1
# Fixed value: how byte-level BPE vocabularies split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Its look-ahead uses the regex engine's stack, one place a character: runs of
# white space (the engine's \s) of this length or more are cut out before.
LONG_SPACE = 10_000
SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)
FLUSH_CHARS = 4_000_000


def load_encoder(vocabulary: str, added_tokens: bool = False):
    """An encoder (text to ids) for a byte-level BPE vocabulary file whose ids
    follow the order of its merges. With ``added_tokens``, the file's added
    tokens are found in texts as the tokenizer does by default; without,
    special strings in texts are plain text."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    # Byte-level vocabularies write each byte as one printable character:
    # itself if it prints, else the next free one from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char_of = {b: chr(b) for b in printable}
    char_of |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in char_of)}
    byte_of = {c: b for b, c in char_of.items()}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if added_tokens and any(t[flag] for t in spec.get("added_tokens", []) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        # Found by rules beyond the string itself.
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    encoding = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if len(text) < LONG_SPACE:
            return encoding.encode_ordinary(text)
        # SPLIT makes a run of white space one part, but for its last character
        # if other text follows, which starts the next part.
        ids, at = [], 0
        for run in SPACES.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += encoding.encode_ordinary(text[at:run.start()])
            ids += encoding._encode_single_piece(text[run.start():end])
            at = end
        return ids + encoding.encode_ordinary(text[at:])

    if not (added_tokens and special):
        return encode
    # The leftmost and longest one, as in the tokenizer.
    found = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")")

    def encode_added(text: str) -> list[int]:
        parts = found.split(text)
        ids = encode(parts[0])
        for token, part in zip(parts[1::2], parts[2::2], strict=True):
            ids.append(special[token])
            ids += encode(part)
        return ids

    return encode_added


PIECES = ("_x_id {id}, start long, length long, doc_tokens long, ids binary, "
          "_x_part int, _x_local long")


def _tokenise(vocabulary: str, max_tokens: int, end_id: int):
    """Per-partition function: texts to pieces, each with its rank among the
    pieces of its length in this partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from array import array

        encode = load_encoder(vocabulary, added_tokens=True)
        part = TaskContext.get().partitionId()
        seen = [0] * (max_tokens + 1)
        for batch in batches:
            ids = batch.column(0)
            out: list[tuple] = []
            size = 0
            rows: list[int] = []

            def flush():
                cols = list(zip(*out, strict=True))
                return pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()),
                     pa.array([part] * len(out), pa.int32()), pa.array(cols[4], pa.int64())],
                    names=["_x_id", "start", "length", "doc_tokens", "ids", "_x_part", "_x_local"])

            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                tokens = array("I", encode(text))
                tokens.append(end_id)
                n = len(tokens)
                for start in range(0, n, max_tokens):
                    piece = tokens[start:start + max_tokens]
                    rows.append(i)
                    out.append((start, len(piece), n, piece.tobytes(), seen[len(piece)]))
                    seen[len(piece)] += 1
                size += len(text) + 1
                if size >= FLUSH_CHARS:
                    yield flush()
                    out, rows, size = [], [], 0
            if out:
                yield flush()
    return run


def pack_lengths(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns ``(count, [(length, copies), ...])`` for a histogram.

    Lengths are placed longest first. A length goes to the packs with the
    most space left (the shortest packs) as long as it fits there, one copy a
    pack, all packs of one pattern at once; when it fits nowhere, new packs
    are filled with copies of it. Each length splits at most one pattern and
    adds at most two, so there are fewer than 3 * max_tokens patterns.
    """
    # A chain holds (length, copies, rest) so patterns share their beginnings.
    packs: dict[int, list[list]] = {}
    spaces: list[int] = []

    def add(space: int, count: int, chain) -> None:
        if space not in packs:
            packs[space] = []
            heapq.heappush(spaces, -space)
        packs[space].append([count, chain])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            while spaces and not packs[-spaces[0]]:
                del packs[-heapq.heappop(spaces)]
            space = -spaces[0] if spaces else -1
            if space < length:
                per = max_tokens // length
                if left >= per:
                    add(max_tokens - per * length, left // per, (length, per, None))
                if left % per:
                    add(max_tokens - (left % per) * length, 1, (length, left % per, None))
                break
            count, chain = packs[space].pop()
            used = min(count, left)
            if used < count:
                packs[space].append([count - used, chain])
            add(space - length, used, (length, 1, chain))
            left -= used
    patterns = []
    for groups in packs.values():
        for count, chain in groups:
            parts: list[list[int]] = []
            while chain is not None:
                length, copies, chain = chain
                if parts and parts[-1][0] == length:
                    parts[-1][1] += copies
                else:
                    parts.append([length, copies])
            patterns.append((count, [(a, b) for a, b in reversed(parts)]))
    return patterns


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first_rank, end_rank, copies, first_sequence, offset)``:
    which ranks of each length go to which pattern."""
    given: dict[int, int] = {}
    out = []
    sequence = 0
    for count, parts in patterns:
        offset = 0
        for length, copies in parts:
            lo = given.get(length, 0)
            given[length] = lo + count * copies
            out.append((length, lo, given[length], copies, sequence, offset))
            offset += length * copies
        sequence += count
    return out


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``doc_tokens``, ``ids``
    (little-endian unsigned 32-bit), ``sequence_id``, ``offset``.

    A document's ids (with ``end_id`` last) are cut into pieces of
    ``max_tokens`` and a rest; each sequence holds at most ``max_tokens`` ids.

    Edge cases: a null or empty text is the end id alone; null and repeated
    ids are kept, each row packed on its own; a text of any length is cut
    like others; added tokens of the vocabulary in texts get their ids; an empty table gives an empty result; other input columns
    are ignored.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    pieces = store(docs.select(col(id_col).alias("_x_id"), col(text_col).cast("string").alias("_x_text"))
                   .mapInArrow(_tokenise(vocabulary, max_tokens, end_id), PIECES.format(id=id_type)), "pack-pieces")
    counts = store(pieces.groupBy("_x_part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # At most max_tokens rows.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    patterns = slots(pack_lengths(histogram, max_tokens))
    places = spark.createDataFrame(
        patterns, "length long, lo long, hi long, copies long, first_sequence long, first_offset long")
    before = Window.partitionBy("length").orderBy("_x_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = store(counts.select("_x_part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                  "pack-bases")
    ranked = (pieces.join(broadcast_rows(bases), ["_x_part", "length"])
              .withColumn("rank", F.col("base") + F.col("_x_local")))
    nth = F.col("rank") - F.col("lo")
    # The places are bounded by max_tokens alone, whatever the data.
    return (ranked.join(F.broadcast(places), "length").where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select(F.col("_x_id").alias(id_col), "start", "length", "doc_tokens", "ids",
                    (F.col("first_sequence") + F.floor(nth / F.col("copies"))).cast("long").alias("sequence_id"),
                    (F.col("first_offset") + (nth % F.col("copies")) * F.col("length")).cast("long").alias("offset")))
