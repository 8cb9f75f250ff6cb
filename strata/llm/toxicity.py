"""Toxicity scores from a learned lexicon, misspellings and context windows.

Terms are learned from labelled rows. The lexicon's trie intersected with a
Levenshtein automaton gives one table-driven automaton that accepts every term
and its misspellings; it runs over the distinct words of each batch. Windows
around the hits tell quotation from abuse. A term weighs as much as labelled
rows that hold it are toxic, and a small logistic regression turns a text's
abuse and quotation into a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import broadcast_rows, col, store, text_or_empty
from strata.llm.words import _A, SLICE_BYTES, U, mixed, slices, words

# A term: letters of any script, with their marks and joiners.
TERM = r"^\p{L}[\p{L}\p{M}\x{200C}\x{200D}]*$"
TRIMMED = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

MIN_LENGTH = 4          # bytes of a term: four ASCII letters, two of most other scripts
MIN_ROWS = 3            # toxic rows with a term, copies counted once
FIRST_PART = 8          # frequent words are ruled out by one in so many of the other rows
HEAD = 5                # first words by which copies of a text are told
LIFT = 20.0             # times as frequent (per row) as in other rows
EDIT_LENGTH = 5         # terms from this length on may be misspelled by one edit
WINDOW = 8              # words on either side of a hit
FIT_ROWS = 20_000       # labelled rows the regression is fitted on at most
MISSPELLED = 0.8        # a misspelled hit, in exact hits
# Words that report speech, and words that address somebody.
REPORTING = ("said", "says", "say", "called", "calls", "quote", "quoted", "quotes", "wrote", "writes", "word", "term")
ADDRESSING = ("you", "your", "youre", "you're", "u", "ur")
OPENING, CLOSING = "\"“„«‘'", "\"”“»’'"


def lexicon_automaton(terms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(moves, term, edits, to, default, alphabet)`` of the terms' trie
    intersected with the automaton of one Levenshtein edit (or swap of
    neighbours).

    ``alphabet`` holds the code points of the terms, sorted. From ``state``
    the letter ``alphabet[c]`` leads to ``to[i]`` if ``moves[i]`` is
    ``state * len(alphabet) + c``, every other character to
    ``default[state]``; state 0 is dead, 1 the first. ``term`` and ``edits``
    give what a state accepts (term -1: nothing).
    """
    alphabet = sorted({letter for word in terms for letter in word})
    number_of = {letter: c for c, letter in enumerate(alphabet)}
    other = len(alphabet)
    children: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    edits_of: list[int] = [0]  # most edits of any term below
    for number, word in enumerate(terms):
        node, allowed = 0, int(len(word) >= EDIT_LENGTH)
        edits_of[0] = max(edits_of[0], allowed)
        for letter in word:
            c = number_of[letter]
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
                edits_of.append(0)
            node = children[node][c]
            edits_of[node] = max(edits_of[node], allowed)
        ends[node] = number

    # A place is (trie node, edits used, letter still owed by a swap or -1).
    def closed(places):
        out = set(places)
        for node, used, owed in places:
            if not used and owed < 0:
                out |= {(child, 1, -1) for child in children[node].values() if edits_of[child]}
        return frozenset(out)

    def read(places, letter):
        out = set()
        for node, used, owed in places:
            if owed >= 0:
                if owed == letter:
                    out.add((node, used, -1))
                continue
            if letter in children[node]:
                out.add((children[node][letter], used, -1))
            if not used and edits_of[node]:
                out.add((node, 1, -1))
                for first, child in children[node].items():
                    if edits_of[child]:
                        out.add((child, 1, -1))
                        if letter in children[child] and edits_of[children[child][letter]]:
                            out.add((children[child][letter], 1, first))
        return closed(out)

    def letters_of(places):
        # The letters that may lead elsewhere than any other character.
        out = set()
        for node, used, owed in places:
            if owed >= 0:
                out.add(owed)
                continue
            out.update(children[node])
            if not used and edits_of[node]:
                for child in children[node].values():
                    out.update(children[child])
        return sorted(out)

    first = closed({(0, 0, -1)})
    numbers = {frozenset(): 0, first: 1}
    queue, moves, to, default = [first], [], [], [0]

    def number(places):
        if places not in numbers:
            numbers[places] = len(numbers)
            queue.append(places)
        return numbers[places]

    for places in queue:
        state, rest = len(default), number(read(places, other))
        default.append(rest)
        for letter in letters_of(places):
            after = number(read(places, letter))
            if after != rest:
                moves.append(state * len(alphabet) + letter)
                to.append(after)
    term, edits = np.full(len(default), -1), np.zeros(len(default), np.int64)
    for places, state in numbers.items():
        best = min(((used, ends[node]) for node, used, owed in places
                    if owed < 0 and ends[node] >= 0 and (not used or len(terms[ends[node]]) >= EDIT_LENGTH)), default=None)
        if best:
            edits[state], term[state] = best
    return (np.array(moves, np.int64), term, edits, np.array(to, np.int32), np.array(default, np.int32),
            np.array([ord(letter) for letter in alphabet], np.int64))


def _code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Code points of the characters whose first bytes are ``lead``."""
    at = np.flatnonzero(lead)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    b0, b1, b2, b3 = (padded[at + i] if not i else padded[at + i] & 0x3F for i in range(4))
    return np.select([b0 < 0x80, b0 < 0xE0, b0 < 0xF0],
                     [b0, (b0 & 0x1F) << 6 | b1, (b0 & 0x0F) << 12 | b1 << 6 | b2],
                     (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3)


def run_automaton(automaton, cores: pa.Array) -> np.ndarray:
    """The state in which each (lower-case) word ends, 0 for words not accepted."""
    moves, term, _, to, default, alphabet = automaton
    cores = cores.cast(pa.binary())
    if not len(cores):
        return np.zeros(0, np.int32)
    offsets = np.frombuffer(cores.buffers()[1], np.int32)[cores.offset:cores.offset + len(cores) + 1].astype(np.int64)
    data = np.frombuffer(cores.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    lead = (data & 0xC0) != 0x80  # one symbol a character
    at = np.concatenate([[0], np.cumsum(lead)])[offsets - offsets[0]]
    points = _code_points(data, lead)
    symbols = np.searchsorted(alphabet, points)
    symbols[(symbols == len(alphabet)) | (np.append(alphabet, -1)[symbols] != points)] = -1
    length = np.diff(at)
    state = np.ones(len(cores), np.int32)
    alive = np.arange(len(cores))
    step = 0
    while len(alive):
        alive = alive[length[alive] > step]
        now, letter = state[alive], symbols[at[alive] + step]
        key = np.where(letter >= 0, now * np.int64(len(alphabet)) + letter, -1)
        i = np.searchsorted(moves, key)
        state[alive] = np.where(np.append(moves, -2)[i] == key, np.append(to, 0)[i], default[now])
        alive = alive[state[alive] > 0]
        step += 1
    state[term[state] < 0] = 0
    return state


def _cores(dictionary: pa.Array) -> pa.Array:
    """Words without punctuation at their ends, lower-case in every script."""
    cores = pc.ascii_trim(dictionary, characters=TRIMMED)
    try:
        return pc.utf8_lower(cores)
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([c.decode("utf-8", "replace").lower() for c in cores.cast(pa.binary()).to_pylist()], cores.type)


def _contexts():
    """Batches (text) to ``(word, context, head)``: the cores that may be
    terms with hashes of the words on either side and of the text's first
    words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                encoded, at = words(part.column(0))
                if not len(encoded):
                    continue
                cores = _cores(encoded.dictionary)
                fits = pc.and_(pc.match_substring_regex(cores, TERM),
                               pc.greater_equal(pc.binary_length(cores), MIN_LENGTH))
                index = encoded.indices.to_numpy()
                h = np.fromiter((xxhash.xxh64_intdigest(c) for c in cores.to_pylist()), np.uint64, len(cores))[index]
                edge = np.zeros(len(index), bool)
                edge[at[:-1][np.diff(at) > 0]] = True
                before = np.where(edge, U(1), np.concatenate([[U(1)], h[:-1]]))
                after = np.where(np.concatenate([edge[1:], [True]]), U(2), np.concatenate([h[1:], [U(2)]]))
                context = mixed(before * _A + after)
                n = np.diff(at)
                filled = at[:-1][n > 0]
                first = np.zeros(len(filled), np.uint64)
                for i in range(HEAD):
                    first = mixed(first * _A + h[np.minimum(filled + i, at[1:][n > 0] - 1)])
                head = np.repeat(first, n[n > 0])
                pick = np.flatnonzero(fits.to_numpy(zero_copy_only=False)[index])
                seen = pa.table({"word": cores.take(pa.array(index[pick])), "context": pa.array(context[pick].view(np.int64)),
                                 "head": pa.array(head[pick].view(np.int64))})
                yield from seen.group_by(["word", "context", "head"]).aggregate([]).to_batches()
    return run


def learn_lexicon(labelled: DataFrame, label: str, text_col: str) -> list[str]:
    """Terms that toxic rows use far more often than others.

    A use counts by its context and by the text's first words, the smaller
    number of the two, so that copies and near copies of one text count once.
    A term must be LIFT times as frequent in toxic rows, and so much so that
    by chance (Chernoff's bound) less than a tenth of a word would be.

    Both counts cover every labelled row. Words are counted and tested in
    Spark; only the terms found reach the driver. Uses in a part of the other
    rows are at most those in all, so a word that fails the first test there
    fails it for good; the words left are counted in all other rows.
    """
    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []

    def uses(rows: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
        found = (rows.select(text_or_empty(text_col).alias("text"))
                 .mapInArrow(_contexts(), "word string, context long, head long"))
        if wanted is not None:
            found = found.join(broadcast_rows(wanted.select("word")), "word", "left_semi")
        return found.groupBy("word").agg(F.least(F.count_distinct("context"), F.count_distinct("head")).alias("n"))

    def passing(words: DataFrame, others: DataFrame | None, tested: int) -> DataFrame:
        # The words (word, k) that pass both tests by their uses in ``others``.
        counts = words if others is None else words.join(others, "word", "left")
        rest = F.lit(0) if others is None else F.coalesce("n", F.lit(0))
        k, p = F.col("k"), n1 / (n1 + n0)
        q = k / (k + rest)
        # -log of the bound on k or more of k + rest uses in toxic rows.
        surprise = (k + rest) * (q * F.log(q / p) + F.when(rest > 0, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0))
        return counts.where((k / n1 >= LIFT * (rest + 0.5) / (n0 + 1)) & (q > p)
                            & (surprise >= math.log(10 * tested))).select("word", "k")

    toxic = store(uses(labelled.where(F.col(label) == 1)).where(F.col("n") >= MIN_ROWS)
                  .withColumnRenamed("n", "k"), "tox-words")
    tested = toxic.count()
    if not tested:
        return []
    other = labelled.where(F.col(label) == 0)
    left = store(passing(toxic, None, tested), "tox-words-left")
    part = other.where(F.pmod(F.xxhash64(text_or_empty(text_col)), F.lit(FIRST_PART)) == 0)
    left = store(passing(left, uses(part, left), tested), "tox-words-rare")
    return sorted(r["word"] for r in passing(left, uses(other, left), tested).collect())


# A hit's term is its number in the lexicon.
HITS = "hits array<struct<word:string,term:int,exact:boolean,quoted:boolean,addressed:boolean>>, n_words long"


def _hits(automaton, id_index: int):
    """Batches (passed..., text) to passed columns, hits and word count."""
    def near(flags: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[hi] > total[lo]

    kind = pa.list_(pa.struct([("word", pa.string()), ("term", pa.int32()), ("exact", pa.bool_()),
                               ("quoted", pa.bool_()), ("addressed", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, term, edits, *_ = automaton
        for batch in batches:
            for part in slices(batch, id_index, SLICE_BYTES):
                encoded, at = words(part.column(id_index))
                cores = _cores(encoded.dictionary)
                state = run_automaton(automaton, cores)
                index = encoded.indices.to_numpy()
                pos = np.flatnonzero(state[index] > 0)
                hit = index[pos]
                doc = np.searchsorted(at, pos, side="right") - 1
                lo, hi = np.maximum(at[doc], pos - WINDOW), np.minimum(at[doc + 1], pos + WINDOW + 1)
                if len(pos):
                    every = encoded.dictionary
                    opens = pc.match_substring_regex(every, "^[" + OPENING + "]").to_numpy(zero_copy_only=False)[index]
                    closes = pc.match_substring_regex(every, "[" + CLOSING + "][.,;:!?]*$").to_numpy(zero_copy_only=False)[index]
                    reports = pc.is_in(cores, value_set=pa.array(REPORTING, cores.type)).to_numpy(zero_copy_only=False)[index]
                    address = pc.is_in(cores, value_set=pa.array(ADDRESSING, cores.type)).to_numpy(zero_copy_only=False)[index]
                    inside = near(opens, lo, pos + 1) & near(closes, pos, hi)
                    quoted, addressed = inside | near(reports, lo, pos), near(address, lo, hi)
                else:
                    quoted = addressed = np.zeros(0, bool)
                flat = pa.StructArray.from_arrays(
                    [cores.take(pa.array(hit)), pa.array(term[state[hit]], pa.int32()),
                     pa.array(edits[state[hit]] == 0), pa.array(quoted), pa.array(addressed)], fields=list(kind.value_type))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:id_index], lists, pa.array(np.diff(at))], names=[*part.schema.names[:id_index], "hits", "n_words"])
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression with a Gaussian prior around ``prior``
    (first column: the constant, hardly held), by Newton steps."""
    hold = np.full(x.shape[1], penalty)
    hold[0] = 1e-3
    w = prior.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + hold * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold + 1e-9), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


# Constant, strongest abuse, log(1 + abuse), log(1 + quoted), any address: the
# weights of what the labels do not show.
PRIOR = np.array([-2.0, 2.0, 1.0, 0.2, 0.5])


def score_toxicity(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text",
                   label: str = "toxic", fit_rows: int = FIT_ROWS, keep_text: bool = False) -> DataFrame:
    """One row per input row: its columns without the text (with it if
    ``keep_text``), ``score`` (0 to 1), ``n_abuse`` (the sum of the weights of
    the hits that are not quoted) and ``n_quoted`` (the number of those that are).

    Only labelled rows for which the condition ``train`` (over ``id_col``)
    holds are learned from; a score depends on the text and, where it holds a
    misspelling, on how frequent words are in the rows scored: a misspelling
    counts if it is no word of its own: it must be rarer in the corpus than
    half its term, and labelled rows must not show it outside toxic rows.

    Edge cases: null and empty texts score as texts without hits; null ids
    have no label; an id labelled twice has its larger label, null labels are
    ignored; without toxic labels no term is learned and all scores are equal;
    repeated rows are scored each; an empty table gives an empty result; input
    columns named like an added column are replaced.
    """
    own = {"score", "n_abuse", "n_quoted", "hits", "n_words", "y", text_col.lower()}
    carried = [c for c in docs.columns if c != id_col and c.lower() not in own and not c.startswith("_x_")]
    passed = [id_col, *carried, *([text_col] if keep_text else [])]
    known = store(labels.where(col(label).isin(0, 1)).groupBy(col(id_col)).agg(F.max(col(label)).cast("int").alias("y"))
                  .where(train), "tox-labels")
    known = broadcast_rows(known)
    terms = learn_lexicon(docs.select(col(id_col), col(text_col)).join(known, id_col), "y", text_col)
    automaton = lexicon_automaton(terms)

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    scanned = docs.select(*[col(c) for c in passed], text_or_empty(text_col).alias("_x_text")).mapInArrow(
        _hits(automaton, len(passed)), f"{fields}, {HITS}")
    rows = store(scanned, "tox-rows")

    # Misspellings that are words of their own. The variants of the terms are
    # bounded by the lexicon, as is what the driver gets of them.
    hit = rows.where(F.size("hits") > 0).select(col(id_col), F.explode(F.array_distinct(F.transform(
        "hits", lambda h: F.struct(h["word"].alias("word"), h["term"].alias("term"), h["exact"].alias("exact"))))).alias("h"))
    y = F.col("y")
    counts = (hit.join(known, id_col, "left").groupBy("h.word", "h.term", "h.exact")
              .agg(F.count(F.lit(1)).alias("df"), F.coalesce(F.sum(y), F.lit(0)).alias("df1"),
                   F.coalesce(F.sum(1 - y), F.lit(0)).alias("df0")).collect())
    total = known.agg(F.coalesce(F.sum(y), F.lit(0)), F.coalesce(F.sum(1 - y), F.lit(0))).first()
    of_term = {r["term"]: r["df"] for r in counts if r["exact"]}
    ordinary = sorted(r["word"] for r in counts if not r["exact"] and (
        r["df"] > 0.5 * of_term.get(r["term"], 0)
        or (r["df0"] and r["df1"] * (total[1] + 1) < LIFT * r["df0"] * (total[0] + 1))))

    real = F.col("hits")
    if ordinary:
        real = F.filter(real, lambda h: h["exact"] | ~h["word"].isin(ordinary))
    # A term's weight: the share of toxic rows among the labelled rows that hold
    # it, as if one other row held it too.
    rows_of = {r["term"]: (r["df1"], r["df0"]) for r in counts if r["exact"]}
    shares = [y1 / (y1 + y0 + 1.0) for y1, y0 in (rows_of.get(i, (0, 0)) for i in range(len(terms)))]
    weights_of = F.array(*[F.lit(w) for w in shares]) if shares else F.array().cast("array<double>")
    force = F.transform(F.filter("real", lambda h: ~h["quoted"]),
                        lambda h: F.get(weights_of, h["term"]) * F.when(h["exact"], 1.0).otherwise(MISSPELLED))
    counted = rows.withColumn("real", real).withColumn("_x_force", force).withColumns({
        "_x_abuse": F.aggregate("_x_force", F.lit(0.0), lambda a, x: a + x),
        "_x_strongest": F.coalesce(F.array_max("_x_force"), F.lit(0.0)), "_x_quoted": F.size(F.filter("real", lambda h: h["quoted"])).cast("double"),
        "_x_address": F.exists("real", lambda h: h["addressed"] & ~h["quoted"]).cast("double")})
    features = [F.lit(1.0), F.col("_x_strongest"), F.log1p("_x_abuse"), F.log1p("_x_quoted"),
                F.col("_x_address")]
    sample = (counted.join(known, id_col).select(*[f.alias(f"f{i}") for i, f in enumerate(features)], "y",
                                                 F.xxhash64(col(id_col)).alias("o"))
              .orderBy("o").limit(fit_rows).collect())
    x = np.array([[r[f"f{i}"] for i in range(len(features))] for r in sample]).reshape(-1, len(features))
    weights = fit_logistic(x, np.array([float(r["y"]) for r in sample]), PRIOR)
    z = sum((float(w) * f for w, f in zip(weights, features, strict=True)), F.lit(0.0))
    return counted.select(*[col(c) for c in passed], (1.0 / (1.0 + F.exp(-z))).alias("score"),
                          F.col("_x_abuse").alias("n_abuse"), F.col("_x_quoted").alias("n_quoted"))
