"""What a Python worker takes for one batch of texts."""

import tracemalloc

import pyarrow as pa
import pytest

from strata.llm import neardup, toxicity


@pytest.mark.parametrize("stage", ["contexts", "hits", "signatures"])
def test_a_batch_is_taken_apart_in_small_slices(stage):
    letters = "abcdefghij"
    text = " ".join("word" + "".join(letters[int(d)] for d in str(i)) for i in range(1000))
    texts = pa.array([text] * (8_000_000 // len(text)))
    ids = pa.array(range(len(texts)), pa.int64())
    run, columns = {
        "contexts": (toxicity._contexts(), [texts]),
        "hits": (toxicity._hits(toxicity.lexicon_automaton(["word", "words"]), 1), [ids, texts]),
        "signatures": (neardup._sign(1, 5), [ids, texts])}[stage]
    batch = pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows
    assert peak < 24_000_000, peak
