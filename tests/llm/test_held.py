"""What worker processes keep between tasks."""

from __future__ import annotations

import gc

import public_tokenizers

from millrace.llm import bpe
from millrace.llm.common import arrow_map, held, release


def test_operators_do_not_leave_their_objects_to_others(spark):
    """Workers are used again, so a tokenizer would stand beside whatever runs after it."""
    rows = spark.range(64).selectExpr("concat('word ', id) AS text").repartition(8).cache()
    tokenizer = public_tokenizers.path("word_bpe_49k.json")

    def count(batches):
        gc.collect()
        here = sum(isinstance(o, bpe.Bpe) for o in gc.get_objects())
        for batch in batches:
            yield batch.from_arrays([batch.column(0), [here] * batch.num_rows], names=["text", "n"])

    for holds, kept in ((bpe.HELD, True), (None, False)):
        encoded = bpe.encode(rows, tokenizer).collect()
        assert len(encoded) == 64 and all(len(r["ids"]) for r in encoded)
        seen = {r["n"] for r in arrow_map(rows, count, "text string, n long", holds).collect()}
        assert (max(seen) > 0) == kept, seen
    rows.unpersist()


def test_objects_of_one_kind_are_made_once():
    made = []

    def make():
        made.append(len(made))
        return made[-1]

    try:
        assert [held("a", "x", make), held("a", "y", make), held("a", "x", make)] == [0, 1, 0]
        release("a")
        assert held("a", "y", make) == 1
        release("b")
        assert held("a", "y", make) == 2
    finally:
        release(None)
