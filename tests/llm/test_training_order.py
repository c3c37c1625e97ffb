"""Shards read back as they were written, from any slot, with and without ids."""

import pytest

from sensitext.llm.tokens import WordTokenizer, tokenizer_path
from sensitext.llm.training_order import feistel, read_order, token_sequences, write_training_order

LONG = "one two three four five six seven eight nine ten " * 9


def test_a_missing_id_is_not_minus_one(spark, tmp_path):
    rows = [(None, LONG), (-1, LONG + "end"), (None, None), (-1, ""), (0, "a"), (2**62, "b")]
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id bigint, text string, slot int")
    folder = str(tmp_path / "order")
    total = write_training_order(docs, folder, seq_len=32, shard_slots=4)
    found = read_order(spark, folder).collect()
    assert sorted(r.slot for r in found) == list(range(total))
    tokens = WordTokenizer(tokenizer_path(), "<u2")
    want = []
    for doc, text in rows:
        packed = tokens.encode(text or "") + b"\1\0"
        want += [(str(doc), k, packed[at : at + 64]) for k, at in enumerate(range(0, len(packed), 64))]
    assert sorted((str(r.doc_id), r.piece, bytes(r.ids)) for r in found) == sorted(want)
    assert all(r.length == len(r.ids) // 2 > 0 for r in found)


@pytest.mark.parametrize("key", [0, 42, 2**63])
def test_slots_are_those_of_the_permutation(spark, tmp_path, key):
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('w ', int(id)) AS text").coalesce(1)
    folder = str(tmp_path / "order")
    total = write_training_order(docs, folder, key=key, seq_len=8, shard_slots=16)
    drafts = token_sequences(docs, tokenizer_path(), 8, 1).orderBy("part", "nth").collect()
    assert len(drafts) == total
    slots = feistel(range(total), total, key).tolist()
    want = {(d.doc_id, d.piece): slot for d, slot in zip(drafts, slots)}
    for first in (0, 1, 15, 16, total - 1):
        rows = read_order(spark, folder, first_slot=first).collect()
        assert {(r.doc_id, r.piece): r.slot for r in rows} == {
            k: s for k, s in want.items() if s >= first
        }
