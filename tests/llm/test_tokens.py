import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.tokens import blocks, encoder, tokenizer_path, with_token_counts

ENCODER = encoder(tokenizer_path())
PARTS = ["a", "b ", " ", "  ", "\n", "\t", "é", "'s", "1", "...", ",", "\u00a0", "<|endoftext|>", "\x1c", "\u3000", " \n", "日本", "\x85"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=3)), max_size=9).map("".join), max_size=6))
def test_ids_are_those_of_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [bytes(x) for x in ENCODER.encode(pa.array(texts, pa.string()))] == ENCODER.whole(texts)


def test_null_is_empty_and_blocks_cover_all_rows():
    assert [bytes(x) for x in ENCODER.encode(pa.array([None, "a"], pa.string()))] == ENCODER.whole(["", "a"])
    batch = pa.record_batch({"text": pa.array(["x" * 10, None, "y" * 40, "", "z"])})
    parts = list(blocks(batch, most=12))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_counts_keep_rows_and_columns(odd_docs, odd_rows):
    got = with_token_counts(odd_docs, "n").collect()
    want = [len(x) // 4 + 1 for x in ENCODER.whole([r[1] or "" for r in odd_rows])]
    assert sorted(r["n"] for r in got) == sorted(want)
    assert got[0].asDict().keys() == {*odd_docs.columns, "n"}
