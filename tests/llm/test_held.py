"""Workers are handed from stage to stage: what one operator held goes when another's task begins."""

import weakref

import pyarrow as pa
import pytest

from tallyquill.llm import bpe_chunks, ngram_join, toxicity, word_bpe
from tallyquill.llm.queries import BYTE_BPE, WORD_BPE

TEXTS = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three four five six", "seven"])], names=["doc_id", "text"])
LABELLED = pa.RecordBatch.from_arrays([pa.array(["one two", "three"]), pa.array([0, 1])], names=["text", "label"])


@pytest.mark.parametrize("task", [lambda: ngram_join._classes(5)([TEXTS]), lambda: toxicity._counts([LABELLED]), lambda: [bpe_chunks.chunk_bpe(BYTE_BPE)]])
def test_another_task_lets_go_of_the_encoder(task):
    ours = weakref.ref(word_bpe.word_bpe(WORD_BPE))
    assert ours() is word_bpe.word_bpe(WORD_BPE)
    list(task())
    assert ours() is None
