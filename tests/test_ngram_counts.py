"""Phrases counted by numbers against phrases counted one by one."""

from collections import Counter

import pyarrow as pa
import pytest

from articlespark.operators import ngrams

TEXTS = ["the fox of the fox of the fox", None, "", "of the", "ü é ü é ü", "fox", "the the the", None, "é of the é of the"]


@pytest.mark.parametrize("sizes", [[1, 2, 3], [2, 3], [3]])
@pytest.mark.parametrize("weak", [[], ["the", "of"]])
@pytest.mark.parametrize("piece", [1, 12, 1 << 20])
def test_phrases_of_every_row_and_piece(monkeypatch, sizes, weak, piece):
    monkeypatch.setattr(ngrams, "PIECE_BYTES", piece)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS)], ["id", "words"])
    got = [(i, n, term, cnt) for part in ngrams._pieces(batch, [1]) for n, rows, terms, counts in ngrams._phrase_counts(part.column(1), sizes, weak)
           for i, term, cnt in zip(part.column(0).take(rows).to_pylist(), terms.to_pylist(), counts.to_pylist())]
    expected = Counter()
    for i, text in enumerate(TEXTS):
        words = text.split() if text else []
        for n in sizes:
            phrases = [words[k:k + n] for k in range(len(words) - n + 1)]
            expected.update((i, n, " ".join(p)) for p in phrases if n == 1 or not set(weak).issuperset(p))
    assert sorted(got) == sorted((*key, cnt) for key, cnt in expected.items())


def test_no_rows_and_no_words():
    for texts in ([], [None], ["", None]):
        assert list(ngrams._phrase_counts(pa.array(texts, pa.string()), [1, 2, 3], ["the"])) == []
