import numpy as np
import pyarrow as pa

from opinara.llm import language
from opinara.llm.common import trimmed


def test_a_reader_gives_its_rows_and_then_its_memory(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    monkeypatch.setattr(pa, "system_memory_pool", Pool)
    rows = trimmed(lambda batches: (b * 2 for b in batches))(iter([1, 2]))
    assert next(rows) == 2 and not released
    assert list(rows) == [4] and len(released) == 2


def test_numbers_of_words_are_narrow():
    table = np.zeros((language.TABLE + 1, 2), np.float32)
    model = language.Model(["de", "en"], table, np.zeros((language.OTHER + 1, 2), bool))
    scores, *numbers, first = language.scored_words([b"one two", b"three"], model)
    assert scores.dtype == np.float32 and {x.dtype for x in numbers} == {np.dtype(np.int32)}
    assert first.tolist() == [0, 2, 3]
