"""Words and hashes of batches."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from galecast.llm import lm, quality, substrings, text
from galecast.llm.chunks import Question, expand, expand_sorted, questions, squeeze, squeeze_sorted
from tests.llm.conftest import prose

SAMPLES = ["", None, "a", "  a\tb\n", "ab cd ab", "x\x0b\x0cy\x1cz w", "ü 漢字", "end ", " start", "a b c d e f a b c d e f"]


def found(samples):
    data, offsets = text.texts(pa.array(samples, pa.string()))
    starts, ends, bounds = text.words(data, offsets)
    raw = data.tobytes()
    words = [raw[a:b].decode() for a, b in zip(starts, ends)]
    return [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])], (data, starts, ends, bounds)


def test_words_equal_the_pattern():
    assert found(SAMPLES)[0] == [re.findall(text.WORD, s or "") for s in SAMPLES]
    assert found([])[0] == []
    assert found(["", None])[0] == [[], []]


def test_equal_words_have_equal_hashes_and_others_differ(monkeypatch):
    monkeypatch.setattr(text, "PASS_BYTES", 8)
    words, (data, starts, ends, bounds) = found(SAMPLES * 3)
    flat = [w for row in words for w in row]
    hashes = text.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(flat))
    assert all(len({h for h, w in zip(hashes.tolist(), flat) if w == word}) == 1 for word in set(flat))
    for k in (1, 2, 3):
        windows = [tuple(flat[i : i + k]) for i in range(len(flat) - k + 1)]
        got = text.window_hashes(hashes, k).tolist()
        assert len(dict(zip(windows, got))) == len(set(zip(windows, got))) == len(set(got))
        inside = {a + i for a, row in zip(bounds, words) for i in range(len(row) - k + 1)}
        assert set(text.window_starts(bounds, k).tolist()) == inside
    assert len(text.window_hashes(hashes[:2], 3)) == 0


def test_passes_cover_all_rows_once():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n for n in (0, 5, 30, 1, 1, 0)])})
    parts = [part.column("text").to_pylist() for part in text.passes(batch, limit=6)]
    assert sum(parts, []) == batch.column("text").to_pylist()
    assert ["a" * 30] in parts


def test_squeezed_integers_come_back():
    values = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    assert (expand(squeeze(values)) == values).all()
    assert (expand_sorted(squeeze_sorted(np.sort(values))) == np.sort(values)).all()
    assert len(expand(squeeze(values[:0]))) == 0


def test_covered():
    assert text.covered(np.array([0, 5]), 3, 9).tolist() == [True] * 3 + [False] * 2 + [True] * 3 + [False]


def thue_morse(bits: int, first: str, second: str) -> str:
    """2 ** bits letters whose polynomial hashes agree modulo any power of two that is not large against their number."""
    return "".join((first, second)[i.bit_count() & 1] for i in range(1 << bits))


@pytest.mark.parametrize("bits", [9, 10, 11, 12])
def test_regular_words_do_not_collide(spark, bits):
    one, two = thue_morse(bits, "a", "b"), thue_morse(bits, "b", "a")
    data, offsets = text.texts(pa.array([f"{one} {two}"]))
    first, second = text.word_hashes(data, *text.words(data, offsets)[:2], both=True)
    assert first[0] != first[1] and second[0] != second[1]
    rest = [prose(77, 1).split()[0] + str(i) for i in range(60)]
    rows = [(1, " ".join([*rest[:30], one, *rest[30:]])), (2, " ".join([*rest[:30], two, *rest[30:]])), (3, " ".join([one, *"cdef", two, *"cdef"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["n_removed"] for r in substrings.repeated_documents(docs).orderBy("doc_id").collect()] == [0, 0, 0]
    assert [r["n_repeat_words"] for r in quality.with_quality(docs).orderBy("doc_id").collect()] == [0, 0, 0]
    assert lm.scored_documents(docs.where("doc_id < 3")).where("n_backed_off = 0").count() == 0
    known = lm.scored_documents(docs.where("doc_id < 3")).select("log_score").collect()
    both = lm.scored_documents(docs.where("doc_id < 3").withColumn("text", F.regexp_replace("text", two, one))).select("log_score").collect()
    assert max(r[0] for r in known) < min(r[0] for r in both)


def test_questions_are_whole_at_any_number_of_buckets():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1))
    for bits in (4, 12, 30):
        rows = questions(7, Question(keys, keys >> np.uint64(9)), bits).to_pydict()
        assert rows["bucket"] == sorted(set((keys >> np.uint64(64 - bits)).tolist()))
        assert (np.concatenate([expand_sorted(x) for x in rows["keys"]]) == keys).all()
        assert (np.concatenate([expand(x) for x in rows["numbers"]]) == keys >> np.uint64(9)).all()
    assert questions(7, Question(keys[:0], keys[:0]), 4).num_rows == 0
