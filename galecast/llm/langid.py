"""Language identification with error-correcting output codes.

Every language has a codeword; one binary classifier for each bit tells the languages with a 1 from those with a 0. A classifier
is a table of log-odds of hashed byte n-grams, learned from n-gram counts that Spark sums by language over a bounded sample. A
text's margin for a bit is the mean log-odds of its n-grams. Decoding charges each codeword the logistic loss of its bits, each
bit weighted by how well its classifier tells the sample apart, and takes the codeword with the least; a small lead over the
second best is flagged as ambiguous. So a few wrong bits do not change the answer.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from galecast.llm.text import passes, texts

#: Labelled rows of a language that the classifiers learn from (expected number; a hash of the row decides) and their bound.
SAMPLE_ROWS = 400
#: n-gram lengths in bytes, and hash buckets of each length.
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 14
#: Bits of a random codeword where there are too many languages for the exhaustive code.
EXHAUSTIVE, RANDOM_BITS = 6, 10
SMOOTH = 0.5
#: Margins are scaled to this standard deviation on the sample, so that losses do not depend on the number of languages.
SCALE = 4.0
AMBIGUOUS = 0.2
UNKNOWN = "und"
COLUMNS = "lang_pred string, score double, second string, ambiguous boolean"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(128)]


class Model(NamedTuple):
    langs: list[str]
    code: np.ndarray  # (langs, bits), 0 or 1
    table: np.ndarray  # (orders * BUCKETS, bits) log-odds
    middle: np.ndarray  # (bits,) threshold of the margin
    weight: np.ndarray  # (bits,)


def codewords(n: int) -> np.ndarray:
    """Up to EXHAUSTIVE languages: all splits of them in two. More: random words in which every bit splits them evenly."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= EXHAUSTIVE:
        return np.array([[1, *rest] for rest in itertools.product((0, 1), repeat=n - 1)][:-1], np.int8).T
    random, bits = np.random.default_rng(5), int(np.ceil(RANDOM_BITS * np.log2(n)))
    best, far = None, -1
    for _ in range(64):
        code = np.stack([random.permutation(n) % 2 for _ in range(bits)], axis=1).astype(np.int8)
        least = min((code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2))
        best, far = (code, least) if least > far else (best, far)
    return best


def grams(data: np.ndarray, starts: np.ndarray = np.zeros(1, np.int64)) -> np.ndarray:
    """(bytes, orders): table row of the n-gram that ends at each byte; those that reach over the front of their text start at it.

    starts: where the texts of data begin.
    """
    data = _FOLD[data].astype(np.uint32)
    out, key = np.empty((len(data), len(ORDERS)), np.int32), np.zeros(len(data), np.uint32)
    place = np.full(len(data), max(ORDERS), np.uint8)
    for j in range(max(ORDERS) - 2, -1, -1):
        place[starts[starts + j < len(data)] + j] = j
    for k in range(max(ORDERS)):
        more = (data[: len(data) - k] + np.uint32(1)) * np.uint32((0x01000193, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[k])
        more[place[k:] < k] = 0
        key[k:] += more
        if k + 1 in ORDERS:
            i = ORDERS.index(k + 1)
            hashed = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out[:, i] = ((hashed >> np.uint32(12)) & np.uint32(BUCKETS - 1)).astype(np.int32) + i * BUCKETS
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse n-gram counts of each language in a partition."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in passes(batch):
            data, offsets = texts(part.column("text"))
            for lang, a, b in zip(part.column("lang").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                total = totals.setdefault(lang, np.zeros(len(ORDERS) * BUCKETS, np.int64))
                total += np.bincount(grams(data[a:b]).ravel(), minlength=len(total))
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["lang", "gram", "n"])


def train(labelled: DataFrame, row: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled (text, lang). row: what the sampling hash is taken of.

    The sample holds about sample_rows rows of each language (all where there are fewer), the classifiers number as many as the
    codewords have bits; both and the count tables are bounded whatever the size of the corpus. The languages' sizes go
    through the driver. Rows without text or language
    teach nothing. Without any labelled row the model knows no language.
    """
    labelled = labelled.select(row.alias("row"), "text", "lang").where("text is not null and lang is not null")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("rows")).collect()
    span = 1 << 30
    limit = [F.lit(x) for r in sizes for x in (r["lang"], sample_rows * span // r["rows"])]
    share = F.element_at(F.create_map(*limit), F.col("lang")) if limit else F.lit(0)
    sample = labelled.where(F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(span)) < share)
    counts = sample.select("lang", "text").mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts.column("lang").to_pylist()))
    table = np.zeros((len(names), len(ORDERS) * BUCKETS))
    where = np.searchsorted(names, counts.column("lang").to_pylist()) if names else np.zeros(0, int)
    table[where, counts.column("gram").to_numpy()] = counts.column("n").to_numpy()
    return fit(names, table)


def fit(names: list[str], counts: np.ndarray) -> Model:
    """Log-odds of each bit. A language counts as much as any other, however much text it has."""
    code = codewords(len(names))
    share = np.empty_like(counts)
    for i in range(len(ORDERS)):
        part = counts[:, i * BUCKETS : (i + 1) * BUCKETS] + SMOOTH * counts[:, i * BUCKETS : (i + 1) * BUCKETS].sum(axis=1, keepdims=True) / 1e5 + 1e-9
        share[:, i * BUCKETS : (i + 1) * BUCKETS] = part / part.sum(axis=1, keepdims=True)
    odds = np.zeros((counts.shape[1], code.shape[1]))
    for bit in range(code.shape[1]):
        yes, no = code[:, bit] == 1, code[:, bit] == 0
        if yes.any() and no.any():
            odds[:, bit] = np.clip(np.log(share[yes].mean(axis=0) / share[no].mean(axis=0)), -6, 6)
    # The margins that texts of a language have on average give each bit its threshold, its scale and its weight.
    mean = (share @ odds) / len(ORDERS) if len(names) else np.zeros((0, code.shape[1]))
    middle, weight = np.zeros(code.shape[1]), np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        yes, no = mean[code[:, bit] == 1, bit], mean[code[:, bit] == 0, bit]
        if len(yes) and len(no):
            middle[bit] = (yes.min() + no.max()) / 2
            weight[bit] = max(yes.min() - no.max(), 0.0)
            odds[:, bit] *= SCALE / max(weight[bit], 0.05)
            middle[bit] *= SCALE / max(weight[bit], 0.05)
    weight = weight / weight.sum() if weight.sum() > 0 else np.full(len(weight), 1 / len(weight))
    return Model(names, code, odds.astype(np.float32), middle, weight)


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, bits): mean log-odds over a text's n-grams, less the threshold; an empty text has none."""
    sums = np.zeros((len(offsets) - 1, model.code.shape[1]))
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    low, high = offsets[:-1][some], offsets[1:][some]
    step = 1 << 18
    for a in range(0, len(data), step):
        front = max(0, a - max(ORDERS))
        begin = low[np.searchsorted(low, front) : np.searchsorted(low, a + step)] - front
        part = grams(data[front : a + step], begin)[a - front :]
        value = model.table[part[:, 0]]
        for i in range(1, len(ORDERS)):
            value += model.table[part[:, i]]
        first, last = np.searchsorted(high, a, side="right"), np.searchsorted(low, a + len(part))
        sums[some[first:last]] += np.add.reduceat(value, np.maximum(low[first:last], a) - a, axis=0, dtype=np.float64)
    return sums / (np.maximum(size, 1)[:, None] * len(ORDERS)) - model.middle


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest and the second nearest codeword and the share of the nearest, from the weighted losses."""
    sign = 2.0 * model.code.T - 1
    loss = np.stack([(np.logaddexp(0, -margin * sign[:, i]) * model.weight).sum(axis=1) for i in range(sign.shape[1])], axis=1)
    share = np.exp(-SCALE * (loss - loss.min(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    order = np.argsort(loss, axis=1, kind="stable")
    return order[:, 0], order[:, min(1, order.shape[1] - 1)], np.take_along_axis(share, order[:, :1], axis=1)[:, 0]


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of docs with the columns of COLUMNS; columns of such names in docs are replaced.

    A null text, or one without any letter, is `und` with score 0, as is everything where the model knows no language. Only the
    text decides. `second` is the next best language, null where there is none. No shuffle.
    """
    added = [part.split()[0] for part in COLUMNS.split(", ")]
    kept = [name for name in docs.columns if name not in added]
    docs = docs.select(*(F.col(f"`{name}`") for name in kept), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    names = np.array([*model.langs, UNKNOWN, None], object)
    known = len(model.langs)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in passes(batch, text, 1 << 20):
                letter = part.column("_letter").to_numpy(zero_copy_only=False) & (known > 0)
                best, second, score = np.full(len(letter), known), np.full(len(letter), known + 1), np.zeros(len(letter))
                if known:
                    first, other, share = decode(model, margins(model, *texts(part.column(text))))
                    best, score = np.where(letter, first, known), np.where(letter, share, 0.0)
                    second = np.where(letter & (other != first), other, known + 1)
                unsure = (score < 0.5 + AMBIGUOUS) | ~letter
                rest = [part.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(names[best], pa.string()), pa.array(score), pa.array(names[second], pa.string()), pa.array(unsure)], names=[*kept, *added])

    return docs.mapInArrow(predict, StructType([*docs.schema.fields[:-1], *StructType.fromDDL(COLUMNS).fields]))


def predicted_documents(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out and the columns of COLUMNS of every document.

    Documents whose crc32(doc_id as text) mod 3 is 1 are held out, the others with a language are learned from. A null doc_id is
    not held out and not learned from.
    """
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    learned = docs.where(third.isin(0, 2)).select("doc_id", "text", "lang")
    model = train(learned, F.col("doc_id"), sample_rows)
    slim = docs.select("doc_id", F.coalesce(third == 1, F.lit(False)).alias("held_out"), "text")
    return with_language(slim, model).drop("text")
