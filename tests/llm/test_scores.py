"""Language ID, backoff scores, quality bands."""

import collections
import math
import re
import time

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from galecast.llm import langid, lm, quality
from galecast.llm.text import WORD

SF = "/root/testdata/sf0.01"


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 6, 7, 30):
        code = langid.codewords(n)
        far = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert far >= (1 if n == 2 else 2 ** (n - 2) if n <= 6 else 4)
        assert all(0 < column.sum() < n for column in code.T)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predicted_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got["lang"] == got["lang_pred"]).mean() > 0.98
    assert got["score"].between(0, 1).all()


def test_a_few_wrong_bits_do_not_change_the_answer():
    model = langid.Model(list("abcd"), langid.codewords(4), np.zeros((1, 7)), np.zeros(7), np.full(7, 1 / 7))
    for i in range(4):
        margin = (2.0 * model.code[i] - 1) * 3
        margin[i] *= -1
        best, _, share = langid.decode(model, margin[None, :])
        assert best[0] == i and 0 < share[0] <= 1
    assert langid.decode(model, np.zeros((1, 7)))[2][0] == pytest.approx(0.25)


def test_only_the_text_of_learned_rows_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = langid.predicted_documents(docs)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert first.exceptAll(langid.predicted_documents(other)).count() == 0


def test_language_of_odd_rows(odd, empty):
    got = {r["doc_id"]: r for r in langid.predicted_documents(odd).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (100, 101, 102, 108))
    assert got[106]["lang_pred"] in ("xx", "yy") and langid.predicted_documents(odd).count() == odd.count()
    assert langid.predicted_documents(empty).count() == 0
    none = langid.predicted_documents(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def backoff(texts, order):
    words = [re.findall(WORD, t or "") for t in texts]
    count = collections.Counter(tuple(w[j : j + n]) for w in words for n in range(1, order + 1) for j in range(len(w) - n + 1))
    total = sum(map(len, words))
    out = []
    for w in words:
        own = collections.Counter(tuple(w[j : j + n]) for n in range(1, order + 1) for j in range(len(w) - n + 1))
        left = lambda g: count[g] - own[g]  # noqa: B023, E731
        score = 0.0
        for j in range(len(w)):
            for n in range(min(order, j + 1), 0, -1):
                gram = tuple(w[j - n + 1 : j + 1])
                if n == 1:
                    score += math.log(left(gram) / (total - len(w)) if left(gram) else 1 / (total - len(w) + 1))
                elif left(gram):
                    score += math.log(left(gram) / left(gram[:-1]))
                    break
                else:
                    score += math.log(lm.BACKOFF)
        out.append((len(w), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(odd, order):
    rows = [r["text"] for r in odd.collect()]
    got = lm.scored(odd.select("text", "kept", "n_words" if "n_words" in odd.columns else "doc_id"), order)
    mine = sorted((r["n_words"], round(r["log_score"], 5)) for r in got.collect())
    want = sorted((n, round(s, 5)) for n, s in backoff(rows, order))
    assert [n for n, _ in mine] == [n for n, _ in want]
    assert np.allclose([s for _, s in mine], [s for _, s in want], atol=1e-4)


def test_longer_context_counts_in_the_registered_order(spark):
    texts = ["a b c", "a b c", "x b d", "x b d", "a b d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.scored_documents(docs).collect()}
    for i, (n, score) in enumerate(backoff(texts, 3)):
        assert got[i]["n_words"] == n and got[i]["log_score"] == pytest.approx(score)
    assert got[4]["n_backed_off"] == 1  # others hold "a b" and "b d", but not "a b d"


def test_counts_do_not_depend_on_blocks(odd, spark):
    rows = sorted((len(re.findall(WORD, r["text"] or "")), round(s, 4)) for r, (_, s) in zip(odd.collect(), backoff([r["text"] for r in odd.collect()], 3), strict=True))
    for size in (1, 3000, 1 << 30):
        got = sorted((r["n_words"], round(r["log_score"], 4)) for r in lm.scored(odd.select("doc_id", "text"), block_bytes=size).collect())
        assert [n for n, _ in got] == [n for n, _ in rows]
        assert np.allclose([s for _, s in got], [s for _, s in rows], atol=1e-3)


def test_blocks_cut_by_the_reader_keep_their_counts(odd):
    blocks = lm.in_blocks(odd.select("doc_id", "text"), 1 << 20)
    count = lambda df: {r["gram"]: r["n"] for r in df.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    whole, cut = count(lm.grams_of(blocks, 2)), count(lm.grams_of(blocks.repartition(7), 2))
    assert whole == cut
    told = lm.told_back(lm.grams_of(blocks, 2)).collect()
    assert told and all(r["total"] == whole[r["gram"]] for r in told)


def test_ngrams_are_exploded_once(odd):
    told = lm.told_back(lm.grams_of(lm.in_blocks(odd.select("doc_id", "text")), 3))
    told.collect()
    plan = told._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert "ReusedExchange" in final and final.count("MapInArrow") == 1


def shuffle_files(spark):
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}


def test_exchanges_leave_the_disk_before_the_next(odd, spark):
    texts = [r["text"] for r in odd.collect()]
    before, setting = shuffle_files(spark), spark.conf.get(lm.CLEANUP)
    got = lm.scored(odd.select("doc_id", "text"), block_bytes=3000, slices=3)
    assert len(got.collect()) == len(texts)
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.conf.get(lm.CLEANUP) == setting


def test_slices_do_not_change_scores(odd):
    want = sorted((n, round(s, 4)) for n, s in backoff([r["text"] for r in odd.collect()], 4))
    got = sorted((r["n_words"], round(r["log_score"], 4)) for r in lm.scored(odd.select("doc_id", "text"), 4, block_bytes=1, slices=3).collect())
    assert [n for n, _ in got] == [n for n, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-3)


def test_only_ngrams_with_told_parts_are_sent(spark):
    texts = ["a b c d", "a b c e", "b c x", "y z y z"]
    blocks = lm.in_blocks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id"), 1)
    told = lm.stored(lm.told_back(lm.grams_of(blocks, 2, 2)), "told")
    sent = lm.longer_grams(blocks, told, 3)
    assert sent.select("gram").distinct().count() == 1 and sent.count() == 2  # "a b c"; the others hold a pair that no second block has
    assert {r["total"] for r in lm.told_back(sent).collect()} == {2}


def test_stored_ngrams_are_exchanged_once(odd):
    grams = lm.stored(lm.grams_of(lm.in_blocks(odd.select("doc_id", "text"), 3000), 2), "grams")
    told = lm.told_back(lm.in_slice(grams, "gram", 0, 3))
    assert told.collect()
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")]


def test_backoff_of_odd_rows(odd, empty):
    got = {r["doc_id"]: r for r in lm.scored_documents(odd).collect()}
    assert got[100]["log_score"] == 0 and got[101]["mean_log_score"] is None and got[102]["perplexity"] is None
    assert got[110]["n_backed_off"] == 0  # its copies know it
    assert lm.scored_documents(empty).count() == 0


def plain_quality(text):
    words = re.findall(WORD, text or "")
    seen = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = [False] * len(words)
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            marked[i : i + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    n = len(words)
    failed = n < 10 or 100 * sum(marked) > 20 * n
    raw = (text or "").encode()

    def outside(part):
        low, high = next((a, b) for size, a, b in reversed(quality.BANDS) if len(part) >= size)
        return not low <= len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part) <= high

    parts = [raw[i : i + 2048] for i in range(0, len(raw), 2048)]
    bad = bool(raw) and (outside(raw) or sum(len(p) for p in parts if outside(p)) > 0.5 * len(raw))
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(marked), failed, not failed and not bad


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_quality_equals_brute_force(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = sorted((str(r["doc_id"]), *(r[c] for c in COUNTS)) for r in quality.with_quality(docs).collect())
    assert got == sorted((str(r["doc_id"]), *plain_quality(r["text"])) for r in docs.collect())
    assert quality.with_quality(empty).count() == 0


def test_repetition_and_noise_leave_their_bands(spark):
    noise = "".join(chr(33 + (i * i * 7919 + i // 7 * 104729 >> 3) % 94) + " " * (i % 9 == 0) for i in range(4000))
    again = " ".join(f"w{i} of the same old line" for i in range(400))
    rows = {r["doc_id"]: r for r in quality.with_quality(spark.createDataFrame([(1, noise), (2, again)], "doc_id long, text string")).collect()}
    assert rows[1]["band"] == "noise" and rows[2]["band"] == "repetitive" and not rows[1]["kept"] and not rows[2]["kept"]


def test_quality_stage_keeps_all_columns(odd):
    kept = quality.rejected_removed(odd)
    assert kept.columns == odd.columns
    want = [r for r in odd.collect() if plain_quality(r["text"])[-1]]
    assert sorted(map(str, kept.collect())) == sorted(map(str, want))


def test_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    got = quality.with_quality(docs.join(labels, "doc_id")).where("not base_failed").toPandas()
    assert got[got["quality"] == 1]["kept"].mean() > 0.995
    assert got[got["quality"] == 0]["kept"].mean() < 0.9
