"""Operators 1, 6 and 7 against plain versions that loop over rows, and the whole pipeline on odd rows."""

import itertools
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose
from galecast.llm import langid, mix, shard
from oracle_check import SF_ROOT

SF = f"{SF_ROOT}/sf0.001"


# ---- language ID ---------------------------------------------------------------------------


def plain_grams(text: str) -> list[list[int]]:
    """For each byte the table rows of the n-grams that end at it."""
    folded = [b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in text.encode()]
    factors, out = (0x01000193, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), []
    for i in range(len(folded)):
        rows = []
        for place, n in enumerate(langid.ORDERS):
            key = sum((folded[i - j] + 1) * factors[j] for j in range(min(n, i + 1))) % 2**32
            rows.append((((key ^ key >> 15) * 0x2C1B3C6D) % 2**32 >> 12) % langid.BUCKETS + place * langid.BUCKETS)
        out.append(rows)
    return out


def plain_languages(labelled: list[tuple[str, str]], asked: list[str]) -> list[tuple[str, float]]:
    langs = sorted({lang for _, lang in labelled})
    code, width = langid.codewords(len(langs)).tolist(), langid.BUCKETS
    shares = []
    for lang in langs:
        counts = [0] * (width * len(langid.ORDERS))
        for text, other in labelled:
            for row in itertools.chain.from_iterable(plain_grams(text) if other == lang else []):
                counts[row] += 1
        share = []
        for a in range(0, len(counts), width):
            part = counts[a : a + width]
            more = langid.SMOOTH * sum(part) / 1e5 + 1e-9
            whole = sum(part) + more * width
            share += [(c + more) / whole for c in part]
        shares.append(share)
    bits = []
    for bit in range(len(code[0])):
        yes, no = ([s for s, word in zip(shares, code, strict=True) if word[bit] == side] for side in (1, 0))
        odds = [max(-6.0, min(6.0, math.log((sum(a) / len(a)) / (sum(b) / len(b))))) for a, b in zip(zip(*yes, strict=True), zip(*no, strict=True), strict=True)]
        mean = [sum(x * y for x, y in zip(share, odds, strict=True)) / len(langid.ORDERS) for share in shares]
        low, high = min(m for m, w in zip(mean, code, strict=True) if w[bit]), max(m for m, w in zip(mean, code, strict=True) if not w[bit])
        bits.append((odds, (low + high) / 2, max(low - high, 0.0), langid.SCALE / max(low - high, 0.05)))
    weights = [weight / sum(b[2] for b in bits) for _, _, weight, _ in bits]
    out = []
    for text in asked:
        grams = plain_grams(text)
        margin = [(sum(odds[row] for rows in grams for row in rows) / (len(grams) * len(langid.ORDERS)) - middle) * scale for odds, middle, _, scale in bits]
        loss = [sum(w * math.log1p(math.exp(-m if bit else m)) for w, m, bit in zip(weights, margin, word, strict=True)) for word in code]
        best = min(range(len(langs)), key=lambda i: (loss[i], i))
        out.append((langs[best], 1 / sum(math.exp(-langid.SCALE * (x - loss[best])) for x in loss)))
    return out


def test_a_text_is_judged_by_itself(spark):
    """What stands before a text in a batch, or how batches are cut, does not change its margin."""
    rows = [(i, prose(i, 40) if i % 2 else f"Überß {prose(i, 5)} déjà", "ab"[i % 2]) for i in range(20)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id"))
    texts = [b"x", b"yz", b"", "é".encode(), b"abc", b"abcd", b"efghi", prose(3, 60000).encode(), b"q"]
    alone = [langid.margins(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    together = langid.margins(model, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert np.allclose(alone, together, atol=1e-6)


def test_codes_learn_and_decode_as_the_plain_version_does(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null and lang is not null").orderBy("doc_id").limit(40)
    rows = [(r.doc_id, r.text[:400], r.lang) for r in rows.collect()]
    assert len({lang for *_, lang in rows}) >= 3
    labelled = spark.createDataFrame(rows[:30], "doc_id long, text string, lang string")
    texts = [text for _, text, _ in rows[30:]] + ["Ünï 漢字 x", "a", prose(1, 30)]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = langid.with_language(asked, langid.train(labelled, F.col("doc_id"))).orderBy("doc_id").collect()
    plain = plain_languages([(text, lang) for _, text, lang in rows[:30]], texts)
    assert [r.lang_pred for r in got] == [lang for lang, _ in plain]
    assert np.allclose([r.score for r in got], [score for _, score in plain], atol=1e-4)


# ---- mixing --------------------------------------------------------------------------------


def plain_cube(units: list[tuple[int, int, Fraction]]) -> list[int]:
    """0 or 1 for each (hash, size, chance) in this order, in exact fractions: flight, then the best of all landings."""
    p, size = [chance for *_, chance in units], [s for _, s, _ in units]
    random = [Fraction(h & 0xFFFFF, 1 << 20) for h, *_ in units]
    step = 0
    while len(open_ := [i for i, x in enumerate(p) if 0 < x < 1]) > mix.LANDING:
        trio = open_[:3]
        a, b, c = (size[i] for i in trio)
        move = (b - c, c - a, a - b) if len({a, b, c}) > 1 else (1, -1, 0)

        def room(sign: int, trio=trio, move=move):
            return min((1 - p[i]) / (sign * v) if sign * v > 0 else p[i] / (-sign * v) for i, v in zip(trio, move, strict=True) if v)

        up, down = room(1), room(-1)
        by = up if random[step % len(random)] * (up + down) < down else -down
        for i, v in zip(trio, move, strict=True):
            p[i] += by * v
        step += 1
    tokens, rows = sum(p[i] * size[i] for i in open_), sum(p[i] for i in open_)

    def far(ends: tuple[int, ...]) -> tuple:
        return abs(sum(e * size[i] for e, i in zip(ends, open_, strict=True)) - tokens), abs(sum(ends) - rows), ends[::-1]

    for i, end in zip(open_, min(itertools.product((0, 1), repeat=len(open_)), key=far), strict=True):
        p[i] = end
    return [int(x) for x in p]


def test_mix_equals_the_cube_method_in_fractions(spark):
    rows = [(i, prose(i, 20 + (i * 37) % 90), f"s{i % 3 % 2}" if i % 5 else None) for i in range(60)] + [(900, None, "s0"), (901, "", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mix.mixed_documents(docs).collect()}
    sizes = {i: len((text or "").split()) for i, text, _ in rows}
    totals = {name: sum(sizes[i] for i, _, s in rows if s == name) for name in ("s0", "s1", None)}
    # Weights 5, 2, 1 of 150 % of all words; a target stops at twice its source and the excess goes to the others by weight.
    left, goal, share = {"s0": 5, "s1": 2, None: 1}, {}, Fraction(3, 2) * sum(totals.values())
    while over := [s for s in left if (share - sum(goal.values())) * left[s] / sum(left.values()) > 2 * totals[s]]:
        goal |= {s: Fraction(2 * totals[s]) for s in over}
        left = {s: w for s, w in left.items() if s not in over}
    rest = share - sum(goal.values())
    goal |= {s: rest * w / sum(left.values()) for s, w in left.items()}
    keyed = docs.select("doc_id", "source", mix.words_of("text").alias("size"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("key"))
    order = {r.doc_id: r.h for r in keyed.select("doc_id", F.xxhash64(F.xxhash64(F.lit(11), "doc_id", "size", "key"), F.lit(1)).alias("h")).collect()}
    for source in totals:
        ids = sorted((i for i, _, s in rows if s == source), key=lambda i: order[i])
        rate = goal[source] / totals[source]
        sure = min(int(rate), 2)
        taken = plain_cube([(order[i], sizes[i], rate - sure) for i in ids])
        for i, extra in zip(ids, taken, strict=True):
            r = got[i]
            assert (r["size"], r.source_size, r.taken) == (sizes[i], totals[source], sizes[i] * (sure + extra)), (source, i)
            assert math.isclose(r.target, goal[source])


# ---- sharding ------------------------------------------------------------------------------


@pytest.mark.parametrize(("bucket_rows", "number"), [(4096, 7), (16, 40)])
def test_shards_equal_a_sort_of_all_rows(spark, bucket_rows, number):
    rows = [(i, f"s{i % 7 // 5}" if i % 4 else None) for i in range(300)] + [(7, "s0")] * 3 + [(None, "s1"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumn("tie", F.lit("t"))
    key, tie = F.col("doc_id"), F.col("tie")
    span = 1 << 40
    named = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    hashed = docs.select("doc_id", named.alias("name"), F.pmod(F.xxhash64(F.lit(7), key, tie), F.lit(span)).alias("random"), F.pmod(F.xxhash64(F.lit(7), named), F.lit(span)).alias("phase"))
    ranked = []
    for _, group in itertools.groupby(sorted(hashed.collect(), key=lambda r: (r.name, r.random)), key=lambda r: r.name):
        group = list(group)
        ranked += [((rank + r.phase / span) / len(group), r.name, r.doc_id) for rank, r in enumerate(group)]
    plain, seen = [], {}
    for place, (_, name, doc_id) in enumerate(sorted(ranked, key=lambda x: x[:2])):
        at = place * number // len(ranked)
        seen[at] = seen.get(at, -1) + 1
        plain.append((at, seen[at], name, doc_id))
    got = shard.shards(docs, number, F.col("source"), key, tie, bucket_rows=bucket_rows).withColumn("name", named).collect()
    assert sorted((r.shard, r.slot, r.name, r.doc_id) for r in got) == sorted(plain)


# ---- pipeline ------------------------------------------------------------------------------


def test_the_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns through all stages."""
    benchmark, base = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("benchmark", "documents"))
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    item = benchmark.where("text is not null").orderBy("item_id").first()["text"]
    text = {r.doc_id: r.text for r in base.where("doc_id <= 12").collect()}
    more = [(900, None), (901, ""), (902, " \t\n"), (903, "x" * 300000), (None, text[4]), (950, f"{text[3]} {item} {text[5]}")]
    more += [(1000 + i, text[0]) for i in range(12)] + [(960, " ".join(text[i] for i in range(6, 13)) * 20)]
    extra = spark.createDataFrame([(i, t, None, "é" if i else None, None) for i, t in more], base.schema)
    again = base.where("doc_id = 1")
    clash = {"kept": F.lit(False), "size": F.lit("a"), "row": F.lit(1), "fingerprint": F.lit(None).cast("string"), "text_crc32": F.lit(0)}
    base.unionByName(extra).unionByName(again).unionByName(again).withColumns(clash).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "mixing":
            assert after.exceptAll(docs).count() == 0, name
        ids[name], docs = [r.doc_id for r in after.select("doc_id").collect()], after
    first, second, third, mixed = (ids[name] for name, _ in corpus_pipeline.STAGES[:-1])
    assert not {900, 901, 902, 903} & set(first) and {0, 1, 3, 4, 5, 950, None, *range(1000, 1012)} <= set(first)
    assert not set(range(1000, 1012)) & set(second) and all(second.count(i) == 1 for i in (0, 1, 3, 5, 950)) and second.count(4) + second.count(None) == 1
    assert 950 not in third and {0, 1, 3, 5} <= set(third)
    assert set(mixed) <= set(third) and all(mixed.count(i) <= 2 for i in set(mixed))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, mixed)) == sorted(str(r.doc_id) for r in last)
    spans = sorted((r.start, r.n_tokens) for r in last)
    assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
